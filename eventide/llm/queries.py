"""Queries of this subpackage: each applies one operator to its whole table."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm import (
    alignment,
    chat,
    decontam,
    divergence,
    jaccard,
    langid,
    licenses,
    mixing,
    packing,
    phrases,
    secrets,
    token_files,
    topk,
)
from eventide.llm.common import store, table
from eventide.session import run_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERY_EVERY, TOP = 20, 20
WEIGHTS, MOST_COPIES = (5, 2, 1), 3
TOKENIZER = "word_bpe_49k.json"
END_ID = 1
BYTE_TOKENIZER, PIECE_MODEL = "byte_bpe_50k.json", "piece_bpe_32k.model"
SEQUENCE_TOKENS, SEQUENCE_END_ID = 1024, 2


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_EVERY == 0, TOP)


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = jaccard.join(table(spark, sf_dir, "documents"))
    return joined.select("doc_id", "class_id", "n_links", "n_texts", "n_copies")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.summary(secrets.scan(table(spark, sf_dir, "documents")))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_turns(table(spark, sf_dir, "conversations"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs))


def token_digest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Write token files and read them back."""
    path = run_dir(spark, "tokens")
    token_files.write_tokens(docs, path, public_tokenizers.path(TOKENIZER), END_ID)
    back = token_files.read_tokens(spark, path)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digest(spark, table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.summary(licenses.scan(table(spark, sf_dir, "documents")))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), WEIGHTS, MOST_COPIES)
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.dedup(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = (public_tokenizers.path(BYTE_TOKENIZER), public_tokenizers.path(PIECE_MODEL))
    return alignment.align(table(spark, sf_dir, "documents"), *paths)


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(BYTE_TOKENIZER)
    cut = packing.cut_documents(table(spark, sf_dir, "documents"), path, SEQUENCE_END_ID, SEQUENCE_TOKENS)
    digest = cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(store(digest, "pieces"), SEQUENCE_TOKENS).drop("item")


def queries() -> dict[str, Query]:
    return {
        "op1_topk_search": op1_topk_search,
        "op2_jaccard_join": op2_jaccard_join,
        "op3_secret_scan": op3_secret_scan,
        "op4_chat_format": op4_chat_format,
        "op5_decontaminate": op5_decontaminate,
        "op6_language_id": op6_language_id,
        "op7_token_files": op7_token_files,
        "op8_license_scan": op8_license_scan,
        "op9_mix_sources": op9_mix_sources,
        "op10_substring_dedup": op10_substring_dedup,
        "op11_source_divergence": op11_source_divergence,
        "op12_tokenizer_alignment": op12_tokenizer_alignment,
        "op13_best_fit_packing": op13_best_fit_packing,
    }


TOPK_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id,
    list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.row, a.vec_id AS query_id, b.vec_id,
    CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.row <> b.row WHERE a.vec_id % 20 = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


WORDS_SQL = r"""
d AS (
  SELECT doc_id, text, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents)"""

# Equal texts are one text; classes are reached by following links from every text.
JACCARD_SQL = f"""
WITH RECURSIVE {WORDS_SQL},
t AS (SELECT text, min(doc_id) AS rep, count(*) AS copies, any_value(w) AS w FROM d WHERE len(w) > 0 GROUP BY text),
shingles AS (
  SELECT DISTINCT rep, array_to_string(w[i : i + 4], ' ') AS s
  FROM (SELECT rep, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM t)),
sizes AS (SELECT rep, count(*) AS n FROM shingles GROUP BY rep),
pairs AS (
  SELECT a.rep AS a, b.rep AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.rep <> b.rep GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON a = x.rep JOIN sizes y ON b = y.rep WHERE 5 * c >= 4 * (x.n + y.n - c)),
reached AS (
  SELECT rep, rep AS root FROM t UNION SELECT links.b, reached.root FROM reached JOIN links ON links.a = reached.rep),
classes AS (SELECT rep, min(root) AS class_id FROM reached GROUP BY rep),
linked AS (
  SELECT a AS rep, sum(t.copies) AS n_links, count(*) AS n_texts FROM links JOIN t ON t.rep = links.b GROUP BY a)
SELECT d.doc_id, coalesce(class_id, d.doc_id) AS class_id,
  CAST(coalesce(n_links, 0) + coalesce(copies - 1, 0) AS BIGINT) AS n_links,
  coalesce(n_texts, 0) AS n_texts, coalesce(copies, 1) AS n_copies
FROM d LEFT JOIN t ON t.text = d.text AND len(d.w) > 0
LEFT JOIN classes ON classes.rep = t.rep LEFT JOIN linked ON linked.rep = t.rep
"""

PHRASES_SQL = f"""
WITH {WORDS_SQL},
windows AS (
  SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d)),
later AS (
  SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM later),
removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
places AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text
  FROM places ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN removed ON removed.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id
"""


def _spans_sql(kind: str, pattern: str) -> str:
    """Matches of a pattern with their places: what lies between them adds up."""
    quoted = pattern.replace("'", "''")
    return f"""
{kind}_parts AS (
  SELECT doc_id, regexp_split_to_array(text, '{quoted}') AS gaps, regexp_extract_all(text, '{quoted}') AS found FROM t),
{kind}_rows AS (
  SELECT doc_id, i, len(gaps[i]) AS gap, found[i] AS m
  FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM {kind}_parts)),
{kind} AS (
  SELECT doc_id, m, CAST(sum(gap + len(m)) OVER (PARTITION BY doc_id ORDER BY i) AS BIGINT) AS z, z - len(m) AS a
  FROM {kind}_rows)"""


def _secrets_sql() -> str:
    kinds = {"assign": secrets.ASSIGN, "access": secrets.ACCESS, "hex": secrets.HEX}
    value, taken = secrets.ASSIGN.replace("'", "''"), secrets.TAKEN.replace("'", "''")
    runs = _spans_sql("run", secrets.CANDIDATE).replace("FROM t)", "FROM blanked)", 1)
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
blanked AS (
  SELECT doc_id, array_to_string(list_transform(
    list_zip(regexp_split_to_array(text, '{taken}'), regexp_extract_all(text, '{taken}')),
    lambda z: z[1] || repeat(' ', coalesce(len(z[2]), 0))), '') AS text FROM t),
{",".join(_spans_sql(k, p) for k, p in kinds.items())},{runs},
base AS (
  SELECT doc_id, 0 AS k, 'assign' AS kind, a, z FROM assign
  WHERE len(regexp_extract(m, '{value}', 1)) >= {secrets.VALUE_LENGTH}
  UNION ALL SELECT doc_id, 1, 'access', a, z FROM access
  UNION ALL SELECT doc_id, 2, 'hex', a, z FROM hex),
windows AS (
  SELECT doc_id, a, a + off AS p, substr(m, off + 1, {secrets.WINDOW}) AS w
  FROM (SELECT *, unnest(range(0, len(m) - {secrets.WINDOW - 1})) AS off FROM run)),
counted AS (
  SELECT doc_id, p, w, ch, count(*) AS c
  FROM (SELECT *, unnest(string_split(w, '')) AS ch FROM windows) GROUP BY ALL),
entropies AS (
  SELECT doc_id, p, w, log2({secrets.WINDOW}) - sum(c * log2(c)) / {secrets.WINDOW} AS bits FROM counted GROUP BY ALL),
high AS (
  SELECT doc_id, p, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS stretch FROM entropies
  WHERE bits >= CASE
    WHEN regexp_full_match(w, '[0-9A-Fa-f]+') AND regexp_matches(w, '[0-9]') AND regexp_matches(w, '[A-Fa-f]')
    THEN {secrets.HEX_BITS}
    WHEN regexp_matches(w, '[0-9]') AND regexp_matches(w, '[a-z]') AND regexp_matches(w, '[A-Z]') THEN {secrets.FULL_BITS}
    WHEN regexp_matches(w, '[0-9]') AND regexp_matches(w, '[A-Za-z]') THEN {secrets.MIXED_BITS}
    WHEN regexp_matches(w, '[a-z]') AND regexp_matches(w, '[A-Z]') THEN {secrets.CASES_BITS}
    ELSE {secrets.LETTER_BITS} END),
spans AS (
  SELECT * FROM base UNION ALL
  SELECT doc_id, 3, 'entropy', min(p), max(p) + {secrets.WINDOW} FROM high GROUP BY doc_id, stretch)
SELECT t.doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access,
  count(*) FILTER (k = 2) AS n_hex,
  sha256(coalesce(string_agg(kind || ':' || a || ':' || z, ',' ORDER BY a, k) FILTER (k < 3), '')) AS base_sha256,
  coalesce(string_agg(kind || ':' || a || ':' || z, ',' ORDER BY a, k), '') AS spans
FROM t LEFT JOIN spans ON spans.doc_id = t.doc_id GROUP BY t.doc_id
"""


# The regular expression takes runs of letters; beyond ASCII every character is one.
DIVERGENCE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
words AS (SELECT r, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY ALL HAVING count(DISTINCT r) >= 30),
counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
langs AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
sums AS (SELECT lang, source, sum(n) AS n FROM counts GROUP BY ALL),
sources AS (
  SELECT lang, source, coalesce(sums.n, 0) AS n, coalesce(v, 0) AS v
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN sums USING (lang, source) LEFT JOIN langs USING (lang)),
full_rows AS (
  SELECT s.lang, s.source, kept.term, coalesce(c.n, 0) AS n,
    1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 5) // (s.n + 5 * s.v) AS p,
    1 + 1000000000::HUGEINT * (kept.n + 5) // (langs.n + 5 * s.v) AS q
  FROM sources s JOIN kept USING (lang) JOIN langs USING (lang)
  LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = kept.term),
apart AS (
  SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
  FROM full_rows x JOIN full_rows y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
rows_ AS (
  SELECT s.lang, s.source, 'pair' AS part, o.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM sources s JOIN sources o ON o.lang = s.lang AND o.source <> s.source
  LEFT JOIN apart a ON a.lang = s.lang AND a.source = s.source AND a.item = o.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM full_rows WHERE n > 0 AND p > q)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM rows_ QUALIFY part = 'pair' OR rank <= 50
"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for the queries that SQL can express."""
    return {
        "op1_topk_search": TOPK_SQL,
        "op2_jaccard_join": JACCARD_SQL,
        "op3_secret_scan": _secrets_sql(),
        "op10_substring_dedup": PHRASES_SQL,
        "op11_source_divergence": DIVERGENCE_SQL,
    }
