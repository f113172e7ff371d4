"""Secret scans: fixed patterns, and entropy of sliding windows. Built-in functions only.

Three kinds are found by pattern. What they or the allow list match, one after the
other from the left, is then blanked out, and every run of ``RUN`` or more key
characters that is left is a candidate: a window of ``WINDOW`` characters slides over
it, and the window's Shannon entropy follows from the counts of the character that
enters and the one that leaves. The limit depends on the classes of characters in the
window. Every maximal stretch of windows over their limits is a finding of its own, from
the first window's start to the last one's end. Pattern findings always stay.

A run is cut into pieces of ``PIECE`` windows, so the time a text takes grows with its
length, however long its runs are.

Of 3,000 random keys of 20 / 32 / 40 characters the limits found: hexadecimal 97 / 100 /
100 %, base32 93 / 100 / 100 %, lower case with digits 97 / 100 / 100 %, base62 97 / 100 /
100 %, letters of both cases 73 / 96 / 99 %; of lower-case letters alone 1 / 5 / 7 %, as
words look like them.

Places are code points, the end exclusive. Edge cases: a null text is empty and has no
findings; equal rows get equal results; an empty table gives no rows; other columns
are not read.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.functions.plan import compute_once
from eventide.llm.common import only

# Fixed patterns. Those of access and hex hold the least length: a shorter run has no longer part.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
VALUE_LENGTH = 12
KINDS = ("assign", "access", "hex", "entropy")

WINDOW, RUN = 20, 20
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{RUN},}}"
# Digits first, then the letters of hexadecimal numbers, then the others.
ALPHABET = "0123456789abcdefABCDEFghijklmnopqrstuvwxyzGHIJKLMNOPQRSTUVWXYZ+/_=-"
# Bits a window's entropy must reach: hexadecimal digits, both cases with digits, one case
# with digits, letters of both cases, anything else.
HEX_BITS, FULL_BITS, MIXED_BITS, CASES_BITS, LETTER_BITS = 3.0, 3.7, 3.5, 3.9, 4.1
# Windows of one piece of a run.
PIECE = 256
# What is no secret, in either case of letters.
ALLOWED = (
    "example|sample|dummy|placeholder|changeme|your[_-]?(api)?[_-]?key|redacted|xxxxxx|000000|"
    "abcdefgh|123456789|qwertyuiop|lorem|ipsum|localhost|undefined|base64"
)

# What is blanked out before candidates are looked for.
TAKEN = f"{ASSIGN[:-2]}{{{VALUE_LENGTH},}})|{ACCESS}|{HEX}|(?i:{ALLOWED})"

_CHUNK = 256
_SPAN = "struct<start: int, end: int, text: string>"


def _raw(text: str, pattern: str) -> Column:
    """Matches in order with the number of characters before each since the last one."""
    found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    between = F.split(F.col(text), pattern, -1)
    pairs = F.filter(
        F.zip_with(between, found, lambda gap, m: F.struct(F.length(gap).alias("gap"), F.length(m).alias("len"), m.alias("text"))),
        lambda x: x["text"].isNotNull(),
    )
    none = F.array().cast("array<struct<gap: int, len: int, text: string>>")
    return F.when(F.col(text).rlike(pattern), pairs).otherwise(none)


def _placed(raw: str) -> Column:
    """Start and end of each match: running sums, by chunks so that no list is copied often."""
    return F.expr(f"""
        aggregate(transform(sequence(0, greatest(size({raw}) - 1, 0) div {_CHUNK}), c -> slice({raw}, c * {_CHUNK} + 1, {_CHUNK})),
          cast(named_struct('at', 0, 'out', array()) as struct<at: int, out: array<array<{_SPAN}>>>),
          (s, chunk) -> element_at(transform(array(
            aggregate(chunk, cast(named_struct('at', s.at, 'out', array()) as struct<at: int, out: array<{_SPAN}>>),
              (q, x) -> named_struct('at', q.at + x.gap + x.len, 'out', concat(q.out, array(named_struct(
                'start', q.at + x.gap, 'end', q.at + x.gap + x.len, 'text', x.text)))))),
            r -> named_struct('at', r.at, 'out', concat(s.out, array(r.out)))), 1),
          s -> flatten(s.out))""")


def _blanked(text: str) -> Column:
    """The text with spaces in place of what is taken."""
    found = F.regexp_extract_all(F.col(text), F.lit(TAKEN), F.lit(0))
    between = F.split(F.col(text), TAKEN, -1)
    filled = F.zip_with(between, found, lambda gap, m: F.concat(gap, F.coalesce(F.repeat(F.lit(" "), F.length(m)), F.lit(""))))
    return F.when(F.col(text).rlike(TAKEN), F.array_join(filled, "")).otherwise(F.col(text))


# Pieces of all candidates: the windows of one begin in its first PIECE characters, and the
# start of the next piece gives the rest of the last ones.
_PIECES = f"""
flatten(transform(candidates, x -> element_at(transform(array(regexp_extract_all(x.text, '.{{1,{PIECE}}}', 0)), cut ->
  transform(cut, (p, k) -> named_struct('at', x.start + k * {PIECE},
    'text', concat(p, coalesce(left(get(cut, k + 1), {WINDOW - 1}), ''))))), 1)))
"""

# Stretches of windows over their limit in one piece (first and last window). The state is the
# sum of c * log2(c) over the window's characters, the characters by class, and the stretches
# so far. With each character ``w`` holds the one that leaves, those that stay and the one that enters.
_STRETCHES = f"""
aggregate(transform(sequence(1, length(q.text)), i -> named_struct('i', i, 'w', substr(q.text, greatest(i - {WINDOW}, 1), least(i, {WINDOW + 1})))),
  cast(named_struct('sum', 0D, 'hex', 0, 'digits', 0, 'lower', 0, 'upper', 0, 'first', null, 'out', array())
       as struct<sum: double, hex: int, digits: int, lower: int, upper: int, first: int, out: array<struct<first: int, last: int>>>),
  (s, c) -> element_at(transform(transform(transform(
    array(named_struct('new', right(c.w, 1), 'old', if(c.i > {WINDOW}, left(c.w, 1), ''),
      'stay', if(c.i > {WINDOW}, substr(c.w, 2, {WINDOW - 1}), left(c.w, length(c.w) - 1)))),
    a -> named_struct(
      'in', length(a.stay) - length(replace(a.stay, a.new)),
      'gone', if(a.old = '', 0, 1 + length(a.stay) - length(replace(a.stay, a.old))),
      'n', instr('{ALPHABET}', a.new), 'o', if(a.old = '', 0, instr('{ALPHABET}', a.old)))),
    b -> named_struct(
      'sum', s.sum + if(b.gone > 1, (b.gone - 1) * log2(b.gone - 1) - b.gone * log2(b.gone), 0D)
        + (b.in + 1) * log2(b.in + 1) - if(b.in > 0, b.in * log2(b.in), 0D),
      'hex', s.hex + if(b.n <= 22, 1, 0) - if(b.o BETWEEN 1 AND 22, 1, 0),
      'digits', s.digits + if(b.n <= 10, 1, 0) - if(b.o BETWEEN 1 AND 10, 1, 0),
      'lower', s.lower + if(b.n BETWEEN 11 AND 16 OR b.n BETWEEN 23 AND 42, 1, 0) - if(b.o BETWEEN 11 AND 16 OR b.o BETWEEN 23 AND 42, 1, 0),
      'upper', s.upper + if(b.n BETWEEN 17 AND 22 OR b.n BETWEEN 43 AND 62, 1, 0) - if(b.o BETWEEN 17 AND 22 OR b.o BETWEEN 43 AND 62, 1, 0))),
    d -> element_at(transform(array(
        c.i >= {WINDOW} AND log2({WINDOW}) - d.sum / {WINDOW} >= CASE
          WHEN d.hex = {WINDOW} AND d.digits > 0 AND d.digits < {WINDOW} THEN {HEX_BITS}
          WHEN d.digits > 0 AND d.lower > 0 AND d.upper > 0 THEN {FULL_BITS}
          WHEN d.digits > 0 AND d.lower + d.upper > 0 THEN {MIXED_BITS}
          WHEN d.lower > 0 AND d.upper > 0 THEN {CASES_BITS}
          ELSE {LETTER_BITS} END),
      over -> named_struct('sum', d.sum, 'hex', d.hex, 'digits', d.digits, 'lower', d.lower, 'upper', d.upper,
        'first', if(over, coalesce(s.first, c.i - {WINDOW}), null),
        'out', if(NOT over AND s.first IS NOT NULL, concat(s.out, array(named_struct('first', s.first, 'last', c.i - {WINDOW + 1}))), s.out))), 1)), 1),
  s -> if(s.first IS NULL, s.out, concat(s.out, array(named_struct('first', s.first, 'last', length(q.text) - {WINDOW})))))
"""

# Stretches that go on in the next piece are one.
_JOINED = f"""
zip_with(
  transform(filter(stretches, (x, k) -> k = 0 OR x.first > get(stretches, k - 1).last + 1), x -> x.first),
  transform(filter(stretches, (x, k) -> k = size(stretches) - 1 OR get(stretches, k + 1).first > x.last + 1), x -> x.last),
  (a, z) -> named_struct('start', a, 'end', z + {WINDOW}))
"""


def scan(docs: DataFrame) -> DataFrame:
    """Findings of each document (doc_id, text): an array of (start, end) per kind, with the
    matched text where a pattern found it."""
    texts = only(docs, ["doc_id", "text"]).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX}
    blanked = compute_once(texts, _blanked("text").alias("rest"))
    raw = compute_once(
        blanked, *[_raw("text", p).alias(f"raw_{k}") for k, p in patterns.items()], _raw("rest", CANDIDATE).alias("raw_candidates")
    ).drop("text", "rest")
    placed = compute_once(raw, *[_placed(f"raw_{k}").alias(k) for k in (*patterns, "candidates")])
    long_values = F.filter("assign", lambda x: F.length(F.regexp_extract(x["text"], ASSIGN, 1)) >= VALUE_LENGTH)
    kept = compute_once(placed, long_values.alias("kept"), F.expr(_PIECES).alias("pieces"))
    kept = kept.select("doc_id", F.col("kept").alias("assign"), "access", "hex", "pieces")
    within = f"transform(pieces, q -> transform({_STRETCHES}, r -> named_struct('first', q.at + r.first, 'last', q.at + r.last)))"
    found = compute_once(kept, F.flatten(F.expr(within)).alias("stretches")).drop("pieces")
    return compute_once(found, F.expr(_JOINED).alias("entropy")).drop("stretches")


def _listed(kinds: tuple[str, ...]) -> Column:
    """kind:start:end of all findings by start, then kind."""
    def tagged(kind: str) -> Column:
        number, name = F.lit(KINDS.index(kind)).alias("k"), F.lit(kind).alias("kind")
        return F.transform(kind, lambda x: F.struct(x["start"], number, x["end"], name))

    ordered = F.array_sort(F.concat(*map(tagged, kinds)))
    return F.array_join(F.transform(ordered, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def summary(scanned: DataFrame) -> DataFrame:
    """One line per document of a scan: counts, the hash of its pattern findings, all places."""
    counts = [F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS[:3]]
    return scanned.select(
        "doc_id", *counts, F.sha2(_listed(KINDS[:3]), 256).alias("base_sha256"), _listed(KINDS).alias("spans")
    )
