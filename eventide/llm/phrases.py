"""Substring dedup by automata of repeated phrases.

A window is ``WINDOW`` consecutive words of one document. Words are removed that a
window covers whose words also stand at an earlier place: a smaller doc_id, or an
earlier start in the same document. All is judged on the input.

1. Of the equal texts only the first goes on; in the others every window recurs.
2. Each window has an anchor, the ``ANCHOR`` words in it with the smallest hash, so
   equal windows have equal anchors. Anchors that occur once in all texts drop out.
   The others have a family, the smallest text hash among their places.
3. Documents give each family the segments whose windows have its anchors. All places
   of a window are therefore in one family.
4. Families are dealt to cells. In a cell, windows that recur are confirmed, their
   first places are joined to passages, the passages are cut into pieces for an
   Aho-Corasick automaton, and it runs over all segments of the cell: around each
   hit the windows that hold the piece are compared with those of the passage, and equal
   ones, elsewhere than at the passage itself, are covered.
5. A family too large for one cell is split by document. What a cell leaves then is
   the first place of each window, and these windows, each a family of its own,
   go through step 4 again. A hot passage shrinks to one place per cell and round.

Order of documents: by id, a null id last; equal ids by the text's hash. Of equal rows
the first stays.

Edge cases: null and empty texts have no words, and their hash is that of the empty
string; texts of fewer than ``WINDOW`` words keep all; an empty table gives no rows;
other columns are not read.
"""

import hashlib
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm import words as W
from eventide.llm.common import only, store, tidy
from eventide.llm.groups import bounds, groups
from eventide.llm.mixing import WHITE_SPACE

WINDOW, ANCHOR = 20, 5
# A piece lies whole in every window of its passage that it could touch.
PIECE = 10
STRIDE = WINDOW - PIECE + 1
# Passages that may share a piece; windows take the place of pieces of more.
SHARED = 16
CELL_WORDS = 200_000
# Hits compared together.
HITS = 50_000


def _keyed(docs: DataFrame) -> DataFrame:
    """Documents with two hashes of the text and two of id and text."""
    return only(docs, ["doc_id", "text"]).select(
        "doc_id",
        "text",
        F.xxhash64("text").alias("t1"),
        F.xxhash64(F.lit(1), "text").alias("t2"),
        F.xxhash64("doc_id", "text").alias("k1"),
        F.xxhash64(F.lit(1), "doc_id", "text").alias("k2"),
    )


def anchors(tokens: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor places: the hash, the token, and the last window start it serves.

    The windows that an anchor serves follow one another; the leftmost of equal
    hashes is taken.
    """
    grams, _ = W.windows(tokens, np.array([0, len(tokens)]), ANCHOR)
    reach = WINDOW - ANCHOR + 1
    n = len(tokens) - WINDOW + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return np.zeros(0, np.uint64), none, none
    # Smallest of the next 1, 2, 4, ... anchors, by value, then place.
    place = np.arange(len(grams))
    low, at, width = grams, place, 1
    while width < reach:
        step = min(width, reach - width)
        left, right = low[: len(low) - step], low[step:]
        later = right < left
        at = np.where(later, at[step:], at[: len(at) - step])
        low = np.where(later, right, left)
        width += step
    room = np.repeat(first[1:], np.diff(first))[:n] - np.arange(n)
    window = np.flatnonzero(room >= WINDOW)
    chosen = at[:n][window]
    new = np.ones(len(window), dtype=bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (window[1:] != window[:-1] + 1)
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(window)) - 1 if len(begin) else begin
    return grams[chosen[begin]], window[begin], window[end]


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors of each text: hash, hash of the text, the document, and the windows served."""
    for batch in batches:
        texts = batch.column("text")
        t1, k1 = (batch.column(c).to_numpy() for c in ("t1", "k1"))
        for a, b in W.slices(texts):
            found = W.split(texts.slice(a, b - a))
            value, begin, end = anchors(W.hashes(found), found.first)
            doc = np.searchsorted(found.first, begin, side="right") - 1
            base = found.first[doc]
            span = ((begin - base) << 8) | (end - begin)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(value.view(np.int64)),
                    pa.array(t1[a:b][doc]),
                    pa.array(k1[a:b][doc]),
                    pa.array(span),
                ],
                ["anchor", "t1", "k1", "span"],
            )


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The segments of each document, per family: runs of words that its windows cover."""
    names = ["no_id", "doc_id", "t1", "k1", "k2"]
    for batch in batches:
        columns: list[list] = [[], [], [], [], []]
        for row in range(batch.num_rows):
            found = W.split(batch.column("text").slice(row, 1))
            places = batch.column("places")[row].values
            family = places.field("family").to_numpy()
            span = places.field("span").to_numpy()
            begin = span >> 8
            end = np.minimum(begin + (span & 255) + WINDOW, len(found.start))
            order = np.lexsort((begin, family))
            family, begin, end = family[order], begin[order], end[order]
            new = np.ones(len(family), dtype=bool)
            new[1:] = (family[1:] != family[:-1]) | (begin[1:] >= end[:-1])
            heads = np.flatnonzero(new)
            last = np.maximum.reduceat(end, heads)
            for f, a, z in zip(family[heads].tolist(), begin[heads].tolist(), last.tolist(), strict=True):
                if z - a >= WINDOW:
                    for to, value in zip(columns, (row, f, a, z - a, W.text_of_words(found, a, z - 1)), strict=True):
                        to.append(value)
        at = pa.array(columns[0], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(c).take(at) for c in names],
                pa.array(columns[1], pa.int64()),
                pa.array(columns[2], pa.int64()),
                pa.array(columns[3], pa.int64()),
                pa.array(columns[4], pa.string()),
            ],
            [*names, "family", "start", "n", "text"],
        )


def _numbered(found: W.Words, family: np.ndarray) -> np.ndarray:
    """Words as small numbers, equal for equal words of one family."""
    key, check = (W.mix(W.hashes(found, seed) ^ W.mix(family.astype(np.uint64))) for seed in (1, 2))
    _, head, which = np.unique(key, return_index=True, return_inverse=True)
    if (check[head][which] != check).any():  # two words of one hash
        _, which = np.unique(np.stack([key, check], axis=1), axis=0, return_inverse=True)
    return which.reshape(-1)


@dataclass
class Pieces:
    """Pieces of passages in an automaton: how long each is and the places it stands at."""

    automaton: ahocorasick.Automaton
    size: np.ndarray
    first: np.ndarray
    places: np.ndarray


def pieces_of(number: np.ndarray, heads: np.ndarray, tails: np.ndarray) -> Pieces:
    """Cut the passages [heads, tails) into pieces, so that each of their windows holds one."""
    pieces: dict[tuple, list[int]] = {}
    for a, z in zip(heads.tolist(), tails.tolist(), strict=True):
        for at in range(a, z - PIECE + 1, STRIDE):
            pieces.setdefault(tuple(number[at : at + PIECE].tolist()), []).append(at)
    common = {p for p, places in pieces.items() if len(places) > SHARED}
    if common:
        for a, z in zip(heads.tolist(), tails.tolist(), strict=True):
            for at in range(a, z - PIECE + 1, STRIDE):
                if tuple(number[at : at + PIECE].tolist()) in common:
                    for w in range(max(a, at + PIECE - WINDOW), min(at, z - WINDOW) + 1):
                        pieces.setdefault(tuple(number[w : w + WINDOW].tolist()), []).append(w)
        for p in common:
            del pieces[p]
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for k, piece in enumerate(pieces):
        automaton.add_word(piece, k)
    automaton.make_automaton()
    counts = np.array([len(p) for p in pieces.values()], dtype=np.int64)
    return Pieces(
        automaton,
        np.array([len(p) for p in pieces], dtype=np.int64),
        np.concatenate([[0], np.cumsum(counts)]),
        np.array([x for p in pieces.values() for x in p], dtype=np.int64),
    )


def locate(number: np.ndarray, first: np.ndarray, windows: np.ndarray, leads: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Starts of the windows, in any segment, that equal a passage's window elsewhere.

    ``windows`` has a number for each word where a window starts, else -1; ``leads`` tells
    the windows of the passages. Around each hit of a piece the windows that hold it are
    compared with those at the piece's places.
    """
    hit_at, hit_piece = [], []
    for a, z in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        for last, piece in pieces.automaton.iter(tuple(number[a:z].tolist())):
            hit_at.append(a + last + 1)
            hit_piece.append(piece)
    piece = np.array(hit_piece, dtype=np.int64)
    at = np.array(hit_at, dtype=np.int64) - pieces.size[piece]
    found = np.zeros(len(number), dtype=bool)
    padded = np.concatenate([np.full(WINDOW, -1, windows.dtype), windows])
    lead = np.concatenate([np.zeros(WINDOW, dtype=bool), leads])
    for begin in range(0, len(piece), HITS):
        some = piece[begin : begin + HITS]
        n = pieces.first[some + 1] - pieces.first[some]
        rank = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        place = pieces.places[np.repeat(pieces.first[some], n) + rank]
        here, size = np.repeat(at[begin : begin + HITS], n), np.repeat(pieces.size[some], n)
        for back in range(WINDOW - PIECE + 1):
            one, other = here - back + WINDOW, place - back + WINDOW
            same = (padded[one] == padded[other]) & lead[other] & (one != other) & (back <= WINDOW - size)
            found[one[same] - WINDOW] = True
    return np.flatnonzero(found)


def joined_runs(
    owner: np.ndarray, doc_of: np.ndarray, begin: np.ndarray, end: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of one document that overlap or touch, as one; ``owner`` is a segment of it."""
    if not len(owner):
        return owner, begin, end
    apart = doc_of[owner].astype(np.int64) * (int(end.max()) + 2)
    order = np.argsort(apart + begin, kind="stable")
    owner, begin, end, apart = (c[order] for c in (owner, begin, end, apart))
    reach = np.maximum.accumulate(apart + end)
    new = np.flatnonzero(np.append(True, (apart + begin)[1:] > reach[:-1]))
    last = np.append(new[1:], len(owner)) - 1
    return owner[new], begin[new], reach[last] - apart[new]


def _cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Covered words of each cell; of families in several cells also the first places of all windows."""
    for table in groups(batches, ["cell"]):
        cuts = bounds(table, ["cell"])
        table = table.combine_chunks()
        for lo, hi in itertools.pairwise(cuts.tolist()):
            yield from _one_cell(table.slice(lo, hi - lo).combine_chunks())


CELL = "k1 long, k2 long, begin long, end long, no_id boolean, doc_id long, t1 long, family long, start long, n long, text string"


def _one_cell(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    no_id = rows["no_id"].to_numpy()
    doc_id = rows["doc_id"].fill_null(0).to_numpy()
    t1, k1, k2, start, family, many = (rows[c].to_numpy() for c in ("t1", "k1", "k2", "start", "family", "many"))
    order = np.lexsort((family, start, k2, k1, t1, doc_id, no_id))
    # Windows that go on may come from the segments of two families.
    same = np.ones(len(order), dtype=bool)
    for column in (start, k1, k2, family):
        same[1:] &= column[order][1:] == column[order][:-1]
    same[0] = False
    order = order[~same]
    no_id, t1, k1, k2, start, family, many = (c[order] for c in (no_id, t1, k1, k2, start, family, many))
    rows = rows.take(pa.array(order))
    found = W.split(rows["text"].combine_chunks())
    number = _numbered(found, np.repeat(family, found.counts))
    key, at = W.windows(W.mix(number.astype(np.uint64)), found.first, WINDOW)
    # Segments are in order, so the first of equal windows is the first in the table.
    _, head, which, seen = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    segment = np.searchsorted(found.first, at, side="right") - 1
    leads = head[which] == np.arange(len(key))
    again = np.flatnonzero(leads & (seen[which] > 1))
    if len(again):
        new = np.ones(len(again), dtype=bool)
        new[1:] = (at[again][1:] != at[again][:-1] + 1) | (segment[again][1:] != segment[again][:-1])
        begins = np.flatnonzero(new)
        heads = at[again][begins]
        tails = at[again][np.append(begins[1:], len(again)) - 1] + WINDOW
        windows = np.full(len(number), -1, dtype=np.int64)
        windows[at] = which
        passage = np.zeros(len(number), dtype=bool)
        passage[at[again]] = True
        place = locate(number, found.first, windows, passage, pieces_of(number, heads, tails))
        owner = np.searchsorted(found.first, place, side="right") - 1
        begin = place - found.first[owner] + start[owner]
        new_doc = np.append(True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]))
        owner, begin, end = joined_runs(owner, np.cumsum(new_doc), begin, begin + WINDOW)
        yield _batch(k1=k1[owner], k2=k2[owner], begin=begin, end=end)
    # Families that stand in other cells too: the first places go on.
    on = np.flatnonzero(leads & many[segment])
    if len(on):
        owner = segment[on]
        raw = found.data.tobytes()
        text = [raw[found.start[a] : found.end[a + WINDOW - 1]].decode() for a in at[on].tolist()]
        word_key = W.hashes(found)
        grams, places = W.windows(word_key, found.first, WINDOW)
        yield _batch(
            k1=k1[owner],
            k2=k2[owner],
            no_id=no_id[owner],
            doc_id=rows["doc_id"].combine_chunks().take(pa.array(owner)),
            t1=t1[owner],
            family=grams[np.searchsorted(places, at[on])].view(np.int64),
            start=at[on] - found.first[owner] + start[owner],
            n=np.full(len(on), WINDOW),
            text=pa.array(text, pa.string()),
        )


def _batch(**columns) -> pa.RecordBatch:
    size = len(columns["k1"])
    kinds = {"no_id": pa.bool_(), "text": pa.string()}
    names = [c.split()[0] for c in CELL.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[c]) if c in columns else pa.nulls(size, kinds.get(c, pa.int64())) for c in names], names
    )


def _dealt(segments: DataFrame) -> DataFrame:
    """Segments with their cell, and whether their family stands in several."""
    # Stored, so that the join may split a hot family.
    words = store(segments.groupBy("family").agg(F.sum("n").alias("words")), "families")
    total = words.agg(F.sum("words")).first()[0] or 0
    cells = max(1, -(-total // CELL_WORDS))
    large = words.filter(F.col("words") > CELL_WORDS)
    parts = F.ceil(F.col("words") / CELL_WORDS)
    own = F.xxhash64("family", F.pmod(F.xxhash64("k1", F.lit(3)), parts))
    shared = F.pmod(F.xxhash64("family"), F.lit(cells))
    dealt = segments.join(large, "family", "left")
    return dealt.withColumns(
        {"many": F.col("words").isNotNull(), "cell": F.when(F.col("words").isNull(), shared).otherwise(own)}
    ).drop("words")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each text, by its hash, and how many words are gone."""
    for batch in batches:
        removed, kept = [], []
        for row in range(batch.num_rows):
            found = W.split(batch.column("text").slice(row, 1))
            runs = batch.column("runs")[row].values
            mark = np.zeros(len(found.start) + 1, dtype=np.int64)
            np.add.at(mark, runs.field("begin").to_numpy(), 1)
            np.add.at(mark, runs.field("end").to_numpy(), -1)
            gone = np.cumsum(mark[:-1]) > 0
            raw = found.data.tobytes()
            left = np.flatnonzero(~gone)
            parts = [raw[a:b] for a, b in zip(found.start[left].tolist(), found.end[left].tolist(), strict=True)]
            removed.append(int(gone.sum()))
            kept.append(hashlib.sha256(b" ".join(parts)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("k1"), batch.column("k2"), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
            ["k1", "k2", "removed", "sha"],
        )


def covered(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Heads of all documents, texts that hold recurring anchors, and covered runs (k1, k2, begin, end)."""
    keyed = _keyed(docs)
    parts = F.array_remove(F.split(F.coalesce("text", F.lit("")), WHITE_SPACE), "")
    heads = keyed.withColumn("parts", parts).select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id", "t1", "t2", "k1", "k2",
        F.size("parts").cast("bigint").alias("n_words"),
        F.sha2(F.array_join("parts", " "), 256).alias("sha_all"),
    )
    heads = store(heads, "heads")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k1", "k2", "row")
    firsts = store(heads.filter(F.col("n_words") >= WINDOW).groupBy("t1", "t2").agg(F.min(place).alias("first")), "firsts")
    kinds = "anchor long, t1 long, k1 long, span long"
    places = keyed.select("t1", "k1", "text").mapInArrow(tidy(_places), kinds)
    # Recurring: in two different texts, or twice in one.
    stats = places.groupBy("anchor").agg(
        F.min("t1").alias("family"), F.max("t1").alias("other"), F.min("span").alias("low"), F.max("span").alias("high")
    )
    # Stored, so that the join may split a hot anchor's places.
    recurring = store(stats.filter("family <> other OR low <> high").select("anchor", "family"), "anchors")
    hits = places.select("anchor", "k1", "span").join(recurring, "anchor")
    by_doc = hits.groupBy("k1").agg(F.collect_set(F.struct("family", "span")).alias("places"))
    reps = firsts.select("first.no_id", "t1", "t2", "first.k1", "first.k2")
    wanted = by_doc.join(reps, "k1")
    # Equal rows fall together before they are sent.
    one = keyed.groupBy("k1", "k2").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"))
    texts = one.join(wanted, ["k1", "k2"])
    texts = store(texts.select("no_id", "doc_id", "t1", "k1", "k2", "text", "places"), "texts")

    kinds = "no_id boolean, doc_id long, t1 long, k1 long, k2 long, family long, start long, n long, text string"
    segments = store(texts.mapInArrow(tidy(_segments), kinds), "segments")
    runs = []
    while True:
        ordered = _dealt(segments).repartition("cell").sortWithinPartitions("cell")
        done = store(ordered.mapInArrow(tidy(_cell), CELL), "cells")
        runs.append(done.filter("begin IS NOT NULL").select("k1", "k2", "begin", "end"))
        segments = done.filter("family IS NOT NULL").select(*[c.split()[0] for c in kinds.split(", ")])
        if segments.isEmpty():
            break
    out = runs[0]
    for more in runs[1:]:
        out = out.unionByName(more)
    return heads.join(firsts.select("t1", "t2", "first.row").withColumnRenamed("row", "first_row"), ["t1", "t2"], "left"), texts, out


def dedup(docs: DataFrame) -> DataFrame:
    """Per document (doc_id, text) its words, those removed, and the hash of what is left."""
    heads, texts, runs = covered(docs)
    by_doc = runs.groupBy("k1", "k2").agg(F.collect_set(F.struct("begin", "end")).alias("runs"))
    # Small runs of few texts would be broadcast, those of many not: one plan at every size.
    cut = texts.select("k1", "k2", "text").join(by_doc.hint("merge"), ["k1", "k2"])
    cut = cut.mapInArrow(tidy(_cut), "k1 long, k2 long, removed long, sha string")
    copy = F.col("first_row").isNotNull() & (F.col("first_row") != F.col("row"))
    empty: Column = F.sha2(F.lit(""), 256)
    out = heads.join(cut, ["k1", "k2"], "left")
    return out.select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0))).alias("n_removed"),
        F.when(copy, empty).otherwise(F.coalesce("sha", "sha_all")).alias("kept_sha256"),
    )
