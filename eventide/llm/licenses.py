"""Licence scans by ordered signature rules.

Words are runs of ASCII letters, digits and characters beyond ASCII, in lower case
(A-Z only). Base places are those where the words of a base phrase stand one after
another. Around every trigger word a region of ``REACH`` words to either side is
tried against the rules whose key word it holds; of the matches, in order of rule
priority, then length, then place, one that lies inside an accepted match is dropped.

Edge cases: null and empty texts have no words, no places and score 0; equal rows get
equal results; places of one phrase may overlap and all count; an empty table gives no
rows; other columns are not read.
"""

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm import license_rules
from eventide.llm import words as W
from eventide.llm.common import only, tidy

# Base phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
REACH = 48

_compiled: list = []


def _word_keys(some: list[str]) -> np.ndarray:
    return W.hashes(W.split(pa.array([" ".join(some)])))


def _rules() -> tuple[list, np.ndarray, dict[str, list[int]]]:
    """Rules, sorted trigger hashes, and the rules of each key word; made once per worker."""
    if not _compiled:
        rules = license_rules.rules()
        by_key: dict[str, list[int]] = {}
        for number, rule in enumerate(rules):
            by_key.setdefault(rule.key, []).append(number)
        _compiled.extend([rules, np.sort(_word_keys(license_rules.TRIGGERS)), by_key])
    return tuple(_compiled)


def base_places(keys: np.ndarray, first: np.ndarray) -> list[tuple[str, np.ndarray]]:
    """Starts of each base phrase, inside one text."""
    left = np.repeat(first[1:], np.diff(first)) - np.arange(len(keys))
    out = []
    for phrase, label in BASE.items():
        wanted = _word_keys(phrase.split())
        at = np.flatnonzero(keys == wanted[0])
        at = at[left[at] >= len(wanted)]
        for k in range(1, len(wanted)):
            at = at[keys[at + k] == wanted[k]]
        out.append((label, at))
    return out


def _around(places: list[int], reach: int, n_words: int) -> list[tuple[int, int]]:
    """Word ranges within reach of places, joined where they touch."""
    out: list[tuple[int, int]] = []
    for place in places:
        begin, end = max(place - reach, 0), min(place + reach, n_words)
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], end)
        else:
            out.append((begin, end))
    return out


def match_rules(region: list[str]) -> list[tuple[int, int, int]]:
    """(first word, last word, rule) of all rule matches in a region.

    A rule is tried if the region holds all words that it needs, around the places of its
    key word, as far as a match can reach.
    """
    rules, _, by_key = _rules()
    text = f" {' '.join(region)} "
    # Where the space before each word stands, and the last one.
    spaces = [0, *np.cumsum([len(w) + 1 for w in region]).tolist()]
    places: dict[str, list[int]] = {}
    for k, word in enumerate(region):
        if word in by_key:
            places.setdefault(word, []).append(k)
    here = set(region)
    out = []
    for key, at in places.items():
        ranges: dict[int, list[tuple[int, int]]] = {}
        for number in by_key[key]:
            rule = rules[number]
            if not rule.needed <= here:
                continue
            if rule.reach not in ranges:
                ranges[rule.reach] = _around(at, rule.reach, len(region))
            for begin, end in ranges[rule.reach]:
                for m in rule.expression.finditer(text, spaces[begin], spaces[end] + 1):
                    out.append((bisect_left(spaces, m.start()), bisect_left(spaces, m.end()) - 1, number))
    return out


def resolve(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Drop matches inside one that precedes them in priority, length or place.

    A match lies inside an accepted one if the furthest end of those that begin no later
    is not before its own; that end comes from a tree over the places, so that the time grows
    with the number of matches and its logarithm.
    """
    rules = _rules()[0]
    found = sorted(set(found), key=lambda x: (rules[x[2]].priority, x[0] - x[1], x[0], x[2]))
    places = {begin: k + 1 for k, begin in enumerate(sorted({begin for begin, _, _ in found}))}
    furthest = [-1] * (len(places) + 1)
    kept: list[tuple[int, int, int]] = []
    for begin, end, number in found:
        at, reach = places[begin], -1
        while at:
            reach = max(reach, furthest[at])
            at &= at - 1
        if reach >= end:
            continue
        kept.append((begin, end, number))
        at = places[begin]
        while at <= len(places):
            furthest[at] = max(furthest[at], end)
            at += at & -at
    return sorted(kept)


def _regions(triggers: np.ndarray, n_words: int) -> Iterator[tuple[int, int]]:
    """Word ranges around triggers, joined where they touch."""
    begin = np.maximum(triggers - REACH, 0)
    end = np.minimum(triggers + REACH + 1, n_words)
    new = np.flatnonzero(np.append(True, begin[1:] > end[:-1]))
    yield from zip(begin[new].tolist(), end[np.append(new[1:], len(begin)) - 1].tolist(), strict=True)


DETECTION = "array<struct<first: long, last: long, label: string, priority: int>>"
SCAN = f"doc_id long, n_words long, base array<struct<first: long, label: string>>, detections {DETECTION}"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rules, trigger_keys, _ = _rules()
    for batch in batches:
        texts = batch.column("text")
        for a, b in W.slices(texts):
            found = W.ascii_folded(texts.slice(a, b - a), W.NO_ALNUM)
            keys, first = W.hashes(found), found.first
            base: list[list[dict]] = [[] for _ in range(b - a)]
            for label, places in base_places(keys, first):
                for p in places.tolist():
                    doc = int(np.searchsorted(first, p, side="right")) - 1
                    base[doc].append({"first": p - int(first[doc]), "label": label})
            at = np.minimum(np.searchsorted(trigger_keys, keys), len(trigger_keys) - 1)
            triggers = np.flatnonzero(trigger_keys[at] == keys)
            bounds = np.searchsorted(triggers, first)
            detections: list[list[dict]] = [[] for _ in range(b - a)]
            for doc in np.flatnonzero(np.diff(bounds)).tolist():
                origin = int(first[doc])
                matches = []
                for lo, hi in _regions(triggers[bounds[doc] : bounds[doc + 1]] - origin, int(first[doc + 1]) - origin):
                    region = [found.word(origin + k).decode() for k in range(lo, hi)]
                    matches += [(lo + x, lo + y, n) for x, y, n in match_rules(region)]
                detections[doc] = [
                    {"first": x, "last": y, "label": rules[n].label, "priority": rules[n].priority} for x, y, n in resolve(matches)
                ]
            kind = pa.struct([("first", pa.int64()), ("last", pa.int64()), ("label", pa.string()), ("priority", pa.int32())])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(a, b - a),
                    pa.array(found.counts, pa.int64()),
                    pa.array(base, pa.list_(pa.struct([("first", pa.int64()), ("label", pa.string())]))),
                    pa.array(detections, pa.list_(kind)),
                ],
                ["doc_id", "n_words", "base", "detections"],
            )


def scan(docs: DataFrame) -> DataFrame:
    """Per document (doc_id, text) its words, base places, and detections by word range."""
    return only(docs, ["doc_id", "text"]).mapInArrow(tidy(_scan), SCAN)


def summary(scanned: DataFrame) -> DataFrame:
    """One line per document of a scan: counts, ends of the base places, labels, score."""
    labels = F.array_union(F.transform("base", lambda x: x["label"]), F.transform("detections", lambda x: x["label"]))
    scores = F.create_map(*[F.lit(x) for pair in license_rules.SCORES.items() for x in pair])
    best = F.array_max(F.transform("detections", lambda x: scores[x["priority"]]))
    base_score = F.when(F.size("base") > 0, 1.0)
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("base").cast("bigint").alias("n_base"),
        F.array_min(F.transform("base", lambda x: x["first"])).alias("first_word"),
        F.array_max(F.transform("base", lambda x: x["first"])).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("base", lambda x: x["label"]))), ",").alias("base_labels"),
        F.array_join(F.array_sort(labels), ",").alias("labels"),
        F.coalesce(F.greatest(best, base_score), F.lit(0.0)).alias("score"),
    )
