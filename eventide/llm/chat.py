"""Chat formatting with minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant in turn,
the assistant last. Turns in other order are repaired: a turn is merged with the one
before it, gets another role, or empty turns are put before it (or at the end). Dynamic
programming over the automaton of legal turns finds the cheapest repair; of equally
cheap ones that whose first differing turn has the earlier choice (a new turn under its
own role, then another one, each in the order system, user, assistant; then a merge).

The result is a piece of rendered text for every turn of the input; the pieces of a
conversation, one after the other, are its rendering. So a conversation may be of any
length: turns are sorted over all tasks, a part of a conversation is summed up by the
cheapest cost between any two states, and a task needs only the costs behind its
part and the state before it.

Edge cases: a null text is empty, a null or unknown role must be relabelled; a null
conv_id is a conversation of its own; turns go by number (null first), then role and
text; repeated turns stay turns; the turn markers inside a text are broken up by a space;
an empty table gives no rows; other columns are not read.
"""

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import only, store, tidy
from eventide.llm.groups import bounds, groups

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
MERGE, INSERT, RELABEL = 1, 2, 4
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
FAR = 1 << 40

# State before, label: empty turns that make the label legal there.
BETWEEN: dict[tuple[int, int], list[int]] = {
    (START, SYSTEM): [],
    (START, USER): [],
    (START, ASSISTANT): [USER],
    (SYSTEM, USER): [],
    (SYSTEM, ASSISTANT): [USER],
    (USER, USER): [ASSISTANT],
    (USER, ASSISTANT): [],
    (ASSISTANT, USER): [],
    (ASSISTANT, ASSISTANT): [USER],
}
# Empty turns that end a conversation.
AT_END = {START: [], SYSTEM: [USER, ASSISTANT], USER: [ASSISTANT], ASSISTANT: []}


@dataclass(frozen=True)
class Choice:
    label: int
    merge: bool
    insert: tuple[int, ...]
    cost: int


def _choices(state: int, role: int) -> list[Choice]:
    """What can be done with a turn of a role (0: unknown), in order of preference."""
    labels = sorted((SYSTEM, USER, ASSISTANT), key=lambda x: (x != role, x))
    out = []
    for label in labels:
        if (state, label) in BETWEEN:
            between = BETWEEN[state, label]
            out.append(Choice(label, False, tuple(between), INSERT * len(between) + RELABEL * (label != role)))
    for label in labels:
        if state == label:
            out.append(Choice(label, True, (), MERGE + RELABEL * (label != role)))
    return out


CHOICES = {(state, role): _choices(state, role) for state in range(4) for role in range(4)}
# Per role the cheapest cost between two states.
STEP = np.full((4, 4, 4), FAR, dtype=np.int64)
for (_state, _role), _list in CHOICES.items():
    for _c in _list:
        STEP[_role, _state, _c.label] = min(STEP[_role, _state, _c.label], _c.cost)
END = np.array([INSERT * len(AT_END[s]) for s in range(4)], dtype=np.int64)


def matrix(roles: list[int]) -> np.ndarray:
    """Cheapest cost of a run of turns between any two states."""
    out = np.where(np.eye(4, dtype=bool), 0, FAR)
    for role in roles:
        out = np.minimum((out[:, :, None] + STEP[role][None]).min(axis=1), FAR)
    return out


def costs_behind(roles: list[int], end: np.ndarray) -> list[np.ndarray]:
    """Cheapest cost from each state to the conversation's end, before each turn and after the last."""
    out = [end]
    for role in reversed(roles):
        out.append(np.minimum((STEP[role] + out[-1][None]).min(axis=1), FAR))
    return out[::-1]


def repair(roles: list[int], state: int, behind: list[np.ndarray]) -> list[Choice]:
    """The choice for each turn, from ``state`` on."""
    out = []
    for k, role in enumerate(roles):
        best = min(c.cost + behind[k + 1][c.label] for c in CHOICES[state, role])
        choice = next(c for c in CHOICES[state, role] if c.cost + behind[k + 1][c.label] == best)
        out.append(choice)
        state = choice.label
    return out


def _turn(label: int, text: str) -> str:
    return f"{OPEN}{ROLES[label - 1]}\n{text}"


def _safe(text: str | None) -> str:
    return (text or "").replace("<|", "< |")


def piece(state: int, choice: Choice, text: str | None, last: bool) -> str:
    """What a turn adds to the rendering."""
    if choice.merge:
        out = "\n" + _safe(text)
    else:
        closed = CLOSE if state != START else ""
        out = closed + "".join(_turn(x, "") + CLOSE for x in choice.insert) + _turn(choice.label, _safe(text))
    if last:
        out += CLOSE + "".join(_turn(x, "") + CLOSE for x in AT_END[choice.label])
    return out


ORDERED = "conv long, no_conv boolean, turn long, role string, text string, part int, pos long"
PIECES = (
    "conv_id long, place long, turn long, role string, new_role string, action string, "
    "inserted array<string>, cost long, piece string"
)


def _roles(table: pa.Table) -> list[int]:
    number = {r: k + 1 for k, r in enumerate(ROLES)}
    return [number.get(r, 0) for r in table["role"].to_pylist()]


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, pa.Table]]:
    """Each conversation's rows in each part."""
    keys = ["part", "no_conv", "conv"]
    for table in groups(batches, keys):
        cuts = bounds(table, keys)
        for lo, hi in itertools.pairwise(cuts.tolist()):
            rows = table.slice(lo, hi - lo)
            yield {k: rows[k][0].as_py() for k in keys}, rows


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cost matrices of conversations at the ends of a part, which may go on in another."""

    def row(key: dict, rows: pa.Table) -> pa.RecordBatch:
        flat = matrix(_roles(rows)).reshape(-1).tolist()
        return pa.RecordBatch.from_pylist([{**key, "n": rows.num_rows, "matrix": flat}], schema=kind)

    kind = pa.schema([("part", pa.int32()), ("no_conv", pa.bool_()), ("conv", pa.int64()), ("n", pa.int64()), ("matrix", pa.list_(pa.int64()))])
    held = None
    for key, rows in _conversations(batches):
        if held is None or held[0]["part"] != key["part"]:
            if held is not None and not held[2]:
                yield row(*held[:2])
            yield row(key, rows)
            held = (key, rows, True)
        else:
            held = (key, rows, False)
    if held is not None and not held[2]:
        yield row(*held[:2])


def _behind(parts: pd.DataFrame) -> pd.DataFrame:
    """Costs behind each part of one conversation, and how many turns are before it."""
    parts = parts.sort_values("part").reset_index(drop=True)
    if len(parts) == 1:
        return parts.iloc[:0][["part", "no_conv", "conv"]].assign(before=0, last=False, behind=None)
    end, out = END, []
    for flat in reversed(parts["matrix"].tolist()):
        out.append(end.tolist())
        end = np.minimum((np.array(flat).reshape(4, 4) + end[None]).min(axis=1), FAR)
    before = parts["n"].cumsum() - parts["n"]
    return parts[["part", "no_conv", "conv"]].assign(before=before, last=parts.index == len(parts) - 1, behind=out[::-1])


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state after each part for every state before it."""
    kind = pa.schema([("part", pa.int32()), ("no_conv", pa.bool_()), ("conv", pa.int64()), ("exits", pa.list_(pa.int32()))])
    for key, rows in _conversations(batches):
        roles = _roles(rows)
        behind = costs_behind(roles, np.array(rows["behind"][0].as_py()))
        exits = [(repair(roles, s, behind) or [Choice(s, False, (), 0)])[-1].label for s in range(4)]
        yield pa.RecordBatch.from_pylist([{**key, "exits": exits}], schema=kind)


def _entries(parts: pd.DataFrame) -> pd.DataFrame:
    """The state before each part of one conversation."""
    parts = parts.sort_values("part")
    state, out = START, []
    for exits in parts["exits"]:
        out.append(state)
        state = int(exits[state])
    return parts[["part", "no_conv", "conv"]].assign(entry=out)


def _render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in PIECES.split(", ")]
    kinds = [pa.int64()] * 3 + [pa.string()] * 3 + [pa.list_(pa.string()), pa.int64(), pa.string()]
    out: list[list] = [[] for _ in names]
    for key, rows in _conversations(batches):
        roles = _roles(rows)
        behind, entry, before, last = (rows[c][0].as_py() for c in ("behind", "entry", "before", "last"))
        whole = behind is None
        state = START if whole else entry
        choices = repair(roles, state, costs_behind(roles, END if whole else np.array(behind)))
        texts, n = rows["text"].to_pylist(), len(roles)
        for k, (c, role, text) in enumerate(zip(choices, rows["role"].to_pylist(), texts, strict=True)):
            final = k == n - 1 and (whole or last)
            done = [w for w, yes in (("relabel", c.label != roles[k]), ("merge", c.merge)) if yes]
            added = [ROLES[x - 1] for x in (*c.insert, *(AT_END[c.label] if final else ()))]
            cost = c.cost + (INSERT * len(AT_END[c.label]) if final else 0)
            values = (
                key["conv"] if not key["no_conv"] else None, k + (0 if whole else before), rows["turn"][k].as_py(), role,
                ROLES[c.label - 1], "+".join(done) or "keep", added, cost, piece(state, c, text, final),
            )
            for to, value in zip(out, values, strict=True):
                to.append(value)
            state = c.label
        if len(out[0]) >= 4096:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names)
            out = [[] for _ in names]
    if out[0]:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names)


def format_turns(conversations: DataFrame) -> DataFrame:
    """Repaired and rendered turns of (conv_id, turn, role, text): one row per turn, with its piece.

    ``place`` numbers the turns of a conversation; ``inserted`` names the empty turns that its
    piece holds before it, and for the last turn also behind it.
    """
    rows = only(conversations, ["conv_id", "turn", "role", "text"]).select(
        F.coalesce("conv_id", F.lit(0)).cast("long").alias("conv"),
        F.col("conv_id").isNull().alias("no_conv"),
        F.col("turn").cast("long").alias("turn"),
        "role",
        "text",
        F.monotonically_increasing_id().alias("pos"),
    )
    order = ["no_conv", "conv", F.col("turn").asc_nulls_first(), "role", F.xxhash64("text"), "pos"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = ordered.withColumns({"part": F.spark_partition_id(), "pos": F.monotonically_increasing_id()})
    ordered = store(ordered.select("conv", "no_conv", "turn", "role", "text", "part", "pos"), "turns")

    def by_part(df: DataFrame) -> DataFrame:
        return df.repartition("part").sortWithinPartitions("part", "pos")

    key = ["part", "no_conv", "conv"]
    kind = "part int, no_conv boolean, conv long"
    heads = by_part(ordered.select(*key, "pos", "role"))
    summaries = heads.mapInArrow(tidy(_summaries), f"{kind}, n long, matrix array<long>")
    # At most two rows per part from here on; conversations in one part drop out.
    cut = summaries.groupBy("no_conv", "conv").applyInPandas(_behind, f"{kind}, before long, last boolean, behind array<long>")
    cut = store(cut, "cut")
    parts = by_part(ordered.select(*key, "pos", "role").join(F.broadcast(cut), key))
    exits = parts.mapInArrow(tidy(_exits), f"{kind}, exits array<int>")
    entries = exits.groupBy("no_conv", "conv").applyInPandas(_entries, f"{kind}, entry int")
    known = store(cut.join(entries, key), "entries")
    return by_part(ordered.join(F.broadcast(known), key, "left")).mapInArrow(tidy(_render), PIECES)


def rendered(turns: DataFrame) -> DataFrame:
    """One text per conversation, for conversations that fit in a row."""
    pieces = F.array_sort(F.collect_list(F.struct("place", "piece")))
    return turns.groupBy("conv_id").agg(
        F.array_join(F.transform(pieces, lambda x: x["piece"]), "").alias("text"), F.sum("cost").alias("cost")
    )
