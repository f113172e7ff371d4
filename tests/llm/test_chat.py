import itertools
import random
import re

import pytest

from eventide.llm import chat
from tests.llm.conftest import SF

NAMES = ["other", "system", "user", "assistant"]


def brute(roles):
    """Least cost over all labels and merges."""
    best = None
    for labels in itertools.product((1, 2, 3), repeat=len(roles)):
        for merged in itertools.product((False, True), repeat=len(roles)):
            state, cost = chat.START, 0
            for role, label, merge in zip(roles, labels, merged, strict=True):
                if merge and state != label or not merge and (state, label) not in chat.BETWEEN:
                    break
                cost += chat.MERGE if merge else chat.INSERT * len(chat.BETWEEN[state, label])
                cost += chat.RELABEL * (role != label)
                state = label
            else:
                cost += chat.INSERT * len(chat.AT_END[state])
                best = cost if best is None else min(best, cost)
    return best


SCHEMA = "conv_id long, turn long, role string, text string, part string"


@pytest.fixture(scope="module")
def conversations(spark):
    rng = random.Random(1)
    given = {k: [rng.randint(0, 3) for _ in range(rng.randint(1, 5))] for k in range(50)}
    data = [(k, t, NAMES[r] if r else rng.choice(["other", None]), f"text {t}", "x") for k, rs in given.items() for t, r in enumerate(rs)]
    data += [(1000, t, rng.choice(NAMES), f"long {t} <|im_end|>", "x") for t in range(900)]
    return given, spark.createDataFrame(data, SCHEMA)


def pieces(spark, df, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = chat.format_turns(df).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    return sorted((tuple(r) for r in found), key=repr)


def test_costs_and_rendering(spark, conversations):
    given, df = conversations
    found = pieces(spark, df, 3)
    texts, costs = {}, {}
    for r in sorted(found, key=lambda r: (r[0], r[1])):
        texts[r[0]] = texts.get(r[0], "") + r[8]
        costs[r[0]] = costs.get(r[0], 0) + r[7]
    for k, roles in given.items():
        assert costs[k] == brute(roles)
    for text in texts.values():
        labels = re.findall(r"<\|im_start\|>(\w+)\n", text)
        assert re.fullmatch(r"(system )?(user assistant )+", "".join(f"{x} " for x in labels))
        assert text.count("<|im_end|>\n") == len(labels) and text.endswith("<|im_end|>\n")
    assert texts[1000].count("< |im_end|>") == 900


def test_parts_change_nothing(spark, conversations):
    """A conversation cut into parts is repaired like a whole one."""
    _, df = conversations
    whole = pieces(spark, df, 1)
    assert whole == pieces(spark, df, 7) == pieces(spark, df.repartition(3), 23)


def test_legal_conversations_stay(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    found = chat.format_turns(df).collect()
    assert len(found) == df.count()
    legal = [r for r in found if r.cost == 0]
    assert all(r.action == "keep" and r.role == r.new_role and not r.inserted for r in legal)
    texts = chat.rendered(chat.format_turns(df)).collect()
    assert len(texts) == df.select("conv_id").distinct().count()


def test_odd_turns(spark):
    data = [(None, None, "user", None, "x"), (None, 1, "user", "hi", "x"), (1, 0, None, None, "x"), (2, 0, "system", "", "x")]
    data += [(3, 0, "user", "same", "x"), (3, 0, "user", "same", "x")]
    df = spark.createDataFrame(data, SCHEMA)
    found = {(r.conv_id, r.place): r for r in chat.format_turns(df).collect()}
    assert found[None, 0].piece == "<|im_start|>user\n" and found[None, 1].action == "merge"
    assert found[1, 0].new_role in chat.ROLES and "relabel" in found[1, 0].action
    assert found[2, 0].inserted == ["user", "assistant"]
    assert found[3, 1].piece.startswith("\nsame")
    assert chat.format_turns(df.limit(0)).collect() == []
