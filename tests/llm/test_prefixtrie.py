"""The trie against one made of Python dictionaries."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import prefixtrie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            convs.setdefault(conv, []).append((turn is not None, turn or 0, tie, (role, text)))
    convs = {c: [t[-1] for t in sorted(turns, key=lambda t: t[:3])] for c, turns in convs.items()}
    members, ends = {}, {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        made = tuple(convs.get(c - int(np.fmod(c, 5)), [])[:h] + own[h:])
        ends.setdefault(made, []).append(c)
        for d in range(len(made) + 1):
            members.setdefault(made[:d], []).append(c)
    out = {}
    for node, who in members.items():
        below = [m for m in members if m[:len(node)] == node]
        kids = [m for m in below if len(m) == len(node) + 1]
        out[min(who), len(node)] = (
            min(members[node[:-1]]) if node else None, len(who), len(kids),
            sum(1 for m in below if not any(x[:-1] == m and x for x in members)),
            sum((len(members[m]) - 1) * len(m[-1][1].encode()) for m in below if m),
            hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest())
    return out


def found(df):
    return {(r["conv_id"], r["depth"]): tuple(r)[2:] for r in df.collect()}


def conversations(rnd, n, turns):
    rows = []
    for c in range(n):
        for t in range(rnd.randrange(turns)):
            rows.append((c * rnd.choice([1, 1, 1, 2]), t, rnd.choice(["user", "bot", None]),
                         rnd.choice(["a", "é", "longer text", None, ""])))
    return rows


@pytest.mark.parametrize("seed, shard", [(1, 4), (2, 30), (3, 4096)])
def test_trie_equals_brute_force(spark, seed, shard):
    rnd = random.Random(seed)
    rows = conversations(rnd, 40, 12)
    rows += [(None, 0, "user", "x"), (-7, 0, "user", "a"), (-5, 1, "user", "b"), (-5, None, "user", "first"),
             (3, 0, "user", "a"), (3, 0, "user", "a"), (41, 5, "user", "x" * 100_000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("depth", F.lit("mine"))
    assert found(prefixtrie.build(df, shard)) == brute(rows)


def test_hot_first_turn_and_one_very_long_conversation(spark):
    rows = [(c, t, "user", "same" if t == 0 else f"{c}-{t}") for c in range(40) for t in range(4)]
    rows += [(100, t, "user", f"long {t}") for t in range(50)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(prefixtrie.build(df, 8)) == brute(rows)


def test_no_conversations(spark):
    assert prefixtrie.build(spark.createDataFrame([], SCHEMA)).collect() == []
    assert prefixtrie.build(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).collect() == []


def test_slots_are_minimal_and_verified():
    rng = np.random.default_rng(5)
    a, b = rng.integers(-2**62, 2**62, (2, 5000))
    slots = prefixtrie.Slots(a, b)
    assert sorted(slots.of(a, b)) == list(range(5000))
    assert (slots.of(b, a) == -1).all()
    with pytest.raises(ValueError):
        prefixtrie.Slots(np.array([1, 1]), np.array([2, 2]))
    assert len(prefixtrie.Slots(a[:0], b[:0]).of(a, b)) == 5000


def test_pieces_of_ids_make_the_same_digest(spark, monkeypatch):
    ends = spark.createDataFrame([(i % 2, 7, (i * 37) % 500 - 20) for i in range(500)], "p1 long, p2 long, conv long")
    got = {r["p1"]: r["ends_sha256"] for r in prefixtrie.ends_digest(ends.repartition(6), []).collect()}
    for k in (0, 1):
        ids = sorted((i * 37) % 500 - 20 for i in range(500) if i % 2 == k)
        assert got[k] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
