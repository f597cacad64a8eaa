"""The prefix trie of conversations against a plain one."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fieldspark.llm import trie
from fieldspark.llm.queries import rebuilt_conversations

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string, owner int"


def in_order(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns, key=lambda t: t[:2])] for c, turns in convs.items()}


def rebuilt(convs):
    found = {}
    for c, own in convs.items():
        h, base = zlib.crc32(str(c).encode()) % 9, c - int(math.fmod(c, 5))
        found[c] = own if base == c else convs.get(base, [])[:h] + own[h:]
    return found


def brute(convs):
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c in sorted(convs):
        path = tuple(convs[c])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
            if d:
                children[path[: d - 1]].add(path[:d])
        ends[path].append(c)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in children[p]) if children[p] else 1
        own = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        saved[p] = own + sum(saved[k] for k in children[p])
    digest = {p: hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest() for p in members}
    return sorted(
        (m[0], len(p), members[p[:-1]][0] if p else -1, len(m), len(children[p]), leaves[p], saved[p], digest[p])
        for p, m in members.items()
    )


def rows():
    rng = random.Random(2)
    say = ["hello", "é", "", None, "more", "x" * 500, "語"]
    found = []
    for c in range(-7, 150):
        if rng.random() < 0.2:
            continue
        n = rng.choice([1, 2, 3, 8, 9, 10, 12])
        same = rng.random() < 0.6
        for t in range(n):
            found.append((c, t if t or rng.random() < 0.5 else None, ("user", "assistant")[t % 2], say[t % 3] if same else rng.choice(say)))
    found += [(500 + c, t, "user", "copy") for c in range(40) for t in range(6)]
    found += [(1000, t, None, "long") for t in range(1500)] + [(1003, t, None, "long" if t < 1400 else "other") for t in range(1450)]
    found += [(700, 0, "user", "twice"), (700, 0, "user", "twice"), (None, 0, "user", "nobody's")]
    rng.shuffle(found)
    return found


def frame(spark, some):
    return spark.createDataFrame([(*r, "x", 1) for r in some], SCHEMA).repartition(4)


def told(df):
    return sorted(map(tuple, df.fillna(-1, ["parent_conv_id"]).collect()))


@pytest.mark.parametrize("shard, messages, chars", [(None, None, None), (5, 3, 20)])
def test_tries_equal_brute_force(spark, monkeypatch, shard, messages, chars):
    if shard:
        monkeypatch.setattr(trie, "SHARD_PATHS", shard)
        monkeypatch.setattr(trie, "SHARD_GROWTH", 2)
        monkeypatch.setattr(trie, "QUEUE_MESSAGES", messages)
        monkeypatch.setattr(trie, "PIECE_CHARS", chars)
    some = rows()
    turns = trie.numbered(frame(spark, some))
    assert told(trie.nodes_of(*rebuilt_conversations(turns))) == brute(rebuilt(in_order(some)))
    if not shard:
        assert told(trie.prefix_trie(frame(spark, some))) == brute(in_order(some))


def test_equal_turns_have_one_order(spark):
    some = [(1, 0, "a", "x"), (1, 0, "a", "y"), (2, 0, "a", "y"), (2, 0, "a", "x"), (3, None, None, None)]
    found = told(trie.prefix_trie(frame(spark, some)))
    assert [r[:4] for r in found] == [(1, 0, -1, 3), (1, 1, 1, 2), (1, 2, 1, 2), (3, 1, 1, 1)]


def test_no_conversations(spark):
    assert trie.prefix_trie(frame(spark, [(None, 1, "a", "b")])).collect() == []
    assert trie.prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_paths_in_any_tree(spark):
    """Totals over trees deep in shards, with stars and long lines of paths."""
    rng = random.Random(9)
    up = {0: None}
    for c in range(1, 400):
        up[c] = c - 1 if c < 120 else 3 if c < 250 else rng.randrange(c)
    tops = {0: 0}
    for c in range(1, 400):
        tops[c] = tops[up[c]] + rng.randint(1, 3)
    want = {c: [1, c] for c in up}
    for c in range(399, 0, -1):
        want[up[c]] = [a + b for a, b in zip(want[up[c]], want[c])]
    table = [(c, tops[c], u, None if u is None else tops[u], 1, c) for c, u in up.items()]
    paths = spark.createDataFrame(table, "owner bigint, top bigint, up bigint, up_top bigint, leaves bigint, saved bigint")
    found = trie.path_totals(paths, 16)
    assert {r.owner: [r.leaves, r.saved] for r in found.collect()} == want


def test_queue_spills_and_keeps_order():
    rng = random.Random(1)
    queue, left = trie.Queue(4, 10), []
    sums = defaultdict(lambda: [0, 0])
    for _ in range(500):
        message = (rng.randrange(20), rng.randrange(3), rng.randrange(9), 1)
        queue.push(message)
        for i in (0, 1):
            sums[message[:2]][i] += message[2 + i]
    assert queue.spills > 10
    while queue.peek() is not None:
        head = queue.peek()
        assert queue.pop() == head
        left.append(head)
    assert [m[:2] for m in left] == sorted(m[:2] for m in left)
    for key, wanted in sums.items():
        assert [sum(m[2 + i] for m in left if m[:2] == key) for i in (0, 1)] == wanted


def test_running_sums_over_ranges(spark):
    rng = random.Random(4)
    values = [(rng.choice([1, 1, 1, 1, 2, 9]), i, rng.randrange(-(1 << 63), 1 << 63)) for i in range(3_000)]
    df = spark.createDataFrame(values, "g bigint, i bigint, v bigint")
    ranged = trie._ranged(df, [F.col("g"), F.col("i")], 7)
    sums, want = defaultdict(int), {}
    for g, i, v in sorted(values):
        sums[g] += v
        want[i] = sums[g]
    found = {r.i: r for r in trie.running(ranged, "g", ["v"]).collect()}
    for i, total in want.items():
        assert (found[i].v_upto - total) % (1 << 64) == 0
        assert (found[i].v_before + found[i].v - total) % (1 << 64) == 0


def test_members_of_a_node_over_many_batches():
    def batch(rows):
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns] + [pa.array([3] * len(rows), pa.int32())], names=["depth", "x", "y", "conv", "part"]
        )

    one = [(0, 0, 0, c) for c in range(50)]
    batches = [batch(one[:7]), batch(one[7:]), batch([(1, 0, 0, 1), (1, 0, 1, 2), (1, 0, 1, 3)]), batch([(2, 0, 0, 9)])]
    found = [r for b in trie._members(iter(batches), 30) for r in b.to_pylist()]
    digests = {r["depth"]: r["ends_sha256"] for r in found if r["ends_sha256"]}
    assert set(digests) == {1}  # the first and the last node of a range go on in pieces
    assert ",".join(r["piece"] for r in found if r["depth"] == 0) == ",".join(map(str, range(50)))
    assert np.max([len(r["piece"] or "") for r in found]) <= 32
