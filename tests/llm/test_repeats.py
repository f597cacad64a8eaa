"""Window repeats, line runs, SimHash groups and string tiling against plain definitions."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fieldspark.llm import common, lines, simhash, substrings, tiling
from tests.llm.corpus import documents, texts


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def kept_by_definition(rows, size):
    counts = Counter()
    for _, text in rows:
        w = words(text)
        counts.update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    found = []
    for doc, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if counts[tuple(w[i : i + size])] > 1:
                gone[i : i + size] = [True] * size
        found.append((doc, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return found


def ordered(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("size", [8, 35])
def test_repeated_windows_go(spark, size):
    rows = texts()
    got = substrings.remove_repeats(documents(spark, rows), window=size, chunk_bytes=20_000, bucket_keys=3_000).collect()
    assert ordered([(r.doc_id, r.n_words, r.n_removed, r.kept) for r in got]) == ordered(kept_by_definition(rows, size))
    assert all(sum(b - a for a, b in r.repeats) == r.n_removed for r in got)


def test_digest_is_that_of_the_kept_words(spark):
    rows = texts()
    got = substrings.remove_repeats(documents(spark, rows), digest=True).collect()
    wanted = [(d, n, m, hashlib.sha256(k.encode()).hexdigest()) for d, n, m, k in kept_by_definition(rows, 35)]
    assert ordered([tuple(r) for r in got]) == ordered(wanted)


def test_no_rows_no_repeats(spark):
    assert substrings.remove_repeats(documents(spark, [])).collect() == []


def test_word_hashes_do_not_depend_on_place():
    many = [b"one two  three", b"", b" two\tone", None or b"three"]
    hashes, starts = common.hashed_words(many)
    assert starts.tolist() == [0, 3, 3, 5, 6]
    assert hashes[0] == hashes[4] and hashes[1] == hashes[3] and hashes[2] == hashes[5]
    assert len(set(hashes.tolist())) == 3


def removed_lines(rows, least):
    """Longest earlier match from every line, in order of id and xxhash64 of the text."""
    sequence = []
    for doc in rows:
        sequence += [(x, doc, i) for i, x in enumerate(doc[2].split("\n"))] if doc[2] is not None else []
        sequence.append((None, doc, -1))
    places, gone = defaultdict(list), defaultdict(set)
    for p, (line, doc, i) in enumerate(sequence):
        if line is None:
            continue
        best = 0
        for q in places[line]:
            n = 0
            while sequence[p + n][0] is not None and sequence[q + n][0] == sequence[p + n][0]:
                n += 1
            best = max(best, n)
        places[line].append(p)
        if best and sum(len(sequence[p + k][0]) + 1 for k in range(best)) >= least:
            gone[doc] |= set(range(i, i + best))
    return gone


@pytest.mark.parametrize("least", [5, 40])
def test_later_copies_of_line_runs_go(spark, least):
    docs = documents(spark)
    order = docs.select("doc_id", F.xxhash64("text").alias("h"), "text").distinct().collect()
    order = sorted((tuple(r) for r in order), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    gone = {(r[0], r[2]): g for r, g in removed_lines(order, least).items()}
    wanted = []
    for doc, text in texts():
        split = text.split("\n") if text is not None else []
        lost = gone.get((doc, text), set())
        kept = "\n".join(x for i, x in enumerate(split) if i not in lost) if text is not None else None
        wanted.append((doc, kept, len(split), len(lost)))
    got = lines.remove_repeated_lines(docs, min_chars=least)
    assert got.columns == [*docs.columns, "n_lines", "n_removed"]
    rows = got.select("doc_id", "text", "n_lines", "n_removed").collect()
    assert ordered([tuple(r) for r in rows]) == ordered(wanted)
    assert any(r[3] for r in wanted)


def test_short_copies_go_and_blank_lines_stay(spark):
    rows = [
        (1, "All rights reserved.\n\nfirst own line\nyes"), (2, "second own line\n\nAll rights reserved."), (3, "yes\nthird own line\n \n \nyes"),
        (4, "x\n\n\ny\nfourth own line"), (5, "fifth own line\nx\n\n\ny\n\nz"), (6, "\n\n"), (7, ""), (8, None), (9, "a\na\na"),
        (10, "\n" * 50 + "yes"), (11, "b" + "\n" * 50 + "yes"),
    ]
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in lines.remove_repeated_lines(documents(spark, rows)).collect()}
    assert got == {
        1: (rows[0][1], 4, 0), 2: ("second own line\n", 3, 1), 3: ("third own line\n \n ", 5, 2), 4: (rows[3][1], 5, 0),
        5: ("fifth own line\n\nz", 7, 4), 6: ("\n\n", 3, 0), 7: ("", 1, 0), 8: (None, 0, 0), 9: ("a", 3, 2),
        10: ("\n" * 49, 51, 1), 11: ("b", 51, 50),
    }


def test_short_copies_follow_the_definition(spark):
    """Every later line of a run that repeats and is not all blank goes, by the longest earlier match at each line."""
    rng = np.random.default_rng(2)
    rows = [(i, "\n".join(rng.choice(["a", "", " ", "bc", f"own {i}", "d e"], 12).tolist())) for i in range(30)]
    everything = [(d, i, x) for d, t in rows for i, x in enumerate([*t.split("\n"), None])]
    gone = defaultdict(set)
    for p, (d, i, _) in enumerate(everything):
        for q in range(p):
            n = 0
            while p + n < len(everything) and everything[p + n][2] is not None and everything[q + n][2] == everything[p + n][2]:
                n += 1
            if any(everything[p + k][2].strip() for k in range(n)):
                gone[d] |= set(range(i, i + n))
    got = lines.remove_repeated_lines(documents(spark, rows)).collect()
    for r in got:
        split = dict(rows)[r.doc_id].split("\n")
        assert r.text == "\n".join(x for k, x in enumerate(split) if k not in gone[r.doc_id])
        assert r.n_removed == len(gone[r.doc_id])


def test_no_documents_no_lines(spark):
    assert lines.remove_repeated_lines(documents(spark, [])).collect() == []


def test_doubling_ranks_follow_the_order_of_blocks(spark):
    ids = [3, 1, 2, 3, 1, 2, 9, 1, 2]
    rows = spark.createDataFrame([(i, v, v) for i, v in enumerate(ids)], "place long, a long, b long")
    levels = {d: {r.place: r["rank"] for r in ranks.collect()} for d, ranks in lines.doubled(rows, 8)}
    assert set(levels[1]) == {0, 1, 2, 3, 4, 5, 7, 8}
    assert levels[1][1] < levels[1][2] < levels[1][0]
    assert set(levels[2]) == {0, 1, 3, 4, 7} and levels[2][1] == levels[2][4] == levels[2][7] < levels[2][0] == levels[2][3]


def print_by_definition(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("bits", [3, 9])
def test_groups_are_those_of_all_pairs(spark, bits):
    rows = texts()
    prints = [print_by_definition(t) for _, t in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(prints):
        for j, b in enumerate(prints[:i]):
            if (a ^ b).bit_count() <= bits and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    least = {}
    for (doc, _), g in zip(rows, group):
        if doc is not None:
            least[g] = min(doc, least.get(g, doc))
    wanted = [(d, f"{p:016x}", least.get(g)) for (d, _), p, g in zip(rows, prints, group)]
    got = simhash.near_duplicates(documents(spark, rows), max_bits=bits, shard_size=8)
    assert ordered([tuple(r) for r in got.collect()]) == ordered(wanted)
    one = simhash.one_of_each(documents(spark, rows), max_bits=bits, shard_size=8).collect()
    assert len(one) == len(set(group))
    assert {r.doc_id for r in one} == {least.get(g) for g in group}


def test_no_documents_no_groups(spark):
    assert simhash.near_duplicates(documents(spark, [])).collect() == []
    assert simhash.one_of_each(documents(spark, [])).collect() == []


def test_trees_find_every_link():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 400, dtype=np.uint64)
    near = base ^ (np.uint64(1) << rng.integers(0, 64, 400, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 400, dtype=np.uint64))
    points = np.unique(np.concatenate([base, near]))
    tree, shards = simhash._top_tree(points[::3], float(len(points)), 40.0)
    assert shards > 4
    groups = simhash._Groups(len(points))
    for _, members, visitors in simhash._routed(tree, points, 3):
        both = np.concatenate([members, visitors])
        inside = simhash.linked(points[both], np.arange(len(members)), np.arange(len(members), len(both)), 3, leaf_pairs=64)
        groups.join(both, both[inside])
    close = np.bitwise_count(points[:, None] ^ points[None, :]) <= 3
    assert all(len(set(groups.parent[np.flatnonzero(row)])) == 1 for row in close)
    assert len(set(groups.parent)) == len(base)


def test_components_of_a_path_a_star_and_a_ring(spark):
    path = [(i, i + 1) for i in range(1, 40)]
    star = [(1000, i) for i in range(900, 960)]
    ring = [(100 + i, 100 + (i * 7 + 7) % 49) for i in range(49)]
    edges = spark.createDataFrame([*path, *star, *ring, (500, 500)], "a long, b long")
    got = {r.node: r.root for r in common.components(edges).collect()}
    assert {got.get(i, i) for i in range(1, 41)} == {1}
    assert {got.get(i, i) for i in [1000, *range(900, 960)]} == {900}
    parent = {}
    for a, b in ring:
        parent.setdefault(a, a), parent.setdefault(b, b)
        ra, rb = a, b
        while parent[ra] != ra:
            ra = parent[ra]
        while parent[rb] != rb:
            rb = parent[rb]
        parent[max(ra, rb)] = min(ra, rb)
    for x in parent:
        r = x
        while parent[r] != r:
            r = parent[r]
        assert got.get(x, x) == r


TOKEN = re.compile("[0-9a-z_\u00c0-\u1fff\u2070-\u2fff\u3040-\U0010ffff]+")


def coverage_by_definition(item, doc, least):
    """Mark the longest common run of unmarked tokens, first places first, until none is left."""
    a, b = TOKEN.findall(item.lower()), TOKEN.findall(doc.lower())
    used_a, used_b = [False] * len(a), [False] * len(b)
    while True:
        best = None
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and not used_a[i + n] and not used_b[j + n]:
                    n += 1
                if n >= least and (best is None or n > best[0]):
                    best = (n, i, j)
        if best is None:
            return sum(used_a) / len(a) if a else 0.0
        n, i, j = best
        used_a[i : i + n] = [True] * n
        used_b[j : j + n] = [True] * n


def test_tiles_cover_reordered_passages(spark):
    items = [
        (1, "Alpha beta gamma delta epsilon. Zeta eta theta iota kappa, lambda mu."), (2, "one two three four five six seven eight nine ten"),
        (3, "too short"), (4, None), (None, "one two three four five"), (5, "de de de de de de de de"), (2, "one two three four five six seven eight nine ten"),
    ]
    texts = [
        "x zeta eta THETA iota kappa lambda mu y y alpha “beta” gamma delta epsilon z", "one two three four five - and - six seven eight nine ten",
        "one two three four", "de " * 11, "nothing to see here at all, really", "", None,
        "four five six seven eight one two three four five six seven eight nine", "alpha beta gamma delta epsilon",
    ]
    docs = documents(spark, list(enumerate(texts)))
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    known = [(i, t) for i, t in dict.fromkeys(items) if i is not None and t is not None]
    for block_bytes in (1 << 20, 40):
        got = tiling.contamination(docs, benchmark, block_bytes=block_bytes).orderBy("doc_id").collect()
        for row, text in zip(got, texts):
            shares = {i: coverage_by_definition(t, text or "", 5) for i, t in known}
            assert row.max_coverage == pytest.approx(max(shares.values()))
            assert row.item_ids == sorted(i for i, s in shares.items() if s >= 0.5)
            assert row.contaminated == bool(row.item_ids)
    assert got[0].contaminated and got[1].contaminated
    empty = tiling.contamination(docs, benchmark.limit(0)).collect()
    assert len(empty) == len(texts) and not any(r.contaminated for r in empty)


def test_short_items_and_unspaced_scripts_are_found(spark):
    items = [(1, "forty-two"), (2, "Paris"), (3, "天地玄黄，宇宙洪荒。"), (4, "東京タワーはどこですか"), (5, "ภาษาไทย ง่าย"), (6, "。、…"), (7, "a b c d e f"), (8, "𠮷野家")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    wanted = {
        "it is forty two": [1], "two forty": [], "forty": [], "in PARIS, now": [2], "parisian": [], "他说天地玄黄，宇宙洪荒。是": [3], "天地 玄黄": [],
        "昨日、東京タワーはどこでした": [4], "เรียนภาษาไทยง่าย": [5], "a b c d": [], "x a b c d e": [7], "行く𠮷野家へ": [8], "": [], "。、…": [], "é": [],
    }
    docs = documents(spark, list(enumerate(wanted)))
    for block_bytes in (1 << 20, 20):
        got = tiling.contamination(docs, benchmark, block_bytes=block_bytes).collect()
        assert {r.text: r.item_ids for r in got} == wanted


def test_token_spans_follow_the_definition():
    single = "[\u0e00-\u109f\u3040-\u312f\u3400-\u4dbf\u4e00-\u9fff\U00020000-\U0003ffff]"
    token = re.compile(f"{single}|(?:(?!{single})[0-9a-z_\u00c0-\u1fff\u2070-\u2fff\u3040-\U0010ffff])+")
    rng = np.random.default_rng(6)
    for _ in range(50):
        text = "".join(rng.choice(list("ab9_ .,é語東タไ𠮷😀한글，。\u00a0"), 40).tolist())
        starts, ends = tiling.token_spans(np.frombuffer(text.encode() + b" ", dtype=np.uint8))
        assert [text.encode()[a:b].decode() for a, b in zip(starts, ends)] == token.findall(text)
