"""The prefix trie against prefixes enumerated in plain Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from nimbusgrid.llm import trie

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def plain(sequences):
    """Nodes of the trie of {id: [(role, text), ...]}."""
    members = {}
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {p: 0 for p in members}
    for p in members:
        if p:
            children[p[:-1]] += 1
    rows = []
    for p, held in members.items():
        below = [x for x in members if x[:len(p)] == p]
        ends = sorted(c for c in held if len(sequences[c]) == len(p))
        rows.append((min(held), len(p), min(members[p[:-1]]) if p else None, len(held), children[p], sum(children[x] == 0 for x in below),
                     sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in below if x),
                     hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(rows, key=str)


def lists(spark, sequences):
    rows = [(c, k, r, t) for c, turns in sequences.items() for k, (r, t) in enumerate(turns)]
    made = trie.turn_lists(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    empty = [(c, []) for c, turns in sequences.items() if not turns]
    return made.unionByName(spark.createDataFrame(empty, made.schema)) if empty else made


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def branching(seed, n, depth, kinds):
    rng = random.Random(seed)
    return {i: [("u" if k % 2 else "a", rng.choice(kinds)) for k in range(rng.randrange(depth))] for i in range(n)}


@pytest.mark.parametrize("sequences", [
    branching(1, 150, 9, ["x", "yy"]),
    {i: [("u", str(k)) for k in range(i)] for i in range(40)},  # a chain: every one starts the next
    {i: [("u", str(k)) for k in range(i % 30)] + [("a", f"end {i}")] for i in range(60)},  # one long edge, split at all depths
    {-5: [], 3: [("u", "")], 4: [("u", "")], 5: [("", "u")], 10**15: [("u", "é")] * 70},
], ids=["branching", "chain", "comb", "edges"])
def test_against_plain_prefixes(spark, sequences):
    assert got(trie.prefix_trie(lists(spark, sequences))) == plain(sequences)


def test_batches_follow_the_logarithm(spark, monkeypatch):
    """A chain of 64 conversations, each the start of the next, takes far fewer batches than its depth."""
    batches, real = [], trie.inserted
    monkeypatch.setattr(trie, "inserted", lambda *a: batches.append(1) or real(*a))
    trie.prefix_trie(lists(spark, {i: [("u", str(k)) for k in range(i)] for i in range(64)})).collect()
    assert len(batches) <= 12


def test_fat_binary_search_finds_every_prefix(spark):
    sequences = branching(2, 60, 12, ["x", "y"])
    paths = trie.sequences(lists(spark, sequences)).withColumn("sid", trie._at("path", "size"))
    distinct = paths.dropDuplicates(["sid"])
    nodes = trie.build(distinct)
    found = trie.located(distinct.select("sid", "size", "path", "sums"), nodes, 12)
    assert found.where("d <> size").count() == 0
    strange = lists(spark, {0: [("u", "never seen")], 1: []})
    away = trie.located(trie.sequences(strange), nodes, 12)
    assert [r.d for r in away.collect()] == [0, 0]


def test_two_fattest(spark):
    pairs = [(a, b) for a in range(20) for b in range(a + 1, 40)]
    rows = spark.createDataFrame(pairs, "a int, b int").withColumn("f", trie.fattest("a", "b")).collect()
    assert all(r.f == max(range(r.a + 1, r.b + 1), key=lambda x: x & -x) for r in rows)


def test_rebuilt_conversations(spark):
    rng = random.Random(4)
    rows = [(c, rng.choice([None, *range(20)]), rng.choice(["user", None]), rng.choice(["a", "b", None, ""]))
            for c in list(range(40)) + [103, 104] for _ in range(rng.randrange(1, 12))]
    rows += [(None, 1, "user", "x"), (7, 3, "user", "same"), (7, 3, "user", "same")]
    original = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            mark = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            original.setdefault(c, []).append(((turn is not None, turn or 0, mark), (role, text)))
    original = {c: [t for _, t in sorted(v)] for c, v in original.items()}
    want = {}
    for c, turns in original.items():
        h = zlib.crc32(str(c).encode()) % 9
        want[c] = original.get(c - c % 5, [])[:h] + turns[h:]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("c", "turns", "base", "head", "lent", "sid", "d"):
        table = table.withColumn(name, F.lit("clash"))
    assert got(trie.prefix_trie(trie.rebuilt(trie.turn_lists(table)))) == plain(want)


def test_hot_conversation_and_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "_CHUNK", 2)
    sequences = {i: [("u", "hello"), ("a", "x" * 50_000)] for i in range(50)} | {60: [("u", "hello")]}
    assert got(trie.prefix_trie(lists(spark, sequences))) == plain(sequences)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert trie.prefix_trie(trie.rebuilt(trie.turn_lists(empty))).collect() == []
