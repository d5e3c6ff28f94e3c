"""The Merkle manifest against trees built in plain Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from nimbusgrid.llm import manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, altered=False):
    d, text, lang, source, n = row
    if altered and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return h(*map(field, (d, source, lang, n, text)))


def climb(nodes):
    """The top of ``nodes`` and every node's siblings on the way, as (left, right)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, i in zip(paths, range(len(paths))):
            run = at[i] // 8 * 8
            path.append(("".join(nodes[run:at[i]]), "".join(nodes[at[i] + 1:run + 8])))
            at[i] //= 8
        nodes = [h(*nodes[i:i + 8]) for i in range(0, len(nodes), 8)]
    return nodes[0], paths


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    built = []
    for g in order:
        members = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        built.append((members, *climb([leaf(r) for r in members])))
    root, above = climb([top for _, top, _ in built])
    out = []
    for (members, top, paths), upper in zip(built, above):
        for row, path in zip(members, paths):
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            now = leaf(row, hit)
            for left, right in path + upper:
                now = h(left, now, right)
            out.append((row[0], leaf(row), top, root, h(*[x for s in path + upper for x in s]), now, now == root))
    return sorted(out, key=str)


def run(spark, rows, **columns):
    docs = spark.createDataFrame(rows, SCHEMA)
    for name, value in columns.items():
        docs = docs.withColumn(name, value)
    made = manifest.build(docs)
    got = manifest.proofs(made).select(
        "id", "leaf", "subroot", F.lit(made.root).alias("root"), manifest.proof_digest(F.col("path")).alias("proof"),
        manifest.folded(F.coalesce("altered", "leaf"), F.col("path")).alias("folded"))
    return sorted((tuple(r) + (r.folded == r.root,) for r in got.collect()), key=str)


def documents(seed, n, ids):
    rng = random.Random(seed)
    langs = ["en", "de", "é", "", None, "a lone one"]
    return [(ids(i, rng), rng.choice(["Some Text", "plain", "ÄÖ Ü", "", None, "x" * 300]) if rng.random() < 0.5 else f"Doc {i}",
             langs[5] if i == 0 else rng.choice(langs[:5]), rng.choice(["web", None]), rng.choice([None, i])) for i in range(n)]


@pytest.mark.parametrize("ids", [
    lambda i, rng: i, lambda i, rng: rng.randrange(-2**63, 2**63), lambda i, rng: rng.choice([None, 7, 7, -64, i, i // 2])],
    ids=["dense", "sparse", "repeated"])
def test_against_plain_trees(spark, ids):
    rows = documents(5, 300, ids)
    assert run(spark, rows) == brute(rows)


def test_equal_rows_and_clashing_names(spark, monkeypatch):
    monkeypatch.setattr(manifest, "_COPIES", 4)
    rows = [(3, "Same", "en", "s", 1)] * 30 + [(3, "Other", "en", "s", 1), (2, "A", "en", "s", 1), (None, None, None, None, None)] * 2
    extra = {c: F.lit("z") for c in ("g", "id", "leaf", "altered", "m", "at", "n", "path", "slots", "run", "one", "rank", "word", "bit")}
    assert run(spark, rows, **extra) == brute(rows)


def test_small_tables(spark):
    assert run(spark, []) == []
    for n in (1, 2, 8, 9, 65):
        rows = [(i, f"T{i}", "en", None, i) for i in range(n)]
        assert run(spark, rows) == brute(rows)


def test_long_text(spark):
    rows = [(1, "Long Words " * 200_000, "en", "s", 1), (2, "b", "en", "s", 2)]
    assert run(spark, rows) == brute(rows)


def test_positions_over_several_directory_levels(spark):
    ids = [0, 1, 63, 64, 1 << 16, (1 << 16) + 5, 1 << 30, 1 << 45, -1, -(1 << 40)]
    rows = spark.createDataFrame([("g", i, 1) for i in ids], "g string, id long, m long")
    got = {r.id: r.at for r in manifest.ranked(rows, "g", "id", "at").collect()}
    assert got == {i: k for k, i in enumerate(sorted(ids))}
