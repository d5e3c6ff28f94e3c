"""Set-similarity joins against brute force over all pairs."""

import random
from itertools import combinations

import numpy as np
import pytest

from nimbusgrid.llm import jaccard, lines
from nimbusgrid.llm.common import components


def corpus(seed, n=120, words=14):
    """Texts with exact copies, near copies and a passage that many share."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    passage = " ".join(f"p{i}" for i in range(12))
    texts = []
    for _ in range(n):
        kind = rng.random()
        if texts and kind < 0.25:
            texts.append(rng.choice(texts))
        elif texts and kind < 0.6:
            w = rng.choice(texts).split(" ")
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
            texts.append(" ".join(w))
        else:
            body = " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, words)))
            texts.append(body + "\n" + passage if rng.random() < 0.5 else body)
    return texts


def roots(nodes, edges):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def test_components_against_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 360)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    used = {x for a, b in edges if a != b for x in (a, b)}
    assert got == roots(used, [(a, b) for a, b in edges if a != b])


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([(1, 1), (None, 2)], "a long, b long")).count() == 0


def shingle_set(text, width):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


@pytest.mark.parametrize("width, percent, seed", [(3, 90, 1), (1, 60, 2), (2, 80, 3)])
def test_jaccard_join_against_all_pairs(spark, monkeypatch, width, percent, seed):
    monkeypatch.setattr(jaccard, "COMMON", 3)  # so that common shingles are moved here too
    texts = corpus(seed) + [None, "", " \t\n", "one", "One", "one two"]
    sets = {i: shingle_set(t, width) for i, t in enumerate(texts)}
    linked = [(a, b) for a, b in combinations(sets, 2)
              if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.id: (r.n_shingles, r.component_id) for r in jaccard.join(docs, width=width, percent=percent).collect()}
    want = roots(sets, linked)
    assert got == {i: (len(s), want[i]) for i, s in sets.items()}


def test_jaccard_join_edges(spark):
    rows = [(5, "a b c d", 1), (5, "a b c d", 2), (None, "a b c d", 3), (9, "A B C D", 4), (2, "x y z", 5), (5, "x y z", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rep long")  # a clashing name is not read
    got = sorted((r.id is None, r.id or 0, r.n_shingles, r.component_id) for r in jaccard.join(docs).collect())
    assert got == [(False, 2, 1, 2), (False, 5, 1, 2), (False, 5, 2, 2), (False, 5, 2, 2), (False, 9, 2, 2), (True, 0, 2, None)]
    assert jaccard.join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def longs(spark, values):
    return spark.createDataFrame([(v,) for v in values], "token long")


def test_first_shingles_are_told_by_flags_and_not_shuffled(spark):
    tokens = [5, 7, -1, 1 << 40, (1 << 62) + 9, -(1 << 50) - 3]
    asked = np.array(tokens + [6, 8, 1000], np.int64)
    assert jaccard._flagged(jaccard._flags(longs(spark, tokens)), asked).tolist() == [True] * 6 + [False] * 3
    reps = spark.createDataFrame([(1, 4, [1, 2, 3, 4], True)], "rep long, n long, low array<long>, whole boolean")
    parts = jaccard._ordered(reps, jaccard._flags(longs(spark, [2])), 90, jaccard._flags(longs(spark, [1, 2, 3])))
    assert "Exchange" not in parts._jdf.queryExecution().toString()
    r = parts.first()
    assert (r.rare, r.late, r.mixed, r.lead, r.own, r.rares, r.enough) == ([1, 3], [2], True, [1, 2, 3], 0.75, 3, True)


def test_pairs_that_cannot_share_enough_are_not_checked(spark):
    a, b, c = list(range(40)), [*range(8), *range(50, 82)], [*range(39), 90]
    parts = spark.createDataFrame([(i, 40, x[:12], [], x[:30], False) for i, x in enumerate((a, b, c), 1)],
                                  "rep long, n long, rare array<long>, late array<long>, low array<long>, whole boolean")
    pairs = spark.createDataFrame([(2, 1), (3, 1), (3, 2)], "a long, b long")
    assert [tuple(r) for r in jaccard._promising(pairs, parts, 90).collect()] == [(3, 1)]


def brute_lines(rows, percent=80):
    seen, out = [], set()
    for d, text in sorted((r for r in rows if r[0] is not None and r[1] is not None), key=lambda r: r[0]):
        for k, line in enumerate(text.split("\n")):
            words = frozenset(line.lower().replace("\t", " ").split(" ")) - {""}
            if not words:
                continue
            if any(words == s for s in seen):
                out.add((d, k, True))
            elif any(100 * len(words & s) >= percent * len(words | s) for s in seen):
                out.add((d, k, False))
            seen.append(words)
    return out


@pytest.mark.parametrize("seed", [11, 12])
def test_lines_against_all_pairs(spark, seed):
    rng = random.Random(seed)
    flat = corpus(seed, n=150, words=24)
    rows = [(i, "\n".join(rng.sample(flat, rng.randrange(1, 4)))) for i in range(60)]
    rows += [(70, None), (71, ""), (72, "\n \n\t"), (None, flat[0]), (73, "Solo  line\tHERE"), (74, "here solo LINE")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {tuple(r) for r in lines.repeated_lines(docs).select("doc_id", "line", "exact").collect()}
    assert got == brute_lines(rows)


def test_lines_removed_from_texts(spark):
    rows = [(1, "same words here\nother", 7), (2, "a b\nsame words here\nc d", 8), (3, None, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, line int")
    kept = lines.without_lines(docs, lines.repeated_lines(docs))
    assert kept.columns == docs.columns
    assert sorted(tuple(r) for r in kept.collect()) == [(1, "same words here\nother", 7), (2, "a b\nc d", 8), (3, None, 9)]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lines.repeated_lines(empty).count() == 0


def test_lines_plan_has_no_python(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    plan = lines.line_sets(docs, "doc_id", "text", lines.bands(docs, "text"), 80)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_near_lines_of_both_texts_of_a_repeated_id(spark):
    a, b = ([f"{c}{i}" for i in range(30)] for c in "ab")
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, " ".join(a[:-1] + ["x"])), (3, " ".join(b[:-1] + ["y"]))]
    got = lines.repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {tuple(r) for r in got} == {(2, 0, False), (3, 0, False)}


def test_words_of_a_line_are_hashed_once(spark):
    docs = spark.createDataFrame([(1, "a b c\n \t\nd")], "doc_id long, text string")
    sets = lines.line_sets(docs, "doc_id", "text", lines.bands(docs, "text"), 80)
    assert sorted((r.l, r.n) for r in sets.collect()) == [(0, 3), (2, 1)]
    assert sets._jdf.queryExecution().optimizedPlan().toString().count("array_distinct(") == 1


def test_small_families_are_settled_before_the_join(spark, monkeypatch):
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(words[:39] + [f"x{i}"])) for i in range(6)]
    left, written = {}, lines.keep

    def keep(df, label):
        out, path = written(df, label)
        left.setdefault(label, []).append(out.count())
        return out, path

    monkeypatch.setattr(lines, "keep", keep)
    got = lines.repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {tuple(r) for r in got} == {(i, 0, False) for i in range(1, 6)}
    assert left["pairs"] == [5, 0]  # every later line with the first, then none is left to meet the others
