"""Personal data and secrets against the patterns as written, and what the models add."""

import re
import time

import numpy as np
import pytest

from nimbusgrid.llm import pii, secrets

PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
       "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
SECRETS = {"assign": r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
           "access": r"AKIA[A-Z0-9]+", "hex": r"[0-9a-f]+"}


def plain_pii(text):
    def holds(kind, s):
        d = re.sub("[^0-9]", "", s)
        if kind == "ip":
            return all(int(p) <= 255 for p in s.split("."))
        if kind == "card":
            doubled = [int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))]
            return 13 <= len(d) <= 19 and sum(doubled) % 10 == 0
        return kind == "email" or 9 <= len(d) <= 15
    return [(k, m.start(), m.end()) for k, p in PII.items() for m in re.finditer(p, text) if holds(k, m[0])]


def plain_secrets(text):
    def holds(kind, m):
        return len(m[2]) >= 6 if kind == "assign" else len(m[0]) >= (20 if kind == "access" else 24)
    found = [(k, m.start(), m.end()) for k, p in SECRETS.items() for m in re.finditer(p, text) if holds(k, m)]
    return sorted(found, key=lambda f: (f[1], list(SECRETS).index(f[0])))


def noise(seed, alphabet, n, length):
    rng = np.random.default_rng(seed)
    return ["".join(rng.choice(list(alphabet), rng.integers(0, length))) for _ in range(n)]


@pytest.mark.parametrize("alphabet", ["a1.@-", "0123456789 -+().", "45.6 ", "+1 2()-é@x.y%", "@.a@"])
def test_base_pii_is_what_the_patterns_say(alphabet):
    for text in noise(1, alphabet, 1500, 40) + ["4539 1488 0343 6467", "1.2.3.4.5.6.7.8", "a@b@c.d.e", "+1 (555) 123-4567x"]:
        assert pii.base_spans(text) == plain_pii(text), text


@pytest.mark.parametrize("alphabet", ["0af", "AKI0Z9 ", "=: 'x9\"", "fg0"])
def test_base_secrets_are_what_the_patterns_say(alphabet):
    words = ["password", "PassWd", "token", "api_key", "APIKEY", "secret", "AKIA"]
    for i, text in enumerate(noise(2, alphabet, 1500, 60)):
        text = words[i % 7] + text + words[i % 5] + " = 'abcdef12'" * (i % 2)
        assert secrets.base_spans(text) == plain_secrets(text), text


@pytest.mark.parametrize("text", ["a" * 300_000, "1" * 300_000, "1." * 150_000, "@" * 100_000, "a@" * 100_000, "+1 " * 100_000,
                                  "token" * 60_000, "password " + " " * 200_000, "x1" * 150_000, "- " * 100_000])
def test_long_runs_take_no_quadratic_time(text):
    began = time.perf_counter()
    pii.base_spans(text)
    list(pii.islands(text))
    secrets.base_spans(text)
    list(secrets.candidates(text))
    assert time.perf_counter() - began < 10


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(5)
    out = []
    for i in range(300):
        n = "".join(map(str, rng.integers(0, 10, 7)))
        digits = "4" + "".join(map(str, rng.integers(0, 10, 14)))
        check = next(c for c in "0123456789" if pii.luhn(digits + c))
        hexa = "".join(rng.choice(list("0123456789abcdef"), 32))
        out.append(f"word other name.{i}@mail.example.com then +1 (555) {n[:3]}-{n[3:]} and {i} items, card {digits + check} from "
                   f"10.0.{i % 256}.{n[0]} on 2024-01-{i % 28 + 1:02d} token = {hexa} longishordinaryword")
    return out


def test_field_scores_whole_spans_and_adds_to_the_patterns(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    field = pii.train(docs)
    for text in texts[:40]:
        runs = [(run, pii.lattice(text, run)) for run in pii.islands(text)]
        decoded = {(pii.KINDS[k], run[i][0], run[j][1]) for run, seg in runs if seg for i, j, k in pii.decode(field, seg, len(run))}
        assert decoded == set(pii.base_spans(text))  # the learned field agrees where the patterns are right
    spans = pii.spans_of("call 555-867-5309 now", field)
    assert [s[0] for s in spans] == ["phone"] and not spans[0][3]
    assert pii.spans_of("on 2024-01-02 we had 12 items and 3.5 more", field) == []


def test_pii_rows(spark, texts):
    field = pii.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    rows = [(1, None, "x"), (2, "", "x"), (None, "a@b.co", "x"), (1, "a@b.co", "y")]
    got = pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string, spans string"), field)
    assert got.columns == ["doc_id", "spans"]
    assert sorted(((r.doc_id or 0), [tuple(s) for s in r.spans]) for r in got.collect()) == [
        (0, [("email", 0, 6, True)]), (1, []), (1, [("email", 0, 6, True)]), (2, [])]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pii.find_pii(empty, pii.train(empty)).count() == 0


def test_network_finds_secrets_like_the_labelled_ones(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    network = secrets.train(docs)
    assert network.threshold >= secrets.FLOOR
    rows = [(1, None), (2, ""), (3, "nothing token here = no"), (4, texts[0]), (4, texts[0])]
    got = sorted((r.doc_id, [tuple(s) for s in r.spans if s.base]) for r in secrets.find_secrets(
        spark.createDataFrame(rows, "doc_id long, text string"), network).collect())
    assert got[0] == (1, []) and got[1] == (2, []) and got[3] == got[4]
    assert got[3][1] == [(*f, True) for f in secrets.base_spans(texts[0])]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert secrets.find_secrets(empty, secrets.train(empty)).count() == 0


def test_network_learns_from_all_candidates(spark, texts):
    rng = np.random.default_rng(8)
    runs = ["".join(rng.choice(list("0123456789abcdef" if i % 2 else "ghijklmnopqrstuvwxyz"), 30)) for i in range(14000)]
    docs = spark.createDataFrame([(" ".join(runs[i:i + 10]),) for i in range(0, len(runs), 10)] * 10 + [(t,) for t in texts], "text string")
    network = secrets.train(docs)
    assert network.used + network.held >= len(runs) + len(texts) and network.held > len(runs) / 4
    assert network.recall >= secrets.RECALL and network.precision > 0.9
    again = secrets.train(docs)
    assert np.array_equal(again.filters, network.filters) and abs(again.threshold - network.threshold) < 1e-9


def test_threshold_is_the_score_at_a_rank(spark):
    scores = sorted([0.0, 1.0, 0.5, 0.5, 0.25, 1e-9] + np.random.default_rng(3).random(200).tolist())
    frame = spark.createDataFrame([(x,) for x in scores], "score double")
    for rank in (0, 1, 3, 100, 205):
        assert 0 <= scores[rank] - secrets._ranked(frame, rank) < 1e-10


def test_network_margin_is_a_convolution():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, secrets._CODES, (3, secrets.WINDOW))
    net = secrets.Network(rng.normal(size=(5, secrets._CODES, 4)), rng.normal(size=4), rng.normal(size=4), 0.5)
    for row, margin in zip(codes, net.margin(codes)):
        maps = [sum(net.filters[k][row[i + k]] for k in range(5)) + net.bias for i in range(secrets.WINDOW - 4)]
        assert np.isclose(np.maximum(np.max(maps, 0), 0) @ net.dense + 0.5, margin)


def test_long_candidates_have_windows_over_their_whole_length():
    cut = secrets.windows("key " + "a1" * 100, 4, 204)
    assert len(cut) == 5 and all(len(w) == secrets.WINDOW for w in cut)


def test_threshold_keeps_the_recall_where_classes_overlap():
    rng = np.random.default_rng(4)
    labels = (rng.random(900) < 0.5).astype(float)
    codes = np.where(rng.random((900, secrets.WINDOW)) < 0.06 + 0.08 * labels[:, None], 40, rng.integers(1, 30, (900, secrets.WINDOW)))
    network = secrets.fit(codes, labels)
    held = np.random.default_rng(7).permutation(900)[::3]
    over = network.score(codes[held]) >= network.threshold
    assert network.recall >= secrets.RECALL and over[labels[held] > 0].mean() >= secrets.RECALL
    assert np.isclose(network.precision, labels[held][over].mean())


def test_candidates_without_digits_and_short_ones_near_context():
    found = lambda text: [text[s:e] for s, e in secrets.candidates(text)]
    assert found("key QwErTyUiOpAsDfGhJk, 1234567890123456 and abc-def-ghi-jkl-mno") == [
        "QwErTyUiOpAsDfGhJk", "1234567890123456", "abc-def-ghi-jkl-mno"]
    assert found("the passwd is hunter2xyz99 today") == ["hunter2xyz99"]
    assert found("ordinary hunter2xyz99 words ================") == []
