import math
import random

import pytest

from wordloom.operators import scoring as SC


def loop_scores(x, rows, threshold=0.25):
    """Brute-force reading of the pivot scoring: scan classes 1..K-1 keeping a running maximum
    margin (start 0); class 0 scores 0; divide classes 0..K-2 by the sum; reject option."""
    k = len(rows)
    best, run = 0, 0.0
    raw = [0.0] * k
    for c in range(1, k):
        m = sum(a * b for a, b in zip(x, rows[c]))
        if m > run:
            run, best = m, c
        raw[c] = 1.0 / (1.0 + math.exp(-(m - run)))
    s = sum(raw)
    sc = [raw[c] / s if c < k - 1 else raw[c] for c in range(k)]
    final = best if (max(sc) == sc[best] and sc[best] > threshold) else 0
    return best, sc, final


def test_legacy_scores_match_loop(spark):
    rnd = random.Random(11)
    k, dim = 6, 5
    rows = [[rnd.uniform(-1, 1) for _ in range(dim)] for _ in range(k)]
    xs = [[rnd.uniform(-2, 2) for _ in range(dim)] for _ in range(300)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "id int, f array<double>")
    got = {r["id"]: r for r in SC.legacy_scores(df, rows, "f").collect()}
    for i, x in enumerate(xs):
        best, sc, final = loop_scores(x, rows)
        r = got[i]
        assert r["prediction"] == best and r["final"] == final
        assert r["scores"] == pytest.approx(sc)
        assert r["scores"][0] == 0.0


def test_softmax_sums_to_one(spark):
    rows = [[1.0, 0.0], [0.0, 1.0], [0.5, 0.5]]
    df = spark.createDataFrame([([2.0, 1.0],), ([0.0, 3.0],)], "f array<double>")
    out = SC.softmax_scores(df, rows, "f").collect()
    for r in out:
        assert sum(r["probs"]) == pytest.approx(1.0)
    assert [r["prediction"] for r in out] == [0.0, 1.0]


def test_linear_model_checks_classes(spark):
    bad = spark.createDataFrame([(1, [1.0]), (2, [2.0])], "class int, weights array<double>")
    with pytest.raises(ValueError):
        SC.linear_model(bad)


@pytest.mark.parametrize("k", [1, 2, 3, 5, 8, 9, 33])
def test_scores_in_row_and_in_blocks(spark, monkeypatch, k):
    """Any number of classes, ties of margins, null features, repeated rows; the model as a literal and as a table in blocks."""
    rnd = random.Random(k)
    rows = [[float(rnd.randint(-2, 2)) for _ in range(3)] for _ in range(k)]
    xs = [[float(rnd.randint(-2, 2)) for _ in range(3)] for _ in range(60)]
    df = spark.createDataFrame([*enumerate(xs), (0, xs[0]), (99, None)], "id int, f array<double>")
    model = spark.createDataFrame(list(enumerate(rows)), "class int, weights array<double>")
    literal = SC.linear_model(model)
    assert literal == rows
    monkeypatch.setattr(SC, "IN_ROW_VALUES", 0)
    monkeypatch.setattr(SC, "BLOCK_VALUES", 7)
    blocks = SC.linear_model(model)
    assert blocks.n_classes == k and blocks.n_blocks == -(-k // 2)
    for scores in (SC.legacy_scores, SC.softmax_scores):
        a, b = (sorted(map(repr, scores(df, m, "f").collect())) for m in (literal, blocks))
        assert a == b and len(a) == 62
    for r in SC.legacy_scores(df, blocks, "f").where("f is not null").collect():
        best, sc, final = loop_scores(r["f"], rows) if k > 1 else (0, [0.0], 0)
        assert (r["prediction"], r["final"]) == (best, final) and r["scores"] == pytest.approx(sc)


def test_scores_of_twenty_thousand_classes(spark):
    rnd = random.Random(2)
    rows = [[rnd.uniform(-1, 1) for _ in range(4)] for _ in range(20_000)]
    xs = [[rnd.uniform(-2, 2) for _ in range(4)] for _ in range(6)]
    df = spark.createDataFrame(list(enumerate(xs)), "id int, f array<double>")
    for r in SC.legacy_scores(df, rows, "f").collect():
        best, sc, final = loop_scores(xs[r["id"]], rows)
        assert (r["prediction"], r["final"]) == (best, final)
        assert r["scores"] == pytest.approx(sc)
