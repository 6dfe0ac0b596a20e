import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import metrics as m

TIES = [(1, 1, 0.9), (2, 0, 0.9), (3, 1, 0.8), (4, 0, 0.5), (5, 1, 0.5), (6, 0, 0.5), (7, 0, 0.2), (8, 1, 0.1)]


@pytest.fixture(scope="module")
def ties(spark):
    return spark.createDataFrame(TIES, "row_id int, y int, score double")


def brute_auc(data):
    pos = [s for _, y, s in data if y == 1]
    neg = [s for _, y, s in data if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def brute_ap(data):
    total, out = sum(y for _, y, _ in data), 0.0
    before = 0
    for t in sorted({s for *_, s in data}, reverse=True):
        tp = sum(y for _, y, s in data if s >= t)
        n = sum(1 for *_, s in data if s >= t)
        out += (tp - before) / total * tp / n
        before = tp
    return out


@pytest.mark.parametrize("range_rows", [10**6, 7])
def test_auc_and_average_precision_with_ties(ties, range_rows):
    got = m.classification_metrics(ties, range_rows=range_rows).first()
    assert got["roc_auc"] == pytest.approx(brute_auc(TIES))
    assert got["pr_auc"] == pytest.approx(brute_ap(TIES))
    assert got["brier"] == pytest.approx(np.mean([(s - y) ** 2 for _, y, s in TIES]))


def test_auc_of_reversed_scores(ties):
    other = ties.withColumn("score", 1 - F.col("score"))
    assert m.roc_auc(other).first()[0] == pytest.approx(1 - brute_auc(TIES))


def test_threshold_is_inclusive_and_cells_add_up(ties):
    c = m.confusion(ties, 0.5).first()
    assert (c["tn"], c["fp"], c["fn"], c["tp"]) == (1, 3, 1, 3)
    assert sum(c) == len(TIES)
    assert m.classification_metrics(ties, 0.5, "a_").first()["a_tp"] == 3


def test_one_class_gives_no_auc_and_no_division_error(spark):
    df = spark.createDataFrame([(1, 0, 0.1), (2, 0, 0.7)], "row_id int, y int, score double")
    got = m.classification_metrics(df).first()
    assert got["roc_auc"] is None and got["pr_auc"] is None
    assert got["recall"] == 0.0 and got["precision"] == 0.0 and got["f1"] == 0.0
    assert got["balanced_accuracy"] == 0.5
    assert m.classification_metrics(df, 0.9).first()["precision"] == 0.0


def test_published_cells_give_the_published_rates(spark):
    cells = spark.createDataFrame([(13034, 9844, 8594, 17885)], "tn long, fp long, fn long, tp long")
    got = cells.withColumns(m._from_cells(*[F.col(c) for c in ("tn", "fp", "fn", "tp")])).first()
    assert got["accuracy"] == pytest.approx(0.6264359665, abs=1e-10)
    assert got["f1"] == pytest.approx(0.6598657025, abs=1e-10)
    assert got["balanced_accuracy"] == pytest.approx(0.6225792740, abs=1e-10)


def test_recall_threshold_prefers_recall_then_the_lowest_threshold(spark, ties):
    curve = m.score_curve(ties)
    # precision at 0.9: 1/2, 0.8: 2/3, 0.5: 3/6, 0.2: 3/7, 0.1: 4/8
    assert m.recall_threshold(curve, 0.5).first()[0] == 0.1
    assert m.recall_threshold(curve, 0.6).first()[0] == 0.8
    # nothing is precise enough: the best F1
    assert m.recall_threshold(curve, 0.99).first()[0] == 0.1
    empty = m.score_curve(spark.createDataFrame([], "row_id int, y int, score double"))
    assert m.recall_threshold(empty, 0.5).first()[0] == 0.5


def test_curves_close_at_their_ends(ties):
    curve = m.score_curve(ties)
    roc = [tuple(r) for r in m.roc_curve(curve).collect()]
    assert (None, 0.0, 0.0) in roc and (0.1, 1.0, 1.0) in roc
    pr = [tuple(r) for r in m.precision_recall_curve(curve).collect()]
    assert (None, 1.0, 0.0) in pr and (0.1, 0.5, 1.0) in pr


def test_calibration_bins_follow_quantiles(spark):
    values = np.random.default_rng(5).beta(2, 5, 400).round(2)
    ys = (np.random.default_rng(6).random(400) < values).astype(int)
    df = spark.createDataFrame([(int(y), float(s)) for y, s in zip(ys, values)], "y int, score double")
    edges = np.quantile(values, np.linspace(0.1, 0.9, 9))
    place = np.searchsorted(edges, values)
    got = {r["bin"]: r for r in m.calibration(df, range_rows=7).collect()}
    assert set(got) == set(place)
    for b in set(place):
        assert got[b]["n"] == (place == b).sum()
        assert got[b]["mean_score"] == pytest.approx(values[place == b].mean())
        assert got[b]["positive_share"] == pytest.approx(ys[place == b].mean())


def test_report_and_two_thresholds(ties):
    lines = {r["label"]: r for r in m.class_report(ties).collect()}
    assert lines["1"]["support"] == 4 and lines["macro avg"]["support"] == 8
    both = m.two_threshold_metrics(ties, 0.6).first()
    assert both["threshold"] == 0.5 and both["recall_oriented_threshold"] == 0.8
    other = ties.withColumn("score", F.lit(0.9))
    assert m.two_threshold_metrics(ties, 0.1, by_frame=other).first()["recall_oriented_threshold"] == 0.9
