"""Metrics of a scored frame (``y`` 0/1, ``score``): ranking, thresholds, calibration.

Everything starts from one table with a row per distinct score, so that a frame of any size is first
reduced by a partial aggregate; only distinct scores are ordered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cohortlens.functions.columns import ratio, ratio0, safe_corr
from cohortlens.operators.ordering import RANGE_ROWS, exact_quantiles, running_totals

METRIC_NAMES = (
    "threshold", "roc_auc", "pr_auc", "accuracy", "balanced_accuracy", "f1", "precision", "recall", "brier",
    "tn", "fp", "fn", "tp",
)


def score_curve(
    scored: DataFrame,
    y: str = "y",
    score: str = "score",
    by: Sequence[str] = (),
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Per distinct score: positives and negatives there (``pos, neg``) and at or above it (``tps, fps``)."""
    hit = F.col(y).cast("int")
    per_score = scored.groupBy(*by, F.col(score).cast("double").alias("score")).agg(
        F.sum(hit.cast("long")).alias("pos"),
        F.sum((1 - hit).cast("long")).alias("neg"),
        F.sum((F.col(score) - hit) * (F.col(score) - hit)).alias("sq"),
    )
    run = running_totals(
        per_score, "score", ["pos", "neg"], by=by, descending=True, range_rows=range_rows
    )
    return run.withColumnsRenamed({"cum_pos": "tps", "cum_neg": "fps"})


def _auc() -> Column:
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    area = F.sum(neg * (F.col("tps") - F.col("pos")) + neg * pos / 2)
    return F.try_divide(area, F.sum(pos) * F.sum(neg))


def _average_precision() -> Column:
    pos = F.col("pos").cast("double")
    return F.try_divide(F.sum(pos * F.col("tps") / (F.col("tps") + F.col("fps"))), F.sum(pos))


def _from_cells(tn: Column, fp: Column, fn: Column, tp: Column) -> dict[str, Column]:
    recall, precision = ratio0(tp, tp + fn), ratio0(tp, tp + fp)
    # a class that does not occur is left out of the balanced mean
    both = F.array_compact(F.array(ratio(tp, tp + fn), ratio(tn, tn + fp)))
    mean = F.try_divide(F.aggregate(both, F.lit(0.0), lambda a, x: a + x), F.size(both).cast("double"))
    return {
        "accuracy": ratio(tp + tn, tp + tn + fp + fn),
        "balanced_accuracy": mean,
        "f1": ratio0(2 * tp, 2 * tp + fp + fn),
        "precision": precision,
        "recall": recall,
    }


def _as_column(threshold: float | Column) -> Column:
    return threshold if isinstance(threshold, Column) else F.lit(float(threshold))


def _with_threshold(df: DataFrame, threshold: float | Column) -> DataFrame:
    """The threshold as a column: one picked by a subquery over model scores may not stand in an aggregate."""
    return df.withColumn("_t", _as_column(threshold).cast("double"))


def metrics_from_curve(
    curve: DataFrame, threshold: float | Column = 0.5, prefix: str = "", by: Sequence[str] = ()
) -> DataFrame:
    """One row of metrics (per ``by``) from the curve table."""
    above = F.col("score") >= F.col("_t")
    zero = F.lit(0).cast("long")
    cells = _with_threshold(curve, threshold).groupBy(*by).agg(
        F.max("_t").alias("threshold"),
        _auc().alias("roc_auc"),
        _average_precision().alias("pr_auc"),
        F.try_divide(F.sum("sq"), F.sum(F.col("pos") + F.col("neg")).cast("double")).alias("brier"),
        F.coalesce(F.sum(F.when(~above, F.col("neg"))), zero).alias("tn"),
        F.coalesce(F.sum(F.when(above, F.col("neg"))), zero).alias("fp"),
        F.coalesce(F.sum(F.when(~above, F.col("pos"))), zero).alias("fn"),
        F.coalesce(F.sum(F.when(above, F.col("pos"))), zero).alias("tp"),
    )
    rates = _from_cells(*[F.col(c) for c in ("tn", "fp", "fn", "tp")])
    full = cells.withColumns(rates)
    return full.select(*by, *[F.col(n).alias(prefix + n) for n in METRIC_NAMES])


def classification_metrics(
    scored: DataFrame, threshold: float | Column = 0.5, prefix: str = "", by: Sequence[str] = (), **curve_args
) -> DataFrame:
    return metrics_from_curve(score_curve(scored, by=by, **curve_args), threshold, prefix, by)


def confusion(scored: DataFrame, threshold: float | Column = 0.5) -> DataFrame:
    """One row with the four cells; empty cells are 0. No ordering is needed here."""
    hit, above = F.col("y").cast("int") == 1, F.col("score") >= F.col("_t")
    return _with_threshold(scored, threshold).agg(
        F.count_if(~hit & ~above).alias("tn"),
        F.count_if(~hit & above).alias("fp"),
        F.count_if(hit & ~above).alias("fn"),
        F.count_if(hit & above).alias("tp"),
    )


def threshold_metrics(scored: DataFrame, threshold: float | Column = 0.5) -> DataFrame:
    cells = confusion(scored, threshold)
    return cells.withColumns(_from_cells(*[F.col(c) for c in ("tn", "fp", "fn", "tp")]))


def roc_auc(scored: DataFrame, by: Sequence[str] = (), **curve_args) -> DataFrame:
    return score_curve(scored, by=by, **curve_args).groupBy(*by).agg(_auc().alias("roc_auc"))


def average_precision(scored: DataFrame, by: Sequence[str] = (), **curve_args) -> DataFrame:
    return score_curve(scored, by=by, **curve_args).groupBy(*by).agg(_average_precision().alias("pr_auc"))


def brier(scored: DataFrame) -> DataFrame:
    gap = F.col("score").cast("double") - F.col("y").cast("int")
    return scored.agg(F.avg(gap * gap).alias("brier"))


def _points(curve: DataFrame) -> DataFrame:
    # whole-number totals: the same in every evaluation
    total = curve.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n"))).scalar()
    return curve.withColumn("_p", total["p"]).withColumn("_n", total["n"])


def precision_recall_curve(curve: DataFrame) -> DataFrame:
    """``threshold, precision, recall`` per distinct score, and the closing point (1, 0) without a threshold."""
    points = _points(curve).select(
        F.col("score").alias("threshold"),
        ratio(F.col("tps"), F.col("tps") + F.col("fps")).alias("precision"),
        F.coalesce(ratio(F.col("tps"), F.col("_p")), F.lit(1.0)).alias("recall"),
    )
    end = curve.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return points.unionByName(end)


def roc_curve(curve: DataFrame) -> DataFrame:
    """``threshold, fpr, tpr`` per distinct score, and the origin without a threshold."""
    points = _points(curve).select(
        F.col("score").alias("threshold"),
        ratio(F.col("fps"), F.col("_n")).alias("fpr"),
        ratio(F.col("tps"), F.col("_p")).alias("tpr"),
    )
    origin = curve.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(origin)


def recall_threshold(curve: DataFrame, min_precision: float = 0.5) -> DataFrame:
    """One row ``threshold``: most recall with enough precision, else best F1, else 0.5; lowest on ties."""
    points = precision_recall_curve(curve).where("threshold is not null")
    low_first = -F.col("threshold")
    f1 = 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + F.lit(1e-12))
    enough = F.max(
        F.when(F.col("precision") >= F.lit(float(min_precision)), F.struct(F.col("recall").alias("a"), low_first.alias("b")))
    )
    best = F.max(F.struct(f1.alias("a"), low_first.alias("b")))
    return points.agg(F.coalesce(-enough["b"], -best["b"], F.lit(0.5)).alias("threshold"))


def two_threshold_metrics(
    scored: DataFrame, min_precision: float = 0.62, by_frame: DataFrame | None = None, **curve_args
) -> DataFrame:
    """Metrics at 0.5 and, prefixed, at the recall-oriented threshold, in one row.

    ``by_frame`` lets the caller choose the threshold on other rows than the ones it is reported on.
    """
    curve = score_curve(scored, **curve_args)
    picked = recall_threshold(curve if by_frame is None else score_curve(by_frame, **curve_args), min_precision).scalar()
    base = metrics_from_curve(curve, 0.5).select(F.struct(*METRIC_NAMES).alias("m")).scalar()
    high = metrics_from_curve(curve, picked, "recall_oriented_")
    return high.select(*[base[n].alias(n) for n in METRIC_NAMES], *high.columns)


def class_report(scored: DataFrame, threshold: float = 0.5, digits: int = 3) -> DataFrame:
    """Precision, recall, F1 and support per class, then macro and weighted averages."""
    c = {n: F.col(n) for n in ("tn", "fp", "fn", "tp")}

    def line(label: str, tp: Column, fp: Column, fn: Column) -> Column:
        return F.struct(
            F.lit(label).alias("label"),
            ratio0(tp, tp + fp).alias("precision"),
            ratio0(tp, tp + fn).alias("recall"),
            ratio0(2 * tp, 2 * tp + fp + fn).alias("f1"),
            (tp + fn).alias("support"),
        )

    rows = confusion(scored, threshold).select(
        line("0", c["tn"], c["fn"], c["fp"]).alias("a"), line("1", c["tp"], c["fp"], c["fn"]).alias("b")
    )
    n = F.col("a.support") + F.col("b.support")

    def mean(label: str, weigh) -> Column:
        names = ("precision", "recall", "f1")
        return F.struct(F.lit(label).alias("label"), *[weigh(m).alias(m) for m in names], n.alias("support"))

    macro = mean("macro avg", lambda m: (F.col(f"a.{m}") + F.col(f"b.{m}")) / 2)
    weighted = mean(
        "weighted avg",
        lambda m: ratio0(F.col(f"a.{m}") * F.col("a.support") + F.col(f"b.{m}") * F.col("b.support"), n),
    )
    out = rows.select(F.inline(F.array(F.col("a"), F.col("b"), macro, weighted)))
    return out.select("label", *[F.bround(m, digits).alias(m) for m in ("precision", "recall", "f1")], "support")


def calibration(scored: DataFrame, bins: int = 10, **args) -> DataFrame:
    """``bin, n, mean_score, positive_share`` over quantile bins; bins without rows do not appear."""
    inner = [i / bins for i in range(1, bins)]
    edges = exact_quantiles(scored.select("score"), ["score"], inner, **args)
    cut = edges.agg(
        F.transform(F.sort_array(F.collect_list(F.struct("prob", "value"))), lambda e: e["value"])
    ).scalar()  # bins - 1 numbers
    bin_no = sum(((F.element_at(cut, i) < F.col("score")).cast("int") for i in range(1, bins)), F.lit(0))
    # one row per distinct score is enough to find the bin
    per_score = scored.groupBy("score").agg(F.count("*").alias("n"), F.sum(F.col("y").cast("long")).alias("pos"))
    return (
        per_score.groupBy(bin_no.alias("bin"))
        .agg(F.sum("n").alias("n"), F.sum(F.col("score") * F.col("n")).alias("_s"), F.sum("pos").alias("_p"))
        .select("bin", "n", (F.col("_s") / F.col("n")).alias("mean_score"), (F.col("_p") / F.col("n")).alias("positive_share"))
    )


def model_comparison(scored: DataFrame, model: str = "model", **curve_args) -> DataFrame:
    """One metric row per model in a long scored frame, best ROC AUC first."""
    return classification_metrics(scored, by=[model], **curve_args).orderBy(F.desc_nulls_last("roc_auc"), model)


def group_agreement(risk: DataFrame) -> DataFrame:
    """Correlation of predicted and observed group rates, and how many groups miss each goal."""
    flags = [c for c in risk.columns if c.startswith("misses_")]
    return risk.agg(
        F.count("*").alias("n_groups"),
        safe_corr(F.col("predicted_rate"), F.col("observed_rate")).alias("r"),
        *[F.count_if(F.col(c)).alias(f"n_{c}") for c in flags],
    )
