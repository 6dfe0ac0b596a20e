"""Candidate classifiers: search over parameters with grouped folds, scoring, choice of the champion."""

from __future__ import annotations

import hashlib
import itertools
import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from statistics import fmean, pstdev

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from cohortlens.functions.columns import ratio
from cohortlens.functions.seeded import given, lowest_mask
from cohortlens.operators.frame import Roles, min_max_score
from cohortlens.operators.metrics import roc_auc
from cohortlens.operators.pairs import vote
from cohortlens.operators.pivots import nearest
from cohortlens.operators.prep import feature_names, fit_prep
from cohortlens.operators.pruning import pruned
from cohortlens.operators.splits import check_folds, with_folds
from cohortlens.session import PARTITION_ROWS, shared_folder, spread, written
from cohortlens.worklist import Worklist, data_fingerprint, fingerprint

SEED = 42
FOLDS = 5
DRAWS = 8
LOGISTIC_ROWS = 1 << 19  # rows of a partition of a logistic fit: each pass over them sends the driver a result from every partition
LEVELS_KEPT = 9  # forests up to this depth keep each row's nodes, instead of going down all trees again for each level; the trees are the same
DEEPEST = 30  # the deepest tree Spark grows; stands for "no limit"

# The parameter spaces that are searched.
SPACES: dict[str, dict[str, list]] = {
    "logistic": {"C": [10 ** (-2 + 4 * i / 11) for i in range(12)], "class_weight": [None, "balanced"]},
    "tree": {
        "max_depth": [4, 6, 8, 12, None],
        "min_samples_leaf": [20, 50, 100, 200],
        "ccp_alpha": [0.0, 2e-5, 2e-4, 2e-3],
    },
    "random_forest": {
        "n_trees": [50, 80],
        "max_depth": [8, 12, 16, None],
        "min_samples_leaf": [10, 30, 80],
        "max_features": ["sqrt", "0.5"],
        "class_weight": [None, "balanced"],
    },
    "knn": {"k": [5, 11, 21, 31], "weights": ["uniform", "distance"], "metric": ["euclidean", "manhattan"]},
}
CANDIDATES = ("dummy", "logistic", "tree", "random_forest", "knn")
DEFAULTS: dict[str, dict] = {
    "dummy": {},
    "logistic": {"C": 1.0, "class_weight": None},
    "tree": {"max_depth": None, "min_samples_leaf": 1, "ccp_alpha": 0.0},
    "random_forest": {"n_trees": 80, "max_depth": None, "min_samples_leaf": 1, "max_features": "sqrt", "class_weight": None},
    "knn": {"k": 15, "weights": "uniform", "metric": "euclidean"},
}


@dataclass
class KnnModel:
    """Prepared training rows and the rule to vote by."""

    prep: PipelineModel
    base: DataFrame
    params: dict
    row_key: str = "row_id"

    def neighbors(self, df: DataFrame) -> DataFrame:
        queries = self.prep.transform(df).select(F.col(self.row_key).alias("id"), vector_to_array("features").alias("v"))
        return nearest(queries, self.base, self.params["k"], self.params["metric"])

    def score(self, df: DataFrame) -> DataFrame:
        found = vote(self.neighbors(df), self.params["k"], self.params["weights"])
        return df.join(found.withColumnRenamed("id", self.row_key), self.row_key, "left")

    def save(self, path: str) -> str:
        self.prep.write().overwrite().save(f"{path}/prep")
        self.base.write.mode("overwrite").parquet(f"{path}/base")
        facts = [(json.dumps(self.params), self.row_key)]
        self.base.sparkSession.createDataFrame(facts, "params string, row_key string").write.mode("overwrite").json(f"{path}/rule")
        return path

    @staticmethod
    def load(spark: SparkSession, path: str) -> KnnModel:
        rule = spark.read.json(f"{path}/rule").first()
        return KnnModel(PipelineModel.load(f"{path}/prep"), spark.read.parquet(f"{path}/base"), json.loads(rule["params"]), rule["row_key"])


@dataclass
class Candidate:
    name: str
    model: PipelineModel | KnnModel
    best_params: dict = field(default_factory=dict)
    cv_roc_auc: float | None = None
    cv_std: float | None = None
    n_train: int = 0
    fold_scores: list[tuple[str, int, float]] = field(default_factory=list)


# ---------------------------------------------------------------- fitting


def class_weight_table(df: DataFrame, target: str = "y") -> DataFrame:
    """``y, n, weight`` with weight = rows / (classes x rows of the class)."""
    counts = df.groupBy(target).agg(F.count("*").alias("n"))
    total = F.sum("n").over(W.partitionBy())
    return counts.withColumn("weight", ratio(total, F.count("*").over(W.partitionBy()) * F.col("n")))


def _weight(train: DataFrame, class_weight: str | None) -> Column:
    if class_weight is None:
        return F.lit(1.0)
    table = {r["y"]: r["weight"] for r in class_weight_table(train).collect()}  # two classes
    out = F.lit(None).cast("double")
    for y, w in table.items():
        out = F.when(F.col("y") == y, F.lit(w)).otherwise(out)
    return out


def _classifier(name: str, params: dict, weight_sum: float, seed: int):
    common = {"featuresCol": "features", "labelCol": "y", "weightCol": "_w"}
    if name == "logistic":
        # the penalty is per row here, and the columns are already scaled
        return LogisticRegression(
            standardization=False, elasticNetParam=0.0, regParam=1.0 / (params["C"] * weight_sum), maxIter=params.get("max_iter", 2000), tol=params.get("tol", 1e-6), **common
        )
    depth = params["max_depth"] or DEEPEST
    shape = {"maxDepth": min(depth, DEEPEST), "minInstancesPerNode": params["min_samples_leaf"], "maxBins": 256, "seed": seed}
    if name == "tree":
        return DecisionTreeClassifier(**shape, **common)
    if name == "random_forest":
        return RandomForestClassifier(
            numTrees=params["n_trees"], featureSubsetStrategy=params["max_features"], cacheNodeIds=depth <= LEVELS_KEPT, **shape, **common
        )
    raise ValueError(f"unknown model '{name}'")


def _fit_on_features(name: str, params: dict, prepared: DataFrame, n_rows: int, seed: int):
    # balanced weights add up to the number of rows as well
    rows = prepared.withColumn("_w", _weight(prepared, params.get("class_weight")))
    model = _classifier(name, params, float(n_rows), seed).fit(rows)
    return pruned(model, params["ccp_alpha"]) if name == "tree" else _without_summary(rows.sparkSession, model)


def _partition_rows(name: str) -> int:
    """A logistic fit passes over its rows tens of times; trees draw by partition and keep the smaller ones."""
    return LOGISTIC_ROWS if name == "logistic" else PARTITION_ROWS


def _without_summary(spark: SparkSession, model):
    """The same model without its training summary, as it is read from a store.

    The summary holds the session, which travels with every task that scores; a session with job tags or observed metrics cannot be sent.
    """
    if not model.hasSummary:
        return model
    path = f"{shared_folder(spark)}/fitted"
    model.write().save(path)
    return type(model).load(path)


def loss_slopes(model: PipelineModel, train: DataFrame, c: float, target: str = "y") -> DataFrame:
    """``feature, slope``: the slope of the penalised mean loss at each coefficient of an unweighted logistic model; 0 at its least."""
    names, coefficients = feature_names(model), model.stages[-1].coefficients.toArray()
    rows = model.transform(train).select(vector_to_array("features").alias("x"), (vector_to_array("probability")[1] - F.col(target)).alias("e"))
    by = rows.select(F.posexplode("x").alias("i", "x"), "e").groupBy("i").agg(F.avg(F.col("x") * F.col("e")).alias("loss"), F.count("*").alias("n"))
    label, weight = F.array(*[F.lit(n) for n in names]), F.array(*[F.lit(float(v)) for v in coefficients])
    at = F.col("i") + 1
    return by.select(F.element_at(label, at).alias("feature"), (F.col("loss") + F.element_at(weight, at) / (c * F.col("n"))).alias("slope"))


def most_frequent(df: DataFrame, target: str = "y") -> DataFrame:
    """One row ``prediction``: the most frequent class, the lower one on a tie."""
    counts = df.groupBy(target).agg(F.count("*").alias("n"))
    return counts.agg(F.min_by(target, F.struct(-F.col("n"), F.col(target))).cast("double").alias("prediction"))


def fit_model(name: str, train: DataFrame, roles: Roles, params: dict | None = None, seed: int = SEED, row_key: str = "row_id"):
    """Preparation and classifier in one pipeline, with the given parameters over the defaults."""
    params = {**DEFAULTS[name], **(params or {})}
    if name == "dummy":
        label = most_frequent(train).first()["prediction"]
        return PipelineModel([SQLTransformer(statement=f"SELECT *, {label!r}D AS prediction FROM __THIS__")])
    prep = fit_prep(train, roles)
    return _fit_prepared(name, params, prep, prep.transform(train).select(row_key, "y", "features"), seed, row_key)


def _fit_prepared(name: str, params: dict, prep: PipelineModel, prepared: DataFrame, seed: int, row_key: str):
    """The classifier on rows ``row_key, y, features``, after their preparation."""
    if name == "knn":
        base = prepared.select(F.col(row_key).alias("id"), vector_to_array("features").alias("v"), F.col("y").cast("double").alias("y"))
        return KnnModel(prep, written(base, "knn_base"), params, row_key)
    n_rows = prepared.count()
    rows = spread(prepared, n_rows, row_key, _partition_rows(name)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fitted = _fit_on_features(name, params, rows, n_rows, seed)
    finally:
        rows.unpersist()
    return PipelineModel([*prep.stages, fitted])


def score(model: PipelineModel | KnnModel, df: DataFrame, name: str = "score") -> DataFrame:
    """The rows of ``df`` with the predicted chance of y = 1."""
    if isinstance(model, KnnModel):
        return model.score(df).withColumnRenamed("score", name)
    if getattr(model.stages[-1], "hasSummary", False):
        # a model that was fitted elsewhere
        model = PipelineModel([*model.stages[:-1], _without_summary(df.sparkSession, model.stages[-1])])
    out = model.transform(df)
    if "probability" in out.columns:
        return out.select(*df.columns, vector_to_array("probability")[1].alias(name))
    if "rawPrediction" in out.columns:
        raw = out.select(*df.columns, vector_to_array("rawPrediction")[1].alias("_raw"))
        return min_max_score(raw, "_raw", name).drop("_raw")
    return out.select(*df.columns, F.col("prediction").cast("double").alias(name))


# ---------------------------------------------------------------- search


def draws(space: dict[str, list], n: int, seed: int = SEED) -> list[dict]:
    """``n`` different settings of the space, in seeded order."""
    every = [dict(zip(space, values)) for values in itertools.product(*space.values())]
    return sorted(every, key=lambda p: hashlib.md5(f"{seed}:{json.dumps(p)}".encode()).hexdigest())[: max(1, n)]


@dataclass
class FoldMatrices:
    """The group folds of one training set as prepared matrices, written once and read by all candidates.

    A matrix has ``row_key, y, features, held, capped``: whether the row is held out, and whether it is among the ``knn_rows`` that the
    nearest-neighbor model may keep; without that number it may keep all. Preparation is fitted on the rows that are not held out.
    Matrix None is that of all rows.
    """

    train: DataFrame
    roles: Roles
    work: Worklist
    k: int = FOLDS
    group: str = "group_id"
    row_key: str = "row_id"
    seed: int = SEED
    knn_rows: int | None = None

    def folded(self) -> DataFrame:
        def make() -> DataFrame:
            out = with_folds(self.train, self.k, self.group, row_key=self.row_key, seed=self.seed)
            cap = given(self.row_key).isNotNull() if self.knn_rows is None else lowest_mask(self.train.select(self.row_key), self.seed, self.row_key, F.lit(self.knn_rows))
            return out.withColumn("capped", cap)

        out = self.work.table("folded", make)
        self.work.unit("folds_checked", lambda: check_folds(out, self.k))
        return out

    def prep(self, fold: int | None) -> PipelineModel:
        path = self.work.path(f"prep_{fold}")

        def fit() -> None:
            rows = self.folded()
            fit_prep(rows if fold is None else rows.where(F.col("fold") != fold), self.roles).write().overwrite().save(path)

        self.work.unit(f"prep:{fold}", fit)
        return PipelineModel.load(path)

    def matrix(self, fold: int | None) -> DataFrame:
        held = F.lit(False) if fold is None else F.col("fold") == fold
        return self.work.table(
            f"matrix_{fold}", lambda: self.prep(fold).transform(self.folded()).select(self.row_key, "y", "features", held.alias("held"), "capped")
        )

    def fit_rows(self, name: str, fold: int | None) -> DataFrame:
        rows = self.matrix(fold).where("not held")
        return (rows.where("capped") if name == "knn" else rows).select(self.row_key, "y", "features")

    def held_rows(self, name: str, fold: int) -> DataFrame:
        rows = self.matrix(fold).where("held")
        return (rows.where("capped") if name == "knn" else rows).select(self.row_key, "y", "features")


def _fold_scores(name: str, settings: list[dict], folds: FoldMatrices, fold: int) -> list[float]:
    """AUC of every setting on one fold; all settings are scored in one job."""
    key, train, held = folds.row_key, folds.fit_rows(name, fold), folds.held_rows(name, fold)
    parts, kept = [], []
    if name == "knn":
        base = train.select(F.col(key).alias("id"), vector_to_array("features").alias("v"), F.col("y").cast("double").alias("y"))
        queries = held.select(F.col(key).alias("id"), vector_to_array("features").alias("v"))
        for metric in sorted({p["metric"] for p in settings}):
            # one neighbor search answers every k and every way to vote
            most = max(p["k"] for p in settings if p["metric"] == metric)
            found = written(nearest(queries, base, most, metric), "neighbors")
            for i, p in enumerate(settings):
                if p["metric"] == metric:
                    votes = vote(found, p["k"], p["weights"]).withColumnRenamed("id", key)
                    parts.append(held.select(key, "y").join(votes, key).select(F.lit(i).alias("draw"), "y", "score"))
    else:
        n_rows = train.count()
        rows = spread(train, n_rows, key, _partition_rows(name)).persist(StorageLevel.MEMORY_AND_DISK)
        kept = [rows, held.persist(StorageLevel.MEMORY_AND_DISK)]
        for i, p in enumerate(settings):
            model = _fit_on_features(name, p, rows, n_rows, folds.seed)
            parts.append(model.transform(held).select(F.lit(i).alias("draw"), "y", vector_to_array("probability")[1].alias("score")))
    scored = reduce(DataFrame.unionByName, parts)
    out = {r["draw"]: r["roc_auc"] for r in roc_auc(scored, by=["draw"]).collect()}  # one row per setting
    for df in kept:
        df.unpersist()
    return [out[i] for i in range(len(settings))]


def search_all(
    names: Sequence[str],
    folds: FoldMatrices,
    n_draws: int = DRAWS,
    spaces: dict[str, dict[str, list]] | None = None,
) -> list[Candidate]:
    """Seeded random search of every candidate by mean AUC over the folds, then a fit on all training rows.

    Each candidate and fold is a unit of ``folds.work``, and so is each last fit: a run that is taken up again repeats none that has ended.
    """
    work, seed, spaces = folds.work, folds.seed, SPACES if spaces is None else spaces
    settings = {n: [{**DEFAULTS[n], **p} for p in draws(spaces[n], n_draws, seed)] if spaces.get(n) else [] for n in names}
    searched = [n for n in names if settings[n]]
    if searched:
        work.units({f"matrix:{f}": (lambda f=f: folds.matrix(f).count()) for f in range(folds.k)})
    # forests take longest: they begin first, so that none is left to work alone at the end
    named = {(n, f): f"search:{n}:{f}:{fingerprint(settings[n])}" for n in sorted(searched, key=lambda n: n != "random_forest") for f in range(folds.k)}
    scores = work.units({unit: (lambda n=n, f=f: _fold_scores(n, settings[n], folds, f)) for (n, f), unit in named.items()})
    best = {}
    for n in searched:
        means = [fmean(scores[named[n, f]][i] for f in range(folds.k)) for i in range(len(settings[n]))]
        best[n] = max(range(len(means)), key=lambda i: means[i])

    def last(n: str) -> int:
        chosen = settings[n][best[n]] if n in best else {}
        if n == "dummy":
            model, rows = fit_model(n, folds.train, folds.roles), folds.train
        else:
            rows = folds.fit_rows(n, None)
            model = _fit_prepared(n, {**DEFAULTS[n], **chosen}, folds.prep(None), rows, seed, folds.row_key)
        path = work.path(f"model_{n}")
        model.save(path) if isinstance(model, KnnModel) else model.write().overwrite().save(path)
        return rows.count()

    fits = {n: f"model:{n}:{fingerprint(settings[n][best[n]] if n in best else {})}" for n in names}
    if any(n != "dummy" for n in names):
        folds.matrix(None)
    rows = work.units({fits[n]: (lambda n=n: last(n)) for n in names})
    out = []
    for n in names:
        path = work.path(f"model_{n}")
        model = KnnModel.load(work.spark, path) if n == "knn" else PipelineModel.load(path)
        if n not in best:
            out.append(Candidate(n, model, n_train=rows[fits[n]]))
            continue
        table = [scores[named[n, f]] for f in range(folds.k)]
        mean, spread_ = fmean(fold[best[n]] for fold in table), pstdev(fold[best[n]] for fold in table)
        lines = [(json.dumps(settings[n][i]), f, table[f][i]) for f in range(folds.k) for i in range(len(settings[n]))]
        out.append(Candidate(n, model, settings[n][best[n]], mean, spread_, rows[fits[n]], lines))
    return out


def search(
    name: str,
    train: DataFrame,
    roles: Roles,
    n_draws: int = DRAWS,
    k: int = FOLDS,
    group: str = "group_id",
    row_key: str = "row_id",
    seed: int = SEED,
    knn_rows: int | None = None,
    space: dict[str, list] | None = None,
    folder: str | None = None,
) -> Candidate:
    """The search of one candidate; with ``folder`` it can be taken up again there."""
    spark = train.sparkSession
    facts = fingerprint(data_fingerprint(train), vars(roles), k, group, row_key, seed, knn_rows)
    work = Worklist(spark, folder or shared_folder(spark), facts)
    folds = FoldMatrices(train, roles, work, k, group, row_key, seed, knn_rows)
    return search_all([name], folds, n_draws, None if space is None else {name: space})[0]


def cv_summary(fold_rows: DataFrame, by: str = "params") -> DataFrame:
    """Mean and population deviation over the folds of each setting, best first."""
    return (
        fold_rows.groupBy(by)
        .agg(F.avg("roc_auc").alias("mean_test_score"), F.stddev_pop("roc_auc").alias("std_test_score"))
        .orderBy(F.desc_nulls_last("mean_test_score"), by)
    )


def champion(results: DataFrame, tolerance: float = 0.005) -> DataFrame:
    """One row ``champion`` from ``name, cv_roc_auc, holdout_roc_auc``.

    The best AUC wins, cross-validated where there is one. When logistic and forest are both within the
    tolerance of the best, the simpler logistic wins. Without any candidate it is logistic.
    """
    scored = results.where("name <> 'dummy'").select("name", F.coalesce("cv_roc_auc", "holdout_roc_auc").alias("m")).where("m is not null")
    top = scored.agg(
        F.max("m").alias("best"),
        F.max_by("name", F.struct("m", "name")).alias("first"),
        F.max(F.when(F.col("name") == "logistic", F.col("m"))).alias("l"),
        F.max(F.when(F.col("name") == "random_forest", F.col("m"))).alias("f"),
    )
    close = (F.abs(F.col("l") - F.col("best")) < tolerance) & (F.abs(F.col("f") - F.col("best")) < tolerance)
    return top.select(F.when(close, F.lit("logistic")).otherwise(F.coalesce("first", F.lit("logistic"))).alias("champion"))
