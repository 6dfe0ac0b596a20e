"""Feature preparation as a fitted pipeline of built-in stages, so that it stays on the JVM and can be saved."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from cohortlens.operators.frame import Roles
from cohortlens.operators.ordering import exact_quantiles

UNKNOWN = "UNKNOWN"


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, median`` with the mean of the two middle values for even counts."""
    return exact_quantiles(df, columns, [0.5]).select("column", F.col("value").alias("median"))


def _number(c: str) -> Column:
    return F.col(c).cast("double")


def scaling(df: DataFrame, columns: Sequence[str], fill: dict[str, float]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of the filled columns; a deviation of 0 scales by 1."""
    if not columns:
        return {}
    row = df.agg(
        *[
            F.struct(
                F.avg(F.coalesce(_number(c), F.lit(fill[c]))).alias("mean"),
                F.stddev_pop(F.coalesce(_number(c), F.lit(fill[c]))).alias("std"),
                (F.min(F.coalesce(_number(c), F.lit(fill[c]))) == F.max(F.coalesce(_number(c), F.lit(fill[c])))).alias("flat"),
            ).alias(c)
            for c in columns
        ]
    ).first()
    return {c: (row[c]["mean"] or 0.0, 1.0 if row[c]["flat"] or not row[c]["std"] else row[c]["std"]) for c in columns}


def standardised(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill with the exact median and scale by population moments: ``num__<c>`` for each column."""
    return numeric_stage(df, columns).transform(df)


def numeric_stage(train: DataFrame, columns: Sequence[str]) -> SQLTransformer:
    found = {r["column"]: r["median"] for r in medians(train, columns).collect()}  # one row per column
    fill = {c: float(found.get(c) or 0.0) for c in columns}
    moments = scaling(train, columns, fill)
    parts = [
        f"(coalesce(CAST(`{c}` AS DOUBLE), {fill[c]!r}D) - ({moments[c][0]!r}D)) / {moments[c][1]!r}D AS `num__{c}`"
        for c in columns
    ]
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


def text_stage(columns: Sequence[str]) -> SQLTransformer:
    parts = [f"coalesce(CAST(`{c}` AS STRING), '{UNKNOWN}') AS `text__{c}`" for c in columns]
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


def fit_prep(train: DataFrame, roles: Roles) -> PipelineModel:
    """Median + scaling for numbers, sentinel + one-hot for categories; a level not seen here gives all zeros."""
    stages: list = []
    parts = []
    if roles.numeric:
        stages.append(numeric_stage(train, roles.numeric))
        parts += [f"num__{c}" for c in roles.numeric]
    if roles.categorical:
        text = text_stage(roles.categorical)
        seen = text.transform(train)
        indexer = StringIndexer(
            inputCols=[f"text__{c}" for c in roles.categorical],
            outputCols=[f"index__{c}" for c in roles.categorical],
            handleInvalid="keep",
            stringOrderType="alphabetAsc",
        ).fit(seen)
        # the slot that dropLast leaves out is the one for unseen levels
        encoder = OneHotEncoder(
            inputCols=[f"index__{c}" for c in roles.categorical],
            outputCols=[f"cat__{c}" for c in roles.categorical],
            dropLast=True,
        ).fit(indexer.transform(seen))
        stages += [text, indexer, encoder]
        parts += [f"cat__{c}" for c in roles.categorical]
    stages.append(VectorAssembler(inputCols=parts, outputCol="features"))
    return PipelineModel(stages)


def feature_names(model: PipelineModel) -> list[str]:
    """``num__<column>`` and ``cat__<column>_<level>`` in the order of the feature vector."""
    levels: dict[str, list[str]] = {}
    names: list[str] = []
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel):
            for col, labels in zip(stage.getInputCols(), stage.labelsArray):
                base = col.removeprefix("text__")
                levels[f"cat__{base}"] = [f"cat__{base}_{level}" for level in labels]
        if isinstance(stage, VectorAssembler):
            for c in stage.getInputCols():
                names += levels.get(c, [c])
    return names


def levels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, level, position``: the encoded levels of each category, in alphabetical order."""
    seen = text_stage(columns).transform(df).select(*[F.col(f"text__{c}").alias(c) for c in columns])
    pairs = seen.unpivot([], list(columns), "column", "level").distinct()
    # one row per column and level
    place = F.row_number().over(W.partitionBy("column").orderBy("level")) - 1
    return pairs.where("level is not null").select("column", place.cast("int").alias("position"), "level")
