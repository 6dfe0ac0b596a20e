"""Mixing sources to target weights: hash-threshold histograms, in DataFrame operations only.

Every row has a tag of hex digits, fixed by its id and text. Sizes are summed by source and the tag's leading digits;
the bucket in which a source's budget ends is refined by further digits, and nothing else is looked at again. Rows below
the threshold are taken, rows above it are not: a filter, with no order over the rows. The budgets of the 1st, 2nd
and 3rd time a source is gone through are nested: all but the last cover every row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from cohortlens.llm.store import stored, whole_text

DIGITS = 4  # hex digits of a level: 65,536 buckets for each source
LEVELS = 6  # half of them of the content, half of the row, so that repeated rows are dealt out too
SALTS = 64  # parts that a source's rows are dealt to where they meet its plan
LEAF_ROWS = 1_000  # of a source in the bucket that is then read row by row
MOST = 3  # times a document is taken
WEIGHTS = (5, 2, 1)
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Add ``target`` to ``source, source_size``: shares of all sizes by weight, none above ``most`` times its source.

    Sources in code point order, null last, take the weights in turn. What a capped source leaves goes to the others by
    weight until none is above its cap: the cap binds for the sources with the least cap per weight, so one running
    total in that order finds the level. Windows here run over one row per source.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1
    weighed = sizes.withColumn("w", F.element_at(F.array(*[F.lit(int(x)).cast("long") for x in weights]), turn.cast("int")))
    weighed = weighed.withColumn("cap", F.lit(int(most)).cast("long") * F.col("source_size"))
    by_cap = W.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy()
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    heavy = F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0))
    stepped = weighed.select("*", left.alias("left"), heavy.alias("heavy"))
    # capped while the cap is at most the level that the sources from here on would share
    free = stepped.withColumn("free", F.col("cap") * F.col("heavy") > F.col("w") * F.col("left"))
    at = free.withColumn("place", F.when(F.col("free"), F.struct("left", "heavy")))
    first = F.first("place", ignorenulls=True).over(by_cap.rowsBetween(W.unboundedPreceding, 0))
    level = at.withColumn("level", first)
    share = F.col("w") * F.col("level.left") / F.col("level.heavy")
    return level.select("source", "source_size", F.coalesce(share, F.col("cap").cast("double")).alias("target"))


def _digits(level: int) -> Column:
    return F.substring("tag", 1, DIGITS * (level + 1))


def _thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """``source, row_id, part``: the words of the one row of each source in which its budget ends; and ``edge``, its tag.

    A level reads only the rows in the boundary bucket of the level before it.
    """
    left, inside = budgets.select("source", F.col("budget").alias("left")), rows
    for level in range(LEVELS):
        sums = inside.groupBy("source", _digits(level).alias("bucket")).agg(F.sum("size").alias("size"), F.count("*").alias("n"))
        upto = F.sum("size").over(W.partitionBy("source").orderBy("bucket"))
        ends = (
            sums.select("*", upto.alias("upto"))
            .join(left.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
            .where((F.col("upto") > F.col("left")) & (F.col("upto") - F.col("size") <= F.col("left")))
        )
        edge = stored(ends.select("source", "bucket", "n", (F.col("left") - (F.col("upto") - F.col("size"))).alias("left")), f"edge_{level}")
        inside = _inside(inside, edge, level)
        left = edge.select("source", "left")
        if not (edge.agg(F.max("n")).first()[0] or 0) > LEAF_ROWS:
            break
    before = F.sum("size").over(W.partitionBy("source").orderBy("tag", "row_id")) - F.col("size")
    leaf = inside.select("source", "row_id", "tag", "size", before.alias("before"))
    return (
        leaf.join(left.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
        .where((F.col("before") <= F.col("left")) & (F.col("before") + F.col("size") > F.col("left")))
        .select("source", F.col("tag").alias("edge"), F.col("row_id").alias("edge_row"), (F.col("left") - F.col("before")).alias("part"))
    )


def _inside(rows: DataFrame, edge: DataFrame, level: int) -> DataFrame:
    at = edge.select(F.col("source").alias("_s"), F.col("bucket").alias("_b"))
    return rows.join(at, F.col("source").eqNullSafe(F.col("_s")) & (_digits(level) == F.col("_b")), "left_semi")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per row of ``docs``: ``id, size, source, source_size, target, times, part, taken``, and the ``keep`` columns.

    ``taken`` words = ``times`` whole copies and ``part`` words of one more; only the row in which a source's budget ends has
    a part that is not the whole text. A source's taken words are its target without the fraction. Null text: size 0; null
    source: a source of its own, the last. Repeated rows are rows like any other. Sizes all 0: targets 0. Empty table: no rows.
    """
    text = whole_text(text_col)
    content = F.md5(F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(source_col), text))
    base = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col(id_col).alias("id"),
        F.col(source_col).cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        content.alias("content"),
        *keep,
    )
    tag = F.concat(F.substring("content", 1, 12), F.substring(F.md5(F.col("row_id").cast("string")), 1, 12))
    rows = stored(base.withColumn("tag", tag).drop("content"), "tagged")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    times = F.floor(F.col("target") / F.greatest("source_size", F.lit(1)))
    aims = targets(sizes, weights, most).select("*", times.alias("whole"))
    aims = stored(aims.withColumn("budget", F.floor(F.col("target") - F.col("whole") * F.col("source_size"))), "targets")
    edges = _thresholds(rows.select("row_id", "source", "size", "tag"), aims)
    plan = aims.join(edges.withColumnRenamed("source", "_e"), F.col("source").eqNullSafe(F.col("_e")), "left").drop("_e")
    # one source may hold a third of all rows: its plan, one row, is repeated for each part of them
    plan = plan.withColumnRenamed("source", "_s").withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = F.pmod(F.xxhash64("tag", "row_id"), F.lit(SALTS)).cast("int")
    below = (F.col("tag") < F.col("edge")) | ((F.col("tag") == F.col("edge")) & (F.col("row_id") < F.col("edge_row")))
    more = F.when(F.col("budget") == 0, 0).when(F.col("row_id") == F.col("edge_row"), F.col("part")).when(below, F.col("size")).otherwise(0)
    return (
        rows.withColumn("_deal", dealt)
        .join(plan, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_deal") == F.col("_part")))
        .withColumn("more", more.cast("long"))
        .select(
            "id",
            "size",
            "source",
            "source_size",
            "target",
            (F.col("whole") + ((F.col("more") == F.col("size")) & (F.col("size") > 0)).cast("long")).alias("times"),
            F.when(F.col("more") < F.col("size"), F.col("more")).otherwise(0).alias("part"),
            (F.col("whole") * F.col("size") + F.col("more")).alias("taken"),
            *keep,
        )
    )


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each copy, the last of a source cut after its share of words."""
    names = docs.columns
    packed = docs.withColumn("_row", F.struct(*names))
    plan = mix(packed, keep=["_row"], **options)
    text = options.get("text_col", "text")
    pieces = F.split(F.col(f"_row.{text}"), r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    # white space before the first word is a piece of its own
    lead = F.col(f"_row.{text}").rlike(r"^[\x20\x09-\x0D]").cast("long")
    cut = F.array_join(F.slice(pieces, 1, (F.col("part") + lead).cast("int")), "")
    copies = F.concat(
        F.array_repeat(F.lit(False), F.col("times").cast("int")), F.when(F.col("part") > 0, F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>"))
    )
    rows = plan.withColumn("_cut", F.explode(copies))
    columns = [F.when(F.col("_cut"), cut).otherwise(F.col(f"_row.{c}")).alias(c) if c == text else F.col(f"_row.{c}").alias(c) for c in names]
    return rows.select(*columns)


ORACLE = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
  substr(md5(concat_ws(':', coalesce(CAST(doc_id AS VARCHAR), ''), source, coalesce(text, ''))), 1, 12) AS tag FROM {docs}),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1),
w AS (SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w, 3 * source_size AS cap FROM s),
p AS (SELECT *, (SELECT sum(source_size) FROM w) - coalesce(sum(cap) OVER b, 0) AS l, (SELECT sum(w) FROM w) - coalesce(sum(w) OVER b, 0) AS h
  FROM w WINDOW b AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT arg_max(l, h) AS l, max(h) AS h FROM p WHERE cap * h > w * l),
t AS (SELECT source, source_size, CASE WHEN h IS NULL OR p_free = 0 THEN CAST(cap AS DOUBLE) ELSE CAST(w * l AS DOUBLE) / CAST(h AS DOUBLE) END AS target
  FROM (SELECT p.source, p.source_size, p.cap, p.w, level.l, level.h, CAST(p.h <= level.h AS INT) AS p_free FROM p LEFT JOIN level ON true)),
a AS (SELECT *, CAST(floor(target / greatest(source_size, 1)) AS BIGINT) AS whole FROM t),
b AS (SELECT *, CAST(floor(target - whole * source_size) AS BIGINT) AS budget FROM a),
o AS (SELECT d.doc_id, d.size, b.source_size, b.target, b.whole, b.budget,
  sum(d.size) OVER (PARTITION BY d.source ORDER BY d.tag, d.doc_id ROWS UNBOUNDED PRECEDING) - d.size AS before
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
"""
SQL = ORACLE.format(docs="documents") + """
SELECT doc_id, size, source_size, round(target, 6) AS target,
  CAST(whole * size + greatest(0, least(size, budget - before)) AS BIGINT) AS taken FROM o"""
