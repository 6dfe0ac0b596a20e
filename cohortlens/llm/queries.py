"""The registered queries of this subpackage, each over its whole table, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlens.llm import compression, exact, jaccard, links, maxent, mixing, packing, periodic, pii, rules, spans, substrings, vector_trie
from cohortlens.llm.store import whole_text

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op6_mix_sources", mixing.SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", F.round("target", 6).alias("target"), "taken")


@query("op7_pack_mixture")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(table(spark, sf_dir, "documents"))
    return out.withColumnRenamed("id", "doc_id")


@query(
    "op10_exact_dedup",
    """
SELECT doc_id, max(doc_id) OVER same AS keep_id, CAST(count(*) OVER same AS BIGINT) AS group_size,
  row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact.exact_dedup(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha256").alias("text_sha256"))


@query("op4_remove_repeats")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned corpus: every document, with what is left of its text."""
    out = spans.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_sentences", "n_removed", "removed", "text")


@query("op5_quality_compression")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = compression.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.withColumnRenamed("id", "doc_id")


@query("op8_line_rules")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.line_rules(table(spark, sf_dir, "documents")).drop("row_id").withColumnRenamed("id", "doc_id")


@query("op9_link_trust")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.judge(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


@query("op2_pii_field")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.find_pii(table(spark, sf_dir, "documents"))
    counts = [f"n_{k}" for k in pii.KINDS]
    return out.select(F.col("id").alias("doc_id"), *counts, F.sha2("base", 256).alias("base_sha256"), "spans")


@query("op1_maxent_score")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.score(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query("op3_jaccard_groups")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(table(spark, sf_dir, "documents")).drop("row_id", "component").withColumnRenamed("id", "doc_id")


@query("op11_lyndon_substrings")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.remove_repeated_bytes(table(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    spans_of = F.size("removed").cast("long")
    return out.select(F.col("id").alias("doc_id"), "n_bytes", removed.alias("n_removed"), spans_of.alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op12_vector_trie")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, books = vector_trie.compress(table(spark, sf_dir, "embeddings"))
    return out.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(vector_trie.digest(books)).alias("codebooks_sha256"))


def repeating(docs: DataFrame) -> DataFrame:
    """``doc_id, text``; in one text of ten, by its id, the words from some place on repeat a stretch of them."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.filter(F.split(whole_text(), "[ \\x09-\\x0D]+"), lambda w: w != "")
    own = docs.select("doc_id", whole_text().alias("text"), h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    own = own.withColumn("a", F.when(n > 0, g % n).cast("int")).withColumn("p", (F.lit(1) + F.floor((n - F.col("a")) / (3 + g % 8))).cast("int"))
    times = F.ceil((n - F.col("a")) / F.col("p")).cast("int")
    rest = F.slice(F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), times)), F.lit(1), n - F.col("a"))
    text = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), rest), " ")
    return own.select("doc_id", F.when(F.col("a").isNotNull(), text).otherwise(F.col("text")).alias("text"))


@query("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periodic.collapse_runs(repeating(table(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    out = out.select(F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), best.alias("best"), lines.alias("lines"), "text")
    return out.select(
        "doc_id",
        "n_runs",
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
