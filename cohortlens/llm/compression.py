"""Quality classifier: two zstandard dictionaries, one built from good and one from bad labelled texts.

A text that is like the good ones gets smaller with the good dictionary. The normalised difference of the two compressed
sizes is all that a text is judged by: a logistic calibration, fitted on labelled rows which the dictionaries have not seen, makes it a
probability. Where only some rows of a class are taken, each counts for all it stands for, so the probability goes by the share of
labels in the table, whatever its size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from cohortlens.llm.store import in_fold, stored

ROWS = 3_000  # labelled rows of each class at most for the dictionaries, and as many for the calibration
DICTIONARY_BYTES = 1 << 18  # of whole texts of one class; a larger dictionary covers more words but points further back
LONGEST = 1 << 13  # bytes of a text that may go into a dictionary, so that it holds many texts
LEVEL = 7
FOLDS = 5
CHUNK = 512  # texts are compressed in chunks, so that a dictionary counts as much in a long text as in a short one


class Differences:
    """Normalised differences of the compressed sizes of whole texts: positive where the good dictionary saves more."""

    def __init__(self, good: bytes, bad: bytes, level: int) -> None:
        params = zstandard.ZstdCompressionParameters.from_level(level, write_content_size=False, write_checksum=False, write_dict_id=False)
        self.by = [zstandard.ZstdCompressor(dict_data=self._dictionary(d, level), compression_params=params).compress for d in (good, bad)]

    @staticmethod
    def _dictionary(content: bytes, level: int) -> zstandard.ZstdCompressionDict:
        out = zstandard.ZstdCompressionDict(content)
        out.precompute_compress(level=level)
        return out

    def __call__(self, text: bytes) -> float:
        chunks = [text[at : at + CHUNK] for at in range(0, len(text), CHUNK)]
        good, bad = (sum(len(compress(c)) for c in chunks) for compress in self.by)
        return (bad - good) / (bad + good) if chunks else 0.0


def logistic(x: np.ndarray, y: np.ndarray, counts: np.ndarray, penalty: float = 1e-3) -> tuple[float, float]:
    """Slope and intercept by Newton steps, each row as often as it counts."""
    mean = np.average(x, weights=counts)
    scale = max(float(np.sqrt(np.average((x - mean) ** 2, weights=counts))), 1e-9)
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    w = np.zeros(2)
    ridge = np.diag([penalty * counts.sum(), 1e-9])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        w = w + np.linalg.solve(z.T @ (z * (counts * np.maximum(p * (1 - p), 1e-6))[:, None]) + ridge, z.T @ (counts * (y - p)) - ridge @ w)
    return w[0] / scale, w[1] - w[0] * mean / scale


def chosen(sizes: list[int], limit: int, longest: int = LONGEST) -> list[int]:
    """Numbers of the texts, in order, of at most ``longest`` bytes each that fit in ``limit`` together; the shortest one if none does."""
    out, left = [], limit
    for i, n in enumerate(sizes):
        if n <= min(left, longest):
            out.append(i)
            left -= n
    return out or [int(np.argmin(sizes))] if sizes else []


def picked_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, most: int) -> tuple[DataFrame, dict[tuple[int, bool], int]]:
    """``id, tag, label, for_dict, text`` of at most ``most`` labelled rows of each class and use, written once; and how many there are in all.

    Those with the lowest hashes of their ids are taken, never held-out ones. An id with both labels has none. Of documents that share an
    id, the least text comes along.
    """
    labelled = labels.where(~in_fold(id_col, FOLDS) & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
    labelled = labelled.agg(F.min(label_col).cast("int").alias("label"), F.max(label_col).cast("int").alias("_other")).where("label = _other").drop("_other")
    labelled = labelled.withColumn("tag", F.xxhash64(F.col("id").cast("string"))).withColumn("for_dict", F.pmod("tag", F.lit(2)) == 0)
    counts = {(r["label"], r["for_dict"]): r["count"] for r in labelled.groupBy("label", "for_dict").count().collect()}
    rows = None
    for label in (0, 1):
        for for_dict in (True, False):
            part = labelled.where((F.col("label") == label) & (F.col("for_dict") == for_dict)).orderBy("tag", "id").limit(most)
            rows = part if rows is None else rows.unionByName(part)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where(~in_fold("id", FOLDS) & (F.length(F.col(text_col).cast("string")) > 0))
    # the ids are at most 4 x most
    found = texts.join(F.broadcast(rows), "id").groupBy("id", "tag", "label", "for_dict").agg(F.min("text").alias("text"))
    return stored(found, "labelled_texts"), counts


def _dictionary(rows: DataFrame, label: int, limit: int) -> bytes:
    own = rows.where(F.col("label") == label)
    sizes = own.select("id", "tag", F.octet_length("text").alias("size")).orderBy("tag", "id").collect()
    take = chosen([r["size"] for r in sizes], limit)
    # whole texts, together at most ``limit`` bytes
    ids = [sizes[i]["id"] for i in take]
    texts = own.where(F.col("id").isin(ids)).orderBy("tag", "id").select("text").collect() if ids else []
    return b"\n".join(r["text"].encode() for r in texts).ljust(8)


def _each(good: bytes, bad: bytes, level: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        difference = Differences(good, bad, level)
        for batch in batches:
            found = [difference(t.as_buffer().to_pybytes()) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["label"], batch["for_dict"], pa.array(found, pa.float64())], names=["label", "for_dict", "difference"])

    return run


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, most: int, dictionary_bytes: int, level: int = LEVEL) -> dict:
    """Dictionaries, slope and intercept; with one class or no labelled rows, the rate of label 1 alone."""
    rows, counts = picked_rows(docs, labels, id_col, text_col, label_col, most)
    total = sum(counts.values())
    model = {"rate": (sum(n for (y, _), n in counts.items() if y) + 1) / (total + 2)}
    there = {(r["label"], r["for_dict"]) for r in rows.select("label", "for_dict").distinct().collect()}
    if {y for y, _ in there} != {0, 1}:
        return model
    apart = len(there) == 4  # else the few rows serve both uses
    dictionaries = [_dictionary(rows.where("for_dict") if apart else rows, y, dictionary_bytes) for y in (1, 0)]
    used = rows.where("NOT for_dict") if apart else rows
    # texts are compressed in tasks; one number a row comes back
    found = used.select("label", "for_dict", "text").mapInArrow(_each(*dictionaries, level), "label int, for_dict boolean, difference double").collect()
    stands_for = [max(1.0, counts[r["label"], r["for_dict"]] / most) for r in found]
    slope, intercept = logistic(np.array([r["difference"] for r in found]), np.array([r["label"] for r in found], float), np.array(stands_for))
    return {**model, "good": dictionaries[0], "bad": dictionaries[1], "level": level, "slope": slope, "intercept": intercept}


class Scorer:
    """Scores of whole texts under a model of ``fit``."""

    def __init__(self, model: dict) -> None:
        self.model = model
        self.difference = Differences(model["good"], model["bad"], model["level"]) if "good" in model else None

    def __call__(self, column: pa.Array) -> np.ndarray:
        scores = np.full(len(column), self.model["rate"])
        if self.difference is not None:
            for i, text in enumerate(column):
                if text.is_valid and len(data := text.as_buffer().to_pybytes()):
                    z = self.model["slope"] * self.difference(data) + self.model["intercept"]
                    scores[i] = 1 / (1 + np.exp(-min(max(z, -30.0), 30.0)))
        return scores


def _score(model: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["id"], batch["held_out"], pa.array(scorer(batch["text"]))], names=["id", "held_out", "score"])

    return run


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    threshold: float = 0.3,
    most: int = ROWS,
    dictionary_bytes: int = DICTIONARY_BYTES,
) -> DataFrame:
    """``id, held_out, score, predicted``, one row per row of ``docs``.

    Labels of rows in the held-out fold are never read, and an id that has both labels counts as unlabelled. The dictionaries hold whole texts,
    ``dictionary_bytes`` of each class in texts of at most ``LONGEST`` bytes (or its shortest text, if all are longer), from at most ``most`` labelled rows; as many others fit
    the calibration, each weighted by the labelled rows it stands for. A null or empty text gets the rate of label 1, and so does every text
    when the labelled texts have one class or none. Long texts are compressed whole, in chunks, one at a time. Repeated rows get equal
    scores, ties in the order of the rows' hashes go by id; extra columns are not read. Empty table: no rows.
    """
    model = fit(docs, labels, id_col, text_col, label_col, most, dictionary_bytes)
    base = docs.select(F.col(id_col).alias("id"), in_fold(id_col, FOLDS).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    id_type = base.schema["id"].dataType.simpleString()
    scored = base.mapInArrow(_score(model), f"id {id_type}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def kept(
    docs: DataFrame,
    labels: DataFrame,
    text_col: str = "text",
    threshold: float = 0.3,
    id_col: str = "doc_id",
    label_col: str = "quality",
    most: int = ROWS,
    dictionary_bytes: int = DICTIONARY_BYTES,
) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``, with all their columns; texts do not move."""
    model = fit(docs, labels, id_col, text_col, label_col, most, dictionary_bytes)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            yield batch.filter(pa.array(scorer(batch.column(at)) >= threshold))

    return docs.mapInArrow(run, docs.schema)
