"""Quality rules: cross-document line frequency, after rules on single documents.

One pass over the texts counts what the single-document rules need and keeps, for each document, the hashes of its distinct
normalised lines (A-Z lower-cased, words joined by one space, digits alike) and the words in each. The rest is
DataFrame work on hashes: the distinct documents of each host and line, the lines above the limit, what they leave.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from cohortlens.llm.store import stored
from cohortlens.llm.text import Hasher, Slice, Words, code_points, mixed, per_doc, slices, windows, words

LEAST_WORDS = 20
REPEATED_PERCENT = 30
WINDOW = 8
LINE_DOCS = 20  # distinct documents of a host that may share a line
KEPT_PERCENT = 50  # of a document's words that must be left
SYMBOLS = b"#*$%&|<>"
FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeat_words(hashes: np.ndarray, doc: np.ndarray, n_docs: int, k: int) -> np.ndarray:
    """Words of each document inside windows of ``k`` words that it has twice or more."""
    if len(hashes) < k:
        return np.zeros(n_docs, np.int64)
    own = np.flatnonzero(doc[: len(doc) - k + 1] == doc[k - 1 :])
    with np.errstate(over="ignore"):
        keys = mixed(windows(hashes, k)[own] + doc[own].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    again = np.zeros(len(keys), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    edge = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edge, own[again], 1)
    np.add.at(edge, own[again] + k, -1)
    return np.bincount(doc[np.cumsum(edge[:-1]) > 0], minlength=n_docs)


def _line_of_words(part: Slice, found: Words) -> np.ndarray:
    """Number of the line of each word, over the slice; documents start new lines."""
    breaks = np.flatnonzero(part.data == 10)
    starts = np.unique(np.concatenate([breaks + 1, part.offsets[:-1]]))
    return np.searchsorted(starts, found.start, side="right") - 1


def _duplicate_lines(text: bytes) -> int:
    seen, n = set(), 0
    for line in text.split(b"\n"):
        if line in seen:
            n += 1
        elif line.split():
            seen.add(line)
    return n


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    exact, folded = Hasher(lower=False), Hasher(lower=True)
    # for normalised lines, all digits are alike
    folded.values[48:58] = folded.values[48]
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    for batch in batches:
        for part in slices(batch["text"]):
            found = words(part)
            n, doc = part.n, found.doc
            inside = code_points(part.data) & (np.frombuffer(_SPACES, np.uint8)[part.data] == 0)
            line = _line_of_words(part, found)
            hashes = folded(part, found)
            first = np.flatnonzero(np.r_[True, line[1:] != line[:-1]]) if len(line) else np.zeros(0, np.int64)
            counts = np.diff(np.r_[first, len(line)])
            with np.errstate(over="ignore"):
                place = np.arange(len(line)) - np.repeat(first, counts)
                weighed = hashes * mixed(place.astype(np.uint64) + np.uint64(1))
                sums = mixed(np.add.reduceat(weighed, first)) if len(first) else np.zeros(0, np.uint64)
            edges = np.searchsorted(doc[first], np.arange(n + 1))
            raw = part.data.tobytes()
            texts = [raw[a:b] for a, b in zip(part.offsets[:-1].tolist(), part.offsets[1:].tolist())]
            own = batch.slice(part.first, n)
            content = np.array([xxhash.xxh3_64_intdigest(t) for t in texts], np.uint64).view(np.int64)
            offsets = pa.array(edges, pa.int32())
            figures = [
                np.bincount(doc, minlength=n),
                per_doc(inside, part.offsets),
                per_doc(symbol[part.data], part.offsets),
                [_duplicate_lines(t) if b"\n" in t else 0 for t in texts],
                _repeat_words(exact(part, found), doc, n, WINDOW),
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    own["row_id"],
                    own["id"],
                    own["host"],
                    pa.array(content),
                    *[pa.array(f, pa.int64()) for f in figures],
                    pa.ListArray.from_arrays(offsets, pa.array(sums.view(np.int64))),
                    pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int32())),
                ],
                names=["row_id", "id", "host", "content", *FIGURES, "lines", "line_words"],
            )


_SPACES = bytes(1 if b == 32 or 9 <= b <= 13 else 0 for b in range(256))


def line_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    line_docs: int = LINE_DOCS,
    kept_percent: int = KEPT_PERCENT,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """One row per row of ``docs``: ``id``, the counts, ``base_failed, words_left, kept``.

    A line is removed where more than ``line_docs`` distinct documents of its host hold it; documents with one text count
    once, so plain copies do not reject each other. A document that is left with fewer than ``least_words`` words, or less than
    ``kept_percent`` of its words, is rejected. Null text: no words, rejected. Null hosts are one host. Repeated rows get
    equal verdicts. Empty table: no rows. Extra columns are not read.
    """
    base = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col(id_col).alias("id"),
        F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"),
        F.col(text_col).cast("string").alias("text"),
    )
    id_type = base.schema["id"].dataType.simpleString()
    figures = ", ".join(f"{c} long" for c in FIGURES)
    schema = f"row_id long, id {id_type}, host string, content long, {figures}, lines array<long>, line_words array<int>"
    rows = stored(base.mapInArrow(_lines, schema), "lines")
    held = rows.select("host", "content", F.explode(F.array_distinct("lines")).alias("line"))
    # a third of all rows may hold one line: both counts are summed in each task before anything moves
    shared = held.distinct().groupBy("host", "line").count().where(F.col("count") > line_docs).select("host", "line")
    each = rows.select("row_id", "host", F.explode(F.arrays_zip("lines", "line_words")).alias("x"))
    each = each.select("row_id", "host", F.col("x.lines").alias("line"), F.col("x.line_words").alias("n"))
    gone = each.join(shared, ["host", "line"]).groupBy("row_id").agg(F.sum("n").alias("gone"))
    left = F.col("n_words") - F.coalesce("gone", F.lit(0))
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    fine = ~failed & (left >= least_words) & (100 * left >= kept_percent * F.col("n_words"))
    return (
        rows.drop("lines", "line_words", "host", "content")
        .join(gone, "row_id", "left")
        .select("row_id", "id", *FIGURES, failed.alias("base_failed"), left.alias("words_left"), fine.alias("kept"))
    )
