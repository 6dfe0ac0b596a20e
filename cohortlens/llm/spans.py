"""Substring dedup: sliding spans of sentences.

Sentences end at a line break and after a word that ends in . ! or ?. After ``BARE`` words without either, a word whose
hash says so ends one, so text without punctuation is cut at the same words wherever it is repeated; and so does every ``LONGEST``-th.
From each sentence on, two runs are hashed: the next ``RUN`` sentences, whatever their words, and the fewest of at least ``LONG_RUN``
sentences that have ``LONG_WORDS`` words. So every run of four sentences counts, its last sentence too, and three if they are not short.
Runs are counted globally; of a repeated run, every occurrence but the first (by id, row and place) marks its sentences, and marked
sentences are removed from the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cohortlens.llm.store import stored
from cohortlens.llm.text import Hasher, Slice, code_points, mixed, slices, words

RUN = 4  # sentences, of any length
LONG_RUN = 3  # sentences that have at least
LONG_WORDS = 16
BARE = 7  # words without an end, after which
CUT = 8  # one word in so many ends a sentence
LONGEST = 24  # words of a sentence; one word over and over may have no other end
ENDS = b".!?"


def sentences(part: Slice, hasher: Hasher) -> tuple[np.ndarray, ...]:
    """For each sentence of a slice: document, first word, word after the last; and the words' starts and hashes."""
    found = words(part)
    hashes = hasher(part, found)
    if len(hashes) == 0:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    mark = np.zeros(256, bool)
    mark[list(ENDS)] = True
    lines = np.concatenate([[0], np.cumsum(part.data == 10)])
    last = mark[part.data[found.end - 1]]
    last[:-1] |= (lines[found.start[1:]] > lines[found.end[:-1]]) | (found.doc[1:] != found.doc[:-1])
    last[-1] = True
    # only words near by decide, so a repeated passage is cut alike but for its first few words; before a slice as before a document is an end
    ends = np.concatenate([np.full(BARE, -1), [0], np.cumsum(last)])
    last |= (ends[BARE + 1 :] == ends[: -BARE - 1]) & (mixed(hashes) % np.uint64(CUT) == 0)
    at = np.arange(len(last))
    begin = np.maximum.accumulate(np.where(np.concatenate([[True], last[:-1]]), at, 0))
    last |= (at - begin) % LONGEST == LONGEST - 1
    to = np.flatnonzero(last) + 1
    start = np.concatenate([[0], to[:-1]])
    return found.doc[start], start, to, found.start, hashes


def runs(doc: np.ndarray, start: np.ndarray, to: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First sentence, number of sentences and hash of each run, in the order of the first sentences."""
    n = len(doc)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.arange(n)
    any_words, long_words = at + RUN - 1, np.maximum(np.searchsorted(to, start + LONG_WORDS, side="left"), at + LONG_RUN - 1)
    end = np.stack([any_words, long_words], axis=1)
    fits = end < n
    fits &= doc[np.minimum(end, n - 1)] == doc[:, None]
    fits[:, 1] &= long_words != any_words
    first, end = np.repeat(at, 2)[fits.ravel()], end.ravel()[fits.ravel()]
    step = np.uint64(0xD6E8FEB86659FD93)
    with np.errstate(over="ignore"):
        # hash of any range of words: differences of running sums, brought to the same power
        up = np.concatenate([[np.uint64(1)], np.cumprod(np.full(len(hashes), step), dtype=np.uint64)])
        down = np.concatenate([[np.uint64(1)], np.cumprod(np.full(len(hashes), np.uint64(pow(int(step), -1, 1 << 64))), dtype=np.uint64)])
        upto = np.concatenate([[np.uint64(0)], np.cumsum(hashes * up[:-1], dtype=np.uint64)])
        last = to[end]
        found = mixed((upto[last] - upto[start[first]]) * down[start[first]] + (last - start[first]).astype(np.uint64))
    return first, end - first + 1, found


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = Hasher(lower=False)
    for batch in batches:
        for part in slices(batch["text"]):
            doc, start, to, _, hashes = sentences(part, hasher)
            first, length, found = runs(doc, start, to, hashes)
            edges = np.searchsorted(doc, np.arange(part.n + 1))
            lists = pa.array(np.searchsorted(doc[first], np.arange(part.n + 1)), pa.int32())
            own = batch.slice(part.first, part.n)
            # place and length of a run in one number
            place = (first - edges[doc[first]]) << 16 | length
            columns = [pa.ListArray.from_arrays(lists, pa.array(x.view(np.int64))) for x in (found, place)]
            yield pa.RecordBatch.from_arrays([own["row_id"], own["id"], own["text"], *columns], names=["row_id", "id", "text", "hashes", "places"])


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut the marked sentences out; ``runs`` lists the places of the marked runs."""
    hasher = Hasher(lower=False)
    for batch in batches:
        marked = batch["runs"].to_pylist()
        counts, gone, spans, left = [], [], [], []
        for part in slices(batch["text"]):
            doc, start, _, word_start, _ = sentences(part, hasher)
            points = np.concatenate([[0], np.cumsum(code_points(part.data))])
            edges = np.searchsorted(doc, np.arange(part.n + 1))
            for d in range(part.n):
                lo, hi = part.offsets[d], part.offsets[d + 1]
                n = edges[d + 1] - edges[d]
                hit = np.zeros(n + 1, np.int64)
                for place in marked[part.first + d] or []:
                    hit[place >> 16] += 1
                    hit[(place >> 16) + (place & 0xFFFF)] -= 1
                hit = np.cumsum(hit[:-1]) > 0
                # a sentence reaches to the next one's first word
                begin = np.append(word_start[start[edges[d] : edges[d + 1]]], hi)
                turn = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
                cuts = [(begin[a], begin[b]) for a, b in turn.reshape(-1, 2)]
                kept, at = [], lo
                for a, b in cuts:
                    kept.append(part.data[at:a].tobytes())
                    at = b
                kept.append(part.data[at:hi].tobytes())
                counts.append(n)
                gone.append(int(hit.sum()))
                spans.append([{"start": int(points[a] - points[lo]), "end": int(points[b] - points[lo])} for a, b in cuts])
                left.append(b"".join(kept).decode())
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [batch["row_id"], batch["id"], pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, span), pa.array(left, pa.string())],
            names=["row_id", "id", "n_sentences", "n_removed", "removed", "text"],
        )


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", touched_only: bool = False) -> DataFrame:
    """``row_id, id, n_sentences, n_removed, removed`` (spans in code points, end exclusive) ``, text`` (what is left).

    One row per row of ``docs``, or only those that lose sentences. The first occurrence of a run, by id (null first), row and
    place, stays; a repeated row loses all runs, a run repeated inside one text all but its first. Null text: empty. Texts
    of fewer sentences than a run lose nothing: three with 16 words, or four. Long texts are taken whole, one at a time. Empty table: no
    rows. Extra columns are not read.
    """
    base = docs.select(
        F.monotonically_increasing_id().alias("row_id"), F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    id_type = base.schema["id"].dataType.simpleString()
    schema = f"row_id long, id {id_type}, text string, hashes array<long>, places array<long>"
    rows = stored(base.mapInArrow(_hashed, schema), "sentences")
    each = rows.select("row_id", "id", F.explode(F.arrays_zip("hashes", "places")).alias("x"))
    each = each.select("row_id", "id", F.col("x.hashes").alias("hash"), F.col("x.places").alias("place"))
    # counts only: a run that a third of all rows hold is summed in each task before anything moves
    # written, so that the joins read both sides anew and adaptive skew handling can split a hot run
    repeated = stored(each.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"), "repeated")
    occurrences = stored(each.join(repeated, "hash"), "occurrences")
    first = stored(occurrences.groupBy("hash").agg(F.min(F.struct("id", "row_id", "place")).alias("first")), "first")
    marked = occurrences.join(first, "hash").where(
        ~((F.col("first.row_id") == F.col("row_id")) & (F.col("first.place") == F.col("place")))
    )
    # at most as many as the text has runs
    by_row = marked.groupBy("row_id").agg(F.collect_list("place").alias("runs"))
    out = rows.select("row_id", "id", "text").join(by_row, "row_id", "inner" if touched_only else "left")
    names = f"row_id long, id {id_type}, n_sentences long, n_removed long, removed array<struct<start:long,end:long>>, text string"
    return out.select("row_id", "id", "text", "runs").mapInArrow(_removed, names)
