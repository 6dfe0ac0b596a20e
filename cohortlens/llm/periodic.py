"""Periodic runs of words: internal pattern matching over each text.

The words of some whole texts are one sequence, with a separator of its own after each text. Doubling gives the suffix
array and, on the way, a name for every block of 2^k words; equal names are equal blocks. For each k, every second aligned
block of a text asks where it occurs again within the next 2 * 2^k words: a range successor query in a wavelet tree over the
suffix array, on the interval of the block. Occurrences whose starts lie within one block length form a progression, so its
first terms, or the ends of the stretch that its step repeats over, give all periods that can be meant. A candidate is
extended both ways by names, from long blocks to short ones, and is a run if it is long enough.

Why that finds every run: with period q in (2^k, 2 * 2^k], a run has at least 4q words, so it holds a block that starts at a
multiple of 2 * 2^k and is followed by q more words of the run. That block occurs again q words later. Blocks of two
words also stand for the periods 1 and 2.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cohortlens.llm.store import whole_text
from cohortlens.llm.text import Hasher, Slice, Words, slices, words

LEAST = 6  # words of a run
TIMES = 4  # periods in a run; the search above needs four
SLICE = 1 << 18  # bytes of whole texts that share one suffix array, small enough for a core's own cache
RUN = "array<struct<start:long,length:long,period:long>>"


class WaveletTree:
    """Positions in suffix order, by their bits from the highest on: counts and order statistics of any interval."""

    def __init__(self, values: np.ndarray) -> None:
        self.levels = []
        for bit in range(max(1, int(len(values)).bit_length()) - 1, -1, -1):
            low = (values >> bit) & 1 == 0
            upto = np.zeros(len(values) + 1, np.int32)
            np.cumsum(low, out=upto[1:])
            self.levels.append((bit, upto, int(upto[-1])))
            values = np.concatenate([values[low], values[~low]])

    def below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values of each interval are less than ``x``."""
        n = np.zeros(len(lo), np.int32)
        for bit, upto, ones in self.levels:
            a, b = upto[lo], upto[hi]
            up = (x >> bit) & 1 == 1
            n += np.where(up, b - a, 0)
            lo, hi = np.where(up, ones + lo - a, a), np.where(up, ones + hi - b, b)
        return n

    def ranked(self, lo: np.ndarray, hi: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The value of each interval that has ``rank`` lesser ones."""
        out = np.zeros(len(lo), np.int32)
        for bit, upto, ones in self.levels:
            a, b = upto[lo], upto[hi]
            up = rank >= b - a
            out |= np.where(up, 1 << bit, 0)
            rank = np.where(up, rank - (b - a), rank)
            lo, hi = np.where(up, ones + lo - a, a), np.where(up, ones + hi - b, b)
        return out


class Blocks:
    """Suffix array and names of all blocks of 1, 2, 4, ... symbols; a symbol that occurs once ends all that is equal."""

    def __init__(self, symbols: np.ndarray, longest: int) -> None:
        n = len(symbols)
        self.order = np.argsort(symbols, kind="stable").astype(np.int32)
        ranked = symbols[self.order]
        first = np.ones(n, bool)
        first[1:] = ranked[1:] != ranked[:-1]
        self.names, self.ends = [], []
        size = 1
        while True:
            # the name of a block is where its group starts in the order
            starts = np.flatnonzero(first)
            length = np.diff(np.append(starts, n))
            name, end = np.empty(n, np.int32), np.empty(n, np.int32)
            name[self.order], end[self.order] = np.repeat(starts, length), np.repeat(starts + length, length)
            self.names.append(name)
            self.ends.append(end)
            open_slots = np.flatnonzero(np.repeat(length > 1, length))
            if not len(open_slots) or size >= longest:
                return
            # only groups of two or more are put in order by what follows; none of their blocks holds a separator
            place = self.order[open_slots]
            key = name[place].astype(np.int64) * n + name[place + size]
            by = np.argsort(key, kind="stable")
            self.order[open_slots] = place[by]
            key = key[by]
            first[open_slots[1:]] |= key[1:] != key[:-1]
            size *= 2

    def same_after(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal symbols from ``i`` and ``j`` (> i) on."""
        out = np.zeros(len(i), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            name, more = self.names[k], np.arange(len(i))
            while len(more):
                more = more[name[i[more] + out[more]] == name[j[more] + out[more]]]
                out[more] += 1 << k
                if k < len(self.names) - 1:
                    break  # longer blocks differ, so this length fits once at most
        return out

    def same_before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal symbols before ``i`` and ``j`` (> i)."""
        out = np.zeros(len(i), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            name, more = self.names[k], np.arange(len(i))
            while len(more):
                a, b = i[more] - out[more] - (1 << k), j[more] - out[more] - (1 << k)
                more = more[(a >= 0) & (name[np.maximum(a, 0)] == name[np.maximum(b, 0)])]
                out[more] += 1 << k
                if k < len(self.names) - 1:
                    break
        return out


def _asking(counts: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """Starts of every second aligned block of ``size`` words, in texts that can hold a run of such a period."""
    least = LEAST if size == 2 else TIMES * (size + 1)
    able = counts >= least
    n, at = np.where(able, -(-counts // (2 * size)), 0), first
    doc = np.repeat(np.arange(len(counts)), n)
    step = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    start = at[doc] + step * 2 * size
    return start[start + size < at[doc] + counts[doc]].astype(np.int32)


def runs(symbols: np.ndarray, counts: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of all runs. Text d is ``symbols[first[d] : first[d] + counts[d]]``, followed by a separator."""
    none = (np.zeros(0, np.int64),) * 3
    longest = int(counts.max(initial=0))
    if longest < LEAST:
        return none
    blocks = Blocks(symbols, max(2, longest // TIMES))
    tree, found = None, []
    for k in range(1, len(blocks.names)):
        size = 1 << k
        at = _asking(counts, first, size)
        at = at[blocks.ends[k][at] - blocks.names[k][at] > 1]
        if not len(at):
            continue
        tree = tree or WaveletTree(blocks.order)
        lo, hi = blocks.names[k][at], blocks.ends[k][at]
        rank = tree.below(lo, hi, at + 1)
        there = rank < hi - lo
        at, lo, hi, rank = (x[there] for x in (at, lo, hi, rank))
        near = tree.ranked(lo, hi, rank) <= at + 2 * size
        at, lo, hi = (x[near] for x in (at, lo, hi))
        for window in (0, size):
            most = at + window + size
            rank = tree.below(lo, hi, at + window + 1)
            n = tree.below(lo, hi, most + 1) - rank
            b, next_one = at[n > 0], tree.ranked(lo[n > 0], hi[n > 0], rank[n > 0])
            found.append((b, next_one - b))
            two = n > 1
            b, next_one, second = at[two], tree.ranked(lo[two], hi[two], rank[two]), tree.ranked(lo[two], hi[two], rank[two] + 1)
            found.append((b, second - b))
            # a progression of three or more: the block repeats by its step, and the stretches around both ends must match
            step, many = second - next_one, n[two] > 2
            b, next_one, step = b[many], next_one[many], step[many]
            gap = next_one - b
            found.append((b, gap + blocks.same_after(next_one, next_one + step) - blocks.same_after(b, b + step)))
            found.append((b, gap - blocks.same_before(next_one, next_one + step) + blocks.same_before(b, b + step)))
    if not found:
        return none
    b, q = (np.concatenate(x) for x in zip(*found))
    able = q > 0
    b, q = b[able], q[able]
    able = b + q < len(symbols)
    b, q = b[able], q[able]
    start, end = b - blocks.same_before(b, b + q), b + q + blocks.same_after(b, b + q)
    long = end - start >= np.maximum(LEAST, TIMES * q)
    start, end, q = start[long], end[long], q[long]
    # one stretch, found from many blocks and by multiples of its period
    by = np.lexsort((q, end, start))
    start, end, q = start[by], end[by], q[by]
    new = np.ones(len(q), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, q = start[new], end[new], q[new]
    by = np.lexsort((q, start))
    return start[by], end[by], q[by]


def _kept_text(part: Slice, found: Words, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The kept words of each text, joined by one space: bytes and offsets."""
    start, end, doc = found.start[kept], found.end[kept], found.doc[kept]
    more = np.zeros(len(doc), bool)
    more[:-1] = doc[1:] == doc[:-1]
    # a word that another one of its text follows has white space behind it, which becomes the one space
    edge = np.zeros(len(part.data) + 2, np.int8)
    edge[start] += 1
    edge[end + more] -= 1
    data = part.data.copy()
    data[end[more]] = 32
    take = np.cumsum(edge[: len(data)], dtype=np.int8) > 0
    sizes = np.bincount(doc, weights=end + more - start, minlength=part.n).astype(np.int64)
    return data[take], np.concatenate([[0], np.cumsum(sizes)])


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = Hasher(lower=False)
    for batch in batches:
        for part in slices(batch["text"], SLICE):
            found = words(part)
            counts = np.bincount(found.doc, minlength=part.n)
            first = np.cumsum(counts) - counts + np.arange(part.n)
            symbols = np.empty(len(found.doc) + part.n, np.int64)
            place = np.arange(len(found.doc)) + found.doc
            symbols[first + counts] = np.arange(part.n)
            symbols[place] = np.unique(hasher(part, found), return_inverse=True)[1] + part.n
            start, end, q = runs(symbols, counts, first)
            doc = np.searchsorted(first, start, side="right") - 1
            gone = np.zeros(len(symbols) + 1, np.int64)
            np.add.at(gone, start + q, 1)
            np.add.at(gone, end, -1)
            data, offsets = _kept_text(part, found, np.cumsum(gone[:-1])[place] == 0)
            fields = [pa.array(x, pa.int64()) for x in (start - first[doc], end - start, q)]
            each = pa.StructArray.from_arrays(fields, names=["start", "length", "period"])
            edges = pa.array(np.searchsorted(doc, np.arange(part.n + 1)), pa.int32())
            text = pa.LargeStringArray.from_buffers(part.n, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch["id"].slice(part.first, part.n), pa.ListArray.from_arrays(edges, each), text], names=["id", "runs", "text"]
            )


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id, runs, text``.

    ``runs`` are the longest stretches of words with smallest period q and at least ``max(6, 4 * q)`` words, as word number,
    length and period, by start, then period. ``text`` has the words that are not inside a run after its first period, joined by one space. Null or empty text, or
    one without words: no runs, empty text. Texts are taken whole, and memory follows the longest one (and
    slices of ``SLICE`` bytes of shorter ones). Repeated rows and null ids are rows like others; no ties are left open. Empty table: no rows. Extra columns are not read.
    """
    base = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    return base.mapInArrow(_find, f"id {base.schema['id'].dataType.simpleString()}, runs {RUN}, text string")
