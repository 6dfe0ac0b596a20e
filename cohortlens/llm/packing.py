"""Mixture-controlled packing: deficit round-robin over source queues, worked out for all documents at once.

In a round each source earns its share of a window and serves that many tokens from its queue, cutting documents where the credit
ends; the part of a token that is left is carried on. So after r rounds a source has served floor(r * quantum) tokens: no state passes from
task to task, and deficits carry across windows and partitions by construction. A round is a window long but for the
parts of tokens, so every window holds each source's share of it but for at most a token from each source. Places in queues are
running totals over hash ranges, each of which one task can hold; places in the stream follow from the round.
"""

from __future__ import annotations

import json
import math
import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from cohortlens.llm.store import stored, worker_state
from cohortlens.llm.text import slices

TOKENIZER = "word_bpe_49k.json"
WINDOW = 4096
END = 2
CACHED_WORDS = 300_000
_SIGN = rb"[!-&(-/:-@\[-`{-~]"  # ASCII signs but the apostrophe
# signs that end a word after a digit or a letter (a-z, or of U+00C0 to U+00FF); it begins with a sign, which is found faster than what is before
_LAST = re.compile(_SIGN + rb"(?:(?<=[a-z0-9].)|(?<=\xC3[\x80-\x96\x98-\xB6\xB8-\xBF].))" + _SIGN + rb"*+(?=[\x20\x09-\x0D]|\Z)")
SHARES = 10**6  # the largest weight as a whole number
TOGETHER = 1 << 20  # numbers of a table of rounds and sources
WORDS_AT_ONCE = 3 << 20  # bytes of text whose words are looked up together


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones themselves, others in turn from U+0100."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b) if b in plain else chr(next(rest)) for b in range(256)}


class WordIds:
    """Ids of texts by a tokenizer whose pieces never cross white space, and which folds case: each word is encoded rarely.

    What splits off in any case is split before words are looked up, so that fewer are different: A-Z become a-z, and the
    signs after a letter or digit that end a word stand alone. A test compares with encoding whole texts. Words that come again
    are kept, up to ``CACHED_WORDS``; those that came once are not, so rare words do not push out the others.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # without the steps that leave plain lower-case letters as they are; bytes of others are mapped here instead
        self.bare = Tokenizer.from_file(path)
        steps = json.loads(self.bare.to_str())
        folds = "Lowercase" in json.dumps(steps["normalizer"])
        self.short_cut = folds and '"ByteLevel"' in json.dumps(steps["pre_tokenizer"])
        if self.short_cut:
            self.bare.normalizer, self.bare.pre_tokenizer = None, None
        self.letters = _byte_letters()
        self.fold = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123))) if folds else bytes(range(256))
        self.special = [str(t).encode() for t in (x.content for x in self.tokenizer.get_added_tokens_decoder().values())]
        self.known: dict[bytes, bytes] = {}
        self.once = bytearray(1 << 21)
        # ids that fit two bytes are kept in two
        self.code = "H" if self.tokenizer.get_vocab_size() < 1 << 16 else "I"
        self.width = 2 if self.code == "H" else 4

    def _words(self, text: bytes) -> list[bytes]:
        if any(s.split(b"|")[0] in text and s.lower() in text.lower() for s in self.special):
            return text.split()  # special tokens are found as they stand
        return _LAST.sub(rb" \g<0>", text.translate(self.fold)).split()

    def _plain(self, word: bytes) -> str | None:
        """A word of Latin lower-case letters as the model sees it; none if other steps could change it."""
        if not self.short_cut:
            return None
        if word.isalpha() and word.islower():
            return word.decode("ascii")  # bytes know ASCII letters only
        text = word.decode()
        if not text.isalpha() or max(text) > "\u024f" or text.lower() != text:
            return None
        return text if text.isascii() else word.decode("latin-1").translate(self.letters)

    def _encoded(self, words: list[bytes]) -> dict[bytes, bytes]:
        seen = [self._plain(w) for w in words]
        plain, other = [w for w, x in zip(words, seen) if x is not None], [w for w, x in zip(words, seen) if x is None]
        code, out = self.code, {}
        for tokenizer, part, asked in ((self.bare, plain, [x for x in seen if x is not None]), (self.tokenizer, other, [w.decode() for w in other])):
            for at in range(0, len(part), 10_000):
                found = tokenizer.encode_batch_fast(asked[at : at + 10_000], add_special_tokens=False)
                out.update(zip(part[at : at + 10_000], [array(code, e.ids).tobytes() for e in found]))
        return out

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        split = [self._words(t) for t in texts]
        known = self.known
        here = self._encoded(list(set().union(*split).difference(known)))
        room = CACHED_WORDS - len(known)
        known.update(here)
        get = known.__getitem__
        out = [b"".join(map(get, words)) for words in split]
        for w in here:
            at = zlib.crc32(w) & 0xFFFFFF
            if not self.once[at >> 3] >> (at & 7) & 1:
                self.once[at >> 3] |= 1 << (at & 7)
                del known[w]
            elif room > 0:
                room -= 1
            else:
                del known[w]
        return out


def _encode(path: str, end: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = worker_state("ids_" + path, lambda: WordIds(path))
        last = array(ids.code, [end]).tobytes()
        for batch in batches:
            for part in slices(batch["text"], WORDS_AT_ONCE):
                data, edges = part.data.tobytes(), part.offsets.tolist()
                found = [x + last for x in ids([data[a:b] for a, b in zip(edges, edges[1:])])]
                own = batch.slice(part.first, part.n)
                yield pa.RecordBatch.from_arrays(
                    [own["row_id"], own["id"], own["source"], pa.array([len(x) // ids.width for x in found], pa.int64()), pa.array(found, pa.binary())],
                    names=["row_id", "id", "source", "n", "ids"],
                )
        pa.default_memory_pool().release_unused()

    return run


def encoded(docs: DataFrame, id_col: str, text_col: str, source_col: str, path: str, end: int) -> DataFrame:
    """``row_id, id, source, n, ids``: each row's ids with the end id, two or four bytes each, little-endian."""
    base = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col(id_col).alias("id"),
        F.col(source_col).cast("string").alias("source"),
        F.col(text_col).cast("string").alias("text"),
    )
    id_type = base.schema["id"].dataType.simpleString()
    return stored(base.mapInArrow(_encode(path, end), f"row_id long, id {id_type}, source string, n long, ids binary"), "encoded")


def _before(df: DataFrame, groups: list[str], block: str, order: list[str], value: str, name: str) -> DataFrame:
    """Add the sum of ``value`` over the rows before this one in (block, order), within ``groups``.

    One sum for each block, a running total over the blocks, and one within each block.
    """
    sums = df.groupBy(*groups, block).agg(F.sum(value).alias("_sum"))
    upto = F.sum("_sum").over(W.partitionBy(*groups).orderBy(block))
    blocks = sums.select(*[F.col(c).alias("_g_" + c) for c in groups], F.col(block).alias("_b"), (upto - F.col("_sum")).alias("_shift"))
    same = F.col(block) == F.col("_b")
    for c in groups:
        same &= F.col(c).eqNullSafe(F.col("_g_" + c))
    inside = F.sum(value).over(W.partitionBy(*groups, block).orderBy(*order)) - F.col(value)
    return (
        df.withColumn("_in", inside)
        .join(blocks, same)
        .withColumn(name, F.col("_in") + F.col("_shift"))
        .drop("_in", "_b", "_shift", *["_g_" + c for c in groups])
    )


def queued(lengths: DataFrame) -> DataFrame:
    """``row_id, queue_at`` from ``row_id, id, source, n``: the tokens before each row in the queue of its source."""
    rows = lengths.count()
    # about as many blocks as rows in a block, whatever the size
    blocks = 1 << max(0, math.ceil(math.log2(max(1, rows)) / 2))
    tag = F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit("")), "row_id")
    slot = F.floor(F.pmod(F.shiftrightunsigned("tag", 32), F.lit(1 << 32)) / F.lit((1 << 32) // blocks))
    placed = lengths.withColumn("tag", tag).withColumn("slot", slot)
    return _before(placed, ["source"], "slot", ["tag", "row_id"], "n", "queue_at").select("row_id", "queue_at")


class Rounds:
    """What each source has served after any number of rounds, in whole numbers.

    ``sizes`` has the tokens of each source, ``weights`` what it earns in a round, of ``window`` tokens for all together.
    """

    def __init__(self, sizes: list[int], weights: list[int], window: int) -> None:
        # numbers beyond 63 bits are Python's own
        longest = max((n * sum(weights) // w for n, w in zip(sizes, weights)), default=0) + 2 * window
        self.kind = np.int64 if longest * max([*weights, window]) < 1 << 62 and max(sizes, default=0) * sum(weights) < 1 << 62 else object
        self.sizes, self.weights = np.array(sizes, self.kind), np.array(weights, self.kind)
        self.all, self.window = sum(weights), window

    def served(self, turn: np.ndarray, source: np.ndarray) -> np.ndarray:
        return np.minimum(turn.astype(self.kind) * self.window * self.weights[source] // self.all, self.sizes[source]).astype(np.int64)

    def turns(self, token: np.ndarray, source: int) -> np.ndarray:
        """The round in which a token of the queue is served."""
        earned = self.window * self.weights[source]
        return (-(-(token.astype(self.kind) + 1) * self.all // earned)).astype(np.int64)

    def places(self, turn: np.ndarray, source: np.ndarray) -> np.ndarray:
        """Where in the stream a source begins in a round: all that was served before, and what sources before it serve."""
        out = np.zeros(len(turn), np.int64)
        rounds, row = np.unique(turn, return_inverse=True)
        at_once = max(1, TOGETHER // max(1, len(self.sizes)))
        for a in range(0, len(rounds), at_once):
            own = np.flatnonzero((row >= a) & (row < a + at_once))
            if len(own):
                every = np.arange(len(self.sizes))
                table = np.stack([self.served(rounds[a : a + at_once, None] - k, every[None, :]) for k in (1, 0)])
                before = table[0].sum(axis=1)[:, None] + np.cumsum(table[1] - table[0], axis=1) - (table[1] - table[0])
                out[own] = before[row[own] - a, source[own]]
        return out


def _pieces(rounds: Rounds, source: int, first: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Round, first token in the queue and number of tokens of each piece of a document."""
    last = first + n
    ends = rounds.turns(np.array([first, last - 1]), source)
    if ends[1] - ends[0] >= n:
        # fewer tokens than rounds: the round of each
        turn = np.unique(rounds.turns(np.arange(first, last), source))
    else:
        turn = np.arange(ends[0], ends[1] + 1)
    own = np.full(len(turn), source)
    start, end = np.maximum(rounds.served(turn - 1, own), first), np.minimum(rounds.served(turn, own), last)
    some = end > start
    return turn[some], start[some], (end - start)[some]


def _cut(window: int, tables: list[tuple[dict, list[int], list[int], int]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pieces of each document, one for each round in which it is served and each window that it then reaches into.

    ``tables`` has sources by name, their tokens and weights, and where their stream begins.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        streams = [(names, Rounds(sizes, weights, window), begin) for names, sizes, weights, begin in tables]
        for batch in batches:
            ids, n, queue = batch["ids"], batch["n"].to_numpy(), batch["queue_at"].to_numpy()
            sources, columns = batch["source"].to_pylist(), []
            for names, rounds, begin in streams:
                parts = []
                for row, source in enumerate(sources):
                    if source in names:
                        turn, start, length = _pieces(rounds, names[source], int(queue[row]), int(n[row]))
                        parts.append((np.full(len(turn), row), np.full(len(turn), names[source]), turn, start, length))
                if not parts:
                    continue
                row, source, turn, start, length = (np.concatenate(x) for x in zip(*parts))
                at = begin + rounds.places(turn, source) + start - rounds.served(turn - 1, source)
                start = start - queue[row]
                # a piece that crosses the end of a window goes on in the next
                crosses = np.repeat(np.arange(len(at)), (at + length - 1) // window - at // window + 1)
                k = np.arange(len(crosses)) - np.searchsorted(crosses, crosses)
                begins = np.maximum(at[crosses], (at[crosses] // window + k) * window)
                ends = np.minimum((at + length)[crosses], (at[crosses] // window + k + 1) * window)
                columns.append((row[crosses], start[crosses] + begins - at[crosses], ends - begins, begins))
            if not columns:
                continue
            row, start, length, at = (np.concatenate(x) for x in zip(*columns))
            by = np.lexsort((start, row))
            row, start, length, at = row[by], start[by], length[by], at[by]
            sums, wide, last = [], b"", -1
            for r, a, m in zip(row.tolist(), start.tolist(), length.tolist()):
                if r != last:
                    raw, last = ids[r].as_buffer(), r
                    wide = memoryview(np.frombuffer(raw, np.uint16 if len(raw) == 2 * n[r] else np.uint32).astype("<u4").tobytes())
                sums.append(zlib.crc32(wide[4 * a : 4 * (a + m)]))
            taken = pa.array(row, pa.int64())
            numbers = (start, length, np.array(sums, np.int64), n[row], at // window, at % window)
            yield pa.RecordBatch.from_arrays(
                [batch["id"].take(taken), batch["source"].take(taken), *[pa.array(c, pa.int64()) for c in numbers]],
                names=["id", "source", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    return run


def streams(sizes: dict[str | None, int], weights: Mapping[str, float] | None) -> list[tuple[dict, list[int], list[int], int]]:
    """The sources that are mixed, and after them those without a weight: names, tokens, whole weights, begin."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    if weights is None:
        parts = [(order, [sizes[s] for s in order])]
    else:
        mixed = [s for s in order if weights.get(s, 0) > 0]
        rest = [s for s in order if s not in set(mixed)]
        most = max((weights[s] for s in mixed), default=1)
        parts = [(mixed, [max(1, round(weights[s] / most * SHARES)) for s in mixed]), (rest, [sizes[s] for s in rest])]
    out, begin = [], 0
    for names, shares in parts:
        if names:
            out.append(({s: i for i, s in enumerate(names)}, [sizes[s] for s in names], shares, begin))
            begin += sum(sizes[s] for s in names)
    return out


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    window: int = WINDOW,
    weights: Mapping[str, float] | None = None,
    tokenizer: str | None = None,
    end: int = END,
) -> DataFrame:
    """One row per piece: ``id, source, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    ``weights`` are the target proportions by source; without them, each source's share of all tokens, so that all queues end
    together. Every window but the last is full, and holds each source's proportion but for a token from each source, while the
    queues last; sources without a weight come after the others. Null or empty text: the end id alone. A null source is a source of its
    own. Long texts are cut like others. Repeated rows are packed as often as they come; equal places in a queue go by row. Empty table: no
    rows. Extra columns are not read.
    """
    tokens = encoded(docs, id_col, text_col, source_col, tokenizer or tokenizer_path(), end)
    sizes = {r["source"]: r["n"] for r in tokens.groupBy("source").agg(F.sum("n").alias("n")).collect()}  # one row a source
    plan = queued(tokens.select("row_id", "id", "source", "n"))
    id_type = tokens.schema["id"].dataType.simpleString()
    names = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    rows = tokens.join(plan, "row_id").select("id", "source", "n", "queue_at", "ids")
    return rows.mapInArrow(_cut(window, streams(sizes, weights)), f"id {id_type}, source string, {names}")
