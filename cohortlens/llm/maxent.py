"""LM scoring: a hashed maximum-entropy model with n-gram and skip features and a class-factored softmax.

A word is predicted in three steps: its class from the words before it, its symbol within the class from the same and the
class, and, for symbols that many words share, the word from its count. The most frequent words are symbols of their own,
all others share the symbols of their last two bytes. Features (the word before, the word before that one, both) are hashed
into tables whose number of rows grows with the square root of the counted vocabulary.

Training: one pass counts words; one writes each token's symbol and a hash of its word, three bytes, so that texts are cut into words
twice and no more; one sums the observed features, and each further pass sums the expected ones under the model so far; the tables
move by their difference. Every pass covers all training rows, tasks send sums of one size, and these are added in steps.
Counts of words that are not among the most frequent stay in Spark: texts meet them in a join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cohortlens.llm.store import BLOCKS, added, in_blocks, in_fold, stored
from cohortlens.llm.text import Hasher, Slice, mixed, slices, words

FOLDS = 10
OWN, TAIL = 192, 64  # symbols that are one word, and those that many share
SIDE = 16  # classes, and symbols of a class
LEAST_CONTEXTS, MOST_CONTEXTS = 1 << 8, 1 << 16  # rows of a feature's table for classes: twice the root of the vocabulary
MEMBERS = 8  # times as many rows has the table for symbols within classes
CODES = 1 << 16  # hashes of a word that features are made of
FEATURES = 3
ROUNDS = 2
HOT_WORDS = 1 << 20  # whose counts are sent to all tasks: 16 MB at most
TOKENS_AT_ONCE = 1 << 15
END_HASH = np.uint64(0x1D8E4E27C47D124F)
DAMP = 4.0
RATE = 0.4


@dataclass
class Tables:
    """How large the tables of weights are: ``contexts`` rows for each feature and one without; rows for members and one a class."""

    contexts: int

    @classmethod
    def of(cls, vocabulary: int) -> Tables:
        rows = 1 << math.ceil(math.log2(2 * math.sqrt(max(vocabulary, 1))))
        return cls(min(max(rows, LEAST_CONTEXTS), MOST_CONTEXTS))

    @property
    def members(self) -> int:
        return MEMBERS * self.contexts

    @property
    def class_rows(self) -> int:
        return FEATURES * self.contexts + 1

    @property
    def member_rows(self) -> int:
        return self.members + SIDE

    @property
    def size(self) -> int:
        return (self.class_rows + self.member_rows) * SIDE

    def split(self, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        edge = self.class_rows * SIDE
        return theta[:edge].reshape(self.class_rows, SIDE), theta[edge:].reshape(self.member_rows, SIDE)


@dataclass
class Tokens:
    """All tokens of a slice, each document's end among them."""

    hash: np.ndarray
    tail: np.ndarray
    doc: np.ndarray


def tokens_of(part: Slice, hasher: Hasher) -> Tokens:
    found = words(part)
    hashes = hasher(part, found)
    lower = part.data[found.end - 1].astype(np.int64)
    upper = np.where(found.end - found.start > 1, part.data[np.maximum(found.end - 2, 0)], 0).astype(np.int64)
    fold = lambda b: np.where((b >= 65) & (b <= 90), b + 32, b)
    tail = (mixed((fold(lower) * 256 + fold(upper)).astype(np.uint64) + np.uint64(1)) % np.uint64(TAIL)).astype(np.int64)
    counts = np.bincount(found.doc, minlength=part.n)
    ends = np.cumsum(counts)
    hashes, tail = np.insert(hashes, ends, END_HASH), np.insert(tail, ends, 0)
    return Tokens(hashes, tail, np.repeat(np.arange(part.n), counts + 1))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = Hasher(lower=True)
    held: list[tuple[np.ndarray, ...]] = []
    size = 0

    def summed() -> tuple[np.ndarray, ...]:
        hashes, tails, counts = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(hashes, kind="stable")
        first = np.flatnonzero(np.r_[True, hashes[order][1:] != hashes[order][:-1]])
        return hashes[order][first], tails[order][first], np.add.reduceat(counts[order], first)

    for batch in batches:
        for part in slices(batch["text"]):
            t = tokens_of(part, hasher)
            found, at, n = np.unique(t.hash, return_index=True, return_counts=True)
            held.append((found, t.tail[at], n))
            size += len(found)
            if size > 1 << 20:
                held = [summed()]
                size = len(held[0][0])
                if size > 1 << 19:
                    yield _counted(held[0])
                    held, size = [], 0
    if held:
        yield _counted(summed())


def _counted(x: tuple[np.ndarray, ...]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x[0].view(np.int64)), pa.array(x[1], pa.int32()), pa.array(x[2], pa.int64())], names=["hash", "tail", "n"])


@dataclass
class Vocabulary:
    """What tasks need of the counts: of bounded size for any corpus. Travels as a dict, so that executors need not have this package."""

    own: np.ndarray  # hashes of words that are symbols, sorted
    own_symbol: np.ndarray
    hot: np.ndarray  # hashes of frequent words, sorted
    hot_count: np.ndarray
    n: int
    v: int
    tail_n: np.ndarray  # tokens and distinct words of each shared symbol
    tail_v: np.ndarray

    def symbols(self, t: Tokens) -> np.ndarray:
        out = OWN + t.tail
        if len(self.own):
            at = np.minimum(np.searchsorted(self.own, t.hash), len(self.own) - 1)
            out = np.where(self.own[at] == t.hash, self.own_symbol[at], out)
        return out

    def counts(self, hashes: np.ndarray) -> np.ndarray:
        """Counts of frequent words, -1 for others."""
        if not len(self.hot):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hot, hashes), len(self.hot) - 1)
        return np.where(self.hot[at] == hashes, self.hot_count[at], -1)


def vocabulary(counts: DataFrame) -> Vocabulary:
    n, v = counts.agg(F.sum("n"), F.count("*")).first()
    # a quarter of an octave is a step of the histogram
    step = F.floor(F.log2("n") * 4).cast("int")
    cut, total = 0, 0
    for s, k in sorted(counts.groupBy(step.alias("s")).count().collect(), reverse=True):
        if total + k > HOT_WORDS:
            cut = s + 1
            break
        total += k
    hot, own, tails = (
        {c: table[c].to_numpy() for c in table.column_names}
        for table in (
            counts.where(step >= cut).select("hash", "n").toArrow(),
            counts.orderBy(F.desc("n"), "hash").limit(OWN).select("hash", "tail", "n").toArrow(),
            counts.groupBy("tail").agg(F.sum("n").alias("n"), F.count("*").alias("v")).toArrow(),
        )
    )
    tail_n, tail_v = np.zeros(TAIL, np.int64), np.zeros(TAIL, np.int64)
    tail_n[tails["tail"]], tail_v[tails["tail"]] = tails["n"], tails["v"]
    np.subtract.at(tail_n, own["tail"], own["n"])
    np.subtract.at(tail_v, own["tail"], 1)
    rank = np.arange(len(own["hash"]))
    groups = OWN // SIDE
    symbol = (rank % groups) * SIDE + rank // groups
    hashes = own["hash"].view(np.uint64)
    by_hash, hot_hash = np.argsort(hashes), hot["hash"].view(np.uint64)
    order = np.argsort(hot_hash)
    return Vocabulary(hashes[by_hash], symbol[by_hash], hot_hash[order], hot["n"][order], int(n or 0), int(v), tail_n, tail_v)


def _encode(vocabulary_: dict):
    """Figures of the base score and, for each token, its symbol and a hash of its word; words without a frequent count go into lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, hasher = Vocabulary(**vocabulary_.value), Hasher(lower=True)
        for batch in batches:
            for part in slices(batch["text"]):
                t = tokens_of(part, hasher)
                symbols = vocab.symbols(t)
                count = vocab.counts(t.hash)
                hot = count >= 0
                base = np.where(hot, np.log10((np.maximum(count, 0) + 0.1) / (vocab.n + 0.1 * (vocab.v + 1))), 0.0)
                shared = symbols >= OWN
                s = np.where(shared, symbols - OWN, 0)
                within = np.log10((np.maximum(count, 0) + 0.1) / (vocab.tail_n[s] + 0.1 * (vocab.tail_v[s] + 1)))
                rare = np.flatnonzero(~hot)
                edges = pa.array(np.searchsorted(t.doc[rare], np.arange(part.n + 1)), pa.int32())
                lists = [pa.ListArray.from_arrays(edges, x) for x in (pa.array(t.hash[rare].view(np.int64)), pa.array(s[rare], pa.int32()))]
                own, n = batch.slice(part.first, part.n), np.bincount(t.doc, minlength=part.n)
                figures = [
                    pa.array(n, pa.int64()),
                    pa.array(np.bincount(t.doc[hot], minlength=part.n), pa.int64()),
                    pa.array(np.bincount(t.doc, base, minlength=part.n)),
                    pa.array(np.bincount(t.doc, np.where(shared & hot, within, 0.0), minlength=part.n)),
                ]
                ends = np.concatenate([[0], np.cumsum(n)])
                codes = _binary((t.hash % np.uint64(CODES)).astype("<u2"), ends)
                names = ["row_id", "id", "held_out", "n_tokens", "n_known", "base_score", "within", "rare", "rare_symbols", "codes", "symbols"]
                columns = [own["row_id"], own["id"], own["held_out"], *figures, *lists, codes, _binary(symbols.astype(np.uint8), ends)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = (ends * values.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def _values(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary column, and where each row starts and the last one ends."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    return np.frombuffer(data.tobytes(), kind), (offsets - offsets[0]) // np.dtype(kind).itemsize


def _chunks(batch: pa.RecordBatch, sizes: Tables) -> Iterator[tuple[np.ndarray, ...]]:
    """Class rows and member rows of the tables for each feature, and the class and member that came."""
    codes, edges = _values(batch["codes"], "<u2")
    symbols, _ = _values(batch["symbols"], "u1")
    # a place before and two places before a text's first token there is no word
    one, two = np.full(len(codes), CODES, np.uint64), np.full(len(codes), CODES, np.uint64)
    one[1:], two[2:] = codes[:-1], codes[:-2]
    first = edges[:-1][edges[:-1] < len(codes)]
    one[first] = two[first] = CODES
    second = first + 1
    two[second[second < len(codes)]] = CODES
    step, shift = np.uint64(0x9E3779B97F4A7C15), np.arange(FEATURES)[:, None] * sizes.contexts
    for a in range(0, len(codes), TOKENS_AT_ONCE):
        x, y, s = one[a : a + TOKENS_AT_ONCE], two[a : a + TOKENS_AT_ONCE], symbols[a : a + TOKENS_AT_ONCE]
        f = np.stack([mixed(x + np.uint64(1)), mixed((y + np.uint64(1)) << np.uint64(20)), mixed((x << np.uint64(20)) + (y << np.uint64(40)) + np.uint64(1))])
        c = (s // SIDE).astype(np.int64)
        rows = (f % np.uint64(sizes.contexts)).astype(np.int64) + shift
        members = (mixed(f + c.astype(np.uint64) * step) % np.uint64(sizes.members)).astype(np.int64)
        yield rows, members, c, (s % SIDE).astype(np.int64)


def _chances(table: np.ndarray, rows: np.ndarray, last: np.ndarray | int) -> np.ndarray:
    out = table.take(rows[0], axis=0)
    for r in rows[1:]:
        out += table.take(r, axis=0)
    out += table[last]
    np.exp(out, out=out)
    out /= out.sum(1, keepdims=True)
    return out


def _observed(contexts: int):
    """Observed feature sums over a task's rows, in blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Tables(contexts)
        total = np.zeros(sizes.size)
        edge = sizes.class_rows * SIDE
        for batch in batches:
            for rows, members, c, m in _chunks(batch, sizes):
                flat = np.concatenate([*(rows * SIDE + c), (sizes.class_rows - 1) * SIDE + c])
                total[:edge] += np.bincount(flat, minlength=edge)
                flat = np.concatenate([*(members * SIDE + m), (sizes.members + c) * SIDE + m])
                total[edge:] += np.bincount(flat, minlength=len(total) - edge)
        yield in_blocks(total.astype(np.float32))

    return run


def _expected(broadcast, contexts: int):
    """Expected feature sums over a task's rows, in blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Tables(contexts)
        tables, total = sizes.split(broadcast.value), np.zeros(sizes.size)
        by_class, by_member = sizes.split(total)
        # one symbol after the other: its sums stay in a core's own cache
        class_sums, member_sums = np.zeros((SIDE, FEATURES, contexts)), np.zeros((SIDE, sizes.members))
        shift = np.arange(FEATURES)[:, None] * contexts
        for batch in batches:
            for rows, members, c, _ in _chunks(batch, sizes):
                p, q = _chances(tables[0], rows, sizes.class_rows - 1), _chances(tables[1], members, sizes.members + c)
                by_class[-1] += p.sum(0, dtype=np.float64)
                by_member[sizes.members :] += np.eye(SIDE, dtype=np.float32)[c].T @ q
                rows, members = rows - shift, members.ravel()
                p, q = p.T.astype(np.float64), q.T.astype(np.float64)
                for j in range(SIDE):
                    for k in range(FEATURES):
                        class_sums[j, k] += np.bincount(rows[k], p[j], minlength=contexts)
                    member_sums[j] += np.bincount(members, np.concatenate([q[j]] * FEATURES), minlength=sizes.members)
        by_class[:-1] = class_sums.reshape(SIDE, -1).T
        by_member[: sizes.members] = member_sums.T
        yield in_blocks(total.astype(np.float32))

    return run


def start(observed: np.ndarray, sizes: Tables) -> np.ndarray:
    """First weights: what each feature says by itself, shared among the features."""
    out = np.zeros(sizes.size)
    (by_class, by_member), (w_class, w_member) = sizes.split(observed), sizes.split(out)
    rows, bias, member_bias = by_class[:-1], by_class[-1:], by_member[sizes.members :]
    chance = (bias + 1) / (bias + 1).sum(1, keepdims=True)
    w_class[-1:] = np.log(chance)
    w_member[sizes.members :] = np.log((member_bias + 1) / (member_bias + 1).sum(1, keepdims=True))
    seen = rows.sum(1, keepdims=True)
    # the rows for members do not know their class: they start at nothing, and the gradient fills them
    w_class[:-1] = np.log((rows + DAMP * SIDE * chance) / (seen + DAMP * SIDE) / chance) / FEATURES
    return out


def train_model(tokens: DataFrame, sizes: Tables, rounds: int = ROUNDS) -> np.ndarray:
    """Weights from ``codes, symbols`` of the training rows."""
    observed = added(tokens.mapInArrow(_observed(sizes.contexts), BLOCKS), sizes.size, "f4")
    theta = start(observed, sizes)
    for _ in range(rounds):
        model = tokens.sparkSession.sparkContext.broadcast(theta.astype(np.float32))
        expected = added(tokens.mapInArrow(_expected(model, sizes.contexts), BLOCKS), sizes.size, "f4")
        model.unpersist()
        theta += RATE * (observed - expected) / ((observed + expected) / 2 + DAMP)
    return theta


def _score(broadcast, contexts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Tables(contexts)
        tables = sizes.split(broadcast.value)
        for batch in batches:
            _, edges = _values(batch["symbols"], "u1")
            logs, at = np.zeros(int(edges[-1]) + 1), 0
            for rows, members, c, m in _chunks(batch, sizes):
                place = np.arange(len(c))
                p = _chances(tables[0], rows, sizes.class_rows - 1)[place, c].astype(np.float64)
                p *= _chances(tables[1], members, sizes.members + c)[place, m]
                logs[at : at + len(c)] = np.log10(np.maximum(p, 1e-300))
                at += len(c)
            # every text has a token at least, its end
            model = np.add.reduceat(logs, edges[:-1]) if batch.num_rows else np.zeros(0)
            names = ["row_id", "id", "held_out", "n_tokens", "n_known", "base_score", "within"]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in names), pa.array(model)], names=[*names, "model"])

    return run


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """``id, held_out, n_tokens, n_known, train_tokens, base_score, score``, one row per row of ``docs``.

    Learns from the rows whose crc32 of the id as text is not 0 modulo 10 (null id: empty text), all of them whole. Tokens: words,
    A-Z as a-z, then one end. Null or empty text: the end alone. Without training rows every word is unknown. Repeated rows
    get equal scores and count as often as they come; of equally frequent words, those with the lower hashes are symbols of their own.
    Long texts are taken whole, in chunks of tokens. Empty table: no rows. Extra columns are not read.
    """
    spark = docs.sparkSession
    base = docs.select(
        F.monotonically_increasing_id().alias("row_id"), F.col(id_col).alias("id"), in_fold(id_col, FOLDS).alias("held_out"), F.col(text_col).cast("string").alias("text")
    )
    counted = base.where(~F.col("held_out")).select("text").mapInArrow(_count, "hash long, tail int, n long")
    counts = stored(counted.groupBy("hash").agg(F.min("tail").alias("tail"), F.sum("n").alias("n")), "counts")
    vocab = vocabulary(counts)
    known = spark.sparkContext.broadcast(vars(vocab))
    own = f"row_id long, id {base.schema['id'].dataType.simpleString()}, held_out boolean, n_tokens long, n_known long, base_score double, within double"
    encoded = stored(base.mapInArrow(_encode(known), f"{own}, rare array<long>, rare_symbols array<int>, codes binary, symbols binary"), "tokens")
    known.unpersist()
    sizes = Tables.of(vocab.v)
    theta = train_model(encoded.where(~F.col("held_out")).select("codes", "symbols"), sizes, rounds)
    model = spark.sparkContext.broadcast(theta.astype(np.float32))
    scored = encoded.drop("rare", "rare_symbols").mapInArrow(_score(model, sizes.contexts), f"{own}, model double")
    rare = encoded.select("row_id", F.explode(F.arrays_zip("rare", "rare_symbols")).alias("x"))
    rare = rare.select("row_id", F.col("x.rare").alias("hash"), F.col("x.rare_symbols").alias("s"))
    # many documents may hold one unknown word: each is joined once for a document and symbol
    rare = rare.groupBy("row_id", "hash").agg(F.count("*").alias("k"), F.min("s").alias("s"))
    found = rare.join(counts.select("hash", "n"), "hash", "left")
    n = F.coalesce("n", F.lit(0))
    shares = F.array(*[F.lit(float(a + 0.1 * (b + 1))) for a, b in zip(vocab.tail_n.tolist(), vocab.tail_v.tolist())])
    terms = found.groupBy("row_id").agg(
        F.sum(F.when(n > 0, F.col("k")).otherwise(0)).alias("more_known"),
        F.sum(F.col("k") * F.log10((n + 0.1) / F.lit(float(vocab.n + 0.1 * (vocab.v + 1))))).alias("more_base"),
        F.sum(F.col("k") * F.log10((n + 0.1) / F.element_at(shares, F.col("s") + 1))).alias("more_score"),
    )
    none = F.lit(0)
    return scored.join(terms, "row_id", "left").select(
        "id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", none)).alias("n_known"),
        F.lit(vocab.n).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("more_base", none)).alias("base_score"),
        (F.col("model") + F.col("within") + F.coalesce("more_score", none)).alias("score"),
    )
