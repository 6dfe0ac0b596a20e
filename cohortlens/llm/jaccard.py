"""N-gram Jaccard join: a token-group matrix over groups of similar documents, exact for the given similarity.

A text's set holds the hashes of its distinct word n-grams. Equal sets are one class, whatever their number. Tokens are put
in one global order, rare ones first (by a count sketch of fixed size; any order is exact); two sets that link share ``more(n)`` of
the first ``n - need(n) + more(n)`` tokens of each, so only those are shuffled, and only classes are compared that share so many.

* Groups: each token is led by the class that shares the most tokens of all, the middle of its family; each class is compared
  with the leader that it shares the most with, and linked ones form a group. Dense families of copies collapse here.
  Classes without a link stay beside the group of the class that they share most with.
* Matrix: the tokens that still lie in two groups or more, and the blocks of at most ``MEMBERS`` neighbours that have them.
* Bound: a class meets a block if it shares as many leading tokens with it as a link takes, and is compared with
  the block's token union first; a set of n tokens that links to any member has at least ``need(n)`` of them in it.
* Open: only blocks that reach the bound are opened; one look-up counts what each member shares.

Components of all links, not pairs, leave the operator: a group of m copies costs m rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation, functions as F

from cohortlens.llm.store import BLOCKS, added, in_blocks, numbered, stored, without
from cohortlens.llm.text import Hasher, Slice, slices, windows, words

NGRAM = 5
PERCENT = 80
SKETCH = 1 << 20
MEMBERS = 64  # of a group in one block of the matrix
QUERIES = 256  # that meet one block in one task


def need(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Tokens that a set of ``n`` shares at least with any set that it links to."""
    return (percent * n + 99) // 100


def more(n: np.ndarray) -> np.ndarray:
    """Leading tokens that a set of ``n`` shares with any set of its size that it links to. Grows with ``n``."""
    return 1 + n // 20


def least_shared(n: Column, percent: int) -> Column:
    """``more`` of the smallest set that a set of ``n`` can link to."""
    smallest = F.floor((percent * n + 99) / 100)
    return 1 + F.floor(smallest / 20)


class Block:
    """Token union of some sets, and which of them has each token."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        tokens = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(tokens, kind="stable")
        self.owner, self.sizes = owner[order], np.array([len(s) for s in sets])
        self.union, first = np.unique(tokens[order], return_index=True)
        self.edges = np.append(first, len(tokens))

    def links(self, tokens: np.ndarray, percent: int) -> np.ndarray:
        """Numbers of the sets that ``tokens`` links to; none unless the union holds as many of them as a link takes."""
        at = np.minimum(np.searchsorted(self.union, tokens), len(self.union) - 1)
        at = at[self.union[at] == tokens]
        if len(at) < need(np.int64(len(tokens)), percent):
            return np.zeros(0, np.int64)
        lengths = self.edges[at + 1] - self.edges[at]
        places = np.repeat(self.edges[at] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        both = np.bincount(self.owner[places], minlength=len(self.sizes))
        return np.flatnonzero((100 * both >= percent * (len(tokens) + self.sizes - both)) & (both > 0))


def token_sets(part: Slice, hasher: Hasher, ngram: int = NGRAM) -> tuple[np.ndarray, np.ndarray]:
    """Document and hash of each distinct n-gram of a slice, sorted by both; a text with fewer words has one."""
    found = words(part)
    hashes, doc = hasher(part, found), found.doc
    runs = windows(hashes, ngram)
    whole = doc[: len(runs)] == doc[ngram - 1 : ngram - 1 + len(runs)]
    keys, owner = runs[whole], doc[: len(runs)][whole]
    counts = np.bincount(doc, minlength=part.n)
    ends = np.cumsum(counts)
    short = np.flatnonzero((counts > 0) & (counts < ngram))
    if len(short):
        more = [windows(hashes[ends[d] - counts[d] : ends[d]], int(counts[d]))[0] ^ np.uint64(counts[d]) for d in short]
        keys, owner = np.concatenate([keys, np.array(more, np.uint64)]), np.concatenate([owner, short])
    order = np.lexsort((keys, owner))
    keys, owner = keys[order], owner[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], keys[new]


def _sketch(ngram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, total = Hasher(lower=True), np.zeros(SKETCH, np.int64)
        for batch in batches:
            for part in slices(batch["text"]):
                _, keys = token_sets(part, hasher, ngram)
                total += np.bincount((keys % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH)
        yield in_blocks(total)

    return run


def _signature(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits of a sorted set, as two signed numbers."""
    x = xxhash.xxh3_128_intdigest(tokens.tobytes())
    high, low = x >> 64, x & 0xFFFFFFFFFFFFFFFF
    return high - (1 << 64) if high >> 63 else high, low - (1 << 64) if low >> 63 else low


def _prefixes(broadcast, ngram: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, sketch = Hasher(lower=True), broadcast.value
        for batch in batches:
            for part in slices(batch["text"]):
                doc, keys = token_sets(part, hasher, ngram)
                n = np.bincount(doc, minlength=part.n)
                first = np.concatenate([[0], np.cumsum(n)])
                signs = [_signature(keys[first[d] : first[d + 1]]) if n[d] else (0, 0) for d in range(part.n)]
                order = np.lexsort((keys, sketch[(keys % np.uint64(SKETCH)).astype(np.int64)], doc))
                place = np.arange(len(doc)) - first[doc]
                length = np.where(n > 0, np.minimum(n, n - need(n, percent) + more(n)), 0)
                taken = keys[order][place < length[doc]]
                edges = pa.array(np.concatenate([[0], np.cumsum(length)]), pa.int32())
                own = batch.slice(part.first, part.n)
                yield pa.RecordBatch.from_arrays(
                    [
                        own["row_id"],
                        own["id"],
                        pa.array(n, pa.int64()),
                        pa.array([s[0] for s in signs], pa.int64()),
                        pa.array([s[1] for s in signs], pa.int64()),
                        pa.ListArray.from_arrays(edges, pa.array(taken.view(np.int64))),
                    ],
                    names=["row_id", "id", "n", "high", "low", "prefix"],
                )

    return run


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SKETCH, np.int64)
    for batch in batches:
        total += np.bincount(batch["mark"].to_numpy().view(np.uint64) % np.uint64(SKETCH), minlength=SKETCH)
    yield in_blocks(total)


def _sets(broadcast, ngram: int):
    """Complete sets of the rows that may be the classes to compare, by a filter of fixed size; later joins take what they need."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, marked, sent = Hasher(lower=True), broadcast.value, set()
        for batch in batches:
            by_id = batch["mark"].to_numpy().view(np.uint64)
            for part in slices(batch["text"]):
                doc, keys = token_sets(part, hasher, ngram)
                edges = np.searchsorted(doc, np.arange(part.n + 1))
                signs, out = [], []
                for d in np.flatnonzero(np.diff(edges)):
                    tokens = keys[edges[d] : edges[d + 1]]
                    sign = _signature(tokens)
                    if sign not in sent and marked[int(by_id[part.first + d] ^ np.uint64(sign[0] & 0xFFFFFFFFFFFFFFFF)) % SKETCH]:
                        sent.add(sign)
                        signs.append(sign)
                        out.append(tokens.tobytes())
                lists = [pa.array([x[i] for x in signs], pa.int64()) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([*lists, pa.array(out, pa.binary())], names=["high", "low", "tokens"])

    return run


def _open(percent: int):
    """Links between the members (role 0) of one block and the queries (role 1) that came to it, one for each other component."""

    def run(table: pa.Table) -> pa.Table:
        sets: tuple[dict, dict] = ({}, {})
        for role, cid, comp, tokens in zip(table["role"].to_pylist(), table["cid"].to_pylist(), table["comp"].to_pylist(), table["tokens"]):
            sets[role][cid] = (comp, np.frombuffer(tokens.as_buffer(), np.uint64))
        found = []
        if sets[0]:
            names, block = list(sets[0]), Block([t for _, t in sets[0].values()])
            for cid, (comp, tokens) in sets[1].items():
                done = {comp}
                for i in block.links(tokens, percent):
                    other = sets[0][names[i]][0]
                    if other not in done:
                        done.add(other)
                        found.append((cid, names[i]))
        return pa.table({"a": pa.array([x[0] for x in found], pa.int64()), "b": pa.array([x[1] for x in found], pa.int64())})

    return run


def open_groups(sets: DataFrame, classes: DataFrame, members: DataFrame, queries: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` between the ``cid`` of ``queries`` and of ``members`` with the same ``gid``.

    ``classes`` has ``cid, comp, high, low``. A block that many queries meet is repeated for each ``QUERIES`` of them.
    """
    parts = queries.groupBy("gid").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("parts"))
    asked = queries.join(parts, "gid").select("gid", F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("role"), "cid")
    there = members.join(parts, "gid").select("gid", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role"), "cid")
    rows = asked.unionByName(there).join(classes.select("cid", "comp", "high", "low"), "cid").join(sets, ["high", "low"])
    return rows.select("gid", "part", "role", "cid", "comp", "tokens").groupBy("gid", "part").applyInArrow(_open(percent), "a long, b long")


def pointed(links: DataFrame) -> DataFrame:
    """``cid, top`` from links ``a`` to its leader ``b``: the leader's leader's ... leader, four steps up. Leaders have more weight, so no way is a circle.

    A family that takes more steps is left in several groups, which the matrix compares.
    """
    up = stored(links.select(F.col("a").alias("cid"), F.col("b").alias("top")), "leaders")
    # only a leader's own way goes on
    way = up.join(up.select(F.col("top").alias("cid")).distinct(), "cid")
    for _ in range(2):
        on = way.select(F.col("cid").alias("top"), F.col("top").alias("next"))
        way = way.join(on, "top", "left").select("cid", F.coalesce("next", "top").alias("top"))
    on = way.select(F.col("cid").alias("top"), F.col("top").alias("next"))
    return up.join(on, "top", "left").select("cid", F.coalesce("next", "top").alias("top"))


def contracted(links: DataFrame) -> DataFrame:
    """``cid, comp`` of all that ``links`` (``a, b``) touch; the least cid names a component."""
    edge = links.where("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct()
    edge = stored(edge.unionByName(edge.select(F.col("v").alias("u"), F.col("u").alias("v"))), "edges")
    to = stored(edge.groupBy(F.col("u").alias("x")).agg(F.least(F.min("v"), F.col("x")).alias("to")), "to")
    step, changed = 0, True
    while changed:
        # the least name among the neighbours, then the name of that one
        seen = edge.join(to.select(F.col("x").alias("v"), "to"), "v").groupBy(F.col("u").alias("x")).agg(F.min("to").alias("near"))
        lower = to.join(seen, "x").select("x", F.least("to", "near").alias("mid"), F.col("to").alias("was"))
        jump = to.select(F.col("x").alias("mid"), F.col("to").alias("jump"))
        step += 1
        # the write itself counts what moved: no job of its own for that
        moves = Observation()
        moved = lower.join(jump, "mid", "left").select("x", F.least("mid", F.coalesce("jump", "mid")).alias("to"), "was")
        to = stored(moved.observe(moves, F.count(F.when(F.col("to") != F.col("was"), 1)).alias("n")), f"step_{step}").select("x", "to")
        changed = moves.get["n"] > 0
    return to.withColumnsRenamed({"x": "cid", "to": "comp"})


def components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram: int = NGRAM, percent: int = PERCENT, row_col: str | None = None
) -> DataFrame:
    """One row per row of ``docs``: ``row_id, id, n_shingles, component_id`` (the least id that links reach, its own included)
    ``, component`` (a row number of the component, null for empty sets).

    Words are lower-cased (A-Z). Null text or no words: an empty set, linked with nothing. Fewer words than ``ngram``: the whole
    sequence is the one token. Repeated rows are linked. A null id is no least id unless a component has no other. Empty table:
    no rows. Other columns are not read, but for ``row_col``, a unique number for each row, if given. Two sets link when 100 x intersection >= ``percent`` x union.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    counts = added(texts.select("text").mapInArrow(_sketch(ngram), BLOCKS), SKETCH, "i8")
    sketch = spark.sparkContext.broadcast(np.minimum(counts, np.iinfo(np.uint32).max).astype(np.uint32))
    id_type = texts.schema["id"].dataType.simpleString()
    number = F.col(row_col) if row_col else F.monotonically_increasing_id()
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), number.alias("row_id"))
    schema = f"row_id long, id {id_type}, n long, high long, low long, prefix array<long>"
    rows = stored(base.mapInArrow(_prefixes(sketch, ngram, percent), schema), "prefixes")
    full = rows.where("n > 0")
    classes = stored(full.groupBy("high", "low").agg(F.min("row_id").alias("cid"), F.min("id").alias("least"), F.count("*").alias("rows")), "classes")
    # rows that repeat a class go, not their prefixes through a shuffle
    several = classes.where("rows > 1").select("high", "low", "cid")
    copies = full.select("row_id", "high", "low").join(several, ["high", "low"]).where("row_id <> cid").select(F.col("row_id").alias("_copy"))
    reps = full.join(copies, full["row_id"] == copies["_copy"], "left_anti").withColumnRenamed("row_id", "cid")
    each = reps.select("cid", F.explode("prefix").alias("token"))
    shared = each.groupBy("token").count().where("count > 1").select("token")
    enough = least_shared(F.col("n"), percent)
    common = stored(each.join(shared, "token"), "shared")
    many = common.groupBy("cid").count().join(reps.select("cid", "n", F.size("prefix").alias("leading"), "id", "high", "low"), "cid")
    wanted = stored(many.where(F.col("count") >= enough).drop("count"), "active")
    mark = F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit("")))
    marks = added(wanted.select(mark.bitwiseXOR(F.col("high")).alias("mark")).mapInArrow(_marks, BLOCKS), SKETCH, "i8") > 0
    marked = spark.sparkContext.broadcast(marks)
    sets = stored(texts.select("text", mark.alias("mark")).mapInArrow(_sets(marked, ngram), "high long, low long, tokens binary"), "sets")
    # what is written needs them no more
    sketch.unpersist()
    marked.unpersist()
    postings = common.join(wanted.select("cid", "n", "leading"), "cid")
    # the class whose tokens are shared the most is the middle of its family
    held = postings.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    middle = postings.join(held, "token").groupBy("cid").agg(F.sum("df").alias("weight"))
    postings = stored(postings.join(held.select("token"), "token").join(middle, "cid"), "postings")
    leads = postings.groupBy("token").agg(F.max(F.struct("weight", "cid"))["cid"].alias("gid"))
    asked = postings.join(leads, "token").where("cid <> gid").groupBy("cid", "leading", "gid").count()
    best = asked.groupBy("cid", "leading").agg(F.max(F.struct("count", "gid")).alias("best")).select("cid", "leading", "best.gid", "best.count")
    best = stored(best, "best")
    classes_ = wanted.select("cid", "high", "low", F.col("cid").alias("comp"))
    # linked sets share most of what leads them; what this misses is left to the matrix
    queries = best.where(2 * F.col("count") >= F.col("leading")).select("gid", "cid")
    leaders = queries.select("gid").distinct().withColumn("cid", F.col("gid"))
    led = stored(open_groups(sets, classes_, leaders, queries, percent), "group_links")
    labels = classes_.select("cid").join(pointed(led), "cid", "left").select("cid", F.coalesce("top", "cid").alias("comp"))
    near = classes_.drop("comp").join(best.select("cid", F.col("gid").alias("near")), "cid", "left")
    classes_ = stored(near.withColumn("near", F.coalesce("near", "cid")).join(labels, "cid"), "groups")
    # the matrix: tokens that lie in several groups, and the blocks of neighbours that have them
    sizes = classes_.groupBy("comp").agg(F.count("*").alias("size"))
    families = classes_.select(F.col("cid").alias("near"), F.col("comp").alias("family"))
    near = classes_.join(families, "near").join(sizes, "comp").withColumn("family", F.when(F.col("size") > 1, F.col("comp")).otherwise(F.col("family")))
    wide = near.groupBy("family").agg(F.ceil(F.count("*") / MEMBERS).alias("blocks"))
    blocks = near.join(wide, "family").withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")))
    blocks = stored(blocks.select("cid", "comp", "size", F.xxhash64("family", "block").alias("gid")), "blocks")
    known = postings.join(blocks, "cid")
    open_ = known.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("token")
    left = stored(known.join(open_, "token").select("token", "cid", "n", F.struct("size", "comp").alias("own"), "gid"), "left")
    matrix = left.groupBy("token", "gid").agg(F.max("own").alias("most"))
    # of two groups, the smaller asks the larger
    shares = left.drop("gid").join(matrix, "token").where(F.col("own") < F.col("most")).groupBy("gid", "cid", "n").count()
    queries = stored(shares.where(F.col("count") >= enough).select("gid", "cid"), "matrix_queries")
    links = stored(open_groups(sets, classes_, blocks.select("gid", "cid"), queries, percent), "matrix_links")
    labels = contracted(led.unionByName(links))
    named = classes.join(labels, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    least = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    by_class = named.join(least, "comp").select("high", "low", "component_id", F.col("comp").alias("component"))
    out = rows.select("row_id", "id", "n", "high", "low").join(by_class, ["high", "low"], "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select("row_id", "id", F.col("n").alias("n_shingles"), own.alias("component_id"), "component")


def kept(docs: DataFrame, **options) -> DataFrame:
    """The row with the least id (then row number) of each group, and all rows without words, with all their columns."""
    rows, number = numbered(docs, "numbered")
    found = stored(components(rows, row_col=number, **options).where("n_shingles > 0"), "components")
    first = F.min(F.struct(F.col("id").isNull(), F.col("id"), F.col("row_id"))).alias("first")
    # partial sums shrink a large group before it moves
    stays = found.groupBy("component").agg(first).select(F.col("first.row_id").alias("stays"))
    gone = found.join(stays, F.col("row_id") == F.col("stays"), "left_anti").select("row_id")
    return without(rows, number, gone)
