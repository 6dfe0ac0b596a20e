"""Suffix-array dedup of byte strings, with suffix arrays made by grouping (``lyndon``).

Every window of ``least`` bytes is dealt by its own content: the least hash of its strings of a quarter of the length (ties: the first) is its anchor, and the
bytes that all windows with the anchor at about the same place have in common are its key. Equal windows so have equal keys,
wherever they are. Windows next to each other with one anchor make a piece of text; a key that occurs once repeats nothing.
Equal pieces are counted once. The distinct pieces of a key, if there are several, make one short string, whose suffix array puts equal
windows side by side. A key with more than ``MOST`` distinct pieces is dealt anew: its pieces are cut by the place of the anchor, so that the
parts have more bytes in common, down to single windows, whose equal ones are one piece. So no key is ever too large.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cohortlens.llm import lyndon
from cohortlens.llm.store import apart, stored, whole_text
from cohortlens.llm.text import Powers, Ranges, byte_hashes, mixed, slices

LEAST = 200
CHUNK = 1 << 18  # window starts that are worked out together; longer texts go in several
STRINGS = 2 << 20  # bytes of strings that are ordered side by side; a task needs some sixty times as much
MOST = 512  # distinct pieces of a key
CUTS = (1, 4, 16)  # so many places of the anchor are told apart, and at last all
SEEN = 1 << 17  # pieces whose bytes a task remembers to have sent
HOT = 256  # a key with more than one in so many rows is dealt to several tasks
SALTS = 32
BITS = 12  # of a number of windows, or a place in one


def gram(least: int) -> int:
    """Bytes of an anchor: long ones repeat less by chance, short ones leave more windows to each."""
    return max(16, least // 4)


def bounds(places: int, cuts: int) -> np.ndarray:
    """Edges of the classes into which the places of an anchor are cut."""
    cuts = min(cuts, places)
    return np.arange(cuts + 1) * places // cuts


def anchors(data: np.ndarray, valid: np.ndarray, ranges: Ranges, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First start, number and place of the anchor in the first, of neighbouring windows with one anchor; only ``valid`` starts."""
    size = gram(least)
    places = least - size + 1
    n = len(valid)
    with np.errstate(over="ignore"):
        grams = mixed((ranges.upto[size:] - ranges.upto[:-size]) * ranges.down[: len(data) + 1 - size])
    # the lower bits hold the place, so that the first of equal hashes is the least; a chunk has fewer than 2**20 bytes
    least_hash = (grams & ~np.uint64((1 << 20) - 1)) | np.arange(len(grams), dtype=np.uint64)
    reach = 1
    while 2 * reach <= places:
        least_hash = np.minimum(least_hash[:-reach], least_hash[reach:])
        reach *= 2
    if reach < places:
        least_hash = np.minimum(least_hash[:n], least_hash[places - reach : places - reach + n])
    at = (least_hash[:n] & np.uint64((1 << 20) - 1)).astype(np.int64)
    at[~valid] = -1
    turn = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    count = np.diff(np.append(turn, n))
    real = at[turn] >= 0
    turn, count = turn[real], count[real]
    return turn, count, at[turn] - turn


def cut(start: np.ndarray, count: np.ndarray, place: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, ...]:
    """The windows of each piece by the class of the anchor's place: piece, first start, number, place, class."""
    low, high = np.searchsorted(edges, place - count + 1, side="right") - 1, np.searchsorted(edges, place, side="right") - 1
    n = high - low + 1
    own = np.repeat(np.arange(len(start)), n)
    kind = np.repeat(low, n) + np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
    most = np.minimum(place[own], edges[kind + 1] - 1)
    fewest = np.maximum((place - count + 1)[own], edges[kind])
    return own, start[own] + place[own] - most, most - fewest + 1, most, kind


def keys(ranges: Ranges, start: np.ndarray, place: np.ndarray, kind: np.ndarray, edges: np.ndarray, least: int) -> np.ndarray:
    """Hash of the bytes that all windows of the class have in common, wherever in it the anchor lies."""
    at = start + place
    return ranges(at - edges[kind], at - edges[kind + 1] + 1 + least, len(edges)) ^ mixed(kind.astype(np.uint64) + np.uint64(1))


def _pack(start: np.ndarray, count: np.ndarray, place: np.ndarray) -> np.ndarray:
    return (start << (2 * BITS)) | (count << BITS) | place


def _anchored(least: int):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, values, edges = Powers(), byte_hashes(), bounds(least - gram(least) + 1, CUTS[0])
        for batch in batches:
            for part in slices(batch["text"], CHUNK):
                docs, key, place = [], [], []
                for at in range(0, len(part.data), CHUNK):
                    data = part.data[at : at + CHUNK + least - 1]
                    n = len(data) - least + 1
                    if n <= 0:
                        break
                    # no window crosses the end of a text
                    ends = part.offsets[1:][(part.offsets[1:] > at) & (part.offsets[1:] < at + len(data))] - at
                    blocked = np.zeros(n + 1, np.int32)
                    np.add.at(blocked, np.clip(ends - least + 1, 0, n), 1)
                    np.add.at(blocked, np.minimum(ends, n), -1)
                    ranges = Ranges(data, values, powers)
                    start, count, where = anchors(data, np.cumsum(blocked[:-1]) == 0, ranges, least)
                    _, start, count, where, kind = cut(start, count, where, edges)
                    key.append(keys(ranges, start, where, kind, edges, least))
                    doc = np.searchsorted(part.offsets, start + at, side="right") - 1
                    docs.append(doc)
                    place.append(_pack(start + at - part.offsets[doc], count, where))
                doc, key, place = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (docs, key, place))
                own = batch.slice(part.first, part.n)
                lists = pa.array(np.searchsorted(doc, np.arange(part.n + 1)), pa.int32())
                columns = [pa.ListArray.from_arrays(lists, pa.array(x.view(np.int64))) for x in (key, place)]
                yield pa.RecordBatch.from_arrays([own["row_id"], own["id"], own["text"], *columns], names=["row_id", "id", "text", "keys", "places"])

    return go


PIECE = "key long, digest long, row_id long, start long, count int, place int, content binary"
PART = "root_key long, root_digest long, n long, start int, key long, digest long, count int, place int, content binary"


class Sent:
    """Gives the bytes of a piece once a task; the memory starts anew when it is full, which only costs bytes."""

    def __init__(self) -> None:
        self.seen: set[tuple[int, int]] = set()

    def __call__(self, key: np.ndarray, digest: np.ndarray, start: np.ndarray, end: np.ndarray, data: memoryview) -> list[bytes | None]:
        if len(self.seen) > SEEN:
            self.seen = set()
        out: list[bytes | None] = []
        for name, a, b in zip(zip(key.tolist(), digest.tolist()), start.tolist(), end.tolist()):
            if name in self.seen:
                out.append(None)
            else:
                self.seen.add(name)
                out.append(bytes(data[a:b]))
        return out


def _pieces(least: int):
    """Of each text the pieces whose keys occur more than once."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, values, sent = Powers(), byte_hashes(), Sent()
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch["text"][i].as_buffer()
                found = batch["found"].slice(i, 1).flatten()
                key, place = (found.field(c).to_numpy(zero_copy_only=False) for c in ("key", "place"))
                data = np.frombuffer(text, np.uint8)
                start, count, where = place >> (2 * BITS), place >> BITS & (1 << BITS) - 1, place & (1 << BITS) - 1
                by = np.argsort(start, kind="stable")
                key, start, count, where = key[by], start[by], count[by], where[by]
                end = start + count + least - 1
                # long texts in stretches, so that memory for hashes is bounded
                for a, b in _stretches(start, end, CHUNK):
                    lo, hi = int(start[a]), int(end[b - 1])
                    digest = Ranges(data[lo:hi], values, powers)(start[a:b] - lo, end[a:b] - lo, 7) + count[a:b].astype(np.uint64)
                    content = sent(key[a:b], digest, start[a:b], end[a:b], memoryview(text))
                    row = np.full(b - a, batch["row_id"][i].as_py())
                    numbers = [key[a:b].view(np.int64), digest.view(np.int64), row, start[a:b], count[a:b].astype(np.int32), where[a:b].astype(np.int32)]
                    columns = [*map(pa.array, numbers), pa.array(content, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=["key", "digest", "row_id", "start", "count", "place", "content"])

    return go


def _stretches(start: np.ndarray, end: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(end, start[at] + limit, side="right")))
        yield at, to
        at = to


def _split(least: int, cuts: int):
    """Cut distinct pieces further; a part knows the piece that it comes from, and where it starts in it."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, values, sent, edges = Powers(), byte_hashes(), Sent(), bounds(least - gram(least) + 1, cuts)
        for batch in batches:
            for part in slices(batch["content"], CHUNK):
                own = batch.slice(part.first, part.n)
                count, place = (own[c].to_numpy().astype(np.int64) for c in ("count", "place"))
                ranges = Ranges(part.data, values, powers)
                of, start, n, where, kind = cut(part.offsets[:-1], count, place, edges)
                key = keys(ranges, start, where, kind, edges, least)
                end = start + n + least - 1
                digest = ranges(start, end, 7) + n.astype(np.uint64)
                content = sent(key, digest, start, end, memoryview(part.data))
                base = own["start"].to_numpy()[of] + (start - part.offsets[of]).astype(np.int32)
                numbers = [own[c].to_numpy()[of] for c in ("root_key", "root_digest", "n")]
                numbers += [base, key.view(np.int64), digest.view(np.int64), n.astype(np.int32), where.astype(np.int32)]
                columns = [*map(pa.array, numbers), pa.array(content, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in PART.split(", ")])

    return go


def _ordered(least: int):
    """Windows of distinct pieces that occur more than once; rows of one key come together, in the order of their digests."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch["content"].nbytes
            if size > STRINGS:
                table = pa.Table.from_batches(held).combine_chunks()
                key = table["key"].to_numpy()
                # the last key may go on
                ready = int(np.searchsorted(key, key[-1]))
                if ready:
                    yield from repeated_windows(table.slice(0, ready), least)
                held = table.slice(ready).combine_chunks().to_batches()
                size = sum(b["content"].nbytes for b in held)
        if held:
            yield from repeated_windows(pa.Table.from_batches(held).combine_chunks(), least)

    return go


def repeated_windows(table: pa.Table, least: int) -> Iterator[pa.RecordBatch]:
    """``key, digest, first, last`` (windows of the piece, last exclusive) from ``key, digest, n, count, content``.

    A piece has a row with its numbers, and rows with its bytes from the tasks that met it, of which one is read.
    """
    if not table.num_rows:
        return
    key, digest = (table[c].to_numpy() for c in ("key", "digest"))
    numbers, bytes_ = (np.flatnonzero(table[c].is_valid().to_numpy()) for c in ("n", "content"))
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (digest[1:] != digest[:-1])])
    piece = np.cumsum(new) - 1
    content = np.full(piece[-1] + 1, -1)
    content[piece[bytes_[::-1]]] = bytes_[::-1]
    # pieces of keys that occur once have no numbers
    own = numbers[content[piece[numbers]] >= 0]
    content = content[piece[own]]
    if not len(own):
        return
    key, digest = key[own], digest[own]
    times, count = (table[c].take(pa.array(own)).to_numpy() for c in ("n", "count"))
    turn = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sizes = np.diff(np.append(turn, len(key)))
    string = np.repeat(np.arange(len(turn)), sizes)
    # one piece, as often as its key: all its windows are repeated, and there is nothing to put in order
    alone = np.flatnonzero(sizes[string] == 1)
    alone = alone[times[alone] > 1]
    if len(alone):
        columns = [pa.array(x) for x in (key[alone], digest[alone], np.zeros(len(alone), np.int32), count[alone].astype(np.int32))]
        yield pa.RecordBatch.from_arrays(columns, names=["key", "digest", "first", "last"])
    contents = table["content"]
    # all strings side by side: the longest one says how many steps there are, and those that have ended drop out
    rows = np.flatnonzero(sizes[string] > 1)
    if len(rows):
        texts = contents.take(pa.array(content[rows])).to_pylist()
        yield from _windows(texts, string[rows], key[rows], digest[rows], times[rows], count[rows], least)


def _windows(contents: list[bytes], string: np.ndarray, key: np.ndarray, digest: np.ndarray, times: np.ndarray, count: np.ndarray, least: int) -> Iterator[pa.RecordBatch]:
    data = np.frombuffer(b"".join(c + b"\0" for c in contents), np.uint8)
    length = np.array([len(c) + 1 for c in contents], np.int64)
    begin = np.cumsum(length) - length
    symbols = data.astype(np.int32) + 1
    symbols[begin + length - 1] = 0
    turn = np.flatnonzero(np.concatenate([[True], string[1:] != string[:-1]]))
    order = lyndon.suffix_orders(symbols, np.append(begin[turn], len(data)))
    own = count.astype(np.int64)
    windows = lyndon.ranges(begin, own)
    judged = np.zeros(len(data), bool)
    judged[windows] = True
    again = lyndon.equal_neighbours(data, order, judged, least)
    # a piece that occurs twice repeats all its windows
    hit = again[windows] | np.repeat(times > 1, own)
    piece, place = np.repeat(np.arange(len(own)), own), np.arange(len(windows)) - np.repeat(np.cumsum(own) - own, own)
    edge = np.flatnonzero(hit & ~np.concatenate([[False], hit[:-1] & (piece[1:] == piece[:-1])]))
    last = np.flatnonzero(hit & ~np.concatenate([hit[1:] & (piece[1:] == piece[:-1]), [False]]))
    r = piece[edge]
    columns = [pa.array(key[r]), pa.array(digest[r]), pa.array(place[edge], pa.int32()), pa.array(place[last] + 1, pa.int32())]
    yield pa.RecordBatch.from_arrays(columns, names=["key", "digest", "first", "last"])


def _matched(left: DataFrame, right: DataFrame, on: list[str], counts: DataFrame, by: str) -> DataFrame:
    """Inner join of many rows with few of each key; ``counts`` has the rows ``n`` of each ``key`` on the left. Hot keys are dealt out by ``by``."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    # fewer than HOT keys have more than one row in HOT
    hot = [r[0] for r in counts.where(F.col("n") > max(total / HOT, 10_000)).select("key").collect()]
    # one plan for all data: without hot keys every row has the salt 0 (a key that is not hot may be dealt out as well)
    is_hot = F.col("key").isin(hot or [0])
    salted = left.withColumn("_s", F.when(is_hot, F.pmod(F.xxhash64(by), F.lit(SALTS))).otherwise(0).cast("int"))
    every = right.withColumn("_s", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
    return salted.join(every, [*on, "_s"]).drop("_s")


NAME = ["key", "digest"]


def _contents(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``key, digest, content``, once for each distinct piece of some keys. A task has sent a piece's bytes about once."""
    sent = rows.where(F.col("content").isNotNull()).select(*NAME, "content").join(keys.select("key"), "key")
    return sent.groupBy(*NAME).agg(F.first("content").alias("content"))


def _windows_of(pieces: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """``key, digest, first, last`` (repeated windows of a piece, last exclusive), and ``key, n`` of the pieces."""
    # numbers only; a piece that many texts have is summed in each task before anything moves
    distinct = stored(pieces.groupBy(*NAME).agg(F.count("*").alias("n"), F.min("count").alias("count"), F.min("place").alias("place")), "distinct_pieces")
    counts = occurring = stored(distinct.groupBy("key").agg(F.sum("n").alias("n"), F.count("*").alias("pieces")).where("n > 1"), "pieces_of_keys")
    places = least - gram(least) + 1
    rows, parts, out, levels = pieces, None, None, [c for c in CUTS[1:] if c < places] + [places]
    while True:
        large, ready = None, counts
        if levels:
            # a table of its own, so that Spark knows how few they are
            large = stored(counts.where(F.col("pieces") > MOST).select("key"), "large_keys")
            ready = counts.where(F.col("pieces") <= MOST)
        if large is not None and large.isEmpty():
            large = None
        numbers = distinct.join(ready.select("key"), "key").select(*NAME, "n", "count", F.lit(None).cast("binary").alias("content"))
        sent = rows.where(F.col("content").isNotNull())
        if large is not None:
            sent = sent.join(large, "key", "left_anti")
        sent = sent.select(*NAME, F.lit(None).cast("long").alias("n"), F.lit(None).cast("int").alias("count"), "content")
        strings = apart(numbers.unionByName(sent), "key").sortWithinPartitions(*NAME)
        found = strings.mapInArrow(_ordered(least), "key long, digest long, first int, last int")
        if parts is not None:
            # windows of parts are windows of the pieces that they come from
            shift = [(F.col("start") + F.col(c)).alias(c) for c in ("first", "last")]
            own = _matched(parts.select("root_key", "root_digest", "start", *NAME), stored(found, "windows_of_parts"), NAME, counts, "root_digest")
            found = own.select(F.col("root_key").alias("key"), F.col("root_digest").alias("digest"), *shift)
        out = found if out is None else out.unionByName(found)
        if large is None:
            return stored(out, "windows"), occurring
        if parts is None:
            one = distinct.select(F.col("key").alias("root_key"), F.col("digest").alias("root_digest"), "n", F.lit(0).alias("start"), *NAME, "count", "place")
        else:
            one = parts.drop("content")
        wanted = counts.join(large, "key")
        whole = _matched(one, _contents(rows, wanted), NAME, wanted, "root_digest")
        cut_ = whole.select("root_key", "root_digest", "n", "start", "count", "place", "content").mapInArrow(_split(least, levels.pop(0)), PART)
        rows = parts = stored(cut_, "parts")
        distinct = stored(parts.groupBy(*NAME).agg(F.sum("n").alias("n"), F.min("count").alias("count")), "distinct_parts")
        counts = stored(distinct.groupBy("key").agg(F.sum("n").alias("n"), F.count("*").alias("pieces")).where("n > 1"), "parts_of_keys")


def _cut(least: int):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, kept, sizes = [], [], []
            texts, marked = batch["text"], batch["found"]
            for i in range(batch.num_rows):
                text = texts[i].as_buffer()
                sizes.append(len(text))
                if not marked[i].is_valid:
                    removed.append([])
                    kept.append(text.to_pybytes())
                    continue
                found = marked.slice(i, 1).flatten()
                first, last = (np.sort(found.field(c).to_numpy(zero_copy_only=False)) for c in ("first", "last"))
                # starts and ends in order: a gap is where all that began has ended
                last = last + least - 1
                gap = np.flatnonzero(first[1:] > last[:-1])
                start, end = first[np.concatenate([[0], gap + 1])], last[np.append(gap, len(last) - 1)]
                removed.append([{"start": int(a), "end": int(b)} for a, b in zip(start, end)])
                data = text.to_pybytes()
                kept.append(b"".join(data[a:b] for a, b in zip([0, *end.tolist()], [*start.tolist(), len(data)])))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            columns = [batch["id"], pa.array(sizes, pa.int64()), pa.array(removed, span), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n_bytes", "removed", "kept"])

    return go


def remove_repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """One row per row of ``docs``: ``id, n_bytes, removed`` (maximal runs of bytes, end exclusive) ``, kept`` (the bytes that are left).

    A byte goes if a string of ``least`` bytes (48 to 4,095) that covers it starts anywhere else as well, in this text or another; all
    occurrences go. Strings are judged on the texts as given, as UTF-8, and never cross two texts. A repeated row repeats all its
    strings, so both go whole if they are long enough; there are no ties. Null text: empty; shorter texts lose nothing. Long texts are
    taken whole: hashes in chunks, memory in proportion to the longest text. Equal strings are compared byte by byte, but for whole
    pieces of text, which are equal if two 64-bit hashes are. Empty table: no rows. Extra columns are not read.
    """
    if not 48 <= least < 1 << BITS:
        raise ValueError("least is 48 to 4,095 bytes")
    base = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    id_type = base.schema["id"].dataType.simpleString()
    # row numbers are fixed by this write
    rows = stored(base.mapInArrow(_anchored(least), f"row_id long, id {id_type}, text string, keys array<long>, places array<long>"), "anchors")
    each = rows.select("row_id", F.explode(F.arrays_zip("keys", "places")).alias("x")).select("row_id", F.col("x.keys").alias("key"), F.col("x.places").alias("place"))
    # counts only: summed in each task before anything moves
    repeated = stored(each.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "repeated")
    found = _matched(each, repeated.select("key"), ["key"], repeated, "row_id")
    # at most as many as the text has pieces
    by_row = found.groupBy("row_id").agg(F.collect_list(F.struct("key", "place")).alias("found"))
    pieces = stored(rows.select("row_id", "text").join(by_row, "row_id").select("row_id", "text", "found").mapInArrow(_pieces(least), PIECE), "pieces")
    windows, occurring = _windows_of(pieces, least)
    # at most one run for two windows of a piece
    runs = windows.groupBy(*NAME).agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    hits = _matched(pieces.select(*NAME, "row_id", "start"), runs, NAME, occurring, "row_id")
    ranges = F.transform("runs", lambda r: F.struct((F.col("start") + r["first"]).alias("first"), (F.col("start") + r["last"]).alias("last")))
    marks = hits.groupBy("row_id").agg(F.flatten(F.collect_list(ranges)).alias("found"))
    out = rows.select("row_id", "id", "text").join(marks, "row_id", "left").select("id", "text", "found")
    return out.mapInArrow(_cut(least), f"id {id_type}, n_bytes long, removed array<struct<start:long,end:long>>, kept binary")
