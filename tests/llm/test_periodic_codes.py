"""Runs and vector codes against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from cohortlens.llm import periodic, queries, vector_trie

SPACE = re.compile("[^\x20\x09-\x0d]+")


def brute_runs(words):
    """Every longest stretch with period q, for all q; the least q of a stretch counts."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((start, end - start, q) for (start, end), q in found.items())


def collapsed(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def sequences(docs):
    counts = np.array([len(d) for d in docs], np.int64)
    first = np.cumsum(counts) - counts + np.arange(len(docs))
    symbols = []
    for d, doc in enumerate(docs):
        symbols += [len(docs) + w for w in doc] + [d]
    start, end, q = periodic.runs(np.array(symbols, np.int64), counts, first)
    doc = np.searchsorted(first, start, side="right") - 1
    out = [[] for _ in docs]
    for d, s, e, p in zip(doc, start - first[doc], end - first[doc], q):
        out[d].append((int(s), int(e - s), int(p)))
    return out


piece = st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 9), st.integers(0, 9))
sequence = st.lists(piece, max_size=6).map(lambda ps: [w for u, n, cut in ps for w in (u * n)[: max(1, len(u) * n - cut)]])


@settings(max_examples=150, deadline=None)
@given(st.lists(sequence, min_size=1, max_size=5))
def test_runs_are_those_of_brute_force(docs):
    assert sequences(docs) == [brute_runs(d) for d in docs]


def test_runs_of_nested_periods_and_long_ones():
    inner = [1, 2] * 9 + [3]
    docs = [inner * 12, [7] * 3000, list(range(500)) * 5, [1, 1, 1, 1, 2] * 40 + [9], [0] * 5, [0] * 6, [4, 5, 6, 7] * 4, ([4, 5, 6, 7] * 4)[:-1]]
    assert sequences(docs) == [brute_runs(d) for d in docs]


def repeated(doc_id, text):
    words = SPACE.findall(text or "")
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def digests(doc_id, text):
    words = repeated(doc_id, text)
    runs = brute_runs(words)
    best = min(((-length, start, q) for start, length, q in runs), default=None)
    head = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (doc_id, len(runs), *head, sha(lines), sha(" ".join(collapsed(words, runs))))


def short(rows):
    # brute force takes the square of the words
    return [r for r in rows if len((r[1] or "").split()) < 2_000]


def test_op13_is_brute_force(spark, docs, rows, data, tmp_path):
    cases = [(i, "a b a b a b a b " * (i % 3) + f"x{i} " * (i % 9)) for i in range(300, 420)]
    more = [(*c, "en", "s", 1) for c in cases] + [r[:5] for r in short(rows)]
    spark.createDataFrame(more, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()
    assert Counter(tuple(r) for r in got) == Counter(digests(r[0], r[1]) for r in more)
    assert sum(r["n_runs"] > 0 for r in got) > 60
    given_texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    got = {r["doc_id"]: tuple(r) for r in queries.QUERIES["op13_periodic_runs"](spark, data).collect()}
    assert sorted(got) == sorted(i for i, _ in given_texts)
    for i, text in short(given_texts):
        assert got[i] == digests(i, text)


def test_runs_of_odd_rows(spark, docs, rows, none):
    got = periodic.collapse_runs(docs).collect()
    assert len(got) == len(rows)
    want = defaultdict(list)
    for r in short(rows):
        words = SPACE.findall(r[1] or "")
        want[r[0]].append(" ".join(collapsed(words, brute_runs(words))))
    short_ids = {r[0] for r in rows} - {r[0] for r in rows if len((r[1] or "").split()) >= 2_000}
    assert Counter((r["id"], r["text"]) for r in got if r["id"] in short_ids) == Counter((i, t) for i in short_ids for t in want[i])
    assert periodic.collapse_runs(none).count() == 0


def brute_codes(rows, parts=4, entries=256, rounds=4):
    """Contract in plain Python over rows of id, vector, label."""
    kept = [(i, [min(max(math.floor(1024 * x), -vector_trie.LARGEST), vector_trie.LARGEST) for x in v], label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) if kept else 0
    edges = [p * (width // parts) + min(p, width % parts) for p in range(parts + 1)]
    order = sorted(kept, key=lambda r: (r[0] is None, r[0], r[1]))[:entries]
    books = [[r[1][a:b] for r in order] for a, b in zip(edges, edges[1:])]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(book))

    for _ in range(rounds):
        for p, (a, b) in enumerate(zip(edges, edges[1:])):
            own = defaultdict(list)
            for r in kept:
                own[nearest(r[1][a:b], books[p])[1]].append(r[1][a:b])
            books[p] = [[sum(xs) // len(xs) for xs in zip(*own[j])] if own[j] else c for j, c in enumerate(books[p])]
    out = []
    for i, v, label in kept:
        best = [nearest(v[a:b], books[p]) for p, (a, b) in enumerate(zip(edges, edges[1:]))]
        out.append((i, label, "".join(f"{j:02x}" for _, j in best), sum(e for e, _ in best)))
    total = Counter()
    for _, label, _, e in out:
        total[label] += e
    digest = sha(",".join(str(x) for book in books for c in book for x in c))
    return [(i, code, e, total[label], digest) for i, label, code, e in out]


VECTORS = "vec_id long, embedding array<float>, label int, row int, values string, code int, part int"


def vector_rows(n, width, levels, seed=3):
    rng = random.Random(seed)
    rows = [(i, [rng.randrange(-levels, levels) / 64 for _ in range(width)], rng.choice([0, 1, None])) for i in range(n)]
    rows += [rows[4]] * 40 + [(n, None, 1), (n + 1, [], 1), (n + 2, [1.0] * (width - 1) + [None], 1), (n + 3, [float("nan")] + [1.0] * (width - 1), 1)]
    rows += [(n + 4, [float("inf")] + [0.0] * (width - 1), 0), (n + 5, [0.5] * (width + 1), 0), (3, [0.25] * width, 1)]
    return rows


@pytest.mark.parametrize(("n", "width", "entries", "levels"), [(300, 8, 256, 40), (300, 8, 16, 2), (60, 6, 256, 500), (9, 3, 4, 3)])
def test_codes_are_those_of_brute_force(spark, n, width, entries, levels):
    rows = vector_rows(n, width, levels)
    df = spark.createDataFrame([(*r, 1, "x", 1, 1) for r in rows], VECTORS).repartition(3)
    out, books = vector_trie.compress(df, entries=entries)
    got = [(r["id"], r["code"], r["error"], r["label_error"], vector_trie.digest(books)) for r in out.collect()]
    assert Counter(got) == Counter(brute_codes([r for r in rows if not r[1] or len(r[1]) == width], entries=entries))


def test_op12_is_brute_force(spark, data):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{data}/embeddings.parquet").collect()]
    got = queries.QUERIES["op12_vector_trie"](spark, data)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == Counter(brute_codes(rows))


def test_large_components_and_empty_tables(spark):
    rows = [(i, [(-1.0) ** i * 1e30, 3.0e38, float(i), 0.0], i % 2) for i in range(5)]
    out, books = vector_trie.compress(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), entries=3)
    assert Counter((r["id"], r["code"], r["error"], r["label_error"], vector_trie.digest(books)) for r in out.collect()) == Counter(brute_codes(rows, entries=3))
    out, books = vector_trie.compress(spark.createDataFrame([], "vec_id long, embedding array<float>, label int"))
    assert out.count() == 0 and vector_trie.digest(books) == sha("")
    out, _ = vector_trie.compress(spark.createDataFrame([(1, None, 1)], "vec_id long, embedding array<float>, label int"))
    assert out.count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 400), st.integers(1, 6), st.integers(1, 5), st.integers(1, 20), st.integers(0, 99))
def test_the_walk_is_a_plain_search(n, width, levels, entries, seed):
    rng = np.random.default_rng(seed)
    part, book = rng.integers(-levels, levels, (n, width)), rng.integers(-levels, levels, (entries, width))
    part = part[np.lexsort(part.T[::-1])]
    distance = ((part[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
    entry, error = vector_trie.walk(part, book)
    assert (entry == distance.argmin(axis=1)).all() and (error == distance.min(axis=1)).all()
