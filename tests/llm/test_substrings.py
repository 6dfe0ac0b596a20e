"""Repeated byte strings against brute force, suffix arrays against plain sorting."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from cohortlens.llm import lyndon, queries, substrings


def brute(texts, least):
    """Bytes of each text, runs that go and what is left: every window is counted."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + least] for d in data for i in range(len(d) - least + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, np.int64)
        for i in range(len(d) - least + 1):
            if seen[d[i : i + least]] > 1:
                gone[i] += 1
                gone[i + least] -= 1
        gone = np.cumsum(gone[:-1]) > 0
        turn = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
        out.append((len(d), [tuple(map(int, x)) for x in turn.reshape(-1, 2)], np.frombuffer(d, np.uint8)[~gone].tobytes()))
    return out


def found(out):
    return Counter((r["id"], r["n_bytes"], tuple((s["start"], s["end"]) for s in r["removed"]), bytes(r["kept"])) for r in out.collect())


def wanted(rows, least):
    return Counter((r[0], n, tuple(spans), kept) for r, (n, spans, kept) in zip(rows, brute([r[1] for r in rows], least)))


strings = st.lists(st.lists(st.lists(st.integers(1, 3), max_size=14), min_size=1, max_size=5), min_size=1, max_size=5)


@settings(max_examples=200, deadline=None)
@given(strings)
def test_suffix_orders_are_sorted(given_strings):
    flat = [[x for p in s for x in (*p, 0)] for s in given_strings]
    edges = np.cumsum([0] + [len(s) for s in flat])
    got = lyndon.suffix_orders(np.array([x for s in flat for x in s]), edges)
    for s, (a, b) in enumerate(zip(edges, edges[1:])):
        end = lambda i: flat[s].index(0, i)  # noqa: B023, E731
        assert [int(x - a) for x in got[a:b]] == sorted(range(len(flat[s])), key=lambda i: (flat[s][i : end(i) + 1], end(i)))  # noqa: B023


def test_suffix_orders_of_long_repeats():
    flat = [[2] * 300 + [0] + [2] * 200 + [0], [1, 2] * 100 + [0] + [2, 1] * 90 + [0], [3, 3, 3, 1] * 50 + [0]]
    edges = np.cumsum([0] + [len(s) for s in flat])
    got = lyndon.suffix_orders(np.array([x for s in flat for x in s]), edges)
    for s, (a, b) in enumerate(zip(edges, edges[1:])):
        end = lambda i: flat[s].index(0, i)  # noqa: B023, E731
        assert [int(x - a) for x in got[a:b]] == sorted(range(len(flat[s])), key=lambda i: (flat[s][i : end(i) + 1], end(i)))  # noqa: B023


@pytest.mark.parametrize("least", [48, 200])
def test_bytes_that_go_are_those_of_brute_force(spark, docs, rows, none, least):
    assert found(substrings.remove_repeated_bytes(docs, least=least)) == wanted(rows, least)
    assert substrings.remove_repeated_bytes(none).count() == 0


def hot_rows(n, seed=5):
    """A passage in every text at another place, texts of one letter, periodic texts, many copies of one text."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 8)))
    passage = " ".join(word() for _ in range(70))
    texts = [" ".join(word() for _ in range(rng.randint(0, 60))) + passage[rng.randint(0, 60) :] + " ".join(word() for _ in range(rng.randint(0, 40))) for _ in range(n)]
    texts += [passage * 3] * 20 + ["z" * k for k in (199, 200, 201, 700)] + ["abc" * 150, "bca" * 90, "é" * 130 + passage[:90], "x " * 99 + "x ", "x " * 99 + "x y"]
    return list(enumerate(texts))


@pytest.mark.parametrize("most", [64, 2])
def test_hot_passages_are_cut_further(spark, monkeypatch, most):
    monkeypatch.setattr(substrings, "MOST", most)
    monkeypatch.setattr(substrings, "HOT", 2_000)
    rows = hot_rows(300)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert found(substrings.remove_repeated_bytes(df)) == wanted(rows, 200)


def test_joins_that_change_while_they_run_lose_nothing(spark, monkeypatch):
    """Large tables: the joins below are planned as sorted ones, and Spark sends the smaller side around once it is seen to be small."""
    monkeypatch.setattr(substrings, "MOST", 8)
    rows = hot_rows(120)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k"}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        assert found(substrings.remove_repeated_bytes(df)) == wanted(rows, 200)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_chunks_and_batches_do_not_show(spark, monkeypatch):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcd") for _ in range(rng.randint(1, 5)))
    long = " ".join(word() for _ in range(4_000))
    rows = [(0, long), (1, long[3_000:9_000] + "?" + long[100:350]), (2, long[:199]), (3, long[-200:]), (4, long[5_000:5_200])]
    monkeypatch.setattr(substrings, "CHUNK", 1_000)
    monkeypatch.setattr(substrings, "STRINGS", 2_000)
    monkeypatch.setattr(substrings, "SEEN", 5)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert found(substrings.remove_repeated_bytes(df)) == wanted(rows, 200)


def test_op11_is_brute_force(spark, data):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    got = queries.QUERIES["op11_lyndon_substrings"](spark, data)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    want = [(r[0], n, sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest()) for r, (n, spans, kept) in zip(docs, brute([t for _, t in docs], 200))]
    assert Counter(tuple(r) for r in got.collect()) == Counter(want)
    assert sum(w[2] > 0 for w in want) > 10
