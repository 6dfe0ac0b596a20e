"""Nearest neighbors by cells against all pairs."""

import numpy as np
import pytest

from cohortlens.operators import pairs, pivots

from .conftest import rows

COLUMNS = ("id", "rank", "neighbor", "y", "distance")


def table(spark, v, y=None):
    y = np.zeros(len(v)) if y is None else y
    return spark.createDataFrame([(i, [float(x) for x in v[i]], float(y[i])) for i in range(len(v))], "id long, v array<double>, y double")


def groups(n, dims=4, seed=3, spread=0.05):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(n, dims)) * spread + rng.integers(0, 9, (n, 1)) * 1.0


def rounded(found):
    return [(*r[:4], round(r[4], 9)) for r in rows(found, *COLUMNS)]


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
@pytest.mark.parametrize("cells", [None, 1, 40])
def test_the_same_as_all_pairs(spark, monkeypatch, metric, cells):
    monkeypatch.setattr(pivots, "BASE_BLOCK", 30)
    monkeypatch.setattr(pivots, "QUERY_BLOCK", 20)
    # equal rows and whole numbers make many ties
    v = np.concatenate([groups(250), np.random.default_rng(1).integers(0, 3, (120, 4)), np.ones((60, 4))])
    df = table(spark, v, np.arange(len(v)) % 2)
    for skip in (True, False):
        assert rounded(pivots.nearest(df, df, 5, metric, skip, cells)) == rounded(pairs.nearest(df, df, 5, metric, skip))


def test_other_queries_few_rows_and_none(spark):
    base, queries = table(spark, groups(200)), table(spark, groups(50, seed=8)).select("id", "v")
    assert rounded(pivots.nearest(queries, base, 7)) == rounded(pairs.nearest(queries, base, 7))
    few = base.limit(3)
    assert rounded(pivots.nearest(queries, few, 7)) == rounded(pairs.nearest(queries, few, 7))
    assert pivots.nearest(queries, base.limit(0), 2).count() == 0 and pivots.nearest(queries.limit(0), base, 2).count() == 0


def test_grouped_rows_take_fewer_distances_than_half_of_the_pairs(spark):
    df = table(spark, groups(1_500, dims=3))
    found = pivots.nearest(df, df, 5, skip_same_id=True)
    took = {r["id"]: r["distances"] for r in found.select("id", "distances").collect()}
    assert len(took) == 1_500 and sum(took.values()) < 0.3 * 1_500**2


def test_vectors_move_once_for_each_block(spark, tmp_path, monkeypatch):
    """Uniform vectors open nearly all cells; what is written on the way must not hold a copy for each of them."""
    v = np.random.default_rng(4).uniform(size=(900, 16))
    df = table(spark, v)
    paths = iter(range(99))
    monkeypatch.setattr("cohortlens.session.shared_folder", lambda spark: f"{tmp_path}/{next(paths)}")
    assert pivots.nearest(df, df, 5, skip_same_id=True).count() == 4_500
    size = sum(f.stat().st_size for f in tmp_path.rglob("*.parquet"))
    assert size < 8 * v.nbytes


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_estimates_lose_no_neighbor(metric):
    rng = np.random.default_rng(6)
    for shift, scale in ((0, 1), (1e6, 1e-3), (0, 1e200), (1e-200, 1e-202)):
        b = rng.normal(size=(5_000, 12)) * scale + shift
        b[100:140] = b[:40]
        b[7, 3], b[8, 0] = np.inf, np.nan
        a, ids = b[:300], np.arange(len(b))
        best = pairs.Best(a, ids[:300], ids, pairs.Estimates(b, metric), 4)
        best.add(0, len(b))
        with np.errstate(all="ignore"):
            d = pairs.distances(a, b, metric)
        d[np.arange(300), np.arange(300)] = np.inf
        d[~np.isfinite(d)] = np.inf
        want = [(i, j, d[i, j]) for i in range(300) for j in np.argsort(d[i], kind="stable")[:4] if np.isfinite(d[i, j])]
        assert list(zip(best.row, best.col, best.distance)) == want


def test_copies_of_both_sides_are_balanced(spark, monkeypatch):
    """The base is copied once for every chunk of the queries; with several blocks fewer chunks are enough for all tasks."""
    monkeypatch.setattr(pairs, "CHUNK_ROWS", 10)
    df = table(spark, groups(400)).select("id", "v")
    met = pairs.block_pairs(df, df, lambda a, b: b[["id"]], "id long", block_rows=100)
    # 4 blocks and 16 tasks: 4 chunks
    assert {r[0] for r in met.groupBy("id").count().select("count").collect()} == {4}


@pytest.mark.parametrize("kind", ["normal", "outlier", "copies", "far queries"])
def test_codes_of_one_byte_leave_out_no_neighbor(monkeypatch, kind):
    monkeypatch.setattr(pairs, "COLUMN_TILE", 300)
    rng = np.random.default_rng(9)
    b = rng.normal(size=(1_500, 33)).astype(float)
    if kind == "outlier":
        b[17, 3] = 1e4
    if kind == "copies":
        b[700:] = b[:800]
    a = b[:200] if kind != "far queries" else b[:200] + np.where(np.arange(200) % 2, 50.0, 0.0)[:, None]
    estimates, ids = pairs.Estimates(b, "manhattan"), np.arange(len(b))
    # one number far off takes up the scale, so that codes would leave all pairs open
    assert estimates.coded == (kind != "outlier")
    best = pairs.Best(a, np.arange(200), ids, estimates, 7)
    best.add(0, len(b))
    d = pairs.distances(a, b, "manhattan")
    d[np.arange(200), np.arange(200)] = np.inf
    want = np.argsort(d, axis=1, kind="stable")[:, :7]
    assert (best.col.reshape(200, 7) == want).all() and (best.distance.reshape(200, 7) == np.take_along_axis(d, want, 1)).all()


def test_codes_settle_nearly_all_pairs():
    v = np.random.default_rng(10).normal(size=(4_000, 64))
    estimates = pairs.Estimates(v, "manhattan")
    guess, error = estimates(v[:100], 0, len(v))
    d = pairs.distances(v[:100], v, "manhattan")
    assert (np.abs(guess - d) <= error[:, None]).all()
    close, less = estimates(v[:100], 0, len(v), closely=True)
    assert (np.abs(close - d) <= less[:, None]).all() and (less < error / 100).all()
    row, col = np.nonzero(guess <= (np.sort(d, axis=1)[:, 12] + error)[:, None])
    some, less = estimates.closer(v[:100], row, col)
    assert (np.abs(some - d[row, col]) <= less[row]).all() and len(row) < 0.03 * d.size
