import hashlib
from collections import Counter, defaultdict

import pytest

from cohortlens.llm import exact, mixing
from cohortlens.llm.exact import ContentTable


def copies(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(-1 if r[0] is None else r[0])
    return groups


@pytest.mark.parametrize("bucket_bytes", [64 << 20, 5_000])
def test_groups_are_those_of_equal_texts(docs, rows, bucket_bytes):
    got = exact.exact_dedup(docs, bucket_bytes=bucket_bytes).collect()
    groups = copies(rows)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
    assert len(got) == len(rows)
    for r in got:
        ids = groups[by_sha[r["sha256"]]]
        assert r["group_size"] == len(ids) and (-1 if r["keep_id"] is None else r["keep_id"]) == max(ids)
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len(groups) and all(r["id"] == r["keep_id"] for r in kept)


def test_a_hot_text_in_many_tasks(spark):
    rows = [(i, "the same text " * 20 if i % 3 else f"text {i}", "en", "s", 1) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(8)
    got = exact.exact_dedup(df, bucket_bytes=2_000).where("group_size > 1").collect()
    assert len(got) == 400 and {r["group_size"] for r in got} == {400} and {r["keep_id"] for r in got} == {599}
    assert sum(r["kept"] for r in got) == 1


def test_the_table_compares_contents_not_hashes():
    table = ContentTable()
    assert [table.place(5, bytes([i % 7])) for i in range(2_000)] == [(i % 7, i < 7) for i in range(2_000)]
    assert table.place(5 + 1024, b"x") == (7, True)


def test_kept_rows_have_all_columns(docs, rows, none):
    got = exact.kept(docs)
    assert got.columns == docs.columns
    out = got.collect()
    assert Counter(r["text"] or "" for r in out) == Counter(copies(rows).keys())
    assert exact.kept(none).count() == 0 and exact.exact_dedup(none).count() == 0


def size(text):
    return len((text or "").encode().split())


def levels(sizes):
    """Targets by resharing what capped sources leave, round after round."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    capped, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return {**capped, **share}
        capped.update({s: 3.0 * sizes[s] for s in over})


def test_the_mix_takes_the_targets(docs, rows):
    got = mixing.mix(docs).collect()
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += size(r[1])
    want = levels(sizes)
    assert sorted((r["id"] is None, r["id"] or 0, r["size"]) for r in got) == sorted((r[0] is None, r[0] or 0, size(r[1])) for r in rows)
    taken = Counter()
    for r in got:
        taken[r["source"]] += r["taken"]
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["times"] * r["size"] + r["part"]
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)


def test_equal_tags_are_cut_exactly(spark):
    # one row many times over: its tag's first half is one value, so the levels go on to the second half
    rows = [(1, "a b c", "en", "s0", 1)] * 3_000 + [(i, "a", "en", "s1", 1) for i in range(2, 500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    got = mixing.mix(df).groupBy("source", "target").sum("taken").collect()
    assert len(got) == 2 and all(abs(r["target"] - r["sum(taken)"]) <= 1 for r in got)


def test_mixed_rows_are_copies_and_one_cut(docs, rows, none):
    got = mixing.mixed_rows(docs)
    assert got.columns == docs.columns
    words, want = Counter(), Counter()
    for r in got.collect():
        words[r["source"]] += size(r["text"])
        assert r["text"] in {x[1] for x in rows if x[0] == r["doc_id"]} or any((x[1] or "").startswith(r["text"]) for x in rows if x[0] == r["doc_id"])
    for r in mixing.mix(docs).collect():
        want[r["source"]] += r["taken"]
    assert +words == +want
    assert mixing.mix(none).count() == 0 and mixing.mixed_rows(none).count() == 0


def test_the_mix_runs_again_alike(docs):
    key = lambda df: sorted(map(str, df.select("id", "size", "source", "taken").collect()))
    assert key(mixing.mix(docs)) == key(mixing.mix(docs.repartition(7)))
