import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from cohortlens.llm import jaccard, links, rules, spans
from cohortlens.llm.text import Hasher, slices
from tests.llm.conftest import frame, invented


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(rows):
    """(id, set size, least id) of each row, by comparing all pairs."""
    sets = [shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                parent[root(a)] = root(b)
    least = defaultdict(lambda: None)
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = r[0] if least[root(i)] is None else min(least[root(i)], r[0])
    found = Counter((r[0], len(sets[i]), least[root(i)]) for i, r in enumerate(rows))
    return found, len({root(i) for i in range(len(rows))})


def test_components_equal_brute_force(docs, rows, none):
    got = jaccard.components(docs).collect()
    assert Counter((r["id"], r["n_shingles"], r["component_id"]) for r in got) == brute_components(rows)[0]
    assert jaccard.components(none).count() == 0 and jaccard.kept(none).count() == 0


def test_families_at_the_threshold(spark, monkeypatch):
    """Families whose members differ from each other by about a fifth, so leaders alone do not find every link."""
    monkeypatch.setattr(jaccard, "MEMBERS", 3)
    monkeypatch.setattr(jaccard, "QUERIES", 2)
    rng = random.Random(2)
    rows = []
    for _ in range(6):
        base = invented(rng, 70)
        for _ in range(12):
            words = list(base)
            for at in rng.sample(range(70), rng.choice([0, 1, 1, 2, 2, 3])):
                words[at] = f"w{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(words), "en", "s", 1))
    got = jaccard.components(frame(spark, rows)).collect()
    assert Counter((r["id"], r["n_shingles"], r["component_id"]) for r in got) == brute_components(rows)[0]


def test_one_row_of_each_group_is_kept(docs, rows):
    out = jaccard.kept(docs)
    assert out.columns == docs.columns
    assert out.count() == brute_components(rows)[1]


def test_a_block_links_by_the_jaccard_rule():
    rng = np.random.default_rng(1)
    some = lambda: np.unique(rng.integers(0, 30, rng.integers(1, 25))).astype(np.uint64)
    for _ in range(200):
        sets, a = [some() for _ in range(5)], some()
        want = [i for i, b in enumerate(sets) for both in [len(np.intersect1d(a, b))] if both and 100 * both >= 80 * (len(a) + len(b) - both)]
        assert jaccard.Block(sets).links(a, 80).tolist() == want


def repeated_windows(rows, k=50):
    """Windows of ``k`` words that two texts share."""
    seen = defaultdict(set)
    for i, r in enumerate(rows):
        w = (r[1] or "").split()
        for a in range(len(w) - k + 1):
            seen[tuple(w[a : a + k])].add(i)
    return {w: d for w, d in seen.items() if len(d) > 1}


def test_shared_passages_stay_once(docs, rows, none):
    out = spans.remove_repeats(docs).collect()
    assert len(out) == len(rows) and spans.remove_repeats(none).count() == 0
    by_id = defaultdict(list)
    for r in rows:
        by_id[r[0]].append(r[1] or "")
    for r in out:
        # what is left and what was cut make up the text
        ok = []
        for text in by_id[r["id"]]:
            left, at = "", 0
            for s in r["removed"]:
                left, at = left + text[at : s["start"]], s["end"]
            ok.append(left + text[at:] == r["text"])
        assert any(ok)
    again = repeated_windows([(r["id"], r["text"]) for r in out])
    assert repeated_windows(rows) and not again


def test_unique_texts_are_left_alone(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(invented(rng, 200, 4000)), "en", "s", 1) for i in range(40)]
    assert all(r["n_removed"] == 0 for r in spans.remove_repeats(frame(spark, rows)).collect())
    assert spans.remove_repeats(frame(spark, rows), touched_only=True).count() == 0


def test_a_passage_without_any_signs_is_found(spark):
    rng = random.Random(4)
    words = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    hit = 0
    for trial in range(3):
        passage = words(70)
        rows = [(i, words(40) + " " + (passage + " " if i in (3, 11) else "") + words(40), "en", "s", 1) for i in range(15)]
        touched = {r["id"] for r in spans.remove_repeats(frame(spark, rows), touched_only=True).collect()}
        assert touched <= {11}
        hit += touched == {11}
    assert hit >= 2


def brute_repeats(rows):
    """Per row the spans that go: all runs of four sentences, and the shortest of three or more with 16 words, by comparing their words."""
    parts = []
    for _, text in rows:
        for part in slices(pa.array([text or ""])):
            _, start, to, word_start, _ = spans.sentences(part, Hasher(lower=False))
        parts.append(([text_words[a:b] for text_words in [(text or "").encode().split()] for a, b in zip(start, to)], word_start[start].tolist()))
    seen = defaultdict(list)
    for i in sorted(range(len(rows)), key=lambda i: (rows[i][0], i)):
        cut, _ = parts[i]
        for a in range(len(cut)):
            ends = {a + 4}
            for b in range(a + 3, len(cut) + 1):
                if sum(map(len, cut[a:b])) >= 16:
                    ends.add(b)
                    break
            for b in ends:
                if b <= len(cut):
                    seen[tuple(w for s in cut[a:b] for w in s)].append((i, a, b))
    gone = [set() for _ in rows]
    for places in seen.values():
        for i, a, b in places[1:]:
            gone[i].update(range(a, b))
    out = []
    for (_, text), (cut, begin), lost in zip(rows, parts, gone):
        data, begin = (text or "").encode(), [*begin, len((text or "").encode())]
        kept = data[: begin[0]] + b"".join(data[begin[k] : begin[k + 1]] for k in range(len(cut)) if k not in lost)
        out.append((len(cut), len(lost), kept.decode()))
    return out


def test_repeats_are_those_of_brute_force(spark):
    rng = random.Random(21)
    sentence = lambda: " ".join(rng.choice("red blue old sly fox hen cat owl runs é".split()) for _ in range(rng.randint(1, 7))) + rng.choice(".!?.\n")
    shared = [" ".join(sentence() for _ in range(rng.randint(2, 9))) for _ in range(12)]
    texts = [" ".join([sentence() for _ in range(rng.randint(0, 4))] + rng.sample(shared, rng.randint(0, 3)) + [sentence()]) for _ in range(120)]
    texts += [shared[0], shared[0] + " " + shared[0], "", "Red fox. Blue hen. Old cat. Sly owl.", "Red fox. Blue hen. Old cat. Sly owl.", "no end at all " * 60]
    rows = list(enumerate(texts))
    got = {r["id"]: (r["n_sentences"], r["n_removed"], r["text"]) for r in spans.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()}
    assert [got[i] for i, _ in rows] == brute_repeats(rows)


def test_short_runs_and_the_end_of_a_passage_go(spark):
    four = "Alpha beta gamma delta epsilon zeta. Eta theta iota kappa lambda mu. Nu xi omicron pi rho sigma. Tau upsilon."
    rows = [(0, "Red fox. Blue hen. Old cat. Sly owl."), (1, "Red fox. Blue hen. Old cat. Sly owl."), (2, four), (3, "One before it. " + four + " And one behind.")]
    got = {r["id"]: r["text"].split() for r in spans.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == rows[0][1].split() and got[1] == [] and got[2] == four.split()
    assert got[3] == "One before it. And one behind.".split()


def brute_figures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    at = defaultdict(list)
    for i in range(len(words) - 7):
        at[tuple(words[i : i + 8])].append(i)
    inside = {j for places in at.values() if len(places) > 1 for i in places for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside)


def test_line_rules_equal_brute_force(spark, docs, rows, none):
    odd = ["a b c d e f g h " * 5, "x\ny\nx\n\n\nx ", "##é |<>\n\n", "p q\r\np q\r\np q", "1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8 9"]
    rows = [*rows, *[(1000 + i, t, "en", "s", 1) for i, t in enumerate(odd)]]
    out = rules.line_rules(frame(spark, rows)).collect()
    want = Counter((r[0], *brute_figures(r[1] or "")) for r in rows)
    assert Counter((r["id"], *(r[f] for f in rules.FIGURES)) for r in out) == want
    for r in out:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    assert rules.line_rules(none).count() == 0


def test_lines_of_many_documents_of_a_host_go(spark):
    rng = random.Random(8)
    rows = []
    for i in range(60):
        own = [" ".join(invented(rng, 15, 4000)) for _ in range(3)]
        shared = "All   rights reserved 2019" if i % 2 else "all rights RESERVED 2024"
        lines = own + [shared] if i < 40 else [shared + " " + " ".join("abcdefghijklmnopqrstuvw"[j] for j in range(21))] + own[:1]
        rows.append((i, "\n".join(lines), "en", "h" if i < 55 else "other", 1))
    rows += [(100 + i, rows[0][1], "en", "h", 1) for i in range(30)]
    out = {r["id"]: r for r in rules.line_rules(frame(spark, rows), line_docs=12).collect()}
    for i in range(40):
        assert out[i]["n_words"] - out[i]["words_left"] == 4 and out[i]["kept"]
    for i in range(40, 55):
        # more than half of the words were in the shared line
        assert out[i]["words_left"] == 15 and not out[i]["kept"]
    assert all(out[i]["words_left"] == out[i]["n_words"] for i in range(55, 60))
    # plain copies of one document count once
    assert all(out[100 + i]["kept"] for i in range(30))


URLS = ["http://A.example.ORG/es/x?q", "https://example.org/en/12", "http://x.com/de/", "ftp://shop.com/fr/#a", "no scheme", None, "http://", "http://host.net?x=/de/", "http://b.net/a"]


def test_rules_hosts_and_paths(spark, none):
    df = spark.createDataFrame([(i, u, None) for i, u in enumerate(URLS)], "page_id long, url string, html string")
    got = {r["id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in links.judge(df).collect()}
    assert got == {
        0: ("a.example.org", "/es/x", "example.org/es/", "block"),
        1: ("example.org", "/en/12", "example.org/en/1", "block"),
        2: ("x.com", "/de/", "com/de/", "block"),
        3: ("shop.com", "/fr/", "com/fr/", "allow"),
        4: ("", "", None, "allow"),
        5: ("", "", None, "allow"),
        6: ("", "", None, "allow"),
        7: ("host.net", "", None, "allow"),
        8: ("b.net", "/a", None, "allow"),
    }
    assert links.judge(df.limit(0)).count() == 0


def brute_rank(edges, seeds):
    out = defaultdict(float)
    for s, d, w in edges:
        out[s] += w
    rank = {h: 1 / len(seeds) for h in seeds}
    for _ in range(links.ROUNDS):
        new = defaultdict(float, {h: (1 - links.DAMPING) / len(seeds) for h in seeds})
        for s, d, w in edges:
            new[d] += links.DAMPING * rank.get(s, 0.0) * w / out[s]
        rank = new
    return rank


def test_trust_and_distrust_equal_brute_force(spark):
    rng = random.Random(6)
    hosts = [f"h{i}.net" for i in range(12)]
    edges = sorted({(a, b): rng.randint(1, 5) for a, b in (rng.sample(hosts, 2) for _ in range(40))}.items())
    edges = [(a, b, float(w)) for (a, b), w in edges]
    frame_ = spark.createDataFrame(edges, "src string, dst string, w double")
    seeds = [spark.createDataFrame([(h,) for h in x], "host string") for x in (hosts[:2], hosts[2:4])]
    df = spark.createDataFrame([(i, f"http://{h}/p", "") for i, h in enumerate(hosts)], "page_id long, url string, html string")
    trust, distrust = brute_rank(edges, hosts[:2]), brute_rank([(b, a, w) for a, b, w in edges], hosts[2:4])
    for r in links.judge(df, edges=frame_, trusted=seeds[0], blocked=seeds[1]).collect():
        t, d = trust.get(r["host"], 0.0), distrust.get(r["host"], 0.0)
        assert r["trust"] == pytest.approx(t) and r["distrust"] == pytest.approx(d)
        assert r["verdict"] == ("block" if d > t else "allow")


def test_links_in_pages_carry_distrust_back(spark):
    pages = [(0, "http://a.net/x", '<a HREF="http://bad.com/de/1">x</a><a href=/rel>y</a>'), (1, "http://bad.com/de/1", None), (2, "http://c.net/", "<a href='http://a.net/x'>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["id"]: (r["verdict"], r["distrust"] > 0) for r in links.judge(df).collect()}
    assert got == {0: ("block", True), 1: ("block", True), 2: ("block", True)}


def test_a_text_is_cut_alike_wherever_it_lies_in_a_slice():
    rng = random.Random(2)
    texts = ["one two.", *(" ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(50)) for _ in range(20))]
    lengths = lambda parts: [
        (to - start)[doc == d].tolist() for part in parts for doc, start, to, *_ in [spans.sentences(part, Hasher(lower=False))] for d in range(part.n)
    ]
    together = lengths(slices(pa.array(texts)))
    assert together == [x for t in texts for x in lengths(slices(pa.array([t])))]
