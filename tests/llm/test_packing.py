import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from cohortlens.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(packing.tokenizer_path())


def ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END]


ODD = ["The Thin, thin. é́ É 9a1 's can't CAN'T a.b.c ... !! x<|endoftext|>y <|ENDOFTEXT|>", "\x1c   ß İ Σας ΣΑΣ ́x, ŀl ǆ ﬁ", "日本 語。 👍🏽 ½ ² ª", "", "\n"]


def test_words_have_the_ids_of_the_whole_text(tokenizer, rows):
    find = packing.WordIds(packing.tokenizer_path())
    texts = [r[1] or "" for r in rows] + ODD
    for _ in range(3):
        got = [np.frombuffer(x, np.uint16).tolist() for x in find([t.encode() for t in texts])]
        assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_signs_that_end_a_word_are_looked_up_alone(tokenizer):
    find = packing.WordIds(packing.tokenizer_path())
    text = "Gut... gut$$$ café!! 7,) CAFÉ? it's. don't' a.,'b c]\u0301 ×!! ='s; x--"
    got = find._words(text.encode())
    assert got[:10] == [w.encode() for w in ("gut", "...", "gut", "$$$", "café", "!!", "7", ",)", "cafÉ", "?")]
    rng = random.Random(5)
    texts = [text] + ["".join(rng.choices("ab Éé×9.,'!$<|>-=~ \n\u0301", k=60)) for _ in range(300)]
    for _ in range(3):
        ids = [np.frombuffer(x, np.uint16).tolist() for x in find([t.encode() for t in texts])]
        assert ids == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert b"gut" in find.known and b"gut..." not in find.known


def test_words_that_come_once_are_not_kept(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 2)
    find = packing.WordIds(packing.tokenizer_path())
    first = find([b"one two three four"])
    assert not find.known
    assert find([b"one two three four"]) == first
    assert len(find.known) == 2
    assert find([b"one two three four"]) == first
    assert len(find.known) == 2


def test_each_id_lies_in_one_piece(docs, rows, tokenizer):
    window = 64
    got = packing.pack(docs, window=window).collect()
    by_window, by_doc = defaultdict(list), defaultdict(list)
    for r in got:
        by_window[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[(r["id"], r["doc_tokens"])].append((r["start"], r["length"], r["ids_crc32"]))
    last = max(by_window)
    for w, pieces in by_window.items():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:i]) for i in range(len(pieces))]
        assert w == last or sum(n for _, n in pieces) == window
    assert sorted(by_window) == list(range(last + 1))
    wanted = defaultdict(list)
    for r in rows:
        x = ids(tokenizer, r[1])
        wanted[(r[0], len(x))].append(np.array(x, "<u4"))
    assert set(by_doc) == set(wanted)
    for key, pieces in by_doc.items():
        cover = Counter(i for s, n, _ in pieces for i in range(s, s + n))
        assert set(cover) == set(range(key[1])) and set(cover.values()) == {len(wanted[key])}
        crcs = {zlib.crc32(x[s : s + n].tobytes()) for x in wanted[key] for s, n, _ in pieces}
        assert all(c in crcs for _, _, c in pieces)


def shares_of(got):
    share = defaultdict(Counter)
    for r in got:
        share[r["sequence_id"]][r["source"]] += r["length"]
    return share


def test_windows_follow_the_target_proportions(spark):
    """Every window holds each source's share but for a token from each source, documents of any length."""
    rows = [(i, "word " * (1 + i % 90) if i % 50 else "word " * 3_000, "en", "abbccccd"[i % 8], 1) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    window = 512
    share = shares_of(packing.pack(df, window=window).collect())
    sizes = sum(share.values(), Counter())
    for w in range(len(share) - 1):
        assert all(abs(share[w][s] - window * n / sizes.total()) <= len(sizes) + 1 for s, n in sizes.items())
    share = shares_of(packing.pack(df, window=window, weights={"a": 3.0, "b": 1.0, "c": 0.5}).collect())
    # until the first queue ends
    whole = int(min(sizes["a"] / 3, sizes["b"], sizes["c"] / 0.5) * 4.5 / window) - 1
    assert whole > 5
    for w in range(whole):
        assert all(abs(share[w][s] - window * x / 4.5) <= 5 for s, x in (("a", 3.0), ("b", 1.0), ("c", 0.5))) and not share[w]["d"]


def test_rounds_count_alike_in_numbers_of_any_size():
    """What a source has served, round by round, from fractions; and tokens of small sources, which earn less than one a round."""
    from fractions import Fraction

    for sizes, weights in (([7, 900, 93], [7, 900, 93]), ([5, 50, 500], [1, 10, 3]), ([10**15, 3 * 10**15, 12345], [10**15, 3 * 10**15, 12345])):
        rounds = packing.Rounds(sizes, weights, 100)
        for s, (n, w) in enumerate(zip(sizes, weights)):
            last = int(rounds.turns(np.array([n - 1]), s)[0])
            for r in {1, 2, 3, last - 1, last, last + 1} - {0}:
                want = min(n, int(Fraction(r * 100 * w, sum(weights))))
                assert int(rounds.served(np.array([r]), np.array([s]))[0]) == want
                begin = sum(min(m, int(Fraction((r - 1) * 100 * v, sum(weights)))) for m, v in zip(sizes, weights))
                begin += sum(min(m, int(Fraction(r * 100 * v, sum(weights)))) - min(m, int(Fraction((r - 1) * 100 * v, sum(weights)))) for m, v in zip(sizes[:s], weights[:s]))
                assert int(rounds.places(np.array([r]), np.array([s]))[0]) == begin
            turn, start, length = packing._pieces(rounds, s, max(0, n - 40), min(n, 40))
            assert length.sum() == min(n, 40) and (start + length)[-1] == n and (start[1:] == (start + length)[:-1]).all()


def test_no_weight_means_last_and_no_rows_mean_none(docs, none):
    assert packing.pack(none).count() == 0
    got = packing.pack(docs, window=256, weights={"s1": 1.0}).collect()
    assert sum(r["length"] for r in got) == sum(r["length"] for r in packing.pack(docs).collect())
    assert min(r["sequence_id"] for r in got if r["source"] == "s1") == 0
    assert max(r["sequence_id"] for r in got if r["source"] == "s1") <= min(r["sequence_id"] for r in got if r["source"] == "s0")
