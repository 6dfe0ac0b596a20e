import random
import re

import numpy as np
import pyarrow as pa

from cohortlens.llm.text import Hasher, slices, windows, words

TEXTS = [None, "", "  ", "a", "The the THE", "é\x1cb c d", "\tx\n\ny\x0b", "z" * 5_000, "a b " * 300]


def test_words_are_the_runs_between_white_space():
    for limit in (1, 50, 1 << 20):
        got = {}
        for part in slices(pa.array(TEXTS), limit):
            found = words(part)
            for s, e, d in zip(found.start, found.end, found.doc):
                got.setdefault(part.first + int(d), []).append(part.data[s:e].tobytes().decode())
        assert got == {i: w for i, t in enumerate(TEXTS) if (w := re.findall(r"[^\x20\x09-\x0D]+", t or ""))}


def test_hashes_depend_on_the_word_alone():
    rng = random.Random(1)
    texts = [" ".join(rng.choices(["a", "b", "ab", "ba", "aB", "aa", "é", "\x00", "\x00\x00"], k=20)) for _ in range(200)]
    for lower in (True, False):
        seen, back = {}, {}
        for limit in (1, 1 << 20):
            for part in slices(pa.array(texts), limit):
                found = words(part)
                for s, e, h in zip(found.start, found.end, Hasher(lower)(part, found)):
                    word = part.data[s:e].tobytes()
                    word = word.lower() if lower else word
                    assert seen.setdefault(word, h) == h and back.setdefault(h, word) == word


def test_windows_tell_orders_apart():
    h = np.array([1, 2, 3, 1, 2, 3, 2, 1], np.uint64)
    got = windows(h, 3)
    assert got[0] == got[3] and len(set(got.tolist())) == 5 and len(windows(h, 9)) == 0


def test_a_slice_of_a_column_keeps_its_texts():
    column = pa.array(["no", "a b", None, "c"]).slice(1)
    assert [p.data[p.offsets[d] : p.offsets[d + 1]].tobytes() for p in slices(column) for d in range(p.n)] == [b"a b", b"", b"c"]
