"""PII: fixed patterns, and a linear-chain conditional random field over word shapes that adds what they miss.

The field is trained on a small labelled table by gradient steps on its likelihood. The chain is the whole text, decoded by
Viterbi: where the words near by say O so clearly that no tag before or after could change it, the chain is cut, which leaves
the best path as it is; what lies between the cuts is decoded side by side. Words that differ only in their letters have the
same features, so the weights of most words are looked up, not worked out. All texts are read whole, straight from Arrow's bytes.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cohortlens.llm.pii_table import LABELLED
from cohortlens.llm.text import Hasher, Powers, Ranges, Slice, Words, byte_hashes, code_points, mixed, slices, words

KINDS = ("email", "ip", "card", "phone")
TAGS = ("O", *KINDS)
FEATURES = 1 << 13
KNOWN = 1 << 17  # kinds of words whose weights a worker remembers; it starts anew beyond
STEPS = 250
# fixed patterns
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
CUES = ("mail", "e-mail", "email", "call", "phone", "tel", "fax", "mobile", "card", "visa", "credit", "host", "server", "address", "login", "number")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`` from one at sign to the next, in linear time."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        else:
            # the next local part cannot reach back over this sign
            free = max(free, at + 1) if start < at else free
        at = text.find("@", max(at + 1, free))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            yield m.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGITS.findall(m[0])) <= 15:
            yield m.span()


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` by start, then kind in the order of ``KINDS``; offsets count characters."""
    found = [(s, e, k) for k, f in zip(KINDS, (_emails, _ips, _cards, _phones)) for s, e in f(text)]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def shape(word: str) -> str:
    """Letters and digits as classes; runs of one class with their length up to 4, longer ones by doubling."""
    out = []
    for m in re.finditer(r"[A-Z]+|[a-z]+|[0-9]+|[^\W\d_A-Za-z]+|[\W_]", word):
        c, n = m[0][0], len(m[0])
        kind = "X" if "A" <= c <= "Z" else "9" if c.isascii() and c.isdigit() else "x" if c.isalpha() else c
        out.append(kind if kind not in "9" else f"9{n if n <= 4 else 1 << n.bit_length()}")
    return "".join(out)


def word_features(word: str) -> list[int]:
    """Hashed features of one word; the same in every task."""
    s = shape(word)
    digits = len(_DIGITS.findall(word))
    core = word.strip("\"'<>()[],.;:!?").lower()
    names = [f"s={s}", f"b={s[:4]}", f"e={s[-4:]}", f"d={min(digits, 20)}", f"p={len(re.sub(r'[\w]', '', word))}", f"l={min(len(word).bit_length(), 8)}"]
    names += [f"h={c}" for c in "@:+(/-%=" if c in word]
    names += [f"dots={min(word.count('.'), 4)}", f"colons={min(word.count(':'), 4)}", f"mixed={bool(digits) and any(c.isalpha() for c in word)}"]
    if 12 <= digits <= 19:
        names.append(f"luhn={luhn(''.join(_DIGITS.findall(word)))}")
    if core in CUES:
        names.append(f"cue={core}")
    if "@" in core and not core.startswith("@"):
        names.append("inner@")
    return [zlib.crc32(n.encode()) % FEATURES for n in names]


def labelled(table: str = LABELLED) -> list[tuple[list[str], list[int]]]:
    """Words and tags of each sentence; a word that a mark touches has the mark's tag."""
    out = []
    for line in table.splitlines():
        plain, tag_at = "", []
        for outside, kind, inside in re.findall(r"([^{]*)(?:\{(\w+)\|([^}]*)\})?", line):
            plain += outside + inside
            tag_at += [0] * len(outside) + [TAGS.index(kind) if kind else 0] * len(inside)
        found = [m.span() for m in re.finditer(r"\S+", plain)]
        out.append(([plain[s:e] for s, e in found], [max(tag_at[s:e]) for s, e in found]))
    return out


class Field:
    """Weights of the chain: own word, word before, word after (features x tags each), and transitions between tags."""

    def __init__(self, own, before, after, steps, start) -> None:
        self.own, self.before, self.after, self.steps, self.start = own, before, after, steps, start

    def emissions(self, chains: list[list[str]]) -> list[np.ndarray]:
        """For each chain a table of words x tags."""
        known: dict[str, tuple[np.ndarray, ...]] = {}
        out = []
        for chain in chains:
            for w in chain:
                if w not in known:
                    f = word_features(w)
                    known[w] = (self.own[f].sum(0), self.before[f].sum(0), self.after[f].sum(0))
            table = np.array([known[w][0] for w in chain])
            table[1:] += np.array([known[w][1] for w in chain[:-1]]).reshape(-1, len(TAGS))
            table[:-1] += np.array([known[w][2] for w in chain[1:]]).reshape(-1, len(TAGS))
            out.append(table)
        return out

    def decode(self, chains: list[list[str]]) -> list[list[int]]:
        """The best tags of each chain."""
        tables = [t for t in self.emissions(chains)]
        for t in tables:
            t[0] += self.start
        paths = best_paths(np.concatenate(tables) if tables else np.zeros((0, len(TAGS))), np.array([len(t) for t in tables], np.int64), self.steps)
        return [p.tolist() for p in np.split(paths, np.cumsum([len(t) for t in tables])[:-1])] if tables else []


def best_paths(scores: np.ndarray, lengths: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Viterbi over chains that follow each other in ``scores`` (words x tags), one step for each place; ties go to the lower tag.

    Chains of like length go together, so that a long one does not widen the tables of the short ones.
    """
    path = np.zeros(len(scores), np.int8)
    first = np.cumsum(lengths) - lengths
    for size in np.unique(np.frexp(lengths)[1]):
        own = np.flatnonzero(np.frexp(lengths)[1] == size)
        own = own[np.argsort(-lengths[own], kind="stable")]
        begin, n = first[own], lengths[own]
        longest = int(n[0]) if len(n) else 0
        # how many chains, the longer ones first, reach each place
        alive = np.searchsorted(-n, -np.arange(longest), side="left")
        best, back = scores[begin], np.zeros((longest, len(own), len(TAGS)), np.int8)
        for at in range(1, longest):
            k = alive[at]
            reached = best[:k, :, None] + steps
            back[at, :k] = reached.argmax(1)
            best[:k] = reached.max(1) + scores[begin[:k] + at]
        tag = best.argmax(1)
        for at in range(longest - 1, -1, -1):
            k = alive[at]
            path[begin[:k] + at] = tag[:k]
            if at:
                tag[:k] = back[at, np.arange(k), tag[:k]]
    return path


def train(rows: list[tuple[list[str], list[int]]] | None = None, steps: int = STEPS, rate: float = 0.3, penalty: float = 0.01) -> Field:
    """Gradient steps (each weight by its own past gradients) on the likelihood of the labelled chains."""
    rows = labelled() if rows is None else rows
    k = len(TAGS)
    theta = np.zeros((3 * FEATURES + k + 1, k))
    past = np.full(theta.shape, 1e-6)
    places = []
    for tokens, tags in rows:
        f = [word_features(w) for w in tokens]
        each = []
        for i in range(len(tokens)):
            own = f[i]
            before = [FEATURES + x for x in f[i - 1]] if i else []
            after = [2 * FEATURES + x for x in f[i + 1]] if i + 1 < len(tokens) else []
            each.append(np.array(own + before + after))
        places.append((each, tags))
    for _ in range(steps):
        gradient = -penalty * theta
        trans = theta[3 * FEATURES : 3 * FEATURES + k]
        for each, tags in places:
            e = np.array([theta[x].sum(0) for x in each])
            n = len(each)
            forward, backward = np.zeros((n, k)), np.zeros((n, k))
            forward[0] = theta[-1] + e[0]
            for i in range(1, n):
                forward[i] = e[i] + np.logaddexp.reduce(forward[i - 1][:, None] + trans, 0)
            for i in range(n - 2, -1, -1):
                backward[i] = np.logaddexp.reduce(trans + (e[i + 1] + backward[i + 1])[None], 1)
            z = np.logaddexp.reduce(forward[-1])
            share = np.exp(forward + backward - z)
            for i in range(n):
                change = -share[i]
                change[tags[i]] += 1
                np.add.at(gradient, each[i], change)
                if i:
                    pair = np.exp(forward[i - 1][:, None] + trans + (e[i] + backward[i])[None] - z)
                    gradient[3 * FEATURES : 3 * FEATURES + k] -= pair
                    gradient[3 * FEATURES + tags[i - 1], tags[i]] += 1
                else:
                    gradient[-1] += change
        past += gradient**2
        theta += rate * gradient / np.sqrt(past)
    parts = [theta[i * FEATURES : (i + 1) * FEATURES] for i in range(3)]
    return Field(*parts, theta[3 * FEATURES : 3 * FEATURES + k], theta[-1])


def _fits(kind: str, text: str) -> bool:
    """Whether a stretch of words that the field marks can be of its kind at all."""
    digits = len(_DIGITS.findall(text))
    if kind == "email":
        return 0 < text.find("@") < len(text) - 1
    if kind == "ip":
        return text.count(".") == 3 and digits >= 4 or text.count(":") >= 2 and digits >= 2
    return 12 <= digits <= 19 if kind == "card" else 7 <= digits <= 15


def alike() -> tuple[np.ndarray, np.ndarray]:
    """Which letters count as one: all small ones of ASCII, all large ones; and the second bytes of Latin letters with accents."""
    table = np.arange(256, dtype=np.uint8)
    table[97:123], table[65:91] = 120, 88
    accents = np.zeros(256, bool)
    accents[128:192] = True
    accents[[0x97, 0xB7]] = False  # signs of multiplication and division
    return table, accents


class Lookup:
    """Weights of the words of a slice: own, as the word before and as the word after."""

    def __init__(self, field: Field) -> None:
        self.field, self.known = field, {}
        self.letters, self.accents = alike()
        self.lower, self.plain, self.powers = Hasher(lower=True).values, byte_hashes(), Powers()
        cues = [c.encode() for c in CUES]
        joined, edges = np.frombuffer(b"".join(cues), np.uint8), np.cumsum([0, *map(len, cues)])
        self.cues = np.sort(Ranges(joined, self.lower, self.powers)(edges[:-1], edges[1:]))
        self.trimmed = np.zeros(256, bool)
        self.trimmed[list(b"\"'<>()[],.;:!?")] = True

    def __call__(self, part: Slice, found: Words) -> tuple[np.ndarray, np.ndarray]:
        """The table of weights, and each word's row in it."""
        data = self.letters[part.data]
        accented = np.flatnonzero((part.data[:-1] == 0xC3) & self.accents[part.data[1:]]) + 1
        data[accented] = 0xA9
        kind = Ranges(data, self.plain, self.powers)(found.start, found.end)
        # the word without marks around it, if it is a cue
        start, end = found.start.copy(), found.end.copy()
        more = np.arange(len(start))
        while len(more := more[(start[more] < end[more])]) and len(more := more[self.trimmed[part.data[start[more]]]]):
            start[more] += 1
        more = np.arange(len(start))
        while len(more := more[(start[more] < end[more])]) and len(more := more[self.trimmed[part.data[end[more] - 1]]]):
            end[more] -= 1
        core = Ranges(part.data, self.lower, self.powers)(start, end)
        at = np.minimum(np.searchsorted(self.cues, core), len(self.cues) - 1)
        cue = np.where(self.cues[at] == core, at + 1, 0).astype(np.uint64)
        with np.errstate(over="ignore"):
            kinds, first, row = np.unique(mixed(kind + cue), return_index=True, return_inverse=True)
        if len(self.known) > KNOWN:
            self.known = {}
        rows = []
        for name, i in zip(kinds.tolist(), first.tolist()):
            if name not in self.known:
                f = word_features(part.data[found.start[i] : found.end[i]].tobytes().decode())
                self.known[name] = np.stack([x[f].sum(0) for x in (self.field.own, self.field.before, self.field.after)])
            rows.append(self.known[name])
        return np.array(rows).reshape(-1, 3, len(TAGS)), row


def tags_of(part: Slice, found: Words, lookup: Lookup) -> np.ndarray:
    """The best tag of each word, each text one chain."""
    if not len(found.start):
        return np.zeros(0, np.int8)
    field = lookup.field
    table, row = lookup(part, found)
    scores = table[row, 0]
    inner = found.doc[1:] == found.doc[:-1]
    scores[1:][inner] += table[row[:-1][inner], 1]
    scores[:-1][inner] += table[row[1:][inner], 2]
    opens, closes = np.concatenate([[True], ~inner]), np.concatenate([~inner, [True]])
    scores[opens] += field.start
    # the most that the tags on both sides can speak for another tag than O
    most = np.maximum((field.steps - field.steps[:, :1]).max(0), 0) + np.maximum((field.steps - field.steps[:1]).max(1), 0)
    open_ = ~((scores[:, :1] - scores[:, 1:]) > most[1:]).all(1)
    at = np.flatnonzero(open_)
    tags = np.zeros(len(found.start), np.int8)
    if not len(at):
        return tags
    new = np.concatenate([[True], (np.diff(at) > 1) | opens[at[1:]]])
    last = np.concatenate([new[1:], [True]])
    # an O before and behind, where the chain was cut
    scores[at[new & ~opens[at]]] += field.steps[0]
    scores[at[last & ~closes[at]]] += field.steps[:, 0]
    first = np.flatnonzero(new)
    tags[at] = best_paths(scores[at], np.diff(np.append(first, len(at))), field.steps)
    return tags


def _find(weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(Field(*weights.value))
        trigger = np.zeros(256, bool)
        trigger[[64, *range(48, 58)]] = True
        for batch in batches:
            base_all, spans_all = [], []
            for part in slices(batch["text"]):
                found = words(part)
                marks = np.concatenate([[0], np.cumsum(trigger[part.data])])
                # every kind of span holds a digit or an at sign
                per_text = marks[part.offsets[1:]] > marks[part.offsets[:-1]]
                texts = [part.data[a:b].tobytes().decode() if t else "" for a, b, t in zip(part.offsets[:-1], part.offsets[1:], per_text)]
                base = [base_spans(t) if t else [] for t in texts]
                every = [list(b) for b in base]
                tags = tags_of(part, found, lookup)
                points = np.concatenate([[0], np.cumsum(code_points(part.data))])
                turn = np.flatnonzero(np.concatenate([[True], (tags[1:] != tags[:-1]) | (found.doc[1:] != found.doc[:-1])])) if len(tags) else np.zeros(0, np.int64)
                ends = np.append(turn[1:], len(tags))
                marked = (tags[turn] > 0) & per_text[found.doc[turn]]
                for i, j in zip(turn[marked].tolist(), ends[marked].tolist()):
                    d, tag = int(found.doc[i]), int(tags[i])
                    shift = points[part.offsets[d]]
                    s, e = int(points[found.start[i]] - shift), int(points[found.end[j - 1]] - shift)
                    text = texts[d]
                    while s < e and text[s] in "\"'<([{,.;:!?" and not (tag == 4 and text[s] == "("):
                        s += 1
                    while s < e and text[e - 1] in "\"'>)]},.;:!?":
                        e -= 1
                    if _fits(TAGS[tag], text[s:e]) and all(e <= x or s >= y for x, y, _ in base[d]):
                        every[d].append((s, e, TAGS[tag]))
                base_all += base
                spans_all += [sorted(set(x), key=lambda x: (x[0], KINDS.index(x[2]), x[1])) for x in every]
            joined = [",".join(f"{k}:{s}:{e}" for s, e, k in x) for x in base_all]
            columns = [pa.array([sum(k == kind for _, _, k in x) for x in base_all], pa.int64()) for kind in KINDS]
            listed = pa.array([",".join(f"{k}:{s}:{e}" for s, e, k in x) for x in spans_all], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch["id"], *columns, pa.array(joined, pa.string()), listed], names=["id", *[f"n_{k}" for k in KINDS], "base", "spans"]
            )

    return run


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", field: Field | None = None) -> DataFrame:
    """``id, n_email, n_ip, n_card, n_phone, base, spans``, one row per row of ``docs``.

    ``base`` are the spans of the fixed patterns as ``kind:start:end``, comma-joined by start, then kind; offsets count code
    points, the end is exclusive; the numbers count them. ``spans`` has those and the ones that the field adds, which
    overlap no base span; equally good tags go to the lower one. Null or empty text: none. Long texts are one chain, read and
    decoded whole. Repeated rows get equal spans. Extra columns are not read. Empty table: no rows.
    """
    field = field or train()
    # plain arrays: executors need not have this package
    model = docs.sparkSession.sparkContext.broadcast((field.own, field.before, field.after, field.steps, field.start))
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = base.schema["id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return base.mapInArrow(_find(model), f"id {id_type}, {counts}, base string, spans string")
