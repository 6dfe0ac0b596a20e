"""Suffix arrays by grouping: suffixes that share a Lyndon prefix are found first, then put in order.

Many short strings are worked on side by side, one group of each at a time, so that numpy has long arrays. A string is
some pieces, each followed by the symbol 0, which is smaller than all others and ends every comparison.

First part: the suffixes of a string are grouped by their first symbol, and groups are visited from the highest down. The nearest
position before a member whose suffix lies in a lower group is its previous smaller one; pointers of visited positions jump over what
lies between. Such a position's prefix grows by the group's, as often as the group follows it in a row, and it moves up, right
above those of its own group that do not. Each position is a member once, so the work is in proportion to the text.

Second part: a group's members go on, after the prefix they share, with smaller suffixes, which are in order already. So each
group is put in order by the place of what follows, groups with equal prefixes in a row counted first. No names are given anew.
"""

from __future__ import annotations

import numpy as np


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All numbers of ``[start, start + size)``, range after range."""
    upto = np.cumsum(size)
    return np.arange(upto[-1] if len(upto) else 0) + np.repeat(start - upto + size, size)


class Groups:
    """Slots of one string are consecutive; ``head`` is the first slot of a position's group, ``size`` and ``prefix`` lie at heads."""

    def __init__(self, symbols: np.ndarray, edges: np.ndarray) -> None:
        n = len(symbols)
        self.symbols, self.edges = symbols, edges
        string = np.repeat(np.arange(len(edges) - 1, dtype=np.int64), np.diff(edges))
        key = string * (int(symbols.max(initial=0)) + 1) + symbols
        self.order = np.argsort(key, kind="stable").astype(np.int32)
        ranked = key[self.order]
        starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if n else np.zeros(0, np.int64)
        sizes = np.diff(np.append(starts, n))
        self.slot, self.head = np.empty(n, np.int32), np.empty(n, np.int32)
        self.slot[self.order] = np.arange(n)
        self.head[self.order] = np.repeat(starts, sizes)
        self.size, self.prefix = np.zeros(n, np.int32), np.zeros(n, np.int32)
        self.size[starts], self.prefix[starts] = sizes, 1
        self.before = np.zeros(n, np.int32)
        self.moves = np.zeros(n, bool)
        # the group of the symbol 0 is the lowest of a string, and nothing is smaller
        ends = np.concatenate([[0], np.cumsum(symbols == 0)])
        self.floor = edges[:-1] + ends[edges[1:]] - ends[edges[:-1]]

    def visit(self) -> None:
        """All groups of each string, from the highest down."""
        top, floor = self.edges[1:].copy(), self.floor
        while True:
            on = top > floor
            if not on.all():
                top, floor = top[on], floor[on]
                if not len(top):
                    return
            low = self.head[self.order[top - 1]]
            self._step(low, top)
            top = low

    def _step(self, low: np.ndarray, top: np.ndarray) -> None:
        size = top - low
        member = np.sort(self.order[ranges(low, size)])  # strings follow each other, so each one's members stay together
        above, least = np.repeat(top, size), np.repeat(low, size)
        at = member - 1
        walk = np.arange(len(at))
        # over positions that were visited; the one before a string ends another one, whose slots are all lower
        while True:
            walk = walk[self.head[at[walk]] >= above[walk]]
            if not len(walk):
                break
            at[walk] = self.before[at[walk]]
        # a member right before: the group's prefix twice in a row
        first = np.flatnonzero(self.head[at] < least)
        times = np.diff(np.append(first, len(at)))
        at = at[first]
        self.before[member] = np.repeat(at, times)
        grows = self.symbols[at] != 0
        self._move(at[grows], times[grows], self.prefix[least[first[grows]]])

    def _move(self, at: np.ndarray, times: np.ndarray, prefix: np.ndarray) -> None:
        if not len(at):
            return
        head = self.head[at]
        by = np.lexsort((times, head)) if times.max() > 1 else np.argsort(head, kind="stable")
        at, times, head, prefix = at[by], times[by], head[by], prefix[by]
        turn = np.ones(len(at), bool)
        turn[1:] = head[1:] != head[:-1]
        old = np.flatnonzero(turn)
        n = np.diff(np.append(old, len(at)))
        tail = head[old] + self.size[head[old]] - n
        slots = ranges(tail, n)
        # those of the tail that stay change places with those that move from elsewhere
        self.moves[at] = True
        there = self.order[slots]
        stay = there[~self.moves[there]]
        self.moves[at] = False
        free = self.slot[at]
        free = free[free < np.repeat(tail, n)]
        self.order[free], self.slot[stay] = stay, free
        self.order[slots], self.slot[at] = at, slots
        turn[1:] |= times[1:] != times[:-1]
        new = np.flatnonzero(turn)
        length = self.prefix[head[new]] + times[new] * prefix[new]
        count = np.diff(np.append(new, len(at)))
        self.size[head[old]] -= n
        self.size[slots[new]], self.prefix[slots[new]] = count, length
        self.head[at] = np.repeat(slots[new], count)

    def emit(self) -> np.ndarray:
        """Positions of each string by their suffixes. Equal pieces go by their place."""
        heads = np.flatnonzero(self.size > 1)
        heads = heads[self.symbols[self.order[heads]] != 0]
        done = np.ones(len(self.order), bool)
        size = self.size[heads]
        member = self.order[ranges(heads, size)]
        done[member] = False
        length = np.repeat(self.prefix[heads], size)
        after, row = member + length, np.zeros(len(member), np.int64)
        again = np.arange(len(member))
        while True:
            again = again[self.head[after[again]] == self.head[member[again]]]
            if not len(again):
                break
            after[again] += length[again]
            row[again] += 1
        while len(heads):
            # groups whose followers all have their places
            ready = np.logical_and.reduceat(done[after], np.cumsum(size) - size)
            own = np.repeat(ready, size)
            now, slots = member[own], ranges(heads[ready], size[ready])
            by = np.lexsort((self.slot[after[own]], row[own], self.head[now]))
            self.order[slots], self.slot[now[by]] = now[by], slots
            done[now] = True
            heads, size, member, after, row = heads[~ready], size[~ready], member[~own], after[~own], row[~own]
        return self.order


def suffix_orders(symbols: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The suffix array of each string ``symbols[edges[s]:edges[s + 1]]``, one after the other. Each string ends in 0."""
    # a 0 before the first string, as before all others
    groups = Groups(np.concatenate([np.zeros(1, np.int32), symbols.astype(np.int32)]), np.concatenate([[0], np.asarray(edges, np.int64) + 1]))
    groups.visit()
    return groups.emit()[1:] - 1


def equal_neighbours(data: np.ndarray, order: np.ndarray, judged: np.ndarray, least: int) -> np.ndarray:
    """Marks the judged positions whose first ``least`` bytes another judged one shares; neighbours in ``order`` are compared byte by byte."""
    pair = np.flatnonzero(judged[order[1:]] & judged[order[:-1]])
    a, b = order[pair], order[pair + 1]
    width = 8 if least >= 8 else 1
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    kind = np.dtype("<u8") if width == 8 else np.dtype(np.uint8)
    view = np.ndarray(len(data) + 1, kind, padded.tobytes(), strides=(1,))
    for at in [*range(0, least - width + 1, width), least - width]:
        same = view[a + at] == view[b + at]
        a, b = a[same], b[same]
    out = np.zeros(len(data), bool)
    out[a] = out[b] = True
    return out
