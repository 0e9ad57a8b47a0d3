"""External induced suffix sorting with common prefixes, to a bounded depth.

Sorts the suffixes of a shard (texts, each closed by a separator) by their first
``depth`` symbols and gives the common prefix of neighbours, capped at ``depth``.

The S* suffixes are named by their S* substrings, and the string of names is
sorted by doubling (the recursion; it ends when names cover ``depth``). From the
sorted S* suffixes two scans induce all others: a scan takes suffix tuples from
queues by symbol and puts each suffix's predecessor into the queue of its symbol.
Tuples are (position, common prefix with the tuple before it): a predecessor's
common prefix is one more than the least along the way between its source and the
source of the tuple before it. As sources come in order, every queue is filled in
order: the priority queue is an array of queues, and what a scan holds beyond
``memory`` bytes is kept in an unnamed file of the task and read back once, in
order. The file is the task's own, like a spill, and gone when the task ends.
"""

from __future__ import annotations

import tempfile

import numpy as np

SEPARATOR, FIRST = 1, 2             # symbols: 0 ends the shard, bytes start at FIRST
N_SYMBOLS = 256 + FIRST
MEMORY = 256 << 20
TUPLE = np.dtype([("at", np.int64), ("lcp", np.int32)])


class SuffixQueues:
    """One first-in first-out queue of suffix tuples a symbol, disk-backed."""

    def __init__(self, memory: int):
        self.memory, self.held, self.file = memory, 0, None
        self.queues: list[list] = [[] for _ in range(N_SYMBOLS)]

    def put(self, symbol: int, tuples: np.ndarray) -> None:
        if not len(tuples):
            return
        if self.held + tuples.nbytes > self.memory:
            if self.file is None:
                self.file = tempfile.TemporaryFile()
            self.file.seek(0, 2)
            self.queues[symbol].append((self.file.tell(), len(tuples)))
            self.file.write(tuples.tobytes())
        else:
            self.held += tuples.nbytes
            self.queues[symbol].append(tuples)

    def take(self, symbol: int) -> np.ndarray | None:
        """All that waits in a queue; None if nothing does."""
        waiting, self.queues[symbol] = self.queues[symbol], []
        out = []
        for x in waiting:
            if isinstance(x, tuple):
                self.file.seek(x[0])
                out.append(np.frombuffer(self.file.read(x[1] * TUPLE.itemsize), TUPLE))
            else:
                self.held -= x.nbytes
                out.append(x)
        return None if not out else out[0] if len(out) == 1 else np.concatenate(out)


def shard_of(texts: list[bytes]) -> np.ndarray:
    """Symbols of the texts, a separator after each, and the end."""
    joined = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    out = np.full(len(joined) + len(texts) + 1, SEPARATOR, np.int16)
    out[np.arange(len(joined)) + np.repeat(np.arange(len(texts)), sizes)] = joined.astype(np.int16) + FIRST
    out[-1] = 0
    return out


def s_types(text: np.ndarray) -> np.ndarray:
    """Whether a suffix is less than the one after it."""
    n = len(text)
    out = np.zeros(n, bool)
    out[-1] = True
    differ = text[:-1] != text[1:]
    differs = np.flatnonzero(differ)
    # equal neighbours are of the type of the next differing pair; the end symbol differs from all
    upto = np.cumsum(differ) - differ
    out[:-1] = text[differs[upto]] < text[differs[upto] + 1]
    return out


def _refine(name: np.ndarray, own: np.ndarray, key: np.ndarray) -> None:
    """Names are ranks (how many are less); those of the members ``own`` of whole groups of
    equal names are told apart by ``key``."""
    order = np.argsort(name[own] * (int(key.max()) + 1) + key)
    who, key = own[order], key[order]
    old = name[who]
    group, same = np.ones(len(who), bool), np.ones(len(who), bool)
    group[1:] = old[1:] != old[:-1]
    same[1:] = group[1:] | (key[1:] != key[:-1])
    place = np.arange(len(who))
    name[who] = old + np.maximum.accumulate(np.where(same, place, 0)) - np.maximum.accumulate(np.where(group, place, 0))


def sorted_stars(text: np.ndarray, types: np.ndarray, depth: int) -> np.ndarray:
    """Positions of the S* suffixes, sorted to ``depth`` symbols."""
    star = np.flatnonzero(types[1:] & ~types[:-1]) + 1
    if len(star) < 2:
        return star
    n = len(text)
    coded = np.zeros(n + 8, np.int64)
    coded[:n] = text.astype(np.int64) * 2 + types + 1
    length = np.append(np.diff(star) + 1, 1)                # an S* substring ends with the next one's first symbol
    length = np.minimum(length, depth + 6)
    name = np.zeros(len(star), np.int64)
    own, at = np.arange(len(star)), 0
    while len(own):                                         # six symbols at a time, for groups in which some go on
        key = np.zeros(len(own), np.int64)
        for k in range(6):
            key = key << 10 | np.where(length[own] > at + k, coded[np.minimum(star[own] + at + k, n)], 0)
        _refine(name, own, np.unique(key, return_inverse=True)[1])
        at += 6
        open_ = np.zeros(len(star), bool)
        open_[name[length > at]] = True
        own = np.flatnonzero(open_[name] & (np.bincount(name, minlength=len(star))[name] > 1))
    step = 1
    while step < depth and step < len(star):                # a name covers two symbols at least
        own = np.flatnonzero(np.bincount(name, minlength=len(star))[name] > 1)
        if not len(own):
            break
        after = own + step
        _refine(name, own, np.where(after < len(star), name[np.minimum(after, len(star) - 1)] + 1, 0))
        step *= 2
    return star[np.argsort(name * len(star) + np.arange(len(star)))]


def packed(text: np.ndarray) -> np.ndarray:
    """Four symbols from every place on, the first one in the low bits."""
    t = np.concatenate((text, np.zeros(3, text.dtype))).astype(np.uint64)
    return t[:-3] | t[1:-2] << np.uint64(16) | t[2:-1] << np.uint64(32) | t[3:] << np.uint64(48)


def common_prefix(fours: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Common prefixes of pairs of different suffixes of a ``packed`` text, capped. The end
    symbol occurs once, so two suffixes differ before one of them is over."""
    out = np.zeros(len(a), np.int32)
    todo = np.arange(len(a))
    for k in range(0, depth, 4):
        differ = fours[a + k] ^ fours[b + k]
        same = differ == 0
        low = differ[~same]
        one = (low & np.uint64(0xFFFF)) == 0
        two = one & ((low & np.uint64(0xFFFFFFFF)) == 0)
        three = two & ((low & np.uint64(0xFFFFFFFFFFFF)) == 0)
        out[todo[~same]] = k + one + two + three
        todo, a, b = todo[same], a[same], b[same]
        if not len(todo):
            break
    out[todo] = depth
    return np.minimum(out, depth)


class _Scan:
    """Induces predecessors of one type from suffixes in (ascending or descending) order."""

    def __init__(self, text, types, wanted: bool, depth: int, memory: int):
        self.text, self.types, self.wanted, self.depth = text, types, wanted, depth
        self.queues = SuffixQueues(memory)
        self.least = np.zeros(N_SYMBOLS, np.int64)          # least common prefix since a symbol's last put

    def bucket(self) -> None:
        """Sources now begin with another symbol: nothing in common with those before."""
        self.least[:] = 0

    def scan(self, batch: np.ndarray) -> None:
        """``batch``: tuples in order; the first one's lcp is with the one scanned before it."""
        lcp = batch["lcp"].astype(np.int64)
        before = batch["at"] - 1
        ok = before >= 0
        ok[ok] = self.types[before[ok]] == self.wanted
        rows = np.flatnonzero(ok)
        symbols = self.text[before[rows]]
        order = np.argsort(symbols, kind="stable")
        rows, symbols = rows[order], symbols[order]
        cuts = np.flatnonzero(np.diff(symbols)) + 1
        everything = int(lcp.min())
        np.minimum(self.least, everything, out=self.least)  # symbols that aren't put now
        carried = self.least.copy()
        for own in np.split(rows, cuts) if len(rows) else []:
            s = int(self.text[before[own[0]]])
            first = min(int(self._before[s]), int(lcp[: own[0] + 1].min()))
            between = np.minimum.reduceat(lcp, own[:-1] + 1)[: len(own) - 1] if len(own) > 1 else lcp[:0]
            if len(own) > 1:        # reduceat runs the last one to the end of the batch
                between[-1] = lcp[own[-2] + 1: own[-1] + 1].min()
            tuples = np.empty(len(own), TUPLE)
            tuples["at"] = before[own]
            tuples["lcp"] = np.minimum(np.concatenate(([first], between)) + 1, self.depth)
            self.queues.put(s, tuples)
            rest = lcp[own[-1] + 1:]
            carried[s] = rest.min() if len(rest) else self.depth
        self.least = carried

    @property
    def _before(self):
        return self._least_before

    def feed(self, batch: np.ndarray) -> None:
        if len(batch):
            self._least_before = self.least.copy()
            self.scan(batch)


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty(0, TUPLE)


def sort_suffixes(text: np.ndarray, depth: int, memory: int = MEMORY) -> tuple[np.ndarray, np.ndarray]:
    """(positions in order, common prefix with the position before, capped)."""
    types = s_types(text)
    stars = sorted_stars(text, types, depth)
    seeds = np.empty(len(stars), TUPLE)
    seeds["at"], seeds["lcp"] = stars, 0
    fours = packed(text)
    seeds["lcp"][1:] = common_prefix(fours, stars[:-1], stars[1:], depth)
    seed_at = np.searchsorted(text[stars], np.arange(N_SYMBOLS + 1))

    def meet(tuples: np.ndarray, last: int | None) -> np.ndarray:
        """Set the first tuple's common prefix with the suffix before it in the bucket."""
        if len(tuples):
            tuples = tuples.copy()
            tuples["lcp"][0] = 0 if last is None else common_prefix(
                fours, np.array([last]), tuples["at"][:1], depth)[0]
        return tuples

    large: list[np.ndarray] = []
    up = _Scan(text, types, False, depth, memory)
    for c in range(N_SYMBOLS):
        up.bucket()
        own, last = [], None
        while (batch := up.queues.take(c)) is not None:
            if last is None:
                batch = meet(batch, None)
            own.append(batch)
            last = int(batch["at"][-1])
            up.feed(batch)
        if c == 0 and last is None and not types[len(text) - 2: len(text) - 1].any():
            up.feed(np.array([(len(text) - 1, 0)], TUPLE))  # the end, if it is no S* suffix's
        elif seed_at[c] < seed_at[c + 1]:
            up.feed(meet(seeds[seed_at[c]: seed_at[c + 1]], last))
        large.append(_joined(own))

    small: list[np.ndarray] = [np.empty(0, TUPLE)] * N_SYMBOLS
    down = _Scan(text, types, True, depth, memory)
    for c in range(N_SYMBOLS - 1, -1, -1):
        down.bucket()
        own, last = [], None
        while (batch := down.queues.take(c)) is not None:
            if last is None:
                batch = meet(batch, None)
            own.append(batch)
            last = int(batch["at"][-1])
            down.feed(batch)
        small[c] = _joined(own)
        if len(large[c]):
            back = large[c][::-1].copy()
            back["lcp"][1:] = large[c]["lcp"][:0:-1]
            down.feed(meet(back, last))

    order, lcp = [], []
    for c in range(N_SYMBOLS):
        rising = small[c][::-1].copy()
        if len(rising):
            rising["lcp"][1:] = small[c]["lcp"][:0:-1]
            rising = meet(rising, int(large[c]["at"][-1]) if len(large[c]) else None)
        order += [large[c]["at"], rising["at"]]
        lcp += [large[c]["lcp"], rising["lcp"]]
    return np.concatenate(order), np.concatenate(lcp)
