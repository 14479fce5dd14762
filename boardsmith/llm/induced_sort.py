"""Induced suffix sorting with common-prefix values, bucket by bucket, on queues that move to disk.

A text of symbols is sorted by the induction from its leftmost smaller (LMS) suffixes.  What passes between buckets
are suffix tuples (position, common prefix with the tuple before); each bucket is a first-in first-out queue, and
taking the buckets in symbol order makes them one monotone priority queue.  What a pass has sorted goes to queues as
well, which the next pass takes bucket by bucket.  Queues above ``SPILL`` bytes live in temporary files, so of the
tuples memory holds that many bytes a queue set and the bucket at hand; it also holds the text, its suffix types and, while the LMS
suffixes are ordered, four bytes a suffix for each round.  Shards of the usual size stay below ``SPILL`` and never reach the disk.

The reduced text of LMS names is ordered by the same induction's names, doubled until they cover ``depth``
symbols: only repeats of ``depth`` matter here, so suffixes equal up to there stay in any order, and common-prefix
values are capped at ``depth``.
"""

from __future__ import annotations

import itertools
import tempfile

import numpy as np

SPILL = 64 * 2**20
PAIRS = 1 << 16  # neighbours whose common prefixes are taken at once
HASHED = 1 << 17  # symbols whose LMS substrings are hashed at once, or one longer substring
TUPLE = np.dtype([("pos", np.int32), ("lcp", np.uint16)])


class Queues:
    """One first-in first-out queue of suffix tuples for each symbol."""

    def __init__(self, symbols: int, spill: int = SPILL):
        self.parts: list[list] = [[] for _ in range(symbols)]
        self.held, self.spill, self.file = 0, spill, None

    def put(self, symbol: int, tuples: np.ndarray) -> None:
        if not len(tuples):
            return
        self.held += tuples.nbytes
        self.parts[symbol].append(tuples)
        if self.held > self.spill:
            self._to_disk()

    def _to_disk(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        for queue in self.parts:
            for i, part in enumerate(queue):
                if isinstance(part, np.ndarray):
                    place = self.file.seek(0, 2)
                    self.file.write(part.tobytes())
                    queue[i] = (place, len(part))
        self.held = 0

    def get(self, symbol: int) -> np.ndarray:
        """The tuples of a symbol, which stay in their queue."""
        out = []
        for part in self.parts[symbol]:
            if isinstance(part, tuple):
                self.file.seek(part[0])
                part = np.frombuffer(self.file.read(part[1] * TUPLE.itemsize), TUPLE)
            out.append(part)
        return np.concatenate(out) if out else np.zeros(0, TUPLE)

    def take(self, symbol: int) -> np.ndarray:
        queue, out = self.parts[symbol], []
        for part in queue:
            if isinstance(part, tuple):
                self.file.seek(part[0])
                part = np.frombuffer(self.file.read(part[1] * TUPLE.itemsize), TUPLE)
            else:
                self.held -= part.nbytes
            out.append(part)
        queue.clear()
        return np.concatenate(out) if out else np.zeros(0, TUPLE)


class Turned:
    """Queues read downwards, where a tuple's common prefix is the one with the tuple above it."""

    def __init__(self, queues: Queues):
        self.queues = queues

    def get(self, symbol: int) -> np.ndarray:
        up = self.queues.get(symbol)
        return tuples(up["pos"][::-1], np.append(0, up["lcp"][:0:-1])) if len(up) else up


def tuples(pos: np.ndarray, lcp: np.ndarray | int) -> np.ndarray:
    out = np.empty(len(pos), TUPLE)
    out["pos"], out["lcp"] = pos, lcp
    return out


class Sorter:
    def __init__(self, text: np.ndarray, depth: int, spill: int = SPILL):
        """``text``: symbols; 0 separates, ends the text and never stands twice in a row."""
        self.text, self.depth, self.spill, n = text, depth, spill, len(text)
        self.symbols = int(text.max()) + 1
        differs = np.append(text[1:] != text[:-1], True)
        turn = np.where(differs, np.arange(n, dtype=np.int32), np.int32(n))
        turn = np.minimum.accumulate(turn[::-1])[::-1]  # where the run of equal symbols ends
        self.run = np.minimum(turn - np.arange(n, dtype=np.int32) + 1, depth).astype(np.uint16)
        rises = np.append(text[1:] > text[:-1], True)
        self.small = rises[turn]  # S-type: smaller than the suffix after it
        # whether the symbol before is there and of that type
        self.leads_small, self.leads_large = np.append(False, self.small[:-1]), np.append(False, ~self.small[:-1])
        self.lms = np.flatnonzero(self.small & self.leads_large).astype(np.int32)

    def _induce(self, batch: np.ndarray, queues: Queues, small: bool, carry: np.ndarray | None) -> None:
        """Put the predecessors of the given type of a batch of sorted tuples into their buckets.

        ``carry[c]``: least common prefix over what has been taken since bucket c last got a tuple (-1: it never did); None: order only.
        """
        pos = batch["pos"]
        at = np.flatnonzero(self.leads_small[pos] if small else self.leads_large[pos])
        before = pos[at] - 1
        symbol = self.text[before]
        order = np.argsort(symbol, kind="stable")
        symbol = symbol[order]
        cuts = [0, *(np.flatnonzero(symbol[1:] != symbol[:-1]) + 1).tolist(), len(at)] if len(at) else [0]
        runs = [(int(symbol[lo]), lo, hi) for lo, hi in itertools.pairwise(cuts)]
        if carry is None:
            put = tuples(before[order], 0)
            for c, lo, hi in runs:
                queues.put(c, put[lo:hi].copy())
            return
        gap = batch["lcp"]
        least = int(gap.min())
        got = {c: order[lo:hi] for c, lo, hi in runs}
        rest = carry > least
        for c in got:
            rest[c] = False
        ends = {}
        for c, mine in got.items():
            t = at[mine]
            cuts = np.concatenate([[0], t + 1])
            whole = cuts[-1] >= len(gap)
            low = np.minimum.reduceat(gap, cuts[:-1] if whole else cuts).astype(np.int32)
            ends[c] = self.depth if whole else int(low[-1])
            low = low[: len(t)]
            low[0] = min(int(low[0]), int(carry[c])) if carry[c] >= 0 else -1
            queues.put(c, tuples(before[mine], np.minimum(low + 1, self.depth)))
        carry[rest] = least
        for c, low_end in ends.items():
            carry[c] = low_end

    def _pass(self, seeds: Queues | Turned, small: bool, prefixes: bool) -> Queues:
        """Sorted tuples of one type per symbol; ``seeds`` are the other type's, sorted, which open each bucket's second part."""
        queues, out = Queues(self.symbols, self.spill), Queues(self.symbols, self.spill)
        carry = np.full(self.symbols, -1, np.int32) if prefixes else None
        for c in range(self.symbols - 1, -1, -1) if small else range(self.symbols):
            last, fresh = -1, True
            while len(batch := queues.take(c)):
                batch = batch.copy()
                if fresh:
                    batch["lcp"][0], fresh = 0, False
                out.put(c, batch)
                last = int(batch["pos"][-1])
                self._induce(batch, queues, small, carry)
            if len(batch := seeds.get(c)):
                batch = batch.copy()
                batch["lcp"][0] = 0 if last < 0 else min(self.run[last], self.run[batch["pos"][0]])
                self._induce(batch, queues, small, carry)
        return out

    def _by_symbol(self, pos: np.ndarray, lcp: np.ndarray | int) -> Queues:
        """Tuples of sorted suffixes dealt to their first symbols; a bucket's first common prefix is 0."""
        kinds, first = np.unique(self.text[pos], return_index=True)
        out = Queues(self.symbols, self.spill)
        for c, part in zip(kinds.tolist(), np.split(tuples(pos, lcp), first[1:]), strict=True):
            out.put(c, part)
        return out

    def _both(self, pos: np.ndarray, lcp: np.ndarray | int, prefixes: bool = True) -> tuple[Queues, Queues]:
        large = self._pass(self._by_symbol(pos, lcp), False, prefixes)
        return large, self._pass(Turned(large), True, prefixes)

    def _names(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted order of the LMS substrings (indices into ``lms``), and the name of each in text order."""
        text, lms = self.text, self.lms
        _, small = self._both(lms[np.argsort(text[lms], kind="stable")], 0, prefixes=False)
        place = np.full(len(text), -1, np.int32)  # of an LMS position in ``lms``
        place[lms] = np.arange(len(lms), dtype=np.int32)
        end = lms[-1]  # the last separator has no symbol after it and comes first
        found = [np.array([end], np.int32)]
        for c in range(self.symbols):
            pos = small.get(c)["pos"][::-1]
            found.append(pos[(place[pos] >= 0) & (pos != end)])
        order = place[np.concatenate(found)]
        until = np.append(lms[1:], len(text) - 1)
        size = until - lms + 1
        digest = np.empty(len(lms), np.uint64)
        table = np.random.default_rng(7).integers(1, 2**63, self.symbols, np.uint64)
        at = 0
        while at < len(lms):
            to = max(at + 1, int(np.searchsorted(until, lms[at] + HASHED)))
            part = text[lms[at]:until[to - 1] + 1]
            weight = np.cumprod(np.full(len(part), 0x9E3779B97F4A7C15, np.uint64))
            total = np.concatenate([[np.uint64(0)], np.cumsum(table[part] * weight)])
            back = np.cumprod(np.full(len(part), pow(0x9E3779B97F4A7C15, -1, 2**64), np.uint64))
            digest[at:to] = (total[until[at:to] + 1 - lms[at]] - total[lms[at:to] - lms[at]]) * back[lms[at:to] - lms[at]]
            at = to
        fresh = np.append(True, (digest[order][1:] != digest[order][:-1]) | (size[order][1:] != size[order][:-1]))
        name = np.empty(len(lms), np.int32)
        name[order] = np.cumsum(fresh, dtype=np.int32) - 1
        return order, name

    def _sorted_lms(self) -> tuple[np.ndarray, np.ndarray]:
        """LMS suffixes in order, each with its common prefix with the one before.

        A rank is the place of a name's first bearer; a round sorts only the suffixes that share theirs and agree on less than ``depth`` symbols.
        """
        order, name = self._names()
        n = len(order)
        top = np.append(self.lms, np.int32(len(self.text) - 1))
        split = np.ones(n, np.int8)  # the round that told a suffix from the one before it; -1: none yet
        split[1:] = np.where(name[order[1:]] != name[order[:-1]], 0, -1)
        heads = np.flatnonzero(split == 0)
        split[0] = 0
        rank = np.empty(n, np.int32)
        rank[order] = np.repeat(np.append(0, heads), np.diff(np.concatenate([[0], heads, [n]])))
        del name, heads
        levels, step = [rank], 1
        while 2 * step <= self.depth:
            shares = split < 0
            shares[:-1] |= shares[1:]  # the first bearer too
            open_ = np.flatnonzero(shares).astype(np.int32)
            own = order[open_]
            live = top[np.minimum(own + step, n)] - top[own] < self.depth
            open_, own = open_[live], own[live]
            if not len(own):
                break
            key = rank[own].astype(np.int64)
            key *= n + 1
            after = own + np.int32(step)
            key += np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
            turn = np.argsort(key)
            own, key = own[turn], key[turn]
            order[open_] = own
            opens = np.append(True, key[1:] != key[:-1])
            del after, turn, key
            told = open_[opens]
            split[told[split[told] < 0]] = len(levels)
            rank = rank.copy()
            rank[own] = np.repeat(told, np.diff(np.append(np.flatnonzero(opens), len(own))))
            levels.append(rank)
            step *= 2
        common = np.full(n, self.depth, np.uint16)  # of those not told apart
        common[0] = 0
        told = np.flatnonzero(split[1:] >= 0) + 1
        for i in range(0, len(told), PAIRS):
            at = told[i:i + PAIRS]
            common[at] = self._common(order[at - 1], order[at], split[at], levels, top)
        return self.lms[order], common

    def _common(self, above: np.ndarray, below: np.ndarray, told: np.ndarray, levels: list[np.ndarray], top: np.ndarray) -> np.ndarray:
        """Common prefixes, up to ``depth``, of pairs of LMS suffixes that the given rounds told apart."""
        n, last = len(self.lms), len(self.text)
        known = np.where(told > 0, 1 << np.maximum(told.astype(np.int64) - 1, 0), 0)  # names that agree for sure
        a, b = above + known, below + known
        for i in range(len(levels) - 3, -1, -1):
            some = np.flatnonzero((told >= i + 2) & (a < n) & (b < n))
            some = some[levels[i][a[some]] == levels[i][b[some]]]
            a[some] += 1 << i
            b[some] += 1 << i
        a, b = np.minimum(a, n), np.minimum(b, n)
        common = (top[a] - top[above]).astype(np.int64)
        live = np.flatnonzero(common < self.depth)
        p, q, far = top[a[live]].astype(np.int64), top[b[live]].astype(np.int64), common[live]
        while len(live):
            go = np.flatnonzero((p < last) & (q < last))
            go = go[self.text[p[go]] == self.text[q[go]]]
            live, p, q, far = live[go], p[go] + 1, q[go] + 1, far[go] + 1
            common[live] = far
            go = far < self.depth
            if not go.all():
                live, p, q, far = live[go], p[go], q[go], far[go]
        return np.minimum(common, self.depth)

    def repeated(self) -> np.ndarray:
        """Mask of the positions whose next ``depth`` symbols also start somewhere else."""
        out = np.zeros(len(self.text), bool)
        if not len(self.lms):
            return out
        large, small = self._both(*self._sorted_lms())
        for c in range(self.symbols):
            up, down = large.get(c), small.get(c)
            for t in (up, down):
                far = np.flatnonzero(t["lcp"][1:] >= self.depth) + 1
                out[t["pos"][far]] = out[t["pos"][far - 1]] = True
            if len(up) and len(down) and min(self.run[up["pos"][-1]], self.run[down["pos"][-1]]) >= self.depth:
                out[up["pos"][-1]] = out[down["pos"][-1]] = True
        return out
