"""Suffix array with common-prefix values by external induced sorting.

A text is an array of symbols that ends with a 0 found nowhere else. A suffix is small (S) or large (L) against
the one behind it; an S suffix behind an L suffix is a seed. Seeds are sorted by sorting the pieces between them,
naming these in order, and sorting the suffixes of the string of names the same way, one level deeper, unless the
names tell all seeds apart. From the sorted seeds the L suffixes are induced in ascending order, from these the S
suffixes in descending order: a suffix taken from a priority queue yields the one before it, which enters the
queue as a tuple of its first symbols, the rank of the suffix that yielded it, and its position.

Common prefixes go the same way. Two neighbours that were induced share their first symbol and what their sources
share, which is the smallest value between the sources' ranks; a level hands what names share to the level above,
where different pieces add what they share. Values are capped: nobody asks by how much a prefix is longer than the cap.

Arrays and queue live in files of a scratch folder and are worked on in blocks, so a text may be far larger than
memory. The queue is cut at sampled symbol prefixes into intervals of about ``BATCH`` suffixes; one interval at a
time is in memory, with the suffixes that its own members yield into it. An interval cannot be cut where more
suffixes than that begin with the same symbols; texts of equal pieces only are best made one before.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np

# Suffixes of an interval, positions of a block, queued tuples in memory before they go to files.
BATCH, BLOCK, QUEUED = 1 << 18, 1 << 18, 1 << 20
# Arrays up to so many bytes stay in memory: those of a text of some million symbols.
IN_MEMORY = 1 << 23
SAMPLE = 1 << 15
SPAN = 16


@dataclass
class Scratch:
    """Arrays in files of a folder that its owner deletes. A file has no name once it is an array: it goes with it."""

    folder: str
    made: int = 0

    def path(self) -> str:
        self.made += 1
        return os.path.join(self.folder, str(self.made))

    def array(self, size: int, dtype) -> np.ndarray:
        if size * np.dtype(dtype).itemsize <= IN_MEMORY:
            return np.zeros(size, dtype)
        path = self.path()
        mapped = np.memmap(path, dtype, "w+", shape=(size,)).view(np.ndarray)
        os.unlink(path)
        return mapped


def blocks(n: int, size: int = 0) -> Iterator[tuple[int, int]]:
    size = size or BLOCK
    for start in range(0, n, size):
        yield start, min(n, start + size)


class RangeMin:
    """Smallest value of a range of an array that grows at its end."""

    def __init__(self, scratch: Scratch, size: int):
        size += SPAN
        self.n, self.spans = 0, 0
        self.values, self.from_left, self.from_right = (scratch.array(size, np.uint16) for _ in range(3))
        count = size // SPAN + 1
        self.levels = [scratch.array(count, np.uint16) for _ in range(max(1, count.bit_length()))]

    def append(self, values: np.ndarray) -> None:
        for start, end in blocks(len(values)):
            self._append(values[start:end])

    def _append(self, values: np.ndarray) -> None:
        first = self.n // SPAN * SPAN
        self.values[self.n : self.n + len(values)] = values
        self.n += len(values)
        last = -(-self.n // SPAN) * SPAN
        self.values[self.n : last] = 0xFFFF
        rows = np.asarray(self.values[first:last]).reshape(-1, SPAN)
        self.from_left[first:last] = np.minimum.accumulate(rows, axis=1).ravel()
        self.from_right[first:last] = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        new, end = first // SPAN, last // SPAN
        self.levels[0][new:end] = self.from_left[first + SPAN - 1 : last : SPAN]
        for k in range(1, len(self.levels)):
            half = 1 << (k - 1)
            at = np.arange(max(new, 2 * half - 1), end)
            if not len(at):
                break
            self.levels[k][at] = np.minimum(self.levels[k - 1][at], self.levels[k - 1][at - half])

    def query(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Smallest of values[low..high], both ends included; ranges are not empty."""
        left, right = low // SPAN, high // SPAN
        out = np.empty(len(low), np.uint16)
        near = left == right
        if near.any():
            a, b = low[near], high[near]
            least = self.values[a]
            for step in range(1, SPAN):
                at = a + step
                more = at <= b
                if not more.any():
                    break
                least = np.where(more, np.minimum(least, self.values[np.where(more, at, a)]), least)
            out[near] = least
        far = np.flatnonzero(~near)
        if len(far):
            least = np.minimum(self.from_right[low[far]], self.from_left[high[far]])
            count = right[far] - left[far] - 1
            for k in range(int(count.max()).bit_length()):
                at = np.flatnonzero((count > 0) & (np.frexp(count)[1] - 1 == k))
                if len(at):
                    table, end = self.levels[k], right[far[at]] - 1
                    begin = left[far[at]] + (1 << k)
                    least[at] = np.minimum(least[at], np.minimum(table[end], table[begin]))
            out[far] = least
        return out


@dataclass
class Queue:
    """Tuples by interval, in memory up to a limit and in one file per interval beyond it."""

    scratch: Scratch
    bounds: np.ndarray
    held: dict[int, list[np.ndarray]] = field(default_factory=dict)
    files: dict[int, str] = field(default_factory=dict)
    n: int = 0

    def push(self, code: np.ndarray, rank: np.ndarray, pos: np.ndarray) -> None:
        if not len(code):
            return
        place = np.searchsorted(self.bounds, code, side="right")
        order = np.argsort(place, kind="stable")
        rows = np.stack([code, rank, pos], axis=1)[order]
        place = place[order]
        edges = np.flatnonzero(np.diff(place)) + 1
        for start, end in zip([0, *edges], [*edges, len(place)]):
            self.held.setdefault(int(place[start]), []).append(rows[start:end])
        self.n += len(code)
        if self.n > QUEUED:
            for interval, parts in self.held.items():
                path = self.files.setdefault(interval, self.scratch.path())
                with open(path, "ab") as out:
                    for part in parts:
                        part.tofile(out)
            self.held, self.n = {}, 0

    def pull(self, interval: int) -> np.ndarray:
        """All tuples of an interval, in no order."""
        parts = self.held.pop(interval, [])
        self.n -= sum(map(len, parts))
        path = self.files.pop(interval, None)
        if path:
            parts = [np.fromfile(path, np.int64).reshape(-1, 3), *parts]
            os.remove(path)
        return np.concatenate(parts) if parts else np.zeros((0, 3), np.int64)


class Level:
    """A text with what its suffixes are: type, and how often their first symbol is repeated."""

    def __init__(self, scratch: Scratch, text: np.ndarray, n: int, largest: int, cap: int):
        """``text`` holds ``n`` symbols up to ``largest``, then two zeros."""
        self.scratch, self.text, self.n, self.cap = scratch, text, n, cap
        self.bits = max(1, int(largest + 1).bit_length())
        # Symbols that go before a queue tuple, and into a chunk of a piece.
        self.prefix = 3 if 3 * self.bits <= 32 else 1
        self.chunk = 62 // self.bits
        self.pos_type = np.int32 if n < 2**31 else np.int64
        self.small = scratch.array(n, np.bool_)
        self.runs = scratch.array(n, np.uint16)
        self._scan()

    def _scan(self) -> None:
        kind, run = True, 0
        for start, end in reversed(list(blocks(self.n))):
            here, behind = self.text[start:end].astype(np.int64), self.text[start + 1 : end + 1].astype(np.int64)
            if end == self.n:
                behind[-1] = 1  # nothing is smaller than the end
            at = np.arange(end - start)
            change = np.minimum.accumulate(np.where(here != behind, at, end - start)[::-1])[::-1]
            inside = change < end - start
            turn = np.minimum(change, end - start - 1)
            small = np.where(inside, here[turn] < behind[turn], kind)
            runs = np.where(inside, change - at + 1, end - start - at + run)
            self.small[start:end], self.runs[start:end] = small, np.minimum(runs, self.cap)
            kind, run = bool(small[0]), int(min(runs[0], self.cap))

    def seeds(self) -> np.ndarray:
        count, parts = 0, []
        for start, end in blocks(self.n):
            before = self.small[start - 1 : end - 1] if start else np.append(True, self.small[: end - 1])
            found = np.flatnonzero(self.small[start:end] & ~before) + start
            parts.append(self._kept(found))
            count += len(found)
        out = self.scratch.array(count, self.pos_type)
        at = 0
        for part in parts:
            out[at : at + len(part)] = part
            at += len(part)
        return out

    def _kept(self, found: np.ndarray) -> np.ndarray:
        out = self.scratch.array(len(found), self.pos_type)
        out[:] = found
        return out

    def codes(self, pos: np.ndarray) -> np.ndarray:
        """The first symbols of suffixes as one number."""
        code = self.text[pos].astype(np.int64)
        for step in range(1, self.prefix):
            code = code << self.bits | self.text[np.minimum(pos + step, self.n)]
        return code

    def shared(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Leading symbols that two different codes share."""
        apart = one ^ other
        return sum(((apart >> self.bits * step) == 0).astype(np.int64) for step in range(1, self.prefix)) if self.prefix > 1 else np.zeros(len(one), np.int64)

    # Names of the pieces between seeds ------------------------------------------------------------------

    def _piece(self, start: np.ndarray, length: np.ndarray, step: int) -> np.ndarray:
        """Chunk ``step`` of each piece. Behind a piece's end stands a symbol above all: of two pieces of which one
        begins the other the longer one is smaller, as its symbol there begins an L suffix."""
        beyond, code = (1 << self.bits) - 1, np.zeros(len(start), np.int64)
        for offset in range(step * self.chunk, (step + 1) * self.chunk):
            inside = offset < length
            symbol = np.where(inside, self.text[np.minimum(start + offset, self.n)], beyond)
            code = code << self.bits | symbol
        return code

    @staticmethod
    def pieces(seeds: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and length of pieces; a piece ends with the first symbol of the next one."""
        start, last = seeds[at].astype(np.int64), at == len(seeds) - 1
        return start, np.where(last, 1, seeds[np.where(last, at, at + 1)] - start + 1)

    def names(self, seeds: np.ndarray) -> tuple[np.ndarray, int]:
        """The name of each piece in text order, and how many names there are."""
        m = len(seeds)
        names = self.scratch.array(m + 2, np.int64)
        rnd = np.random.default_rng(3)
        some = self._piece(*self.pieces(seeds, np.sort(rnd.integers(0, m, min(m, SAMPLE)))), 0)
        queue = Queue(self.scratch, _bounds(some, m))
        for start, end in blocks(m):
            at = np.arange(start, end)
            queue.push(self._piece(*self.pieces(seeds, at), 0), at, at)
        count = 0
        for interval in range(len(queue.bounds) + 1):
            rows = queue.pull(interval)
            if len(rows):
                at, group = self._sorted_pieces(rows, lambda at: self.pieces(seeds, at))
                new = np.diff(group, prepend=-1) != 0
                names[at] = count + np.cumsum(new) - 1
                count += int(new.sum())
        return names, count

    def _sorted_pieces(self, rows: np.ndarray, pieces):
        order = np.argsort(rows[:, 0], kind="stable")
        at = rows[order, 1]
        start, length = pieces(at)
        code = rows[order, 0]
        group = _firsts(np.diff(code, prepend=-1) != 0)
        step = 1
        while True:
            sizes = np.bincount(group, minlength=len(group))
            open_ = np.flatnonzero((sizes[group] > 1) & (length > step * self.chunk))
            # Pieces that ended differ already from longer ones: both sorts of their group carry a chunk.
            open_ = np.flatnonzero((sizes[group] > 1) & np.isin(group, np.unique(group[open_]))) if len(open_) else open_
            if not len(open_):
                return at, group
            code = self._piece(start[open_], length[open_], step)
            order = np.lexsort((code, group[open_]))
            moved = open_[order]
            at[open_], start[open_], length[open_] = at[moved], start[moved], length[moved]
            code, old = code[order], group[open_]
            new = (np.diff(code, prepend=-1) != 0) | (np.diff(old, prepend=-1) != 0)
            group[open_] = open_[_firsts(new)]
            step += 1

    def shared_pieces(self, a: np.ndarray, a_length: np.ndarray, b: np.ndarray, b_length: np.ndarray) -> np.ndarray:
        """Symbols that suffixes share whose pieces differ, capped."""
        out = np.full(len(a), self.cap, np.int64)
        active, step = np.arange(len(a)), 0
        while len(active) and step * self.chunk < self.cap:
            one = self._piece(a[active], a_length[active], step)
            other = self._piece(b[active], b_length[active], step)
            differ = one != other
            at = active[differ]
            apart = one[differ] ^ other[differ]
            same = np.zeros(len(at), np.int64)
            for k in range(1, self.chunk):
                same += (apart >> self.bits * (self.chunk - k)) == 0
            same += step * self.chunk
            # Where the shorter piece ended, its last symbol begins an S suffix and the other's an L suffix.
            short = np.minimum(a_length[at], b_length[at])
            ended = same >= short
            edge = np.where(ended, short - 1, 0)
            more = np.minimum(self.runs[a[at] + edge], self.runs[b[at] + edge]).astype(np.int64)
            out[at] = np.where(ended, edge + more, same)
            active, step = active[~differ], step + 1
        return np.minimum(out, self.cap)

    # Induction ------------------------------------------------------------------------------------------

    def induce(self, seeds: np.ndarray, shares: np.ndarray, ascending: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions, shared symbols with the one before, and which are seeds, of seeds and induced suffixes in order.

        ``ascending`` induces L suffixes from the smallest up, else S suffixes from the largest down.
        """
        flip = 0 if ascending else (1 << self.bits * self.prefix) - 1
        wanted = not ascending  # small[p] of what is induced
        rnd = np.random.default_rng(5)
        some = self.codes(np.sort(rnd.integers(0, self.n, min(self.n, SAMPLE)))) ^ flip
        queue = Queue(self.scratch, _bounds(some, self.n))
        size = self.n + 1
        out_pos, out_seed = self.scratch.array(size, self.pos_type), self.scratch.array(size, np.bool_)
        merged, of_seeds = RangeMin(self.scratch, size), RangeMin(self.scratch, len(seeds))
        for start, end in blocks(len(shares)):
            of_seeds.append(shares[start:end])
        taken, base, before = 0, 0, None
        for interval in range(len(queue.bounds) + 1):
            high = queue.bounds[interval] if interval < len(queue.bounds) else np.iinfo(np.int64).max
            rows = queue.pull(interval)
            mine, upto = [], taken
            while upto < len(seeds):
                part = seeds[upto : upto + BLOCK].astype(np.int64)
                code = self.codes(part) ^ flip
                fit = int(np.searchsorted(code, high))
                mine.append((part[:fit], code[:fit]))
                upto += fit
                if fit < len(part):
                    break
            batch = _Batch(self, rows, mine, taken, flip, high, wanted)
            taken = upto
            if not len(batch.pos):
                continue
            order, share = batch.sorted(merged, of_seeds, before)
            end = base + len(order)
            out_pos[base:end], out_seed[base:end] = batch.pos[order], batch.seed[order]
            merged.append(share)
            pushed = np.flatnonzero(batch.yields[order])
            queue.push(batch.before_code[order[pushed]], base + pushed, batch.pos[order[pushed]] - 1)
            before, base = batch.code[order[-1]], end
        return out_pos[:base], merged.values[:base], out_seed[:base]


def _bounds(sample: np.ndarray, n: int) -> np.ndarray:
    """Values that cut the n numbers the sample stands for into intervals of about ``BATCH``."""
    count = n // BATCH
    at = np.linspace(0, len(sample), count + 1)[1:-1].astype(int) if count > 1 else []
    return np.unique(np.sort(sample)[at]) if len(at) else np.zeros(0, np.int64)


def _firsts(new: np.ndarray) -> np.ndarray:
    """For each place that of the last True up to it."""
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


class _Batch:
    """The suffixes of an interval: pulled from the queue, seeds, and what these yield into the interval itself."""

    def __init__(self, level: Level, rows: np.ndarray, mine, first_seed: int, flip: int, high: int, wanted: bool):
        self.level, self.flip = level, flip
        seed_pos = np.concatenate([p for p, _ in mine]) if mine else np.zeros(0, np.int64)
        seed_code = np.concatenate([c for _, c in mine]) if mine else np.zeros(0, np.int64)
        pos, code = [rows[:, 2], seed_pos], [rows[:, 0], seed_code]
        source = [rows[:, 1], first_seed + np.arange(len(seed_pos))]
        parent = [np.full(len(rows) + len(seed_pos), -1)]
        yields, before_code, start = [], [], 0
        front = np.concatenate(pos)
        while len(front):
            ahead = front - 1
            can = ahead >= 0
            ahead = np.maximum(ahead, 0)
            can &= level.small[ahead] == wanted
            codes = np.where(can, level.codes(ahead) ^ flip, 0)
            inside = can & (codes < high)
            yields.append(can & ~inside)
            before_code.append(codes)
            new = np.flatnonzero(inside)
            pos.append(ahead[new])
            code.append(codes[new])
            source.append(np.full(len(new), -1))
            parent.append(start + new)
            start += len(front)
            front = ahead[new]
        self.pos, self.code = np.concatenate(pos), np.concatenate(code)
        self.source, self.parent = np.concatenate(source), np.concatenate(parent)
        self.seed = np.zeros(len(self.pos), bool)
        self.seed[len(rows) : len(rows) + len(seed_pos)] = True
        self.yields = np.concatenate(yields) if yields else np.zeros(0, bool)
        self.before_code = np.concatenate(before_code) if before_code else np.zeros(0, np.int64)

    def sorted(self, merged: RangeMin, of_seeds: RangeMin, before: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Order, and symbols shared with the one before. Equal first symbols: induced ones before seeds, of these
        ones with sources of earlier intervals before ones with sources in this."""
        n = len(self.pos)
        inner = self.parent >= 0
        key = self.code << 2 | self.seed.astype(np.int64) << 1 | inner
        order = np.lexsort((self.source, key))
        new = (np.diff(key[order], prepend=-1) != 0) | (np.diff(self.source[order], prepend=-2) != 0)
        rank = np.empty(n, np.int64)
        rank[order] = _firsts(new)
        jump = np.where(inner, self.parent, np.arange(n))
        # Sources in the interval: ranks by twice as many steps of the chain of sources each time.
        while True:
            placed = rank[order]
            sizes = np.bincount(placed, minlength=n)
            tied = np.flatnonzero(sizes[placed] > 1)
            if not len(tied):
                break
            some = order[tied]
            further, old = rank[jump[some]], placed[tied]
            again = np.lexsort((further, old))
            order[tied] = some[again]
            split = (np.diff(further[again], prepend=-1) != 0) | (np.diff(old, prepend=-1) != 0)
            rank[order[tied]] = tied[_firsts(split)]
            jump = jump[jump]
        return order, self._shared(order, merged, of_seeds, before)

    def _shared(self, order: np.ndarray, merged: RangeMin, of_seeds: RangeMin, before: int | None) -> np.ndarray:
        level = self.level
        out = np.zeros(len(order), np.int64)
        if before is not None:
            out[0] = level.shared(np.array([before]), self.code[order[:1]])[0]
        active, a, b, steps = np.arange(1, len(order)), order[:-1], order[1:], 0
        while len(active):
            code_a, code_b, seed_a, seed_b = self.code[a], self.code[b], self.seed[a], self.seed[b]
            differ = code_a != code_b
            out[active[differ]] = steps + level.shared(code_a[differ], code_b[differ])
            mixed = ~differ & (seed_a != seed_b)
            out[active[mixed]] = steps + np.minimum(level.runs[self.pos[a[mixed]]], level.runs[self.pos[b[mixed]]]).astype(np.int64)
            seeds = ~differ & seed_a & seed_b
            out[active[seeds]] = steps + of_seeds.query(self.source[a[seeds]] + 1, self.source[b[seeds]]).astype(np.int64)
            induced = ~differ & ~seed_a & ~seed_b
            active, a, b, steps = active[induced], a[induced], b[induced], steps + 1
            in_a, in_b = self.parent[a] >= 0, self.parent[b] >= 0
            outer = ~in_a & ~in_b
            out[active[outer]] = steps + merged.query(self.source[a[outer]] + 1, self.source[b[outer]]).astype(np.int64)
            mixed = in_a != in_b
            ends = [level.codes(self.pos[x[mixed]] + 1) for x in (a, b)]
            out[active[mixed]] = steps + level.shared(*ends)
            inner = in_a & in_b
            active, a, b = active[inner], self.parent[a[inner]], self.parent[b[inner]]
            if steps >= level.cap:
                out[active] = level.cap
                break
        return np.minimum(out, level.cap).astype(np.uint16)


def suffix_array(scratch: Scratch, text: np.ndarray, n: int, largest: int, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and what each shares with the one before it, up to ``cap``.

    ``text`` holds ``n`` symbols, the last of them the only 0, and two more zeros.
    """
    pos_type = np.int32 if n < 2**31 else np.int64
    if n == 1:
        return np.zeros(1, pos_type), np.zeros(1, np.uint16)
    level = Level(scratch, text, n, largest, cap)
    seeds = level.seeds()
    m = len(seeds)
    names, count = level.names(seeds)
    order, shares = scratch.array(m, pos_type), scratch.array(m, np.uint16)
    if count == m:
        for start, end in blocks(m):
            order[names[start:end]] = np.arange(start, end)
        equal_names = None
    else:
        order, equal_names = suffix_array(scratch, names, m, count - 1, cap // 2 + 1)
    for start, end in blocks(m):
        here = order[start:end].astype(np.int64)
        prior = order[start - 1 : end - 1].astype(np.int64) if start else np.append(here[:1], order[: end - 1])
        # Equal names cover whole pieces; the first different ones share what their pieces do.
        equal = np.zeros(len(here), np.int64) if equal_names is None else equal_names[start:end].astype(np.int64)
        far = (equal > cap // 2) | (here == prior)
        equal = np.where(far, 0, equal)
        found = seeds[here + equal].astype(np.int64) - seeds[here]
        found += level.shared_pieces(*level.pieces(seeds, here + equal), *level.pieces(seeds, prior + equal))
        shares[start:end] = np.where(far, cap, np.minimum(found, cap))
    shares[:1] = 0
    in_order = scratch.array(m, pos_type)
    for start, end in blocks(m):
        in_order[start:end] = seeds[order[start:end]]
    large, large_shares = _induced_only(scratch, *level.induce(in_order, shares, True), pos_type)
    down, down_shares = large[::-1], np.append(large_shares[:0], _turned(scratch, large_shares))
    pos, shared, _ = level.induce(down, down_shares, False)
    result, result_shares = scratch.array(n, pos_type), scratch.array(n, np.uint16)
    # The end itself is the smallest suffix and is induced by none.
    result[0] = n - 1
    for start, end in blocks(len(pos)):
        result[n - end : n - start] = pos[start:end][::-1]
    turned = _turned(scratch, shared)
    for start, end in blocks(len(pos)):
        result_shares[1 + start : 1 + end] = turned[start:end]
    return result, result_shares


def _turned(scratch: Scratch, shares: np.ndarray) -> np.ndarray:
    """Shares of the reversed order: what stood between two stays between them."""
    n = len(shares)
    out = scratch.array(n, np.uint16)
    for start, end in blocks(n - 1):
        out[n - end : n - start] = shares[1 + start : 1 + end][::-1]
    return out


def _induced_only(scratch: Scratch, pos: np.ndarray, shares: np.ndarray, seed: np.ndarray, pos_type) -> tuple[np.ndarray, np.ndarray]:
    """The induced suffixes alone, each with the smallest value since the induced one before it."""
    count = sum(int((~seed[s:e]).sum()) for s, e in blocks(len(seed)))
    out, out_shares = scratch.array(count, pos_type), scratch.array(count, np.uint16)
    at, least = 0, 0xFFFF
    for start, end in blocks(len(seed)):
        mine = np.flatnonzero(~seed[start:end])
        values = np.asarray(shares[start:end])
        if not len(mine):
            least = min(least, int(values.min()))
            continue
        begins = np.append(0, mine[:-1] + 1)
        share = np.minimum.reduceat(values, begins)
        # reduceat runs to the next beginning; the last one must stop at its own suffix.
        share[-1] = values[begins[-1] : mine[-1] + 1].min()
        share[0] = min(share[0], least)
        out[at : at + len(mine)], out_shares[at : at + len(mine)] = pos[start:end][mine], share
        rest = values[mine[-1] + 1 :]
        least = int(rest.min()) if len(rest) else 0xFFFF
        at += len(mine)
    if count:
        out_shares[0] = 0
    return out, out_shares
