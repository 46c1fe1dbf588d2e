"""Row-level parts of the n-gram Jaccard join: shingle sets, routing keys, and signature trees over a block of sets."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np

SLICE = 1 << 18
FANOUT = 8
BATCH = 512
PAIRS = 1 << 18
MAP_BYTES = 1 << 18
SKETCH_BITS = (64, 1 << 14)
SKETCH_SETS = 1 << 13
SKETCH_WORDS = 1 << 18

# Fixed odd multipliers of the hash.
BASE, MIX_A, MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``BASE`` and of its inverse modulo 2**64."""
    if len(_POWERS[0]) < n:
        base = int(BASE)
        for i, b in enumerate((base, pow(base, -1, 1 << 64))):
            steps = np.full(n, b, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word (run without ASCII white space, A-Z in lower case), in order; slices bound the memory."""
    data = text.encode("utf-8", "surrogatepass").lower()
    found, start = [], 0
    while start < len(data):
        end = min(len(data), start + SLICE)
        while end < len(data) and data[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        found.append(_slice_hashes(np.frombuffer(data, np.uint8, end - start, start)))
        start = end
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def _slice_hashes(b: np.ndarray) -> np.ndarray:
    gap = np.ones(len(b) + 2, np.int8)
    gap[1:-1] = (b == 32) | ((b >= 9) & (b <= 13))
    edge = np.diff(gap)
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    powers, inverse = _powers(len(b) + 1)
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * powers[: len(b)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * MIX_B)


def shingles(text: str | None, size: int = 4) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``size`` words; of the whole sequence if it is shorter; empty without words."""
    h = word_hashes(text) if text else np.empty(0, np.uint64)
    if not len(h):
        return h
    width = min(size, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for i in range(width):
        out = mix(out * BASE + h[i : len(h) - width + 1 + i])
    return np.unique(out)


def packed(hashes: np.ndarray) -> bytes:
    """The upper 48 bits of each hash, six bytes each, in order."""
    return hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    """Hashes from ``packed`` ones, the lower 16 bits made of the upper ones; sorted and distinct."""
    wide = np.zeros((len(data) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    found = wide.view(">u8").ravel().astype(np.uint64)
    return np.unique(found | (mix(found) >> np.uint64(48)))


def sketch(hashes: np.ndarray) -> bytes:
    """A bitmap of about a bit an element: a bit is set where an odd number of elements fall.

    Two bitmaps of one size differ in no more bits than their sets do in elements. The larger of two is
    brought to the size of the smaller by folding it, its halves added up without carry. Of a hash the
    upper 48 bits count, as in ``packed``.
    """
    least, most = SKETCH_BITS
    bits = min(most, max(least, 1 << max(len(hashes) - 1, 1).bit_length()))
    upper = hashes >> np.uint64(16)  # sorted, as the hashes are
    distinct = upper[np.concatenate([[True], upper[1:] != upper[:-1]])] if len(upper) else upper
    at = (mix(distinct) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8)).tobytes()


def _folded(data: bytes, size: int) -> np.ndarray:
    return np.bitwise_xor.reduce(np.frombuffer(data, np.uint64).reshape(-1, size // 8), axis=0)


def promising(sketches: list[bytes], sizes: np.ndarray, percent: int, label: np.ndarray, side: np.ndarray | None = None) -> np.ndarray:
    """Whether each set may be linked with another of another ``label`` (and ``side``, if given). No set that is is missed.

    Linked sets differ in at most (100 - percent) / (100 + percent) of the sum of their sizes. More than ``SKETCH_SETS``
    sets are not compared: all may be linked.
    """
    if len(sketches) > SKETCH_SETS:
        return np.ones(len(sketches), bool)
    widths, found = np.array([len(s) for s in sketches]), np.zeros(len(sketches), bool)
    for width in np.unique(widths):
        others = np.flatnonzero((widths >= width) & (percent * sizes <= 100 * sizes[widths == width].max()))
        maps = np.stack([_folded(sketches[i], width) for i in others])
        here = np.flatnonzero(widths[others] == width)
        step = max(1, SKETCH_WORDS // maps.size)
        for start in range(0, len(here), step):
            at = here[start : start + step]
            a, b = others[at], others
            apart = np.bitwise_count(maps[at][:, None, :] ^ maps[None, :, :]).sum(axis=2, dtype=np.int64)
            both = sizes[a][:, None] + sizes[b][None, :]
            near = ((100 + percent) * apart <= (100 - percent) * both) & (label[a][:, None] != label[b][None, :])
            if side is not None:
                near &= side[a][:, None] != side[b][None, :]
            found[a] |= near.any(axis=1)
            found[b] |= near.any(axis=0)
    return found


def digest(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


class Router:
    """Keys under which two sets meet whenever ``100 * intersection >= percent * union`` and the sets differ.

    Such sets differ in at most D(n) elements, n being the smaller size. Elements are dealt by hash into
    segments, more than D(n) of them, so some segment is the same in both (the pigeonhole principle): its
    content is a key. Sizes form classes of ratio 1.5 with one number of segments each; a set has keys for
    every class a smaller partner can be in. Empty segments would match by chance and are left out; segments beyond
    D(n) + 1 make up for them. A set in which too many are missing (few are) also emits the empty ones, under
    marked keys that only such sets have, so no pair is lost.
    """

    def __init__(self, percent: int = 85):
        self.percent = percent

    def differ(self, n: int) -> int:
        return n * (100 - self.percent) // self.percent

    def reach(self, n: int) -> int:
        """Segments looked at for a set of n elements."""
        d = self.differ(n)
        return d + 5 + -(-d * 35 // 100)

    def ranges(self, n: int) -> list[tuple[int, int]]:
        """First and last size of all classes up to the one of n."""
        least = next((i for i in range(1, 10_000) if self.differ(i)), None)
        if least is None:
            return []
        out, first = [], least
        while first <= n:
            out.append((first, max(first, first * 3 // 2)))
            first = out[-1][1] + 1
        return out

    def classes(self, n: int) -> list[tuple[int, int]]:
        """First and last size of the classes in which n itself or a smaller partner of n lies."""
        low = -(-n * self.percent // 100)
        return [(first, last) for first, last in self.ranges(n) if last >= low]

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        return self.marked_keys(hashes)[0]

    def marked_keys(self, hashes: np.ndarray, only: Callable[[int], bool] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(keys, first size of each key's class, how many keys of that class the set can do without).

        A set that has that many keys too many still shares another one with each linked set, if a key is left out by all sets
        that can do without it. -1: none can be left out. ``only`` says which classes are wanted, by their first size.
        """
        n, out = len(hashes), []
        mixed = None
        for first, last in self.classes(n):
            if only is not None and not only(first):
                continue
            if mixed is None:
                mixed = mix(hashes)
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed)])
            segments, top = self.reach(last), self.reach(min(n, last))
            place = ((hashes >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
            bounds = np.searchsorted(place, np.arange(top + 1).astype(np.uint64))
            counts = np.diff(bounds)
            big = counts > 0
            names = (np.uint64(first) << np.uint64(34)) + (np.arange(top).astype(np.uint64) << np.uint64(1))
            content = sums[bounds[1:]] - sums[bounds[:-1]]
            whole = np.concatenate([[0], np.cumsum(big)])
            sizes = range(max(first, -(-n * self.percent // 100)), min(n, last) + 1)
            spare = max(-1, min((int(whole[self.reach(s)]) - self.differ(s) - 1 for s in sizes), default=-1))
            found = mix(content[big] + mix(names[big]))
            out.append((found, first, spare))
            if spare < 0 and len(sizes):
                out.append((mix(content[~big] + mix(names[~big] + np.uint64(1))), first, -1))
        if not out:
            return np.empty(0, np.uint64), np.empty(0, np.int32), np.empty(0, np.int32)
        lengths = [len(k) for k, _, _ in out]
        return (np.concatenate([k for k, _, _ in out]), np.repeat([f for _, f, _ in out], lengths).astype(np.int32), np.repeat([s for _, _, s in out], lengths).astype(np.int32))


class Tree:
    """A signature tree over sets: each node has the OR of its sets' bitmaps and the range of their sizes.

    Level 0 has the sets themselves, in order of size; a node on level i + 1 covers ``FANOUT`` nodes of level i.
    ``extra`` is the most elements that any set below loses by hash collisions in its bitmap.
    """

    def __init__(self, sets: list[np.ndarray], bits: int):
        maps = np.zeros((len(sets), bits // 64), np.uint64)
        for row, s in zip(maps, sets, strict=True):
            at = s & np.uint64(bits - 1)
            np.bitwise_or.at(row, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        sizes = np.array([len(s) for s in sets], np.int64)
        extra = sizes - np.bitwise_count(maps).sum(axis=1).astype(np.int64)
        self.levels = [(maps, sizes, sizes, extra)]
        while len(self.levels[-1][1]) > 1:
            maps, low, high, extra = self.levels[-1]
            cuts = np.arange(0, len(low), FANOUT)
            self.levels.append((
                np.bitwise_or.reduceat(maps, cuts, axis=0), np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts),
                np.maximum.reduceat(extra, cuts)))


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether ``100 * intersection >= percent * union``, exactly."""
    shared = len(a) + len(b) - len(np.union1d(a, b))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _shared(maps: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of bits set in both bitmaps of each pair."""
    out, ones = np.empty(len(a), np.int64), np.ones(maps.shape[1], np.float32)
    rows = max(1, MAP_BYTES // maps[0].nbytes)
    for i in range(0, len(a), rows):
        both = maps.take(a[i : i + rows], axis=0) & maps.take(b[i : i + rows], axis=0)
        out[i : i + rows] = np.bitwise_count(both).astype(np.float32) @ ones  # exact: at most 2**16 bits
    return out


def _possible(tree: Tree, level: int, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether the nodes of each pair can hold linked sets: sizes near enough, and the largest overlap large enough."""
    maps, low, high, extra = tree.levels[level]
    keep = (100 * high[a] >= percent * low[b]) & (100 * high[b] >= percent * low[a])
    a, b = a[keep], b[keep]
    overlap = _shared(maps, a, b)
    most = np.minimum.reduce([overlap + extra[a], overlap + extra[b], high[a], high[b]])
    keep[keep] = (100 + percent) * most >= percent * (low[a] + low[b])
    return keep


def _ranges(tree: Tree, values: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Least and largest of the sets' values below each node, by level."""
    out = [(values, values)]
    for _ in tree.levels[1:]:
        low, high = out[-1]
        cuts = np.arange(0, len(low), FANOUT)
        out.append((np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts)))
    return out


def _alike(ranges: list[tuple[np.ndarray, np.ndarray]], level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether all sets below both nodes of a pair have one and the same value."""
    low, high = ranges[level]
    return (low[a] == high[b]) & (low[b] == high[a])


def links(sets: list[np.ndarray], side: np.ndarray, across: bool, percent: int = 85, known: list | None = None) -> list[tuple[int, int]]:
    """Linked pairs of sets that span all connected components of the links (between both sides only, if ``across``).

    Sets that are equal in ``known`` are connected already.

    Dual traversal from the pair (root, root): a pair of nodes is followed down only while sets below it may be
    linked, are not all connected already and, if ``across``, not all on one side. It goes depth first, and at most
    ``PAIRS`` pairs a level wait, however little a level rules out. Pairs of sets are verified exactly, of the pairs
    at hand the likeliest first; pairs already connected need no answer.
    """
    if len(sets) < 2:
        return []
    sizes = np.array([len(s) for s in sets])
    _, side = np.unique(np.asarray(side), return_inverse=True)
    order = np.lexsort((sizes, side)) if across else np.argsort(sizes, kind="stable")
    ranked = [sets[i] for i in order]
    bits = 1 << int(np.clip(np.ceil(np.log2(4 * int(sizes.max()) + 1)), 9, 16))
    tree = Tree(ranked, bits)
    sides = _ranges(tree, side[order])
    label, found = np.arange(len(sets)), []
    if known is not None:
        names: dict = {}
        label = np.array([names.setdefault(known[i], len(names)) for i in order])
    labels = _ranges(tree, label)
    root = np.zeros(1, np.int64)
    waiting = [(len(tree.levels) - 1, root, root)]
    while waiting:
        level, a, b = waiting.pop()
        most = PAIRS if level == 0 else max(1, PAIRS // FANOUT**2)
        if len(a) > most:
            waiting.append((level, a[most:], b[most:]))
            a, b = a[:most], b[:most]
        useless = _alike(labels, level, a, b)
        if across:
            useless |= _alike(sides, level, a, b)
        a, b = a[~useless], b[~useless]
        keep = _possible(tree, level, a, b, percent)
        a, b = a[keep], b[keep]
        if level:
            count = len(tree.levels[level - 1][1])
            step = np.arange(FANOUT)
            left = np.repeat(a[:, None] * FANOUT + step, FANOUT, axis=1).ravel()
            right = np.tile(b[:, None] * FANOUT + step, (1, FANOUT)).ravel()
            valid = (left < count) & (right < count) & ((left <= right) if level > 1 else (left < right))
            if valid.any():
                waiting.append((level - 1, left[valid], right[valid]))
        elif len(a):
            before = len(found)
            _verify(tree, ranked, a, b, percent, label, found)
            if len(found) > before:
                labels = _ranges(tree, label)
    return [(int(order[i]), int(order[j])) for i, j in found]


def _verify(
    tree: Tree, ranked: list[np.ndarray], a: np.ndarray, b: np.ndarray, percent: int, label: np.ndarray, found: list[tuple[int, int]],
) -> None:
    """Add the linked pairs among (a, b) that connect something new to ``found`` and join their components in ``label``."""
    maps, sizes, _, _ = tree.levels[0]
    likely = np.argsort(-_shared(maps, a, b) / np.maximum(sizes[a] + sizes[b], 1), kind="stable")
    a, b = a[likely], b[likely]
    while len(a):
        for i, j in zip(a[:BATCH], b[:BATCH], strict=True):
            if label[i] != label[j] and linked(ranked[i], ranked[j], percent):
                label[label == label[j]] = label[i]
                found.append((i, j))
        a, b = a[BATCH:], b[BATCH:]
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
