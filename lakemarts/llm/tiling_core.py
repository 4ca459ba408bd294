"""Greedy string tiling by running Karp-Rabin, and the seed index that finds
the benchmark items worth tiling (no Spark here; see ``decontaminate.py``)."""

from __future__ import annotations

import heapq
import re

import numpy as np

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Words of a seed, and the shortest tile.
SEED_WORDS = 5
#: Match length at which the search starts.
START_LENGTH = 20
_PRIME = (1 << 61) - 1
_BASE = 1_000_003


def words(text: str | None) -> list[str]:
    """Lower-cased runs of letters, digits and non-ASCII characters, so that
    case and punctuation do not hide a passage."""
    return _WORD.findall(text.lower()) if text else []


class _Rolling:
    """Karp-Rabin hashes of all windows of one token sequence."""

    def __init__(self, tokens: list[int]):
        self.sums, self.powers = [0], [1]
        for t in tokens:
            self.sums.append((self.sums[-1] * _BASE + t + 1) % _PRIME)
            self.powers.append(self.powers[-1] * _BASE % _PRIME)

    def window(self, start: int, length: int) -> int:
        return (self.sums[start + length] - self.sums[start] * self.powers[length]) % _PRIME


def _unmarked(marked: np.ndarray) -> list[tuple[int, int]]:
    """Runs ``(start, end)`` of places that are not marked."""
    edges = np.flatnonzero(np.diff(~marked, prepend=False, append=False))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def _free_windows(marked: np.ndarray, length: int):
    """Starts of windows without a marked token."""
    for lo, hi in _unmarked(marked):
        yield from range(lo, hi - length + 1)


def _matches(item: np.ndarray, text: np.ndarray, item_marked: np.ndarray, text_marked: np.ndarray,
             hashes: tuple[_Rolling, _Rolling], length: int):
    """Matches ``(item_start, text_start, n)`` of at least ``length`` unmarked
    tokens that cannot be extended on either side: of a long match every
    window meets, but only the first one starts it."""
    starts: dict[int, list[int]] = {}
    for t in _free_windows(text_marked, length):
        starts.setdefault(hashes[1].window(t, length), []).append(t)
    held: dict[int, np.ndarray] = {}
    for i in _free_windows(item_marked, length) if starts else ():
        key = hashes[0].window(i, length)
        if key not in starts:
            continue
        if key not in held:
            held[key] = np.array(starts[key], dtype=np.int64)
        at = held[key]
        if i and not item_marked[i - 1]:
            before = at - 1
            at = at[(before < 0) | (text[before] != item[i - 1]) | text_marked[before]]
        # all of them are extended side by side, token by token
        n = np.zeros(len(at), dtype=np.int64)
        going = np.arange(len(at))
        for k in range(len(item) - i):
            if item_marked[i + k]:
                break
            going = going[at[going] + k < len(text)]
            going = going[(text[at[going] + k] == item[i + k]) & ~text_marked[at[going] + k]]
            if not len(going):
                break
            n[going] = k + 1
        for t, size in zip(at.tolist(), n.tolist()):
            if size >= length:  # else equal hashes of unequal windows
                yield i, t, size


def greedy_tiles(item: list[int], text: list[int], shortest: int = SEED_WORDS) -> list[tuple[int, int, int]]:
    """Tiles ``(item_start, text_start, length)``: again and again the longest
    match of unmarked tokens is taken and marked on both sides, down to
    ``shortest`` tokens.  Ties go to the earliest start in the item, then in
    the text.  ``text`` may hold negative tokens, which match nothing.

    Matches are searched at a length that is halved from ``START_LENGTH``.
    Those of a length wait in a heap, longest first; one that has been marked
    in part by then goes back as its unmarked runs."""
    own, other = np.asarray(item, dtype=np.int64), np.asarray(text, dtype=np.int64)
    item_marked, text_marked = np.zeros(len(own), dtype=bool), other < 0
    hashes = _Rolling(item), _Rolling(text)
    tiles: list[tuple[int, int, int]] = []
    length = max(shortest, min(START_LENGTH, len(item)))
    while True:
        heap = [(-n, i, t) for i, t, n in _matches(own, other, item_marked, text_marked, hashes, length)]
        heapq.heapify(heap)
        while heap and not item_marked.all():
            n, i, t = heapq.heappop(heap)
            n = -n
            taken = item_marked[i : i + n] | text_marked[t : t + n]
            if taken.any():
                for lo, hi in _unmarked(taken):
                    if hi - lo >= length:
                        heapq.heappush(heap, (lo - hi, i + lo, t + lo))
                continue
            item_marked[i : i + n] = text_marked[t : t + n] = True
            tiles.append((i, t, n))
        if length == shortest or item_marked.all():
            return tiles
        length = max(shortest, length // 2)


class Items:
    """A block of benchmark items, indexed by their seeds."""

    def __init__(self, texts: list[str | None], seed: int = SEED_WORDS):
        self.seed = seed
        vocabulary: dict[str, int] = {}
        self.tokens = [[vocabulary.setdefault(w, len(vocabulary)) for w in words(t)] for t in texts]
        self.vocabulary = vocabulary
        hashes, items, starts = [], [], []
        for k, tokens in enumerate(self.tokens):
            h = self._seeds(np.asarray(tokens, dtype=np.int64))
            hashes.append(h)
            items.append(np.full(len(h), k))
            starts.append(np.arange(len(h)))
        empty = [np.empty(0, dtype=np.int64)]
        order = np.argsort(h := np.concatenate(hashes or empty).astype(np.uint64), kind="stable")
        self.hashes = h[order]
        self.items = np.concatenate(items or empty)[order]
        self.starts = np.concatenate(starts or empty)[order]

    def _seeds(self, tokens: np.ndarray) -> np.ndarray:
        n = max(0, len(tokens) - self.seed + 1)
        h = np.zeros(n, dtype=np.uint64)
        for k in range(self.seed):
            h *= np.uint64(0x9E3779B97F4A7C15)
            h ^= tokens[k : k + n].astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)
            h ^= h >> np.uint64(29)
        return h

    def matches(self, text: str | None, coverage: float) -> list[tuple[int, float, list[tuple[int, int, int]]]]:
        """``(item, covered share, tiles)`` of the items whose words are
        covered by tiles to at least ``coverage``; tile starts count words."""
        if not text or not len(self.hashes):
            return []
        get = self.vocabulary.get
        tokens = np.fromiter((get(w, -1) for w in words(text)), dtype=np.int64)
        if len(tokens) < self.seed:
            return []
        unknown = np.concatenate([[0], np.cumsum(tokens < 0)])
        places = np.flatnonzero(unknown[self.seed :] == unknown[: -self.seed])
        if not len(places):
            return []
        h = self._seeds(tokens)[places]
        # every seed is looked up once, however often the text repeats it
        order = np.argsort(h, kind="stable")
        seeds, bounds = np.unique(h[order], return_index=True)
        bounds = np.append(bounds, len(h))
        places = places[order]
        first = np.searchsorted(self.hashes, seeds, "left")
        counts = np.searchsorted(self.hashes, seeds, "right") - first
        hit = np.flatnonzero(counts)
        if not len(hit):
            return []
        first, counts = first[hit], counts[hit]
        at = np.repeat(first, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        seed, item, start = np.repeat(hit, counts), self.items[at], self.starts[at]
        by_item = np.argsort(item, kind="stable")
        seed, item, start = seed[by_item], item[by_item], start[by_item]
        found = []
        cuts = np.flatnonzero(np.diff(item, prepend=-1, append=-1))
        for a, b in zip(cuts[:-1], cuts[1:]):
            own = self.tokens[k := int(item[a])]
            covered = np.zeros(len(own), dtype=bool)
            for offset in range(self.seed):
                covered[start[a:b] + offset] = True
            if covered.sum() < coverage * len(own):
                continue  # every tile consists of seeds, so tiles cannot cover more
            where = np.concatenate([places[bounds[s] : bounds[s + 1]] for s in np.unique(seed[a:b])])
            # the words around this item's seeds; -1 keeps tiles from crossing a gap
            inside = np.zeros(len(tokens), dtype=bool)
            for offset in range(self.seed):
                inside[where + offset] = True
            near = np.flatnonzero(inside)
            gaps = np.flatnonzero(np.diff(near) > 1) + 1
            part = np.insert(tokens[near], gaps, -1)
            origin = np.insert(near, gaps, -1)
            tiles = [(i, int(origin[t]), n) for i, t, n in greedy_tiles(own, part.tolist(), self.seed)]
            share = sum(n for _, _, n in tiles) / len(own)
            if share >= coverage:
                found.append((k, share, sorted(tiles)))
        return found
