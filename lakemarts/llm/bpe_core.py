"""Byte-level BPE with a segment tree over byte positions (no Spark here; see
``bpe.py``).

A piece starts as one token per byte.  The tree's leaves are its byte
positions; the leaf of a live token holds the rank of the pair that it forms
with its live right neighbour, followed by its position, so the root is the
leftmost pair of minimum rank.  A merge writes three leaves (the merged token,
the one it swallowed, its left neighbour) and updates their paths to the root.
Short pieces run through the same steps together, one row of a matrix each;
longer ones run alone.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import regex

#: Bytes up to which pieces are merged together, and pieces at a time.
TOGETHER = 64
ROWS = 1 << 14
#: Pieces whose tokens are remembered before the memory is cleared.
REMEMBERED = 1 << 17
#: Pieces of a text looked at a time.
CHUNK = 1 << 18
_ID_BITS = 20
_POS_BITS = 32
_NONE = np.iinfo(np.int64).max


class Tokenizer:
    """``ranks``: lines of a base64 token and its rank, covering all bytes."""

    def __init__(self, ranks: bytes, pattern: str):
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        if max(table.values()) >= 1 << _ID_BITS:
            raise ValueError("too many tokens")
        self.pattern = regex.compile(pattern)
        self.ranks = table
        self.byte_ids = np.array([table[bytes([b])] for b in range(256)], dtype=np.int64)
        # the rank of every pair of tokens whose bytes together are a token
        self.pairs = {
            (left << _ID_BITS) | right: rank
            for token, rank in table.items()
            for k in range(1, len(token))
            if (left := table.get(token[:k])) is not None and (right := table.get(token[k:])) is not None
        }
        keys = np.fromiter(self.pairs, dtype=np.int64, count=len(self.pairs))
        order = np.argsort(keys)
        self.pair_keys = np.append(keys[order], _NONE)
        self.pair_ranks = np.append(np.fromiter(self.pairs.values(), dtype=np.int64, count=len(keys))[order], 0)
        # tokens by rank, for decoding
        size = max(table.values()) + 1
        self.lengths = np.zeros(size, dtype=np.int64)
        for token, rank in table.items():
            self.lengths[rank] = len(token)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.zeros(int(self.lengths.sum()), dtype=np.uint8)
        for token, rank in table.items():
            self.bytes[self.starts[rank] : self.starts[rank] + len(token)] = np.frombuffer(token, dtype=np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.known_ids = np.empty(0, dtype=np.int32)
        self.known_ends = np.zeros(1, dtype=np.int64)

    # --- merging -----------------------------------------------------------

    def _leaf(self, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Leaves of the pairs: rank and position, or nothing to merge."""
        keys = (left << _ID_BITS) | right
        k = np.searchsorted(self.pair_keys, keys)
        found = (left >= 0) & (right >= 0) & (self.pair_keys[k] == keys)
        return np.where(found, (self.pair_ranks[k] << _POS_BITS) | at, _NONE)

    def _merge_rows(self, pieces: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of pieces of at most ``size`` bytes (a power of two): flat
        ids, and how many each piece has."""
        n = len(pieces)
        raw = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), dtype=np.uint8).reshape(n, size)
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=n)
        place = np.arange(size + 1)
        # column ``size`` stands for what is beyond either end
        ids = np.full((n, size + 1), -1, dtype=np.int64)
        ids[:, :size] = np.where(place[:size] < lengths[:, None], self.byte_ids[raw], -1)
        after = np.tile(np.minimum(place + 1, size), (n, 1))
        before = np.tile(np.where(place > 0, place - 1, size), (n, 1))
        tree = np.full((n, 2 * size), _NONE, dtype=np.int64)
        tree[:, size:] = self._leaf(ids[:, :size], ids[:, 1:], place[:size])
        h = size // 2
        while h:
            np.minimum(tree[:, 2 * h : 4 * h : 2], tree[:, 2 * h + 1 : 4 * h : 2], out=tree[:, h : 2 * h])
            h //= 2
        row = np.flatnonzero(tree[:, 1] != _NONE)
        while len(row):
            root = tree[row, 1]
            at, rank = root & ((1 << _POS_BITS) - 1), root >> _POS_BITS
            gone = after[row, at]
            right, left = after[row, gone], before[row, at]
            ids[row, at], ids[row, gone] = rank, -1
            after[row, at], before[row, right] = right, at
            tree[row, size + at] = self._leaf(rank, ids[row, right], at)
            tree[row, size + gone] = _NONE
            inside = left < size
            tree[row[inside], size + left[inside]] = self._leaf(ids[row[inside], left[inside]], rank[inside], left[inside])
            for leaf in (gone, at, np.where(inside, left, at)):
                node = (size + leaf) >> 1
                while node[0]:
                    tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])
                    node = node >> 1
            row = row[tree[row, 1] != _NONE]
        live = ids[:, :size] >= 0
        return ids[:, :size][live], live.sum(axis=1)

    def _merge_alone(self, piece: bytes) -> list[int]:
        """Tokens of one piece of any length, by the same steps."""
        n = len(piece)
        size = 1 << max(1, (n - 1).bit_length())
        ids = self.byte_ids[np.frombuffer(piece, dtype=np.uint8)].tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pair = self.pairs.get
        tree = [_NONE] * (2 * size)
        for i in range(n - 1):
            rank = pair((ids[i] << _ID_BITS) | ids[i + 1])
            if rank is not None:
                tree[size + i] = (rank << _POS_BITS) | i
        for node in range(size - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def write(leaf: int, value: int) -> None:
            node = size + leaf
            tree[node] = value
            while node > 1:
                node >>= 1
                a, b = tree[2 * node], tree[2 * node + 1]
                least = a if a < b else b
                if tree[node] == least:
                    return
                tree[node] = least

        while tree[1] != _NONE:
            at, rank = tree[1] & ((1 << _POS_BITS) - 1), tree[1] >> _POS_BITS
            gone = after[at]
            right, left = after[gone], before[at]
            ids[at], ids[gone] = rank, -1
            after[at] = right
            write(gone, _NONE)
            new = None
            if right < n:
                before[right] = at
                new = pair((rank << _ID_BITS) | ids[right])
            write(at, _NONE if new is None else (new << _POS_BITS) | at)
            if left >= 0:
                new = pair((ids[left] << _ID_BITS) | rank)
                write(left, _NONE if new is None else (new << _POS_BITS) | left)
        return [t for t in ids if t >= 0]

    def merge(self, pieces: list[bytes]) -> tuple[list[int], np.ndarray, np.ndarray]:
        """Tokens of all pieces, in an order of its own: the pieces' numbers in
        this order, their ids one after another, and how many each has.  A
        piece that is a token is that token."""
        order: list[int] = []
        ids: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        whole: list[int] = []
        sized: dict[int, list[int]] = {}
        for k, p in enumerate(pieces):
            rank = self.ranks.get(p)
            if rank is not None:
                order.append(k)
                whole.append(rank)
            else:
                size = 1 << (len(p) - 1).bit_length()
                sized.setdefault(size if size <= TOGETHER else 0, []).append(k)
        ids.append(np.array(whole, dtype=np.int32))
        counts.append(np.ones(len(whole), dtype=np.int64))
        for k in sized.pop(0, []):
            order.append(k)
            ids.append(np.array(self._merge_alone(pieces[k]), dtype=np.int32))
            counts.append(np.array([len(ids[-1])]))
        for size, which in sized.items():
            for a in range(0, len(which), ROWS):
                some = which[a : a + ROWS]
                flat, each = self._merge_rows([pieces[k] for k in some], size)
                order += some
                ids.append(flat.astype(np.int32))
                counts.append(each)
        return order, np.concatenate(ids), np.concatenate(counts)

    # --- texts -------------------------------------------------------------

    def _encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the pieces in order, and how many each piece has."""
        if len(self.known) > REMEMBERED:
            self._forget()
        known = self.known
        new = [p for p in dict.fromkeys(pieces) if p not in known]
        if new:
            order, ids, counts = self.merge([p.encode("utf-8", "surrogatepass") for p in new])
            first = len(known)
            known.update(zip(map(new.__getitem__, order), range(first, first + len(new))))
            self.known_ends = np.append(self.known_ends, self.known_ends[-1] + np.cumsum(counts))
            self.known_ids = np.append(self.known_ids, ids)
        which = np.fromiter(map(known.__getitem__, pieces), dtype=np.int64, count=len(pieces))
        starts = self.known_ends[which]
        counts = self.known_ends[which + 1] - starts
        return self.known_ids[_ranges(starts, counts)], counts

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Ids of every text; null and empty texts have none."""
        waiting: list[int] = []  # pieces of each text not encoded yet
        pieces: list[str] = []

        def flush() -> Iterator[np.ndarray]:
            if not waiting:
                return
            ids, counts = self._encode_pieces(pieces)
            ends = np.append(0, np.cumsum(counts))[np.cumsum(waiting)]
            yield from np.split(ids, ends[:-1])
            waiting.clear()
            pieces.clear()

        for text in texts:
            text = text or ""
            if len(text) > 4 * CHUNK:
                yield from flush()
                parts, found = [], (m.group() for m in self.pattern.finditer(text))
                while some := list(islice(found, CHUNK)):
                    parts.append(self._encode_pieces(some)[0])
                yield np.concatenate(parts)
                continue
            own = self.pattern.findall(text)
            pieces += own
            waiting.append(len(own))
            if len(pieces) > CHUNK:
                yield from flush()
        yield from flush()

    def decode_flat(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of a sequence of ids."""
        parts = [
            self.bytes[_ranges(self.starts[some], self.lengths[some])]
            for some in (ids[a : a + CHUNK] for a in range(0, len(ids), CHUNK))
        ]
        return np.concatenate(parts) if parts else np.empty(0, dtype=np.uint8)


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The indices ``start .. start + count - 1`` of all ranges in a row."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)


_LOADED: dict[bytes, Tokenizer] = {}


def loaded(ranks: bytes, pattern: str) -> Tokenizer:
    """The tokenizer of these ranks, built once per Python worker."""
    key = hashlib.sha256(ranks + pattern.encode()).digest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Tokenizer(ranks, pattern)
    return _LOADED[key]
