"""Two tokenizers over one text: token bytes, groups, links, and the sorted
runs of linked id pairs (see ``alignment``)."""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import sentencepiece
import tiktoken
import zstandard
from tokenizers import Tokenizer

#: Records in one compressed frame of a run.
FRAME = 1 << 16
#: A run of white space from which the splitting pattern of the fast encoder
#: may exhaust its stack; such texts go to the slower library.
LONG_SPACE = re.compile(r"\s{1000,}")


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for:
    printable ones for themselves, the others for characters from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}


class ByteLevel:
    """A byte-level BPE of the ``tokenizers`` library, from its JSON.

    Where every merge makes the id of its rank, the merges are a rank table
    and the faster library gives the same ids; otherwise, and for texts with
    very long white space, the JSON's own library encodes."""

    def __init__(self, content: bytes, pattern: str):
        self._content = content
        spec = json.loads(content)
        vocab, alphabet = spec["model"]["vocab"], byte_alphabet()
        special = {t["content"] for t in spec.get("added_tokens", [])}
        plain = {k: v for k, v in vocab.items() if k not in special}
        top = max([*vocab.values(), *(t["id"] for t in spec.get("added_tokens", []))])
        self.tokens: list[bytes] = [b""] * (top + 1)
        for token, i in plain.items():
            self.tokens[i] = bytes(alphabet[c] for c in token)
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in spec["model"]["merges"]]
        singles = len(plain) - len(merged)
        ranked = all(plain.get(m) == singles + r for r, m in enumerate(merged))
        self._fast = None
        self.cuts = spec["pre_tokenizer"] == _PLAIN_BYTE_LEVEL and not spec.get("normalizer")
        if ranked and self.cuts:
            ranks = {self.tokens[i]: i for i in plain.values()}
            self._fast = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._slow = None
        self.lengths = np.array([len(t) for t in self.tokens], dtype=np.int64)

    def encode(self, text: str) -> np.ndarray:
        if self._fast is not None and LONG_SPACE.search(text) is None:
            return self._fast.encode_to_numpy(text).astype(np.int64)
        if self._slow is None:
            self._slow = Tokenizer.from_str(self._content.decode("utf-8"))
            self._slow.encode_special_tokens = True
        return np.array(self._slow.encode(text, add_special_tokens=False).ids, dtype=np.int64)


class Pieces:
    """A sentencepiece model with byte fallback."""

    def __init__(self, content: bytes):
        self._model = sentencepiece.SentencePieceProcessor(model_proto=content)
        self.tokens = [self._bytes(self._model.id_to_piece(i)) for i in range(self._model.get_piece_size())]
        self.lengths = np.array([len(t) for t in self.tokens], dtype=np.int64)
        pieces = map(self._model.id_to_piece, range(len(self.tokens)))
        probe = "\ufb01  \u2460 e\u0301 "
        self.cuts = (
            not any(re.search("[^▁]▁", p) for p in pieces)
            and self._model.normalize(probe) == "▁" + probe.replace(" ", "▁")
        )

    @staticmethod
    def _bytes(piece: str) -> bytes:
        if re.fullmatch(r"<0x[0-9A-F]{2}>", piece):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode("utf-8")

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text that begins with a space, which the model adds itself."""
        return np.array(self._model.encode(text[1:]), dtype=np.int64)


def joined(side: ByteLevel | Pieces, ids: np.ndarray) -> bytes:
    return b"".join(map(side.tokens.__getitem__, ids.tolist()))


#: Where a text may be cut: behind a character that is no white space, before
#: a space that is not the last character (the model would encode it as none).
CUT = re.compile(r"(?<=\S)(?= (?!\Z))")
#: Units encoded in one call: short texts keep the encoders' queues small.
CALL_UNITS = 500
_PLAIN_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}


def units(text: str) -> list[str]:
    """Space + text, cut where both tokenizers end a token whatever stands on
    either side; every unit begins with a space."""
    return CUT.split(" " + text)


def _offsets(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(lengths)))


def _gathered(rows: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The places ``offsets[r] .. offsets[r + 1]`` of every row, in order."""
    lengths = offsets[rows + 1] - offsets[rows]
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(offsets[rows] - (ends - lengths), lengths)


class Aligner:
    """Links and groups of a chunk of documents.

    Ends of both sides' tokens, in bytes, cut a text into pieces.  Every piece
    lies in one token of each side, and two tokens that overlap share exactly
    one piece, so pieces are links; ends of both sides close a group.

    Texts are cut into units first (see ``units``): no match of the byte-level
    pattern and no piece of the model reaches over such a cut (checked when
    the vocabularies are read; otherwise a text is one unit).  So the units of
    a chunk are aligned once each, however often they occur, and a document
    is the sequence of its units."""

    def __init__(self, a: ByteLevel, b: Pieces):
        self.a, self.b = a, b
        self.width = len(b.tokens)
        self.cuts = a.cuts and b.cuts
        ids = max(len(a.tokens), self.width)
        digits = [str(i).encode() for i in range(ids)]
        longest = max(map(len, digits)) + 1
        self._cells = np.zeros((3, ids, longest), dtype=np.uint8)  # id and ",", "|" or ";"
        for k, end in enumerate(b",|;"):
            whole = b"".join((d + bytes([end])).ljust(longest, b"\0") for d in digits)
            self._cells[k] = np.frombuffer(whole, dtype=np.uint8).reshape(ids, longest)
        self._size = np.array([len(d) + 1 for d in digits])

    def aligned(self, texts: list[str]) -> dict[str, np.ndarray]:
        """Units to arrays of tokens, links and digest text by unit; units
        whose joined bytes are not the unit are not ``valid`` and empty."""
        tail = [t[-1:].isspace() for t in texts] if self.cuts else [True] * len(texts)
        order = [i for i, t in enumerate(tail) if not t] + [i for i, t in enumerate(tail) if t]
        plain = len(texts) - sum(tail)
        calls = [order[lo : min(lo + CALL_UNITS, plain)] for lo in range(0, plain, CALL_UNITS)]
        calls += [[i] for i in order[plain:]]
        ids, raw = {}, {}
        for name, side in (("a", self.a), ("b", self.b)):
            found = [side.encode("".join(map(texts.__getitem__, c))) for c in calls]
            ids[name] = np.concatenate(found) if found else np.empty(0, dtype=np.int64)
            raw[name] = joined(side, ids[name])
        content = [texts[i].encode("utf-8") for i in order]
        expected = b"".join(content)
        if raw["a"] != expected or raw["b"] != expected:
            return self._without_invalid(texts)
        ends_of_units = _offsets(np.array([len(c) for c in content], dtype=np.int64))
        out = self._linked(ids["a"], ids["b"], ends_of_units)
        back = np.empty(len(order), dtype=np.int64)
        back[order] = np.arange(len(order))
        return out | {"row": back, "valid": np.ones(len(texts), dtype=bool)}

    def _without_invalid(self, texts: list[str]) -> dict[str, np.ndarray]:
        """As ``aligned``, with every unit's bytes compared by itself."""
        valid = np.array([
            all(joined(side, side.encode(t)) == t.encode("utf-8") for side in (self.a, self.b)) for t in texts
        ])
        good = np.flatnonzero(valid)
        if len(good) == len(texts):
            raise ValueError("token ends and unit ends differ; the vocabularies do not allow cuts")
        out = self.aligned([texts[i] for i in good.tolist()])
        row = np.zeros(len(texts), dtype=np.int64)
        row[good] = out["row"]
        return out | {"row": row, "valid": valid}

    def _linked(self, ids_a: np.ndarray, ids_b: np.ndarray, units: np.ndarray) -> dict[str, np.ndarray]:
        """Alignment of consecutive units that end at the bytes ``units``."""
        n = len(ids_a)
        ends = np.concatenate((np.cumsum(self.a.lengths[ids_a]), np.cumsum(self.b.lengths[ids_b])))
        order = np.argsort(ends, kind="stable")
        ends = ends[order]
        of_a = order < n
        again = np.diff(ends, prepend=-1) == 0  # a right token's end behind the same left one
        shared_a, shared_b = np.zeros(n, dtype=bool), np.zeros(len(ids_b), dtype=bool)
        shared_a[order[np.flatnonzero(again) - 1]] = True
        shared_b[order[again] - n] = True
        first = ~again
        before = np.cumsum(of_a) - of_a
        at_a, at_b = before[first], (np.arange(len(ends)) - before)[first]
        # in the digest a group's left tokens stand before its right ones
        group_a, group_b = np.cumsum(shared_a) - shared_a, np.cumsum(shared_b) - shared_b
        closed_a, closed_b = np.flatnonzero(shared_a) + 1, np.flatnonzero(shared_b) + 1
        place = np.concatenate((
            np.arange(n) + np.concatenate(([0], closed_b))[group_a], np.arange(len(ids_b)) + closed_a[group_b],
        ))
        token = np.empty(len(place), dtype=np.int64)
        kind = np.empty(len(place), dtype=np.int64)
        token[place] = np.concatenate((ids_a, ids_b))
        kind[place] = np.concatenate((shared_a * 1, shared_b * 2))
        size = self._size[token]
        cells = self._cells[kind, token]
        text = cells[np.arange(cells.shape[1]) < size[:, None]]
        pieces = ends[first]
        tokens_a = np.searchsorted(ends[of_a], units, side="right")
        tokens_b = np.searchsorted(ends[~of_a], units, side="right")
        return {
            "keys": ids_a[at_a] * self.width + ids_b[at_b],
            "links": np.searchsorted(pieces, units, side="right"), "tokens_a": tokens_a, "tokens_b": tokens_b,
            "text": text, "ends": _offsets(size)[tokens_a + tokens_b],
        }

    def chunk(self, texts: list[str | None]) -> tuple[dict[str, list], np.ndarray, np.ndarray]:
        """Figures of the documents by name, and all links as pair keys with
        the documents they stand in."""
        seen: dict[str, int] = {}
        cut = [(units(t) if self.cuts else [" " + t]) if t else [] for t in texts]
        rows = np.array([seen.setdefault(u, len(seen)) for c in cut for u in c], dtype=np.int64)
        counts = np.array([len(c) for c in cut], dtype=np.int64)
        del cut
        found = self.aligned(list(seen))
        doc = np.repeat(np.arange(len(texts)), counts)
        broken = np.bincount(doc[~found["valid"][rows]], minlength=len(texts)) > 0
        kept = ~broken[doc]
        rows, doc = found["row"][rows[kept]], doc[kept]
        counts = np.bincount(doc, minlength=len(texts))

        def total(offsets: np.ndarray) -> np.ndarray:
            return np.diff(_offsets(np.diff(offsets)[rows])[_offsets(counts)])

        n_a, n_b, n_links = (total(found[k]) for k in ("tokens_a", "tokens_b", "links"))
        text, ends = found["text"].tobytes(), found["ends"].tolist()
        pieces = [text[lo:hi] for lo, hi in zip(ends, ends[1:])]
        digests, lo = [], 0
        for n in counts.tolist():
            whole = b"".join(map(pieces.__getitem__, rows[lo : lo + n].tolist()))
            digests.append(hashlib.sha256(whole[:-1]).hexdigest() if n else "")
            lo += n
        links = np.diff(found["links"])[rows]
        figures = {
            "n_a": n_a.tolist(), "n_b": n_b.tolist(), "n_groups": (n_a + n_b - n_links).tolist(),
            "n_links": n_links.tolist(), "groups_sha256": digests,
        }
        return figures, found["keys"][_gathered(rows, found["links"])], np.repeat(doc, links)


# --- frames: zstd over an array's bytes, lowest bytes first, all of one rank together --------


def pack(values: np.ndarray, width: int) -> bytes:
    cells = np.ascontiguousarray(values, dtype=np.dtype(f"<u{width}")).view(np.uint8).reshape(-1, width)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(cells.T).tobytes())


def unpack(frame: bytes, width: int) -> np.ndarray:
    cells = np.frombuffer(zstandard.ZstdDecompressor().decompress(frame), dtype=np.uint8).reshape(width, -1)
    return np.ascontiguousarray(cells.T).view(np.dtype(f"<u{width}")).ravel().astype(np.int64)


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=0), 8)


def unpack_sorted(frame: bytes) -> np.ndarray:
    return np.cumsum(unpack(frame, 8))


def frames_of(keys: np.ndarray, counts: np.ndarray) -> Iterator[tuple[bytes, bytes]]:
    for lo in range(0, len(keys), FRAME):
        yield pack_sorted(keys[lo : lo + FRAME]), pack(counts[lo : lo + FRAME], 8)


# --- runs ------------------------------------------------------------------------------------


def records(keys: np.ndarray, doc: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A chunk's links as sorted records ``(pair key, document, links)``."""
    if not len(keys):
        return keys, keys, keys
    sort = np.sort(keys * docs + doc)
    first = np.flatnonzero(np.diff(sort, prepend=-1))
    links = np.diff(first, append=len(sort))
    return sort[first] // docs, sort[first] % docs, links


def runs(keys: np.ndarray, doc: np.ndarray, links: np.ndarray, width: int, radices: int) -> Iterator[dict]:
    """The records dealt by the left id's radix, each part a sorted run:
    pairs with their document counts, and the documents and links of each."""
    radix = (keys // width) % radices
    order = np.argsort(radix, kind="stable")
    cuts = np.searchsorted(radix[order], np.arange(radices + 1))
    for r in range(radices):
        own = order[cuts[r] : cuts[r + 1]]
        if not len(own):
            continue
        first = np.flatnonzero(np.diff(keys[own], prepend=-1))
        pairs, counts = keys[own][first], np.diff(first, append=len(own))
        frames = list(frames_of(pairs, counts))
        yield {
            "radix": r, "pairs": [f for f, _ in frames], "counts": [f for _, f in frames],
            "doc": pack(doc[own], 4), "links": pack(links[own], 4),
        }


Run = Iterable[tuple[bytes, bytes]]


def merged(parts: list[Run]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """K-way merge of sorted runs of frames: distinct keys in order, with
    their summed counts, block by block.

    A heap holds every run by the last key of its open frame.  Up to the
    smallest of these all keys are in memory, so this stretch of every run is
    summed and handed on, and the runs that ended their frame open the next;
    one frame a run is open at a time."""
    sources = [iter(p) for p in parts]
    opened: dict[int, list[np.ndarray]] = {}
    heap: list[tuple[int, int]] = []

    def open_next(i: int) -> None:
        frame = next(sources[i], None)
        if frame is None:
            opened.pop(i, None)
            return
        opened[i] = [unpack_sorted(frame[0]), unpack(frame[1], 8)]
        heapq.heappush(heap, (int(opened[i][0][-1]), i))

    for i in range(len(sources)):
        open_next(i)
    while heap:
        bound, keys, counts = heap[0][0], [], []
        for i, (k, c) in opened.items():
            n = int(np.searchsorted(k, bound, side="right"))
            if n:
                keys.append(k[:n])
                counts.append(c[:n])
                opened[i] = [k[n:], c[n:]]
        every = np.concatenate(keys)
        order = np.argsort(every, kind="stable")
        every = every[order]
        first = np.flatnonzero(np.diff(every, prepend=-1))
        yield every[first], np.add.reduceat(np.concatenate(counts)[order], first)
        while heap and heap[0][0] == bound:
            open_next(heapq.heappop(heap)[1])


class Maxima:
    """Sorted pairs of a radix with their counts and whether a count is the
    highest of its left id.  Keys are ordered by the left id first, so an id's
    pairs stand together and its maximum needs one pass."""

    def __init__(self, frames: Run, width: int):
        found = [(unpack_sorted(k), unpack(c, 8)) for k, c in frames]
        empty = np.empty(0, dtype=np.int64)
        self.keys = np.concatenate([k for k, _ in found]) if found else empty
        self.counts = np.concatenate([c for _, c in found]) if found else empty
        if len(self.keys):
            left = self.keys // width
            first = np.flatnonzero(np.diff(left, prepend=-1))
            top = np.maximum.reduceat(self.counts, first)
            self.best = self.counts == np.repeat(top, np.diff(first, append=len(left)))

    def contributions(self, run: dict, docs: int) -> tuple[np.ndarray, np.ndarray]:
        """What a run adds to its chunk's documents: links of highest count,
        and the sum of counts over links."""
        pairs = np.concatenate([unpack_sorted(f) for f in run["pairs"]])
        times = np.concatenate([unpack(f, 8) for f in run["counts"]])
        at = np.repeat(np.searchsorted(self.keys, pairs), times)
        doc, links = unpack(run["doc"], 4), unpack(run["links"], 4)
        return _sums(doc, links * self.best[at], docs), _sums(doc, links * self.counts[at], docs)


def _sums(group: np.ndarray, values: np.ndarray, groups: int) -> np.ndarray:
    """Exact integer sums by group, in two halves that a double holds."""
    low = np.bincount(group, weights=values & 0x3FFFFFF, minlength=groups)
    high = np.bincount(group, weights=values >> 26, minlength=groups)
    return low.astype(np.int64) + (high.astype(np.int64) << 26)
