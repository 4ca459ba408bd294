"""64-bit SimHash fingerprints of word shingles and the covering bit masks."""

from __future__ import annotations

import itertools
import re

import numpy as np
import xxhash

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SEED = 42
#: Shingles hashed at a time, so that memory does not grow with a text.
CHUNK = 1 << 18


def words(text: str) -> list[bytes]:
    """Words of the text with A-Z lower-cased; everything else is kept."""
    # bytes.lower() touches only A-Z, which is what the contract asks for
    return _WORD.findall(text.encode("utf-8", "surrogatepass").lower())


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Unsigned SimHash of the text's ``shingle``-word shingles, repeats
    included.  Null or word-free text: 0.  Fewer words than a shingle: the
    whole word sequence is the only shingle."""
    w = words(text) if text else []
    if not w:
        return 0
    size = min(shingle, len(w))
    joined = b" ".join(w)
    # word i starts after the words and spaces before it
    lengths = np.fromiter(map(len, w), dtype=np.int64, count=len(w))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(w) - size + 1].tolist()
    stops = ends[size - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(starts), CHUNK):
        hashes = np.fromiter(
            (digest(joined[a:b], SEED) for a, b in zip(starts[at : at + CHUNK], stops[at : at + CHUNK])),
            dtype=np.uint64,
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    over_half = (2 * ones > len(starts)).astype(np.uint8)
    return int(np.packbits(over_half, bitorder="little").view(np.uint64)[0])


def covering_masks(radius: int = 4, bits: int = 64) -> list[int]:
    """Masks of the covering family for Hamming radius ``radius``.

    Every bit position gets a non-zero vector of GF(2)^(radius+1); the mask
    of a non-zero vector v has the positions whose vector has an odd inner
    product with v.  At most ``radius`` differing positions span a proper
    subspace, so some v is orthogonal to all of them: in that mask's table
    the two fingerprints agree.  There are 2^(radius+1) - 1 tables.
    """
    size = 1 << (radius + 1)
    vectors = list(itertools.islice(itertools.cycle(range(1, size)), bits))
    return [
        sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2)
        for v in range(1, size)
    ]
