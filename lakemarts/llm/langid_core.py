"""Character n-grams and the bit-sliced Bloom filter of languages (no Spark
here; see ``langid.py``)."""

from __future__ import annotations

import numpy as np

#: Characters of an n-gram; a word's ends count as one space each.
NGRAM = 3
#: Characters looked at a time, so that memory does not grow with a text.
CHUNK = 1 << 18
#: Hash functions of the filter.
HASHES = 4
#: Slots for each n-gram of the largest language, which leaves about 0.24 % of
#: false answers, and the bounds of a slot number's bits: the table has 0.5 to
#: 128 MB for every 64 languages.
SLOTS_EACH = 16
LEAST_BITS, MOST_BITS = 16, 24
_MIX, _APART = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_CODE_BITS = 21  # of a character

_LETTERS: np.ndarray | None = None


def _letters() -> np.ndarray:
    """Per code point: its lower case if it is a letter, else a space."""
    global _LETTERS
    if _LETTERS is None:
        table = np.full(0x110000, ord(" "), dtype=np.uint32)
        for c in range(0x110000):
            if (s := chr(c)).isalpha():
                low = s.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _LETTERS = table
    return _LETTERS


def _chunks(text: str):
    table = _letters()
    carry = np.array([ord(" ")], dtype=np.uint32)
    for at in range(0, len(text), CHUNK):
        raw = np.frombuffer(text[at : at + CHUNK].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        chars = np.concatenate([carry, table[raw]])
        if at + CHUNK >= len(text):
            chars = np.append(chars, np.uint32(ord(" ")))
        yield chars
        carry = chars[-(NGRAM - 1) :]


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text as packed code points, and how often each
    occurs.  Runs of anything but letters count as one space; n-grams with a
    space inside, between two words, are left out."""
    codes, counts = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    parts, times = [], []
    for chars in _chunks(text or ""):
        space = chars == ord(" ")
        n = len(chars) - NGRAM + 1
        if n <= 0:
            continue
        code = np.zeros(n, dtype=np.uint64)
        for k in range(NGRAM):
            code = (code << np.uint64(_CODE_BITS)) | chars[k : k + n].astype(np.uint64)
        keep = ~(space[:n] & space[1 : n + 1])
        for k in range(1, NGRAM - 1):
            keep &= ~space[k : k + n]
        some, number = np.unique(code[keep], return_counts=True)
        parts.append(some)
        times.append(number)
    if parts:
        codes, back = np.unique(np.concatenate(parts), return_inverse=True)
        counts = np.bincount(back, np.concatenate(times), len(codes)).astype(np.int64)
    return codes, counts


def slot_bits(members: int) -> int:
    """Bits of a slot number for languages of up to so many n-grams."""
    return min(MOST_BITS, max(LEAST_BITS, (SLOTS_EACH * members - 1).bit_length()))


def slots(codes: np.ndarray, bits: int) -> np.ndarray:
    """The filter slots of n-grams, one row per hash function."""
    out = np.empty((HASHES, len(codes)), dtype=np.int64)
    with np.errstate(over="ignore"):
        for k in range(HASHES):
            # far apart for every function, so that neighbouring n-grams share no slots
            h = (codes.astype(np.uint64) ^ (np.uint64(k + 1) * _APART)) * _MIX
            h ^= h >> np.uint64(31)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(29)
            out[k] = (h >> np.uint64(64 - bits)).astype(np.int64)
    return out


class Filter:
    """Bloom filters of all languages, bit-sliced: a slot is a row of 64-bit
    words with one bit per language, so one AND of an n-gram's rows gives all
    languages that contain it."""

    def __init__(self, languages: list[str], slot: np.ndarray, word: np.ndarray, mask: np.ndarray, bits: int = LEAST_BITS):
        self.languages = languages
        self.bits = bits
        self.rows = np.zeros((1 << bits, max(1, -(-len(languages) // 64))), dtype=np.uint64)
        self.rows[slot, word] = mask
        # the share of n-grams in no language that a language's filter answers
        used = np.zeros(64 * self.rows.shape[1])
        for w in range(self.rows.shape[1]):
            for b in range(min(64, len(languages) - 64 * w)):
                used[64 * w + b] = np.count_nonzero((self.rows[:, w] >> np.uint64(b)) & np.uint64(1))
        self.false = (used[: len(languages)] / (1 << bits)) ** HASHES

    def languages_of(self, codes: np.ndarray) -> np.ndarray:
        """Bits of all languages that contain each n-gram."""
        at = slots(codes, self.bits)
        held = self.rows[at[0]]
        for k in range(1, HASHES):
            held = held & self.rows[at[k]]
        return held

    def classify(self, text: str | None) -> tuple[str, float]:
        """The language whose filter holds most of the text's n-grams, its
        count corrected for false answers, and its share of all languages'
        corrected counts.  ``und`` and 0 if nothing is held or there is no
        letter; ties go to the first language in order."""
        codes, counts = ngrams(text)
        if not len(codes) or not self.languages:
            return "und", 0.0
        held = self.languages_of(codes)
        total = counts.sum()
        bits = np.unpackbits(held.view(np.uint8), axis=1, bitorder="little")[:, : len(self.languages)]
        hits = counts @ bits.astype(np.int64)
        corrected = np.maximum(0.0, (hits - total * self.false) / (1 - np.minimum(self.false, 0.999999)))
        best = int(np.argmax(corrected))
        everything = corrected.sum()
        if everything <= 0:
            # letters, but no n-gram that was learned: all languages alike
            return self.languages[0], 1.0 / len(self.languages)
        return self.languages[best], float(corrected[best] / everything)
