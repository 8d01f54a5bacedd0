"""Sets of hashed word shingles of many texts at once, by array operations over their bytes."""

from __future__ import annotations

import numpy as np

_A, _B, _C, _D = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
CHUNK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * _C
    x ^= x >> np.uint64(27)
    x *= _D
    x ^= x >> np.uint64(31)
    return x


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z in lower case, and the number of the text of each."""
    raws = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = _LOWER[np.frombuffer(b"\n".join(raws) + b"\n", np.uint8)]
    blank = _BLANK[data]
    begins = ~blank
    begins[1:] &= blank[:-1]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    lengths = np.diff(starts, append=len(data))
    place = np.zeros(len(data), np.uint64)
    place[starts[0] :] = np.arange(starts[0], len(data), dtype=np.uint64) - np.repeat(starts.astype(np.uint64), lengths)
    value = data.astype(np.uint64) * _A + place * _B
    value ^= value >> np.uint64(29)
    value *= _C
    value ^= value >> np.uint64(32)
    value[blank] = 0
    words = mix(np.add.reduceat(value, starts))
    ends = np.cumsum([len(r) + 1 for r in raws])
    return words, np.searchsorted(ends, starts, "right")


def shingle_sets(texts: list[str | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after another, and where each text's end.

    A text of fewer than ``width`` words has its whole sequence as one shingle; one without words has none.
    """
    words, owner = word_hashes(texts)
    counts = np.bincount(owner, minlength=len(texts))
    n = len(words)
    whole = np.zeros(n, bool)
    if n >= width:
        whole[: n - width + 1] = owner[: n - width + 1] == owner[width - 1 :]
    at = np.flatnonzero(whole)
    code = np.zeros(len(at), np.uint64)
    for k in range(width):
        code = mix(code * _A + words[at + k] + np.uint64(k + 1))
    owners = [owner[at]]
    codes = [code]
    first = np.cumsum(counts) - counts
    for size in range(1, width):
        short = np.flatnonzero(counts == size)
        code = np.full(len(short), size, np.uint64) * _B
        for k in range(size):
            code = mix(code * _A + words[first[short] + k] + np.uint64(k + 1))
        owners.append(short)
        codes.append(code)
    owner, code = np.concatenate(owners), np.concatenate(codes)
    order = np.lexsort((code, owner))
    owner, code = owner[order], code[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (owner[1:] != owner[:-1])
    owner, code = owner[new], code[new]
    return code, np.cumsum(np.bincount(owner, minlength=len(texts)))


def chunked(texts: list[str | None]):
    """Runs of texts of about ``CHUNK`` characters, as (from, to)."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text or "") + 1
        if size >= CHUNK:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
