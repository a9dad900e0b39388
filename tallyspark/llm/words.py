"""Vectorised word and shingle hashing over whole texts (numpy, inside Spark tasks).

A word is a maximal run of bytes other than space and ``\\x09-\\x0D`` after A-Z is lower-cased.
Each word gets a 64-bit hash of its bytes; a shingle of ``k`` words gets a 64-bit hash of its
word hashes in order. Everything is computed with prefix sums over a byte buffer, so there is
no Python loop over words, and a long text is taken in pieces of ``PIECE`` bytes cut at white
space: memory is bounded by the piece plus eight bytes per word.
"""

from __future__ import annotations

import numpy as np

PIECE = 1 << 16
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C55)  # odd, hence invertible modulo 2**64
_INV = _U(pow(0x9E3779B97F4A7C55, -1, 1 << 64))
_STEP = _U(0xD1342543DE82EF95)

_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_WHITE = b" \t\n\x0b\x0c\r"
#: Another reading of words: runs of ASCII letters, digits and bytes of other scripts.
ALNUM = np.ones(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = False


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW = _powers(_BASE, PIECE + 1)
_IPOW = _powers(_INV, PIECE + 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _piece_hashes(buf: np.ndarray, separators: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes and word start offsets of one buffer."""
    space = separators[buf]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).view(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    if not len(starts):
        return np.empty(0, np.uint64), starts
    n = len(buf)
    power, inverse = (_POW, _IPOW) if n <= PIECE else (_powers(_BASE, n + 1), _powers(_INV, n + 1))
    run = np.empty(n + 1, np.uint64)
    run[0] = 0
    np.cumsum(_BYTE[buf] * power[:n], out=run[1:])
    raw = (run[ends] - run[starts]) * inverse[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * _STEP), starts


def _pieces(data: bytes):
    """Cut ``data`` after white space into pieces of at most ``PIECE`` bytes (longer only for
    a single word that is longer)."""
    at, n = 0, len(data)
    while at < n:
        end = min(n, at + PIECE)
        if end < n:
            cut = max(data.rfind(bytes((w,)), at, end) for w in _WHITE)
            if cut >= at:
                end = cut + 1
            else:
                nexts = [i for i in (data.find(bytes((w,)), end) for w in _WHITE) if i >= 0]
                end = min(nexts) + 1 if nexts else n
        yield data[at:end]
        at = end


def text_words(text: str | None, separators: np.ndarray = _SPACE) -> np.ndarray:
    """Hashes of the words of one whole text, in order."""
    data = (text or "").encode("utf-8", "surrogatepass")
    if len(data) <= PIECE:
        return _piece_hashes(np.frombuffer(data, np.uint8), separators)[0]
    return np.concatenate([_piece_hashes(np.frombuffer(p, np.uint8), separators)[0] for p in _pieces(data)])


def batch_words(texts) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of many texts: one flat array and ``len(texts) + 1`` offsets into it.

    Short texts are hashed together in buffers of up to ``PIECE`` bytes.
    """
    parts: list[np.ndarray] = []
    counts = np.zeros(len(texts) + 1, np.int64)
    held: list[bytes] = []
    first, size = 0, 0

    def flush(upto: int) -> None:
        nonlocal held, size, first
        if held:
            buf = np.frombuffer(b"\n".join(held), np.uint8)
            hashes, starts = _piece_hashes(buf)
            bounds = np.cumsum([0] + [len(b) + 1 for b in held])
            counts[first + 1 : upto + 1] = np.diff(np.searchsorted(starts, bounds))
            parts.append(hashes)
        held, size, first = [], 0, upto

    for i, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass")
        if size + len(data) + len(held) + 1 > PIECE:
            flush(i)
        if len(data) >= PIECE:
            got = text_words(text)
            parts.append(got)
            counts[i + 1] = len(got)
            first = i + 1
        else:
            held.append(data)
            size += len(data)
    flush(len(texts))
    flat = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    return flat, np.cumsum(counts)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every run of ``k`` words (one per start); the whole sequence as one shingle
    when there are fewer words, and nothing for no words."""
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    width = min(k, n)
    acc = np.zeros(n - width + 1, np.uint64)
    for j in range(width):
        acc = acc * _STEP + words[j : n - width + 1 + j]
    return mix(acc + _U(width))


def shingle_set(text: str | None, k: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes of one whole text."""
    return np.unique(shingle_hashes(text_words(text), k))


def batch_shingle_sets(texts, k: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    flat, at = batch_words(texts)
    return [np.unique(shingle_hashes(flat[at[i] : at[i + 1]], k)) for i in range(len(at) - 1)]
