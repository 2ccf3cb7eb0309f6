"""Word n-grams of whole texts as 64-bit hashes, in numpy."""

from collections.abc import Iterator

import numpy as np

_B = np.uint64(0x9E3779B97F4A7C15 | 1)
_B_INV = np.uint64(pow(int(_B), -1, 1 << 64))
#: Characters per block of texts; a longer text is a block of its own.
BLOCK_CHARS = 1 << 20
_powers: dict[str, np.ndarray] = {}
_word_char: dict[bool, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: a one-to-one map whose outputs look random."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        p = np.full(max(n, BLOCK_CHARS + 64), base, np.uint64)
        p[0] = 1
        have = np.multiply.accumulate(p)
        if n <= BLOCK_CHARS + 64:
            _powers[name] = have
    return have[:n]


def _words(code: np.ndarray, ascii_only: bool) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of letters, digits and marks, or of ASCII letters and digits."""
    if ascii_only not in _word_char:
        import unicodedata

        good = [chr(i) in "abcdefghijklmnopqrstuvwxyz0123456789" if ascii_only else unicodedata.category(chr(i))[0] in "LNM" or chr(i) == "_" for i in range(0x110000)]
        _word_char[ascii_only] = np.array(good)
    inside = np.zeros(len(code) + 2, bool)
    inside[1:-1] = _word_char[ascii_only][code]
    turn = np.flatnonzero(inside[1:] != inside[:-1])
    return turn[::2], turn[1::2]


def blocks(texts: list[str | None], chars: int = BLOCK_CHARS) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of blocks of about ``chars`` characters; null is empty."""
    first, held, size = 0, [], 0
    for i, t in enumerate(texts):
        t = t or ""
        if held and size + len(t) > chars:
            yield first, held
            first, held, size = i, [], 0
        held.append(t)
        size += len(t) + 1
    if held:
        yield first, held


def shingle_hashes(texts: list[str], width: int = 5, ascii_words: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every text's word shingles, repeats included, and their offsets by text.

    Words are maximal runs of letters, marks, digits and underscores, in lower case. A text of
    fewer than ``width`` words, but at least one, has one shingle of all its words. With
    ``ascii_words`` words are runs of ASCII letters and digits, and each word of such a short text
    is a shingle.
    """
    low = [t.lower() for t in texts]
    joined = "\n".join(low)
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends_at = np.cumsum([len(t) + 1 for t in low])
    start, end = _words(code, ascii_words)
    total = np.zeros(len(code) + 1, np.uint64)
    np.cumsum((code.astype(np.uint64) + np.uint64(1)) * _power("up", _B, len(code)), out=total[1:])
    word = mix((total[end] - total[start]) * _power("down", _B_INV, len(code) + 1)[start])
    doc = np.searchsorted(ends_at, start, side="right")
    n_words = np.bincount(doc, minlength=len(texts))
    first = np.concatenate([[0], np.cumsum(n_words)])[:-1]
    n = np.where(n_words >= width, n_words - width + 1, n_words if ascii_words else np.minimum(n_words, 1))
    offsets = np.concatenate([[0], np.cumsum(n)])
    if not len(word):
        return np.empty(0, np.uint64), offsets
    at = np.arange(offsets[-1]) - np.repeat(offsets[:-1], n) + np.repeat(first, n)
    short = np.repeat(n_words < width, n)
    last = at if ascii_words else np.repeat(first + n_words - 1, n)
    out = np.zeros(len(at), np.uint64)
    for k in range(width):
        pos = at + k
        w = word[np.minimum(pos, len(word) - 1)]
        part = mix(w + np.uint64((k + 1) * int(_B) & 0xFFFFFFFFFFFFFFFF))
        out += np.where(short & (pos > last), np.uint64(0), part)
    return mix(out), offsets


def minhashes(hashes: np.ndarray, offsets: np.ndarray, size: int, seed: int) -> np.ndarray:
    """(texts, size) 32-bit minima under ``size`` hash functions; zero rows for texts without shingles."""
    rng = np.random.default_rng(seed)
    a = rng.integers(1, 1 << 63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    some = np.flatnonzero(np.diff(offsets))
    out = np.zeros((len(offsets) - 1, size), np.uint32)
    if len(some):
        starts = offsets[:-1][some]
        for s in range(size):
            out[some, s] = np.minimum.reduceat(((hashes * a[s]) >> np.uint64(32)).astype(np.uint32), starts)
    return out
