"""Word hashes of many texts at once, in numpy.

A word is a run of ASCII letters, digits and other (non-ASCII) characters in the lower-cased text. Every word gets a
64-bit hash of its bytes: a polynomial modulo 2^64, finished by a mixing step. Hashes depend on nothing but the word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Texts are hashed in slices of about so many characters, which bounds a task's memory.
SLICE_CHARS = 1_000_000

_WORD = np.zeros(256, dtype=bool)
_WORD[128:] = True
for _first, _last in ("09", "az", "AZ"):
    _WORD[ord(_first) : ord(_last) + 1] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (a public-domain finaliser)."""
    h = (h ^ (h >> _S33)) * _M1
    h = (h ^ (h >> _S33)) * _M2
    return h ^ (h >> _S33)


def _powers(n: int) -> np.ndarray:
    steps = np.full(n, _BASE, dtype=np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


def _pieces(text: str, limit: int) -> list[str]:
    """The text cut between words, for texts far beyond a slice."""
    cuts, at = [], 0
    while len(text) - at > limit:
        end = at + limit
        while end < len(text) and (ord(text[end]) > 127 or _WORD[ord(text[end])]):
            end += 1
        cuts.append(text[at:end])
        at = end
    return [*cuts, text[at:]]


def hash_words(texts: list[str | None], lines: bool = False, prefix: int = 0) -> tuple[np.ndarray, ...]:
    """Hashes of all words, and the border of each text: words of text i are ``h[b[i]:b[i + 1]]``.

    With ``lines`` there follow the number of line ends before each word within the joined texts, and whether the word
    has a digit; with ``prefix`` the hash of the first so many bytes of each word.
    """
    parts = [(text or "").lower() for text in texts]
    data = np.frombuffer("\n".join(parts).encode("utf-8", "replace"), dtype=np.uint8)
    sizes = np.fromiter((len(p) if p.isascii() else len(p.encode("utf-8", "replace")) for p in parts), dtype=np.int64, count=len(parts))
    is_word = _WORD[data]
    before = np.zeros_like(is_word)
    before[1:] = is_word[:-1]
    starts = np.flatnonzero(is_word & ~before)
    text_ends = np.cumsum(sizes + 1) - 1
    borders = np.concatenate([[0], np.searchsorted(starts, text_ends)]).astype(np.int64)
    if not len(starts):
        none = np.empty(0, np.uint64)
        return (none, borders, none, none)[: 4 if lines else 3 if prefix else 2]
    chars = data[is_word]
    offsets = np.cumsum(is_word, dtype=np.int64)[starts] - 1
    lengths = np.diff(np.append(offsets, len(chars)))
    place = np.arange(len(chars), dtype=np.int64) - np.repeat(offsets, lengths)
    powers = _powers(int(lengths.max()))
    terms = (chars.astype(np.uint64) + np.uint64(1)) * powers[place]
    h = mix(np.add.reduceat(terms, offsets))
    if prefix:
        return h, borders, mix(np.add.reduceat(np.where(place < prefix, terms, np.uint64(0)), offsets))
    if not lines:
        return h, borders
    ends = np.cumsum(data == 10, dtype=np.int64)
    return h, borders, ends[starts], np.add.reduceat(((chars >= 48) & (chars <= 57)).astype(np.int32), offsets) > 0


def sliced(texts: list[str | None], limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` characters, one text at least."""
    at, chars = 0, 0
    for i, text in enumerate(texts):
        n = len(text or "")
        if i > at and chars + n > limit:
            yield at, i
            at, chars = i, 0
        chars += n
    if at < len(texts):
        yield at, len(texts)


def each_text(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray]]:
    """(index, word hashes) of every text; slices bound the memory, also within a very long text."""
    for a, b in sliced(texts):
        if b - a == 1 and len(texts[a] or "") > 4 * SLICE_CHARS:
            yield a, np.concatenate([hash_words([p])[0] for p in _pieces(texts[a], SLICE_CHARS)])
            continue
        h, borders = hash_words(texts[a:b])
        for i in range(b - a):
            yield a + i, h[borders[i] : borders[i + 1]]


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words; empty if there are fewer."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    acc = np.zeros(n, dtype=np.uint64)
    for j, factor in enumerate(_powers(k + 1)[1:]):
        acc += h[j : j + n] * factor
    return mix(acc)
