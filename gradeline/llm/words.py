"""Word and window hashes of texts in numpy, in bounded slabs, for use inside Spark tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

SLAB = 1 << 19
_M = np.uint64
_MUL = _M(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over 64 bits."""
    x = (x ^ (x >> _M(30))) * _M(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _M(27))) * _M(0x94D049BB133111EB)
    return x ^ (x >> _M(31))


def seeds(n: int, start: int = 0) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.arange(start + 1, start + n + 1, dtype=_M) * _MUL)


_BYTE = seeds(256, 1000)
_BASE, _BASE_W = 0x9DDFEA08EB382D69, 0xC2B2AE3D27D4EB4F
_powers: dict[tuple[int, bool], np.ndarray] = {}


def _power(base: int, n: int, inverse: bool = False) -> np.ndarray:
    """The first n powers of an odd base, or of its inverse, modulo 2**64."""
    have = _powers.get((base, inverse))
    if have is None or len(have) < n:
        b = pow(base, -1, 1 << 64) if inverse else base
        have = np.ones(max(n, SLAB + 1), _M)
        have[1:] = _M(b)
        have = np.multiply.accumulate(have)
        _powers[base, inverse] = have
    return have[:n]


def _spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of values[start:end] for each span, the same wherever the span stands."""
    sums = np.zeros(len(values) + 1, _M)
    np.cumsum(values * _power(base, len(values)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _power(base, len(values) + 1, True)[starts] + (ends - starts).astype(_M))


def _hash_slab(data: bytes, prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = np.frombuffer(data, np.uint8)
    word = np.zeros(len(raw) + 2, np.int8)
    word[1:-1] = ~_SPACE[raw]
    edge = np.diff(word)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    codes = _BYTE[raw]
    hashes = _spans(codes, starts, ends, _BASE)
    if prefixes:
        firsts = [_spans(codes, starts, np.minimum(ends, starts + n), _BASE) ^ _M(n) for n in prefixes]
        hashes = np.stack([hashes, *firsts], axis=1)
    return starts, ends, hashes


def _pieces(data: bytes) -> Iterator[bytes]:
    """Cut a long text at white space, so that no word is cut (but a word above a slab stays whole)."""
    at = 0
    while len(data) - at > SLAB:
        cut = max(data.rfind(c, at, at + SLAB) for c in b" \n\t\r\v\f")
        if cut <= at:
            after = [p for c in b" \n\t\r\v\f" if (p := data.find(c, at + 1)) >= 0]
            cut = min(after) if after else len(data)
        yield data[at:cut]
        at = cut
    yield data[at:]


def word_hashes(
    texts: Iterable[bytes], prefixes: tuple[int, ...] = ()
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Slabs of whole texts: (number of texts, word hashes, offsets of each text's words).

    Offsets has one more entry than the slab has texts. Short texts share a slab; a long text is hashed
    in pieces and makes a slab of its own, which takes 8 bytes a word. With ``prefixes`` the hashes have a
    column for the word and one for its first bytes of each given length.
    """
    held: list[bytes] = []
    size = 0

    def together():
        starts, _, hashes = _hash_slab(b"\n".join(held), prefixes)
        begins = np.cumsum([0] + [len(t) + 1 for t in held])
        return len(held), hashes, np.searchsorted(starts, begins)

    for text in texts:
        if held and size + len(text) > SLAB:
            yield together()
            held, size = [], 0
        if len(text) > SLAB:
            hashes = np.concatenate([_hash_slab(p, prefixes)[2] for p in _pieces(text)])
            yield 1, hashes, np.array([0, len(hashes)])
        else:
            held.append(text)
            size += len(text) + 1
    if held:
        yield together()


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` consecutive words, by first word; windows may run over several texts."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, _M)
    starts = np.arange(n)
    return _spans(words, starts, starts + width, _BASE_W)


def shingle_hashes(words: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets) of the word shingles of each text; a shorter text with words has one."""
    counts = np.diff(offsets)
    windows = window_hashes(words, width)
    full = np.repeat(counts >= width, counts)
    last = np.repeat(offsets[1:], counts)
    inside = np.flatnonzero(full & (np.arange(len(words)) + width <= last)) if len(words) else np.zeros(0, int)
    n = np.where(counts >= width, counts - width + 1, (counts > 0).astype(counts.dtype))
    out = np.zeros(n.sum(), _M)
    at = np.concatenate([[0], np.cumsum(n)])
    short = (counts > 0) & (counts < width)
    place = np.ones(len(out), bool)
    place[at[:-1][short]] = False
    out[place] = windows[inside]
    if short.any():
        out[at[:-1][short]] = _spans(words, offsets[:-1][short], offsets[1:][short], _BASE_W)
    return out, at
