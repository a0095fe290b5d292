"""Sets of five-word shingles of whole texts as 64-bit hashes, many texts at a time.

Words are what bytes other than white space make, lower-cased in A to Z. A word's hash is a polynomial
over its bytes, taken from one running sum over the buffer; a shingle's hash mixes the hashes of its
words by place. Two different shingles agree by chance once in 2^64.
"""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)
#: Texts are hashed in buffers of about so many bytes; longer words are taken in parts.
BUFFER = 1 << 19


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """Fixed odd multipliers from a counter."""
    with np.errstate(over="ignore"):
        return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | _ONE


_BYTE = constants(256, 1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACE = constants(64, 2)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _powers(base: int) -> np.ndarray:
    """base ** 0 ... BUFFER, by doubling."""
    out = np.ones(1, np.uint64)
    while len(out) <= BUFFER:
        out = np.concatenate((out, out * np.uint64(pow(base, len(out), 1 << 64))))
    return out


_POWER, _BACK = _powers(_BASE), _powers(_INVERSE)


def _hashed(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, lengths and polynomials of the words in a buffer."""
    word = ~_IS_SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * _POWER[: len(data)], dtype=np.uint64)))
    return starts, ends - starts, (sums[ends] - sums[starts]) * _BACK[starts]


def word_hashes(text: bytes) -> np.ndarray:
    """Of one text of any length; ``text`` is lower-cased already."""
    out, at = [], 0
    while at < len(text):
        stop = min(len(text), at + BUFFER)
        while at < stop < len(text) and not _IS_SPACE[text[stop - 1]]:
            stop -= 1
        if stop > at:
            _, lengths, sums = _hashed(np.frombuffer(text, np.uint8, stop - at, at))
        else:  # one word that is longer than a buffer
            total, done = 0, 0
            stop = at
            while stop < len(text) and not _IS_SPACE[text[stop]]:
                part = np.frombuffer(text, np.uint8, min(BUFFER, len(text) - stop), stop)
                gap = np.flatnonzero(_IS_SPACE[part])
                part = part[: gap[0]] if len(gap) else part
                own = int(np.sum(_BYTE[part] * _POWER[: len(part)], dtype=np.uint64))
                total = (total + own * pow(_BASE, done, 1 << 64)) % (1 << 64)
                stop, done = stop + len(part), done + len(part)
            lengths, sums = np.array([done]), np.array([total], np.uint64)
        out.append(mixed(sums + lengths.astype(np.uint64) * _PLACE[63]))
        at = stop
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def many_word_hashes(texts: list[bytes]) -> list[np.ndarray]:
    """Of many texts: short ones share a buffer."""
    out: list = [None] * len(texts)
    some, size = [], 0

    def flush() -> None:
        nonlocal some, size
        if some:
            data = np.frombuffer(b" ".join(texts[i] for i in some), np.uint8)
            starts, lengths, sums = _hashed(data)
            words = mixed(sums + lengths.astype(np.uint64) * _PLACE[63])
            begins = np.cumsum([0] + [len(texts[i]) + 1 for i in some])
            cuts = np.searchsorted(starts, begins)
            for k, i in enumerate(some):
                out[i] = words[cuts[k] : cuts[k + 1]]
        some, size = [], 0

    for i, text in enumerate(texts):
        if len(text) + 1 > BUFFER // 2:
            out[i] = word_hashes(text)
            continue
        if size + len(text) + 1 > BUFFER:
            flush()
        some.append(i)
        size += len(text) + 1
    flush()
    return out


def shingle_set(words: np.ndarray, width: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes; fewer words than ``width`` are one shingle, none are none."""
    n = len(words)
    if n == 0:
        return words
    if n < width:
        rows = np.sum(words * _PLACE[:n], dtype=np.uint64) + np.uint64(n) * _PLACE[62]
        return mixed(np.array([rows], np.uint64))
    rows = words[: n - width + 1] * _PLACE[0]
    for k in range(1, width):
        rows += words[k : n - width + 1 + k] * _PLACE[k]
    return np.unique(mixed(rows))


def shingle_sets(texts: list[str | None], width: int = 5) -> list[np.ndarray]:
    lowered = [(t or "").encode("utf-8", "replace").lower() for t in texts]
    return [shingle_set(w, width) for w in many_word_hashes(lowered)]
