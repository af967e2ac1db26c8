"""Words and word sequences of Arrow text columns, in numpy.

A word is a run of bytes other than space and ``\\x09-\\x0D``. Texts are cut
in slices of about ``SLICE_BYTES``, so a task's memory follows the slice (or
one text, if that is longer), never the partition. Every text is read whole.

Hashes are 64-bit and depend on the words alone, so they agree between tasks
and runs. Two independent lanes give 128 bits where equality must be certain.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
SEPARATORS = np.zeros(256, bool)
SEPARATORS[[0x20, *range(0x09, 0x0E)]] = True

_MIX_A, _MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the splitmix64 finaliser)."""
    x = x + _GOLDEN
    x = (x ^ (x >> np.uint64(30))) * _MIX_A
    x = (x ^ (x >> np.uint64(27))) * _MIX_B
    return x ^ (x >> np.uint64(31))


def seed(n: int) -> np.uint64:
    """The n-th of a fixed series of well-spread 64-bit constants."""
    return mix(np.array([n], np.uint64) * np.uint64(0xD1342543DE82EF95))[0]


class _Lane:
    """Polynomial hash of byte ranges: powers of an odd base and of its inverse modulo 2**64."""

    def __init__(self, n: int):
        self.table = mix(np.arange(256, dtype=np.uint64) + seed(2 * n))
        base = int(seed(2 * n + 1)) | 1
        self.base, self.inverse = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def powers(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * SLICE_BYTES)
            self.up, self.down = (np.cumprod(np.r_[np.uint64(1), np.full(n - 1, b, np.uint64)]) for b in (self.base, self.inverse))

    def hash(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        self.powers(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * self.up[: len(data)], out=sums[1:])
        own = (sums[end] - sums[start]) * self.down[start]
        return mix(own ^ ((end - start).astype(np.uint64) * _GOLDEN))


_LANES: dict[int, _Lane] = {}


def lane(n: int) -> _Lane:
    if n not in _LANES:
        _LANES[n] = _Lane(n)
    return _LANES[n]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and where each begins (one more entry than texts); null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, at, data = texts.buffers()
    offsets = np.frombuffer(at, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """The words of a slice of texts, one after the other.

    ``first``: the index of each text's first word (one more entry than
    texts); ``text``: the text's index for each word; ``start``/``end``: byte
    range of each word in ``data``.
    """

    def __init__(self, texts: pa.Array, separators: np.ndarray = SEPARATORS):
        self.data, self.at = buffers(texts)
        n = len(self.data)
        gap = separators[self.data]
        edge = np.zeros(n + 1, bool)
        edge[self.at] = True
        before, after = np.ones(n, bool), np.ones(n, bool)
        before[1:], after[:-1] = gap[:-1], gap[1:]
        self.start = np.flatnonzero(~gap & (before | edge[:-1]))
        self.end = np.flatnonzero(~gap & (after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, self.at)
        self.count = np.diff(self.first)
        self.text = np.repeat(np.arange(len(self.count)), self.count)

    def __len__(self) -> int:
        return len(self.start)

    def hash(self, n: int = 0) -> np.ndarray:
        """One 64-bit hash for each word; ``n`` names the lane."""
        return lane(n).hash(self.data, self.start, self.end)

    def bytes(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def ngrams(words: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """Hashes of k consecutive word hashes, by first word; those over a text's end are the caller's to leave out."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    base, out = seed(1000 + salt) | np.uint64(1), np.zeros(n, np.uint64)
    for j in range(k):
        out = out * base + words[j : j + n]
    return mix(out)


def inside(words: Words, k: int) -> np.ndarray:
    """Which starts of k words lie in one text."""
    n = len(words) - k + 1
    return words.text[:n] == words.text[k - 1 :] if n > 0 else np.zeros(0, bool)


def slices(batch: pa.RecordBatch, columns: str | tuple[str, ...] = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with at most ``limit`` bytes in the named text columns, or one row."""
    if not batch.num_rows:
        return
    names = (columns,) if isinstance(columns, str) else columns
    at = sum(buffers(batch.column(batch.schema.get_field_index(c)))[1] for c in names)
    i = 0
    while i < batch.num_rows:
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, side="right")) - 1)
        yield batch.slice(i, j - i)
        i = j


def arrow_map(fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], columns: str | tuple[str, ...] = "text") -> Callable:
    """For ``mapInArrow``: applies ``fn`` to each slice of each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, columns):
                out = fn(part)
                if out is not None and out.num_rows:
                    yield out

    return run


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of equal values."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return at, np.diff(np.r_[at, len(keys)])
