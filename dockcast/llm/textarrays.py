"""Words of many texts as numpy arrays: one 64-bit hash per word, run hashes per document."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes handled at a time: the arrays of one piece take about 40 times as much memory.
PIECE = 2 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


def _piece_hashes(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of one piece (words do not cross its ends)."""
    word = ~_SPACE[buf]
    edge = np.diff(np.concatenate([[False], word, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return starts, np.empty(0, np.uint64)
    lengths = ends - starts
    power = np.multiply.accumulate(np.full(int(lengths.max()), _BASE, np.uint64))
    at = np.flatnonzero(word)
    first = np.cumsum(lengths) - lengths
    values = _BYTE[buf[at]] * power[np.arange(len(at)) - np.repeat(first, lengths)]
    return starts, mix(np.add.reduceat(values, first) + lengths.astype(np.uint64))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (runs of anything but ASCII white space) and the index of each text's first word.

    The second array has one more entry than there are texts.
    """
    joined = b"\n".join([*texts, b""])
    buf = np.frombuffer(joined, np.uint8)
    starts, hashes, i = [], [], 0
    while i < len(buf):
        j = min(len(buf), i + PIECE)
        while j < len(buf) and not _SPACE[buf[j - 1]]:
            ahead = _SPACE[buf[j:j + 65536]]
            j += int(ahead.argmax()) + 1 if ahead.any() else len(ahead)
        s, h = _piece_hashes(buf[i:j])
        starts.append(s + i)
        hashes.append(h)
        i = j
    all_starts = np.concatenate(starts) if starts else np.empty(0, np.int64)
    ends = np.cumsum([len(t) + 1 for t in texts]) if texts else np.empty(0, np.int64)
    bounds = np.searchsorted(all_starts, np.concatenate([[0], ends]).astype(np.int64))
    return (np.concatenate(hashes) if hashes else np.empty(0, np.uint64)), bounds


def run_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive words (across texts too; callers keep those inside one)."""
    n = max(0, len(hashes) - k + 1)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * _BASE + hashes[j:j + n]
    return mix(out)


def text_runs(batches, lower: bool, size: int) -> Iterator[tuple[list, list[bytes]]]:
    """Runs of (keys, texts as bytes) of at most ``size`` bytes from batches whose first two columns are key and text."""
    for batch in batches:
        keys, texts, held = [], [], 0
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            b = (text.as_py() or "").encode()
            if keys and held + len(b) > size:
                yield keys, texts
                keys, texts, held = [], [], 0
            keys.append(key)
            texts.append(b.lower() if lower else b)
            held += len(b)
        if keys:
            yield keys, texts


def longs(x: np.ndarray) -> pa.Array:
    """Unsigned 64-bit values as Spark longs (same bits)."""
    return pa.array(np.ascontiguousarray(x).view(np.int64), pa.int64())


def lists(values: pa.Array, lengths) -> pa.Array:
    """One list per length from the values in order."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), values)
