"""Words and hashed word shingles of whole Arrow batches, without a Python loop over words."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORDS = 5
_P = np.uint64(0x9E3779B97F4A7C15)


def flat_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts (A-Z in lower case, null as empty), and where each text's words begin, plus the end."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat, offsets = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    kept = np.concatenate([[0], np.cumsum(real)])
    return flat.filter(pa.array(real)), kept[offsets]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads their bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def distinct(x: np.ndarray) -> np.ndarray:
    """The distinct values, sorted."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def word_hashes(flat: pa.Array) -> np.ndarray:
    """64-bit hashes of strings: sums of a hash of each byte with its place, and the length, spread once more."""
    if not len(flat):
        return np.zeros(0, np.uint64)
    coded = flat.dictionary_encode()
    return distinct_hashes(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)]


def distinct_hashes(words: pa.Array) -> np.ndarray:
    """word_hashes() of strings that don't repeat."""
    if not len(words):
        return np.zeros(0, np.uint64)
    each = pa.concat_arrays([words.cast(pa.large_string())])
    ends = np.frombuffer(each.buffers()[1], np.int64)[each.offset : each.offset + len(each) + 1]
    data = np.frombuffer(each.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    place = np.arange(len(data)) - np.repeat(ends[:-1], np.diff(ends))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed((place.astype(np.uint64) << np.uint64(8)) + data + _P), dtype=np.uint64)])
    return mixed((sums[ends[1:]] - sums[ends[:-1]]) ^ (np.diff(ends).astype(np.uint64) * _P))


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """For each text its distinct shingle hashes, sorted; with fewer than WORDS words, one for all; without words, none."""
    flat, offsets = flat_words(texts)
    h = word_hashes(flat)
    rolled = h.copy()
    for k in range(1, WORDS):
        rolled = rolled[:-1] * _P + h[k:] if len(rolled) > 1 else rolled[:0]
    rolled = mixed(rolled) if len(rolled) else rolled
    out = []
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        n = b - a
        if n >= WORDS:
            out.append(distinct(rolled[a : b - WORDS + 1]))
        elif n:
            whole = h[a]
            for x in h[a + 1 : b]:
                whole = np.uint64((int(whole) * int(_P) + int(x)) & 0xFFFFFFFFFFFFFFFF)
            out.append(mixed(np.array([whole ^ np.uint64(n)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def slices(batch: pa.RecordBatch, column: int, most_bytes: int = 8 << 20):
    """The batch in slices of about so many bytes of a text column; a row is never cut."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, base + most_bytes, side="right")))
        yield batch.slice(at, stop - at)
        at = stop


#: Bytes of texts that a task works on at a time where several steps share an executor's memory.
FEW_BYTES = 2 << 20


def sparing(task: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """The task, which in the end gives back what Arrow and malloc keep for later: its worker idles beside other stages."""

    @functools.wraps(task)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim:
            trim(0)

    return run
