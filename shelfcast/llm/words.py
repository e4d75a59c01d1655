"""Word and shingle hashes of Arrow text columns, computed inside tasks with numpy.

Every function works on whole texts. Memory is bounded by one slice of a batch (about
``SLICE_BYTES`` of text, or one longer document).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20
_HASH_BYTES = 1 << 20  # text bytes hashed at a time

# An odd multiplier, its inverse modulo 2**64, and the mixing constants.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)

_powers: dict[int, np.ndarray] = {}


def space_table() -> np.ndarray:
    """True for the separators space and 0x09 to 0x0D."""
    table = np.zeros(256, dtype=bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


def punctuation_table() -> np.ndarray:
    """True for every ASCII byte that is neither a letter nor a digit."""
    table = np.zeros(256, dtype=bool)
    table[[b for b in range(128) if not chr(b).isalnum()]] = True
    return table


SPACES = space_table()
PUNCTUATION = punctuation_table()
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32


@dataclass
class Words:
    """Word hashes of a slice; words of document i are ``hashes[first[i]:first[i + 1]]``."""

    hashes: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Spread 64-bit values over all bits (wrapping arithmetic)."""
    x = x + np.uint64((seed * _BASE + _BASE) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX[1])
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 to base**(n - 1) modulo 2**64, kept by the worker."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, _HASH_BYTES), base, dtype=np.uint64)
        known[0] = 1
        known = np.cumprod(known, dtype=np.uint64)
        if n <= 4 * _HASH_BYTES:
            _powers[base] = known
    return known[:n]


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batch in slices of about SLICE_BYTES of text, whole documents each."""
    if batch.num_rows == 0:
        return
    ends = text_offsets(batch.column(column))
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(ends, ends[start] + SLICE_BYTES, "right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def text_offsets(texts: pa.Array) -> np.ndarray:
    if texts.type == pa.large_string():
        kind = np.int64
    else:
        kind = np.int32
    offsets = np.frombuffer(texts.buffers()[1], kind)
    return offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts back to back, and len + 1 offsets; a null text is empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = text_offsets(texts)
    buffer = texts.buffers()[2]
    if buffer is None or offsets[-1] == offsets[0]:
        return np.zeros(0, dtype=np.uint8), offsets - offsets[0]
    data = np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def split_words(texts: pa.Array, separators: np.ndarray = SPACES) -> Words:
    """Words are maximal runs of bytes that are not separators, with A-Z lower-cased."""
    data, offsets = text_bytes(texts)
    starts, stops, first = word_runs(data, offsets, separators)
    return Words(_hash_runs(data, starts, stops), first)


def word_runs(
    data: np.ndarray, offsets: np.ndarray, separators: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of every word in texts back to back, and the first word of each text."""
    if not len(data):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(len(offsets), dtype=np.int64)
    inside = ~separators[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[1:-1]
    edges = edges[edges < len(data)]
    begins[edges] = inside[edges]
    ends = inside
    ends[:-1] &= ~inside[1:] | begins[1:]
    starts = np.flatnonzero(begins)
    stops = np.flatnonzero(ends) + 1
    return starts, stops, np.searchsorted(starts, offsets)


def _hash_runs(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Polynomial hash of each run, read off prefix sums, then mixed with its length."""
    out = np.empty(len(starts), dtype=np.uint64)
    done = 0
    while done < len(starts):
        origin = starts[done]
        until = max(int(np.searchsorted(starts, origin + _HASH_BYTES)), done + 1)
        span = data[origin : stops[until - 1]]
        prefix = np.zeros(len(span) + 1, dtype=np.uint64)
        np.cumsum(_LOWER[span] * powers(_BASE, len(span)), out=prefix[1:])
        low, high = starts[done:until] - origin, stops[done:until] - origin
        value = (prefix[high] - prefix[low]) * powers(_INVERSE, len(span))[low]
        out[done:until] = mix(value + (high - low).astype(np.uint64))
        done = until
    return out


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words in text order, and the offsets per document.

    A document with fewer words, but at least one, has the whole sequence as its one shingle.
    """
    n = words.counts()
    per_doc = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    first = np.concatenate([[0], np.cumsum(per_doc)])
    total = int(first[-1])
    doc = np.repeat(np.arange(len(n)), per_doc)
    at = np.arange(total) - first[doc] + words.first[doc]
    value = np.zeros(total, dtype=np.uint64)
    short = n < width
    within = n[doc]
    padded = np.concatenate([words.hashes, np.zeros(width, dtype=np.uint64)])
    scales = powers(_BASE, width + 1)
    for k in range(width):
        part = padded[at + k] * scales[k + 1]
        if short.any():
            part = np.where(within > k, part, np.uint64(0))
        value += part
    if short.any():
        value += np.where(within < width, within, 0).astype(np.uint64)
    return mix(value), first


def distinct_sorted(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each document in ascending order, and their offsets."""
    n_docs = len(first) - 1
    doc = np.repeat(np.arange(n_docs), np.diff(first))
    order = np.argsort(values, kind="stable")
    order = order[np.argsort(doc[order], kind="stable")]
    values, doc = values[order], doc[order]
    keep = np.ones(len(values), dtype=bool)
    keep[1:] = (values[1:] != values[:-1]) | (doc[1:] != doc[:-1])
    return values[keep], np.concatenate([[0], np.cumsum(np.bincount(doc[keep], minlength=n_docs))])
