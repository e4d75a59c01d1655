"""Removal of byte strings that an earlier document also holds, with a run-length index.

Equal strings of ``MATCH`` bytes meet in one task without a corpus-wide index: the smallest
hash among the ``ANCHOR``-byte substrings of a 50-byte window names its anchor, so equal
windows have equal anchors. Neighbouring windows with the same anchor form one string, and
strings are dealt to buckets by anchor.

Documents are dealt to chunks by a hash of id and text. A chunk sends each distinct string
once, with the smallest and the largest document that holds it there, however often it occurs;
the places stay with the chunk. In a bucket equal strings are merged, and strings that share no
``CONTEXT`` bytes around their anchor with another document are dropped, as no window of theirs
can be removed. All others go into a run-compressed Burrows-Wheeler transform, with the suffix
positions sampled at the ends of its runs, and are streamed through it from their last byte to
the first; every step gives the longest match at that byte and its row among the sorted
suffixes. Rows that share ``MATCH`` bytes form one stretch, which keeps the smallest document
that holds them. Runs of windows for which that document is smaller than the largest of a chunk
go back to the chunk, which lays them on its places.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfcast.llm import words as wh

MATCH = 50
ANCHOR = 10
#: Two equal windows share, for one of these left reaches, the bytes from that far before the
#: anchor on, CONTEXT bytes in all.
_REACHES = (0, 8, 16, 24, 32)
CONTEXT = MATCH - 8
#: Text bytes that one bucket of strings stands for, and text bytes of a chunk of documents.
BUCKET_BYTES = 8 << 20
CHUNK_BYTES = 16 << 20
#: String bytes that are indexed at a time; strings with one anchor stay together.
INDEX_BYTES = 1 << 19
_SLICE = 1 << 20  # text bytes whose anchors are found at a time
_CODEC = "zstd"

_LEVEL = 5

# Strings of a chunk for one bucket or, in bucket -1 - part, the chunk's own places.
_SENT = (
    "bucket long, part long, n long, n_bytes long, strings binary, sizes binary, anchors binary, "
    "numbers binary, lows binary, spreads binary, docs binary, starts binary"
)
# Marks on a chunk's strings, or its places.
_FOUND = "part long, places boolean, n long, numbers binary, docs binary, starts binary, lengths binary"
_RESULT = "doc_id long, n_bytes long, starts array<long>, stops array<long>, kept binary"


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


_SENT_ARROW, _FOUND_ARROW = _arrow(_SENT), _arrow(_FOUND)


# --- strings around anchors -------------------------------------------------------------


def _prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which the hash of any substring is read."""
    prefix = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * wh.powers(wh._BASE, len(data)), out=prefix[1:])
    return prefix


def _substring_hash(prefix: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    return wh.mix((prefix[stop] - prefix[start]) * wh.powers(wh._INVERSE, len(prefix))[start])


def anchored_strings(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, stop, anchor) of the strings of one text: every 50-byte window lies in exactly
    one of them, together with its anchor. Texts of less than 50 bytes have none."""
    windows = len(data) - MATCH + 1
    if windows <= 0:
        return (np.zeros(0, dtype=np.int64),) * 3
    prefix = _prefix_hash(data)
    n = len(data) - ANCHOR + 1
    powers = wh.powers(wh._INVERSE, n)
    value = wh.mix((prefix[ANCHOR:] - prefix[:n]) * powers)
    # Upper bits: hash; lower bits: place, so that the leftmost of equal anchors is taken.
    key = value & ~np.uint64(0xFFFFFF) | np.arange(n, dtype=np.uint64)
    span, have = MATCH - ANCHOR + 1, 1
    while 2 * have <= span:
        key = np.minimum(key[:-have], key[have:])
        have *= 2
    if span > have:
        key = np.minimum(key[: len(key) - (span - have)], key[span - have :])
    place = (key & np.uint64(0xFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    last = np.append(first[1:], windows) - 1
    return first, last + MATCH, place[first]


def _pieces(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """A long text in overlapping pieces: every window lies in one of them."""
    for start in range(0, max(len(data) - MATCH + 1, 1), _SLICE):
        yield start, data[start : start + _SLICE + MATCH - 1]


def gather(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The given substrings back to back."""
    first = np.cumsum(size) - size
    return data[np.arange(int(size.sum())) + np.repeat(start - first, size)]


def _packed(values: np.ndarray) -> bytes:
    return pa.Codec(_CODEC, compression_level=_LEVEL).compress(np.ascontiguousarray(values), asbytes=True)


def _unpacked(blob: bytes, kind, n: int) -> np.ndarray:
    size = n * np.dtype(kind).itemsize
    return np.frombuffer(pa.Codec(_CODEC).decompress(blob, size, asbytes=True), kind)


def _steps(values: np.ndarray) -> np.ndarray:
    """Differences: sorted ids compress to little; their running sum restores them."""
    return np.diff(values, prepend=np.int64(0))


_LAST_ID = np.iinfo(np.int64).max  # stands for a null doc_id: no document is after it


def _ids(column: pa.Array) -> np.ndarray:
    return np.asarray(column.fill_null(_LAST_ID))


def _numbered(docs: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text bytes and offsets of a chunk's rows, the number of each row by id and text (repeated
    rows share one), and the id of each number."""
    raw, offsets = wh.text_bytes(docs.column("text").combine_chunks())
    ids = _ids(docs.column("doc_id").combine_chunks())
    keys = [(int(i), raw[a:b].tobytes()) for i, a, b in zip(ids, offsets[:-1], offsets[1:])]
    distinct = sorted(set(keys))
    number = {key: k for k, key in enumerate(distinct)}
    return raw, offsets, np.array([number[k] for k in keys]), np.array([i for i, _ in distinct])


def _sender(n_buckets: int):
    def send(docs: pa.Table) -> pa.Table:
        rows = list(_sent_rows(docs, n_buckets))
        return pa.Table.from_pylist(rows, schema=_SENT_ARROW)

    return send


def _chunk_strings(docs: pa.Table):
    """All strings of a chunk's distinct rows: text bytes, id of each number, and per string
    number, place in the text, place in the bytes, size, anchor, hash, hash of the anchor."""
    raw, offsets, number, id_of = _numbered(docs)
    _, rows = np.unique(number, return_index=True)
    parts = []
    for row in rows:
        low, high = offsets[row], offsets[row + 1]
        for at, text in _pieces(raw[low:high]):
            start, stop, anchor = anchored_strings(text)
            if len(start):
                prefix = _prefix_hash(text)
                parts.append((
                    np.full(len(start), number[row]), start + at, start + (low + at), stop - start,
                    anchor - start, _substring_hash(prefix, start, stop),
                    _substring_hash(prefix, anchor, anchor + ANCHOR),
                ))
    return raw, id_of, [np.concatenate(c) for c in zip(*parts)]


def _sent_rows(chunk: pa.Table, n_buckets: int) -> Iterator[dict]:
    """The chunk's places, and one row per bucket with its distinct strings."""
    raw, id_of, columns = _chunk_strings(chunk)
    if not columns:
        return
    docs, starts, begin, size, anchor, key, anchor_key = columns
    part = chunk.column("part")[0].as_py()
    # Rows are in the order of their numbers already, and so are the places in each.
    _, first, which = np.unique(key, return_index=True, return_inverse=True)
    by_first = np.argsort(first)
    rank = np.empty(len(first), dtype=np.int64)
    rank[by_first] = np.arange(len(first))
    which, lead = rank[which], first[by_first]
    yield {
        "bucket": -1 - part, "part": part, "n": len(docs), "numbers": _packed(_steps(which).astype(np.int32)),
        "docs": _packed(_steps(docs).astype(np.int32)), "starts": _packed(_steps(starts).astype(np.int32)),
    }
    low = id_of[docs[lead]]
    high = low.copy()
    np.maximum.at(high, which, id_of[docs])
    bucket = (anchor_key[lead] % np.uint64(n_buckets)).astype(np.int64)
    by_bucket = np.argsort(bucket, kind="stable")
    numbers = np.unique(bucket)
    edges = np.searchsorted(bucket[by_bucket], [*numbers, n_buckets])
    for k, number in enumerate(numbers):
        strings = by_bucket[edges[k] : edges[k + 1]]
        chosen = lead[strings]
        text = gather(raw, begin[chosen], size[chosen])
        yield {
            "bucket": int(number), "part": part, "n": len(strings), "n_bytes": len(text),
            "strings": _packed(text), "sizes": _packed(size[chosen].astype(np.uint8)),
            "anchors": _packed(anchor[chosen].astype(np.uint8)),
            "numbers": _packed(_steps(strings).astype(np.int32)), "lows": _packed(_steps(low[strings])),
            "spreads": _packed(high[strings] - low[strings]),
        }


# --- the run-length index ---------------------------------------------------------------


@dataclass
class RunIndex:
    """Run-compressed Burrows-Wheeler transform of strings that each end with a terminator.

    Row r stands for the r-th smallest suffix; ``symbols`` are bytes + 1, 0 ends a string. Equal
    suffixes are in the order of their strings. Per run: first row, symbol, what is added to a
    row to step one symbol to the left, and the sampled suffix positions of its two ends.
    """

    text: np.ndarray
    ends: np.ndarray  # position of each string's terminator
    run_start: np.ndarray
    run_symbol: np.ndarray
    run_step: np.ndarray
    first_suffix: np.ndarray
    last_suffix: np.ndarray
    by_symbol: np.ndarray  # symbol * runs + run, ascending
    run_at: np.ndarray  # run of each row
    low_at: np.ndarray  # smallest document of each row's stretch: rows that share MATCH bytes

    @property
    def runs(self) -> int:
        return len(self.run_start)

    def run_of(self, rows: np.ndarray) -> np.ndarray:
        return self.run_at[rows].astype(np.int64)

    def low_document(self, rows: np.ndarray) -> np.ndarray:
        """Smallest document that holds the first MATCH bytes of these rows' suffixes."""
        return self.low_at[rows]

    def common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length of the common prefix of suffixes a and b, at most ``most``."""
        out = np.zeros(len(a), dtype=np.int64)
        live = np.flatnonzero(most > 0)
        while len(live):
            x, y = self.text[a[live] + out[live]], self.text[b[live] + out[live]]
            out[live] += (x == y) & (x > 0)
            live = live[(x == y) & (x > 0) & (out[live] < most[live])]
        return out

    def stream(self, text: np.ndarray, ends: np.ndarray, sizes: np.ndarray, rows=None, positions=None):
        """Matching statistics of strings, from the last byte of each to its first.

        ``text[end - size:end]`` are the strings' symbols. A walk begins at any row whose suffix
        position is known; beginning an indexed string at its own terminator saves all jumps.
        Yields (string, place, length, row): the longest match that starts at ``place`` of the
        string, and a row whose suffix begins with it.
        """
        order = np.argsort(-sizes, kind="stable")
        ends, sizes = ends[order], sizes[order]
        length = np.zeros(len(order), dtype=np.int64)
        row = np.zeros(len(order), dtype=np.int64) if rows is None else rows[order]
        position = np.full(len(order), self.first_suffix[0]) if positions is None else positions[order]
        for step in range(1, int(sizes[0]) + 1 if len(sizes) else 0):
            n = int(np.searchsorted(-sizes, -step, "right"))
            symbol = text[ends[:n] - step]
            run = self.run_of(row[:n])
            jump = np.flatnonzero(self.run_symbol[run] != symbol)
            if len(jump):
                self._jump(jump, symbol[jump].astype(np.int64), run, row, length, position)
            here = self.run_symbol[run] == symbol
            row[:n] = np.where(here, row[:n] + self.run_step[run], row[:n])
            length[:n] = np.where(here, length[:n] + 1, 0)
            position[:n] = np.where(here, position[:n] - 1, position[:n])
            yield order[:n], sizes[:n] - step, length[:n].copy(), row[:n].copy()

    def _jump(self, lanes, symbol, run, row, length, position) -> None:
        """Move to the nearest run of the symbol above or below, whichever keeps more."""
        at = np.searchsorted(self.by_symbol, symbol * self.runs + run[lanes])
        below = self.by_symbol[np.minimum(at, self.runs - 1)]
        above = self.by_symbol[np.maximum(at - 1, 0)]
        has_below = (at < self.runs) & (below // self.runs == symbol)
        has_above = (at > 0) & (above // self.runs == symbol)
        below, above = below % self.runs, above % self.runs
        now, limit = position[lanes], length[lanes]
        keep_below = self.common(now, self.first_suffix[below], np.where(has_below, limit, 0))
        keep_above = self.common(now, self.last_suffix[above], np.where(has_above, limit, 0))
        down = has_below & (~has_above | (keep_below >= keep_above))
        some = has_below | has_above
        target = np.where(down, below, above)
        ends_of_runs = np.append(self.run_start[1:], len(self.text)) - 1
        lane, target, down = lanes[some], target[some], down[some]
        run[lane] = target
        row[lane] = np.where(down, self.run_start[target], ends_of_runs[target])
        position[lane] = np.where(down, self.first_suffix[target], self.last_suffix[target])
        length[lane] = np.where(down, keep_below[some], keep_above[some])


def _ordered(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the keys (of ``bits`` bits) in their order, equal ones by place, and where
    another key begins. A place behind its key sorts several times faster than an argsort."""
    n, low = len(key), max(len(key) - 1, 1).bit_length()
    if bits + low <= 63:
        placed = np.sort(key << low | np.arange(n))
        order, key = placed & ((1 << low) - 1), placed >> low
    else:
        order = np.argsort(key, kind="stable")
        key = key[order]
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = key[1:] != key[:-1]
    return order, fresh


def suffix_order(text: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Positions in suffix order by prefix doubling, equal suffixes by position; ``left`` is the
    distance to the terminator."""
    n = len(text)
    used = np.flatnonzero(np.bincount(text, minlength=1))
    dense = np.zeros(used[-1] + 1, dtype=np.int64)
    dense[used] = np.arange(len(used))  # the terminator, 0, stays the smallest
    width, low = max(len(used) - 1, 1).bit_length(), max(n - 1, 1).bit_length()
    depth = max((63 - low) // width, 1)
    padded = np.concatenate([dense[text], np.zeros(depth, dtype=np.int64)])
    key = np.zeros(n, dtype=np.int64)
    for k in range(depth):
        key = key << width | np.where(left >= k, padded[k : n + k], 0)
    bits, longest = depth * width, int(left.max()) + 1
    while True:
        order, fresh = _ordered(key, bits)
        if depth >= longest or fresh.all():
            return order
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(fresh) - 1
        ahead = np.zeros(n, dtype=np.int64)
        ahead[: n - depth] = rank[depth:] + 1
        key = rank << n.bit_length() | np.where(left >= depth, ahead, 0)
        bits = low + n.bit_length()
        depth *= 2


def build_index(data: np.ndarray, sizes: np.ndarray, low: np.ndarray) -> RunIndex:
    """Index of byte strings (back to back in ``data``); ``low`` is each one's smallest document."""
    ends = np.cumsum(sizes + 1) - 1
    text = np.zeros(len(data) + len(sizes), dtype=np.uint16)
    inside = np.ones(len(text), dtype=bool)
    inside[ends] = False
    text[inside] = data.astype(np.uint16) + 1
    string = np.repeat(np.arange(len(sizes)), sizes + 1)
    left = ends[string] - np.arange(len(text))
    order = suffix_order(text, left)
    before = text[np.where(left[order] == sizes[string[order]], ends[string[order]], order - 1)]
    run_start = np.flatnonzero(np.concatenate([[True], before[1:] != before[:-1]]))
    run_symbol = before[run_start].astype(np.int64)
    run_size = np.diff(np.append(run_start, len(text)))
    by_symbol = np.lexsort((np.arange(len(run_start)), run_symbol))
    arrives = np.empty(len(run_start), dtype=np.int64)
    arrives[by_symbol] = np.cumsum(run_size[by_symbol]) - run_size[by_symbol]
    prefix = _prefix_hash(text)
    long = left >= MATCH
    window = np.zeros(len(text), dtype=np.uint64)
    at = np.flatnonzero(long)
    window[at] = _substring_hash(prefix, at, at + MATCH)
    window, long = window[order], long[order]
    fresh = np.ones(len(text), dtype=bool)
    fresh[1:] = (window[1:] != window[:-1]) | ~long[1:] | ~long[:-1]
    stretch_start = np.flatnonzero(fresh)
    stretch_low = np.minimum.reduceat(low[string[order]], stretch_start)
    return RunIndex(
        text, ends, run_start, run_symbol, arrives - run_start,
        order[run_start], order[run_start + run_size - 1],
        run_symbol[by_symbol] * len(run_start) + by_symbol,
        np.repeat(np.arange(len(run_start), dtype=np.int32), run_size),
        np.repeat(stretch_low, np.diff(np.append(stretch_start, len(text)))),
    )


def lowest_documents(data: np.ndarray, sizes: np.ndarray, low: np.ndarray) -> np.ndarray:
    """For every window of every string, the smallest document that holds it; the windows of
    all strings (size - MATCH + 1 each) back to back."""
    index = build_index(data, sizes, low)
    windows = sizes - MATCH + 1
    first = np.cumsum(windows) - windows
    out = np.empty(int(windows.sum()), dtype=np.int64)
    # Terminators are the smallest symbols, so the first rows are the strings' ends in order.
    for string, place, length, row in index.stream(
        index.text, index.ends, sizes, np.arange(len(sizes)), index.ends
    ):
        far = length >= MATCH
        out[first[string[far]] + place[far]] = index.low_document(row[far])
    return out


# --- buckets -----------------------------------------------------------------------------


def _keys(data, sizes, anchors):
    """Hashes of whole strings, of their anchors, and of their contexts (0 where a string does
    not reach as far), about a megabyte of strings at a time."""
    begin = np.cumsum(sizes) - sizes
    whole, anchor = np.empty(len(sizes), dtype=np.uint64), np.empty(len(sizes), dtype=np.uint64)
    contexts = np.zeros((len(_REACHES), len(sizes)), dtype=np.uint64)
    low = 0
    while low < len(sizes):
        high = max(int(np.searchsorted(begin, begin[low] + (1 << 20))), low + 1)
        part, origin = slice(low, high), begin[low]
        prefix = _prefix_hash(data[origin : begin[high - 1] + sizes[high - 1]])
        start = begin[part] - origin
        at = start + anchors[part]
        whole[part] = _substring_hash(prefix, start, start + sizes[part])
        anchor[part] = _substring_hash(prefix, at, at + ANCHOR)
        for row, reach in zip(contexts, _REACHES):
            inside = np.flatnonzero((anchors[part] >= reach) & (sizes[part] - anchors[part] >= CONTEXT - reach))
            row[low + inside] = _substring_hash(prefix, at[inside] - reach, at[inside] - reach + CONTEXT)
        low = high
    return begin, whole, anchor, contexts


def _differ(key: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Per row: whether the documents of its group (equal key) differ."""
    _, group, count = np.unique(key, return_inverse=True, return_counts=True)
    least, most = np.full(len(count), _LAST_ID), np.full(len(count), np.iinfo(np.int64).min)
    np.minimum.at(least, group, low)
    np.maximum.at(most, group, high)
    return (least < most)[group]


def _search(table: pa.Table) -> pa.Table:
    """Marks for the strings of one bucket; a chunk's places pass through."""
    sent = table.to_pylist()
    if sent[0]["bucket"] < 0:
        rows = [{"places": True} | {c: r[c] for c in ("part", "n", "numbers", "docs", "starts")} for r in sent]
        return pa.Table.from_pylist(rows, schema=_FOUND_ARROW)
    columns = []
    for row in sent:
        n = row["n"]
        low = np.cumsum(_unpacked(row["lows"], np.int64, n))
        columns.append((
            _unpacked(row["strings"], np.uint8, row["n_bytes"]),
            _unpacked(row["sizes"], np.uint8, n).astype(np.int64), _unpacked(row["anchors"], np.uint8, n).astype(np.int64),
            low, low + _unpacked(row["spreads"], np.int64, n),
            np.full(n, row["part"]), np.cumsum(_unpacked(row["numbers"], np.int32, n), dtype=np.int64),
        ))
    data, sizes, anchors, low, high, part, number = (np.concatenate(c) for c in zip(*columns))
    del sent, columns
    string, start, length, doc = _search_bucket(data, sizes, anchors, low, high)
    return _mark_rows(part[string], number[string], start, length, doc)


def _search_bucket(data, sizes, anchors, sent_low, sent_high):
    """(sent string, first window, windows, document): runs of windows that ``document`` holds,
    which is smaller than the largest document that the string was sent with."""
    begin, whole, anchor, contexts = _keys(data, sizes, anchors)
    _, lead, string = np.unique(whole, return_index=True, return_inverse=True)
    low, high = np.full(len(lead), _LAST_ID), np.full(len(lead), np.iinfo(np.int64).min)
    np.minimum.at(low, string, sent_low)
    np.maximum.at(high, string, sent_high)
    shared = np.zeros(len(lead), dtype=bool)
    for key in contexts[:, lead]:
        rows = np.flatnonzero(key)
        shared[rows] |= _differ(key[rows], low[rows], high[rows])
    windows = np.where(shared, sizes[lead] - MATCH + 1, 0)
    first = np.cumsum(windows) - windows
    lows = np.empty(int(windows.sum()), dtype=np.int64)
    rows = np.flatnonzero(shared)
    rows = rows[np.argsort(anchor[lead[rows]], kind="stable")]
    # Parts of about INDEX_BYTES, cut where the anchor changes.
    filled, anchors_by = np.cumsum(sizes[lead[rows]]), anchor[lead[rows]]
    cuts = np.append(np.flatnonzero(anchors_by[1:] != anchors_by[:-1]) + 1, len(rows))
    start = 0
    while start < len(rows):
        until = int(np.searchsorted(filled, (filled[start - 1] if start else 0) + INDEX_BYTES)) + 1
        until = int(cuts[np.searchsorted(cuts, min(until, len(rows)))])
        part = rows[start:until]
        own = lead[part]
        found = lowest_documents(gather(data, begin[own], sizes[own]), sizes[own], low[part])
        lows[np.repeat(first[part] - (np.cumsum(windows[part]) - windows[part]), windows[part]) + np.arange(len(found))] = found
        start = until
    sent = np.flatnonzero(shared[string])
    found = _marked_runs(string[sent], sent_low[sent], sent_high[sent], first, windows, lows)
    return sent[found[0]], *found[1:]


def _marked_runs(string, low, high, window_first, windows, lows):
    """Runs of windows of each sent string that a document below its largest one holds. Where a
    string was sent for several documents, a run has one such document, as it decides for whom."""
    out = [(np.zeros(0, dtype=np.int64),) * 4]
    per = max(1, (4 << 20) // MATCH)
    for at in range(0, len(string), per):
        s = string[at : at + per]
        n = windows[s]
        first = np.cumsum(n) - n
        place = np.repeat(np.arange(len(s)), n)
        offset = np.arange(len(place)) - first[place]
        least = lows[window_first[s][place] + offset]
        removed = least < high[at : at + per][place]
        several = (low < high)[at : at + per][place]
        cut = (place[1:] != place[:-1]) | (several[1:] & (least[1:] != least[:-1]))
        begins = removed.copy()
        begins[1:] &= ~removed[:-1] | cut
        ends = removed.copy()
        ends[:-1] &= ~removed[1:] | cut
        a, b = np.flatnonzero(begins), np.flatnonzero(ends)
        out.append((place[a] + at, offset[a], offset[b] - offset[a] + 1, least[a]))
    return tuple(np.concatenate(c) for c in zip(*out))


def _mark_rows(part, number, starts, lengths, docs) -> pa.Table:
    """One row per chunk with the marks on its strings."""
    order = np.lexsort((starts, number, part))
    part, number, starts, lengths, docs = (c[order] for c in (part, number, starts, lengths, docs))
    rows = []
    parts, first = np.unique(part, return_index=True)
    for chunk, a, b in zip(parts.tolist(), first, [*first[1:], len(part)]):
        rows.append({
            "part": chunk, "places": False, "n": int(b - a), "numbers": _packed(_steps(number[a:b]).astype(np.int32)),
            "docs": _packed(_steps(docs[a:b])), "starts": _packed(starts[a:b].astype(np.uint8)),
            "lengths": _packed(lengths[a:b].astype(np.uint8)),
        })
    return pa.Table.from_pylist(rows, schema=_FOUND_ARROW)


# --- documents ---------------------------------------------------------------------------


def _removed_runs(found: pa.Table, id_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number, start, stop) of byte runs to remove: the marks laid on a chunk's places."""
    places = marks = None
    held = []
    for row in found.to_pylist():
        n = row["n"]
        number = np.cumsum(_unpacked(row["numbers"], np.int32, n), dtype=np.int64)
        if row["places"]:
            docs, starts = (np.cumsum(_unpacked(row[c], np.int32, n), dtype=np.int64) for c in ("docs", "starts"))
            places = number, docs, starts
        else:
            held.append((
                number, _unpacked(row["starts"], np.uint8, n).astype(np.int64),
                _unpacked(row["lengths"], np.uint8, n).astype(np.int64), np.cumsum(_unpacked(row["docs"], np.int64, n)),
            ))
    if not held:
        return (np.zeros(0, dtype=np.int64),) * 3
    marks = [np.concatenate(c) for c in zip(*held)]
    marks = [c[np.argsort(marks[0], kind="stable")] for c in marks]
    out = []
    for at in range(0, len(places[0]), 1 << 20):
        string, doc, start = (c[at : at + (1 << 20)] for c in places)
        low = np.searchsorted(marks[0], string)
        n = np.searchsorted(marks[0], string, "right") - low
        first = np.cumsum(n) - n
        mark = np.arange(int(n.sum())) + np.repeat(low - first, n)
        doc, start = np.repeat(doc, n), np.repeat(start, n) + marks[1][mark]
        meant = np.flatnonzero(marks[3][mark] < id_of[doc])
        out.append((doc[meant], start[meant], (start + marks[2][mark] - 1 + MATCH)[meant]))
    return tuple(np.concatenate(c) for c in zip(*out))


def _remove(docs: pa.Table, found: pa.Table) -> pa.Table:
    """The texts of one chunk without the bytes that were found for them."""
    raw, offsets, number, id_of = _numbered(docs)
    owner, start, stop = _removed_runs(found, id_of)
    order = np.argsort(owner, kind="stable")
    owner, start, stop = owner[order], start[order], stop[order]
    low, high = np.searchsorted(owner, number), np.searchsorted(owner, number, "right")
    columns: dict[str, list] = {c: [] for c in ("n_bytes", "starts", "stops", "kept")}
    for text_at, text_to, a, b in zip(offsets[:-1], offsets[1:], low, high):
        text = raw[text_at:text_to]
        size, starts, stops = len(text), (), ()
        if a < b:
            depth = np.zeros(size + 1, dtype=np.int32)
            np.add.at(depth, start[a:b], 1)
            np.add.at(depth, stop[a:b], -1)
            removed = np.cumsum(depth[:-1]) > 0
            edges = np.flatnonzero(np.diff(removed, prepend=False, append=False))
            starts, stops = edges[::2].tolist(), edges[1::2].tolist()
            text = text[~removed]
        for c, value in zip(columns, (size, starts, stops, text.tobytes())):
            columns[c].append(value)
    lists = pa.list_(pa.int64())
    return pa.table({
        "doc_id": docs.column("doc_id"), "n_bytes": pa.array(columns["n_bytes"], pa.int64()),
        "starts": pa.array(columns["starts"], lists), "stops": pa.array(columns["stops"], lists),
        "kept": pa.array(columns["kept"], pa.binary()),
    })


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, starts, stops, kept), one row per input row.

    Each byte covered by a 50-byte string that also starts in a document with a smaller doc_id
    is removed; ``starts`` and ``stops`` are the maximal removed byte runs of the UTF-8 text,
    ``kept`` the other bytes. Strings are judged on the input. A null text counts as empty; a
    text of less than 50 bytes keeps all. A null doc_id counts as larger than all others. Rows
    that repeat a doc_id do not remove from each other, and each row's own text decides what is
    removed from it. Other columns of ``docs`` are ignored.

    The numbers of buckets and chunks follow the bytes of the input. A bucket gets a string at most
    once from a chunk and a chunk at most one row from a bucket, so the copies of a string are
    spread over the chunks that hold them. Strings with one anchor meet in one bucket.
    """
    spark = docs.sparkSession
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_buckets, n_chunks = max(least, -(-size // BUCKET_BYTES)), max(least, -(-size // CHUNK_BYTES))
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_chunks)).alias("part")
    chunks = texts.select(part, "doc_id", "text").repartition(n_chunks, "part")
    sent = chunks.groupBy("part").applyInArrow(_sender(n_buckets), _SENT)
    found = sent.repartition(n_buckets, "bucket").groupBy("bucket").applyInArrow(_search, _FOUND)
    return (
        chunks.groupBy("part").cogroup(found.repartition(n_chunks, "part").groupBy("part"))
        .applyInArrow(_remove, _RESULT)
    )


def op5_repeats(spark, sf_dir: str) -> DataFrame:
    """What is left of every document once repeated 50-byte strings are removed."""
    left = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return left.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
