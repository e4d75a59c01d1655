"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, and an
exact check of the weighted shingles.

Every window of a document that is as long as a benchmark item gets a 128-bit SimHash of its
5-word shingles, each as heavy as it is frequent. The index keeps 16 blocks of 8 bits of each
item's fingerprint, entered under every value one bit away, apart for every item size. Two
fingerprints that differ in at most 31 bits differ by at most one bit in some block, so looking
up the 16 blocks of a window among the items of its size finds every one within that radius.
Candidates are confirmed by the exact weighted Jaccard similarity of the shingles.

A window without a shingle of an item cannot be similar to it, so fingerprints are computed
only around shingles that occur in the benchmark; this leaves out nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfcast.llm import words as wh

WIDTH = 5
SIMILARITY = 0.8
RADIUS = 31
BLOCKS = 16  # of 8 bits
#: Text bytes of the benchmark that are broadcast at a time; a larger one takes several scans.
ITEM_BYTES = 16 << 20
_WINDOWS = 2048  # windows fingerprinted at a time
_FILTER_BITS = 20


@dataclass
class ItemIndex:
    """Benchmark items: shingles, fingerprints and the blocks that lead to them."""

    ids: list
    size: np.ndarray  # words
    width: np.ndarray  # words of a shingle: 5, or all of a shorter item
    shingles: list[tuple[np.ndarray, np.ndarray]]  # distinct hashes and counts, per item
    weight: np.ndarray  # shingles with repeats
    fingerprint: np.ndarray  # (items, BLOCKS) bytes
    owner_key: np.ndarray  # every shingle of every item, ascending
    owner: np.ndarray
    seen: np.ndarray  # filter over the low bits of a shingle's hash
    sizes: np.ndarray  # distinct sizes, ascending
    size_first: np.ndarray  # (sizes + 1) offsets into cell and cell_item
    cell: np.ndarray  # block * 256 + value, ascending within a size
    cell_item: np.ndarray


def fingerprints(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """SimHash bytes of the shingle runs ``values[first:last]``."""
    bits = np.unpackbits(
        np.stack([wh.mix(values, seed) for seed in (21, 22)], axis=1).view(np.uint8), axis=1
    ).astype(np.int32) * 2 - 1
    total = np.zeros((len(values) + 1, bits.shape[1]), dtype=np.int32)
    np.cumsum(bits, axis=0, out=total[1:])
    return np.packbits(total[last] > total[first], axis=1)


def build_index(ids: list, texts: list[str]) -> ItemIndex:
    words = wh.split_words(pa.array(texts, pa.string()), wh.PUNCTUATION)
    size = words.counts()
    used = np.flatnonzero(size > 0)
    shingles, prints = [], []
    for i in used:
        own = words.hashes[words.first[i] : words.first[i + 1]]
        one = wh.Words(own, np.array([0, len(own)]))
        values, _ = wh.shingles(one, min(WIDTH, len(own)))
        prints.append(fingerprints(values, np.array([0]), np.array([len(values)]))[0])
        shingles.append(np.unique(values, return_counts=True))
    prints = np.array(prints, dtype=np.uint8).reshape(-1, BLOCKS)
    near = np.concatenate([[0], 1 << np.arange(8)]).astype(np.uint8)
    values = prints[:, :, None] ^ near  # items x blocks x 9
    cell = (np.arange(BLOCKS)[None, :, None] * 256 + values).reshape(-1).astype(np.uint16)
    item = np.repeat(np.arange(len(used), dtype=np.int32), BLOCKS * 9)
    order = np.lexsort((cell, size[used][item]))
    sizes, entries = np.unique(size[used], return_counts=True)
    keys = np.concatenate([s for s, _ in shingles]) if shingles else np.zeros(0, dtype=np.uint64)
    owner = np.repeat(np.arange(len(used)), [len(s) for s, _ in shingles])
    by_key = np.argsort(keys, kind="stable")
    seen = np.zeros(1 << _FILTER_BITS, dtype=bool)
    seen[(keys & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)] = True
    return ItemIndex(
        [ids[i] for i in used], size[used], np.minimum(size[used], WIDTH), shingles,
        np.array([int(c.sum()) for _, c in shingles], dtype=np.int64), prints, keys[by_key], owner[by_key],
        seen, sizes, np.append(0, np.cumsum(entries * BLOCKS * 9)), cell[order], item[order],
    )


def _benchmark_hits(index: ItemIndex, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, item) for every shingle of a text that an item has."""
    place = np.flatnonzero(index.seen[(values & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)])
    low = np.searchsorted(index.owner_key, values[place])
    n = np.searchsorted(index.owner_key, values[place], "right") - low
    first = np.cumsum(n) - n
    at = np.arange(int(n.sum())) + np.repeat(low - first, n)
    return np.repeat(place, n), index.owner[at]


def _window_starts(places: np.ndarray, span: int, n: int) -> np.ndarray:
    """Starts of all windows of ``span`` shingles that hold one of the places."""
    last = max(n - span, 0)
    low, high = np.maximum(places - span + 1, 0), np.minimum(places, last)
    edge = np.zeros(last + 2, dtype=np.int64)
    np.add.at(edge, np.minimum(low, last), 1)
    np.add.at(edge, high + 1, -1)
    return np.flatnonzero(np.cumsum(edge[:-1]) > 0)


def _candidates(index: ItemIndex, prints: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, item), each once, of items of this size that have a block one bit away at most."""
    at = int(np.searchsorted(index.sizes, size))
    mine = slice(index.size_first[at], index.size_first[at + 1])
    wanted = (np.arange(BLOCKS) * 256 + prints).reshape(-1).astype(np.uint16)
    low = np.searchsorted(index.cell[mine], wanted)
    n = np.searchsorted(index.cell[mine], wanted, "right") - low
    first = np.cumsum(n) - n
    item = index.cell_item[mine][np.arange(int(n.sum())) + np.repeat(low - first, n)].astype(np.int64)
    window = np.repeat(np.repeat(np.arange(len(prints)), BLOCKS), n)
    pair = np.unique(window * len(index.ids) + item)
    return pair // len(index.ids), pair % len(index.ids)


def _near_items(index: ItemIndex, prints: np.ndarray, size: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, item, distance) of all pairs within the radius, through the block index; of all
    items, or of those of one size."""
    sizes = index.sizes if size is None else [size]
    window, item = (np.concatenate(c) for c in zip(*(_candidates(index, prints, n) for n in sizes)))
    distance = np.bitwise_count(prints[window] ^ index.fingerprint[item]).sum(axis=1)
    close = distance <= RADIUS
    return window[close], item[close], distance[close]


def _similarity(index: ItemIndex, item: int, values: np.ndarray) -> float:
    """Weighted Jaccard: sum of the smaller counts over sum of the larger ones."""
    own, counts = index.shingles[item]
    at = np.searchsorted(own, values)
    at[at == len(own)] = 0
    met = np.bincount(at[own[at] == values], minlength=len(own))
    common = int(np.minimum(met, counts).sum())
    return common / (len(values) + int(index.weight[item]) - common)


def search_text(index: ItemIndex, values: np.ndarray, width: int, places: np.ndarray, items: np.ndarray):
    """item -> (similarity, distance, start) of its best window in one text's shingles."""
    best: dict[int, tuple] = {}
    for size in np.unique(index.size[items]):
        if min(int(size), WIDTH) != width:
            continue
        span = int(size) - width + 1
        starts = _window_starts(np.unique(places[index.size[items] == size]), span, len(values))
        for k in range(0, len(starts), _WINDOWS):
            start = starts[k : k + _WINDOWS]
            # Windows of one stretch are neighbours; far ones are taken in separate runs.
            for run in np.split(start, np.flatnonzero(np.diff(start) > span) + 1):
                stop = np.minimum(run + span, len(values))
                origin = run[0]
                prints = fingerprints(values[origin : stop[-1]], run - origin, stop - origin)
                for w, item, distance in zip(*_near_items(index, prints, int(size))):
                    similarity = _similarity(index, item, values[run[w] : stop[w]])
                    if similarity >= SIMILARITY:
                        now = (similarity, -int(distance), -int(run[w]))
                        best[item] = max(best.get(item, now), now)
    return best


def _matches(index: ItemIndex, texts: pa.Array) -> Iterator[tuple[int, int, float, int, int]]:
    """(text, item, similarity, distance, first word) of all contaminated texts."""
    words = wh.split_words(texts, wh.PUNCTUATION)
    for width in np.unique(index.width):
        values, first = wh.shingles(words, int(width))
        long_enough = words.counts() >= width
        place, item = _benchmark_hits(index, values)
        doc = np.searchsorted(first, place, "right") - 1
        good = long_enough[doc] & (index.width[item] == width)
        place, item, doc = place[good], item[good], doc[good]
        edges = np.flatnonzero(np.diff(doc, prepend=-1, append=-1))
        for a, b in zip(edges[:-1], edges[1:]):
            d = int(doc[a])
            own = values[first[d] : first[d + 1]]
            found = search_text(index, own, int(width), place[a:b] - first[d], item[a:b])
            for i, (similarity, distance, start) in sorted(found.items()):
                yield d, i, similarity, -distance, -start


def _finder(shared, item_type: pa.DataType):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for piece in wh.slices(batch):
                rows = list(_matches(index, piece.column("text")))
                doc, item, similarity, distance, start = zip(*rows) if rows else ((),) * 5
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id").take(pa.array(doc, pa.int64())),
                        pa.array([index.ids[i] for i in item], item_type),
                        pa.array(start, pa.int64()),
                        pa.array([int(index.size[i]) for i in item], pa.int64()),
                        pa.array(distance, pa.int32()), pa.array(similarity, pa.float64()),
                    ],
                    names=["doc_id", "item_id", "first_word", "n_words", "distance", "similarity"],
                )

    return find


def _cleaner(shared):
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in wh.slices(batch):
                hit = {row[0] for row in _matches(shared.value, piece.column("text"))}
                yield piece.filter(pa.array([i not in hit for i in range(piece.num_rows)], pa.bool_()))

    return clean


def item_blocks(benchmark: DataFrame) -> Iterator[tuple[list, list[str]]]:
    """The items in blocks of about ITEM_BYTES of text; null and wordless texts match nothing."""
    items = benchmark.select("item_id", "text").where("text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text") + 64).alias("bytes")).first()["bytes"] or 0
    blocks = max(1, -(-size // ITEM_BYTES))
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy("item_id", "text").collect()
        yield [r["item_id"] for r in rows], [r["text"] for r in rows]


def find_benchmark_text(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, first_word, n_words, distance, similarity): the best window of every
    item in every document that holds one with similarity 0.8 or more.

    Words are lower-cased runs of letters and digits. A document shorter than an item is one
    window. An item of fewer than five words is a single shingle. Null, empty and wordless
    texts hold nothing; a null doc_id is reported as null; repeated rows and repeated items are
    reported each; equal windows go to the first one. Other columns are ignored. The benchmark
    is a stated query set: it is broadcast in blocks of bounded size, with a scan of the
    documents for each.
    """
    spark = docs.sparkSession
    kind = benchmark.schema["item_id"].dataType
    item_type = pa.string() if kind.simpleString() == "string" else pa.int64()
    schema = (
        f"doc_id long, item_id {'string' if item_type == pa.string() else 'long'}, first_word long, "
        "n_words long, distance int, similarity double"
    )
    out = None
    for ids, texts in item_blocks(benchmark):
        shared = spark.sparkContext.broadcast(build_index(ids, texts))
        part = docs.select("doc_id", "text").mapInArrow(_finder(shared, item_type), schema)
        out = part if out is None else out.unionAll(part)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns; no shuffle."""
    for ids, texts in item_blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(build_index(ids, texts))
        docs = docs.mapInArrow(_cleaner(shared), docs.schema)
    return docs


def op8_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Benchmark items found in the documents."""
    return find_benchmark_text(
        spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    )
