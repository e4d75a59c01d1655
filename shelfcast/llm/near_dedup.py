"""MinHash near-duplicates: one-permutation hashing with optimal densification, banded
buckets and star-shaped candidate edges, every link confirmed on the full shingle sets.

Documents with equal sets are one class, and only one text of it takes part in the search.
In each bucket every member is tried against one hub, so m members give m - 1 edges: first
against the member whose buckets are fullest (the middle of a group of copies), then against
another one. Links found that way merge most of a bucket. A last exact round compares members
that are still in different components: in blocks of a bucket, by 4096-bit sketches, so that
only pairs within reach of the threshold leave the task, and those are confirmed on the texts.
No bucket is capped, and no pair is left out because of a hub.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfcast.llm import words as wh
from shelfcast.llm.graph import components
from shelfcast.session import cut_lineage

#: Rounds of star edges; the exact round follows.
STAR_ROUNDS = 2
#: Shared buckets that a pair needs in the exact round. With 25 bands of 5 rows a pair at
#: similarity 0.85 misses it with probability 9e-6.
FINAL_BANDS = 2
#: Members of a bucket that one task of the exact round compares with as many others.
BLOCK = 4096
#: Bits of a sketch, and how many standard deviations below the threshold are still compared.
SKETCH_BITS = 4096
SKETCH_REACH = 5.0

_SKETCH = "doc_id long, text_key long, n_shingles long, set_key string, bands array<long>"
_PROBE = "rep long, bands array<long>, sketch binary"
_TESTED = "a long, b long, linked boolean"


def signatures(values: np.ndarray, first: np.ndarray, bins: int) -> np.ndarray:
    """One-permutation minima (documents x bins) of sorted distinct hashes.

    The hash range is cut into ``bins`` equal parts; a bin's minimum is the first hash in it.
    An empty bin takes the value of the bin that a hash sequence shared by all documents
    visits first and that is not empty (optimal densification).
    """
    n_docs = len(first) - 1
    doc = np.repeat(np.arange(n_docs), np.diff(first))
    part = ((values >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    cell = doc * bins + part
    leads = np.ones(len(cell), dtype=bool)
    leads[1:] = cell[1:] != cell[:-1]
    full = np.zeros((n_docs, bins), dtype=bool)
    out = np.zeros((n_docs, bins), dtype=np.uint64)
    full.flat[cell[leads]] = True
    out.flat[cell[leads]] = values[leads]
    rows, holes = np.nonzero(~full & (np.diff(first) > 0)[:, None])
    step = 0
    while len(rows):
        step += 1
        probe = (wh.mix(holes.astype(np.uint64), step) % np.uint64(bins)).astype(np.int64)
        hit = full[rows, probe]
        out[rows[hit], holes[hit]] = out[rows[hit], probe[hit]]
        rows, holes = rows[~hit], holes[~hit]
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key per band, different bands never share one on purpose."""
    scales = wh.powers(wh._BASE, rows + 1)[1:]
    grouped = signature[:, : bands * rows].reshape(len(signature), bands, rows)
    joined = (grouped * scales).sum(axis=2, dtype=np.uint64)
    return wh.mix(joined + wh.mix(np.arange(bands, dtype=np.uint64))).view(np.int64)


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    return wh.distinct_sorted(*wh.shingles(wh.split_words(texts), width))


def _sketcher(width: int, bands: int, rows: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in wh.slices(batch):
                values, first = shingle_sets(piece.column("text"), width)
                sizes = np.diff(first)
                keys = band_keys(signatures(values, first, bands * rows), bands, rows)
                sums = []
                for seed in (1, 2):
                    prefix = np.concatenate([[np.uint64(0)], np.cumsum(wh.mix(values, seed), dtype=np.uint64)])
                    sums.append(prefix[first[1:]] - prefix[first[:-1]])
                used = sizes > 0
                offsets = np.concatenate([[0], np.cumsum(used * bands)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        piece.column("text_key"),
                        pa.array(sizes),
                        pa.array([f"{a:016x}{b:016x}" for a, b in zip(*(s.tolist() for s in sums))]),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[used].reshape(-1))),
                    ],
                    names=["doc_id", "text_key", "n_shingles", "set_key", "bands"],
                )

    return sketch


def _tester(width: int, percent: int):
    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in wh.slices(batch, "text_b"):
                # Rows arrive sorted by hub, so a hub's text is hashed once per run of rows.
                hub = np.asarray(piece.column("a"))
                leads = np.concatenate([[True], hub[1:] != hub[:-1]])
                left, left_first = shingle_sets(piece.column("text_a").take(pa.array(np.flatnonzero(leads))), width)
                which = np.cumsum(leads) - 1
                right, right_first = shingle_sets(piece.column("text_b"), width)
                linked = np.empty(len(hub), dtype=bool)
                for i, k in enumerate(which):
                    x = left[left_first[k] : left_first[k + 1]]
                    y = right[right_first[i] : right_first[i + 1]]
                    at = np.searchsorted(x, y)
                    at[at == len(x)] = 0
                    common = int((x[at] == y).sum()) if len(x) else 0
                    linked[i] = common > 0 and 100 * common >= percent * (len(x) + len(y) - common)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("a"), piece.column("b"), pa.array(linked)], names=["a", "b", "linked"]
                )

    return test


def _test_edges(edges: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Confirm candidate edges (a, b) on the texts of both ends."""
    left = texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b"))
    pairs = edges.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return cut_lineage(pairs.sortWithinPartitions("a").mapInArrow(_tester(width, percent), _TESTED))


def _similar_size(percent: int):
    """Sets whose sizes alone rule the similarity out are not compared."""
    return 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")


def _untested(pairs: DataFrame, tested: DataFrame | None) -> DataFrame:
    return pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti")


def _star_edges(members: DataFrame, tested: DataFrame | None, turn: int, percent: int) -> DataFrame:
    """An edge from each member of a bucket to the bucket's hub, if their components differ."""
    rank = F.struct((-F.col("crowd") if turn == 0 else F.xxhash64("rep", F.lit(turn))).alias("rank"),
                    F.col("rep").alias("hub"), F.col("component").alias("hub_component"),
                    F.col("n").alias("n_a"))
    hubs = members.groupBy("band").agg(F.min(rank).alias("h")).select("band", "h.*").drop("rank")
    met = members.withColumnRenamed("n", "n_b").join(hubs, "band")
    return _untested(
        met.where(_similar_size(percent) & (F.col("component") != F.col("hub_component")))
        .select(F.least("hub", "rep").alias("a"), F.greatest("hub", "rep").alias("b")).distinct(),
        tested,
    )


def bit_sketches(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """SKETCH_BITS one-bit minima per document, packed: equal bits grow with the similarity."""
    out = np.empty((len(first) - 1, SKETCH_BITS // 8), dtype=np.uint8)
    salt = wh.mix(np.arange(SKETCH_BITS, dtype=np.uint64), 5)
    for start in range(0, len(out), 256):
        part = first[start : start + 257]
        signature = signatures(values[part[0] : part[-1]], part - part[0], SKETCH_BITS)
        out[start : start + 256] = np.packbits((wh.mix(signature ^ salt) & np.uint64(1)).astype(bool), axis=1)
    return out


def _prober(width: int, bands: int, rows: int):
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in wh.slices(batch):
                values, first = shingle_sets(piece.column("text"), width)
                keys = band_keys(signatures(values, first, bands * rows), bands, rows)
                offsets = np.arange(len(first), dtype=np.int32) * bands
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("rep"),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.reshape(-1))),
                        pa.array([row.tobytes() for row in bit_sketches(values, first)], pa.binary()),
                    ],
                    names=["rep", "bands", "sketch"],
                )

    return probe


def _block_search(percent: int):
    odd = (1 - percent / 100) / 2  # share of differing bits at the threshold
    most = SKETCH_BITS * odd + SKETCH_REACH * np.sqrt(SKETCH_BITS * odd * (1 - odd))

    def search(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        col = {c: table.column(c).to_numpy() for c in ("band", "i", "j", "chunk", "rep", "n", "component", "main")}
        bands = np.stack(table.column("bands").to_numpy())
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint64).reshape(len(bands), -1)
        band, outside = col["band"][0], col["component"] != col["main"]
        left = np.flatnonzero(col["chunk"] == col["i"][0])
        right = np.flatnonzero(col["chunk"] == col["j"][0])
        found = [np.zeros((0, 2), dtype=np.int64)]
        for start in range(0, len(left), 64):
            x = left[start : start + 64]
            n_x, n_y = col["n"][x][:, None], col["n"][right]
            possible = (
                (col["component"][x][:, None] != col["component"][right])
                & (outside[x][:, None] | outside[right])
                & (100 * np.minimum(n_x, n_y) >= percent * np.maximum(n_x, n_y))
            )
            if col["i"][0] == col["j"][0]:
                possible &= col["rep"][x][:, None] < col["rep"][right]
            a, b = np.nonzero(possible)
            for at in range(0, len(a), 20_000):
                p, q = x[a[at : at + 20_000]], right[b[at : at + 20_000]]
                near = np.bitwise_count(sketch[p] ^ sketch[q]).sum(axis=1, dtype=np.int64) <= most
                p, q = p[near], q[near]
                same = bands[p] == bands[q]
                # A pair is taken in the first of the buckets that it shares.
                here = bands[p, same.argmax(axis=1)] == band
                take = here & (same.sum(axis=1) >= FINAL_BANDS)
                found.append(np.stack([col["rep"][p[take]], col["rep"][q[take]]], axis=1))
        pairs = np.sort(np.concatenate(found), axis=1)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return search


def _rest_edges(
    members: DataFrame, texts: DataFrame, tested: DataFrame, width: int, percent: int, bands: int, rows: int
) -> DataFrame:
    """Every pair of a bucket in different components that may reach the threshold.

    Buckets of a single component are passed over. The others are compared in pairs of blocks
    of about BLOCK members, each a group of its own.
    """
    sizes = members.groupBy("band", "component").agg(F.count("*").alias("size"))
    hubs = sizes.groupBy("band").agg(
        F.max(F.struct("size", "component")).getField("component").alias("main"),
        F.count("*").alias("components"), F.ceil(F.sum("size") / BLOCK).cast("long").alias("chunks"),
    ).where("components > 1").select("band", "main", "chunks")
    mixed = cut_lineage(members.join(hubs, "band"))
    # Sketching is dear and texts are small: spread by rows, not by bytes.
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    needed = texts.join(mixed.select("rep").distinct(), "rep", "left_semi").repartition(parts, "rep")
    probes = needed.mapInArrow(_prober(width, bands, rows), _PROBE)
    chunk = F.pmod(F.xxhash64("rep"), "chunks")
    blocks = (
        mixed.withColumn("chunk", chunk)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
        .select("band", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"),
                "chunk", "rep", "n", "component", "main")
    )
    pairs = blocks.join(probes, "rep").groupBy("band", "i", "j").applyInArrow(_block_search(percent), "a long, b long")
    return _untested(pairs, tested)


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, bands: int = 36, rows: int = 5
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per input row.

    Documents are linked if the Jaccard similarity of their sets of ``width``-word shingles is
    at least ``percent`` / 100. ``component_id`` is the smallest doc_id reachable over links.
    Null, empty and blank texts have the empty set and are linked with nothing; a text with
    fewer words is one shingle. Repeated rows are exact copies; rows of one id with different
    texts are linked by their own texts. A null doc_id cannot be named
    as a component: such a row is its own (null) component and is kept. Other columns of
    ``docs`` are ignored, so their names cannot clash.
    """
    return _linked(docs, width, percent, bands, rows).select("doc_id", "n_shingles", "component_id", "kept")


def _linked(docs: DataFrame, width: int, percent: int, bands: int, rows: int) -> DataFrame:
    """``near_duplicates`` with ``text_key``, a hash of the text, and the number ``component``.

    Classes have numbers of their own, so that texts that share an id stay apart.
    """
    source = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    sketch = cut_lineage(source.mapInArrow(_sketcher(width, bands, rows), _SKETCH))
    named = sketch.where("n_shingles > 0 AND doc_id IS NOT NULL")
    first = F.min(F.struct("doc_id", "text_key", "n_shingles", "bands")).alias("r")
    classes = cut_lineage(
        named.groupBy("set_key").agg(first)
        .select(F.monotonically_increasing_id().alias("rep"), "set_key", F.col("r.n_shingles").alias("n"),
                "r.doc_id", "r.text_key", "r.bands")
    )
    reps = classes.select("rep", "n", F.explode("bands").alias("band"))
    crowded = reps.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    shared = cut_lineage(reps.join(crowded, "band"))
    buckets = shared.join(shared.groupBy("rep").agg(F.sum("size").alias("crowd")), "rep").drop("size")
    involved = classes.select("rep", "doc_id", "text_key").join(buckets.select("rep").distinct(), "rep", "left_semi")
    texts = cut_lineage(
        source.join(involved, ["doc_id", "text_key"]).groupBy("rep").agg(F.min("text").alias("text"))
    )
    tested, found = None, None
    members = buckets.withColumn("component", F.col("rep"))
    for turn in range(STAR_ROUNDS + 1):
        if turn < STAR_ROUNDS:
            edges = _star_edges(members, tested, turn, percent)
        else:
            edges = _rest_edges(members, texts, tested, width, percent, bands, rows)
        fresh = _test_edges(edges, texts, width, percent)
        tested = fresh if tested is None else tested.unionAll(fresh)
        if found is not None and fresh.where("linked").isEmpty():
            continue
        found = components(tested.where("linked").select("a", "b"))
        members = buckets.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
            "band", "rep", "n", "crowd", F.coalesce("component", "rep").alias("component")
        )
    grouped = classes.select("rep", "set_key", "doc_id").join(found, F.col("rep") == F.col("node"), "left").select(
        "set_key", "doc_id", F.coalesce("component", "rep").alias("component")
    )
    least = grouped.groupBy("component").agg(F.min("doc_id").alias("least_id"))
    named_classes = grouped.join(least, "component").select("set_key", "component", "least_id")
    known = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    return (
        sketch.select("doc_id", "text_key", "n_shingles", "set_key").join(named_classes, "set_key", "left")
        .select(
            "doc_id", "text_key", "n_shingles", F.when(known, F.col("component")).alias("component"),
            F.when(known, F.col("least_id")).otherwise(F.col("doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def _free_name(name: str, taken: list[str]) -> str:
    while name in taken:
        name += "_"
    return name


def drop_near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, bands: int = 36, rows: int = 5
) -> DataFrame:
    """One document of each group of near duplicates, with all its columns: the smallest id, and
    of several texts of that id in the group one.

    Different texts of one id that are not near duplicates all stay. Of exactly repeated rows (id
    and text) one stays, empty texts included; rows without a doc_id all stay.
    """
    linked = _linked(docs, width, percent, bands, rows).where("doc_id IS NOT NULL")
    chosen = linked.where("component IS NOT NULL").groupBy("component").agg(
        F.min(F.struct("doc_id", "text_key")).alias("k")
    ).select("k.doc_id", "k.text_key")
    empty = linked.where("component IS NULL").select("doc_id", "text_key").distinct()
    kept = chosen.unionAll(empty)
    key = _free_name("text_key", docs.columns)
    marked = docs.withColumn(key, F.xxhash64("text"))
    same = (marked["doc_id"] == kept["doc_id"]) & (marked[key] == kept["text_key"])
    named = marked.join(kept, same, "left_semi").dropDuplicates(["doc_id", key]).drop(key)
    return named.unionAll(docs.where(docs["doc_id"].isNull()))


def op10_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: 3-word shingles, similarity 0.85."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs, width=3, percent=85, bands=25, rows=5)
