"""Merkle manifest of a dataset: one ternary hash tree per source and one over their roots.

A tree is cut into aligned blocks of ``arity ** height`` leaves; block roots are the leaves of the
next layer, so no task ever holds more than a block and the number of layers is logarithmic.
A block is stored as one array in van Emde Boas order: a tree of h levels is its top half of
the levels, followed by the trees that hang below it, each laid out in the same way. Positions
follow from arithmetic alone; construction and the lookup of siblings use the same positions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfcast.llm.numbering import number_rows
from shelfcast.session import cut_lineage

ARITY = 3
HEIGHT = 6  # levels above the leaves of a full block: 729 leaves
_DIGEST = 32
_SHIFT = 33  # as in monotonically_increasing_id()

_BLOCK = "tree string, block long, n int, nodes binary, root string"
_STEPS = "array<struct<at:int,others:string>>"
_STEP_TYPE = pa.list_(pa.struct([("at", pa.int32()), ("others", pa.string())]))


def levels_above(n: int) -> int:
    """Hashing rounds until one of n nodes is left."""
    rounds = 0
    while n > 1:
        n, rounds = -(-n // ARITY), rounds + 1
    return rounds


def tree_size(levels: int) -> int:
    """Nodes of a full tree with so many levels."""
    return (ARITY**levels - 1) // (ARITY - 1)


def layout_positions(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Places of the nodes ``index`` at ``depth`` (0: root) in the van Emde Boas order of a full tree."""
    at = np.zeros(len(index), dtype=np.int64)
    while levels > 1:
        upper = levels // 2
        if depth < upper:
            levels = upper
            continue
        lower, depth = levels - upper, depth - upper
        subtree, index = np.divmod(index, ARITY**depth)
        at += tree_size(upper) + subtree * tree_size(lower)
        levels = lower
    return at


@cache
def _positions(rounds: int) -> list[list[int]]:
    """Places by height above the leaves, for the full tree with ``rounds`` levels above its leaves."""
    return [
        layout_positions(rounds + 1, rounds - h, np.arange(ARITY ** (rounds - h))).tolist()
        for h in range(rounds + 1)
    ]


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _rounds(block: int, n: int, height: int) -> int:
    """Later blocks of a tree are full height; block 0 of a tree with more leaves is full anyway."""
    return height if block else levels_above(n)


def build_block(leaves: list[str], rounds: int) -> tuple[bytes, str]:
    """(array of digests in layout order, root); places without a node are zero."""
    at = _positions(rounds)
    nodes = bytearray(_DIGEST * tree_size(rounds + 1))
    level = leaves
    for h in range(rounds + 1):
        for i, value in enumerate(level):
            start = _DIGEST * at[h][i]
            nodes[start : start + _DIGEST] = bytes.fromhex(value)
        if h < rounds:
            level = [digest("".join(level[i : i + ARITY])) for i in range(0, len(level), ARITY)]
    return bytes(nodes), level[0]


def siblings(nodes: str, n: int, rounds: int, leaf: int) -> list[tuple[int, str]]:
    """(place in its run, digests of the others) of a leaf's ancestors below the block's root.

    ``nodes`` is the block's array in hexadecimal, n its number of leaves.
    """
    at, found = _positions(rounds), []
    for h in range(rounds):
        own = leaf % ARITY
        first = leaf - own
        run = range(first, min(first + ARITY, n))
        starts = [2 * _DIGEST * at[h][i] for i in run if i != leaf]
        found.append((own, "".join(nodes[s : s + 2 * _DIGEST] for s in starts)))
        leaf, n = leaf // ARITY, -(-n // ARITY)
    return found


def fold(leaf: str, path: list[tuple[int, str]]) -> str:
    """The root that follows from a leaf and its siblings, bottom up."""
    for own, others in path:
        cut = 2 * _DIGEST * own
        leaf = digest(others[:cut] + leaf + others[cut:])
    return leaf


def leaf_digest(columns: list[Column]) -> Column:
    """Digest of the values, each as byte count, colon and value, or a dash for null."""
    parts = []
    for c in columns:
        value = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def place_in_tree(rows: DataFrame, *order: str) -> DataFrame:
    """The rows with ``place`` (from 0) within their ``tree`` in the given order, nulls first.

    Rows are range-partitioned by tree and order and written once, so a large tree is spread over
    many tasks. A place is the row's place in its partition, moved by one number per partition and tree.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ("tree", *order, "_tie")
    placed = cut_lineage(
        rows.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("_tie")
        .withColumn("_id", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_id", _SHIFT))
    runs = placed.groupBy("_part", "tree").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    moved = runs.select(
        F.col("_part").alias("p"), F.col("tree").alias("t"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_move"),
    )
    joined = placed.join(moved, (F.col("_part") == F.col("p")) & F.col("tree").eqNullSafe(F.col("t")))
    return joined.withColumn("place", F.col("_id") + F.col("_move")).drop("_id", "_part", "p", "t", "_move")


def _gathered(leaves: DataFrame, height: int, payload: tuple[str, ...]) -> DataFrame:
    """(tree, block, members): at most ``ARITY ** height`` leaves a row, in order."""
    member = F.struct("place", "digest", *payload)
    block = F.expr(f"place div {ARITY**height}").alias("block")
    return leaves.groupBy("tree", block).agg(F.array_sort(F.collect_list(member)).alias("members"))


def _builder(height: int, payload: tuple[str, ...]):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members, blocks = batch.column("members"), batch.column("block").to_pylist()
            sizes = members.value_lengths().to_pylist()
            digests = members.flatten().field("digest").to_pylist()
            nodes, roots, start = [], [], 0
            for block, n in zip(blocks, sizes):
                array, root = build_block(digests[start : start + n], _rounds(block, n, height))
                nodes.append(array)
                roots.append(root)
                start += n
            columns = [
                batch.column("tree"), batch.column("block"), pa.array(sizes, pa.int32()),
                pa.array(nodes, pa.binary()), pa.array(roots, pa.string()),
            ]
            names = ["tree", "block", "n", "nodes", "root"]
            if payload:
                columns.append(members)
                names.append("members")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return build


def _finished(height: int) -> Column:
    """Block 0 with room left is the whole tree; a full one gets a layer above it."""
    return (F.col("block") == 0) & (F.col("n") < ARITY**height)


def build_layers(leaves: DataFrame, height: int, *payload: str) -> list[DataFrame]:
    """Block tables, leaves first: (tree, block, n, nodes, root), each written once.

    ``leaves`` has (tree, place, digest); the first table keeps ``payload`` columns of the leaves
    in ``members``. Every tree ends in exactly one finished block, in one of the layers.
    """
    layers: list[DataFrame] = []
    while True:
        carried = () if layers else payload
        gathered = _gathered(leaves, height, carried)
        schema = _BLOCK
        if carried:
            schema += f", members {gathered.schema['members'].dataType.simpleString()}"
        layers.append(cut_lineage(gathered.mapInArrow(_builder(height, carried), schema)))
        above = layers[-1].where(~_finished(height))
        if above.isEmpty():
            return layers
        leaves = above.select("tree", F.col("block").alias("place"), F.col("root").alias("digest"))


def tree_roots(layers: list[DataFrame], height: int) -> DataFrame:
    """(tree, root) of every tree."""
    found = [layer.where(_finished(height)).select("tree", "root") for layer in layers]
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out


def _with_upper(layer: DataFrame, above: DataFrame | None, roots: DataFrame | None, height: int) -> DataFrame:
    """The blocks with ``path``, the siblings from the block's root up, and ``subroot`` of their tree."""
    done = layer.where(_finished(height))
    if roots is None:
        done = done.select("*", F.expr(f"CAST(array() AS {_STEPS}) AS path"), F.col("root").alias("subroot"))
    else:
        of_tree = roots.select(F.col("tree").alias("t"), "path", "subroot")
        done = done.join(of_tree, F.col("tree").eqNullSafe(F.col("t"))).drop("t")
    if above is None:
        return done
    of_block = above.select(F.col("tree").alias("t"), F.col("place").alias("b"), "path", "subroot")
    lower = layer.where(~_finished(height)).join(
        of_block, F.col("tree").eqNullSafe(F.col("t")) & (F.col("block") == F.col("b"))
    )
    return done.unionByName(lower.drop("t", "b"))


def _blocks(batch: pa.RecordBatch, height: int) -> Iterator[tuple]:
    """(row, block, n, rounds, nodes in hexadecimal, path above) of each block."""
    columns = (batch.column(c) for c in ("block", "n", "nodes", "path"))
    for row, (block, n, nodes, path) in enumerate(zip(*columns)):
        upper = [(step["at"], step["others"]) for step in path.as_py()]
        block, n = block.as_py(), n.as_py()
        yield row, block, n, _rounds(block, n, height), nodes.as_py().hex(), upper


def _climber(height: int):
    width = ARITY**height

    def climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, block, n, rounds, nodes, upper in _blocks(batch, height):
                paths = [siblings(nodes, n, rounds, i) + upper for i in range(n)]
                steps = [[{"at": at, "others": others} for at, others in path] for path in paths]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([batch.column("tree").slice(row, 1)] * n),
                        pa.array(range(block * width, block * width + n), pa.int64()),
                        pa.array(steps, _STEP_TYPE),
                        pa.concat_arrays([batch.column("subroot").slice(row, 1)] * n),
                    ],
                    names=["tree", "place", "path", "subroot"],
                )

    return climb


def upper_paths(layers: list[DataFrame], height: int, roots: DataFrame | None = None) -> DataFrame:
    """The lowest layer's blocks with ``path`` and ``subroot``, worked out from the top layer down.

    ``roots`` has (tree, path, subroot) of what lies above the trees; only the one finished block
    of a tree meets it, so a large tree is no hot key.
    """
    schema = f"tree string, place long, path {_STEPS}, subroot string"
    above = None
    for layer in reversed(layers[1:]):
        above = cut_lineage(_with_upper(layer, above, roots, height).mapInArrow(_climber(height), schema))
    return _with_upper(layers[0], above, roots, height)


def _prover(height: int):
    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = ("doc_id", "digest", "tampered")
        for batch in batches:
            for row, _, n, rounds, nodes, upper in _blocks(batch, height):
                inside = batch.column("members").slice(row, 1).flatten()
                ids, leaves, offered = (inside.field(name) for name in fields)
                paths = [siblings(nodes, n, rounds, i) + upper for i in range(n)]
                folded = [fold(leaf, path) for leaf, path in zip(offered.to_pylist(), paths)]
                proofs = [digest("".join(others for _, others in path)) for path in paths]
                root = fold(batch.column("root")[row].as_py(), upper)
                subroot = batch.column("subroot")[row].as_py()
                yield pa.RecordBatch.from_arrays(
                    [
                        ids, leaves, pa.array([subroot] * n), pa.array([root] * n),
                        pa.array(proofs), pa.array(folded), pa.array([x == root for x in folded]),
                    ],
                    names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
                )

    return prove


_PROOF = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
    "folded_root string, verified boolean"
)


def _root_paths(layers: list[DataFrame], height: int) -> DataFrame:
    """(tree, path, subroot) by source: the tree over the roots, sources in order of their UTF-8 bytes."""
    roots = tree_roots(layers, height).select(
        F.lit("").alias("tree"), F.col("tree").alias("source"), F.col("root").alias("digest")
    )
    ordered = cut_lineage(place_in_tree(roots, "source"))
    top = build_layers(ordered.select("tree", "place", "digest"), height)
    paths = upper_paths(top, height).mapInArrow(_climber(height), f"tree string, place long, path {_STEPS}, subroot string")
    return cut_lineage(
        paths.select("place", "path").join(ordered.select("place", "source", "digest"), "place")
        .select(F.col("source").alias("tree"), "path", F.col("digest").alias("subroot"))
    )


def prove_rows(rows: DataFrame, height: int = HEIGHT) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of each row.

    ``rows`` has (tree, doc_id, digest, tampered): the leaf's digest and the one that is offered
    against the manifest; blocks have ``height`` levels above their leaves. Trees may be null. Leaves ascend by doc_id, a null one first; equal ids
    by digest, then as stored. Repeated rows are leaves of their own. Calling this builds the manifest.
    """
    placed = place_in_tree(rows, "doc_id", "digest")
    layers = build_layers(placed, height, "doc_id", "tampered")
    return upper_paths(layers, height, _root_paths(layers, height)).mapInArrow(_prover(height), _PROOF)


def tampered_leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, digest, tampered) of documents, a tree per source.

    A leaf covers doc_id, source, lang, n_chars and text, nulls apart from empty values. Where the
    id's CRC is even, the row is offered with the line feeds of its text taken out.
    """
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    cut = leaf_digest([*fields, F.replace("text", F.lit("\n"), F.lit(""))])
    hit = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.contains("text", F.lit("\n"))
    leaves = docs.select(
        F.col("source").alias("tree"), "doc_id", leaf_digest([*fields, F.col("text")]).alias("digest"),
        F.when(hit, cut).alias("tampered"),
    )
    return leaves.withColumn("tampered", F.coalesce("tampered", "digest"))


def op11_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """Proofs of all documents; rows whose id has an even CRC are offered without line feeds."""
    return prove_rows(cut_lineage(tampered_leaves(spark.read.parquet(f"{sf_dir}/documents.parquet"))))


def op11_sql(rounds: int = 14) -> str:
    """The same rows in DuckDB, one step per level; holds for up to 3**rounds rows and sources."""
    fields = ["doc_id", "source", "lang", "n_chars"]

    def leaf(text: str) -> str:
        parts = [f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in fields + [text]]
        return f"sha256({' || '.join(parts)})"

    def climb(name: str, start: str) -> str:
        """Levels name0 .. of (tree, i, d); runs hold the digests of a run as a list."""
        steps = [f"{name}0 AS MATERIALIZED ({start})"]
        for k in range(rounds):
            steps.append(f"""{name}_runs{k} AS MATERIALIZED (
  SELECT tree, i // 3 AS i, list(d ORDER BY i) AS run FROM {name}{k} GROUP BY tree, i // 3
), {name}{k + 1} AS MATERIALIZED (
  SELECT r.tree, i, CASE WHEN n = 1 THEN run[1] ELSE sha256(array_to_string(run, '')) END AS d
  FROM {name}_runs{k} r JOIN (SELECT tree, count(*) AS n FROM {name}{k} GROUP BY tree) s ON r.tree IS NOT DISTINCT FROM s.tree
)""")
        return ", ".join(steps)

    def follow(name: str, path: str, start: str) -> str:
        """Siblings and folded digest of each row (rid, tree, i, proof, f) up the levels of name."""
        steps = [f"{path}0 AS MATERIALIZED ({start})"]
        for k in range(rounds):
            steps.append(f"""{path}{k + 1} AS MATERIALIZED (
  SELECT p.rid, p.tree, p.i // 3 AS i,
    CASE WHEN n = 1 THEN proof ELSE proof || array_to_string(list_concat(run[:p.i % 3], run[p.i % 3 + 2:]), '') END AS proof,
    CASE WHEN n = 1 THEN f ELSE sha256(array_to_string(run[:p.i % 3], '') || f || array_to_string(run[p.i % 3 + 2:], '')) END AS f
  FROM {path}{k} p JOIN {name}_runs{k} r ON r.tree IS NOT DISTINCT FROM p.tree AND r.i = p.i // 3
  JOIN (SELECT tree, count(*) AS n FROM {name}{k} GROUP BY tree) s ON s.tree IS NOT DISTINCT FROM p.tree
)""")
        return ", ".join(steps)

    return f"""
WITH RECURSIVE bits AS (
  SELECT i::BIGINT AS i, i::BIGINT AS c, 0 AS k FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8
), leaves AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, source, {leaf("text")} AS leaf, {leaf("replace(text, chr(10), '')")} AS cut,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
        regexp_extract_all(hex(encode(doc_id::VARCHAR)), '..'), lambda b: ('0x' || b)::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 2 = 0 AS hit
  FROM documents, crc
), placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves
), {climb("a", "SELECT source AS tree, i, leaf AS d FROM placed")}, sources AS MATERIALIZED (
  SELECT tree AS source, d AS subroot, row_number() OVER (ORDER BY encode(tree) NULLS FIRST) - 1 AS i FROM a{rounds}
), {climb("b", "SELECT 0 AS tree, i, subroot AS d FROM sources")}, {follow(
    "a", "p", "SELECT rid, source AS tree, i, '' AS proof, CASE WHEN hit THEN cut ELSE leaf END AS f FROM placed"
)}, {follow("b", "q", f"SELECT rid, 0 AS tree, s.i, proof, f FROM p{rounds} JOIN sources s ON s.source IS NOT DISTINCT FROM tree")}
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f AS folded_root, f = root AS verified
FROM placed JOIN q{rounds} q USING (rid) JOIN sources s ON s.source IS NOT DISTINCT FROM placed.source
CROSS JOIN (SELECT d AS root FROM b{rounds})
"""
