"""Document fingerprints by a randomised edit embedding.

A text is read by a random walk shared by all documents: at step j the walk shows what is at
its pointer, and a coin that depends on j and on the character there decides whether the
pointer moves on. After an edit two walks fall into step again, so a few edits change a few
steps, and edit distance becomes Hamming distance between the walks. A walk goes through the
whole text, many texts side by side.

A fingerprint samples ``SLOTS`` steps of the walk. A slot has one random sequence of steps for
all documents, and samples the last of them that lies within the walk: that is a uniform step
of a text of any length, and texts of nearly the same length sample nearly the same steps. The
share of slots that agree estimates the Hamming likeness. Bands of slots give candidate pairs.

Walks that restart every ``BLOCK`` characters (``fingerprint_bytes``, the same for texts up to
``BLOCK``) lose what an earlier insertion or deletion has shifted; no query uses them. Candidates
are compared by samples, then confirmed on every step of both walks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from shelfcast.llm import words as wh
from shelfcast.llm.graph import components
from shelfcast.llm.near_dedup import STAR_ROUNDS, _star_edges, _untested
from shelfcast.session import cut_lineage

SLOTS = 128
BLOCK = 4096  # characters
STEPS = 2 * BLOCK  # a walk moves on every other step on average
GRAM = 4  # characters that a step shows
BANDS = 32
BAND_SLOTS = SLOTS // BANDS
_SEED = 20240229
_GROUP = 1024  # blocks walked side by side
_FAR = np.int64(1) << 40
_SLICE = 256  # steps of unbroken walks taken at a time, a divisor of STEPS
_ALONE = 32  # longest texts that are walked one by one, as few others go as far side by side
#: Members of a bucket that one task of the exact round compares with as many others.
CHUNK = 4096
#: Standard deviations below the threshold at which samples are still confirmed on full walks.
REACH = 5.0
_PAIRS = 2048  # pairs confirmed at a time

_PAIRED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, part int, role string, text string"
)
RESULT = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def _slot_steps() -> np.ndarray:
    """Ascending steps of each slot (row), filled up with _FAR. The next step is the last one
    divided by a uniform number, so the last one below any bound is uniform below it."""
    draw = np.random.default_rng(_SEED)
    step = np.zeros(SLOTS, dtype=np.int64)
    columns = [step]
    while (step < _FAR).any():
        grown = np.floor((step + 1) / np.maximum(draw.random(SLOTS), 1e-12)).astype(np.int64)
        step = np.minimum(np.maximum(grown, step + 1), _FAR)
        columns.append(step)
    return np.stack(columns, axis=1)


_STEPS_OF_SLOT = _slot_steps()
_COINS = np.random.default_rng(_SEED + 1).integers(0, 2, (STEPS, 256), dtype=np.uint8)


def sampled_steps(n_chars: np.ndarray) -> np.ndarray:
    """(texts, SLOTS) sampled steps; -1 for an empty text."""
    reach = 2 * n_chars
    out = np.empty((len(n_chars), SLOTS), dtype=np.int64)
    for slot, steps in enumerate(_STEPS_OF_SLOT):
        at = np.searchsorted(steps, reach) - 1
        out[:, slot] = np.where(at >= 0, steps[at], -1)
    return out


def fingerprint_bytes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(characters, (texts, SLOTS) sampled bytes) of whole texts, by walks that restart."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(sizes)
    shown = _grams(code, ends)
    coin_class = (wh.mix(code.astype(np.uint64), 3) & np.uint64(255)).astype(np.uint8)
    steps = sampled_steps(sizes)
    text = np.repeat(np.arange(len(texts)), SLOTS).reshape(steps.shape)
    block_start = (ends - sizes)[text] + np.maximum(steps, 0) // STEPS * BLOCK
    block, which = np.unique(block_start[steps >= 0], return_inverse=True)
    length = np.minimum(BLOCK, ends[np.searchsorted(ends, block, "right")] - block) if len(block) else block
    # Blocks of similar length are walked together.
    by_length = np.argsort(length)
    place = np.empty(len(block), dtype=np.int64)
    place[by_length] = np.arange(len(block))
    block, length, which = block[by_length], length[by_length], place[which]
    out = np.zeros(steps.shape, dtype=np.uint8)
    sampled = np.zeros(len(which), dtype=np.uint8)
    within = steps[steps >= 0] % STEPS
    by_block = np.argsort(which, kind="stable")
    edges = np.searchsorted(which[by_block], np.arange(0, len(block) + _GROUP, _GROUP))
    for k, low in enumerate(range(0, len(block), _GROUP)):
        group = slice(low, low + _GROUP)
        reached = _walk(coin_class, block[group], length[group])
        mine = by_block[edges[k] : edges[k + 1]]
        at = reached[within[mine], which[mine] - low]
        inside = at < (block + length)[which[mine]]
        sampled[mine] = np.where(inside, shown[np.minimum(at, len(code) - 1)], 0)
    out[steps >= 0] = sampled
    return sizes, out


def _grams(code: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A byte (1 to 255) for the GRAM characters from each place, not beyond the text's end."""
    left = np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(len(code))
    padded = np.concatenate([code, np.zeros(GRAM, dtype=np.uint32)]).astype(np.uint64)
    value = np.zeros(len(code), dtype=np.uint64)
    for k in range(GRAM):
        value = value * np.uint64(0x100000001B3) + np.where(left > k, padded[k : len(code) + k] + np.uint64(1), 0).astype(np.uint64)
    return (wh.mix(value, 4) % np.uint64(255)).astype(np.uint8) + np.uint8(1)


def _walk(coin_class: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """(steps, blocks) places of the pointers; one that is through its block stays at its end."""
    at, end = start.astype(np.int32), (start + length).astype(np.int32)
    out = np.empty((2 * int(length.max()), len(start)), dtype=np.int32)
    classes, moved = np.empty(len(start), dtype=np.uint8), np.empty(len(start), dtype=np.uint8)
    for step in range(len(out)):
        out[step] = at
        np.take(coin_class, at, out=classes, mode="clip")
        np.take(_COINS[step], classes, out=moved, mode="clip")
        np.add(at, moved, out=at)
        np.minimum(at, end, out=at)
    return out


def _prepared(texts: list[str]) -> tuple[np.ndarray, ...]:
    """(characters per text, their ends, byte shown at each place, coin class of each place)."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(sizes)
    coin_class = (wh.mix(code.astype(np.uint64), 3) & np.uint64(255)).astype(np.uint8)
    return sizes, ends, _grams(code, ends), coin_class


@lru_cache(maxsize=4096)
def _salt(turn: int) -> int:
    return int(wh.mix(np.array([turn], dtype=np.uint64), 7)[0]) & 255 if turn else 0


@lru_cache(maxsize=32)
def _salted_coins(salt: int) -> list[bytes]:
    return [row.tobytes() for row in _COINS[:, np.arange(256) ^ salt]]


def _places_alone(classes: bytes, steps: list[int]) -> list[int]:
    """Places of the unbroken walk of one text at ascending steps."""
    out, at, now = [], 0, 0
    for step in steps:
        while now < step and at < len(classes):
            turn, row = divmod(now, STEPS)
            coins, until = _salted_coins(_salt(turn)), min(step, (turn + 1) * STEPS)
            try:
                for moves in coins[row : until - turn * STEPS]:
                    at += moves[classes[at]]
            except IndexError:  # through the text
                break
            now = until
        out.append(at)
    return out


def _unbroken(coin_class: np.ndarray, start: np.ndarray, length: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(first step, (_SLICE, texts) places) until every walk is through. Lengths fall, and a
    slice holds the texts whose walks reach it. Coins of later rounds of STEPS are permuted."""
    at, end = start.astype(np.int32), (start + length).astype(np.int32)
    for first in range(0, 2 * int(length.max(initial=0)), _SLICE):
        live = int(np.searchsorted(-2 * length, -first))
        at, end = at[:live], end[:live]
        turn, row = divmod(first, STEPS)
        coins = _COINS[row : row + _SLICE, np.arange(256) ^ _salt(turn)]
        out = np.empty((_SLICE, live), dtype=np.int32)
        classes, moved = np.empty(live, dtype=np.uint8), np.empty(live, dtype=np.uint8)
        for step in range(_SLICE):
            out[step] = at
            np.take(coin_class, at, out=classes, mode="clip")
            np.take(coins[step], classes, out=moved, mode="clip")
            np.add(at, moved, out=at)
            np.minimum(at, end, out=at)
        yield first, out


def unbroken_bytes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """As fingerprint_bytes, of walks that do not restart."""
    sizes, ends, shown, coin_class = _prepared(texts)
    steps = sampled_steps(sizes)
    out = np.zeros(steps.shape, dtype=np.uint8)
    by_length = np.argsort(-sizes, kind="stable")
    for text in by_length[:_ALONE].tolist():
        if sizes[text]:
            low, high = int(ends[text] - sizes[text]), int(ends[text])
            order = np.argsort(steps[text], kind="stable")
            at = np.array(_places_alone(coin_class[low:high].tobytes(), steps[text][order].tolist())) + low
            out[text, order] = np.where(at < high, shown[np.minimum(at, high - 1)], 0)
    for low in range(_ALONE, len(texts), _GROUP):
        group = by_length[low : low + _GROUP]
        group = group[sizes[group] > 0]
        wanted = steps[group].reshape(-1)
        order = np.argsort(wanted, kind="stable")
        edges = np.searchsorted(wanted[order], np.arange(0, 2 * int(sizes[group].max(initial=0)) + _SLICE, _SLICE))
        found = np.zeros(len(wanted), dtype=np.uint8)
        for first, places in _unbroken(coin_class, (ends - sizes)[group], sizes[group]):
            k = first // _SLICE
            mine = order[edges[k] : edges[k + 1]]
            at = places[wanted[mine] - first, mine // SLOTS]
            found[mine] = np.where(at < ends[group][mine // SLOTS], shown[np.minimum(at, len(shown) - 1)], 0)
        out[group] = found.reshape(-1, SLOTS)
    return sizes, out


def walk_likeness(texts: list[str], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Share of steps at which the unbroken walks of texts[left] and texts[right] show the same,
    of the steps of the longer one; 1 for equal texts."""
    sizes, ends, shown, coin_class = _prepared(texts)
    by_length = np.argsort(-sizes, kind="stable")
    place = np.empty(len(texts), dtype=np.int64)
    place[by_length] = np.arange(len(texts))
    a, b = place[left], place[right]
    common, most = 2 * np.minimum(sizes[left], sizes[right]), 2 * np.maximum(sizes[left], sizes[right])
    equal = np.zeros(len(left), dtype=np.int64)
    end = ends[by_length]
    for first, places in _unbroken(coin_class, (ends - sizes)[by_length], sizes[by_length]):
        reached = np.flatnonzero(common > first)
        if not len(reached):
            break
        seen = np.where(places < end[: places.shape[1]], shown[np.minimum(places, len(shown) - 1)], np.uint8(0)).T
        same = seen[a[reached]] == seen[b[reached]]
        same &= np.arange(_SLICE) < (common[reached] - first)[:, None]
        equal[reached] += same.sum(axis=1)
    return np.where(most > 0, equal / np.maximum(most, 1), 1.0)


def encode(n_chars: int, sampled: np.ndarray) -> str:
    """The number of characters and the sampled bytes, in hexadecimal digits."""
    return f"{n_chars:010x}{sampled.tobytes().hex()}"


def decode(fingerprints: list[str]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([int(f[:10], 16) for f in fingerprints], dtype=np.int64)
    sampled = np.frombuffer(bytes.fromhex("".join(f[10:] for f in fingerprints)), np.uint8)
    return sizes, sampled.reshape(len(fingerprints), SLOTS)


def likeness(n_a, bytes_a, n_b, bytes_b) -> np.ndarray:
    """Share of slots that sample the same step and show the same there; 1 for equal texts."""
    same_step = sampled_steps(n_a) == sampled_steps(n_b)
    return ((bytes_a == bytes_b) & same_step).mean(axis=1)


def edited_text(text: str, following: str) -> str:
    """The last quarter (rounded down) replaced by as much of the start of another text."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def _compared(rows: list[tuple], following: list[tuple]) -> dict[str, list]:
    """Result columns of rows (doc_id, text, n, bytes), each with the row that follows it."""
    edited = [edited_text(a[1], b[1]) for a, b in zip(rows, following)]
    n, own = np.array([r[2] for r in rows]), np.array([r[3] for r in rows]).reshape(-1, SLOTS)
    n_next, other = np.array([r[2] for r in following]), np.array([r[3] for r in following]).reshape(-1, SLOTS)
    n_edited, changed = unbroken_bytes(edited)
    return {
        "doc_id": [r[0] for r in rows],
        "n_chars": n.tolist(),
        "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in edited],
        "fingerprint": [encode(k, b) for k, b in zip(n.tolist(), own)],
        "edited_fingerprint": [encode(k, b) for k, b in zip(n_edited.tolist(), changed)],
        "near_edited": likeness(n, own, n_edited, changed).tolist(),
        "near_next": likeness(n, own, n_next, other).tolist(),
    }


def _batch(columns: dict[str, list], part: int, role: str, texts=None) -> pa.RecordBatch:
    n = len(columns["doc_id"])
    columns = columns | {"part": [part] * n, "role": [role] * n, "text": texts or [None] * n}
    kinds = {"doc_id": pa.int64(), "n_chars": pa.int64(), "near_edited": pa.float64(), "near_next": pa.float64(), "part": pa.int32()}
    return pa.RecordBatch.from_arrays(
        [pa.array(v, kinds.get(c, pa.string())) for c, v in columns.items()], names=list(columns)
    )


def _alone(row: tuple) -> dict[str, list]:
    """Columns of a row whose following text is in another partition."""
    columns = dict.fromkeys(RESULT, [None])
    return columns | {"doc_id": [row[0]], "n_chars": [row[2]], "fingerprint": [encode(row[2], row[3])]}


def _pair_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare each row of a sorted partition with the next one. The partition's first row is
    also sent as ``head`` and its last one as ``tail``, with their texts."""
    last, part = None, 0
    for batch in batches:
        for piece in wh.slices(batch):
            part = piece.column("part")[0].as_py()
            texts = [t or "" for t in piece.column("text").to_pylist()]
            rows = list(zip(piece.column("doc_id").to_pylist(), texts, *(x.tolist() if x.ndim == 1 else x for x in unbroken_bytes(texts))))
            if last is None:
                yield _batch(_alone(rows[0]), part, "head", [rows[0][1]])
            else:
                rows.insert(0, last)
            if len(rows) > 1:
                yield _batch(_compared(rows[:-1], rows[1:]), part, "done")
            last = rows[-1]
    if last is not None:
        yield _batch(_alone(last), part, "tail", [last[1]])


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows at the end of a partition, joined with the first row of the next one."""
    for batch in batches:
        for row in batch.to_pylist():
            n, own = decode([row["fingerprint"], row["next_fingerprint"]])
            columns = _compared(
                [(row["doc_id"], row["text"], int(n[0]), own[0])], [(None, row["next_text"], int(n[1]), own[1])]
            )
            done = _batch(columns, 0, "done")
            yield done.select(list(RESULT))


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """The columns RESULT, one row per input row, each compared with the next document.

    Documents are in the order of doc_id, a null first, rows with equal ids by a hash of the
    text; the last one is followed by the first. A null text counts as empty. Two empty texts
    have likeness 1, an empty and another text 0. Texts are moved once, to a range partition;
    the last row of each is compared with the first row of the next in a join of as many rows
    as there are partitions. Other columns of ``docs`` are ignored.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        docs.select("doc_id", "text", F.xxhash64("text").alias("tie")).repartitionByRange(parts, "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie").select("doc_id", "text", F.spark_partition_id().alias("part"))
    )
    rows = cut_lineage(ordered.mapInArrow(_pair_up, _PAIRED))
    heads = rows.where("role = 'head'").select(
        "part", F.col("text").alias("next_text"), F.col("fingerprint").alias("next_fingerprint")
    )
    # As many rows as partitions: the next part in order, the first one after the last.
    every = Window.orderBy("part")
    order = heads.select("part").select(
        "part", F.lead("part").over(every).alias("after"),
        F.first("part").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("first"),
    ).select("part", F.coalesce("after", "first").alias("next_part"))
    tails = (
        rows.where("role = 'tail'").join(order, "part")
        .join(heads.withColumnRenamed("part", "next_part"), "next_part")
        .select("doc_id", "text", "fingerprint", "next_text", "next_fingerprint")
    )
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*RESULT).schema)
    return rows.where("role = 'done'").select(*RESULT).unionAll(tails.mapInArrow(_finish, schema))


def _cells(n: np.ndarray, sampled: np.ndarray) -> np.ndarray:
    """Sampled step and byte of each slot as one number."""
    return sampled_steps(n) * 256 + sampled


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        n, sampled = decode(batch.column("fingerprint").to_pylist())
        cell = wh.mix(_cells(n, sampled).astype(np.uint64), 6)
        grouped = cell.reshape(len(n), BANDS, BAND_SLOTS) * wh.powers(wh._BASE, BAND_SLOTS + 1)[1:]
        keys = wh.mix(grouped.sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
        offsets = pa.array(np.arange(len(n) + 1, dtype=np.int32) * BANDS)
        yield pa.RecordBatch.from_arrays(
            [batch.column("rep"), pa.array(n), batch.column("fingerprint"),
             pa.ListArray.from_arrays(offsets, pa.array(keys.reshape(-1)))],
            names=["rep", "n", "fingerprint", "bands"],
        )


def _sampled_test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (decode(batch.column(c).to_pylist()) for c in ("print_a", "print_b"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(likeness(*a, *b))], names=["a", "b", "likeness"]
        )


def _walk_test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by ``a``, whose text is walked once per run of rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, _PAIRS):
            for piece in wh.slices(batch.slice(start, _PAIRS), "text_b"):
                a = piece.column("a").to_pylist()
                leads = np.array([k == 0 or x != a[k - 1] for k, x in enumerate(a)])
                hubs = piece.column("text_a").take(pa.array(np.flatnonzero(leads))).to_pylist()
                value = walk_likeness(
                    hubs + piece.column("text_b").to_pylist(), np.cumsum(leads) - 1, len(hubs) + np.arange(len(a))
                )
                yield pa.RecordBatch.from_arrays(
                    [piece.column("a"), piece.column("b"), pa.array(value)], names=["a", "b", "likeness"]
                )


def _chunk_search(kind: pa.DataType, bound: float, percent: float):
    def search(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        col = {c: table.column(c).to_numpy() for c in ("band", "i", "j", "chunk", "rep", "n", "component", "main")}
        bands = np.stack(table.column("bands").to_numpy())
        cells = _cells(*decode(table.column("fingerprint").to_pylist()))
        outside = col["component"] != col["main"]
        left = np.flatnonzero(col["chunk"] == col["i"][0])
        right = np.flatnonzero(col["chunk"] == col["j"][0])
        found = []
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
            p, q = np.nonzero(possible)
            for at in range(0, len(p), 10_000):
                a, b = x[p[at : at + 10_000]], right[q[at : at + 10_000]]
                near = (cells[a] == cells[b]).mean(axis=1) >= bound
                a, b = a[near], b[near]
                # A pair is taken in the first of the buckets that it shares.
                here = bands[a, (bands[a] == bands[b]).argmax(axis=1)] == col["band"][0]
                found += zip(col["rep"][a[here]].tolist(), col["rep"][b[here]].tolist())
        return pa.table({"a": pa.array([min(f) for f in found], kind), "b": pa.array([max(f) for f in found], kind)})

    return search


def _rest_edges(members: DataFrame, prints: DataFrame, tested: DataFrame, bound: float, percent: float) -> DataFrame:
    """Every pair of a bucket in different components whose samples may reach the threshold.
    Buckets of several components are compared in pairs of chunks, each a group of its own."""
    sizes = members.groupBy("band", "component").agg(F.count("*").alias("size"))
    hubs = sizes.groupBy("band").agg(
        F.max(F.struct("size", "component")).getField("component").alias("main"),
        F.count("*").alias("components"), F.ceil(F.sum("size") / CHUNK).cast("long").alias("chunks"),
    ).where("components > 1").select("band", "main", "chunks")
    blocks = (
        members.join(hubs, "band").withColumn("chunk", F.pmod(F.xxhash64("rep"), "chunks"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
        .select("band", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"),
                "chunk", "rep", "n", "component", "main")
    )
    kind = members.schema["rep"].dataType.simpleString()
    arrow = pa.string() if kind == "string" else pa.int64()
    pairs = blocks.join(prints.select("rep", "fingerprint", "bands"), "rep").groupBy("band", "i", "j").applyInArrow(
        _chunk_search(arrow, bound, percent), f"a {kind}, b {kind}"
    )
    return _untested(pairs, tested)


def _confirmed(edges: DataFrame, prints: DataFrame, texts: DataFrame | None, least: float, bound: float) -> DataFrame:
    """(a, b, likeness, linked) of candidate edges: by samples, and with ``texts`` those that
    reach ``bound`` on the whole walks."""
    kind = edges.schema["a"].dataType.simpleString()
    result = f"a {kind}, b {kind}, likeness double"
    one, two = (prints.select(F.col("rep").alias(c), F.col("fingerprint").alias(f"print_{c}")) for c in "ab")
    seen = cut_lineage(edges.join(one, "a").join(two, "b").mapInArrow(_sampled_test, result))
    if texts is None:
        return seen.withColumn("linked", F.col("likeness") >= least)
    left, right = (texts.select(F.col("rep").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab")
    pairs = seen.where(F.col("likeness") >= bound).select("a", "b").join(right, "b").join(left, "a")
    walked = pairs.select("a", "b", "text_a", "text_b").sortWithinPartitions("a").mapInArrow(_walk_test, result)
    return cut_lineage(
        walked.withColumn("linked", F.col("likeness") >= least)
        .unionAll(seen.where(F.col("likeness") < bound).withColumn("linked", F.lit(False)))
    )


def _link_search(classes: DataFrame, least: float, docs: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Links (a, b, likeness) between classes(rep, fingerprint) that share a band, and their
    components (node, component). ``docs(rep, text)`` has the texts to confirm links on.

    Members of a bucket are tried against hubs first; then all members of a bucket that are
    still in different components are compared. Links within a component may be left out.
    """
    kind = classes.schema["rep"].dataType.simpleString()
    prints = cut_lineage(
        classes.mapInArrow(_bands, f"rep {kind}, n bigint, fingerprint string, bands array<bigint>")
    )
    reps = prints.select("rep", "n", F.explode("bands").alias("band"))
    crowded = reps.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    shared = cut_lineage(reps.join(crowded, "band"))
    buckets = shared.join(shared.groupBy("rep").agg(F.sum("size").alias("crowd")), "rep").drop("size")
    texts, bound, percent = None, least, 0.0  # samples of texts of any lengths may agree
    if docs is not None:
        bound, percent = least - REACH * np.sqrt(least * (1 - least) / SLOTS), 100 * least
        involved = docs.join(buckets.select("rep").distinct(), "rep", "left_semi")
        texts = cut_lineage(involved.groupBy("rep").agg(F.min("text").alias("text")))
    tested, found = None, None
    members = buckets.withColumn("component", F.col("rep"))
    for turn in range(STAR_ROUNDS + 1):
        if turn < STAR_ROUNDS:
            edges = _star_edges(members, tested, turn, percent)
        else:
            edges = _rest_edges(members, prints, tested, bound, percent)
        fresh = _confirmed(edges, prints, texts, least, bound)
        tested = fresh if tested is None else tested.unionAll(fresh)
        if found is not None and fresh.where("linked").isEmpty():
            continue
        found = components(tested.where("linked").select("a", "b"))
        members = buckets.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
            "band", "rep", "n", "crowd", F.coalesce("component", "rep").alias("component")
        )
    return tested.where("linked").select("a", "b", "likeness"), found


def near_links(fingerprints: DataFrame, least: float = 0.8) -> DataFrame:
    """(a, b, likeness) links between fingerprints(doc_id, fingerprint) that share a band.

    Equal fingerprints are one class with its smallest id. Links connect every two classes that
    share a band and whose samples agree by ``least``, directly or over others.
    """
    classes = fingerprints.where("doc_id IS NOT NULL").groupBy("fingerprint").agg(F.min("doc_id").alias("rep"))
    return _link_search(classes.select("rep", "fingerprint"), least)[0]


def _unbroken_prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in wh.slices(batch):
            n, sampled = unbroken_bytes([t or "" for t in piece.column("text").to_pylist()])
            prints = pa.array([encode(k, b) for k, b in zip(n.tolist(), sampled)])
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("rep"), pa.array(n), prints],
                names=["doc_id", "rep", "n_chars", "fingerprint"],
            )


def edit_components(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """(doc_id, n_chars, component_id), one row per input row.

    Texts are linked if their unbroken walks agree in at least ``least`` of all steps;
    ``component_id`` is the smallest doc_id reachable over links, null if no row there has one.
    Equal texts are one class whatever their ids; a null text counts as empty. Other columns of
    ``docs`` are ignored.
    """
    text = F.coalesce("text", F.lit(""))
    source = docs.select("doc_id", text.alias("text"), F.substring(F.sha2(text, 256), 1, 32).alias("rep"))
    rows = cut_lineage(
        source.mapInArrow(_unbroken_prints, "doc_id long, rep string, n_chars long, fingerprint string")
    )
    classes = rows.groupBy("rep").agg(F.min("fingerprint").alias("fingerprint"), F.min("doc_id").alias("least_id"))
    _, found = _link_search(classes.select("rep", "fingerprint"), least, source.select("rep", "text"))
    members = cut_lineage(
        classes.select("rep", "least_id").join(found.withColumnRenamed("node", "rep"), "rep", "left")
        .select("rep", "least_id", F.coalesce("component", "rep").alias("component"))
    )
    named = members.groupBy("component").agg(F.min("least_id").alias("component_id"))
    ids = members.join(named, "component").select("rep", "component_id")
    return rows.select("doc_id", "n_chars", "rep").join(ids, "rep").select("doc_id", "n_chars", "component_id")


def op4_edit_fingerprint(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, compared."""
    return fingerprint_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op4_edit_components(spark, sf_dir: str) -> DataFrame:
    """Components of near copies among all documents."""
    return edit_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
