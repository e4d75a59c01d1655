"""Language-model scores by Katz backoff with Good-Turing discounts.

The model has the counts of all n-grams up to an order, discounted by their counts of counts.
What the discounts free in a context goes to the words not seen there, in proportion to the next
shorter context; the backoff weight is computed from the sums over the seen words, so every
context's distribution (with one class for all unknown words) adds up to one.

Documents are read once into chunks of word numbers. A chunk asks for each distinct n-gram once:
sorted keys are cut into bucket blocks, the tasks of a bucket add up the counts, and the answer is
an array in the order of the keys asked for, so it needs no keys. Each n-gram has one owner among
the chunks that hold it; owners add up the sums that backoff weights consist of, and the weights
come back by a join on the few contexts that some held-out text backs off from. No n-gram,
context or vocabulary is ever gathered: the driver sees counts of counts below a bound.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.llm import words as wh
from shelfcast.session import cut_lineage

_END = np.uint64(0x656E64)  # the token after the last word
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
_CHUNKS_PER_TASK = 20  # bits of a chunk's number within its task
_KEYS = 1 << 18  # keys that are mixed at a time
_RANGE = 1 << 61  # of key values that are sorted at a time

_CHUNK = "chunk long, n_tokens long, doc_ids array<long>, held array<boolean>, counts array<int>, vocab binary, tokens binary"
_ASKED = "bucket long, chunk long, gram int, n int, keys binary, counts binary, in_held binary"
_ANSWER = "bucket long, chunk long, gram int, n int, totals binary, owned binary, in_held binary"
_SCORED = (
    "chunk long, doc_ids array<long>, held array<boolean>, counts array<int>, known array<int>, base array<double>, "
    "direct array<double>, back_doc array<int>, back_at array<int>, back_times array<int>, needs array<long>, "
    "contexts array<long>, freed array<double>, lower array<double>"
)
_DOCS = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


@dataclass(frozen=True)
class KatzConfig:
    order: int = 2  # words in the longest n-gram
    folds: int = 7
    held_fold: int = 2  # documents of this fold are scored, but never learned from
    chunk_tokens: int = 1 << 22  # a chunk is closed once it has as many
    bucket_tokens: int = 1 << 21  # of the corpus per bucket of n-grams
    turing_upto: int = 5  # counts with a discount of their own; larger ones follow a fitted line
    fit_upto: int = 60  # largest count the line is fitted on


@dataclass(frozen=True)
class Discounts:
    """Share of each count that is kept: listed for small counts, then (1 + 1/r) ** power."""

    listed: tuple[float, ...]
    power: float

    def kept(self, counts: np.ndarray) -> np.ndarray:
        r = np.maximum(counts, 1)
        line = (1 + 1 / r) ** self.power
        listed = np.array([1.0, *self.listed])
        return np.where(r < len(listed), listed[np.minimum(r, len(listed) - 1)], line)

    def kept_column(self, r: Column) -> Column:
        out = F.pow(1 + 1 / r, F.lit(self.power))
        for count, kept in enumerate(self.listed, 1):
            out = F.when(r == count, F.lit(kept)).otherwise(out)
        return out


@dataclass(frozen=True)
class Model:
    """What every scoring task knows besides the counts of its own n-grams."""

    tokens: int  # of the training texts
    words: int  # distinct ones
    documents: int
    unknown: float  # probability of the class of unknown words
    discounts: tuple[Discounts, ...]  # by n-gram length


def fit_discounts(of_count: dict[int, int], config: KatzConfig) -> Discounts:
    """Good-Turing: r* / r = (r + 1) N(r + 1) / (r N(r)) for small r, on a fitted line beyond.

    The line is the usual log-log fit of averaged counts of counts; its slope is held below -1,
    so every discount is below one and no context is left without mass to back off with. A
    small count whose own ratio is not between 0 and 1 follows the line as well.
    """
    seen = sorted(r for r, n in of_count.items() if n and r <= config.fit_upto)
    slope = -2.0
    if len(seen) > 1:
        before = np.array([0, *seen[:-1]])
        after = np.array([*seen[1:], 2 * seen[-1] - before[-1]])
        height = np.array([of_count[r] for r in seen]) * 2 / (after - before)
        slope = float(np.clip(np.polyfit(np.log(seen), np.log(height), 1)[0], -3.0, -1.05))
    listed = []
    for r in range(1, config.turing_upto + 1):
        own = (r + 1) * of_count.get(r + 1, 0) / (r * of_count[r]) if of_count.get(r) else 0.0
        listed.append(own if 0 < own < 1 else (1 + 1 / r) ** (slope + 1))
    return Discounts(tuple(listed), slope + 1)


def pack(values: np.ndarray) -> bytes:
    """Little-endian integers byte plane by byte plane, compressed."""
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes, n: int, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = np.frombuffer(pa.decompress(data, n * size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, n).T).view(kind).ravel()


def pack_bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def unpack_bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def held_out(doc_id: Column, config: KatzConfig) -> Column:
    fold = F.crc32(doc_id.cast("string")) % config.folds
    return F.coalesce(fold == config.held_fold, F.lit(False))


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, an end token after each, and the token count of each text."""
    words = wh.split_words(texts)
    n = words.counts()
    out = np.full(len(words.hashes) + len(n), _END)
    out[np.arange(len(words.hashes)) + np.repeat(np.arange(len(n)), n)] = words.hashes
    return out, n + 1


def _lists(values: np.ndarray) -> pa.Array:
    """One row that holds all values as a list."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values))


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the keys in ascending order, and where each distinct key begins among them."""
    order = np.argsort(keys)
    ordered = keys[order]
    return order, np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct key, ascending, and the number of each key among them. Keys are
    sorted range by range: chunks are large, and a sort holds several times what it sorts."""
    at, number, done = [], np.empty(len(keys), dtype=np.int32), 0
    for low in range(0, 1 << 64, _RANGE):
        inside = keys >= np.uint64(low)
        inside &= keys <= np.uint64(low + _RANGE - 1)
        places = np.flatnonzero(inside)
        if len(places):
            order, starts = _groups(keys[places])
            first = np.zeros(len(order), dtype=np.int32)
            first[starts] = 1
            places = places[order]
            number[places] = np.cumsum(first, dtype=np.int32) + np.int32(done - 1)
            at.append(places[starts])
            done += len(starts)
    return _all_of(at, np.int64), number


def _mixed(context: np.ndarray | None, tokens: np.ndarray, n: int) -> np.ndarray:
    out = np.empty_like(tokens)
    for a in range(0, len(tokens), _KEYS):
        part = slice(a, a + _KEYS)
        out[part] = wh.mix(tokens[part] if context is None else context[part] * _SPREAD + tokens[part], n)
    return out


def _chunker(config: KatzConfig):
    def row(chunk: int, parts: list) -> pa.RecordBatch:
        ids, held, counts, tokens = zip(*parts)
        parts.clear()
        tokens = np.concatenate(tokens)
        at, place = _distinct(tokens)
        vocab, times = tokens[at], np.bincount(place)
        del tokens
        common = np.argsort(-times, kind="stable")  # frequent words get small numbers
        number = np.empty(len(vocab), dtype=np.uint32)
        number[common] = np.arange(len(vocab), dtype=np.uint32)
        ids = pa.concat_arrays(ids)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([chunk], pa.int64()), pa.array([len(place)], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                _lists(np.concatenate(held)), _lists(np.concatenate(counts).astype(np.int32)),
                pa.array([vocab[common].tobytes()], pa.binary()), pa.array([pack(number[place])], pa.binary()),
            ],
            names=["chunk", "n_tokens", "doc_ids", "held", "counts", "vocab", "tokens"],
        )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << _CHUNKS_PER_TASK
        parts, size, made = [], 0, 0
        for batch in batches:
            for piece in wh.slices(batch):
                tokens, counts = tokens_of(piece.column("text"))
                held = np.asarray(piece.column("held").to_numpy(zero_copy_only=False), dtype=bool)
                parts.append((piece.column("doc_id"), held, counts, tokens))
                size += len(tokens)
                if size >= config.chunk_tokens:
                    yield row(first + made, parts)
                    parts, size, made = [], 0, made + 1
        if parts:
            yield row(first + made, parts)

    return cut


@dataclass
class Chunk:
    """Tokens of a chunk's documents. What can be worked out again is not held: chunks are large."""

    tokens: np.ndarray
    counts: np.ndarray  # tokens of each document
    held: np.ndarray  # per document

    @classmethod
    def read(cls, counts: np.ndarray, held: np.ndarray, vocab: bytes, tokens: bytes) -> Chunk:
        number = unpack(tokens, int(counts.sum(dtype=np.int64)), np.uint32)
        return cls(np.frombuffer(vocab, np.uint64)[number], counts, held)

    def doc(self) -> np.ndarray:
        """Document of each token."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def heads(self) -> np.ndarray:
        """First token of each document."""
        return np.cumsum(self.counts, dtype=np.int64) - self.counts

    def keys(self, n: int, shorter: np.ndarray | None) -> tuple[np.ndarray, np.ndarray | None]:
        """(key of the n-gram that ends at each token, key of its context), from the keys of the
        n-grams one shorter; a single word has no context.

        A text is preceded by start marks, so that its first words have a context; a context's
        key is the key of the shorter n-gram that ends one token earlier.
        """
        if n == 1:
            return _mixed(None, self.tokens, 1), None
        context = np.empty_like(shorter)
        context[1:] = shorter[:-1]
        context[self.heads()] = wh.mix(np.array([n], dtype=np.uint64), 97)
        return _mixed(context, self.tokens, n), context


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[int, Chunk]]:
    for i in range(batch.num_rows):
        counts = batch.column("counts")[i].values.to_numpy()
        held = batch.column("held")[i].values.to_numpy(zero_copy_only=False).astype(bool)
        vocab, tokens = (batch.column(c)[i].as_py() for c in ("vocab", "tokens"))
        yield batch.column("chunk")[i].as_py(), Chunk.read(counts, held, vocab, tokens)


def _asker(order: int, buckets: int):
    """Blocks of sorted distinct keys, with training counts and a mark for those in held-out texts."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, chunk in _chunks(batch):
                held, key = np.repeat(chunk.held, chunk.counts), None
                for n in range(1, order + 1):
                    key = chunk.keys(n, key)[0]
                    by_key, first = _groups(key)
                    distinct = key[by_key[first]]
                    of_held = held[by_key]
                    del by_key
                    in_held = np.logical_or.reduceat(of_held, first)
                    times = np.diff(first, append=len(of_held)) - np.add.reduceat(of_held, first, dtype=np.int64)
                    times = times.astype(np.uint32)
                    del first, of_held
                    bucket = ((distinct >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
                    used, start = np.unique(bucket, return_index=True)
                    stop = np.append(start[1:], len(distinct))
                    cuts = list(zip(start, stop))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(used), pa.array(np.full(len(used), number)),
                            pa.array(np.full(len(used), n, np.int32)), pa.array((stop - start).astype(np.int32)),
                            pa.array([pack(np.diff(distinct[a:b], prepend=np.uint64(0))) for a, b in cuts], pa.binary()),
                            pa.array([pack(times[a:b]) for a, b in cuts], pa.binary()),
                            pa.array([pack_bits(in_held[a:b]) for a, b in cuts], pa.binary()),
                        ],
                        names=["bucket", "chunk", "gram", "n", "keys", "counts", "in_held"],
                    )

    return ask


def _add_up(blocks: pa.Table) -> pa.Table:
    """Totals of one bucket's n-grams in the order of each block, with the owner's mark."""
    out = {c: [] for c in ("totals", "owned", "in_held")}
    order = np.argsort(blocks.column("gram").to_numpy(), kind="stable")
    blocks = blocks.take(pa.array(order))
    gram, sizes = blocks.column("gram").to_numpy(), blocks.column("n").to_numpy()
    rows = {c: blocks.column(c).to_pylist() for c in ("keys", "counts", "in_held")}
    for n in np.unique(gram):
        at = np.flatnonzero(gram == n)
        keys = np.concatenate([np.cumsum(unpack(rows["keys"][i], sizes[i], np.uint64), dtype=np.uint64) for i in at])
        counts = np.concatenate([unpack(rows["counts"][i], sizes[i], np.uint32) for i in at])
        held = np.concatenate([unpack_bits(rows["in_held"][i], sizes[i]) for i in at])
        by_key = np.argsort(keys, kind="stable")
        is_first = np.ones(len(keys), dtype=bool)
        is_first[1:] = keys[by_key][1:] != keys[by_key][:-1]
        group = np.cumsum(is_first) - 1
        total, any_held, owner = np.empty(len(keys), np.uint64), np.empty(len(keys), bool), np.empty(len(keys), bool)
        total[by_key] = np.bincount(group, counts[by_key]).astype(np.uint64)[group]
        any_held[by_key] = (np.bincount(group, held[by_key]) > 0)[group]
        owner[by_key] = is_first
        owner &= total > 0
        ends = np.cumsum(sizes[at])
        for a, b in zip(ends - sizes[at], ends):
            out["totals"].append(pack(total[a:b]))
            out["owned"].append(pack_bits(owner[a:b]))
            out["in_held"].append(pack_bits(any_held[a:b]))
    answers = [pa.array(out[c], pa.binary()) for c in out]
    return pa.table([*(blocks.column(c) for c in ("bucket", "chunk", "gram", "n")), *answers],
                    names=["bucket", "chunk", "gram", "n", *out])


def _histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, r, n): n-grams with training count r, each counted at its owner."""
    for batch in batches:
        gram, sizes = batch.column("gram").to_numpy(), batch.column("n").to_numpy()
        totals, owned = batch.column("totals").to_pylist(), batch.column("owned").to_pylist()
        for n in np.unique(gram):
            kept = [
                unpack(totals[i], sizes[i], np.uint64)[unpack_bits(owned[i], sizes[i])]
                for i in np.flatnonzero(gram == n)
            ]
            r, times = np.unique(np.concatenate(kept), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(r), n, np.int32)), pa.array(r.astype(np.int64)), pa.array(times.astype(np.int64))],
                names=["gram", "r", "n"],
            )


def _all_of(parts: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *(part.astype(kind) for part in parts)])


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys and the sums of the values by key."""
    at, place = _distinct(keys)
    return keys[at], *(np.bincount(place, v, len(at)) for v in values)


def _scorer(model: Model, order: int):
    """What a chunk knows of its texts once its n-grams have their counts.

    The highest order whose n-gram is known gives a token's probability; each longer context
    that is known itself adds its backoff weight, which is left open as (document, place in
    ``needs``, times). Owned n-grams add to what their context frees and to the lower-order
    probability of its seen words, for contexts that occur in held-out texts.
    """

    def score(chunks: pa.Table, answers: pa.Table) -> pa.Table:
        batch = chunks.combine_chunks().to_batches()[0]
        number, chunk = next(_chunks(batch))
        order_of = np.lexsort([answers.column("bucket").to_numpy(), answers.column("gram").to_numpy()])
        answers = answers.take(pa.array(order_of))
        gram, sizes = answers.column("gram").to_numpy(), answers.column("n").to_numpy()
        n_docs, size = len(chunk.counts), len(chunk.tokens)
        prob = np.full(size, model.unknown)
        is_head = np.zeros(size, dtype=bool)
        is_head[chunk.heads()] = True
        key = before = None  # before: of the n-grams one shorter, by distinct n-gram, and which one ends at each token
        open_at, open_key = [], []
        contexts, freed, lowers = [], [], []
        for n in range(1, order + 1):
            key, context = chunk.keys(n, key)
            at, place = _distinct(key)
            if n > 1:
                context = context[at]
            if n == order:
                key = None
            rows = answers.slice(int(np.searchsorted(gram, n)), int((gram == n).sum()))
            packed = [rows.column(c).to_pylist() for c in ("totals", "owned", "in_held")]
            of = rows.column("n").to_numpy()
            total = np.concatenate([unpack(x, k, np.uint64) for x, k in zip(packed[0], of)]).astype(np.int64)
            owned, wanted = (
                np.concatenate([unpack_bits(x, k) for x, k in zip(packed[j], of)]) for j in (1, 2)
            )
            # Worked out by distinct n-gram, not by token: an n-gram's key has its context in it.
            kept = model.discounts[n - 1].kept(total)
            if n == 1:
                whole = max(model.tokens, 1)
                doc = chunk.doc()
                known = np.bincount(doc, (total > 0)[place], n_docs).astype(np.int32)
                base = np.log10((total + 1) / (model.tokens + model.words + 1))
                base = np.bincount(doc, base[place], n_docs)
                del doc
            else:
                total_before, wanted_before, own_before, place_before = before
                head, earlier = is_head[at], place_before[np.maximum(at - 1, 0)]
                whole = np.where(head, model.documents, total_before[earlier])
                open_at.append(np.flatnonzero(((total == 0) & (whole > 0))[place]))
                open_key.append(context[place[open_at[-1]]])
                mine = np.flatnonzero(owned & (head | wanted_before[earlier]))
                mass = (1 - kept[mine]) * total[mine] / whole[mine]
                lower = own_before[place_before[at[mine]]]
                context = context[mine]
                del head, earlier, mine, total_before, wanted_before, own_before, place_before, before
            del at
            own = np.multiply(kept, total, out=kept)
            own /= np.maximum(whole, 1)
            del kept, whole
            seen = total > 0
            for a in range(0, size, _KEYS):
                part = place[a : a + _KEYS]
                np.copyto(prob[a : a + _KEYS], own[part], where=seen[part])
            before = total, wanted, own, place
            del total, wanted, own, place, owned, seen
            if n == order:
                del before
            if n > 1:
                for into, value in zip((contexts, freed, lowers), _summed(context, mass, lower)):
                    into.append(value)
                del context, mass, lower
        doc = chunk.doc()
        direct = np.bincount(doc, np.log10(prob, out=prob), n_docs)
        spots, keys = _all_of(open_at, np.int64), _all_of(open_key, np.uint64)
        needs, need = np.unique(keys, return_inverse=True)
        pairs, times = np.unique(doc[spots] * max(len(needs), 1) + need, return_counts=True)
        columns = [
            batch.column("chunk"), batch.column("doc_ids"), batch.column("held"), batch.column("counts"),
            _lists(known), _lists(base), _lists(direct),
            _lists((pairs // max(len(needs), 1)).astype(np.int32)), _lists((pairs % max(len(needs), 1)).astype(np.int32)),
            _lists(times.astype(np.int32)), _lists(needs.view(np.int64)),
            _lists(_all_of(contexts, np.uint64).view(np.int64)), _lists(_all_of(freed, float)), _lists(_all_of(lowers, float)),
        ]
        return pa.Table.from_arrays(columns, names=[part.split()[0] for part in _SCORED.split(", ")])

    return score


def _finisher(chunks: pa.Table, weights: pa.Table) -> pa.Table:
    """Rows of documents: the open backoff weights of a chunk's texts are filled in."""
    row = {c: chunks.column(c).combine_chunks().values for c in chunks.column_names if c != "chunk"}
    score = row["direct"].to_numpy().copy()
    if len(row["back_doc"]):
        needs, keys = row["needs"].to_numpy(), weights.column("key").to_numpy()
        by_key = np.argsort(keys)
        weight = weights.column("weight").to_numpy()[by_key[np.searchsorted(keys, needs, sorter=by_key)]]
        step = weight[row["back_at"].to_numpy()] * row["back_times"].to_numpy()
        score += np.bincount(row["back_doc"].to_numpy(), step, len(score))
    return pa.Table.from_arrays(
        [
            row["doc_ids"], row["held"], row["counts"].cast(pa.int64()), row["known"].cast(pa.int64()),
            row["base"], pa.array(score),
        ],
        names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
    )


def read_model(answers: DataFrame, documents: int, config: KatzConfig) -> Model:
    """Discounts and totals from the counts of counts of the answers' owned n-grams."""
    of_count = cut_lineage(
        answers.mapInArrow(_histogram, "gram int, r long, n long").groupBy("gram", "r").agg(F.sum("n").alias("n"))
    )
    small = of_count.where(F.col("r") <= max(config.fit_upto, config.turing_upto + 1)).collect()
    listed: dict[int, dict[int, int]] = {n: {} for n in range(1, config.order + 1)}
    for row in small:
        listed[row["gram"]][row["r"]] = row["n"]
    discounts = tuple(fit_discounts(listed[n], config) for n in listed)
    r, n = F.col("r"), F.col("n")
    words, tokens, freed = of_count.where("gram = 1").agg(
        F.sum(n), F.sum(r * n), F.sum(n * r * (1 - discounts[0].kept_column(r)))
    ).first()
    return Model(tokens or 0, words or 0, documents, freed / tokens if tokens else 1.0, discounts)


def score_texts(docs: DataFrame, config: KatzConfig = KatzConfig()) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per input row.

    Learns from the documents outside the held-out fold and scores all. A null text is empty and
    has the end token only; a null doc_id is learned from. Repeated rows count singly. Without
    any training text every token has probability one. ``base_score`` is the add-one unigram
    score, ``score`` the model's, both log10 sums over words and end. Other columns are
    ignored. Calling this counts; the result is read from written tables.
    """
    spark = docs.sparkSession
    marked = docs.select("doc_id", held_out(F.col("doc_id"), config).alias("held"), "text")
    chunks = cut_lineage(marked.mapInArrow(_chunker(config), _CHUNK))
    learned = F.size(F.filter("held", lambda held: ~held))
    tokens, documents = chunks.agg(F.sum("n_tokens"), F.sum(learned)).first()
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (tokens or 0) // config.bucket_tokens + 1)
    asked = chunks.mapInArrow(_asker(config.order, buckets), _ASKED)
    answers = cut_lineage(asked.groupBy("bucket").applyInArrow(_add_up, _ANSWER))
    model = read_model(answers, documents or 0, config)
    scored = cut_lineage(
        chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_scorer(model, config.order), _SCORED)
    )
    sums = scored.select(F.explode(F.arrays_zip("contexts", "freed", "lower")).alias("c"))
    weight = F.log10(F.sum("c.freed") / (1 - F.sum("c.lower"))).alias("weight")
    weights = sums.groupBy(F.col("c.contexts").alias("key")).agg(weight)
    needed = scored.select(F.col("chunk").alias("asker"), F.explode("needs").alias("key")).join(weights, "key")
    texts = scored.drop("contexts", "freed", "lower")
    rows = texts.groupBy("chunk").cogroup(needed.groupBy("asker")).applyInArrow(_finisher, _DOCS)
    return rows.withColumn("train_tokens", F.lit(model.tokens).cast("long"))


def op13_katz_scores(spark, sf_dir: str) -> DataFrame:
    """Katz bigram scores of all documents, learned outside the held-out seventh."""
    return score_texts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
