"""Best-fit packing into sequences of several permitted lengths.

Items are placed in order of falling length, each into the open bin that it fills best. If none
fits, a bin is opened, of the size that costs least per token that it will hold: for each
permitted size a bin is filled on trial from the items that are left and that no earlier trial
has claimed. In the end each bin is reduced to the cheapest size that still holds its contents.
Plans that open one size wherever it fits are made as well, and the cheapest plan is taken.

Best fit looks at lengths only, and lengths are bounded by the largest size. So the plan is
made once for the whole input from the histogram of lengths: equal items go into equal bins by
the run, which gives exactly the bins that placing them singly would give. The tasks then look
up each item's place from its rank among the items of its length.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.llm.numbering import number_rows

_PLACED = (
    "doc_id long, piece long, first_token long, tokens long, bin_id long, bin_size long, bin_offset long"
)


@dataclass(frozen=True)
class PackConfig:
    sizes: tuple[int, ...] = (512, 1024, 2048, 4096)
    overhead: float = 128.0  # cost of a sequence beside its tokens

    def cost(self, size: int) -> float:
        return size + self.overhead

    def opened(self, length: int) -> int:
        """Size with the least cost per token if bins were filled to the brim, the smaller on a tie."""
        return min((s for s in self.sizes if s >= length), key=lambda s: (self.cost(s) / s, s))

    def reduced(self, filled: int) -> int:
        return min((s for s in self.sizes if s >= filled), key=lambda s: (self.cost(s), s))


@dataclass
class Plan:
    """Runs of items (rows of ``items``) and of bins, both in ascending order.

    ``items``: length, first rank, items per bin, first bin, offset in the bin.
    ``bins``: first bin, size. ``before``: number of shorter items, by length.
    """

    items: np.ndarray
    bins: np.ndarray
    before: np.ndarray
    cost: float


class TrialFill:
    """Opens the size whose bin, filled on trial, costs least per token; the smaller on a tie.

    A trial takes as many of the item at hand as fit, then of the next shorter length that fits
    the rest, and so on. What the chosen bins took stays claimed, so later trials see only
    what is left for them. The choice holds for as many bins as its trial can be repeated.
    """

    def __init__(self, histogram: dict[int, int], config: PackConfig):
        self.config = config
        self.unclaimed = dict(histogram)
        self.lengths = sorted(histogram)

    def _fill(self, size: int, length: int, left: int) -> dict[int, int]:
        taken = {length: min(left, size // length)}
        free = size - length * taken[length]
        at = bisect_right(self.lengths, min(free, length - 1)) - 1
        while at >= 0:
            shorter = self.lengths[at]
            taken[shorter] = min(self.unclaimed[shorter], free // shorter)
            free -= shorter * taken[shorter]
            at = min(at, bisect_right(self.lengths, free)) - 1
        return taken

    def __call__(self, length: int, left: int) -> tuple[int, int]:
        """(size, bins) to open for ``left`` items of a length."""
        while self.lengths and self.lengths[-1] >= length:
            self.lengths.pop()
        trials = []
        for size in self.config.sizes:
            if size >= length:
                taken = self._fill(size, length, left)
                filled = sum(n * k for n, k in taken.items())
                trials.append((self.config.cost(self.config.reduced(filled)) / filled, size, taken))
        _, size, taken = min(trials, key=lambda t: t[:2])
        own = taken.pop(length)
        bins = min([left // own, *(self.unclaimed[n] // k for n, k in taken.items())])
        for shorter, k in taken.items():
            self.unclaimed[shorter] -= k * bins
            if not self.unclaimed[shorter]:
                self.lengths.remove(shorter)
        return size, bins


def plan_bins(histogram: dict[int, int], config: PackConfig) -> Plan:
    """The cheapest plan for ``histogram[length]`` items of each length (1 to the largest size)."""

    def wherever_it_fits(choose):
        def opening(length: int, left: int) -> tuple[int, int]:
            size = choose(length)
            return size, -(-left // (size // length))

        return opening

    one_size = [lambda n, size=size: size if n <= size else min(s for s in config.sizes if s >= n) for size in config.sizes]
    rules = [TrialFill(histogram, config), *(wherever_it_fits(f) for f in (config.opened, *one_size))]
    return min((best_fit(histogram, config, rule) for rule in rules), key=lambda plan: plan.cost)


def best_fit(histogram: dict[int, int], config: PackConfig, opening) -> Plan:
    """Best fit decreasing, where ``opening(length, left)`` gives the size and number of new bins."""
    room: list[int] = []  # distinct free room of open bins, ascending
    groups: dict[int, deque] = {}  # room -> runs (first bin, bins, size), oldest first
    items: list[tuple] = []
    n_bins = 0

    def keep(free: int, first: int, count: int, size: int, oldest: bool = False) -> None:
        if free not in groups:
            groups[free] = deque()
            insort(room, free)
        (groups[free].appendleft if oldest else groups[free].append)((first, count, size))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect_left(room, length)
            if at == len(room):
                size, count = opening(length, left)
                free, first = size, n_bins
                n_bins += count
            else:
                free = room[at]
                first, count, size = groups[free].popleft()
                if not groups[free]:
                    del groups[free], room[at]
            each = free // length
            used = min(count, left // each)
            if used:
                items.append((length, rank, each, first, size - free))
                keep(free - each * length, first, used, size)
                rank, left = rank + used * each, left - used * each
            if used < count and left:  # the last bin of this length takes fewer
                items.append((length, rank, left, first + used, size - free))
                keep(free - left * length, first + used, 1, size)
                used, left = used + 1, 0
            if used < count:
                keep(free, first + used, count - used, size, oldest=True)
    runs = sorted(
        (first, config.reduced(size - free), count) for free, same in groups.items() for first, count, size in same
    )
    bins = [(first, size) for first, size, _ in runs]
    longest = max(config.sizes)
    counts = np.zeros(longest + 2, dtype=np.int64)
    for length, n in histogram.items():
        counts[length + 1] = n
    return Plan(
        np.array(sorted(items), dtype=np.int64).reshape(-1, 5),
        np.array(bins, dtype=np.int64).reshape(-1, 2),
        np.cumsum(counts),
        sum(config.cost(size) * count for _, size, count in runs),
    )


def _placer(shared):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan: Plan = shared.value
        starts = plan.before[plan.items[:, 0]] + plan.items[:, 1]
        for batch in batches:
            tokens, number = (np.asarray(batch.column(c)) for c in ("tokens", "row_number"))
            length, rank, each, first, offset = plan.items[np.searchsorted(starts, number, "right") - 1].T
            nth = number - plan.before[length] - rank
            bin_id = first + nth // each
            size = plan.bins[np.searchsorted(plan.bins[:, 0], bin_id, "right") - 1, 1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "piece", "first_token", "tokens")),
                 pa.array(bin_id), pa.array(size), pa.array(offset + nth % each * tokens)],
                names=["doc_id", "piece", "first_token", "tokens", "bin_id", "bin_size", "bin_offset"],
            )

    return place


def pack(items: DataFrame, config: PackConfig = PackConfig()) -> DataFrame:
    """Place ``items(doc_id, tokens)``: one row per piece with its bin, size and offset.

    An item longer than the largest size is cut into pieces of that size and a rest; one with
    no tokens (or a null count) takes no place and has no row. A null doc_id and repeated rows
    are packed like others. Equal pieces are ranked by (doc_id, piece), so the result does not
    depend on the layout. What reaches the driver is the histogram of piece lengths, as many
    rows as the largest size; what is broadcast is the plan made from it. Calling this reads
    the items once.
    """
    longest = max(config.sizes)
    last = ((F.col("tokens") - 1) / longest).cast("long")
    cut = F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece")
    start = F.col("piece") * longest
    pieces = items.where("tokens > 0").select("doc_id", F.col("tokens").alias("all_tokens"), cut).select(
        "doc_id", "piece", start.alias("first_token"),
        F.least(F.lit(longest), F.col("all_tokens") - start).cast("long").alias("tokens"),
    )
    numbered = number_rows(pieces, "tokens", "doc_id", "piece")
    histogram = {r["tokens"]: r["n"] for r in numbered.groupBy("tokens").agg(F.count("*").alias("n")).collect()}
    shared = items.sparkSession.sparkContext.broadcast(plan_bins(histogram, config))
    return numbered.mapInArrow(_placer(shared), _PLACED)


def word_tokens(text: Column) -> Column:
    """Words of a text plus one end marker."""
    return (F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")) + 1).cast("long")


def pack_documents(docs: DataFrame, config: PackConfig = PackConfig()) -> DataFrame:
    """Pack whole documents by words; a null, empty or blank text is its end marker alone.
    Other columns of ``docs`` are ignored."""
    return pack(docs.select("doc_id", word_tokens(F.col("text")).alias("tokens")), config)


def op6_packing(spark, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence."""
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
