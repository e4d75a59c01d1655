"""CSV records of large files whose quoted fields may hold line breaks, without a single reader.

A split of a file may begin inside a quoted field, so a line alone does not tell whether its
line break ends a record. But each line maps "inside a quoted field before" to "inside after",
and only four such maps exist. Composing them along the lines of a split, and then along the
splits of a file, gives the state before every line; records end at breaks outside of quotes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec, functions as F

from shelfcast.session import cut_lineage

_SPLIT = ("file", "block")
_OUTSIDE, _INSIDE, _CLOSED = 0, 1, 2


def _ends_inside(line: Column, start: int) -> Column:
    """1 if a quoted field is open after the line, for a state before it.

    A quote opens a field at the field's start only; elsewhere in an unquoted field it is an
    ordinary character. In a quoted field a doubled quote is one character.
    """
    before_quotes = F.split(line, '"', -1)
    before_quotes = F.slice(before_quotes, 1, F.size(before_quotes) - 1)

    def step(state: Column, piece: Column) -> Column:
        opens = F.endswith(piece, F.lit(",")) | ((piece == "") & (state == _CLOSED))
        return F.when(state == _INSIDE, _CLOSED).when(opens, _INSIDE).otherwise(_OUTSIDE)

    first = F.lit(_INSIDE if start == _INSIDE else _CLOSED)  # a line's first character starts a field
    walked = F.aggregate(before_quotes, first, step)
    return F.when(line.contains('"'), (walked == _INSIDE).cast("int")).otherwise(start)


def read_lines(spark: SparkSession, parts: Sequence[str]) -> DataFrame:
    """(file, block, at, value, const, flip): lines in order of ``at`` within a split of a file.

    A line whose state after does not depend on the state before has it in ``const``; else
    ``flip`` is 1 if the line turns the state round and 0 if it keeps it.
    """
    lines = spark.read.option("lineSep", "\n").text(list(parts)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value",
    )
    after_out, after_in = _ends_inside(F.col("value"), _OUTSIDE), _ends_inside(F.col("value"), _INSIDE)
    return lines.withColumns({"o": after_out, "i": after_in}).select(
        "file", "block", "at", "value",
        F.when(F.col("o") == F.col("i"), F.col("o")).alias("const"),
        F.when(F.col("o") > F.col("i"), 1).otherwise(0).alias("flip"),
    )


def break_in_quotes(spark: SparkSession, parts: Sequence[str]) -> bool:
    """Whether any line break is inside a quoted field; the scan ends at the first one found."""
    opened = _ends_inside(F.col("value"), _OUTSIDE) == 1
    return not spark.read.option("lineSep", "\n").text(list(parts)).where(opened).isEmpty()


def _composed(along: WindowSpec) -> tuple[Column, Column]:
    """(const, flip) of the composition of all maps up to a row."""
    flips = F.sum("flip").over(along)
    const = F.last(F.when(F.col("const").isNotNull(), (F.col("const") + flips) % 2), ignorenulls=True).over(along)
    return ((const + flips) % 2).cast("int"), (flips % 2).cast("int")


def _states_before(lines: DataFrame) -> DataFrame:
    """(file, block, start): the state before each split that holds a line.

    Only lines that are no identity are moved, without their text; then one row per split.
    """
    const, flip = _composed(Window.partitionBy(*_SPLIT).orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    maps = (
        lines.select(*_SPLIT, "at", "const", "flip").where("const IS NOT NULL OR flip = 1")
        .select(*_SPLIT, "at", const.alias("const"), flip.alias("flip"))
        .groupBy(*_SPLIT).agg(F.max_by(F.struct("const", "flip"), "at").alias("m"))
    )
    # Splits without such a line keep the state.
    every = lines.select(*_SPLIT).distinct().join(maps, list(_SPLIT), "left").select(
        *_SPLIT, F.col("m.const").alias("const"), F.coalesce("m.flip", F.lit(0)).alias("flip")
    )
    const, flip = _composed(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, 0))
    after = every.select(*_SPLIT, F.coalesce(const, flip).alias("after"))
    before = F.lag("after", 1, _OUTSIDE).over(Window.partitionBy("file").orderBy("block"))
    return after.select(*_SPLIT, before.alias("start"))


def whole_records(spark: SparkSession, parts: Sequence[str]) -> DataFrame:
    """(value): every record of the files but the first of each (the header) and blank ones.

    Lines are gathered by split and record, so a task holds a split at most. The part of a record
    that lies in later splits, one piece per split, is joined to the split the record began in.
    """
    lines = read_lines(spark, parts)
    along = Window.partitionBy(*_SPLIT).orderBy("at")
    const, flip = _composed(along.rowsBetween(Window.unboundedPreceding, 0))
    states = lines.join(_states_before(lines), list(_SPLIT)).select(
        *_SPLIT, "at", "value", "start",
        F.coalesce(const, (F.col("start") + flip) % 2).alias("after"),
    )
    begins = (F.coalesce(F.lag("after").over(along), F.col("start")) == _OUTSIDE).cast("int")
    numbered = states.select(*_SPLIT, "at", "value", begins.alias("begins"))
    numbered = numbered.withColumn("record", F.sum("begins").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "value"))), lambda p: p["value"]), "\n")
    records = cut_lineage(numbered.groupBy(*_SPLIT, "record").agg(text.alias("value")))

    per_split = records.groupBy(*_SPLIT).agg(
        F.max("record").alias("last"), F.max(F.when(F.col("record") == 0, F.col("value"))).alias("rest")
    )
    begun = F.last(F.when(F.col("last") > 0, F.struct(F.col("block").alias("block"), F.col("last").alias("record"))),
                   ignorenulls=True)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    rests = (
        per_split.withColumn("owner", begun.over(earlier)).where("rest IS NOT NULL")
        .groupBy("file", "owner.block", "owner.record")
        .agg(F.array_sort(F.collect_list(F.struct(F.col("block").alias("b"), "rest"))).alias("rests"))
    )
    whole = records.where("record > 0").join(rests, [*_SPLIT, "record"], "left")
    full = F.array_join(F.concat(F.array("value"), F.coalesce(F.col("rests.rest"), F.array().cast("array<string>"))), "\n")
    return (
        whole.where("NOT (block = 0 AND record = 1)")
        .select(F.regexp_replace(full, "\r$", "").alias("value")).where("trim(value) <> ''")
    )


def parse_records(records: DataFrame, names: Sequence[str], options: dict[str, str]) -> DataFrame:
    """The fields of each record as text columns."""
    quoted = ["`" + name.replace("`", "``") + "`" for name in names]
    parsed = F.from_csv("value", ", ".join(f"{q} string" for q in quoted), options)
    return records.select(parsed.alias("r")).select(*[F.col(f"r.{q}") for q in quoted])
