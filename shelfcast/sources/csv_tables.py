"""CSV sources: choose the folder, land Bronze as text, validate into Silver."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from shelfcast.functions.parsing import missing_to_null
from shelfcast.operators import quality
from shelfcast.schemas import CONTEXT_TABLES, SERIES, TableSpec
from shelfcast.sources import files, records
from shelfcast.sources.runs import RunFolder

SOURCES = ("raw", "sample")
SALES_FILE = "train"

# Notices of the run report.
NO_PROMOTION_WARNING = "onpromotion absent: promotion analysis unavailable."
OIL_WARNING = (
    "Oil retained as context; missing oil prices are allowed; no causal model uses oil."
)

_BAD_RECORD = "_corrupt_record"
_LONG_RECORD = "_long_record"


class SourceParseError(ValueError):
    """A CSV file that cannot be read as a table."""


@dataclass
class Layers:
    selected: str
    bronze: dict[str, DataFrame] = field(default_factory=dict)
    silver: dict[str, DataFrame] = field(default_factory=dict)
    warnings: list[str] = field(default_factory=list)


def select_source(spark: SparkSession, source: str, data_dir: str) -> str:
    """``auto`` prefers real data when it is there; sources are never mixed."""
    if source == "auto":
        real = files.exists(spark, f"{data_dir}/raw/{SALES_FILE}.csv")
        return "raw" if real else "sample"
    if source not in SOURCES:
        raise ValueError("source must be auto, raw, or sample")
    return source


def _has_extra_fields(column_count: int) -> Column:
    """A rejected record with more fields than the header; shorter records end in nulls."""
    unquoted = F.regexp_replace(_BAD_RECORD, '"[^"]*"', "")  # a doubled quote ends one run and starts another
    return F.col(_BAD_RECORD).isNotNull() & (F.size(F.split(unquoted, ",")) > column_count)


def physical_names(headers: Sequence[Sequence[str]]) -> dict[str, str]:
    """A column name per header text that stays unique when case is ignored, as Spark does.

    Lower-case texts, which the contracts use, keep their name; a text that differs from
    another one by case only gets a number.
    """
    texts = dict.fromkeys(text for header in headers for text in header)
    taken: set[str] = set()
    out = {}
    for text in sorted(texts, key=lambda t: t != t.lower()):
        name, number = text, 0
        while name.lower() in taken:
            number += 1
            name = f"{text}.{number}"
        taken.add(name.lower())
        out[text] = name
    return out


def _header_of(line: str) -> tuple[str, ...]:
    """Column texts of a header line; a repeated text is numbered."""
    seen: dict[str, int] = {}
    out = []
    for text in next(csv.reader([line.removeprefix("\ufeff")]), []):
        count = seen[text] = seen.get(text, -1) + 1
        out.append(f"{text}.{count}" if count else text)
    return tuple(out)


def read_text_table(spark: SparkSession, path: str, multi_line: bool = False) -> tuple[DataFrame, list[int]]:
    """Header CSV, a file or a folder of parts, with every column as text and a flag for records
    that are longer than their header; also the header lengths.

    Columns are found by name in each part's own header: parts may order them differently, and
    a column that a part lacks is null there. Nothing is inferred, so one odd value cannot
    change the type of a whole column. Quoted fields may hold line breaks: with ``multi_line``
    each file is read by one task; without it, files stay splittable, and where a scan finds
    such a break, records are put together from the lines of all splits.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for part in files.data_files(spark, path):
        line = files.first_line(spark, part)
        if line:
            groups.setdefault(_header_of(line), []).append(part)
    if not groups:
        raise SourceParseError("No columns to parse from file")
    names = physical_names(list(groups))
    options = {"escape": '"', "columnNameOfCorruptRecord": _BAD_RECORD}
    reader = spark.read.options(header=True, multiLine=multi_line, columnPruning=False, **options)
    table = None
    for header, parts in groups.items():
        columns = [*[names[t] for t in header], _BAD_RECORD]
        if not multi_line and records.break_in_quotes(spark, parts):
            rows = records.parse_records(records.whole_records(spark, parts), columns, options)
        else:
            rows = reader.schema(T.StructType([T.StructField(n, T.StringType()) for n in columns])).csv(parts)
        rows = rows.withColumn(_LONG_RECORD, _has_extra_fields(len(header))).drop(_BAD_RECORD)
        table = rows if table is None else table.unionByName(rows, allowMissingColumns=True)
    return table, sorted({len(header) for header in groups})


def land_bronze(
    spark: SparkSession, path: str, name: str, run: RunFolder, multi_line: bool = False
) -> DataFrame:
    """Copy a CSV into Bronze in one pass that also looks for records that are too long."""
    text, lengths = read_text_table(spark, path, multi_line)
    seen = Observation()
    checked = text.observe(seen, F.count_if(_LONG_RECORD).alias("long_records"))
    table = run.write("bronze", name, checked.drop(_LONG_RECORD))
    if seen.get["long_records"]:
        run.discard("bronze", name)
        fields = " or ".join(map(str, lengths))
        raise SourceParseError(f"Records with more than the {fields} fields of the header")
    return table


def _quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def as_missing(bronze: DataFrame) -> DataFrame:
    """Texts that stand for a missing value become null; all columns are text here."""
    return bronze.withColumns({c: missing_to_null(F.col(_quoted(c))) for c in bronze.columns})


def silver_sales(bronze: DataFrame, run: RunFolder) -> DataFrame:
    """Validated demand, bucketed by series. The grain is checked before rows move by key: the
    check combines copies first, whereas the layout would send all of them to one task."""
    typed = quality.clean_table(as_missing(bronze), quality.sales_spec(bronze))
    return run.write_bucketed(
        "silver", "sales", quality.with_promotion_column(typed), SERIES,
        order=("date", *SERIES),
        source_bytes=files.size_in_bytes(run.spark, run.path("bronze", "sales")),
    )


def silver_context(spec: TableSpec, bronze: DataFrame, run: RunFolder) -> DataFrame:
    table = quality.clean_table(as_missing(bronze), spec)
    if spec.name == "oil":
        table = quality.coerce_oil_price(table)
    return run.write("silver", spec.name, table)


def find_sales(spark: SparkSession, source: str, data_dir: str) -> tuple[str, str]:
    """The selected source and the path of its demand file, which must exist."""
    data_dir = data_dir.rstrip("/")
    selected = select_source(spark, source, data_dir)
    path = f"{data_dir}/{selected}/{SALES_FILE}.csv"
    if not files.exists(spark, path):
        raise FileNotFoundError(f"Missing {path}. Place the demand CSVs there.")
    return selected, path


def load_layers(spark: SparkSession, source: str, data_dir: str, run: RunFolder) -> Layers:
    """Land and validate one source folder. Bad demand data stops the run; an absent or
    invalid context table is reported and left out of Silver, its Bronze copy stays. Context
    files are small, so their quoted fields may hold line breaks."""
    selected, sales_path = find_sales(spark, source, data_dir)
    folder = sales_path.rpartition("/")[0]
    layers = Layers(selected)
    bronze = layers.bronze["sales"] = land_bronze(spark, sales_path, "sales", run)
    layers.silver["sales"] = silver_sales(bronze, run)
    if "onpromotion" not in bronze.columns:
        layers.warnings.append(NO_PROMOTION_WARNING)
    for spec in CONTEXT_TABLES:
        path = f"{folder}/{spec.name}.csv"
        if not files.exists(spark, path):
            layers.warnings.append(f"Optional {spec.name}.csv absent.")
            continue
        try:
            layers.bronze[spec.name] = land_bronze(spark, path, spec.name, run, multi_line=True)
            layers.silver[spec.name] = silver_context(spec, layers.bronze[spec.name], run)
        except (quality.DataValidationError, SourceParseError) as error:
            layers.warnings.append(f"Ignored optional {spec.name}: {error}")
        else:
            if spec.name == "oil":
                layers.warnings.append(OIL_WARNING)
    return layers
