"""Secret scans: fixed patterns, plus character Markov models compared by likelihood ratio.

Everything runs in SQL expressions. Positions come from one row's own text: the pieces
between matches and the matches are measured, and their running sum is the position, so
scanning needs no shuffle. Two first-order character models, one of random strings and one of
ordinary identifiers, are trained on labelled samples: what the fixed patterns find in a
bounded sample of documents is random, the other identifiers there are ordinary.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

# The patterns of the base kinds, in the order in which ties are listed.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_VALUE = 6
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"

KINDS = ("assign", "access", "hex", "markov")
BLOCK = 64  # values that are run over at a time
SYMBOLS = len(ALPHABET)


@dataclass(frozen=True)
class MarkovConfig:
    sample_docs: int = 8_000  # documents that the two models are trained on
    min_chars: int = 16  # shortest string that is scored
    min_ratio: float = 12.0  # log-likelihood ratio from which a string is a secret
    uniform: float = 0.5  # weight of the uniform distribution in the random model
    identifier: str = r"[A-Za-z][A-Za-z0-9_]{5,}"  # ordinary strings of a training text


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    """All matches of a pattern; texts without one are passed over after a single search."""
    return F.when(text.rlike(pattern), F.regexp_extract_all(text, F.lit(pattern), F.lit(group))).otherwise(
        F.array().cast("array<string>")
    )


def _lengths(strings: Column) -> Column:
    return F.transform(strings, lambda s: F.length(s))


def _bound(value: Column, use) -> Column:
    """``use(value)``, with the value computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _running(values: Column, combine, levels: int = 3) -> Column:
    """The values combined from the first up to each one, 0 before the first.

    A step of an aggregate copies its state, so a growing array must not be one over the whole
    input. Blocks of BLOCK values are worked out singly, their last values are run over in the
    same way, and each block is combined with what lies before it.
    """
    def small(block: Column) -> Column:
        start = F.array(F.lit(0))
        grown = F.aggregate(block, start, lambda s, v: F.concat(s, F.array(combine(F.element_at(s, -1), v))))
        return F.slice(grown, F.lit(2), F.size(block))

    if levels == 1:
        return small(values)

    def join(done: Column) -> Column:
        lasts = F.transform(done, lambda b: F.coalesce(F.try_element_at(b, F.lit(-1)), F.lit(0)))
        before = F.concat(F.array(F.lit(0)), _running(lasts, combine, levels - 1))
        return F.flatten(F.zip_with(done, F.slice(before, F.lit(1), F.size(done)),
                                    lambda b, o: F.transform(b, lambda v: combine(o, v))))

    def blocks(all_: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(all_) - 1, F.lit(0)), F.lit(BLOCK))
        return F.transform(starts, lambda i: small(F.slice(all_, i + 1, F.lit(BLOCK))))

    return _bound(values, lambda all_: _bound(blocks(all_), join))


def _spans(text: Column, pattern: str, kind: int, keep: Column | None = None) -> Column:
    """Array of (start, kind, end, kept) of all matches: code points, end exclusive."""
    hits = _matches(text, pattern)
    gaps = _lengths(F.when(text.rlike(pattern), F.split(text, pattern, -1)))
    wanted = F.transform(hits, lambda s: F.lit(True)) if keep is None else keep

    def placed(sizes: Column) -> Column:
        # The text behind the last match is a gap alone.
        steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(sizes)), sizes, lambda gap, size: gap + size)
        zipped = F.arrays_zip(_running(steps, lambda a, b: a + b).alias("end"), sizes.alias("size"), wanted.alias("kept"))
        return F.transform(zipped, lambda z: F.struct(
            (z["end"] - z["size"]).alias("start"), F.lit(kind).alias("kind"), z["end"].alias("end"), z["kept"].alias("kept")))

    none = F.array().cast("array<struct<start:int,kind:int,end:int,kept:boolean>>")
    found = F.when(F.size(hits) > 0, _bound(_lengths(hits), placed)).otherwise(none)
    return F.filter(found, lambda s: s["kept"])


def _codes(string: Column) -> Column:
    """Number of each transition from a character to the next, from 1; 0 if one is outside ALPHABET.

    The string is split once; positions in it are never looked up from its start.
    """
    places = F.array(*[F.lit(ALPHABET.find(chr(c)) + 1) for c in range(128)])

    def place(character: Column) -> Column:
        code = F.ascii(character)
        return F.when(code < 128, F.element_at(places, code + 1)).otherwise(0)

    def pair(first: Column, second: Column) -> Column:
        return F.when((first > 0) & (second > 0), (first - 1) * SYMBOLS + second).otherwise(0)

    def pairs(at: Column) -> Column:
        n = F.size(at) - 1
        return F.when(n > 0, F.zip_with(F.slice(at, F.lit(1), n), F.slice(at, F.lit(2), n), pair))

    return _bound(F.transform(F.split(string, ""), place), pairs)


def training_strings(docs: DataFrame, config: MarkovConfig) -> DataFrame:
    """Distinct labelled strings (value, random) of the sampled documents.

    The sample has the smallest ids by hash, at most ``sample_docs`` of them.
    """
    ids = docs.select("doc_id").where("doc_id IS NOT NULL").distinct()
    chosen = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(config.sample_docs)
    text = F.col("text")
    sample = _texts(docs).join(F.broadcast(chosen), "doc_id", "left_semi")
    secrets = F.concat(
        F.filter(_matches(text, ASSIGN, 2), lambda v: F.length(v) >= ASSIGN_VALUE),
        _matches(text, ACCESS), _matches(text, HEX),
    )
    rest = F.regexp_replace(text, f"{ASSIGN}|{ACCESS}|{HEX}", " ")
    both = F.array(
        F.struct(F.array_distinct(secrets).alias("strings"), F.lit(True).alias("random")),
        F.struct(F.array_distinct(F.regexp_extract_all(rest, F.lit(config.identifier), F.lit(0))).alias("strings"),
                 F.lit(False).alias("random")),
    )
    return (
        sample.select(F.explode(both).alias("b")).select(F.explode("b.strings").alias("value"), "b.random")
        .distinct()
    )


def markov_model(docs: DataFrame, config: MarkovConfig) -> DataFrame:
    """One row with ``model``: the log-likelihood ratio of each of the 68 x 68 transitions."""
    counts = (
        training_strings(docs, config)
        .select("random", F.explode(_codes(F.col("value"))).alias("code")).where("code > 0")
        .groupBy("code").agg(
            F.count_if("random").alias("in_random"), F.count_if(~F.col("random")).alias("in_ordinary")
        )
    )
    grid = docs.sparkSession.range(1, SYMBOLS * SYMBOLS + 1).select(
        F.col("id").cast("int").alias("code"), ((F.col("id") - 1) / SYMBOLS).cast("int").alias("state")
    )
    full = grid.join(counts, "code", "left").fillna(0, ["in_random", "in_ordinary"])
    states = full.groupBy("state").agg(
        F.sum("in_random").alias("all_random"), F.sum("in_ordinary").alias("all_ordinary")
    )
    learned = F.when(F.col("all_random") > 0, F.col("in_random") / F.col("all_random")).otherwise(1.0 / SYMBOLS)
    random = config.uniform / SYMBOLS + (1 - config.uniform) * learned
    ordinary = (F.col("in_ordinary") + 1) / (F.col("all_ordinary") + SYMBOLS)
    ratio = F.log(random) - F.log(ordinary)
    pairs = full.join(states, "state").select(F.struct("code", ratio.alias("ratio")).alias("t"))
    ordered = F.array_sort(F.collect_list("t"))
    return pairs.agg(F.transform(ordered, lambda t: t["ratio"]).alias("model"))


def _ratio(string: Column, model: Column) -> Column:
    """Log-likelihood ratio of a string: random against ordinary, summed over transitions."""
    return F.aggregate(
        _codes(string), F.lit(0.0),
        lambda total, code: total + F.when(code > 0, F.element_at(model, code)).otherwise(0.0),
    )


def find_secrets(docs: DataFrame, config: MarkovConfig = MarkovConfig()) -> DataFrame:
    """(doc_id, found) with ``found``: (start, kind, end) of all spans in order.

    ``kind`` numbers KINDS. Per kind the matches are the leftmost ones that do not overlap;
    spans of different kinds may. A markov span is a run of at least ``min_chars`` characters
    of ALPHABET whose ratio reaches ``min_ratio``. A null text counts as empty, a null doc_id
    stays null, repeated rows give repeated results, other columns are ignored.
    """
    return _scanned(docs, config).select("row.doc_id", "found")


def _scanned(docs: DataFrame, config: MarkovConfig) -> DataFrame:
    """(row, text, found): whole input rows beside their spans."""
    text = F.col("text")
    run = f"[A-Za-z0-9+/_.=-]{{{config.min_chars},}}"
    long_value = F.transform(_matches(text, ASSIGN, 2), lambda v: F.length(v) >= ASSIGN_VALUE)
    model = markov_model(docs, config).scalar()
    # The model is bound to a name: its expression would be worked out again for every transition.
    random = F.when(text.rlike(run), _bound(F.col("model"), lambda m: F.transform(
        _matches(text, run), lambda s: _ratio(s, m) >= config.min_ratio)))
    spans = (
        docs.select(F.struct("*").alias("row"), F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("model", F.when(text.rlike(run), model))
        .select(
            "row", "text",
            _spans(text, ASSIGN, 0, long_value).alias("assign"), _spans(text, ACCESS, 1).alias("access"),
            _spans(text, HEX, 2).alias("hex"), _spans(text, run, 3, random).alias("markov"),
        )
    )
    return spans.select(
        "row", "text",
        F.transform(F.array_sort(F.concat(*KINDS)), lambda s: F.struct(s["start"], s["kind"], s["end"])).alias("found"),
    )


MASK = "[SECRET]"


def redact(docs: DataFrame, config: MarkovConfig = MarkovConfig()) -> DataFrame:
    """The documents with every secret span replaced by MASK, all columns kept; spans that
    overlap or touch become one mask. ``n_chars``, if there is one, follows the text. Texts
    without a span, null ones included, stay as they are."""
    def masked(chars: Column) -> Column:
        def pieces(reach: Column) -> Column:
            def piece(span: Column, i: Column) -> Column:
                at = F.coalesce(F.get(reach, i - 1), F.lit(0))  # end of the spans before
                gap = F.array_join(F.slice(chars, at + 1, F.greatest(span["start"] - at, F.lit(0))), "")
                return F.when((span["start"] > at) | (i == 0), F.concat(gap, F.lit(MASK))).otherwise("")

            rest = F.slice(chars, F.element_at(reach, -1) + 1, F.size(chars))
            return F.concat(F.array_join(F.transform("found", piece), ""), F.array_join(rest, ""))

        return _bound(_running(F.transform("found", lambda s: s["end"]), F.greatest), pieces)

    # One array of characters per text: a substring would be looked up from the text's start.
    covered = F.when(F.size("found") > 0, _bound(F.split("text", ""), masked))
    changed = _scanned(docs, config).select(
        "row", covered.alias("masked")
    )
    columns = {c: F.col("row").getField(c) for c in docs.columns}
    columns["text"] = F.coalesce("masked", columns["text"])
    if "n_chars" in columns:
        size = F.length("masked").cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.coalesce(size, columns["n_chars"])
    return changed.select(*[value.alias(c) for c, value in columns.items()])


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
    )


def op9_secret_scan(spark, sf_dir: str) -> DataFrame:
    """All secret spans of every document, with the digest of the base kinds."""
    found = find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))

    def count(kind: int) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("found", lambda s: s["kind"] < 3)
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"),
        count(3).alias("n_markov"),
    )
