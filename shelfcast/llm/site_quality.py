"""Quality classifier with hierarchical empirical Bayes over sites.

A document's own evidence is a naive Bayes log-likelihood ratio of binned text features, learned
from all labelled documents by one grouped count. Hosts and paths then have posteriors: the mean
of their documents' probabilities, shrunk towards the global mean (hosts) and towards their
host (paths). How strongly is estimated from the spread between sites, so sparse sites follow
the level above and large ones speak for themselves. A document is scored by its evidence on
the odds of its path, its own share taken out.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.llm.toxicity import held_out
from shelfcast.session import cut_lineage

BINS = 16


@dataclass(frozen=True)
class QualityConfig:
    weight: float = 0.5  # of the evidence: the features are not independent
    smoothing: float = 1.0  # added to every count
    least_strength: float = 1.0  # bounds of a prior's strength, in documents
    most_strength: float = 1000.0


# Fixed values: (name, expression over text t, words w, lines l and characters n, bins per
# unit), written so that DuckDB reads them too with the given function names.
FEATURES = (
    ("upper", "{length}(regexp_replace(t, '[^A-ZÀ-ÖØ-Þ]+', ''{g})) / n", 32.0),
    ("marks", "{length}(regexp_replace(t, '[^!#$%&*|@^~<>=]+', ''{g})) / n", 64.0),
    ("digits", "{length}(regexp_replace(t, '[^0-9]+', ''{g})) / n", 64.0),
    ("word_length", "n / w", 1.0),
    ("words", "ln(w) / ln(2.0)", 1.0),
    ("repeated_lines", "1.0 - dl / l", 16.0),
    ("distinct_words", "dw / w", 16.0),
)


def text_bins(docs: DataFrame, host: str, path: str) -> DataFrame:
    """(doc_id, host, path, bins): one bin number per feature. A null or empty text counts as
    one blank; a null host or path is the site named by the empty string."""
    words, lines = F.split("t", "[ \t\r\n]+", -1), F.split("t", "\n", -1)
    measured = docs.select(
        "doc_id", F.coalesce(F.col(host), F.lit("")).alias("host"), F.coalesce(F.col(path), F.lit("")).alias("path"),
        F.coalesce(F.nullif("text", F.lit("")), F.lit(" ")).alias("t"),
    ).withColumns({
        "n": F.length("t").cast("double"), "w": F.size(words).cast("double"), "l": F.size(lines).cast("double"),
        "dw": F.size(F.array_distinct(words)).cast("double"), "dl": F.size(F.array_distinct(lines)).cast("double"),
    })
    bins = [
        F.least(F.floor(F.expr(e.format(length="length", g="")) * scale + 1e-9), F.lit(BINS - 1)).cast("int")
        for _, e, scale in FEATURES
    ]
    return measured.select("doc_id", "host", "path", F.array(*bins).alias("bins"))


def training_counts(binned: DataFrame, labels: DataFrame) -> DataFrame:
    """(feature, bin, good, bad) over the labelled documents outside the held-out fifth."""
    known = (
        labels.select("doc_id", F.col("quality").cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("label").alias("label"))
    )
    return (
        binned.join(known, "doc_id").select("label", F.posexplode("bins").alias("feature", "bin"))
        .groupBy("feature", "bin")
        .agg(F.count_if(F.col("label") == 1).alias("good"), F.count_if(F.col("label") == 0).alias("bad"))
    )


def _ratios(counts: list, config: QualityConfig) -> tuple[list[list[float]], float]:
    """Log-likelihood ratio per feature and bin, and the prior log-odds."""
    table = {(r["feature"], r["bin"]): (r["good"], r["bad"]) for r in counts}
    good = sum(g for (f, _), (g, _) in table.items() if f == 0)
    bad = sum(b for (f, _), (_, b) in table.items() if f == 0)
    s = config.smoothing
    ratios = [
        [
            math.log((table.get((f, b), (0, 0))[0] + s) / (good + s * BINS))
            - math.log((table.get((f, b), (0, 0))[1] + s) / (bad + s * BINS))
            for b in range(BINS)
        ]
        for f in range(len(FEATURES))
    ]
    return ratios, math.log((good + s) / (bad + s))


def _logistic(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-x))


def _strength(mean: float, spread: float, noise: float, config: QualityConfig) -> float:
    """Documents that a prior is worth: the binomial variance over the variance between sites
    beyond what the sites' sizes explain."""
    between = max(spread - noise, 1e-9)
    worth = mean * (1 - mean) / between - 1
    return min(max(worth, config.least_strength), config.most_strength)


def _prior(sites: DataFrame, mean: Column, config: QualityConfig) -> float:
    """Strength of a level's prior, from sites(n, total, squares) and what they shrink to."""
    rate = F.col("total") / F.col("n")
    within = F.greatest(F.col("squares") / F.col("n") - rate * rate, F.lit(0.0))
    row = sites.agg(
        F.sum(F.col("n") * (rate - mean) * (rate - mean)).alias("spread"), F.sum(within).alias("noise"),
        F.sum("n").alias("n"), F.sum("total").alias("total"),
    ).first()
    if not row["n"]:
        return config.most_strength
    return _strength(row["total"] / row["n"], row["spread"] / row["n"], row["noise"] / row["n"], config)


def site_quality(
    docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", config: QualityConfig = QualityConfig()
) -> DataFrame:
    """(doc_id, evidence, host_rate, path_rate, score, keep), one row per input row.

    ``evidence`` is the document's weighted log-likelihood ratio, ``host_rate`` and
    ``path_rate`` are the shrunken means of its site, ``score`` the probability of good quality
    and ``keep`` whether it is 0.5 or more. Null and empty texts have the features of a blank;
    null sites form one site; a null doc_id is scored and never learned from; several labels of
    an id count as their largest. Without labels the evidence is 0. Only counts by feature and
    bin and one row per level reach the driver. Calling this trains.
    """
    binned = cut_lineage(text_bins(docs, host, path))
    ratios, prior = _ratios(training_counts(binned, labels).collect(), config)
    parts = [
        F.element_at(F.array(*[F.lit(v) for v in row]), F.element_at("bins", f + 1) + 1) for f, row in enumerate(ratios)
    ]
    evidence = config.weight * sum(parts[1:], parts[0])
    scored = binned.select("doc_id", "host", "path", evidence.alias("evidence")).withColumn(
        "own", _logistic(F.col("evidence") + prior)
    )
    sums = [F.count("*").alias("n"), F.sum("own").alias("total"), F.sum(F.col("own") * F.col("own")).alias("squares")]
    paths = cut_lineage(scored.groupBy("host", "path").agg(*sums))
    hosts = paths.groupBy("host").agg(*[F.sum(c).alias(c) for c in ("n", "total", "squares")])
    whole = hosts.agg(F.sum("n").alias("n"), F.sum("total").alias("total")).first()
    mean = whole["total"] / whole["n"] if whole["n"] else 0.5
    strong = _prior(hosts, F.lit(mean), config)
    host_rate = (F.col("total") + strong * mean) / (F.col("n") + strong)
    hosts = hosts.select("host", host_rate.alias("host_rate"))
    sites = paths.join(hosts, "host")
    steady = _prior(sites, F.col("host_rate"), config)
    met = scored.join(sites, ["host", "path"])
    path_rate = (F.col("total") + steady * F.col("host_rate")) / (F.col("n") + steady)
    others = (F.col("total") - F.col("own") + steady * F.col("host_rate")) / (F.col("n") - 1 + steady)
    odds = F.log(others) - F.log(1.0 - others)
    score = _logistic(F.col("evidence") + odds)
    return met.select(
        "doc_id", F.round("evidence", 6).alias("evidence"), F.round("host_rate", 6).alias("host_rate"),
        F.round(path_rate, 6).alias("path_rate"), F.round(score, 6).alias("score"), (score >= 0.5).alias("keep"),
    )


def op3_site_quality(spark, sf_dir: str) -> DataFrame:
    """Quality of all documents; the source is the host, its language sections are the paths."""
    return site_quality(
        spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    )


def op3_sql(config: QualityConfig = QualityConfig()) -> str:
    """The same rows in DuckDB. The held-out fold is crc32 based, computed as in op7."""
    bins = ", ".join(
        f"least(floor({e.format(length='length', g=', ' + chr(39) + 'g' + chr(39))} * {scale} + 1e-9), {BINS - 1})::INTEGER"
        for _, e, scale in FEATURES
    )
    s, lo, hi = config.smoothing, config.least_strength, config.most_strength
    strength = f"least(greatest(p * (1 - p) / greatest(spread - noise, 1e-9) - 1, {lo}), {hi})"
    return f"""
WITH RECURSIVE bits AS (
  SELECT i::BIGINT AS i, i::BIGINT AS c, 0 AS k FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crc AS (SELECT list(c ORDER BY i) AS tab FROM bits WHERE k = 8
), known AS (
  SELECT doc_id, max(quality) AS label FROM labels, crc
  WHERE quality IN (0, 1) AND doc_id IS NOT NULL AND xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(doc_id::VARCHAR)), '..'),
      lambda b: ('0x' || b)::BIGINT)),
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 5 <> 0
  GROUP BY doc_id
), texts AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(lang, '') AS path, coalesce(nullif(text, ''), ' ') AS t FROM documents
), split AS (
  SELECT *, regexp_split_to_array(t, '[ \\t\\r\\n]+') AS ws, string_split(t, chr(10)) AS ls FROM texts
), measured AS (
  SELECT doc_id, host, path, t, length(t)::DOUBLE AS n, len(ws)::DOUBLE AS w, len(ls)::DOUBLE AS l,
    len(list_distinct(ws))::DOUBLE AS dw, len(list_distinct(ls))::DOUBLE AS dl FROM split
), binned AS (SELECT row_number() OVER () AS id, doc_id, host, path, [{bins}] AS bins FROM measured
), cells AS (SELECT id, doc_id, unnest(bins) AS bin, generate_subscripts(bins, 1) AS feature FROM binned
), counts AS (
  SELECT feature, bin, count(*) FILTER (label = 1) AS good, count(*) FILTER (label = 0) AS bad
  FROM cells JOIN known USING (doc_id) GROUP BY ALL
), totals AS (SELECT coalesce(sum(good), 0) AS good, coalesce(sum(bad), 0) AS bad FROM counts WHERE feature = 1
), scored AS (
  SELECT b.id, any_value(b.doc_id) AS doc_id, any_value(b.host) AS host, any_value(b.path) AS path,
    {config.weight} * sum(ln((coalesce(c.good, 0) + {s}) / (totals.good + {s * BINS}))
      - ln((coalesce(c.bad, 0) + {s}) / (totals.bad + {s * BINS}))) AS evidence,
    any_value(ln((totals.good + {s}) / (totals.bad + {s}))) AS prior
  FROM binned b JOIN cells x USING (id) LEFT JOIN counts c ON c.feature = x.feature AND c.bin = x.bin CROSS JOIN totals
  GROUP BY b.id
), own AS (SELECT *, 1.0 / (1.0 + exp(-(evidence + prior))) AS own FROM scored
), paths AS (SELECT host, path, count(*) AS n, sum(own) AS total, sum(own * own) AS squares FROM own GROUP BY ALL
), hosts AS (SELECT host, sum(n)::DOUBLE AS n, sum(total) AS total, sum(squares) AS squares FROM paths GROUP BY ALL
), whole AS (SELECT sum(total) / sum(n) AS mean FROM hosts
), host_prior AS (
  SELECT {strength} AS strong FROM (
    SELECT sum(total) / sum(n) AS p, sum(n * (total / n - mean) ** 2) / sum(n) AS spread,
      sum(greatest(squares / n - (total / n) ** 2, 0.0)) / sum(n) AS noise FROM hosts, whole)
), rates AS (SELECT host, (total + strong * mean) / (n + strong) AS host_rate FROM hosts, whole, host_prior
), path_prior AS (
  SELECT {strength} AS steady FROM (
    SELECT sum(total) / sum(n) AS p, sum(n * (total / n - host_rate) ** 2) / sum(n) AS spread,
      sum(greatest(squares / n - (total / n) ** 2, 0.0)) / sum(n) AS noise FROM paths JOIN rates USING (host))
), final AS (
  SELECT doc_id, evidence, host_rate, (total + steady * host_rate) / (n + steady) AS path_rate,
    (total - own + steady * host_rate) / (n - 1 + steady) AS others
  FROM own JOIN paths USING (host, path) JOIN rates USING (host), path_prior
)
SELECT doc_id, round(evidence, 6) AS evidence, round(host_rate, 6) AS host_rate, round(path_rate, 6) AS path_rate,
  round(1.0 / (1.0 + exp(-(evidence + ln(others) - ln(1.0 - others)))), 6) AS score,
  1.0 / (1.0 + exp(-(evidence + ln(others) - ln(1.0 - others)))) >= 0.5 AS keep
FROM final
"""
