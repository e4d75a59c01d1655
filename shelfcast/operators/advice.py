"""Rule-based review suggestions with their evidence as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfcast.functions.columns import fixed_text, ratio
from shelfcast.operators.planning import REORDER

# Evidence and suggestion texts, and the thresholds of the rules.
REORDER_TEXT = (
    "Review replenishment under these planning assumptions; this is not an observed stockout."
)
VARIABLE_EVIDENCE = "Recent daily coefficient of variation exceeds 0.5"
VARIABLE_TEXT = (
    "Monitor variability and investigate demand spikes before changing safety stock."
)
TOP_STORE_TEXT = (
    "Prioritize replenishment review; volume alone does not establish profitability "
    "or persistent performance."
)
WEAK_PROMOTION_TEXT = (
    "Review promotion timing, store mix and margin before deciding whether to continue promotions."
)
VARIABILITY_LIMIT = 0.5
MIN_PROMOTION_ROWS = 5


def series_suggestions(plan: DataFrame) -> DataFrame:
    """At most one suggestion per series: reorder first, else high variability."""
    reorder = F.col("risk") == REORDER
    mean = F.col("recent_average")
    variable = (mean > 0) & (ratio(F.col("demand_std"), mean) > VARIABILITY_LIMIT)
    stock_evidence = F.concat(
        F.col("inventory_source"), F.lit("; stock "), fixed_text(F.col("inventory_on_hand")),
        F.lit(" < reorder point "), fixed_text(F.col("reorder_point")),
    )
    return plan.where(reorder | variable).select(
        F.lit(1).alias("section"), "store_nbr", "family",
        F.concat(F.lit("Store "), F.col("store_nbr"), F.lit(" / "), F.col("family")).alias("scope"),
        F.when(reorder, stock_evidence).otherwise(F.lit(VARIABLE_EVIDENCE)).alias("evidence"),
        F.when(reorder, F.lit(REORDER_TEXT)).otherwise(F.lit(VARIABLE_TEXT)).alias("recommendation"),
    )


def top_store_suggestion(stores: DataFrame) -> DataFrame:
    """The store with the highest volume; equal volumes go to the lowest number."""
    top = stores.orderBy(F.desc("total_sales"), "store_nbr").limit(1)
    volume = fixed_text(F.col("total_sales"), thousands=True)
    return top.select(
        F.lit(2).alias("section"), "store_nbr", F.lit("").alias("family"),
        F.concat(F.lit("Store "), F.col("store_nbr")).alias("scope"),
        F.concat(F.lit("Highest observed sales volume: "), volume).alias("evidence"),
        F.lit(TOP_STORE_TEXT).alias("recommendation"),
    )


def promotion_suggestions(promotions: DataFrame) -> DataFrame:
    """Families whose promoted rows did not sell more, given enough rows in both groups."""
    group_size = F.least("promoted_rows", "nonpromoted_rows")
    weak = (F.col("lift_pct") <= 0) & (group_size >= MIN_PROMOTION_ROWS)
    return promotions.where(weak).select(
        F.lit(3).alias("section"), F.lit(0).cast("bigint").alias("store_nbr"), "family",
        F.col("family").alias("scope"),
        F.concat(
            F.lit("Observed promotion lift "), fixed_text(F.col("lift_pct")), F.lit("%")
        ).alias("evidence"),
        F.lit(WEAK_PROMOTION_TEXT).alias("recommendation"),
    )


def ranked_suggestions(plan: DataFrame, stores: DataFrame, promotions: DataFrame) -> DataFrame:
    """All suggestions with the columns that order them: section, store and family."""
    return (
        series_suggestions(plan)
        .unionByName(top_store_suggestion(stores))
        .unionByName(promotion_suggestions(promotions))
    )


def in_review_order(ranked: DataFrame) -> DataFrame:
    """Series suggestions in (store, family) order, then the top store, then promotions."""
    return ranked.orderBy("section", "store_nbr", "family").select(
        "scope", "evidence", "recommendation"
    )


def recommendations(plan: DataFrame, stores: DataFrame, promotions: DataFrame) -> DataFrame:
    return in_review_order(ranked_suggestions(plan, stores, promotions))


def with_scope_text(suggestions: DataFrame, text: str) -> DataFrame:
    """Suggestions whose scope contains the searched text."""
    return suggestions.where(F.contains("scope", F.lit(text)))
