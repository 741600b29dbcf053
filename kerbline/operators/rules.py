"""Frequent itemsets and association rules over categorical columns."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbline.functions import calendar
from kerbline.shared import attach

# Fixed values.
MIN_SUPPORT = 0.02
ITEM_COLUMNS = ["Time", "Day", "Weather", "Congestion"]
TARGET = "Congestion="


def transactions(df: DataFrame, weather: str = "weather") -> DataFrame:
    """The four item columns of every row."""
    return df.select(
        calendar.time_band().alias("Time"),
        calendar.day_type().alias("Day"),
        F.col(weather).alias("Weather"),
        F.col("congestion_quartile").alias("Congestion"),
    )


def _item(column: str) -> Column:
    return F.when(F.col(column).isNotNull(), F.concat(F.lit(column + "="), F.col(column)))


def basket_build(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Each row's items as a sorted array of ``Column=value`` texts."""
    columns = columns or ITEM_COLUMNS
    return df.select(F.array_sort(F.array_compact(F.array(*[_item(c) for c in columns]))).alias("items"))


def frequent_itemsets(df: DataFrame, columns: list[str] | None = None, min_support: float = MIN_SUPPORT) -> DataFrame:
    """All itemsets with enough support, as (itemset, items, size, records, support).

    Rows are first reduced to counted distinct tuples, which is all that the cube expands.
    """
    columns = columns or ITEM_COLUMNS
    tuples = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    total = tuples.agg(F.sum("n").cast("double").alias("total"))
    items = tuples.select("n", *[_item(c).alias(c) for c in columns])
    cube = items.cube(*columns).agg(F.grouping_id().alias("gid"), F.sum("n").alias("records"))
    # A null that the cube did not put there is a missing value, not an item.
    size = len(columns)
    complete = F.lit(True)
    for i, c in enumerate(columns):
        rolled_up = F.expr(f"(shiftright(gid, {size - 1 - i}) & 1) = 1")
        complete = complete & (rolled_up | F.col(c).isNotNull())
    kept = attach(cube.where((F.col("gid") != 2**size - 1) & complete), total)
    members = F.array_sort(F.array_compact(F.array(*columns)))
    return kept.select(
        F.concat_ws(", ", members).alias("itemset"),
        members.alias("items"),
        F.size(members).alias("size"),
        "records",
        (F.col("records") / F.col("total")).alias("support"),
    ).where(F.col("support") >= min_support)


def basket_itemsets(baskets: DataFrame, items: str = "items", min_support: float = MIN_SUPPORT) -> DataFrame:
    """The same for baskets of any length, by FP-growth."""
    total = baskets.count()
    found = FPGrowth(itemsCol=items, minSupport=min_support).fit(baskets).freqItemsets
    members = F.array_sort("items")
    return found.select(
        F.concat_ws(", ", members).alias("itemset"),
        members.alias("items"),
        F.size(members).alias("size"),
        F.col("freq").alias("records"),
        (F.col("freq") / F.lit(float(total))).alias("support"),
    )


def rule_metrics(a: Column, c: Column, s: Column) -> dict[str, Column]:
    """Rule measures from the antecedent, consequent and joint support."""
    confidence = s / a
    leverage = s - a * c
    spread = F.greatest(s * (1 - a), a * (c - s))
    return {
        "antecedent_support": a,
        "consequent_support": c,
        "support": s,
        "confidence": confidence,
        "lift": confidence / c,
        "representativity": F.lit(1.0),
        "leverage": leverage,
        "conviction": F.when(confidence >= 1, F.lit(float("inf"))).otherwise((1 - c) / (1 - confidence)),
        "zhangs_metric": F.when(spread == 0, 0.0).otherwise(leverage / spread),
        "jaccard": s / (a + c - s),
        "certainty": F.when(c >= 1, 0.0).otherwise((confidence - c) / (1 - c)),
        "kulczynski": (confidence + s / c) / 2,
    }


def association_rules(itemsets: DataFrame, min_lift: float = 1.0, min_support: float = MIN_SUPPORT) -> DataFrame:
    """Every split of a frequent itemset into antecedent and consequent with enough lift.

    At most 1/min_support itemsets exist per column subset, so the lookup tables are small.
    """
    lookup = itemsets.select("itemset", "support")
    masks = F.explode(F.sequence(F.lit(1), (F.pow(F.lit(2), F.col("size")) - 2).cast("int")))
    splits = itemsets.where("size >= 2").select("items", F.col("support").alias("s"), masks.alias("mask"))
    splits = splits.select(
        "s",
        F.expr("filter(items, (x, i) -> (shiftright(mask, i) & 1) = 1)").alias("left_items"),
        F.expr("filter(items, (x, i) -> (shiftright(mask, i) & 1) = 0)").alias("right_items"),
    ).select(
        "s",
        "left_items",
        "right_items",
        F.concat_ws(", ", "left_items").alias("antecedents"),
        F.concat_ws(", ", "right_items").alias("consequents"),
    )
    left = lookup.select(F.col("itemset").alias("antecedents"), F.col("support").alias("a"))
    right = lookup.select(F.col("itemset").alias("consequents"), F.col("support").alias("c"))
    measured = splits.join(left, "antecedents").join(right, "consequents")
    measures = rule_metrics(F.col("a"), F.col("c"), F.col("s"))
    return measured.select(
        "antecedents", "consequents", "left_items", "right_items", *[m.alias(n) for n, m in measures.items()]
    ).where(F.col("lift") >= min_lift)


def rule_filter(rules: DataFrame, target: str = TARGET) -> DataFrame:
    """Rules with one consequent item of the target column and none of it in the antecedent."""
    return rules.where(
        (F.size("right_items") == 1)
        & F.forall("right_items", lambda x: x.startswith(target))
        & ~F.exists("left_items", lambda x: x.startswith(target))
    )


def congestion_rules(rules: DataFrame, n: int = 10, target: str = TARGET) -> DataFrame:
    """Top rules by lift, confidence and support."""
    return (
        rule_filter(rules, target)
        .orderBy(F.col("lift").desc(), F.col("confidence").desc(), F.col("support").desc(), "antecedents", "consequents")
        .limit(n)
        .select(F.col("antecedents").alias("Antecedent"), F.col("consequents").alias("Consequent"), "support", "confidence", "lift")
    )
