"""Population-stability drift reports against a frozen reference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbline.errors import DataError
from kerbline.functions.quantiles import exact_quantiles, long_form
from kerbline.operators.features import shift_transform
from kerbline.operators.splits import chronological_cut
from kerbline.shared import saved

# Fixed values.
FEATURES = ["traffic_volume", "temp", "rain_occurrence", "clouds_all", "hour"]
ALERT = 0.20
MODERATE = 0.10
EMPTY_SHARE = 0.0001
BINS = 10
HASH_SPAN = 1 << 30
NORMAL = "Normal simulated sample"
SHIFTED = "Shifted alert-test sample"


def occurrence_recode(df: DataFrame, column: str = "rain_1h", name: str = "rain_occurrence") -> DataFrame:
    """A zero-inflated amount is monitored as whether it occurred."""
    return df.withColumn(name, F.when(F.col(column).isNotNull(), (F.col(column) > 0).cast("int")))


def psi_bin_edges(reference: DataFrame, features: list[str], bins: int = BINS) -> DataFrame:
    """Per feature: distinct reference quantiles, or equal widths when fewer than three are left.

    ``edges`` are the finite edges; the first and last stand for minus and plus infinity.
    """
    steps = [i / bins for i in range(bins + 1)]
    quantiles = exact_quantiles(reference, features, steps).select("feature", F.array_distinct(F.array_sort("q")).alias("u"))
    return quantiles.select("feature", edges_of("u", bins).alias("edges"))


def edges_of(distinct: str, bins: int = BINS) -> Column:
    """Edges from distinct quantiles in order: themselves, or equal widths when they are fewer than three."""
    low, high = F.element_at(distinct, 1), F.element_at(distinct, -1)
    flat = low == high
    lo, hi = F.when(flat, low - 0.5).otherwise(low), F.when(flat, high + 0.5).otherwise(high)
    even = F.array(*[lo + (hi - lo) * F.lit(float(i)) / F.lit(float(bins)) for i in range(bins)], hi)
    return F.when(F.size(distinct) < 3, even).otherwise(F.col(distinct))


def bin_of(bins: int = BINS) -> Column:
    """Bin of ``v`` in ``edges``: 1 + interior edges at or below it; the outer edges are open."""
    steps = [f"CASE WHEN size(edges) > {i + 1} AND get(edges, {i}) <= v THEN 1 ELSE 0 END" for i in range(1, bins)]
    return F.expr(" + ".join(["1", *steps]))


def bin_counts(bins: int = BINS) -> Column:
    """Rows per bin as an array aggregate."""
    return F.expr(f"array({', '.join(f'count_if(bin = {i})' for i in range(1, bins + 1))})")


def bin_profile(df: DataFrame, edges: DataFrame, by: list[str], features: list[str], bins: int = BINS) -> DataFrame:
    """(by..., feature, n, mean, counts); the edge table has one row per feature."""
    placed = long_form(df, features, by).join(F.broadcast(edges), "feature").withColumn("bin", bin_of(bins))
    return placed.groupBy(*by, "feature").agg(
        F.count("v").alias("n"), F.avg("v").alias("mean"), bin_counts(bins).alias("counts")
    )


def reference_profile(reference: DataFrame, features: list[str], bins: int = BINS) -> DataFrame:
    """What monitoring has to remember: (feature, edges, reference_mean, reference_counts, reference_rows)."""
    edges = saved(psi_bin_edges(reference, features, bins))
    profile = bin_profile(reference, edges, [], features, bins)
    frozen = edges.join(F.broadcast(profile), "feature").select(
        "feature",
        "edges",
        F.col("mean").alias("reference_mean"),
        F.col("counts").alias("reference_counts"),
        F.col("n").alias("reference_rows"),
    )
    return saved(frozen)


def psi_value() -> Column:
    """Index from ``counts``/``n`` against ``reference_counts``/``reference_rows`` over the existing bins."""
    current = f"IF(counts[i] = 0, {EMPTY_SHARE}D, counts[i] / n)"
    before = f"IF(reference_counts[i] = 0, {EMPTY_SHARE}D, reference_counts[i] / reference_rows)"
    terms = f"transform(sequence(0, size(edges) - 2), i -> ({current} - {before}) * ln({current} / {before}))"
    return F.expr(f"aggregate({terms}, 0D, (total, term) -> total + term)")


def psi_against(frozen: DataFrame, current: DataFrame, by: list[str], features: list[str], bins: int = BINS) -> DataFrame:
    """(by..., feature, reference_mean, current_mean, current_rows, psi) against a frozen reference profile."""
    profile = bin_profile(current, frozen.select("feature", "edges"), by, features, bins)
    return profile.join(F.broadcast(frozen), "feature").select(
        *by,
        "feature",
        "reference_mean",
        F.col("mean").alias("current_mean"),
        F.col("n").alias("current_rows"),
        psi_value().alias("psi"),
    )


def psi(reference: DataFrame, current: DataFrame, features: list[str], by: list[str], bins: int = BINS) -> DataFrame:
    return psi_against(reference_profile(reference, features, bins), current, by, features, bins)


def drift_level(value: Column) -> Column:
    return (
        F.when(value < MODERATE, "No material drift").when(value < ALERT, "Moderate change").otherwise("Material drift")
    )


def any_alert(rows: DataFrame, scenario: str = "Scenario") -> DataFrame:
    """Write to every row whether any feature of its scenario alerts."""
    alert = F.max((F.col("Feature_Status") == "ALERT").cast("int")).over(Window.partitionBy(scenario))
    return rows.withColumn(
        "Overall_Status", F.when(alert == 1, "ALERT / Requires investigation").otherwise("PASS / Normal")
    )


def report(scores: DataFrame, scenario: str = "Scenario") -> DataFrame:
    """Levels and statuses judged on the unrounded index, numbers shown with four decimals."""
    judged = scores.select(
        scenario,
        F.col("feature").alias("Feature"),
        F.bround("reference_mean", 4).alias("Reference_Mean"),
        F.bround("current_mean", 4).alias("Current_Mean"),
        F.bround("psi", 4).alias("PSI"),
        drift_level(F.col("psi")).alias("Drift_Level"),
        F.when(F.col("psi") >= ALERT, "ALERT").otherwise("PASS").alias("Feature_Status"),
        F.lit(ALERT).alias("Threshold"),
    )
    return any_alert(judged, scenario)


def reference_rows(df: DataFrame, order: list[str]) -> DataFrame:
    """The first 80 percent in time order; a reference that cannot fill its bins is an error."""
    total = df.count()
    if int(total * 0.80) < BINS:
        raise DataError(f"{total} rows leave fewer reference rows than bins ({BINS})")
    return df.where(chronological_cut(df, order, 0.80, total))


def monitored_rows(reference: DataFrame, keys: list[str], share: float = 1.0) -> DataFrame:
    """The rows judged against the reference: all of them, or a stated share by key hash, however large the table."""
    if share >= 1.0:
        return reference
    return reference.where(F.pmod(F.xxhash64(*keys), F.lit(HASH_SPAN)) < int(share * HASH_SPAN))


def scenarios(sample: DataFrame) -> DataFrame:
    """The normal sample and its deliberately shifted copy, stacked under ``Scenario``."""
    typed = sample.withColumn("traffic_volume", F.col("traffic_volume").cast("double"))
    return typed.withColumn("Scenario", F.lit(NORMAL)).unionByName(
        shift_transform(typed).withColumn("Scenario", F.lit(SHIFTED))
    )


def drift_report(
    df: DataFrame, order: list[str], keys: list[str], share: float = 1.0, features: list[str] | None = None
) -> DataFrame:
    """A share (default all) of the first 80 percent of the table, and its shifted copy, judged against those 80 percent."""
    features = features or FEATURES
    needed = ["traffic_volume", "temp", "rain_1h", "clouds_all", "hour"]
    rows = df.select(*dict.fromkeys([*order, *keys, *needed]))
    reference = reference_rows(rows, order)
    current = occurrence_recode(scenarios(monitored_rows(reference, keys, share)))
    return report(psi(occurrence_recode(reference), current, features, ["Scenario"]))


def summary_lines(results: DataFrame, scenario_order: list[str], feature_order: list[str]) -> DataFrame:
    """Ordered text lines (line_no, line): per scenario a status line, its feature lines and a blank."""
    names = F.array(*[F.lit(s) for s in scenario_order])
    features = F.array(*[F.lit(f) for f in feature_order])
    block = len(feature_order) + 2
    at = (F.array_position(names, F.col("Scenario")) - 1) * block
    line = F.format_string(
        "  %s: PSI=%.4f, %s, %s", F.col("Feature"), F.col("PSI"), F.col("Drift_Level"), F.col("Feature_Status")
    )
    body = results.select(
        (at + 1 + F.array_position(features, F.col("Feature"))).alias("line_no"), line.alias("line")
    )
    heads = results.groupBy("Scenario").agg(F.first("Overall_Status").alias("status"))
    head = heads.select((at + 1).alias("line_no"), F.format_string("%s: %s", F.col("Scenario"), F.col("status")).alias("line"))
    blank = heads.select((at + block).alias("line_no"), F.lit("").alias("line"))
    lines = head.unionByName(body).unionByName(blank)
    return lines.withColumn("line_no", F.col("line_no").cast("int"))
