"""Distribution statistics, probabilities and histograms; every operator is a few partial aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbline.functions.quantiles import exact_quantiles
from kerbline.shared import attach

# Fixed values.
CONGESTED_VOLUME = 5500
WARM_KELVIN = 292
HISTOGRAM_BINS = 35


def skew_adjusted(column: str) -> Column:
    """Sample-corrected skewness."""
    n = F.count(column).cast("double")
    return F.when(n > 2, F.skewness(column) * F.sqrt(n * (n - 1)) / (n - 2))


def describe_measure(df: DataFrame, measure: str = "traffic_volume") -> DataFrame:
    moments = df.agg(
        F.avg(measure).alias("mean"),
        F.stddev_samp(measure).alias("std_sample"),
        F.stddev_pop(measure).alias("std_population"),
        F.var_samp(measure).alias("var_sample"),
        F.var_pop(measure).alias("var_population"),
        (F.max(measure) - F.min(measure)).alias("value_range"),
    )
    median = exact_quantiles(df, [measure], [0.5]).select(F.col("q")[0].alias("median"))
    return attach(moments, median)


def skewness_adjusted(df: DataFrame, measure: str = "traffic_volume") -> DataFrame:
    return df.agg(skew_adjusted(measure).alias("skewness"))


def pearson_corr(df: DataFrame, a: str = "temp", b: str = "traffic_volume") -> DataFrame:
    return df.agg(F.corr(a, b).alias("correlation"))


def _events(weather: str = "weather") -> dict[str, Column]:
    return {
        "congestion": F.col("traffic_volume") > CONGESTED_VOLUME,
        "clear": F.col(weather) == "Clear",
        "warm": F.col("temp") > WARM_KELVIN,
    }


def _ratio(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def event_probabilities(df: DataFrame, weather: str = "weather") -> DataFrame:
    e = _events(weather)
    n, jam = F.count(F.lit(1)), F.count_if(e["congestion"])
    return df.agg(
        _ratio(jam, n).alias("p_congestion"),
        _ratio(F.count_if(e["clear"]), n).alias("p_clear"),
        _ratio(F.count_if(e["congestion"] & e["clear"]), n).alias("p_congestion_and_clear"),
        _ratio(F.count_if(e["congestion"] & e["clear"]), jam).alias("p_clear_given_congestion"),
        _ratio(F.count_if(e["congestion"] & e["warm"]), jam).alias("p_warm_given_congestion"),
    )


def independence_check(df: DataFrame, weather: str = "weather") -> DataFrame:
    p = event_probabilities(df, weather)
    product = F.col("p_congestion") * F.col("p_clear")
    return p.select(
        F.col("p_congestion_and_clear").alias("p_joint"),
        product.alias("p_product"),
        (F.col("p_congestion_and_clear") - product).alias("difference"),
    )


def odds_ratio(df: DataFrame, weather: str = "weather", first: str = "Clear", second: str = "Clouds") -> DataFrame:
    jam = _events(weather)["congestion"]

    def odds(category: str) -> Column:
        here = F.col(weather) == category
        return _ratio(F.count_if(here & jam), F.count_if(here & ~jam))

    table = df.agg(odds(first).alias("odds_first"), odds(second).alias("odds_second"))
    return table.withColumn("odds_ratio", F.try_divide("odds_first", "odds_second"))


def histogram(df: DataFrame, measure: str = "traffic_volume", bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins over [min, max], last bin closed, empty bins kept."""
    span = df.agg(F.min(measure).cast("double").alias("lo"), F.max(measure).cast("double").alias("hi"))
    # A constant measure is given a unit-wide span around its value.
    flat = F.col("lo") == F.col("hi")
    span = span.select(
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    ).where("lo is not null")
    value = F.col(measure).cast("double")
    placed = attach(df.select(measure).where(value.isNotNull()), span)
    bin_of = F.least(F.width_bucket(value, F.col("lo"), F.col("hi"), F.lit(bins)), F.lit(bins))
    counts = placed.groupBy(bin_of.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    width = (F.col("hi") - F.col("lo")) / bins
    every = span.select("lo", "hi", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    return every.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (F.col("lo") + (F.col("bin") - 1) * width).alias("left_edge"),
        F.when(F.col("bin") == bins, F.col("hi")).otherwise(F.col("lo") + F.col("bin") * width).alias("right_edge"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("records"),
    )


def histogram_mode_above_median(df: DataFrame, measure: str = "traffic_volume", bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Edges of the fullest bin that starts above the median; the first bin when there is none."""
    median = exact_quantiles(df, [measure], [0.5]).select(F.col("q")[0].alias("median"))
    upper = attach(histogram(df, measure, bins), median)
    weight = F.when(F.col("left_edge") > F.col("median"), F.col("records")).otherwise(F.lit(0))
    order = F.struct(weight.alias("w"), (-F.col("bin")).alias("b"))
    return upper.agg(
        F.max_by("bin", order).alias("bin"),
        F.max_by("left_edge", order).alias("mode_low"),
        F.max_by("right_edge", order).alias("mode_high"),
        F.first("median").alias("median"),
    )


def distribution_shape(df: DataFrame, measure: str = "traffic_volume", bins: int = HISTOGRAM_BINS) -> DataFrame:
    mode = histogram_mode_above_median(df, measure, bins)
    moments = df.agg(F.avg(measure).alias("mean"), skew_adjusted(measure).alias("skewness"))
    return attach(mode, moments)


def cutoff_summary(df: DataFrame, measure: str = "traffic_volume", scaled: list[str] | None = None) -> DataFrame:
    """Quartile thresholds and scaling parameters as (name, value) rows."""
    from kerbline.operators.features import quartile_edges, scale_statistics

    scaled = scaled or ["temp", "traffic_volume"]
    edges = quartile_edges(df, measure).select("q1", "q2", "q3")
    stats = scale_statistics(df, scaled)
    wide = attach(edges, stats)
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in wide.columns])
    return wide.select(F.inline(pairs))
