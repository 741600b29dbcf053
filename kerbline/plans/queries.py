"""Every operator as a named query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbline.functions import calendar, text
from kerbline.operators import (
    cleaning, cluster, describe, drift, evaluate, explain, features, lloyd, models, network,
    quality, recommend, reference_store, rules, runs, score, splits, stats, treeshap,
)
from kerbline.plans import landed
from kerbline.shared import attach, fresh_path, saved
from kerbline.sources import records, tables
from kerbline.sources.fixture import KEY, RAW_COLUMNS, derive_raw, read, traffic_raw, traffic_text
from kerbline.streaming import jobs, lateness

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORDER = ["date_time", *KEY]
DAY = "2013-02-11"
# The library default is 200 trees.
QUERY_TREES = 40
SCENARIOS = [
    dict(Scenario="Weekday travel during rain", day_type="Weekday", weather="Rain"),
    dict(Scenario="Weekend travel in clear weather", day_type="Weekend", weather="Clear"),
    dict(Scenario="Weekday travel during squall conditions", day_type="Weekday", weather="Squall"),
]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles so that the order of a floating sum does not show."""
    fixed = {}
    for name, dtype in df.dtypes:
        if dtype == "double":
            rounded = F.round(F.col(name), digits)
            fixed[name] = F.when(rounded == 0, F.lit(0.0)).otherwise(rounded)
    return df.withColumns(fixed) if fixed else df


# Sources and sinks


@query
def csv_scan_raw(spark, sf_dir):
    path = fresh_path(spark, "raw-csv")
    columns = ["event_id", *RAW_COLUMNS]
    tables.write_table(traffic_text(spark, sf_dir).select(*columns), path, "csv")
    return tables.csv_scan_raw(spark, path, columns).drop(tables.CORRUPT)


@query
def csv_records(spark, sf_dir):
    """The raw CSV with line breaks and quotes inside some descriptions, cut into records in parallel."""
    path = fresh_path(spark, "broken-csv")
    columns = ["event_id", *RAW_COLUMNS]
    told = F.concat("weather_description", F.lit('\nseen "twice", twice'))
    broken = traffic_text(spark, sf_dir).withColumn("weather_description", F.when(F.col("event_id") % 17 == 0, told).otherwise(F.col("weather_description")))
    tables.write_table(broken.select(*columns), path, "csv")
    return records.csv_records(spark, path, columns).drop(tables.CORRUPT)


@query
def feature_scan(spark, sf_dir):
    landed.features(spark, sf_dir)
    path = landed.path_of(spark, sf_dir, "features")
    return tidy(tables.read_table(spark, path, ["date_time", *drift.FEATURES[:2], "rain_1h", "clouds_all", "hour"]))


@query
def table_scan(spark, sf_dir):
    view = tables.register(landed.traffic(spark, sf_dir), "traffic")
    return spark.sql(
        f"SELECT weather_main, count(*) AS records, sum(traffic_volume) AS total_volume FROM {view} GROUP BY weather_main"
    )


@query
def table_sink(spark, sf_dir):
    path = fresh_path(spark, "by-year")
    dated = landed.traffic(spark, sf_dir).withColumn("year", F.year("date_time"))
    tables.write_table(dated, path, partition_by=["year"])
    return tables.read_table(spark, path, [*KEY, "year", "date_time", "traffic_volume"])


@query
def report_sink(spark, sf_dir):
    folder = fresh_path(spark, "reports")
    report = tidy(recommend.pattern_hour(landed.features(spark, sf_dir)))
    path = tables.write_report(report, folder, "pattern_hour")
    return spark.read.schema(report.schema).option("header", True).csv(path)


@query
def text_summary_sink(spark, sf_dir):
    results = saved(drift_report(spark, sf_dir))
    lines = drift.summary_lines(results, [drift.NORMAL, drift.SHIFTED], drift.FEATURES)
    tables.write_lines(lines, fresh_path(spark, "summary"))
    return lines


@query
def model_store(spark, sf_dir):
    rows = _model_rows(spark, sf_dir)
    model = models.linear_regressor(rows)
    path = fresh_path(spark, "model")
    models.save_model(model, path, {"target": "traffic_volume", "features": ",".join(features.model_columns())})
    again, _ = models.load_model(path)
    before = models.predict_batch(model, rows).select(*KEY, F.col("prediction").alias("before"))
    after = models.predict_batch(again, rows).select(*KEY, F.col("prediction").alias("after"))
    gap = F.abs(F.col("before") - F.col("after"))
    return before.join(after, KEY).agg(F.count(F.lit(1)).alias("rows"), F.max(gap).alias("largest_gap"))


# Schema and quality


@query
def schema_check(spark, sf_dir):
    return quality.schema_check(traffic_raw(spark, sf_dir), [*RAW_COLUMNS, "station"])


@query
def table_profile(spark, sf_dir):
    return quality.table_profile(traffic_raw(spark, sf_dir).select(*RAW_COLUMNS))


@query
def table_head(spark, sf_dir):
    return quality.head(landed.traffic(spark, sf_dir), ORDER, 5)


@query
def duplicate_count(spark, sf_dir):
    return quality.duplicate_count(traffic_raw(spark, sf_dir), RAW_COLUMNS)


@query
def year_coverage(spark, sf_dir):
    return quality.year_coverage(traffic_raw(spark, sf_dir))


@query
def date_validity(spark, sf_dir):
    return quality.date_validity(traffic_text(spark, sf_dir))


@query
def numeric_validity(spark, sf_dir):
    return quality.numeric_validity(traffic_text(spark, sf_dir), list(cleaning.NUMERIC))


@query
def null_gate(spark, sf_dir):
    typed = cleaning.parse_numeric(traffic_text(spark, sf_dir))
    monitored = ["traffic_volume", "temp", "rain_1h", "clouds_all"]
    return quality.null_counts(typed, monitored)


@query
def one_hot_check(spark, sf_dir):
    f = landed.features(spark, sf_dir)
    return quality.one_hot_check(f, features.flag_columns(f.drop("weather_main")))


@query
def cleaning_audit(spark, sf_dir):
    return cleaning.cleaning_audit(traffic_text(spark, sf_dir))


@query
def range_quarantine(spark, sf_dir):
    checked = quality.range_quarantine(cleaning.parse_numeric(traffic_text(spark, sf_dir)).transform(cleaning.parse_timestamp))
    return checked.select("event_id", "weather_description", F.concat_ws("; ", "reasons").alias("reasons"), "is_valid")


@query
def median_fill(spark, sf_dir):
    typed = cleaning.parse_numeric(traffic_text(spark, sf_dir))
    columns = ["temp", "rain_1h", "snow_1h", "clouds_all"]
    doubles = typed.select("event_id", "weather_description", *[F.col(c).cast("double").alias(c) for c in columns])
    return tidy(quality.median_fill(doubles, columns))


# Cleaning


@query
def fill_missing_category(spark, sf_dir):
    return cleaning.fill_missing_category(traffic_text(spark, sf_dir)).select("event_id", "weather_main", "holiday")


@query
def standardise_text(spark, sf_dir):
    filled = cleaning.fill_missing_category(traffic_raw(spark, sf_dir))
    return cleaning.standardise_text(filled).select("event_id", "holiday", "weather_main", "weather_description")


@query
def parse_timestamp(spark, sf_dir):
    return cleaning.parse_timestamp(traffic_text(spark, sf_dir)).select("event_id", "weather_main", "date_time")


@query
def parse_numeric(spark, sf_dir):
    return tidy(cleaning.parse_numeric(traffic_text(spark, sf_dir)).select("event_id", "weather_main", *cleaning.NUMERIC))


@query
def drop_incomplete(spark, sf_dir):
    typed = cleaning.parse_numeric(traffic_text(spark, sf_dir))
    return tidy(cleaning.drop_incomplete(typed).select("event_id", "weather_main", *cleaning.NUMERIC))


@query
def drop_exact_duplicates(spark, sf_dir):
    return tidy(cleaning.drop_exact_duplicates(traffic_raw(spark, sf_dir)))


@query
def impute_by_group_median(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    rule = cleaning.OutlierRule("o_totalprice", lambda c: F.col("o_orderpriority") == "1-URGENT", "flagged")
    fixed = cleaning.impute_by_group_median(orders, [rule], F.month("o_orderdate"), bounded_groups=True)
    return tidy(fixed.select("o_orderkey", "o_totalprice"), 4)


@query
def outlier_rules(spark, sf_dir):
    ready = traffic_raw(spark, sf_dir).transform(cleaning.fill_missing_category).transform(cleaning.standardise_text)
    fixed = ready.transform(cleaning.drop_exact_duplicates).transform(cleaning.repair_outliers)
    return tidy(fixed.select(*KEY, "temp", "rain_1h"))


@query
def clean_traffic(spark, sf_dir):
    return tidy(cleaning.clean(traffic_raw(spark, sf_dir)))


# Scalar features


@query
def calendar_parts(spark, sf_dir):
    return features.calendar_parts(landed.traffic(spark, sf_dir)).select(*KEY, "hour", "day_of_week", "month", "year")


@query
def weekend_flag(spark, sf_dir):
    return features.weekend_flag(landed.traffic(spark, sf_dir)).select(*KEY, "is_weekend")


@query
def cyclical_encode(spark, sf_dir):
    names = ["hour_sin", "hour_cos", "month_sin", "month_cos", "day_of_week_sin", "day_of_week_cos"]
    return tidy(features.cyclical_encode(landed.traffic(spark, sf_dir)).select(*KEY, *names))


@query
def indicator_flags(spark, sf_dir):
    names = ["is_holiday", "is_rainy", "is_snowy", "is_peak_hour"]
    return features.indicator_flags(landed.traffic(spark, sf_dir)).select(*KEY, *names)


@query
def quartile_category(spark, sf_dir):
    return features.quartile_category(landed.traffic(spark, sf_dir).select(*KEY, "traffic_volume"))


@query
def zscore(spark, sf_dir):
    return tidy(features.zscore(landed.traffic(spark, sf_dir).select(*KEY, "temp", "traffic_volume")))


@query
def one_hot_encode(spark, sf_dir):
    rows = landed.traffic(spark, sf_dir).select("event_id", "traffic_volume", "weather_main")
    return features.one_hot_encode(rows)


@query
def one_hot_decode(spark, sf_dir):
    f = landed.features(spark, sf_dir)
    flags = features.flag_columns(f.drop("weather_main", "weather"))
    return features.one_hot_decode(f.select("event_id", "traffic_volume", *flags)).select("event_id", "traffic_volume", "weather")


@query
def feature_table(spark, sf_dir):
    return tidy(features.engineer(landed.traffic(spark, sf_dir)))


@query
def time_of_day_band(spark, sf_dir):
    return landed.features(spark, sf_dir).select(*KEY, calendar.time_band().alias("time_period"))


@query
def label_map(spark, sf_dir):
    return landed.features(spark, sf_dir).select(*KEY, calendar.day_type().alias("day_type"))


@query
def adverse_weather_flag(spark, sf_dir):
    return features.adverse_weather_flag(landed.features(spark, sf_dir)).select(*KEY, "adverse_weather")


@query
def proxy_risk_label(spark, sf_dir):
    flagged = features.adverse_weather_flag(landed.features(spark, sf_dir))
    return features.proxy_risk_label(flagged).select(*KEY, "risk_label")


@query
def window_text(spark, sf_dir):
    hour = F.col("hour")
    return landed.features(spark, sf_dir).select(
        *KEY, text.hour_range(hour).alias("travel_window"), text.hour_mark(hour).alias("recommended_time")
    )


@query
def narrative_text(spark, sf_dir):
    f = landed.features(spark, sf_dir)
    return describe.narrative_text(f, stats.distribution_shape(f))


@query
def shift_transform(spark, sf_dir):
    rows = landed.traffic(spark, sf_dir).select(*KEY, "traffic_volume", "temp", "clouds_all", "rain_1h")
    return tidy(features.shift_transform(rows.withColumn("traffic_volume", F.col("traffic_volume").cast("double"))))


# Filters


@query
def year_range_filter(spark, sf_dir):
    kept = landed.traffic(spark, sf_dir).where(calendar.years_between("date_time", 2013, 2015))
    return kept.select(*KEY, "date_time", "traffic_volume")


@query
def category_in_filter(spark, sf_dir):
    kept = landed.traffic(spark, sf_dir).where(F.col("holiday").isin("New Years Day", "Labor Day"))
    return kept.select(*KEY, "holiday", "date_time")


@query
def date_lookup_filter(spark, sf_dir):
    return describe.date_lookup_filter(landed.traffic(spark, sf_dir), DAY).select(*KEY, "date_time", "traffic_volume")


@query
def hour_window_filter(spark, sf_dir):
    return tidy(recommend.hour_window_filter(recommend.pattern_hour(landed.features(spark, sf_dir)), 6, 22))


@query
def min_evidence_filter(spark, sf_dir):
    return tidy(recommend.min_evidence_filter(recommend.pattern_weather_hour(landed.features(spark, sf_dir))))


# Aggregations


@query
def annual_totals(spark, sf_dir):
    return tidy(describe.annual_totals(landed.traffic(spark, sf_dir)))


@query
def yoy_change(spark, sf_dir):
    return describe.yoy_change(landed.traffic(spark, sf_dir))


@query
def holiday_comparison(spark, sf_dir):
    return describe.holiday_comparison(landed.traffic(spark, sf_dir), ["New Years Day", "Labor Day"])


@query
def hourly_by_daytype(spark, sf_dir):
    return tidy(describe.hourly_by_daytype(landed.features(spark, sf_dir)))


@query
def hourly_pivot(spark, sf_dir):
    return tidy(describe.hourly_pivot(landed.features(spark, sf_dir)))


@query
def hourly_peaks(spark, sf_dir):
    return tidy(describe.hourly_peaks(landed.features(spark, sf_dir)))


@query
def weather_summary(spark, sf_dir):
    return tidy(describe.weather_extremes(landed.features(spark, sf_dir)))


@query
def date_hourly_summary(spark, sf_dir):
    return describe.date_hourly_summary(landed.features(spark, sf_dir), DAY)


@query
def daytype_summary(spark, sf_dir):
    return describe.daytype_summary(landed.features(spark, sf_dir))


@query
def pattern_weather_hour(spark, sf_dir):
    return tidy(recommend.pattern_weather_hour(landed.features(spark, sf_dir)))


@query
def pattern_hour(spark, sf_dir):
    return tidy(recommend.pattern_hour(landed.features(spark, sf_dir)))


def _given_clusters(spark, sf_dir) -> DataFrame:
    """Feature rows under a stated labelling: quartile rank, plus 4 in adverse weather, 8 in heavy rain, 9 in heavy snow."""
    f = features.adverse_weather_flag(landed.features(spark, sf_dir))
    rank = F.array_position(F.array(*[F.lit(x) for x in features.QUARTILE_LABELS]), F.col("congestion_quartile")) - 1
    label = (
        F.when(F.col("rain_1h") >= 3, 8).when(F.col("snow_1h") >= 0.4, 9).otherwise(rank + F.col("adverse_weather") * 4)
    )
    return f.withColumn("cluster", label.cast("int"))


@query
def cluster_profiles(spark, sf_dir):
    return tidy(cluster.cluster_profiles(_given_clusters(spark, sf_dir)))


@query
def label_balance(spark, sf_dir):
    rows = features.proxy_risk_label(features.adverse_weather_flag(landed.features(spark, sf_dir)))
    return describe.label_balance(rows, "risk_label")


@query
def kpi_cards(spark, sf_dir):
    f = landed.features(spark, sf_dir)
    return tidy(describe.kpi(f, (F.col("is_peak_hour") == 1) & F.col("weather").isin("Clear", "Clouds")))


@query
def daily_trend(spark, sf_dir):
    return tidy(describe.daily_trend(landed.traffic(spark, sf_dir)))


@query
def temperature_profile(spark, sf_dir):
    return tidy(describe.temperature_profile(landed.traffic(spark, sf_dir)))


@query
def describe_measure(spark, sf_dir):
    return tidy(stats.describe_measure(landed.traffic(spark, sf_dir)), 4)


@query
def pearson_corr(spark, sf_dir):
    return tidy(stats.pearson_corr(landed.traffic(spark, sf_dir)))


@query
def event_probabilities(spark, sf_dir):
    return tidy(stats.event_probabilities(landed.features(spark, sf_dir)))


@query
def independence_check(spark, sf_dir):
    return tidy(stats.independence_check(landed.features(spark, sf_dir)))


@query
def odds_ratio(spark, sf_dir):
    return tidy(stats.odds_ratio(landed.features(spark, sf_dir)))


@query
def skewness_adjusted(spark, sf_dir):
    return tidy(stats.skewness_adjusted(landed.traffic(spark, sf_dir)))


@query
def histogram(spark, sf_dir):
    return tidy(stats.histogram(landed.traffic(spark, sf_dir)))


@query
def histogram_mode_above_median(spark, sf_dir):
    return tidy(stats.histogram_mode_above_median(landed.traffic(spark, sf_dir)))


@query
def cutoff_summary(spark, sf_dir):
    return tidy(stats.cutoff_summary(landed.traffic(spark, sf_dir)))


# Windows, order, sets


@query
def top_n_per_group(spark, sf_dir):
    hourly = describe.hourly_by_daytype(landed.features(spark, sf_dir))
    order = [F.col("average_traffic_volume"), F.col("hour")]
    return tidy(describe.top_n_per_group(hourly, ["is_weekend"], order, 3))


def _runs(spark, sf_dir) -> DataFrame:
    """Run records derived from ``orders``: one run per order, versions by customer."""
    orders = read(spark, sf_dir, "orders")
    key = F.col("o_custkey").cast("string")
    return runs.run_records(
        orders,
        run_id=F.col("o_orderkey"),
        name=F.concat(F.lit("run_"), F.col("o_orderkey").cast("string")),
        tags={
            "solution_version": F.concat(F.lit("v"), F.substring("o_orderpriority", 1, 1)),
            "model_version": F.when(F.col("o_custkey") % 10 != 0, F.concat(F.lit("model_"), key)),
            "candidate_status": F.col("o_orderstatus"),
            "data_version": F.lit("orders_v1"),
        },
        params={"model_type": F.col("o_orderpriority"), "split_method": F.lit("chronological")},
        metrics={"mae": F.col("o_totalprice"), "r2": F.col("o_totalprice") / 1000000},
        status=F.lit("FINISHED"),
        start_time=F.col("o_orderdate").cast("timestamp_ntz"),
    )


@query
def latest_per_key(spark, sf_dir):
    rows = _runs(spark, sf_dir).select("run_id", "run_name", "start_time", F.col("tags")["model_version"].alias("model_version"))
    newest = runs.latest_per_key(rows, F.col("model_version"), [F.col("start_time"), F.col("run_id")])
    return newest.select("key", "run_id", "run_name", "start_time")


@query
def any_alert_broadcast(spark, sf_dir):
    return drift_report(spark, sf_dir).select("Scenario", "Feature", "Feature_Status", "Overall_Status")


@query
def share_of_total(spark, sf_dir):
    groups = landed.traffic(spark, sf_dir).groupBy("weather_main").agg(F.count(F.lit(1)).alias("records"))
    return tidy(describe.share_of_total(groups))


@query
def order_by(spark, sf_dir):
    return tidy(describe.weather_means(landed.features(spark, sf_dir)).orderBy("mean", "weather"))


@query
def top_k_measure(spark, sf_dir):
    return describe.top_k_measure(landed.features(spark, sf_dir), 20, ORDER)


@query
def bottom_k_windows(spark, sf_dir):
    f = landed.features(spark, sf_dir).where("is_weekend = 0")
    return tidy(recommend.bottom_k_windows(recommend.pattern_hour(f), 5))


@query
def distinct_rows(spark, sf_dir):
    return tidy(landed.traffic(spark, sf_dir).select("date_time", "holiday", "temp", "traffic_volume").distinct())


@query
def union_results(spark, sf_dir):
    f = landed.features(spark, sf_dir)
    parts = [
        describe.kpi(f, F.col("is_weekend") == flag).withColumn("day_type", F.lit(name)).withColumn("position", F.lit(flag))
        for flag, name in [(0, "Weekday"), (1, "Weekend")]
    ]
    return tidy(parts[0].unionByName(parts[1]))


# Splits and samples


@query
def random_split(spark, sf_dir):
    return splits.random_split(landed.traffic(spark, sf_dir).select(*KEY), KEY)


@query
def stratified_split(spark, sf_dir):
    rows = features.proxy_risk_label(features.adverse_weather_flag(landed.features(spark, sf_dir)))
    return splits.stratified_split(rows.select(*KEY, "risk_label"), "risk_label", KEY)


@query
def chronological_split(spark, sf_dir):
    return splits.chronological_split(landed.traffic(spark, sf_dir).select(*ORDER), ORDER)


@query
def fixed_size_sample(spark, sf_dir):
    return splits.fixed_size_sample(landed.traffic(spark, sf_dir).select(*KEY, "traffic_volume"), KEY)


# Models


def _model_rows(spark, sf_dir) -> DataFrame:
    return models.training_table(landed.features(spark, sf_dir), KEY)


def _split_fit(spark, sf_dir, fit, split="random"):
    rows = _model_rows(spark, sf_dir)
    if split == "random":
        marked = splits.random_split(rows, KEY)
    elif split == "stratified":
        marked = splits.stratified_split(rows, "risk_label", KEY)
    else:
        marked = splits.chronological_split(rows, ORDER)
    train, test = marked.where("is_train").drop("is_train"), marked.where("NOT is_train").drop("is_train")
    return fit(train), test


def _classifier(spark, sf_dir, fit, name):
    model, test = _split_fit(spark, sf_dir, fit, "stratified")
    scored = saved(models.predict_batch(model, test).select("risk_label", "prediction", "score"))
    metrics = evaluate.classification_metrics(scored, "risk_label", "prediction")
    auc = evaluate.roc_auc(scored, "risk_label", "score")
    return attach(metrics, auc).withColumn("model", F.lit(name))


def _regressor(spark, sf_dir, fit, name, split="random"):
    model, test = _split_fit(spark, sf_dir, fit, split)
    metrics = evaluate.regression_metrics(models.predict_batch(model, test), "traffic_volume", "prediction")
    return metrics.withColumn("model", F.lit(name))


@query
def logistic_classifier(spark, sf_dir):
    return _classifier(spark, sf_dir, models.logistic_classifier, "Logistic Regression")


@query
def forest_classifier(spark, sf_dir):
    return _classifier(spark, sf_dir, models.forest_classifier, "Random Forest")


@query
def linear_regressor(spark, sf_dir):
    return _regressor(spark, sf_dir, models.linear_regressor, "Linear Regression")


@query
def forest_regressor(spark, sf_dir):
    def fit(train):
        return models.forest_regressor(train, trees=QUERY_TREES)

    return _regressor(spark, sf_dir, fit, "Random Forest Regressor")


@query
def boosted_regressor(spark, sf_dir):
    def fit(train):
        return models.boosted_regressor(train, order=ORDER)

    return _regressor(spark, sf_dir, fit, "Boosted Trees", "chronological")


def _network(spark, sf_dir):
    """The network, its chronological test rows and the error of the training mean by hour on them."""
    rows = _model_rows(spark, sf_dir)
    marked = splits.chronological_split(rows, ORDER)
    train, test = marked.where("is_train").drop("is_train"), marked.where("NOT is_train").drop("is_train")
    by_hour = train.groupBy(F.hour("date_time").alias("h")).agg(F.avg("traffic_volume").alias("prediction"))
    guessed = test.join(F.broadcast(by_hour), F.hour("date_time") == F.col("h"))
    hourly = evaluate.regression_metrics(guessed, "traffic_volume", "prediction").select(F.col("mae").alias("hourly_mae"))
    return network.fit_network(train, ORDER), test, hourly


@query
def network_regressor(spark, sf_dir):
    fitted, test, hourly = _network(spark, sf_dir)
    metrics = evaluate.regression_metrics(network.predict(fitted, test), "traffic_volume", "prediction")
    return attach(metrics, hourly).withColumns({"steps": F.lit(fitted.steps), "best_step": F.lit(fitted.best_step), "model": F.lit("Neural Network")})


@query
def network_check(spark, sf_dir):
    """What holds for every fit: the rows judged, the error of the mean by hour on them, and an early stop."""
    fitted, test, hourly = _network(spark, sf_dir)
    metrics = evaluate.regression_metrics(network.predict(fitted, test), "traffic_volume", "prediction")
    return tidy(attach(metrics, hourly).select("rows", "hourly_mae", F.lit(fitted.stopped).alias("stopped_early")), 4)


@query
def predict_batch(spark, sf_dir):
    model, test = _split_fit(spark, sf_dir, models.logistic_classifier, "stratified")
    return models.predict_batch(model, test).select(*KEY, "risk_label", "prediction", "score")


# Evaluation on stated predictions


def _document_scores(spark, sf_dir) -> DataFrame:
    """Labelled documents under a stated score: length as a share of the longest document."""
    documents = read(spark, sf_dir, "documents").select("doc_id", "n_chars")
    longest = documents.agg(F.max("n_chars").cast("double").alias("longest"))
    labels = read(spark, sf_dir, "labels").select("doc_id", "quality")
    joined = attach(labels.join(documents, "doc_id"), longest)
    scored = joined.select("doc_id", "quality", (F.col("n_chars") / F.col("longest")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.05).cast("int"))


def _mean_predictions(spark, sf_dir) -> DataFrame:
    """Feature rows with three stated predictions: mean by hour and day type, by day type, overall."""
    f = landed.features(spark, sf_dir)
    hours = f.groupBy("is_weekend", "hour").agg(F.avg("traffic_volume").alias("by_hour"))
    days = f.groupBy("is_weekend").agg(F.avg("traffic_volume").alias("by_day"))
    overall = f.agg(F.avg("traffic_volume").alias("overall"))
    grouped = f.join(F.broadcast(hours), ["is_weekend", "hour"]).join(F.broadcast(days), "is_weekend")
    return attach(grouped, overall)


@query
def classification_metrics(spark, sf_dir):
    return tidy(evaluate.classification_metrics(_document_scores(spark, sf_dir), "quality", "predicted"))


@query
def roc_auc(spark, sf_dir):
    return tidy(evaluate.roc_auc(_document_scores(spark, sf_dir), "quality", "score"))


@query
def roc_curve(spark, sf_dir):
    return tidy(evaluate.roc_curve(_document_scores(spark, sf_dir), "quality", "score"), 9)


@query
def regression_metrics(spark, sf_dir):
    return tidy(evaluate.regression_metrics(_mean_predictions(spark, sf_dir), "traffic_volume", "by_hour"))


@query
def model_leaderboard(spark, sf_dir):
    rows = _mean_predictions(spark, sf_dir)
    entries = F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("prediction")) for m in ["by_hour", "by_day", "overall"]])
    stacked = rows.select("traffic_volume", F.inline(entries))
    return tidy(evaluate.model_leaderboard(evaluate.regression_metrics(stacked, "traffic_volume", "prediction", ["model"])))


@query
def subgroup_errors(spark, sf_dir):
    rows = _mean_predictions(spark, sf_dir).withColumn("year", F.year("date_time"))
    slices = ["is_weekend", "is_peak_hour", "weather", "is_holiday", "year", "congestion_quartile"]
    return tidy(evaluate.subgroup_errors(rows, slices, "traffic_volume", "by_hour"))


def _explained_forest(spark, sf_dir):
    """The chronological forest, fitted once per session and kept in the shared folder."""

    def fit(train):
        return models.forest_regressor(train, trees=QUERY_TREES)

    path = landed.path_of(spark, sf_dir, "explained-forest")
    if path not in landed.done:
        model, _ = _split_fit(spark, sf_dir, fit, "chronological")
        models.save_model(model, path, {"target": "traffic_volume", "version": score.MODEL_VERSION})
        landed.done.add(path)
    rows = _model_rows(spark, sf_dir)
    test = splits.chronological_split(rows, ORDER).where("NOT is_train").drop("is_train")
    return models.load_model(path)[0], test


@query
def permutation_importance(spark, sf_dir):
    model, test = _explained_forest(spark, sf_dir)
    return explain.permutation_importance(model, test, KEY).orderBy(F.col("importance").desc(), "feature")


@query
def sampled_shapley(spark, sf_dir):
    model, test = _explained_forest(spark, sf_dir)
    return explain.sampled_shapley(model, test, KEY).orderBy(F.col("mean_absolute_contribution").desc(), "feature")


def _explained(spark, sf_dir):
    model, test = _explained_forest(spark, sf_dir)
    leaves = treeshap.leaf_table(model)
    return model, test, leaves, treeshap.contributions(leaves, test, KEY)


@query
def tree_shapley(spark, sf_dir):
    """Exact contributions of all test rows, by input."""
    *_, parts = _explained(spark, sf_dir)
    return treeshap.mean_absolute(parts).orderBy(F.col("mean_absolute_contribution").desc(), "feature")


@query
def tree_shapley_rows(spark, sf_dir):
    """Each test row, and whether its contributions and the base value are its prediction."""
    model, test, leaves, parts = _explained(spark, sf_dir)
    base = treeshap.base_value(leaves)
    told = F.aggregate("contributions", F.lit(float(base)), lambda total, x: total + x)
    scored = models.predict_batch(model, test).select(*KEY, "prediction")
    return parts.join(scored, KEY).select(*KEY, (F.abs(told - F.col("prediction")) < 1e-9 * F.greatest(F.lit(1.0), F.abs("prediction"))).alias("adds_up"))


# Clusters


def _sweep(spark, sf_dir):
    """The vectors, the sweep and the best model; swept once per session and kept in the shared folder."""
    vectors = cluster.cluster_table(landed.features(spark, sf_dir), KEY)
    path = landed.path_of(spark, sf_dir, "kmeans-sweep")
    if path not in landed.done:
        sweep, fitted = cluster.kmeans_sweep(vectors)
        fitted[cluster.select_size(sweep)].save(spark, f"{path}/model")
        sweep.write.mode("overwrite").parquet(f"{path}/sweep")
        landed.done.add(path)
    return vectors, spark.read.parquet(f"{path}/sweep"), lloyd.Centers.load(spark, f"{path}/model")


@query
def kmeans_sweep(spark, sf_dir):
    return _sweep(spark, sf_dir)[1]


@query
def kmeans_select_fit(spark, sf_dir):
    vectors, _, best = _sweep(spark, sf_dir)
    return cluster.cluster_naming(cluster.cluster_profiles(best.transform(vectors)))


@query
def silhouette(spark, sf_dir):
    return tidy(cluster.silhouette(read(spark, sf_dir, "embeddings"), "label", "embedding"))


@query
def cluster_naming(spark, sf_dir):
    named = cluster.cluster_naming(cluster.cluster_profiles(_given_clusters(spark, sf_dir)))
    return named.select("cluster", "records", "cluster_name")


# Rules


def _itemsets(spark, sf_dir) -> DataFrame:
    return rules.frequent_itemsets(rules.transactions(landed.features(spark, sf_dir)))


@query
def basket_build(spark, sf_dir):
    f = landed.features(spark, sf_dir)
    baskets = rules.basket_build(rules.transactions(f))
    return baskets.groupBy(F.concat_ws(", ", "items").alias("basket")).agg(F.count(F.lit(1)).alias("records"))


@query
def frequent_itemsets(spark, sf_dir):
    return tidy(_itemsets(spark, sf_dir).drop("items"))


def _rules(spark, sf_dir) -> DataFrame:
    return rules.association_rules(saved(_itemsets(spark, sf_dir)))


@query
def association_rules(spark, sf_dir):
    return tidy(_rules(spark, sf_dir).drop("left_items", "right_items"))


@query
def rule_filter(spark, sf_dir):
    kept = rules.rule_filter(_rules(spark, sf_dir))
    return tidy(kept.select("antecedents", "consequents", "support", "confidence", "lift"))


@query
def congestion_rules(spark, sf_dir):
    return tidy(rules.congestion_rules(_rules(spark, sf_dir)))


# Recommendations


@query
def recommend_windows(spark, sf_dir):
    """One request per day type and weather found in the data."""
    levels = saved(recommend.patterns(landed.features(spark, sf_dir)))
    seen = levels.where("by_weather").select("Day_Type", "Weather").distinct()
    requests = seen.select(
        F.concat_ws(" ", "Day_Type", "Weather").alias("Scenario"),
        F.col("Day_Type").alias("day_type"),
        F.col("Weather").alias("weather"),
        F.lit(6).alias("earliest_hour"),
        F.lit(22).alias("latest_hour"),
        F.lit(3).alias("windows"),
    )
    return recommend.recommend(requests, levels)


@query
def recommend_scenarios(spark, sf_dir):
    levels = recommend.patterns(landed.features(spark, sf_dir))
    return recommend.recommend(recommend.requests_table(spark, SCENARIOS), levels)


@query
def recommend_unknown(spark, sf_dir):
    """Requests of which one names a weather that was never observed; every request has a row."""
    asked = [*SCENARIOS, dict(Scenario="Weekend travel in a tornado", day_type="Weekend", weather="Tornado")]
    levels = recommend.patterns(landed.features(spark, sf_dir))
    return recommend.answers(recommend.requests_table(spark, asked), levels)


@query
def quiet_hours(spark, sf_dir):
    return describe.quiet_hours(landed.features(spark, sf_dir))


# Drift


def _reference(spark, sf_dir) -> DataFrame:
    rows = landed.features(spark, sf_dir)
    return drift.occurrence_recode(drift.reference_rows(rows, ORDER))


@query
def psi_bin_edges(spark, sf_dir):
    edges = drift.psi_bin_edges(_reference(spark, sf_dir), drift.FEATURES)
    return tidy(edges.select("feature", F.posexplode("edges").alias("position", "edge")))


def _scores(spark, sf_dir) -> DataFrame:
    """Unrounded index of the shifted second half against the first 80 percent."""
    reference = _reference(spark, sf_dir)
    later = features.shift_transform(landed.features(spark, sf_dir).where(calendar.years_between("date_time", 2015, 2017)))
    return drift.psi(reference, drift.occurrence_recode(later), drift.FEATURES, ["is_weekend"])


@query
def psi(spark, sf_dir):
    return tidy(_scores(spark, sf_dir))


@query
def sketched_reference(spark, sf_dir):
    """The index against a reference of daily sketches, the last day added alone: is it within its bound of the exact one on the same edges?"""
    reference, path = _reference(spark, sf_dir), fresh_path(spark, "reference")
    last = reference.agg(F.max(F.to_date("date_time"))).first()[0]
    for part in (F.to_date("date_time") < F.lit(last), F.to_date("date_time") == F.lit(last)):
        reference_store.add_days(reference.where(part), path, "v1", drift.FEATURES)
    sketched = saved(reference_store.frozen_reference(reference_store.merged(spark, path, "v1")))
    later = features.shift_transform(landed.features(spark, sf_dir).where(calendar.years_between("date_time", 2015, 2017)))
    current = drift.bin_profile(drift.occurrence_recode(later), sketched.select("feature", "edges"), ["is_weekend"], drift.FEATURES)
    exact = drift.bin_profile(reference, sketched.select("feature", "edges"), [], drift.FEATURES)
    exact = exact.select("feature", F.col("counts").alias("reference_counts"), F.col("n").alias("reference_rows"))
    judged = current.join(F.broadcast(sketched), "feature").select(
        "is_weekend", "feature", "counts", "n", "edges", drift.psi_value().alias("psi"), reference_store.share_bound().alias("bound")
    )
    both = judged.join(F.broadcast(exact), "feature").withColumn("exact", drift.psi_value())
    return both.select("is_weekend", "feature", (F.abs(F.col("psi") - F.col("exact")) <= F.col("bound") + 1e-9).alias("within_bound"))


@query
def occurrence_recode(spark, sf_dir):
    return drift.occurrence_recode(landed.traffic(spark, sf_dir)).select(*KEY, "rain_occurrence")


@query
def drift_report(spark, sf_dir):
    rows = landed.features(spark, sf_dir)
    return drift.drift_report(rows, ORDER, KEY)


@query
def drift_scenarios(spark, sf_dir):
    rows = landed.features(spark, sf_dir)
    reference = drift.reference_rows(rows.select(*ORDER, "traffic_volume", "temp", "rain_1h", "clouds_all", "hour"), ORDER)
    return tidy(drift.occurrence_recode(drift.scenarios(drift.monitored_rows(reference, KEY))).drop("date_time"))


# Scoring and runs


def _requests(raw: DataFrame) -> DataFrame:
    named = cleaning.standardise_text(cleaning.fill_missing_category(raw))
    return named.withColumn("is_holiday", F.col("holiday") != cleaning.NO_HOLIDAY)


@query
def score_features(spark, sf_dir):
    valid = quality.range_quarantine(_requests(traffic_raw(spark, sf_dir))).where("is_valid")
    return tidy(score.score_features(valid, ["event_id"]))


def _served_model(spark, sf_dir):
    """The explained forest, as it was saved."""
    return _explained_forest(spark, sf_dir)[0]


@query
def score_table(spark, sf_dir):
    return score.score_table(_requests(traffic_raw(spark, sf_dir)), _served_model(spark, sf_dir), KEY)


@query
def experiment_runs(spark, sf_dir):
    path = fresh_path(spark, "runs")
    records = _runs(spark, sf_dir)
    even = F.col("run_id") % 2 == 0
    runs.append_runs(records.where(even), path)
    runs.append_runs(records.where(~even), path)
    stored = spark.read.parquet(path)
    tags = ["solution_version", "model_version", "candidate_status", "data_version"]
    return tidy(
        stored.select(
            "run_id", "run_name", "status", "start_time",
            *[F.col("tags")[t].alias(t) for t in tags],
            *[F.col("params")[p].alias(p) for p in ["model_type", "split_method"]],
            *[F.col("metrics")[m].alias(m) for m in ["mae", "r2"]],
        ),
        9,
    )


@query
def run_comparison(spark, sf_dir):
    return runs.run_comparison(_runs(spark, sf_dir))


# Streaming


def _event_stream(spark, sf_dir) -> DataFrame:
    schema = read(spark, sf_dir, "events").schema
    return derive_raw(jobs.file_stream(spark, f"{sf_dir}/events.parquet", schema))


@query
def score_stream(spark, sf_dir):
    predictions, _ = _streamed(spark, sf_dir)
    return jobs.written(spark, predictions).drop("batch_id")


def _streamed(spark, sf_dir) -> tuple[str, str]:
    """Paths of the predictions and the refused requests of one streaming run."""
    out = [fresh_path(spark, name) for name in ("scores", "refused", "score-state")]
    jobs.score_to(_requests(_event_stream(spark, sf_dir)), _served_model(spark, sf_dir), KEY, *out).awaitTermination()
    return out[0], out[1]


@query
def quarantine_table(spark, sf_dir):
    refused = quality.range_quarantine(_requests(traffic_raw(spark, sf_dir))).where("NOT is_valid")
    return refused.select(*KEY, F.array_join("reasons", "; ").alias("reasons"))


@query
def quarantine_stream(spark, sf_dir):
    _, refused = _streamed(spark, sf_dir)
    return jobs.written(spark, refused).select(*KEY, F.array_join("reasons", "; ").alias("reasons"))


@query
def score_accounting(spark, sf_dir):
    """Every streamed request has one outcome."""
    counted = jobs.accounted(spark, *_streamed(spark, sf_dir))
    return counted.agg(F.sum("predicted").alias("predicted"), F.sum("refused").alias("refused"))


def _monitored(raw: DataFrame) -> DataFrame:
    return drift.occurrence_recode(raw).withColumn("hour", F.hour("date_time"))


def _frozen(spark, sf_dir) -> DataFrame:
    return drift.reference_profile(_reference(spark, sf_dir), drift.FEATURES)


@query
def drift_windows(spark, sf_dir):
    """Batch twin of the stream."""
    return tidy(jobs.drift_windows(_monitored(traffic_raw(spark, sf_dir)), _frozen(spark, sf_dir)))


@query
def drift_stream(spark, sf_dir):
    """The windows that the watermark has closed."""
    windows = jobs.drift_windows(_monitored(_event_stream(spark, sf_dir)), _frozen(spark, sf_dir))
    out, state = fresh_path(spark, "drift"), fresh_path(spark, "drift-state")
    jobs.append_to(windows, out, state).awaitTermination()
    return tidy(spark.read.parquet(out))


@query
def drift_late_rows(spark, sf_dir):
    """Four batches out of order: rows counted in their closed window, and rows that came after it closed."""
    files, windows, late, state = (fresh_path(spark, name) for name in ("disordered", "late-windows", "late-rows", "late-state"))
    events = read(spark, sf_dir, "events")
    events.repartition(4, "event_id").write.parquet(files)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(files)
    rows = _monitored(derive_raw(stream))
    lateness.drift_with_late_rows(rows, _frozen(spark, sf_dir), KEY, windows, late, state).awaitTermination()
    counted = jobs.written(spark, windows).where("feature = 'hour'").select("window_start", F.col("records").alias("n"))
    missed = jobs.written(spark, late).groupBy("window_start").agg(F.count("*").alias("n"))
    everything = counted.unionByName(missed).groupBy("window_start").agg(F.sum("n").alias("records"))
    # The newest row closes all windows that end an hour before it.
    newest = _monitored(traffic_raw(spark, sf_dir)).agg((F.max("date_time") - F.expr("INTERVAL 25 HOURS")).alias("last"))
    return attach(everything, newest).where("window_start <= last").select("window_start", "records")
