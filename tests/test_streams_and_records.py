"""Streams with two outcomes and with late rows, requests without an answer, and CSV records with line breaks."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from kerbline.errors import DataError
from kerbline.operators import cleaning, drift, models, recommend
from kerbline.plans import landed
from kerbline.plans import queries as q
from kerbline.shared import fresh_path
from kerbline.sources import records, tables
from kerbline.sources.fixture import KEY, traffic_raw
from kerbline.streaming import jobs, lateness

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def forest(spark):
    rows = models.training_table(landed.features(spark, SF_DIR), KEY)
    return models.forest_regressor(rows, trees=3, depth=5)


def test_replayed_batches_change_nothing(spark, forest):
    requests = q._requests(traffic_raw(spark, SF_DIR)).withColumn("temp", F.when(F.col("event_id") % 9 == 0, 9.0).otherwise(F.col("temp")))
    source, predictions, refused, state = (fresh_path(spark, n) for n in ("requests", "predictions", "refused", "state"))
    requests.repartition(3).write.parquet(source)

    def run():
        stream = spark.readStream.schema(requests.schema).option("maxFilesPerTrigger", 1).parquet(source)
        jobs.score_to(stream, forest, KEY, predictions, refused, state).awaitTermination()
        return sorted(map(tuple, jobs.accounted(spark, predictions, refused).collect()))

    first = run()
    assert len(first) == 3 and sum(a + b for _, a, b in first) == requests.count()
    assert all(b for *_, b in first)
    # The last batch was not committed: it runs again and replaces what it wrote.
    for name in ("2", ".2.crc"):
        (Path(state.removeprefix("file:")) / "commits" / name).unlink(missing_ok=True)
    assert run() == first
    reasons = jobs.written(spark, refused).select(F.explode("reasons")).distinct().collect()
    assert [r[0] for r in reasons] == ["temp outside 200..350"]


def test_windows_and_late_rows_are_all_rows(spark):
    rows = q._monitored(traffic_raw(spark, SF_DIR)).select(*KEY, "date_time", *drift.FEATURES)
    frozen = q._frozen(spark, SF_DIR)
    source, windows, late, state = (fresh_path(spark, n) for n in ("disordered", "windows", "late", "state"))
    rows.repartition(4, "event_id").write.parquet(source)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    lateness.drift_with_late_rows(stream, frozen, KEY, windows, late, state).awaitTermination()
    closed, missed = jobs.written(spark, windows), jobs.written(spark, late)
    assert missed.count() > 0
    counted = closed.where("feature = 'hour'").select("window_start", F.col("records").alias("n"))
    everything = counted.unionByName(missed.groupBy("window_start").agg(F.count("*").alias("n"))).groupBy("window_start").agg(F.sum("n").alias("n"))
    newest = rows.agg(F.max("date_time") - F.expr("INTERVAL 25 HOURS")).first()[0]
    expected = {r["d"]: r["n"] for r in rows.groupBy(F.date_trunc("day", "date_time").cast("timestamp_ntz").alias("d")).agg(F.count("*").alias("n")).collect()}
    assert {r["window_start"]: r["n"] for r in everything.collect() if r["window_start"] <= newest} == {d: n for d, n in expected.items() if d <= newest}
    # Rows in time, brought together as a batch, give the windows of the stream.
    held = missed.select(F.from_json("row", "event_id bigint, weather_main string").alias("r")).select("r.*")
    in_time = rows.join(held, KEY, "left_anti")
    batch = jobs.drift_windows(in_time, frozen).collect()
    streamed = {(r["window_start"], r["feature"]): r for r in closed.collect()}
    for r in batch:
        if r["window_start"] <= newest:
            other = streamed[r["window_start"], r["feature"]]
            assert (other["records"], other["drift_level"], other["window_end"]) == (r["records"], r["drift_level"], r["window_end"])
            assert other["psi"] == pytest.approx(r["psi"]) and other["current_mean"] == pytest.approx(r["current_mean"])


def test_every_request_has_a_row(spark):
    levels = recommend.patterns(landed.features(spark, SF_DIR))
    asked = recommend.requests_table(
        spark, [dict(Scenario="a", day_type="Weekday", weather="Rain"), dict(Scenario="b", day_type="Weekend", weather="Tornado"), dict(Scenario="c", day_type="Weekend", weather="Clear", earliest_hour=8, latest_hour=9)]
    )
    found = recommend.answers(asked.unionByName(asked), levels)
    rows = {}
    for r in found.collect():
        rows.setdefault(r["Scenario"], []).append(r)
    assert {k: len(v) for k, v in rows.items()} == {"a": 3, "b": 1, "c": 1}
    assert not rows["b"][0]["Answered"] and rows["b"][0]["Evidence_Basis"] == recommend.UNKNOWN_WEATHER
    assert rows["c"][0]["Travel_Window"] == "08:00 to 09:00"
    assert recommend.recommend(asked, levels).count() == 4


def csv_text(rows):
    return "".join(",".join('"' + c.replace('"', '""') + '"' if any(x in c for x in ',"\n') else c for c in row) + "\n" for row in rows)


@pytest.mark.parametrize("block", [64, 700, 10**6])
def test_records_equal_a_read_in_one_piece(spark, tmp_path, monkeypatch, block):
    rows = [(str(k), f"line {k}" + "\nbreak" * (k % 4), 'say "hi"' if k % 3 else "", "x" * (k % 50)) for k in range(300)]
    rows.append(("900", "long " + "\n".join(f"row {k}, part" for k in range(200)), "", "end"))
    for part, own in enumerate((rows[:200], rows[200:])):
        (tmp_path / f"{part}.csv").write_text(csv_text([("a", "b", "c", "d"), *own]))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    spark.conf.set("spark.sql.files.openCostInBytes", "16")
    try:
        found = records.csv_records(spark, str(tmp_path), ["a", "b", "c", "d"]).collect()
        whole = spark.read.schema("a string, b string, c string, d string").option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(map(str, (tuple(r)[:4] for r in found))) == sorted(map(str, map(tuple, whole)))
    assert all(r[tables.CORRUPT] is None for r in found) and len(found) == 301


def test_unreadable_records_are_kept_and_counted(spark, tmp_path):
    columns = tables.RAW_COLUMNS
    good = ["None", "280.5", "0.0", "0.0", "40", "Clear", "sky\nis clear", "2013-01-01 00:00:00", "100"]
    text = csv_text([columns, good]) + "1,2,3\n\n" + csv_text([good])
    (tmp_path / "a.csv").write_text(text)
    found = records.csv_records(spark, str(tmp_path))
    assert found.count() == 3 and found.where(F.col(tables.CORRUPT).isNotNull()).count() == 1
    audit = {(r["step"], r["column"]): r["rows_changed"] for r in cleaning.cleaning_audit(found).collect()}
    assert audit["corrupt_line", "all"] == 1
    with pytest.raises(DataError):
        records.csv_records(spark, str(tmp_path / "absent"))
