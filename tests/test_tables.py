from pathlib import Path

import pytest
from pyspark.sql import functions as F

from support import FAR, HOME, SMALL
from tidewatch.config import RuleConfig, StreamConfig
from tidewatch.functions.messages import iso_string, parse_transactions
from tidewatch.plans import reports
from tidewatch.plans.backfill import backfill
from tidewatch.plans.catalog import QUERIES, damage
from tidewatch.plans.scoring import score_transactions
from tidewatch.schema import ALERT_CSV_SCHEMA, REJECT_SCHEMA, RESULT_SCHEMA, stored_columns
from tidewatch.session import work_dir
from tidewatch.sinks import messages as message_sink
from tidewatch.sinks import tables
from tidewatch.sources import events
from tidewatch.sources.messages import kafka_options, project_records
from tidewatch.sources.tables import load_results, read_parquet_dir

LIVE = RuleConfig()


@pytest.fixture
def scored(txns):
    """Ten rows: three alerts, one of them for two reasons."""
    rows = [(f"c{i}", f"u{i}", i * 61) for i in range(7)]
    rows += [("h", "v", 0, HOME, 20_000.0), ("hl", "v", 600, FAR, 30_000.0)]
    rows += [("l", "v", 1200, HOME, 50.0)]
    df = txns(rows)
    extra = {
        "timestamp": iso_string(F.col("event_time")),
        "city": F.lit("Paris"),
        "transaction_type": F.lit("purchase"),
        "merchant": F.concat(F.lit('A "B", C\\D & '), "transaction_id"),
        "is_seed_fraud": F.lit(None).cast("boolean"),
        "kafka_ts": F.col("event_time"),
    }
    return (
        stored_columns(
            score_transactions(df.withColumns(extra), LIVE).withColumn(
                "processed_at", F.current_timestamp()
            )
        )
    )


def write_all(scored, out, batch_id):
    tables.write_clean(scored, out, batch_id, 7)
    tables.write_alerts(scored, out, batch_id, 3)
    tables.write_alerts_csv(scored, out, batch_id, 3)


def test_tables_read_back(spark, scored, tmp_path):
    out = str(tmp_path)
    write_all(scored, out, 0)
    clean, alerts = load_results(spark, out)
    assert clean.schema == alerts.schema == RESULT_SCHEMA
    assert (clean.count(), alerts.count()) == (7, 3)
    assert {r[0] for r in clean.select("batch_id").distinct().collect()} == {0}
    both = reports.union_results(clean, alerts).drop("processed_at", "batch_id")
    assert both.exceptAll(scored.drop("processed_at")).isEmpty()


def test_a_replayed_batch_changes_nothing(spark, scored, tmp_path):
    out = str(tmp_path)
    for batch_id in (0, 1, 0, 1):
        write_all(scored, out, batch_id)
    clean, alerts = load_results(spark, out)
    assert (clean.count(), alerts.count()) == (14, 6)


def test_csv_copy(spark, scored, tmp_path):
    write_all(scored, str(tmp_path), 0)
    folder = tmp_path / "fraud_alerts_csv" / "batch_id=0"
    (file,) = folder.glob("*.csv")
    header, first, *_ = file.read_text().splitlines()
    assert header == ",".join(ALERT_CSV_SCHEMA.fieldNames())
    assert ".000Z" in first and "true" in first
    back = tables.read_alerts_csv(spark, str(folder))
    want = {r.transaction_id: (r.merchant, r.fraud_reason) for r in scored.filter("is_fraud").collect()}
    assert {r.transaction_id: (r.merchant, r.fraud_reason) for r in back.collect()} == want


def test_csv_without_alerts_is_a_header(spark, scored, tmp_path):
    tables.write_alerts_csv(scored.filter("not is_fraud"), str(tmp_path), 0, 0)
    (file,) = (tmp_path / "fraud_alerts_csv" / "batch_id=0").glob("*.csv")
    assert file.read_text().splitlines() == [",".join(ALERT_CSV_SCHEMA.fieldNames())]


def test_batch_folders_are_partitions(spark, scored, tmp_path):
    for batch_id in (3, 4):
        write_all(scored, str(tmp_path), batch_id)
    df = spark.read.parquet(f"{tmp_path}/fraud_alerts")
    assert {r[0] for r in df.select("batch_id").distinct().collect()} == {3, 4}


def test_backfill_writes_every_row_once(spark, tmp_path):
    sent = damage(events.transactions(spark, SMALL))
    config = RuleConfig(amount_limit=150.0)
    for _ in range(2):
        backfill(sent, config, str(tmp_path), 0)
    clean, alerts = load_results(spark, str(tmp_path))
    rejects = spark.read.schema(REJECT_SCHEMA).parquet(f"{tmp_path}/rejects")
    assert clean.count() + alerts.count() + rejects.count() == 1000
    assert alerts.count() > 0 and rejects.filter("reject_reason is null").isEmpty()
    kinds = {r[0] for r in rejects.select("reject_reason").distinct().collect()}
    assert len(kinds) == 6
    assert not (tmp_path / "_staging" / "batch_id=0").exists()
    want = score_transactions(
        parse_transactions(project_records(sent)), config
    ).select("transaction_id", "distance_km", "fraud_reason")
    both = reports.union_results(clean, alerts).select(want.columns)
    assert both.exceptAll(want).isEmpty() and want.exceptAll(both).isEmpty()


def test_heavy_user_count_reads_one_column(spark):
    plan = (
        events.transactions(spark, SMALL).groupBy("user_id").count()._jdf.queryExecution()
    ).executedPlan().toString()
    assert "ReadSchema: struct<user_id:bigint>" in plan


def test_metrics(scored):
    row = tables.batch_metrics(scored).first()
    assert (row.total, row.alerts, row.alert_rate) == (10, 3, pytest.approx(30.0))
    empty = tables.batch_metrics(scored.filter("false")).first()
    assert (empty.total, empty.alerts, empty.alert_rate) == (0, 0, 0.0)
    line = str(tables.BatchMetrics(3, total=8, alerts=2))
    assert line.startswith("batch_id=3 rows=8 alerts=2 alert_percent=25.0")


# --- reading folders -----------------------------------------------------------


def test_missing_and_empty_folders_are_empty_tables(spark, tmp_path):
    (tmp_path / "transactions").mkdir()
    clean, alerts = load_results(spark, str(tmp_path))
    assert (clean.count(), alerts.count()) == (0, 0)
    assert clean.schema == alerts.schema == RESULT_SCHEMA


def test_nested_unfinished_and_unreadable_files(spark, tmp_path):
    good = spark.range(5)
    good.write.parquet(str(tmp_path / "a" / "b"))
    good.write.parquet(str(tmp_path / "_temporary" / "0"))
    (tmp_path / "a" / "broken.parquet").write_bytes(b"PAR1 not really")
    (tmp_path / "a" / "notes.txt").write_text("x")
    found = read_parquet_dir(spark, str(tmp_path), good.schema, skip_unreadable=True)
    assert found.count() == 5
    with pytest.raises(Exception, match="broken.parquet"):
        read_parquet_dir(spark, str(tmp_path), good.schema).count()


def test_a_table_of_many_files_is_read_whole(spark, tmp_path):
    events.read_events(spark, SMALL).repartition(7).write.parquet(f"{tmp_path}/events.parquet")
    assert QUERIES["src_parquet_dir"](spark, str(tmp_path)).count() == 1000
    assert QUERIES["src_load_results"](spark, str(tmp_path)).count() == 1000


def test_csv_layout_and_text_do_not_depend_on_rules_or_content(spark, txns, tmp_path):
    odd = '  Acme, "x"\nsecond line  '
    rows = txns([("h", "v", 0, HOME, 20_000.0)]).withColumn("merchant", F.lit(odd))
    scored = score_transactions(rows, RuleConfig(rules=("high_value",)))
    tables.write_alerts_csv(scored, str(tmp_path), 0, 1)
    back = tables.read_alerts_csv(spark, f"{tmp_path}/fraud_alerts_csv/batch_id=0").collect()
    assert [(r.merchant, r.is_fraud, r.fraud_location_anomaly) for r in back] == [(odd, True, None)]
    (file,) = (tmp_path / "fraud_alerts_csv" / "batch_id=0").glob("*.csv")
    assert file.read_text().splitlines()[0] == ",".join(ALERT_CSV_SCHEMA.fieldNames())


def test_messages_keep_the_amount(spark, scored):
    exact = scored.withColumn("amount", F.lit(10000.004))
    values = message_sink.to_values(exact).select("value", F.col("value").alias("json_str"))
    back = parse_transactions(values.select("json_str", F.lit(None).alias("kafka_ts")))
    assert {r.amount for r in back.collect()} == {10000.004}


def test_reports_read_only_their_columns(spark, scored, tmp_path):
    write_all(scored, str(tmp_path), 0)
    results = reports.union_results(*load_results(spark, str(tmp_path)))
    plan = reports.kpis(results)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<amount:double,is_fraud:boolean>" in plan


# --- reports -------------------------------------------------------------------


def test_reports(spark, scored, tmp_path):
    write_all(scored, str(tmp_path), 0)
    found = {k: v.collect() for k, v in reports.refresh(spark, str(tmp_path)).items()}
    (kpis,) = found["kpis"]
    assert (kpis.total, kpis.alerts, kpis.alert_rate) == (10, 3, pytest.approx(30.0))
    assert kpis.avg_alert_amount == pytest.approx((20_000 + 30_000 + 50) / 3)
    assert [r.transaction_id for r in found["latest_alerts"]] == ["l", "hl", "h"]
    assert [r.is_high_value for r in found["latest_alerts"]] == [False, True, True]
    assert {(r.reason, r.alerts) for r in found["reason_counts"]} == {
        ("high_value", 1),
        ("high_value+location_anomaly", 1),
        ("location_anomaly", 1),
    }
    assert sum(r.rows for r in found["volume_by_minute"]) == 10
    assert len(found["geo_points"]) == 3


def test_reports_on_nothing(spark, tmp_path):
    found = {k: v.collect() for k, v in reports.refresh(spark, str(tmp_path)).items()}
    (kpis,) = found.pop("kpis")
    assert tuple(kpis) == (0, 0, 0.0, None)
    assert all(rows == [] for rows in found.values())


def test_latest_alerts_is_a_top_k(spark, scored):
    many = scored.crossJoin(spark.range(20).select(F.col("id").alias("copy")))
    latest = reports.latest_alerts(many)
    assert latest.count() == reports.LATEST_ROWS
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_latest_alerts_shows_the_columns_there_are(scored):
    assert "city" not in reports.latest_alerts(scored.drop("city")).columns


def test_bad_times_and_places_are_left_out_of_their_reports(scored):
    bad = scored.withColumn("timestamp", F.lit("soon")).withColumn("latitude", F.lit(None))
    assert reports.volume_by_minute(bad.drop("event_time")).isEmpty()
    assert reports.volume_by_minute(bad).agg(F.sum("rows")).first()[0] == 10
    assert reports.geo_points(bad).isEmpty()


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, True)], "x int, y boolean")
    b = spark.createDataFrame([("z", 2)], "w string, x int")
    rows = {tuple(r) for r in reports.union_results(a, b).select("x", "y", "w").collect()}
    assert rows == {(1, True, None), (2, None, "z")}


# --- messages and settings -------------------------------------------------------


def test_messages_as_text(spark, scored, tmp_path):
    message_sink.write_text(scored, str(tmp_path / "out"))
    lines = [x for f in Path(tmp_path / "out").glob("*.txt") for x in f.read_text().splitlines()]
    assert len(lines) == 10 and all(x.startswith('{"transaction_id":"') for x in lines)


def test_kafka_settings():
    env = {"KAFKA_BOOTSTRAP_SERVERS": "b:1", "KAFKA_TOPIC": "t", "OUTPUT_PATH": "/o"}
    config = StreamConfig.from_env(env, fail_on_data_loss=False, max_per_trigger=None)
    assert kafka_options(config) == {
        "kafka.bootstrap.servers": "b:1",
        "subscribe": "t",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
    }
    assert config.checkpoint_base == "/o/_checkpoints"
    assert kafka_options(StreamConfig())["failOnDataLoss"] == "true"


def test_work_dirs_are_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert work_dir(spark, "x").startswith(shared)
    assert work_dir(spark, "x") != work_dir(spark, "x")
