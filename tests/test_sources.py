from __future__ import annotations

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from mapflow.plans.delivery import REDELIVERY
from mapflow.plans.publish import publish
from mapflow.plans.quality import QualityError
from mapflow.session import shared_dir
from mapflow.sources import landing, sinks
from mapflow.streaming.intake import intake_triggers, keep_first_arrivals


def test_formats(spark, frame, tmp_path):
    df = frame([(1, "a;b"), (2, None)], "x int, y string")
    df.write.option("header", True).option("sep", "|").csv(f"{tmp_path}/in")
    landed = landing.land_parquet(spark, f"{tmp_path}/in", f"{tmp_path}/out", ".TXT", sep="|")
    assert rows(landing.read_landed(spark, landed)) == [("1", "a;b"), ("2", None)]
    with pytest.raises(ValueError, match="xlsx"):
        landing.read_delivery(spark, "x", "xlsx")
    df.where("x > 5").write.parquet(f"{tmp_path}/empty")
    with pytest.raises(ValueError, match="no rows"):
        landing.read_landed(spark, f"{tmp_path}/empty")


def test_inventory_of_listed_files(spark, frame, tmp_path):
    for name in ("known.csv", "other.TXT", "stray.csv", "bare"):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_text("x")
    expected = frame([("known", ".csv"), ("other", "csv"), ("bare", "csv")], "SourceFileName string, SourceFileFormat string")
    got = landing.inventory(landing.list_files(spark, f"{tmp_path}/in"), expected)
    assert rows(got.select("file_name", "extension", "length", "verdict")) == [
        ("bare", "", 1, "WRONG_FORMAT"), ("known", "csv", 1, "OK"), ("other", "txt", 1, "WRONG_FORMAT"), ("stray", "csv", 1, "UNKNOWN"),
    ]


def test_overwrite_reports_the_schema_change(spark, frame):
    first = frame([(1, "a")], "x int, y string")
    assert sinks.overwrite_table(first, "t_evolve") == {"added": ["x", "y"], "removed": [], "retyped": []}
    second = frame([(2, 0.5)], "x bigint, z double")
    assert sinks.overwrite_table(second, "t_evolve") == {"added": ["z"], "removed": ["y"], "retyped": ["x"]}
    assert rows(spark.table("t_evolve")) == [(2, 0.5)]


def test_log_is_created_once_and_appended(spark):
    for _ in range(2):
        sinks.create_if_absent(spark, "t_log", sinks.PROCESS_LOG_SCHEMA)
        sinks.append_log(spark, [{"RunID": 1, "Status": "Started"}, {"RunID": 1, "Status": "Completed"}], "t_log")
    assert spark.table("t_log").count() == 4


def test_export_and_manifest(spark, frame, tmp_path):
    df = frame([(1, "2024-01-31"), (2, "2024-02-29"), (2, "2024-02-29")], "x int, day string")
    faulty = df.select(F.expr("cast(raise_error('no such day') as int) AS x"))
    frames = {"good": df, "none": None, "faulty": faulty, "last": df}
    status = {r["table_name"]: r for r in sinks.export_many(spark, frames, str(tmp_path), {"good": F.col("day")}).collect()}
    assert {name: r["exported"] for name, r in status.items()} == {"good": True, "none": False, "faulty": False, "last": True}
    assert status["good"]["error"] == "" and status["faulty"]["error"] not in ("", "no data")
    stored = spark.read.json(f"{tmp_path}/good_manifest.json").first().asDict()
    assert (stored["record_count"], stored["column_count"], stored["snapshot_date"]) == (3, 2, "2024-01-31")
    again = spark.read.parquet(f"{tmp_path}/good.parquet").repartition(3)
    assert sinks.export_manifest(again, "good", F.col("day")).first()["content_hash"] == stored["content_hash"]
    fewer = sinks.export_manifest(df.distinct(), "good", F.col("day")).first()["content_hash"]
    assert fewer != stored["content_hash"]  # copies count


def test_one_month_is_replaced_next_to_the_others(spark, frame, tmp_path):
    def write(data, **how):
        df = frame(data, "x int, run_month string")
        assert sinks.export_parquet(df, str(tmp_path), "t", partition_by=["run_month"], **how)
        return rows(spark.read.parquet(f"{tmp_path}/t.parquet").selectExpr("x", "cast(run_month as string)"))

    write([(1, "202501"), (2, "202502")])
    assert write([(3, "202502")], replace_partitions=True) == [(1, "202501"), (3, "202502")]
    assert write([(4, "202503")]) == [(4, "202503")]


def test_comments(spark, frame):
    df = sinks.with_comments(frame([(1, 2)], "x int, y int"), {"x": "A.x + 1"})
    sinks.overwrite_table(df, "t_comments")
    sinks.comment_table(spark, "t_comments", "what it's for")
    assert rows(sinks.column_lineage(spark, "t_comments")) == [("x", "A.x + 1"), ("y", None)]
    detail = {r["col_name"]: r["data_type"] for r in spark.sql("describe extended t_comments").collect()}
    assert detail["Comment"] == "what it's for"


def test_empty_like(spark, frame):
    sinks.create_empty_like(frame([(1, "a", 2.0)], "x int, y string, z double"), ["x", "z"], "t_empty")
    empty = spark.table("t_empty")
    assert (empty.count(), empty.dtypes) == (0, [("x", "int"), ("z", "double")])


def test_publish_checks_what_it_wrote(frame, tmp_path):
    df = frame([(1, "a"), (2, "b")], "x int, y string")
    assert rows(publish(df, str(tmp_path), "ok", {"PK": ["x"]}, partition_by=["y"])) == [(1, "a"), (2, "b")]
    with pytest.raises(QualityError):
        publish(df.union(df), str(tmp_path), "bad", {"PK": ["x"]})


def test_shared_folder_is_the_one_of_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or shared_dir(spark) == configured
    assert shared_dir(spark) == shared_dir(spark)


def trigger(name, day="20250331"):
    row = dict.fromkeys(landing.TRIGGER_COLUMNS, "x")
    return json.dumps({**row, "dial_source_file_name": name, "dial_source_file_snapshot_datetime": day})


def test_intake_takes_every_trigger_once(spark, frame, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    meta = frame(
        [("a", "20250331", REDELIVERY), ("b", "20250331", 5)], "SourceFileName string, SnapshotDate string, FileDeliveryStep int"
    )

    def run():
        taken = intake_triggers(spark, str(folder), meta, f"{tmp_path}/out", f"{tmp_path}/state", max_files=1)
        return rows(taken.select("dial_source_file_name", "disposition"))

    (folder / "1.json").write_text(trigger("a"))
    (folder / "2.json").write_text(trigger("b"))
    assert run() == [("a", "LOAD"), ("b", "ARCHIVE")]
    assert run() == [("a", "LOAD"), ("b", "ARCHIVE")]
    (folder / "3.json").write_text(trigger("c"))
    assert run() == [("a", "LOAD"), ("b", "ARCHIVE"), ("c", "ARCHIVE")]


def test_redelivery_across_runs(spark, frame, tmp_path):
    """A first arrival is kept however late it is, a repeat goes however late it is; null keys are one key."""
    schema = "id int, ts timestamp"

    def deliver(*arrivals):
        df = frame(list(arrivals), "id int, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
        df.write.mode("append").parquet(f"{tmp_path}/in")

    def run():
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        kept = keep_first_arrivals(stream, ["id"], "ts", f"{tmp_path}/out", f"{tmp_path}/state")
        return rows(kept.selectExpr("id", "date_format(ts, 'MM-dd')"))

    (tmp_path / "in").mkdir()
    assert run() == []
    deliver((1, "2024-03-10"), (2, "2024-03-11"), (2, "2024-03-09"), (None, "2024-03-01"))
    assert run() == [(None, "03-01"), (1, "03-10"), (2, "03-09")]
    deliver((3, "2024-01-02"), (1, "2024-05-01"), (2, "2024-01-01"), (None, "2024-03-02"))
    assert run() == [(None, "03-01"), (1, "03-10"), (2, "03-09"), (3, "01-02")]
    assert run() == [(None, "03-01"), (1, "03-10"), (2, "03-09"), (3, "01-02")]


def test_a_batch_looks_up_its_own_keys_only(spark, frame, tmp_path):
    """State is written for the keys of a batch, not for all that were ever stored; nothing stored is read again."""
    (tmp_path / "in").mkdir()

    def run(ids):
        frame([(i, i % 7, f"r{i}") for i in ids], "id int, place int, text string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema("id int, place int, text string").parquet(f"{tmp_path}/in")
        return keep_first_arrivals(stream, ["id"], "place", f"{tmp_path}/out", f"{tmp_path}/state")

    assert run(range(500)).count() == 500
    before = {p.name for p in (tmp_path / "out").iterdir()}
    for path in (tmp_path / "out").rglob("*.parquet"):
        path.write_bytes(b"not to be read")
    run([3, 4, 500, 501, 501])
    (batch,) = {p.name for p in (tmp_path / "out").iterdir()} - before
    new = spark.read.parquet(f"{tmp_path}/out/{batch}")
    assert sorted(r["id"] for r in new.collect()) == [500, 501]


def test_a_table_is_replaced_by_rows_of_its_own(spark, frame, tmp_path):
    name, folder = "default.own_rows", str(tmp_path / "versions")
    first = frame([(1, "01"), (2, "02")], "id int, month string")
    assert sinks.replace_versioned(first, name, folder, ["month"])["added"] == ["id", "month"]
    reading = spark.table(name)
    assert sinks.replace_versioned(reading.selectExpr("id + 10 AS id", "month"), name, folder, ["month"]) == {"added": [], "removed": [], "retyped": []}
    assert rows(spark.table(name)) == [(11, "01"), (12, "02")]
    assert rows(reading) == [(1, "01"), (2, "02")]  # who began before keeps what it began with


def test_a_failed_replacement_leaves_the_table(spark, frame, tmp_path):
    name, folder = "default.kept_rows", str(tmp_path / "versions")
    sinks.replace_versioned(frame([(1,), (0,)], "id int"), name, folder)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        sinks.replace_versioned(spark.table(name).selectExpr("1 / id AS id"), name, folder)
    assert rows(spark.table(name)) == [(0,), (1,)]
