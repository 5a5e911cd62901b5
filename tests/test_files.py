"""Snapshots, parquet files and published tables."""

import csv
import tempfile
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from leaguescore import sinks
from leaguescore.registry import QUERIES
from leaguescore.schemas import REPORT_COLUMNS, REPORT_SCHEMA
from leaguescore.sources import (
    latest_snapshot,
    list_snapshots,
    read_latest,
    scan_csv,
    scan_parquet,
    snapshot_freshness,
    snapshot_manifest,
)

SF_DIR = "/root/testdata/sf0.001"


def test_latest_rows_per_handle(spark):
    rows = [
        ("stats, 2024-12-19 010101 EST.parquet", 1),
        ("stats, 2024-12-20 010101 EST.parquet", 2),
        ("stats, 2024-12-20 010101 EST.parquet", 3),
        ("plays, a, 2024-01-01 000000 EST.parquet", 4),
        ("notes.txt", 5),
    ]
    df = spark.createDataFrame(rows, "file_name string, n int")
    newest = latest_snapshot(df, "file_name").collect()
    assert sorted(r["n"] for r in newest) == [2, 3, 4]
    assert {r["handle"] for r in newest} == {"stats", "plays, a"}


def test_the_newest_snapshot_has_all_its_extensions(spark):
    names = ["a, 2.csv", "a, 2.parquet", "a, 1.csv", "b, 1.x", "plain", ", 3.x", None]
    rows = [(n, i) for n in names for i in range(2)]
    df = spark.createDataFrame(rows, "file_name string, handle_no int")
    newest = latest_snapshot(df, "file_name").collect()
    assert sorted({r["file_name"] for r in newest}) == [", 3.x", "a, 2.csv", "a, 2.parquet", "b, 1.x"]
    assert len(newest) == 8 and latest_snapshot(df.where("file_name = 'plain'"), "file_name").isEmpty()


def test_freshness(spark):
    names = "file_name string"
    remote = spark.createDataFrame([("a, 2.csv",), ("a, 1.csv",), ("b, 2.csv",), ("c, 2.csv",)], names)
    local = spark.createDataFrame([("a, 2.csv",), ("b, 1.csv",), ("d, 9.csv",)], names)
    rows = snapshot_freshness(
        snapshot_manifest(remote, "file_name"), snapshot_manifest(local, "file_name")
    ).collect()
    assert {r["handle"]: r["is_stale"] for r in rows} == {"a": False, "b": True, "c": False}


def test_read_latest_file(spark):
    folder = tempfile.mkdtemp(prefix="snapshots-")
    for stamp, n in (("2024-12-19 042746 EST", 1), ("2024-12-20 042746 EST", 2)):
        spark.range(n).toPandas().to_parquet(f"{folder}/stats_2024, {stamp}.parquet")
    spark.range(9).toPandas().to_parquet(f"{folder}/stats_def_2024, 2025-01-01 000000 EST.parquet")
    assert list_snapshots(spark, folder).count() == 3
    assert read_latest(spark, folder, "stats_2024").count() == 2
    with pytest.raises(FileNotFoundError):
        read_latest(spark, folder, "stats")


def test_read_latest_folder_and_odd_names(spark):
    folder = tempfile.mkdtemp(prefix="snapshots-")
    for stamp, n in (("2024-12-19 101010 UTC", 1), ("2024-12-20 101010 UTC", 2)):
        spark.range(n).write.parquet(f"{folder}/a+b 50%, c, {stamp}.parquet")
    spark.range(9).toPandas().to_parquet(f"{folder}/a b 50%, c, 2025-01-01 000000 UTC.parquet")
    names = {r["file_name"] for r in list_snapshots(spark, folder).collect()}
    assert "a+b 50%, c, 2024-12-20 101010 UTC.parquet" in names and len(names) == 3
    assert read_latest(spark, folder, "a+b 50%, c").count() == 2
    assert read_latest(spark, folder, "a b 50%, c").count() == 9


def test_csv_is_read_by_others_and_back(spark, tmp_path):
    texts = ['My "Best" team', " lead", "trail ", "a,b", "back\\slash", "two\nlines", 'q"']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, t string")
    path = sinks.write_csv(df.coalesce(1), str(tmp_path / "out"), "1")
    (part,) = Path(path).glob("part-*")
    with part.open(newline="", encoding="utf-8") as file:
        assert [row[1] for row in csv.reader(file)] == ["t", *texts]
    with (tmp_path / "in.csv").open("w", newline="", encoding="utf-8") as file:
        csv.writer(file).writerows([("n", "t"), *enumerate(texts)])
    for place in (path, str(tmp_path / "in.csv")):
        back = scan_csv(spark, place, df.schema, multi_line=True)
        assert {r["n"]: r["t"] for r in back.collect()} == dict(enumerate(texts))


def test_a_fraction_is_not_cut(spark, table):
    row = (1, "QB1", *["x"] * 3, 1, *["x"] * 8, True, "x", 12.7, 1)
    df = spark.createDataFrame([row], REPORT_SCHEMA)
    with pytest.raises(Exception, match="not a whole number"):
        sinks.publish(df, table)


def test_scan_reads_named_columns_only(spark):
    df = scan_parquet(spark, f"{SF_DIR}/orders.parquet", "o_orderkey").where("o_orderkey > 5")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan
    assert "GreaterThan(o_orderkey,5)" in plan


@pytest.fixture
def table(spark):
    name = "published_report"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


@pytest.fixture(scope="module")
def report(spark):
    return QUERIES["scored_report"](spark, SF_DIR)


def test_publish_replace_and_append(spark, report, table, tmp_path):
    location = str(tmp_path / "table")
    sinks.publish(report, table, path=location)
    sinks.publish(report, table, path=location)
    back = sinks.read_published(spark, table)
    assert back.columns == list(REPORT_COLUMNS)
    assert dict(back.dtypes)["football_value"] == "int"
    assert dict(back.dtypes)["subsequently_traded"] == "string"
    rows = back.count()
    assert rows == report.count()
    sinks.publish(report.limit(9), table, mode="append", path=location)
    assert sinks.read_published(spark, table).count() == rows + 9


def test_contract_is_enforced_on_request(spark, table):
    row = (1, None, *["x"] * 3, 1, *["x"] * 8, True, "x", 1.0, 1)
    df = spark.createDataFrame([row], REPORT_SCHEMA)
    with pytest.raises(sinks.ContractViolation, match="position_code: 1"):
        sinks.publish(df, table, enforce_not_null=True)


def good_report(spark, n=3, **changes):
    row = dict(zip(REPORT_COLUMNS, (1, "QB1", *["x"] * 3, 1, *["x"] * 8, True, "x", 1.0, 1)))
    kinds = {f.name: f.dataType for f in REPORT_SCHEMA}
    df = spark.range(n).select(*[F.lit(v).cast(kinds[c]).alias(c) for c, v in row.items()])
    return df.withColumns(changes)


def tables_like(spark, table):
    return {t.name for t in spark.catalog.listTables() if t.name.startswith(table)}


def test_a_table_of_the_user_survives_a_checked_publish(spark, table, tmp_path):
    own = f"{table}__staging"
    try:
        spark.range(5).write.option("path", str(tmp_path / "own")).saveAsTable(own)
        sinks.publish(good_report(spark), table, enforce_not_null=True)
        assert sinks.read_published(spark, table).count() == 3
        bad = good_report(spark, position=F.lit(None).cast("string"))
        with pytest.raises(sinks.ContractViolation, match="position: 3"):
            sinks.publish(bad, table, enforce_not_null=True)
        assert spark.table(own).count() == 5 and sinks.read_published(spark, table).count() == 3
        assert tables_like(spark, table) == {table, own}
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {own}")


def test_a_name_that_is_taken_is_not_dropped(spark, table, tmp_path, monkeypatch):
    taken = f"{table}__taken"
    monkeypatch.setattr(sinks, "staging_name", lambda _: taken)
    try:
        spark.range(5).write.option("path", str(tmp_path / "own")).saveAsTable(taken)
        with pytest.raises(ValueError, match="there already"):
            sinks.publish(good_report(spark), table, enforce_not_null=True)
        assert spark.table(taken).count() == 5
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {taken}")


def test_two_checked_publishes_at_once(spark, tmp_path):
    names = ["published_one", "published_two"]
    try:
        with ThreadPoolExecutor(2) as pool:
            def run(name):
                sinks.publish(good_report(spark, 50), name, enforce_not_null=True, path=str(tmp_path / name))

            list(pool.map(run, names))
            shared = "published_shared"
            both = [
                pool.submit(
                    sinks.publish, good_report(spark, 20), shared, mode="append", enforce_not_null=True
                )
                for _ in range(2)
            ]
            errors = [f.exception() for f in both]
        assert all(spark.table(name).count() == 50 for name in names)
        assert None in errors and spark.table(shared).count() in (20, 40)
        assert tables_like(spark, "published_") == {*names, shared}
    finally:
        for name in (*names, "published_shared"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_a_checked_publish_runs_the_report_once(spark, table):
    runs = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch

    rows = good_report(spark, 40).mapInArrow(seen, REPORT_SCHEMA)
    sinks.publish(rows, table, enforce_not_null=True)
    assert sinks.read_published(spark, table).count() == 40 and runs.value == 40


def test_an_empty_report_keeps_the_contract(spark, table):
    sinks.publish(good_report(spark, 0), table, enforce_not_null=True)
    assert sinks.read_published(spark, table).isEmpty()


def test_staging_names():
    one, two = sinks.staging_name("a.b"), sinks.staging_name("`a`.`b c`")
    assert one.startswith("a.b__staging_") and two.startswith("`a`.`b c__staging_") and two.endswith("`")
    assert sinks.staging_name("a.b") != one


def test_write_parquet_never_overwrites(spark, report, tmp_path):
    base = str(tmp_path / "runs")
    path = sinks.write_parquet(report, base, "2024-12-20 1342")
    assert spark.read.parquet(path).count() == report.count()
    with pytest.raises(Exception, match="exists"):
        sinks.write_parquet(report, base, "2024-12-20 1342")
