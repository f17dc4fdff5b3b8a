import uuid
from datetime import datetime, timedelta, timezone

import pandas as pd
import pytest
from pyspark.sql import functions as F

from orderloom.schemas import RAW
from orderloom.sources.raw import (
    Landed,
    MissingTables,
    csv_tables,
    ingest,
    read_raw,
    read_snapshot,
    record_run,
    run_days,
    runs,
    snapshots,
    stored_with_types,
    write_snapshot,
)

DAY_1 = datetime(2024, 5, 1, 6, tzinfo=timezone.utc)
DAY_1_LATER = datetime(2024, 5, 1, 22, tzinfo=timezone.utc)
DAY_2 = datetime(2024, 5, 2, 6, tzinfo=timezone.utc)


def frame(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "id STRING")


def ids(df):
    return sorted(r.id for r in df.collect())


def test_same_day_is_replaced_and_other_days_stay(spark, tmp_path):
    raw = str(tmp_path)
    assert write_snapshot(frame(spark, "a", "b"), raw, "t", DAY_1) == 2
    assert write_snapshot(frame(spark, "c"), raw, "t", DAY_1_LATER) == 1
    assert ids(read_snapshot(spark, raw, "t")) == ["c"]
    write_snapshot(frame(spark, "c", "d"), raw, "t", DAY_2)
    assert list(snapshots(spark, raw, "t")) == ["2024-05-01", "2024-05-02"]
    assert ids(read_snapshot(spark, raw, "t")) == ["c", "d"]
    assert ids(read_snapshot(spark, raw, "t", "all")) == ["c", "c", "d"]
    assert ids(read_snapshot(spark, raw, "t", "2024-05-01")) == ["c"]
    with pytest.raises(FileNotFoundError, match="2024-06-01"):
        read_snapshot(spark, raw, "t", "2024-06-01")


def test_snapshot_without_rows_replaces_the_day(spark, tmp_path):
    raw = str(tmp_path)
    assert write_snapshot(frame(spark, "a"), raw, "t", DAY_1) == 1
    assert write_snapshot(frame(spark, "a").where("false"), raw, "t", DAY_1) == 0
    assert ids(read_snapshot(spark, raw, "t")) == []
    assert write_snapshot(frame(spark), raw, "t", DAY_2) == 0
    assert ids(read_snapshot(spark, raw, "t")) == []
    assert read_snapshot(spark, raw, "t").columns == ["id"]


def test_stamp_is_one_value_per_snapshot(spark, tmp_path):
    write_snapshot(frame(spark, "a", "b"), str(tmp_path), "t", DAY_1)
    stamps = spark.read.parquet(f"{tmp_path}/t").select("loaded_at").distinct().collect()
    assert [r.loaded_at for r in stamps] == [datetime(2024, 5, 1, 6)]
    assert read_snapshot(spark, str(tmp_path), "t").columns == ["id"]


def test_latest_reads_one_day_only(spark, tmp_path):
    for day in (DAY_1, DAY_2):
        write_snapshot(frame(spark, "a"), str(tmp_path), "t", day)
    files = read_snapshot(spark, str(tmp_path), "t").inputFiles()
    assert files and all("ingest_date=2024-05-02" in f for f in files)


def test_days_stored_as_single_files(spark, tmp_path):
    folder = tmp_path / "t"
    folder.mkdir()
    for day, key in (("2024-05-01", "a"), ("2024-05-03", "b")):
        rows = pd.DataFrame({"id": [key]})
        rows["loaded_at"] = pd.Timestamp.now()
        rows.to_parquet(folder / f"t_{day}.parquet", index=False)
    (folder / "notes_2024-05-09.parquet").write_text("not a snapshot")
    raw = str(tmp_path)
    assert ids(read_snapshot(spark, raw, "t")) == ["b"]
    assert ids(read_snapshot(spark, raw, "t", "all")) == ["a", "b"]
    assert read_snapshot(spark, raw, "t").columns == ["id"]
    write_snapshot(frame(spark, "c"), raw, "t", DAY_2)
    assert ids(read_snapshot(spark, raw, "t", "2024-05-02")) == ["c"]
    assert ids(read_snapshot(spark, raw, "t", "all")) == ["a", "b", "c"]


def test_missing_table(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="no snapshot of t"):
        read_snapshot(spark, str(tmp_path), "t")


@pytest.mark.parametrize(
    "snapshot, details, payments", [("latest", 1, 1), ("all", 2**6, 2**2)]
)
def test_two_equal_snapshots(spark, raw, tmp_path, snapshot, details, payments):
    from orderloom.plans.silver import build_silver

    for day in (DAY_1, DAY_2):
        for name, df in raw().items():
            write_snapshot(df, str(tmp_path), name, day)
    silver = build_silver(read_raw(spark, str(tmp_path), snapshot))
    assert silver["order_details"].count() == details
    assert silver["order_payments"].count() == payments
    assert silver["order_reviews"].count() == payments


def test_folder_names_can_be_mapped(spark, raw, tmp_path):
    for name, df in raw().items():
        write_snapshot(df, str(tmp_path), f"shop_{name}", DAY_1)
    tables = read_raw(spark, str(tmp_path), names={n: f"shop_{n}" for n in raw()})
    assert tables["orders"].count() == 1


def csv_folder(tmp_path, **files):
    folder = tmp_path / "csv"
    folder.mkdir(exist_ok=True)
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def test_ingest(spark, tmp_path):
    folder = csv_folder(tmp_path, orders="id,code\n1,01037\n2,NA\n", places="id\n7\n")
    (tmp_path / "csv" / "notes.txt").write_text("not a table")
    assert list(csv_tables(spark, folder)) == ["orders", "places"]
    raw = f"{tmp_path}/raw"
    report = ingest(spark, folder, raw, DAY_1)
    assert [(r.table, r.status, r.attempts, r.rows) for r in report] == [
        ("orders", "landed", 1, 2),
        ("places", "landed", 1, 1),
    ]
    rows = {tuple(r) for r in read_snapshot(spark, raw, "orders").collect()}
    assert rows == {("1", "01037"), ("2", None)}


def test_malformed_table_is_skipped_at_once(spark, tmp_path):
    folder = csv_folder(tmp_path, good="id\n1\n", bad="id,code\n1,2,3\n")
    raw = f"{tmp_path}/raw"
    report = {r.table: r for r in ingest(spark, folder, raw, DAY_1, max_retries=2, retry_delay=0)}
    assert (report["good"].status, report["bad"].status) == ("landed", "skipped")
    assert (report["bad"].attempts, report["bad"].rows) == (1, None)
    assert "more fields" in report["bad"].error
    assert snapshots(spark, raw, "bad") == {}
    with pytest.raises(MissingTables, match=r"absent \(no such file\), bad \("):
        ingest(spark, folder, raw, DAY_1, max_retries=1, required=["good", "bad", "absent"])


def test_transient_failure_is_retried(spark, tmp_path):
    from orderloom.sources.csv_read import read_csv

    folder = csv_folder(tmp_path, t="id\n1\n")
    calls = []

    def flaky(session, path):
        calls.append(path)
        if len(calls) < 3:
            raise OSError("connection reset")
        return read_csv(session, path)

    (landed,) = ingest(spark, folder, f"{tmp_path}/raw", DAY_1, retry_delay=0, read=flaky)
    assert (landed.status, landed.attempts, landed.error) == ("landed", 3, None)


def test_skipped_table_keeps_its_last_snapshot(spark, tmp_path):
    raw = f"{tmp_path}/raw"
    folder = csv_folder(tmp_path, t="id,code\n1,x\n", u="id\n1\n")
    ingest(spark, folder, raw, DAY_1)
    csv_folder(tmp_path, t="id,code\n2,x,y\n", u="id\n2\n")
    ingest(spark, folder, raw, DAY_2, max_retries=1)
    assert ids(read_snapshot(spark, raw, "t")) == ["1"]
    assert ids(read_snapshot(spark, raw, "u")) == ["2"]


def test_empty_folder(spark, tmp_path):
    assert ingest(spark, csv_folder(tmp_path), f"{tmp_path}/raw", DAY_1) == []
    assert ingest(spark, f"{tmp_path}/nowhere", f"{tmp_path}/raw", DAY_1) == []
    assert not (tmp_path / "raw").exists()


def test_inferred_types(spark, tmp_path):
    df = spark.createDataFrame(
        [
            ("1", "1.5", "01037", "a", None, "-3", "1", "True"),
            ("20", "2", "01038", "b", None, None, "99999999999999999999", "False"),
        ],
        "n STRING, x STRING, zip STRING, s STRING, empty STRING, gaps STRING, big STRING, "
        "flag STRING",
    )
    out = stored_with_types(df, f"{tmp_path}/t")
    assert dict(out.dtypes) == {
        "n": "bigint",
        "x": "double",
        "zip": "string",
        "s": "string",
        "empty": "string",
        "gaps": "bigint",
        "big": "string",
        "flag": "boolean",
    }
    assert {r.n: r.gaps for r in out.collect()} == {1: -3, 20: None}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_long_ids_stay_distinct(spark, conf, tmp_path, ansi):
    conf(ansi__enabled=ansi)

    def typed(df):
        return stored_with_types(df, f"{tmp_path}/{uuid.uuid4().hex}")

    for digits, kind in ((15, "bigint"), (18, "bigint"), (19, "bigint"), (20, "string")):
        for sign in ("", "-", "+"):
            ids = [sign + ("1234567890123456789" + "0")[:digits], sign + "1" * digits]
            out = typed(spark.createDataFrame([(i,) for i in ids], "id STRING"))
            assert out.dtypes == [("id", kind)]
            assert out.distinct().count() == 2
    mixed = spark.createDataFrame([("1.5",), ("1234567890123456789",)], "v STRING")
    assert typed(mixed).dtypes == [("v", "string")]
    over = spark.createDataFrame([("9223372036854775808",)], "v STRING")
    assert typed(over).dtypes == [("v", "string")]


def test_types_are_found_while_text_is_stored(spark, tmp_path):
    """The source is worked out once; a column with any name gets its type."""
    seen = spark.sparkContext.accumulator(0)

    def look(value):
        seen.add(1)
        return value

    rows = spark.range(50, numPartitions=4).select(
        F.udf(look)(F.col("id").cast("string")).alias("a.b"), F.lit("x").alias("c`d"), F.lit(1).alias("n")
    )
    out = stored_with_types(rows, f"{tmp_path}/t")
    assert dict(out.dtypes) == {"a.b": "bigint", "c`d": "string", "n": "int"}
    assert (out.count(), seen.value) == (50, 50)
    assert stored_with_types(spark.range(3), f"{tmp_path}/u").dtypes == [("id", "bigint")]


def test_a_run_names_the_day_of_each_table(spark, tmp_path):
    raw, day = f"{tmp_path}/raw", datetime(2024, 5, 1, 6, tzinfo=timezone.utc)

    def land(table, value, n):
        write_snapshot(spark.createDataFrame([(value,)], "v STRING"), raw, table, day + timedelta(days=n))
        return Landed(table, "landed", 1, rows=1)

    tables = ["a", "b", "c"]
    first = record_run(spark, raw, day, [land("a", "a0", 0), land("b", "b0", 0)], tables)
    second = record_run(spark, raw, day + timedelta(days=1), [land("a", "a1", 1), Landed("b", "skipped", 3)], tables)
    # The third day lands b; the second run still reads it at the first day.
    third = record_run(spark, raw, day + timedelta(days=2), [land("b", "b2", 2)], tables)
    assert runs(spark, raw) == [first, second, third]
    assert run_days(spark, raw, first) == {"a": "2024-05-01", "b": "2024-05-01"}
    assert run_days(spark, raw, second) == {"a": "2024-05-02", "b": "2024-05-01"}
    assert run_days(spark, raw, third) == {"a": "2024-05-02", "b": "2024-05-03"}
    # A run that is made up for later sees no day after its own.
    land("c", "c5", 5)
    late = record_run(spark, raw, day + timedelta(days=3), [], tables)
    assert run_days(spark, raw, late) == {"a": "2024-05-02", "b": "2024-05-03"}


def test_raw_tables_of_a_run(spark, raw, tmp_path):
    folder, day = f"{tmp_path}/raw", datetime(2024, 5, 1, 6, tzinfo=timezone.utc)
    landed = []
    for name, df in raw().items():
        write_snapshot(df, folder, name, day)
        landed.append(Landed(name, "landed", 1, rows=1))
    name = record_run(spark, folder, day, landed, list(RAW))
    write_snapshot(raw(sellers=[{"seller_city": "later"}])["sellers"], folder, "sellers", day + timedelta(days=1))
    assert read_raw(spark, folder)["sellers"].first().seller_city == "later"
    assert read_raw(spark, folder, f"run:{name}")["sellers"].first().seller_city == "campinas"


def test_a_bad_file_does_not_cost_its_table(spark, tmp_path):
    folder = tmp_path / "csv" / "t.csv"
    folder.mkdir(parents=True)
    contents = {
        "1": "id,v\n1,a\n", "2": "v,id\nb,2\n", "3": "id,v\n3,c,surplus\n", "4": 'id,v\n4,"open\n',
        "5": "id,other\n5,e\n", "6": "id,v\n6,f\n",
    }
    for name, text in contents.items():
        (folder / f"{name}.csv").write_text(text)
    csv, raw = f"{tmp_path}/csv", f"{tmp_path}/raw"
    assert [r.status for r in ingest(spark, csv, raw, DAY_1, retry_delay=0)] == ["skipped"]
    (report,) = ingest(spark, csv, raw, DAY_1, required=["t"], retry_delay=0, set_aside=True)
    assert (report.status, report.rows) == ("landed", 3)
    assert [file.rsplit("/", 1)[1] for file, _ in report.set_aside] == ["3.csv", "4.csv", "5.csv"]
    errors = dict(report.set_aside)
    for name, mark in [("3", "more fields"), ("4", "without end"), ("5", "other columns")]:
        assert any(mark in e for f, e in errors.items() if f.endswith(f"{name}.csv"))
    assert {(r.id, r.v) for r in read_snapshot(spark, raw, "t").collect()} == {("1", "a"), ("2", "b"), ("6", "f")}
