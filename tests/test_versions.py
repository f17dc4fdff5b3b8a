"""Loads and builds at once, and loads that die at any step: always one version, no file lost."""

import threading
import uuid

import pytest

from orderloom.sources import tables, versions
from orderloom.sources.files import child_names, create_if_absent, read_text
from orderloom.sources.tables import (
    create_schema,
    create_silver_tables,
    load_rows,
    save_table,
    settle,
    table_location,
)


@pytest.fixture
def schema(spark):
    name = f"s_{uuid.uuid4().hex}"
    create_schema(spark, name)
    return name


@pytest.fixture
def payments(build):
    rows = build()["order_payments"]
    return lambda n: rows.selectExpr(
        *[c for c in rows.columns if c != "payment_sequential"], f"cast({n} as int) AS payment_sequential"
    )


def shown(spark, name):
    return sorted(r[0] for r in spark.table(name).select("payment_sequential").collect())


def folders(spark, schema, table):
    home = tables._home(spark, schema)
    return {f"{home}/{c}" for c in child_names(spark, home) if c.startswith(f"{table}-")}


class Died(BaseException):
    """Ends a load without any of its own clean-up."""


@pytest.fixture
def dies_at(monkeypatch):
    def arrange(owner, name, after=False):
        original = getattr(owner, name)

        def dying(*args, **kwargs):
            if after:
                original(*args, **kwargs)
            monkeypatch.setattr(owner, name, original)
            raise Died

        monkeypatch.setattr(owner, name, dying)

    return arrange


def test_create_if_absent_has_one_winner(spark, tmp_path):
    path, wins = f"{tmp_path}/f/one.json", []

    def attempt(k):
        if create_if_absent(spark, path, f"content {k}"):
            wins.append(k)

    threads = [threading.Thread(target=attempt, args=(k,)) for k in range(12)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(wins) == 1 and read_text(spark, path) == f"content {wins[0]}"
    assert [p.name for p in (tmp_path / "f").iterdir() if not p.name.endswith(".crc")] == ["one.json"]


def test_create_if_absent_by_rename(spark, tmp_path, monkeypatch):
    """Stores other than the local disk: a rename that does not overwrite."""
    root = f"viewfs://versions{tmp_path}"
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.versions.link./" + tmp_path.parts[1], f"file:///{tmp_path.parts[1]}")
    assert create_if_absent(spark, f"{root}/v/1.json", "a")
    assert not create_if_absent(spark, f"{root}/v/1.json", "b")
    assert read_text(spark, f"{root}/v/1.json") == "a"


def test_loads_at_once(spark, schema, payments):
    """Several loads and rebuilds end in any order: one of them is shown, whole, and files stay."""
    create_silver_tables(spark, schema)
    errors = []

    def attempt(k):
        try:
            load_rows(payments(k), schema, "order_payments")
        except Exception as error:  # reported below
            errors.append(error)

    threads = [threading.Thread(target=attempt, args=(k,)) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    name = f"{schema}.order_payments"
    newest = tables._log(spark, schema, "order_payments").latest()
    assert table_location(spark, name) == newest.folder
    assert len(shown(spark, name)) == 1
    load_rows(payments(9), schema, "order_payments")
    assert shown(spark, name) == [9]
    assert len(folders(spark, schema, "order_payments")) == versions.KEEP


def test_a_load_leaves_the_files_of_one_under_way(spark, schema, payments, monkeypatch):
    create_silver_tables(spark, schema)
    original = tables._switch

    def with_others(*args):
        monkeypatch.setattr(tables, "_switch", original)
        for k in (1, 2, 3):
            load_rows(payments(k), schema, "order_payments")
        original(*args)

    monkeypatch.setattr(tables, "_switch", with_others)
    load_rows(payments(7), schema, "order_payments")
    assert shown(spark, f"{schema}.order_payments") == [7]


@pytest.mark.parametrize("table", ["order_payments", "mart"])
def test_dead_loads(spark, schema, payments, dies_at, table):
    """Before the switch nothing has changed; after it the next look shows the new version."""
    name = f"{schema}.{table}"

    def put(n):
        if table == "mart":
            save_table(payments(n), schema, table)
        else:
            load_rows(payments(n), schema, table)

    create_silver_tables(spark, schema)
    put(1)
    for owner, step, after, seen in [
        (versions.VersionLog, "commit", False, 1),
        (versions.VersionLog, "publish", False, 1),
        (versions.VersionLog, "publish", True, 2),
        (tables, "_show", False, 3),
        (tables, "_show", True, 4),
    ]:
        dies_at(owner, step, after)
        with pytest.raises(Died):
            put(seen if seen > 1 else 99)
        settle(spark, schema, table)
        assert shown(spark, name) == [seen]
    put(50)
    put(51)
    assert shown(spark, name) == [51]
    log = tables._log(spark, schema, table)
    log.clean(lease_hours=0)
    assert folders(spark, schema, table) == {v.folder for v in log.versions()}
    assert len(log.versions()) == versions.KEEP


def test_a_load_that_outlives_its_lease_changes_nothing(spark, schema, payments, monkeypatch):
    create_silver_tables(spark, schema)
    load_rows(payments(1), schema, "order_payments")
    commit = versions.VersionLog.commit

    def late(log, *args):
        log.clean(lease_hours=0)
        return commit(log, *args)

    monkeypatch.setattr(versions.VersionLog, "commit", late)
    with pytest.raises(versions.LeaseLost):
        load_rows(payments(2), schema, "order_payments")
    assert shown(spark, f"{schema}.order_payments") == [1]


def test_other_columns(spark, schema, dies_at):
    """A build with other columns that dies anywhere leaves the old table or the new one."""
    save_table(spark.range(3), schema, "mart")
    before = spark.table(f"{schema}.mart")
    save_table(spark.range(4).withColumnRenamed("id", "other"), schema, "mart")
    assert before.count() == 3  # its files are still there
    assert spark.table(f"{schema}.mart").columns == ["other"]
    for owner, step, after, columns in [
        (versions.VersionLog, "publish", False, ["other"]),
        (tables, "_show", False, ["third"]),
    ]:
        dies_at(owner, step, after)
        with pytest.raises(Died):
            save_table(spark.range(5).withColumnRenamed("id", "third"), schema, "mart")
        settle(spark, schema, "mart")
        assert spark.table(f"{schema}.mart").columns == columns
    # Dead between the two names: the entry is gone, and made anew from the manifest.
    spark.sql(f"DROP TABLE {schema}.mart")
    settle(spark, schema, "mart")
    assert spark.table(f"{schema}.mart").count() == 5
    assert not [t for t in spark.catalog.listTables(schema) if "_next_" in t.name]


def test_a_managed_table_of_other_columns_keeps_its_files(spark, schema):
    spark.range(3).write.format("parquet").saveAsTable(f"{schema}.mart")
    before = spark.table(f"{schema}.mart")
    before.explain()
    save_table(spark.range(4).withColumnRenamed("id", "other"), schema, "mart")
    assert (before.count(), spark.table(f"{schema}.mart").count()) == (3, 4)


def test_appends_at_once(spark, schema, payments):
    create_silver_tables(spark, schema)
    load_rows(payments(0), schema, "order_payments")
    threads = [
        threading.Thread(target=load_rows, args=(payments(k), schema, "order_payments", True)) for k in (1, 2, 3, 4)
    ]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    spark.catalog.refreshTable(f"{schema}.order_payments")
    assert shown(spark, f"{schema}.order_payments") == [0, 1, 2, 3, 4]


def test_an_append_run_twice_adds_once(spark, schema, payments, dies_at):
    create_silver_tables(spark, schema)
    name = f"{schema}.order_payments"
    for _ in range(3):
        load_rows(payments(1), schema, "order_payments", append=True, load_id="day-1")
    assert shown(spark, name) == [1]
    # Dead before it was recorded, and after: the second try adds the rows, or finishes the first.
    for after in (False, True):
        dies_at(versions.VersionLog, "record_append", after)
        for outcome in (Died, None):
            if outcome:
                with pytest.raises(outcome):
                    load_rows(payments(2), schema, "order_payments", append=True, load_id=f"late-{after}")
            else:
                load_rows(payments(2), schema, "order_payments", append=True, load_id=f"late-{after}")
    assert shown(spark, name) == [1, 2, 2]
    load_rows(payments(5), schema, "order_payments")
    load_rows(payments(6), schema, "order_payments")
    tables._log(spark, schema, "order_payments").clean(lease_hours=0)
    load_rows(payments(1), schema, "order_payments", append=True, load_id="day-1")
    assert shown(spark, name) == [6]
