"""Loading, storing and reading back."""

from collections import Counter
from types import SimpleNamespace

import pytest
from bank import AS_OF, hand_made

from ledgerloom import FinanceModels, TableSink, load, refresh, register_views
from ledgerloom.plans.models import PUBLISHED
from ledgerloom.plans.refresh import ChecksFailed, Refreshed
from ledgerloom.sources import schemas
from ledgerloom.sources.scratch import scratch_folder


def rows(table):
    return Counter(tuple(r) for r in table.select(*sorted(table.columns)).collect())


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_stored_tables_equal_lazy_ones(spark, tmp_path, fmt):
    raw = hand_made(spark)
    done = refresh(raw, TableSink(fmt=fmt, path=str(tmp_path)), AS_OF)
    lazy = FinanceModels(raw, AS_OF)
    assert list(done.tables) == list(PUBLISHED.values())
    for attribute, name in PUBLISHED.items():
        assert rows(done.tables[name]) == rows(getattr(lazy, attribute)), name
    assert done.checks.count() == 77


def test_refresh_replaces_and_views_store_nothing(spark, tmp_path):
    raw = hand_made(spark)
    sink = TableSink(path=str(tmp_path))
    staging = {name for name in PUBLISHED.values() if name.startswith("stg_")}
    for _ in range(2):
        done = refresh(raw, sink, AS_OF, views=staging)
    assert done.tables["stg_finance__accounts"].count() == 8
    assert done.tables["fct_customer_360"].count() == 4
    assert not (tmp_path / "stg_finance__accounts").exists()
    assert (tmp_path / "fct_customer_360").exists()


@pytest.mark.parametrize("namespace", ["default", "ledgerloom_check"])
def test_catalog_sink(spark, tmp_path, namespace):
    sink = TableSink(path=str(tmp_path), namespace=namespace)
    table = FinanceModels(hand_made(spark), AS_OF).stg_fees
    for _ in range(2):
        back = sink.publish("ledgerloom_sink_check", table)
    assert rows(back) == rows(table)
    assert rows(spark.table(f"{namespace}.ledgerloom_sink_check")) == rows(table)
    assert (tmp_path / "ledgerloom_sink_check").exists()


def test_sql_over_registered_views(spark):
    register_views(hand_made(spark), AS_OF)
    found = spark.sql(
        """SELECT region_name, sum(total_balance) AS balance
        FROM fct_account_summary JOIN (
          SELECT customer_id, total_balance FROM fct_customer_360
        ) USING (customer_id)
        WHERE is_dormant_account GROUP BY region_name ORDER BY region_name"""
    ).collect()
    assert [(r.region_name, str(r.balance)) for r in found] == [
        ("Northeast", "0.00"),
        ("Southeast", "0.00"),
    ]


def test_sink_needs_a_target():
    with pytest.raises(ValueError):
        TableSink()


def test_load_csv_with_built_in_and_own_reference_lists(spark, tmp_path):
    raw = hand_made(spark)
    written = {
        "a_m": raw.accounts,
        "c_m": raw.customers,
        "f_l": raw.fees,
        "t_l": raw.transactions,
        "branches": raw.branches,
        "divisions": raw.divisions,
    }
    for name, table in written.items():
        table.write.option("header", "true").csv(f"{tmp_path}/{name}.csv")
    for reference in (None, str(tmp_path)):
        loaded = load(spark, str(tmp_path), reference_location=reference)
        assert rows(loaded.accounts) == rows(raw.accounts)
        assert rows(loaded.customers) == rows(raw.customers)
        assert rows(loaded.fees) == rows(raw.fees)
        assert rows(loaded.transactions) == rows(raw.transactions)
        assert rows(loaded.branches) == rows(raw.branches)
        assert rows(loaded.divisions) == rows(raw.divisions)


def test_load_stops_on_a_malformed_row(spark, tmp_path):
    header = ",".join(field.name for field in schemas.DIVISIONS)
    for name in schemas.LEDGERS:
        (tmp_path / f"{name}.csv").write_text("x\n")
    (tmp_path / "divisions.csv").write_text(header + "\r\nRB,Retail Banking\r\nCB,Commercial,extra\r\n")
    (tmp_path / "branches.csv").write_text(
        "branch_code,branch_name,region_code,division_code\r\nBR001,Boston Retail,NE,RB\r\n"
    )
    loaded = load(spark, str(tmp_path), reference_location=str(tmp_path))
    assert [tuple(r) for r in loaded.branches.collect()] == [("BR001", "Boston Retail", "NE", "RB")]
    with pytest.raises(Exception, match="MALFORMED"):
        loaded.divisions.collect()


def test_load_stops_on_columns_in_another_order(spark, tmp_path):
    for name, schema in {**schemas.LEDGERS, **schemas.REFERENCE_LISTS}.items():
        header = ",".join(reversed([field.name for field in schema]))
        (tmp_path / f"{name}.csv").write_text(f"{header}\nRB,CB\n")
    loaded = load(spark, str(tmp_path), reference_location=str(tmp_path))
    with pytest.raises(Exception, match="header"):
        loaded.divisions.collect()


def test_load_parquet_and_tables(spark, tmp_path):
    raw = hand_made(spark)
    ledgers = {
        "a_m": raw.accounts,
        "c_m": raw.customers,
        "f_l": raw.fees,
        "t_l": raw.transactions,
    }
    for name, table in ledgers.items():
        table.write.parquet(f"{tmp_path}/{name}")
        table.write.mode("overwrite").option("path", f"{tmp_path}/t/{name}").saveAsTable(
            f"default.{name}"
        )
    for loaded in (load(spark, str(tmp_path), "parquet"), load(spark, "default", "table")):
        assert rows(loaded.transactions) == rows(raw.transactions)


def session_with(master, **settings):
    conf = SimpleNamespace(get=lambda name, default: settings.get(name, default))
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_scratch_folder_is_shared_on_a_cluster(spark):
    shared = session_with("yarn", **{"spark.checkpoint.dir": "/shared/folder/"})
    assert scratch_folder(shared).startswith("/shared/folder/ledgerloom-")
    with pytest.raises(RuntimeError):
        scratch_folder(session_with("yarn"))
    assert scratch_folder(spark) != scratch_folder(spark)


def test_report_is_stored_and_errors_can_stop(spark, tmp_path):
    done = refresh(hand_made(spark), TableSink(path=str(tmp_path)), AS_OF)
    assert rows(spark.read.parquet(f"{tmp_path}/data_checks")) == rows(done.checks)
    columns = "table_name string, column_name string, test string, outcome string"
    warned = [("f_l", "t_id", "relationships", "warn"), ("f_l", "f_id", "unique", "pass")]
    Refreshed({}, spark.createDataFrame(warned, columns)).require_passed()
    failed = [*warned, ("a_m", "a_id", "unique", "fail")]
    with pytest.raises(ChecksFailed, match="a_m.a_id unique"):
        Refreshed({}, spark.createDataFrame(failed, columns)).require_passed()
