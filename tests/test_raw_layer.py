"""The raw layer over tables of a few own rows: whole, compressed, and never stored twice."""

import re
from contextlib import contextmanager
from datetime import datetime, timedelta

import pytest
from helpers import bronze_line, write_csv

import __spark_entry__ as entry
from loanlens import scratch
from loanlens.catalog import tables
from loanlens.plans import medallion
from loanlens.sources import bronze, messy
from loanlens.sources.statements import joined_lines, latest_statements, statements
from loanlens.streaming import alerts

DAY = datetime(1995, 3, 4)
TABLES = {
    "region": ("r_regionkey bigint, r_name string", [(0, "ASIA")]),
    "nation": (
        "n_nationkey bigint, n_name string, n_regionkey bigint",
        [(1, "JAPAN", 0), (2, "CHINA", 0)],
    ),
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey bigint, c_mktsegment string",
        [(7, "Ministry", 1, "BUILDING"), (8, "Council", 2, "BUILDING")],
    ),
    "supplier": ("s_suppkey bigint, s_nationkey bigint", [(3, 2)]),
    "part": (
        "p_partkey bigint, p_name string, p_size int",
        [(key, f"part {key}", 10) for key in (1, 59, 97)],
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp, o_orderpriority string",
        [(5, 7, "O", 900_000.0, DAY, "1-URGENT"), (6, 8, "F", 900_000.0, DAY, "2-HIGH")],
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp",
        [
            (order, part, 3, number, 10.0, 0.05, 0.02, "R", "F", DAY)
            for order, part, number in [(5, 1, 1), (5, 59, 2), (5, 97, 3), (6, 1, 1), (6, 1, 4)]
        ],
    ),
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).write.parquet(str(root / f"{name}.parquet"))
    return str(root)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_newest_statement_is_chosen_where_the_join_left_it(spark, folder):
    latest = latest_statements(spark, folder)
    text = plan(latest)
    assert "hashpartitioning(loan_number" not in text
    assert text.count("hashpartitioning(l_orderkey") == 1
    numbers = {r.loan_number: r.project_id for r in latest.collect()}
    assert numbers == {"L5": "P000001", "L6": "P000001"}
    assert statements(spark, folder).count() == 5


def test_parts_are_named_after_the_choice(spark, tmp_path):
    tables_now = dict(TABLES)
    schema, parts = TABLES["part"]
    tables_now["part"] = (schema, parts + parts)  # every part twice
    schema, lines = TABLES["lineitem"]
    later = DAY + timedelta(days=1)
    no_part = (5, 999, 3, 4, 10.0, 0.05, 0.02, "R", "F", later)
    tables_now["lineitem"] = (schema, [*lines, no_part])  # newer, but of no known part
    for name, (schema, rows) in tables_now.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    latest = latest_statements(spark, str(tmp_path))
    text = plan(latest)
    named = re.search(r"\[l_partkey#\d+L?\], \[p_partkey#\d+L?\], Inner", text)
    assert named.start() < text.index("Window [")  # names do not travel with every line
    found = [(r.loan_number, r.project_id) for r in latest.collect()]
    assert sorted(found) == [("L5", "P000001"), ("L6", "P000001")]


def test_a_loan_lies_side_by_side(spark, folder):
    rows = [r.loan_number for r in statements(spark, folder).coalesce(1).collect()]
    changes = sum(a != b for a, b in zip(rows, rows[1:]))
    assert changes == 1


def test_dates_have_the_four_patterns(spark, folder):
    rows = tables.raw_rows(spark, folder).select("l_linenumber", "end_of_period").distinct()
    assert {tuple(r) for r in rows.collect()} == {
        (1, "1995-03-04T00:00:00"),
        (2, "03/04/1995"),
        (3, "1995-03-04"),
        (4, "1995-03-04T00:00:00.000"),
    }


def test_raw_files_and_copies_are_compressed(spark, folder):
    for path in (tables.bronze_dir(spark, folder), tables.copies_dir(spark, folder)):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        names = [r.path for r in files.select("path").collect() if ".csv" in r.path]
        assert names and all(name.endswith(".csv.gz") for name in names)
    raw = bronze.read_bronze(spark, tables.bronze_dir(spark, folder))
    good, bad = bronze.split_quarantine(raw)
    assert (good.count(), bad.count()) == (4, 1)


def test_every_row_the_stream_took_is_accounted_for(spark, folder):
    rows = entry.queries()["alert_ingestion"](spark, folder).collect()
    # Four readable rows are above the limit, one of them without a loan number.
    assert {r.risk_level: (r.alerts, r.with_time, r.with_file) for r in rows} == {
        "CRITICAL": (4, 4, 4),
        "UNREADABLE": (1, 1, 1),
    }


def keep_folders(monkeypatch, module, root):
    @contextmanager
    def temporary(_, name):
        yield f"{root}/{name}"

    monkeypatch.setattr(module, "temporary", temporary)


LINES = [
    bronze_line(loan_number="L1", cancelled_amount=5),
    bronze_line(loan_number="L2", cancelled_amount=2_000_000),
    bronze_line(loan_number=""),
    bronze_line(loan_number="L3") + ",surplus",
]


def test_good_rows_are_not_stored_on_their_way_to_silver(spark, tmp_path, monkeypatch):
    write_csv(tmp_path / "raw" / "1.csv", LINES)
    keep_folders(monkeypatch, medallion, tmp_path / "kept")
    counts = medallion.bronze_to_silver(
        spark, str(tmp_path / "raw"), str(tmp_path / "silver"), "20240131"
    )
    assert counts == (4, 1, 1, 2)
    staged = spark.read.parquet(str(tmp_path / "kept" / "raw"))
    good = staged.where("_fate = 'good'").drop("_fate")
    assert good.count() == 2 and good.dropna("all").count() == 0


def test_rows_without_alert_are_not_stored_by_the_stream(spark, tmp_path, monkeypatch):
    write_csv(tmp_path / "in" / "1.csv", LINES)
    keep_folders(monkeypatch, alerts, tmp_path / "kept")
    out = alerts.run_alerts(
        spark, str(tmp_path / "in"), None, str(tmp_path / "check"), str(tmp_path / "out")
    )
    assert [r.loan_number for r in out.collect()] == ["L2"]
    staged = spark.read.parquet(str(tmp_path / "kept" / "stream"))
    assert staged.count() == 3
    assert alerts.recorded_quarantine(spark, str(tmp_path / "out")).count() == 2


def test_raw_files_are_written_in_methods_that_java_compiles(spark, tmp_path, monkeypatch):
    key, seen, before = "spark.sql.codegen.hugeMethodLimit", [], spark.conf.get("spark.sql.codegen.hugeMethodLimit", None)
    plain = messy.as_files
    monkeypatch.setattr(messy, "as_files", lambda rows: seen.append(spark.conf.get(key)) or plain(rows))
    joined = joined_lines(spark, "/root/testdata/sf0.001").limit(200)
    messy.write_bronze(messy.messy_statements(joined), str(tmp_path / "raw"))
    assert seen[0] == "8000" and spark.conf.get(key, None) == before
    with scratch.compiled(spark), scratch.compiled(spark):
        assert spark.conf.get(key) == "8000"
    assert spark.conf.get(key, None) == before
