import time

import pytest
from helpers import bronze_line, write_csv
from pyspark.errors import StreamingQueryException

from loanlens import contract
from loanlens.operators import cleanse
from loanlens.sources import bronze
from loanlens.streaming import alerts

FIELDS = contract.BRONZE_HEADER


def line(number, cancelled, **changes):
    return bronze_line(loan_number=number, cancelled_amount=cancelled, **changes)


def run(spark, root):
    return alerts.run_alerts(
        spark,
        str(root / "in"),
        str(root / "archive"),
        str(root / "checkpoint"),
        str(root / "out"),
    )


def test_restart_neither_loses_nor_repeats(spark, tmp_path):
    for i in range(7):  # more files than one trigger takes
        write_csv(tmp_path / "in" / f"{i}.csv", [line(f"L{i}", 2_000_000), line("x", 5)], FIELDS)
    first = run(spark, tmp_path)
    assert sorted(r.loan_number for r in first.collect()) == [f"L{i}" for i in range(7)]
    assert run(spark, tmp_path).count() == 7
    write_csv(tmp_path / "in" / "late.csv", [line("L9", 20_000_000)], FIELDS)
    rows = {r.loan_number: r for r in run(spark, tmp_path).collect()}
    assert len(rows) == 8 and rows["L9"].risk_level == "CRITICAL"
    assert rows["L9"].source_file.endswith("late.csv") and rows["L9"].ingestion_timestamp
    assert list(rows["L9"].asDict()) == contract.ALERT_COLUMNS
    assert list((tmp_path / "archive").rglob("*.csv"))  # handled files moved away


def test_batch_and_stream_agree(spark, tmp_path):
    amounts = [1_000_000, 1_000_001, 5_000_000, 10_000_000, 10_000_001]
    lines = [line(f"L{a}", a, original_principal_amount=3 * a) for a in amounts]
    lines.append(line("zero", 3_000_000, original_principal_amount=0))
    lines += ["a line,that does not fit", line(None, 2_000_000), line(" ", 5)]
    write_csv(tmp_path / "in" / "a.csv", lines, FIELDS)
    good, _ = bronze.split_quarantine(bronze.read_bronze(spark, str(tmp_path / "in")))
    good = good.where(~bronze.lacks_key(good))
    expected = alerts.high_risk(cleanse.typed_rows(good)).collect()
    streamed = run(spark, tmp_path).drop("ingestion_timestamp", "source_file").collect()
    assert sorted(expected) == sorted(streamed) and len(expected) == 5
    ratios = {r.loan_number: r.cancellation_ratio for r in expected}
    assert ratios["L5000000"] == 33.33 and ratios["zero"] == 0.0


def recorded(spark, root):
    found = alerts.recorded_quarantine(spark, str(root / "out")).collect()
    return sorted(((r.reason, r[contract.CORRUPT] or r["Loan Number"]) for r in found), key=str)


def test_unusable_rows_are_set_apart_once(spark, tmp_path):
    surplus = line("L1", 5) + ",surplus"
    write_csv(tmp_path / "in" / "a.csv", [surplus, line("L2", 2_000_000), line(None, 1)], FIELDS)
    write_csv(tmp_path / "in" / "b.csv", ["short", line(" ", 9_000_000)], FIELDS)
    expected = [("corrupt", "short"), ("corrupt", surplus), ("without_key", " "), ("without_key", None)]
    assert [r.loan_number for r in run(spark, tmp_path).collect()] == ["L2"]
    assert recorded(spark, tmp_path) == sorted(expected, key=str)
    run(spark, tmp_path)
    assert len(recorded(spark, tmp_path)) == 4
    rows = alerts.recorded_quarantine(spark, str(tmp_path / "out")).collect()
    assert all(r.source_file.endswith(".csv") and r.ingestion_timestamp for r in rows)


def test_a_batch_that_failed_half_way_is_repeated_whole(spark, tmp_path, monkeypatch):
    for i in range(7):
        write_csv(tmp_path / "in" / f"{i}.csv", [line(f"L{i}", 2_000_000), "short"], FIELDS)
    whole = alerts._record

    def fail_after_storing(batch, number, *where):
        whole(batch, number, *where)
        raise RuntimeError("lost before the checkpoint knew")

    monkeypatch.setattr(alerts, "_record", fail_after_storing)
    with pytest.raises(StreamingQueryException):
        run(spark, tmp_path)
    monkeypatch.setattr(alerts, "_record", whole)
    assert sorted(r.loan_number for r in run(spark, tmp_path).collect()) == [f"L{i}" for i in range(7)]
    assert len(recorded(spark, tmp_path)) == 7


def test_stopped_after_the_first_batch_and_resumed(spark, tmp_path):
    for i in range(7):
        write_csv(tmp_path / "in" / f"{i}.csv", [line(f"L{i}", 2_000_000)], FIELDS)
    where = (str(tmp_path / "checkpoint"), str(tmp_path / "out"))
    raw = alerts.read_raw_stream(spark, str(tmp_path / "in"), files_per_trigger=2)
    query = alerts.start_recording(raw, *where, interval="1 hour")
    while query.isActive and query.lastProgress is None:
        time.sleep(0.1)
    query.stop()
    assert alerts.recorded_alerts(spark, where[1]).count() == 2
    alerts.start_recording(raw, *where, available_now=True).awaitTermination()
    found = alerts.recorded_alerts(spark, where[1])
    assert sorted(r.loan_number for r in found.collect()) == [f"L{i}" for i in range(7)]


def test_nothing_recorded_yet(spark, tmp_path):
    assert alerts.recorded_alerts(spark, str(tmp_path / "out")).columns == contract.ALERT_COLUMNS
    assert alerts.recorded_quarantine(spark, str(tmp_path / "out")).count() == 0


def test_swapped_columns_stop_the_job(spark, tmp_path):
    swapped = [FIELDS[1], FIELDS[0], *FIELDS[2:]]
    write_csv(tmp_path / "in" / "a.csv", [line("L1", 2_000_000)], swapped)
    with pytest.raises(StreamingQueryException):
        run(spark, tmp_path)
    assert not list((tmp_path / "out").rglob("*.parquet"))


def test_console_and_interval(spark, tmp_path):
    write_csv(tmp_path / "in" / "a.csv", [line("L1", 2_000_000)], FIELDS)
    stream = alerts.read_statement_stream(spark, str(tmp_path / "in"), str(tmp_path / "archive"))
    query = alerts.start_alerts(
        alerts.high_risk(alerts.enrich(stream)), str(tmp_path / "checkpoint"), interval="1 second"
    )
    try:
        assert query.name == alerts.QUERY_NAME
        query.processAllAvailable()
        assert sum(p["numInputRows"] for p in query.recentProgress) == 1
    finally:
        query.stop()
