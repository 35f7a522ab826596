import json
from datetime import datetime

import pytest
from helpers import BASE, bronze_line, write_csv

from loanlens import contract
from loanlens.plans import medallion
from loanlens.sources import bronze, lake
from loanlens.streaming import loader


def test_quarantine_keeps_the_line_whole(spark, tmp_path):
    bad, short = bronze_line() + ",extra", "L9,too,short"
    write_csv(tmp_path / "a.csv", [bronze_line(), bad, short])
    good, malformed = bronze.split_quarantine(bronze.read_bronze(spark, str(tmp_path)))
    assert good.count() == 1 and malformed.count() == 2
    lines = {r[contract.CORRUPT] for r in malformed.select(contract.CORRUPT, "Region").collect()}
    assert lines == {bad, short}


def test_malformed_does_not_depend_on_the_columns_used(spark, tmp_path):
    write_csv(tmp_path / "a.csv", [bronze_line(), bronze_line() + ",extra"])
    good, _ = bronze.split_quarantine(bronze.read_bronze(spark, str(tmp_path)))
    assert good.select("Region").count() == 1
    assert good.select("Loan Number").collect() == [("L1",)]


def test_raw_to_silver(spark, tmp_path):
    lines = [
        bronze_line(country_code="01"),
        bronze_line(loan_number="L2", country_code="2"),
        bronze_line(loan_number="L3", region=None, cancelled_amount="junk"),
        bronze_line() + ",extra",
        bronze_line(loan_number=None),
        bronze_line(loan_number=" "),
    ]
    write_csv(tmp_path / "bronze" / "a.csv", lines)
    source, silver_path = str(tmp_path / "bronze"), str(tmp_path / "silver")
    counts = medallion.bronze_to_silver(spark, source, silver_path, "20240131")
    assert counts == (6, 1, 2, 3)
    silver = lake.read_silver(spark, silver_path)
    rows = {r.loan_number: r for r in silver.collect()}
    assert {r.country_code for r in rows.values()} == {"01", "2"}  # still texts
    assert rows["L3"].region == "Unknown" and rows["L3"].cancelled_amount == 0.0
    assert rows["L1"].borrowers_obligation == 40.0
    kept = list((tmp_path / "bronze" / "_quarantine").rglob("*.csv"))
    assert any("extra" in f.read_text() for f in kept)
    keyless = (tmp_path / "bronze" / "_quarantine" / "rows_without_key_20240131").glob("*.csv")
    assert sum(f.read_text().count("2024-01-31") for f in keyless) == 2
    # The quarantine folder is not read as raw data, and a rerun changes nothing.
    assert medallion.bronze_to_silver(spark, source, silver_path, "20240131") == (6, 1, 2, 3)


def test_land_pages_unites_fields(spark, tmp_path):
    pages = [{"loan": "L1", "a": 1}, {"loan": "L2", "b": "x"}, {"loan": "L3", "a": None}]
    for i, page in enumerate(pages):
        (tmp_path / f"{i}.json").write_text(json.dumps(page))
    landed = bronze.land_pages(spark, str(tmp_path))
    assert sorted(landed.columns) == ["a", "b", "loan"]
    rows = {r.loan: (r.a, r.b) for r in landed.collect()}
    assert rows == {"L1": ("1", ""), "L2": ("", "x"), "L3": ("", "")}


def test_copy_csv(spark, tmp_path):
    quoted = bronze_line(project_name='"a, \\"b\\""')
    write_csv(tmp_path / "in" / "a.csv", [quoted, bronze_line(region=None), "too,short"])
    moment = datetime(2024, 1, 31, 2, 3, 4)
    audit = bronze.copy_csv(spark, str(tmp_path / "in"), str(tmp_path / "out"), now=moment)
    assert audit.target.endswith("batch=20240131_020304")
    assert (audit.rows_read, audit.rows_copied, audit.status) == (3, 2, "PARTIAL")
    assert audit.bytes_written > 0
    copied = bronze.read_bronze(spark, audit.target)
    rows = {(r["Project Name"], r["Region"]) for r in copied.collect()}
    assert rows == {('a, "b"', "ASIA"), ("Roads", None)}
    files = list((tmp_path / "out").rglob("*.csv"))
    assert all(f.read_text().startswith('"End of Period"') for f in files)


def test_copies_are_audited_and_failures_too(spark, tmp_path):
    write_csv(tmp_path / "in" / "a.csv", [bronze_line(), "too,short"])
    out = str(tmp_path / "out")
    assert bronze.copy_audits(spark, out).count() == 0
    first = bronze.copy_csv(spark, str(tmp_path / "in"), out, now=datetime(2024, 1, 1))
    bronze.copy_csv(spark, first.target, out, now=datetime(2024, 1, 2))
    with pytest.raises(Exception):
        bronze.copy_csv(spark, str(tmp_path / "in"), out, now=datetime(2024, 1, 2))  # folder is taken
    rows = bronze.copy_audits(spark, out).orderBy("copied_at", "status").collect()
    assert [(r.status, r.rows_read, r.rows_copied) for r in rows] == [
        ("PARTIAL", 2, 1), ("FAILED", 0, 0), ("SUCCESS", 1, 1),
    ]
    assert rows[0].source == str(tmp_path / "in") and rows[0].bytes_written == first.bytes_written > 0


def test_quoted_line_breaks(spark, tmp_path):
    broken = bronze_line(borrower='"Ministry\nof roads"')
    write_csv(tmp_path / "raw" / "a.csv", [broken, bronze_line(loan_number="L2"), "short"])
    source, silver = str(tmp_path / "raw"), str(tmp_path / "silver")
    assert medallion.bronze_to_silver(spark, source, silver, "d") == (4, 3, 0, 1)
    assert medallion.bronze_to_silver(spark, source, silver, "d", multi_line=True) == (3, 1, 0, 2)
    names = {r.loan_number: r.borrower for r in lake.read_silver(spark, silver).collect()}
    assert names == {"L1": "Ministry\nof roads", "L2": "Ministry"}


def files_of(path):
    return {f.name for f in path.glob("*.parquet")}


def test_merging_a_delivery_rewrites_only_its_countries(spark, tmp_path):
    silver = tmp_path / "silver"
    places = {"L1": "A", "L2": "A", "L3": "B", "L4": "C", "L5": "C D/1"}
    stay = [bronze_line(loan_number=n, country_code=c) for n, c in places.items()]
    write_csv(tmp_path / "one" / "a.csv", stay)
    medallion.bronze_to_silver(spark, str(tmp_path / "one"), str(silver), "d", merge=True)
    untouched = files_of(silver / "country_code=A")
    late = dict(end_of_period="2024-02-29", cancelled_amount="77")
    moves = [
        bronze_line(loan_number="L3", country_code="C", **late),  # B loses its last loan
        bronze_line(loan_number="L4", country_code="E", end_of_period="2023-01-31"),  # too old to move
        bronze_line(loan_number="L5", country_code="F", **late),
        bronze_line(loan_number="L6", country_code="E"),
    ]
    write_csv(tmp_path / "two" / "a.csv", [*moves, moves[0]])
    for _ in range(2):  # the second time changes nothing
        counts = medallion.bronze_to_silver(spark, str(tmp_path / "two"), str(silver), "d", merge=True)
        assert counts == (5, 0, 0, 6)
        rows = {r.loan_number: (r.country_code, r.cancelled_amount) for r in lake.read_silver(spark, str(silver)).collect()}
        assert rows == {
            "L1": ("A", 10.0), "L2": ("A", 10.0), "L3": ("C", 77.0), "L4": ("C", 10.0), "L5": ("F", 77.0), "L6": ("E", 10.0),
        }
        assert files_of(silver / "country_code=A") == untouched
        assert sorted(p.name for p in silver.glob("country_code=*")) == [f"country_code={c}" for c in "ACEF"]


def test_columns_go_by_name(spark, tmp_path):
    header = [contract.BRONZE_HEADER[1], contract.BRONZE_HEADER[0], *contract.BRONZE_HEADER[2:], "New"]
    values = [*bronze_line().split(","), "n"]
    values[0], values[1] = values[1], values[0]
    write_csv(tmp_path / "in" / "a.csv", [",".join(values)], header)
    silver = str(tmp_path / "silver")
    assert medallion.bronze_to_silver(spark, str(tmp_path / "in"), silver, "d") == (1, 0, 0, 1)
    row = lake.read_silver(spark, silver).first()
    assert row.loan_number == "L1" and str(row.end_of_period) == "2024-01-31"


def test_files_with_another_header_stop_the_job(spark, tmp_path):
    write_csv(tmp_path / "a.csv", [bronze_line()])
    swapped = [contract.BRONZE_HEADER[1], contract.BRONZE_HEADER[0], *contract.BRONZE_HEADER[2:]]
    write_csv(tmp_path / "b.csv", [bronze_line()], swapped)
    with pytest.raises(Exception):
        bronze.read_bronze(spark, str(tmp_path)).collect()


def test_pages_to_silver(spark, tmp_path):
    pages = [{**BASE, "loan_number": "L1"}, {**BASE, "loan_number": "L2"}]
    del pages[1]["region"], pages[1]["cancelled_amount"]
    lines = "\n".join(json.dumps(p) for p in pages)
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "0.json").write_text(lines)
    bronze.write_landed(bronze.land_pages(spark, str(tmp_path / "pages")), str(tmp_path / "raw"))
    silver = str(tmp_path / "silver")
    assert medallion.bronze_to_silver(spark, str(tmp_path / "raw"), silver, "d") == (2, 0, 0, 2)
    rows = {r.loan_number: r for r in lake.read_silver(spark, silver).collect()}
    assert rows["L2"].region == "Unknown" and rows["L2"].cancelled_amount == 0.0
    assert rows["L1"].region == "ASIA"


def test_whole_flow(spark, tmp_path):
    lines = [bronze_line(loan_number=f"L{i}", country_code=f"0{i % 2}") for i in range(5)]
    write_csv(tmp_path / "bronze" / "a.csv", [*lines, "broken"])
    counts = medallion.run_all(spark, str(tmp_path), "20240131")
    assert counts == {
        "loaded": 6, "corrupt": 1, "without_key": 0, "written": 5, "dim_country": 2, "dim_project": 1,
        "dim_loan_type": 1, "dim_borrower": 1, "fact_loans": 5,
    }
    again = medallion.run_all(spark, str(tmp_path), "20240201")  # Gold is rewritten and reloaded
    assert again == counts
    fact = loader.current_rows(spark, str(tmp_path / "warehouse"), "fact_loans")
    assert fact.count() == 5
