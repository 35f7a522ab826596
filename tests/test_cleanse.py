import pytest
from helpers import raw_rows
from pyspark.sql import functions as F

from loanlens import contract
from loanlens.operators import cleanse, quality


def test_names():
    named = [cleanse.standard_name(h) for h in contract.BRONZE_HEADER]
    assert named == contract.COLUMNS
    odd = "  Original Principal Amount (USD) "
    assert cleanse.standard_name(odd) == "original_principal_amount_usd"
    assert cleanse.standard_name("Borrower’s Obligation") == "borrowers_obligation"


def test_name_clash_is_an_error(spark):
    with pytest.raises(ValueError, match="a_b"):
        cleanse.standardize_names(spark.createDataFrame([(1, 2)], ["A b", "a-B"]))


def test_numbers(spark):
    texts = ["abc", "1,000", "", " 7 ", "1e3", None]
    df = raw_rows(spark, *[{"cancelled_amount": t} for t in texts])
    read = [r.cancelled_amount for r in cleanse.cast_numbers(df).collect()]
    assert read == [None, None, None, 7.0, 1000.0, None]
    filled = cleanse.fill_defaults(cleanse.cast_numbers(df))
    assert [r.cancelled_amount for r in filled.collect()] == [0, 0, 0, 7, 1000, 0]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-01-31T00:00:00.000", "2024-01-31"),
        ("2024-01-31T13:14:15", "2024-01-31"),
        ("01/31/2024", "2024-01-31"),
        ("2024-01-31", "2024-01-31"),
        ("1/5/2024", None),
        ("13/31/2024", None),
        ("2024-02-30", None),
        ("2024-01-31T00:00", None),
        ("bad", None),
        ("Thursday", None),
        ("", None),
        (None, None),
    ],
)
def test_dates(spark, text, expected):
    df = raw_rows(spark, {"board_approval_date": text})
    row = cleanse.parse_dates(df).first()
    assert (str(row.board_approval_date) if expected else row.board_approval_date) == expected


def test_date_shape_choice_equals_trying_all_patterns(spark):
    texts = ["2024-01-31T00:00:00.000", "2024-01-31T00:00:00", "01/31/2024", "2024-01-31"]
    texts += [t + "x" for t in texts] + [t.replace("2024", "24") for t in texts]
    df = raw_rows(spark, *[{"board_approval_date": t} for t in texts])
    column = "board_approval_date"
    tried = F.coalesce(*[F.try_to_date(F.col(column), f) for f in contract.DATE_FORMATS])
    rows = df.select(cleanse.date_from_text(column).alias("a"), tried.alias("b")).collect()
    assert all(r.a == r.b for r in rows)


def test_missing_columns_are_added_and_filled(spark):
    df = raw_rows(spark, {}).drop("region", "loans_held", "closed_date_most_recent")
    row = cleanse.cleanse(df).first()
    assert row.region == "Unknown" and row.loans_held == 0.0
    assert row.closed_date_most_recent is None


def test_latest_snapshot_and_idempotence(spark):
    df = raw_rows(
        spark,
        {"end_of_period": "2024-01-31", "cancelled_amount": "1"},
        {"end_of_period": "02/29/2024", "cancelled_amount": "2"},
        {"end_of_period": "02/29/2024", "cancelled_amount": "2"},
        {"end_of_period": None, "cancelled_amount": "9"},
        {"loan_number": "L2", "end_of_period": None},
        {"loan_number": None},
    )
    silver = cleanse.cleanse(df)
    rows = {r.loan_number: r for r in silver.collect()}
    assert set(rows) == {"L1", "L2", None} and rows["L1"].cancelled_amount == 2.0
    again = cleanse.latest_loans(cleanse.fill_defaults(silver))
    assert sorted(map(str, again.collect())) == sorted(map(str, silver.collect()))


def test_warehouse_types_round_and_count_losses(spark):
    df = spark.createDataFrame([("1.005", "x"), ("2", "3")], "a string, b string")
    out = cleanse.warehouse_types(df, {"a": "decimal(18,2)", "b": "bigint"}).collect()
    assert [(str(r.a), r.b, r["_cast_failures"]) for r in out] == [("1.01", None, 1), ("2.00", 3, 0)]


def test_trim(spark):
    df = spark.createDataFrame([(" a ", 1)], "t string, n int")
    assert cleanse.trim_text(df).first() == ("a", 1)


def test_quality_tables(spark):
    df = raw_rows(spark, {"region": None}, {"interest_rate": "n/a"}, {"country": "Xland"})
    nulls = {r.column_name: r.null_percent for r in quality.null_percentages(df).collect()}
    assert nulls["region"] == 33.33 and nulls["country"] == 0.0 and len(nulls) == 33
    lost = {r.column_name: r.cast_failures for r in quality.cast_failures(df).collect()}
    assert lost["interest_rate"] == 1 and sum(lost.values()) == 1
    one = quality.profile(df).first()
    assert (one.row_count, one.column_count, one.distinct_country) == (3, 33, 2)
    assert one.distinct_region == 1  # a missing region is no value
    empty = quality.null_percentages(df.limit(0)).collect()
    assert {r.null_percent for r in empty} == {0.0}
    assert not quality.validate_landing(df.limit(0)).first().passed
    assert quality.validate_landing(df, 3).first().passed
    long = quality.length_violations(df, {"country": 4}).first()
    assert (long.violations, long.longest) == (3, 5)
