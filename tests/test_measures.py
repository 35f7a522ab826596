from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from loanlens.functions import formats, scalars
from loanlens.operators import ranking
from loanlens.plans import dashboards, kpis, questions


def loans(spark, *rows):
    columns = (
        "loan_number string, original_principal_amount int, "
        "cancelled_amount int, board_approval_date date"
    )
    return spark.createDataFrame(rows, columns)


def test_zero_principal(spark):
    df = spark.createDataFrame([(0.0, 5.0)], "p double, c double")
    row = df.agg(
        F.sum("p").alias("original_principal_amount"), F.sum("c").alias("cancelled_amount")
    )
    known = kpis.fact_measures()
    out = row.agg(
        known["cancellation_rate"].alias("a"), known["regional_cancellation_rate"].alias("b")
    ).first()
    assert out.a is None and out.b == 0.0
    parts = df.select(scalars.ratio("c", "p"), scalars.divide(F.col("c"), F.col("p"), 7.0)).first()
    assert tuple(parts) == (0.0, 7.0)


def test_empty_portfolio(spark):
    empty = loans(spark).where("false")
    row = empty.agg(
        kpis.fact_measures()["total_loan_amount"].alias("t"),
        kpis.fact_measures()["avg_cancellation_per_loan"].alias("a"),
        kpis.fact_measures()["loan_count"].alias("n"),
    ).first()
    assert tuple(row) == (0.0, 0.0, 0)


def test_sums_per_loan_give_the_same_measures(spark):
    amounts = "original_principal_amount", "cancelled_amount", "disbursed_amount", "repaid_to_ibrd", "due_to_ibrd"
    days = "agreement_signing_date", "last_disbursement_date", "effective_date_most_recent", "last_repayment_date", "first_repayment_date"
    schema = ", ".join(
        ["status string", "loan_number string", "board_approval_date date", "interest_rate decimal(8,4)"]
        + [f"{c} decimal(18,2)" for c in amounts] + [f"{c} date" for c in days]
    )
    rows = []
    for i in range(200):
        number = None if i % 17 == 0 else f"L{i % 23}"
        start = None if i % 5 == 0 else date(2000, 1, 1 + i % 28)
        money = [None if i % 7 == k else Decimal(300_000 * ((i * (k + 3)) % 11)) for k in range(5)]
        rows.append((None if i % 13 == 0 else "ab"[i % 2], number, start, Decimal(i % 4), *money, *[date(2003 + k, 2, 1 + i % 9) for k in range(5)]))
    df = spark.createDataFrame(rows, schema)
    for by in ([], ["status"]):
        expected = df.groupBy(*by).agg(*[c.alias(n) for n, c in kpis.fact_measures().items()])
        found = kpis.measure_table(df, list(kpis.fact_measures()), by)
        as_text = lambda d: sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in d.collect())
        assert as_text(found) == as_text(expected)
    nothing = kpis.measure_table(df.where("false"), ["loan_count", "avg_processing_days", "total_due"]).first()
    assert tuple(nothing) == (0, None, 0.0)


def test_sketches_merge_to_a_close_count(spark):
    numbers = spark.range(30_000).select(F.concat(F.lit("L"), F.col("id") % 20_000).alias("loan_number"), (F.col("id") % 7).alias("part"))
    sketches = kpis.loan_sketches(numbers, ["part"])
    assert sketches.count() == 7
    estimate = kpis.estimated_loans(sketches).first().loans
    assert abs(estimate - 20_000) <= kpis.sketch_error() * 20_000
    assert kpis.estimated_loans(kpis.loan_sketches(numbers.where("false"), ["part"]), ["part"]).count() == 0


def test_year_over_year_does_not_bridge_a_gap(spark):
    df = loans(
        spark,
        ("a", 1, 10, date(2000, 5, 1)),
        ("b", 1, 30, date(2002, 5, 1)),
        ("c", 1, 15, date(2003, 5, 1)),
        ("d", 1, 1, None),
    )
    rows = {r.year: r.yoy_cancellation_change for r in kpis.yoy_cancellation(df).collect()}
    assert rows == {2000: None, 2002: None, 2003: -0.5}


def test_top_with_ties(spark):
    df = spark.createDataFrame(
        [("a", 5), ("b", 4), ("c", 3), ("d", 3), ("e", 1)], "country string, total int"
    )
    top = ranking.top_n_with_ties(df, 3, "total")
    assert top.count() == 4
    names = top.agg(ranking.joined_names("country", "total").alias("n")).first().n
    assert names == "a, b, c, d"
    cut = [r.country for r in ranking.top_n(df, 3, "total", ["country"]).collect()]
    assert cut == ["a", "b", "c"]
    ranks = [r.k for r in ranking.dense_rank_by(df, "total", "k").orderBy("country").collect()]
    assert ranks == [1, 2, 3, 3, 4]


@pytest.mark.parametrize(
    "mask, value, text",
    [
        (formats.billions, 1234.565, "$1,234.57B"),
        (formats.billions, -0.5, "-$0.50B"),
        (formats.millions, 0.125, "$0.13M"),
        (formats.millions, 4.225, "$4.23M"),
        (formats.dollars, 1234567.5, "$1,234,568"),
        (formats.dollars, None, "$0"),
        (formats.percent, 0.12345, "12.35%"),
        (formats.percent, 12.5, "1250.00%"),
        (formats.percent, None, "N/A"),
        (formats.signed_percent, 0.1234, "+12.3%"),
        (formats.signed_percent, -0.1234, "-12.3%"),
        (formats.signed_percent, 0.0001, "0.0%"),
        (formats.signed_percent, -0.0001, "0.0%"),
        (formats.signed_percent, None, "N/A"),
        (formats.rate_percent, 4.25, "4.25%"),
    ],
)
def test_masks(spark, mask, value, text):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(mask(F.col("v")).alias("t")).first().t == text


@pytest.mark.parametrize(
    "amount, level",
    [(1_000_001, "ELEVATED"), (5_000_000, "ELEVATED"), (5_000_001, "HIGH"),
     (10_000_000, "HIGH"), (10_000_001, "CRITICAL")],
)
def test_risk_limits(spark, amount, level):
    df = spark.createDataFrame([(float(amount),)], "cancelled_amount double")
    assert df.select(scalars.risk_level().alias("r")).first().r == level


def test_year_boundaries_count_new_years(spark):
    df = spark.createDataFrame([(date(2020, 12, 31), date(2021, 1, 1))], "a date, b date")
    assert df.select(scalars.year_boundaries("b", "a").alias("y")).first().y == 1


def star(spark):
    fact = spark.createDataFrame(
        [
            ("L1", 0, 0, 0, 0, 100, 10, 50, 5, 45, 1.0, date(2000, 1, 1)),
            ("L2", 0, 0, 0, 1, 300, 0, 300, 30, 270, 3.0, date(2001, 1, 1)),
            ("L3", 1, 0, 1, None, 600, 200, 300, 0, 300, 2.0, date(2002, 1, 1)),
            ("L4", 9, 0, 1, 0, 50, 0, 50, 0, 50, 2.0, date(2002, 1, 1)),
        ],
        "loan_number string, country_key long, project_key long, loan_type_key long, "
        "borrower_key long, original_principal_amount long, cancelled_amount long, "
        "disbursed_amount long, repaid_to_ibrd long, due_to_ibrd long, "
        "interest_rate double, board_approval_date date",
    )
    return {
        "fact_loans": fact,
        "dim_country": spark.createDataFrame(
            [(0, "a", "Aland", "North"), (1, "b", "Bland", "South")],
            "country_key long, country_code string, country string, region string",
        ),
        "dim_loan_type": spark.createDataFrame(
            [(0, "X", "Open"), (1, "Y", "Closed")],
            "loan_type_key long, loan_type string, loan_status string",
        ),
        "dim_borrower": spark.createDataFrame(
            [(0, "Ann"), (1, "Bob")], "borrower_key long, borrower string"
        ),
    }


def test_visuals_keep_unmatched_members(spark):
    tables = star(spark)
    regions = {r.region: r.cancelled_amount for r in dashboards.cancellations_by_region(tables).collect()}
    assert regions == {"North": 10, "South": 200, None: 0}
    top = dashboards.top_borrowers(tables).collect()
    assert {(r.borrower, r.country) for r in top} == {
        ("Ann", "Aland"), ("Bob", "Aland"), (None, "Bland"), ("Ann", None)
    }
    shares = {r.region: r.share for r in dashboards.loans_by_region(tables).collect()}
    assert shares["South"] == 600 / 1050 and abs(sum(shares.values()) - 1) < 1e-12
    matrix = {r.region: r for r in dashboards.region_type_matrix(tables).collect()}
    assert matrix["South"]["Y"] == 200 / 600 and matrix["South"]["X"] is None


def test_slicers(spark):
    tables = star(spark)
    count = lambda **s: dashboards.loan_count_card(dashboards.slice_star(tables, **s)).first()[0]
    assert count() == 4
    assert count(region=["North"]) == 2
    assert count(country=["Bland"], loan_type=["Y"]) == 1
    assert count(loan_status=["Open", "Closed"]) == 4
    assert count(date_from=date(2001, 1, 1), date_to=date(2001, 12, 31)) == 1
    assert count(region=[]) == 0


def test_rate_card_alert(spark):
    card = dashboards.cancellation_rate_card(star(spark)).first()
    assert card.cancellation_rate == 0.2 and card.is_alert


def test_declining_borrowers(spark):
    tables = star(spark)
    rows = questions.declining_borrowers(tables).collect()
    assert rows == []  # Aland grew, the others have no year before
