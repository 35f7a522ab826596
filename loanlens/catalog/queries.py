"""Named queries, each a function of a session and a folder of test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens import contract
from loanlens.catalog import tables
from loanlens.functions import formats
from loanlens.functions import measures as m
from loanlens.functions.scalars import (
    cancellation_percent,
    days_or_zero,
    divide,
    flag,
    log_amount,
    ratio,
    risk_level,
    year_boundaries,
)
from loanlens.operators import cleanse, dedup, joins, keys, quality, ranking, star
from loanlens.plans import dashboards, features, kpis, medallion, model, questions
from loanlens.sources import bronze, lake, messy
from loanlens.sources.statements import latest_statements, statements
from loanlens.streaming import alerts, loader

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Plain result types: exact decimals as doubles, doubles rounded, dates as text."""

    def plain(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DoubleType):
            column = F.round(column, 6)
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        return column.alias(field.name)

    return df.select(*[plain(f) for f in df.schema])


def query(function: Query) -> Query:
    """Registers a query under its function name."""
    QUERIES[function.__name__] = lambda spark, sf: comparable(function(spark, sf))
    return function


# ---------------------------------------------------------------- statements

_SUMS = [
    "original_principal_amount",
    "cancelled_amount",
    "disbursed_amount",
    "undisbursed_amount",
    "repaid_to_ibrd",
    "due_to_ibrd",
    "sold_3rd_party",
    "loans_held",
]


def _totals(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("loan_number").alias("loan_count"),
        *[F.sum(c).alias(c) for c in _SUMS],
        F.min("first_repayment_date").alias("first_repayment_date"),
        F.max("last_repayment_date").alias("last_repayment_date"),
        F.max("closed_date_most_recent").alias("closed_date_most_recent"),
    )


@query
def cancellation_rate_by_region(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: latest statements, a country dimension, a ratio of exact sums."""
    silver = tables.silver(spark, sf)
    countries = star.dimension_rows(silver, "dim_country").select("country_code", "region")
    return (
        silver.drop("region")
        .join(countries, "country_code", "left")
        .groupBy("region")
        .agg(
            F.sum("original_principal_amount").alias("principal"),
            F.sum("cancelled_amount").alias("cancelled"),
            kpis.fact_measures(True)["regional_cancellation_rate"].alias(
                "cancellation_rate"
            ),
        )
    )


@query
def statement_totals(spark: SparkSession, sf: str) -> DataFrame:
    return _totals(statements(spark, sf))


@query
def latest_loans(spark: SparkSession, sf: str) -> DataFrame:
    """All columns of the newest statement of every loan."""
    return latest_statements(spark, sf)


@query
def latest_loan_totals(spark: SparkSession, sf: str) -> DataFrame:
    return _totals(tables.silver(spark, sf))


@query
def latest_by_default_order(spark: SparkSession, sf: str) -> DataFrame:
    """Newest statement with ties cut by all remaining columns."""
    return dedup.latest_loans(statements(spark, sf))


@query
def distinct_commitments(spark: SparkSession, sf: str) -> DataFrame:
    """Exact-duplicate removal over a projection that repeats itself."""
    columns = ["country_code", "loan_type", "currency_of_commitment", "loan_status"]
    return dedup.drop_exact_duplicates(statements(spark, sf).select(*columns))


@query
def duplicate_commitments(spark: SparkSession, sf: str) -> DataFrame:
    """How many rows exact-duplicate removal takes away."""
    columns = ["country_code", "loan_type", "project_id", "loan_status"]
    return dedup.exact_duplicate_count(statements(spark, sf).select(*columns))


# ------------------------------------------------------------------ cleansing


@query
def numbers_from_text(spark: SparkSession, sf: str) -> DataFrame:
    """Unreadable and missing numbers per column and the sum of the others."""
    typed = cleanse.cast_numbers(tables.messy_rows(spark, sf))
    columns = contract.NUMERIC
    exact = {c: F.col(c).cast("decimal(18,4)") for c in columns}
    return typed.groupBy("l_linenumber").agg(
        *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"{c}_missing") for c in columns],
        *[F.sum(exact[c]).alias(f"{c}_sum") for c in columns],
    )


@query
def dates_from_text(spark: SparkSession, sf: str) -> DataFrame:
    """Readable dates per pattern and column, with their range."""
    parsed = cleanse.parse_dates(tables.messy_rows(spark, sf))
    return parsed.groupBy("l_linenumber").agg(
        *[F.count(c).alias(f"{c}_read") for c in contract.DATES],
        *[F.min(c).alias(f"{c}_min") for c in contract.DATES],
        *[F.max(c).alias(f"{c}_max") for c in contract.DATES],
    )


@query
def defaults_filled(spark: SparkSession, sf: str) -> DataFrame:
    """What filling puts in place of missing values, by region."""
    filled = cleanse.fill_defaults(
        cleanse.parse_dates(cleanse.cast_numbers(tables.messy_rows(spark, sf)))
    )
    return filled.groupBy("region").agg(
        F.count(F.when(F.col("guarantor") == "Unknown", 1)).alias("unknown_guarantors"),
        F.count(F.when(F.col("interest_rate") == 0, 1)).alias("zero_rates"),
        F.count(F.when(F.col("cancelled_amount") == 0, 1)).alias("zero_cancelled"),
        F.count(F.when(F.col("last_disbursement_date").isNull(), 1)).alias("no_date"),
        F.count(F.lit(1)).alias("row_count"),
    )


@query
def dimension_defaults(spark: SparkSession, sf: str) -> DataFrame:
    """Dimension defaults on rows that skipped Silver."""
    raw = tables.messy_rows(spark, sf).select(
        "country_code", "region", "guarantor", "guarantor_country_code", "country"
    )
    filled = cleanse.fill_dimension(raw, "dim_country")
    return filled.groupBy("region", "guarantor").agg(F.count(F.lit(1)).alias("row_count"))


@query
def declared_defaults(spark: SparkSession, sf: str) -> DataFrame:
    """How often filling puts the declared default of every dimension attribute.

    Each attribute is missing in the rows of every third, fourth, ... part.
    """
    rows = tables.messy_rows(spark, sf)
    parts = []
    for table, defaults in cleanse.DIMENSION_DEFAULTS.items():
        gaps = {
            c: F.when(F.col("l_partkey") % every != 0, F.col(c))
            for every, c in enumerate(defaults, 3)
        }
        filled = cleanse.fill_dimension(rows.withColumns(gaps), table)
        counts = filled.agg(*[F.count_if(F.col(c) == v).alias(c) for c, v in defaults.items()])
        long = counts.unpivot([], list(defaults), "column_name", "row_count")
        parts.append(long.select(F.lit(table).alias("table_name"), "*"))
    return reduce(DataFrame.unionByName, parts)


@query
def warehouse_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Declared date type from text of the plain pattern: range, and what does not fit."""
    rows = tables.messy_rows(spark, sf).where(F.col("l_linenumber") % 4 == 3)
    typed = cleanse.warehouse_types(rows, dict.fromkeys(contract.DATES, "date"))
    return typed.groupBy("loan_type").agg(
        *[F.count(c).alias(f"{c}_read") for c in contract.DATES],
        *[F.max(c).alias(f"{c}_max") for c in contract.DATES],
        F.sum("_cast_failures").alias("cast_failures"),
    )


@query
def trimmed_text(spark: SparkSession, sf: str) -> DataFrame:
    """Trimmed borrower names of padded input."""
    padded = statements(spark, sf).select(
        F.concat(F.lit("  "), "borrower", F.lit(" ")).alias("borrower"),
        F.concat("country", F.lit("   ")).alias("country"),
    )
    trimmed = cleanse.trim_text(padded)
    return trimmed.groupBy("borrower", "country").agg(F.count(F.lit(1)).alias("row_count"))


@query
def warehouse_typing(spark: SparkSession, sf: str) -> DataFrame:
    """Declared types from text: sums of what fits, count of what does not."""
    types = {f.name: f.type for f in contract.WAREHOUSE["fact_loans"]}
    numbers = {c: t for c, t in types.items() if c in contract.NUMERIC}
    typed = cleanse.warehouse_types(tables.raw_rows(spark, sf).select("loan_type", *numbers), numbers)
    return typed.groupBy("loan_type").agg(
        *[F.sum(c).alias(c) for c in numbers],
        F.sum("_cast_failures").alias("cast_failures"),
    )


@query
def bronze_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Well-formed and malformed rows of the raw files, malformed lines whole."""
    raw = bronze.read_bronze(spark, tables.bronze_dir(spark, sf))
    malformed = bronze.is_malformed(raw)
    whole_line = malformed & F.col(contract.CORRUPT).endswith("surplus")
    return raw.agg(
        F.count(F.when(~malformed, 1)).alias("well_formed"),
        F.count(F.when(whole_line, 1)).alias("malformed"),
    )


@query
def silver_from_raw_files(spark: SparkSession, sf: str) -> DataFrame:
    """All Silver columns of the cleansed raw files."""
    return tables.bronze_silver(spark, sf).select(*contract.COLUMNS)


@query
def fact_from_raw_files(spark: SparkSession, sf: str) -> DataFrame:
    """Typed values of the fact built from the cleansed raw files."""

    def build(folder: str) -> None:
        medallion.store_star(spark, tables.bronze_silver(spark, sf), folder)

    gold = tables.stored(spark, sf, "raw-gold", build)
    fact = lake.read_gold(spark, gold, "fact_loans")
    return fact.select("loan_number", *contract.NUMERIC, *contract.DATES)


@query
def silver_of_one_country(spark: SparkSession, sf: str) -> DataFrame:
    """Reads one country's partition of Silver only."""
    silver = tables.bronze_silver(spark, sf).where(F.col("country_code") == "C07")
    return silver.groupBy("country_code", "loan_status").agg(
        F.count(F.lit(1)).alias("loans"),
        F.sum(F.col("disbursed_amount").cast("decimal(18,2)")).alias("disbursed_amount"),
    )


@query
def landed_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Sparse JSON pages landed as one wide table: filled fields per status."""

    def build(folder: str) -> None:
        rows = tables.raw_rows(spark, sf)
        page = F.to_json(F.struct(*contract.COLUMNS))  # leaves missing fields out
        # With every name in every record, text is far larger than its content.
        messy.as_files(rows.select(page)).text(folder)

    landed = bronze.land_pages(spark, tables.stored(spark, sf, "pages", build))
    sparse = ["region", "guarantor", "cancelled_amount", "last_disbursement_date"]
    return landed.groupBy("loan_status").agg(
        F.count(F.lit(1)).alias("records"),
        *[F.count(F.when(F.col(c) == "", 1)).alias(f"{c}_empty") for c in sparse],
    )


@query
def raw_step_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per step of the raw-to-Silver run, counted while it writes."""
    counts = tables.raw_step_counts(spark, sf)
    good, _ = bronze.split_quarantine(
        bronze.read_bronze(spark, tables.bronze_dir(spark, sf))
    )
    copies = dedup.exact_duplicates_of_wide_rows(cleanse.typed_rows(good))
    seen = {name: F.lit(value) for name, value in counts._asdict().items()}
    return copies.withColumns(seen)


@query
def standard_names(spark: SparkSession, sf: str) -> DataFrame:
    """Names of the raw columns after standardisation, with their filled values."""
    good, _ = bronze.split_quarantine(
        bronze.read_bronze(spark, tables.bronze_dir(spark, sf))
    )
    named = cleanse.standardize_names(good)
    counts = named.agg(*[F.count(c).alias(c) for c in named.columns])
    return counts.unpivot([], named.columns, "column_name", "filled")


@query
def landing_check(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = bronze.split_quarantine(
        bronze.read_bronze(spark, tables.bronze_dir(spark, sf))
    )
    return quality.validate_landing(good)


@query
def copied_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Quoted copy of the raw files without the rows that do not fit."""
    copied = bronze.read_bronze(spark, tables.copies_dir(spark, sf) + "/batch=20020101*")
    return copied.groupBy("`Loan Status`").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count(contract.CORRUPT).alias("malformed"),
        F.count("`Region`").alias("regions"),
    ).withColumnRenamed("Loan Status", "loan_status")


@query
def copy_audit(spark: SparkSession, sf: str) -> DataFrame:
    """What the audit table holds of a copy and of a copy of that."""
    audits = bronze.copy_audits(spark, tables.copies_dir(spark, sf))
    return audits.select(
        "status", "rows_read", "rows_copied", (F.col("bytes_written") > 0).alias("has_bytes")
    )


@query
def rows_across_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Step counts of raw files with line breaks in values, and such values in Silver."""
    folder, counts = tables.multi_line_dir(spark, sf)
    broken = F.count(F.when(F.col("borrower").contains("\n"), 1))
    seen = {name: F.lit(value) for name, value in counts._asdict().items()}
    return lake.read_silver(spark, folder).agg(broken.alias("two_line_borrowers")).withColumns(seen)


@query
def silver_after_delivery(spark: SparkSession, sf: str) -> DataFrame:
    """Silver after a delivery was merged into it: the same as built at once."""
    return tables.delivered_silver(spark, sf).select(*contract.COLUMNS)


# ------------------------------------------------------------------- quality


@query
def null_percentages(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.messy_rows(spark, sf).select(*contract.COLUMNS)
    return quality.null_percentages(rows)


@query
def quality_profile(spark: SparkSession, sf: str) -> DataFrame:
    return quality.profile(tables.silver(spark, sf))


@query
def cast_failures(spark: SparkSession, sf: str) -> DataFrame:
    return quality.cast_failures(tables.messy_rows(spark, sf))


@query
def length_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Names over a limit chosen so that some are."""
    limits = {"project_name": 8, "borrower": 18, "loan_type": 50, "country": 8}
    return quality.length_violations(tables.silver(spark, sf), limits)


@query
def declared_lengths(spark: SparkSession, sf: str) -> DataFrame:
    """Every text column of the star against its declared length."""
    parts = [
        quality.length_violations(df, table=table).select(F.lit(table).alias("table_name"), "*")
        for table, df in tables.star(spark, sf).items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def repeated_loan_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Loans with more than one statement."""
    return quality.duplicate_keys(statements(spark, sf), ["loan_number"])


@query
def key_uniqueness(spark: SparkSession, sf: str) -> DataFrame:
    return quality.uniqueness(tables.star(spark, sf))


@query
def required_violations(spark: SparkSession, sf: str) -> DataFrame:
    return quality.required_violations(tables.star(spark, sf))


@query
def foreign_key_check(spark: SparkSession, sf: str) -> DataFrame:
    gold = tables.star(spark, sf)
    return joins.orphan_counts(gold["fact_loans"], gold)


@query
def orphan_loans(spark: SparkSession, sf: str) -> DataFrame:
    """Loans whose country was taken out of the dimension."""
    gold = tables.star(spark, sf)
    kept = gold["dim_country"].where(F.col("region") != "ASIA")
    lost = joins.orphans(gold["fact_loans"], kept, "country_key")
    return lost.select("loan_number", "original_principal_amount")


# --------------------------------------------------------------- star schema


def _register_dimension(table: str) -> None:
    def build(spark: SparkSession, sf: str) -> DataFrame:
        return star.build_dimension(tables.silver(spark, sf), table)

    build.__name__ = table
    query(build)


for _table in star.DIMENSIONS:
    _register_dimension(_table)


@query
def fact_loans(spark: SparkSession, sf: str) -> DataFrame:
    """The fact with its five keys, built against stored dimensions."""
    return star.build_fact(tables.silver(spark, sf), tables.star(spark, sf))


@query
def fact_keys_without_broadcast(spark: SparkSession, sf: str) -> DataFrame:
    """The same keys when every dimension counts as too large to broadcast."""
    fact = star.build_fact(tables.silver(spark, sf), tables.star(spark, sf), 0)
    return fact.select(
        "loan_fact_key", "country_key", "project_key", "loan_type_key", "borrower_key"
    )


@query
def statement_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Dense keys over all loans, in one sorted pass."""
    loans = statements(spark, sf).select("loan_number").distinct()
    return keys.dense_key(loans, ["loan_number"], "loan_key")


@query
def star_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Fact measures through all four dimensions."""
    gold = tables.star(spark, sf)
    attributes = {
        "dim_country": ["region"],
        "dim_project": ["project_id"],
        "dim_loan_type": ["loan_status"],
        "dim_borrower": ["borrower"],
    }
    joined = joins.star_join(gold["fact_loans"], gold, attributes)
    return joined.groupBy("region", "loan_status").agg(
        F.count_distinct("project_id").alias("projects"),
        F.count_distinct("borrower").alias("borrowers"),
        F.sum("original_principal_amount").alias("principal"),
    )


@query
def clustered_fact(spark: SparkSession, sf: str) -> DataFrame:
    """Filters the fact in its clustered layout."""

    def build(folder: str) -> None:
        fact = tables.star(spark, sf)["fact_loans"]
        lake.cluster(fact, "fact_loans").write.parquet(folder)

    fact = spark.read.schema(contract.table_schema("fact_loans")).parquet(
        tables.stored(spark, sf, "clustered", build)
    )
    chosen = fact.where(
        F.col("country_key").between(3, 7)
        & (F.col("board_approval_date") >= F.lit(date(1998, 1, 1)))
    )
    return chosen.groupBy("country_key").agg(
        F.count(F.lit(1)).alias("loans"), F.sum("loans_held").alias("loans_held")
    )


# ------------------------------------------------------------------- scalars


@query
def loan_ratios(spark: SparkSession, sf: str) -> DataFrame:
    """Scalar functions per loan; every seventh loan without a principal."""
    loans = tables.silver(spark, sf)
    number = F.substring("loan_number", 2, 20).cast("bigint")
    principal = "original_principal_amount"
    zeroed = loans.withColumn(
        principal, F.when(number % 7 == 0, F.lit(0)).otherwise(F.col(principal))
    )
    return zeroed.select(
        "loan_number",
        ratio("cancelled_amount", principal).alias("cancelled_share"),
        ratio("disbursed_amount", principal).alias("disbursed_share"),
        ratio("repaid_to_ibrd", principal).alias("repaid_share"),
        divide(F.col("cancelled_amount"), F.col(principal)).alias("divided"),
        cancellation_percent().alias("cancelled_percent"),
        risk_level().alias("risk_level"),
        days_or_zero("agreement_signing_date", "board_approval_date").alias("days"),
        log_amount(principal).alias("log_principal"),
        flag(F.col("sold_3rd_party") > 0).alias("third_party"),
        flag(ratio("cancelled_amount", principal) > 0.10).alias("significant"),
        year_boundaries("last_repayment_date", "first_repayment_date").alias("years"),
    )


@query
def loan_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Every text mask on per-loan numbers."""
    loans = tables.silver(spark, sf)
    share = ratio("cancelled_amount", "original_principal_amount")
    amount = F.col("due_to_ibrd").cast("double")
    return loans.select(
        "loan_number",
        formats.billions(amount / 1_000_000).alias("billions"),
        formats.millions(amount / 1_000).alias("millions"),
        formats.dollars(amount).alias("dollars"),
        formats.percent(share).alias("percent_2"),
        formats.percent(share, 1).alias("percent_1"),
        formats.signed_percent(share - 0.1).alias("signed"),
        formats.rate_percent(F.col("interest_rate").cast("double")).alias("rate"),
    )


# ------------------------------------------------------------------ measures


@query
def portfolio_measures(spark: SparkSession, sf: str) -> DataFrame:
    """All fact measures over the whole portfolio."""
    fact = tables.star(spark, sf)["fact_loans"]
    return kpis.measure_table(fact, list(kpis.fact_measures()), (), True)


@query
def statement_measures(spark: SparkSession, sf: str) -> DataFrame:
    """All measures over every statement, where loans repeat and counts are distinct."""
    rows = statements(spark, sf)
    return kpis.measure_table(rows, list(kpis.fact_measures()), ["loan_status"])


@query
def estimated_loan_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Loans per region, estimated from sketches stored per country and loan status."""

    def build(folder: str) -> None:
        rows = statements(spark, sf)
        kpis.loan_sketches(rows, ["region", "country", "loan_status"]).write.parquet(folder)

    sketches = spark.read.parquet(tables.stored(spark, sf, "sketches", build))
    estimated = kpis.estimated_loans(sketches, ["region"])
    exact = statements(spark, sf).groupBy("region").agg(m.loan_count().alias("loan_count"))
    off = F.abs(F.col("loans") - F.col("loan_count"))
    close = off <= F.col("loan_count") * F.lit(kpis.sketch_error())
    return exact.join(estimated, "region").select("region", "loan_count", close.alias("is_close"))


@query
def region_measures(spark: SparkSession, sf: str) -> DataFrame:
    gold = tables.star(spark, sf)
    rows = joins.star_join(gold["fact_loans"], gold, {"dim_country": ["region"]})
    return kpis.measure_table(rows, list(kpis.fact_measures()), ["region"], True)


@query
def measure_texts(spark: SparkSession, sf: str) -> DataFrame:
    gold = tables.star(spark, sf)
    rows = joins.star_join(gold["fact_loans"], gold, {"dim_country": ["region"]})
    return kpis.measure_texts(rows, ["region"])


@query
def dimension_counts(spark: SparkSession, sf: str) -> DataFrame:
    return kpis.dimension_counts(tables.star(spark, sf))


@query
def yoy_cancellation(spark: SparkSession, sf: str) -> DataFrame:
    yearly = kpis.yoy_cancellation(tables.star(spark, sf)["fact_loans"])
    text = formats.signed_percent(F.col("yoy_cancellation_change"))
    return yearly.withColumn("yoy_text", text)


@query
def yoy_cancellation_with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Per region, years of which every third is left out."""
    gold = tables.star(spark, sf)
    rows = joins.star_join(gold["fact_loans"], gold, {"dim_country": ["region"]})
    gaps = rows.where(F.year("board_approval_date") % 3 != 0)
    return kpis.yoy_cancellation(gaps, ["region"])


@query
def top_three_countries(spark: SparkSession, sf: str) -> DataFrame:
    return kpis.top_countries(tables.star(spark, sf))


@query
def cancellation_ranks(spark: SparkSession, sf: str) -> DataFrame:
    return kpis.cancellation_ranks(tables.star(spark, sf))


@query
def project_ranks_with_ties(spark: SparkSession, sf: str) -> DataFrame:
    """Projects ranked five or better by number of loans, ties kept."""
    counts = tables.silver(spark, sf).groupBy("project_id").agg(
        F.count("loan_number").alias("loans")
    )
    return ranking.top_n_with_ties(counts, 5, "loans")


@query
def duration_correlations(spark: SparkSession, sf: str) -> DataFrame:
    return questions.duration_correlations(tables.star(spark, sf))


@query
def declining_borrowers(spark: SparkSession, sf: str) -> DataFrame:
    return questions.declining_borrowers(tables.star(spark, sf))


@query
def cancellation_rate_by_borrower(spark: SparkSession, sf: str) -> DataFrame:
    return questions.cancellation_rate_by_borrower(tables.star(spark, sf))


@query
def repayment_years_by_country(spark: SparkSession, sf: str) -> DataFrame:
    return questions.repayment_years_by_country(tables.star(spark, sf))


# ---------------------------------------------------------------- dashboards


def _register_visual(name: str, visual: Callable[[dashboards.Star], DataFrame]) -> None:
    def build(spark: SparkSession, sf: str) -> DataFrame:
        return visual(tables.star(spark, sf))

    build.__name__ = f"visual_{name}"
    query(build)


for _name, _visual in dashboards.VISUALS.items():
    _register_visual(_name, _visual)


@query
def visual_region_type_rates(spark: SparkSession, sf: str) -> DataFrame:
    return dashboards.region_type_rates(tables.star(spark, sf))


@query
def sliced_measures(spark: SparkSession, sf: str) -> DataFrame:
    """All five slicers at once, then measures by country."""
    sliced = dashboards.slice_star(
        tables.star(spark, sf),
        region=["ASIA", "EUROPE"],
        country=["NATION_2", "NATION_3", "NATION_7", "NATION_8", "NATION_13"],
        loan_status=["O", "F"],
        loan_type=["1-URGENT"],
        date_from=date(1996, 1, 1),
        date_to=date(1999, 12, 31),
    )
    return dashboards.loan_map(sliced)


# ------------------------------------------------------------------- streams


@query
def high_risk_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """Alerts over all statements as a batch."""
    return alerts.high_risk(statements(spark, sf))


@query
def risk_level_counts(spark: SparkSession, sf: str) -> DataFrame:
    graded = alerts.high_risk(tables.silver(spark, sf))
    return graded.groupBy("risk_level").agg(
        F.count(F.lit(1)).alias("loans"),
        F.sum("cancelled_amount").alias("cancelled_amount"),
    )


@query
def streamed_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """Alerts of the raw files by the file stream, without the ingestion columns."""
    return tables.streamed_alerts(spark, sf).drop("ingestion_timestamp", "source_file")


@query
def alert_ingestion(spark: SparkSession, sf: str) -> DataFrame:
    """Raw rows the stream reports or sets apart that carry their ingestion time and file.

    Rows without a loan number are graded like the others; lines that do not fit the
    header can't be, and are counted as such.
    """
    carried = ["risk_level", "ingestion_timestamp", "source_file"]
    aside = alerts.recorded_quarantine(spark, tables.alerts_dir(spark, sf))
    keyless = aside.where(F.col("reason") == bronze.WITHOUT_KEY).drop("reason", contract.CORRUPT)
    graded = alerts.high_risk(cleanse.typed_rows(keyless, carried[1:]))
    unreadable = aside.where(F.col("reason") == bronze.CORRUPT_LINE)
    rows = (
        tables.streamed_alerts(spark, sf)
        .select(*carried)
        .unionByName(graded.select(*carried))
        .unionByName(unreadable.withColumn("risk_level", F.lit("UNREADABLE")).select(*carried))
    )
    return rows.groupBy("risk_level").agg(
        F.count(F.lit(1)).alias("alerts"),
        F.count("ingestion_timestamp").alias("with_time"),
        F.count(F.when(F.col("source_file").rlike(r"\.csv(\.gz)?$"), 1)).alias("with_file"),
    )


@query
def streamed_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Raw rows the stream set apart, by reason, with how many lines are kept whole."""
    aside = alerts.recorded_quarantine(spark, tables.alerts_dir(spark, sf))
    return aside.groupBy("reason").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count(F.when(F.col(contract.CORRUPT).endswith(",surplus"), 1)).alias("whole_lines"),
        F.count("ingestion_timestamp").alias("with_time"),
        F.count("source_file").alias("with_file"),
    )


@query
def restarted_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """Alerts of a stream that was stopped after its first batch and resumed."""
    recorded = alerts.recorded_alerts(spark, tables.restarted_alerts_dir(spark, sf))
    return recorded.drop("ingestion_timestamp", "source_file")


@query
def loaded_fact(spark: SparkSession, sf: str) -> DataFrame:
    """The warehouse fact after two deliveries of the same loans: each loan once."""
    rows = loader.current_rows(spark, tables.warehouse_dir(spark, sf), "fact_loans")
    return rows.drop("_loaded_at", "_source_file")


@query
def loaded_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Row counts of all warehouse tables, and of their audit columns."""
    folder = tables.warehouse_dir(spark, sf)
    result = None
    for table in contract.WAREHOUSE:
        counts = loader.current_rows(spark, folder, table).agg(
            F.lit(table).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.count("_loaded_at").alias("with_time"),
            F.count("_source_file").alias("with_file"),
        )
        result = counts if result is None else result.unionByName(counts)
    return result


@query
def loaded_after_rebuild(spark: SparkSession, sf: str) -> DataFrame:
    """The warehouse fact after a delivery that changed, removed and added loans."""
    folder = tables.rebuilt_warehouse_dir(spark, sf)
    rows = loader.current_rows(spark, folder, "fact_loans")
    return rows.select("loan_number", "cancelled_amount")


@query
def compacted_cleared_source(spark: SparkSession, sf: str) -> DataFrame:
    """The fact of a source cleared after each load, after as many compactions."""
    folder = tables.cleared_warehouse_dir(spark, sf)
    rows = loader.current_rows(spark, folder, "fact_loans", keep_vanished=True)
    return rows.select("loan_number", "cancelled_amount")


@query
def loaded_with_bad_file(spark: SparkSession, sf: str) -> DataFrame:
    """Files of a delivery by status: one with a lost value contributes nothing."""
    folder = tables.bad_file_warehouse_dir(spark, sf)
    rows = loader.current_rows(spark, folder, "dim_project")
    loaded = rows.agg(F.lit("visible").alias("status"), F.count(F.lit(1)).alias("rows"))
    history = loader.load_history(spark, folder, "dim_project")
    return loaded.unionByName(history.groupBy("status").agg(F.sum("rows").alias("rows")))


@query
def load_history(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and lost values per batch of the fact, each delivered twice."""
    history = loader.load_history(spark, tables.warehouse_dir(spark, sf), "fact_loans")
    return history.groupBy("batch_id", "status").agg(
        F.sum("rows").alias("rows"), F.sum("lost_values").alias("lost_values")
    )


@query
def recent_loads(spark: SparkSession, sf: str) -> DataFrame:
    """History report of the last day, newest first; file names differ per run."""
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    return loader.recent_loads(spark, tables.warehouse_dir(spark, sf), "fact_loans", now)


@query
def recent_load_report(spark: SparkSession, sf: str) -> DataFrame:
    """History report of a delivery of two files, one of them skipped, without times."""
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    folder = tables.bad_file_warehouse_dir(spark, sf)
    recent = loader.recent_loads(spark, folder, "dim_project", now)
    return recent.select("batch_id", "status", "rows", "lost_values")


# --------------------------------------------------------------------- model


@query
def model_features(spark: SparkSession, sf: str) -> DataFrame:
    return tables.feature_rows(spark, sf)


@query
def class_balance(spark: SparkSession, sf: str) -> DataFrame:
    return features.class_balance(tables.feature_rows(spark, sf))


@query
def model_split(spark: SparkSession, sf: str) -> DataFrame:
    """Loans and positives in the training and the test part."""
    train, test = model.split(tables.feature_rows(spark, sf))
    parts = [
        features.class_balance(part).select(F.lit(name).alias("part"), "*")
        for name, part in (("train", train), ("test", test))
    ]
    return parts[0].unionByName(parts[1])


@query
def model_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Batch scoring of the held-out loans with the stored model."""
    scored = tables.test_predictions(spark, sf)
    return scored.select("loan_number", features.LABEL, "prediction")


@query
def scored_loans(spark: SparkSession, sf: str) -> DataFrame:
    """The held-out loans, their label, and whether scoring gave them a class."""
    scored = tables.test_predictions(spark, sf)
    given = F.col("prediction").isin(0.0, 1.0)
    return scored.select("loan_number", features.LABEL, given.alias("is_scored"))


@query
def confusion_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Loans per label in the confusion matrix."""
    matrix = model.confusion_matrix(tables.test_predictions(spark, sf))
    return matrix.groupBy(features.LABEL).agg(F.sum("loans").alias("loans"))


@query
def model_stages(spark: SparkSession, sf: str) -> DataFrame:
    """What the preparation stages learned: category codes by frequency."""
    return model.category_codes(tables.fitted(spark, sf), spark)


@query
def model_preparation(spark: SparkSession, sf: str) -> DataFrame:
    """What imputing and scaling learned per slot, medians by whether they are in bound."""
    rows = tables.feature_rows(spark, sf)
    learned = model.learned_parameters(tables.fitted(spark, sf), rows)
    train, _ = model.split(rows)
    bounds = model.median_bounds(learned, train)
    return learned.join(bounds, "name", "left").select("slot", "name", "deviation", "in_bound")


@query
def model_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return model.metrics(tables.test_predictions(spark, sf))


@query
def model_confusion(spark: SparkSession, sf: str) -> DataFrame:
    return model.confusion_matrix(tables.test_predictions(spark, sf))


@query
def model_importances(spark: SparkSession, sf: str) -> DataFrame:
    return model.feature_importances(
        tables.fitted(spark, sf), tables.feature_rows(spark, sf)
    )


@query
def model_tuning(spark: SparkSession, sf: str) -> DataFrame:
    """Cross-validated scores on all training loans, for the whole grid."""
    train, _ = model.split(tables.feature_rows(spark, sf))
    return model.grid_scores(spark, model.cross_validate(train))
