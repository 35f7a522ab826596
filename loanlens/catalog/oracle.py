"""SQL for DuckDB that states, from the given tables alone, what each query returns.

The SQL is written independently of the library: no stored tables, keys by
``row_number``, dimensions looked up on natural keys.  Decimals are returned as
doubles and dates as text, like the queries' results.
"""

from __future__ import annotations

from collections.abc import Iterable

from loanlens import contract

MONEY = contract.MONEY
RATES = contract.RATES
DATES = contract.DATES

STATEMENTS = """
SELECT x.*, due_to_ibrd - sold_3rd_party AS loans_held, sold_3rd_party AS due_3rd_party
FROM (
 SELECT x.*, due_to_ibrd AS borrowers_obligation,
  cast(due_to_ibrd * cast(CASE WHEN l_suppkey % 10 = 0 THEN 0.1 ELSE 0 END
       AS decimal(2,1)) AS decimal(18,2)) AS sold_3rd_party,
  cast(first_repayment_date + to_months(cast(12 * l_linenumber AS integer)) AS date)
   AS last_repayment_date,
  cast(last_disbursement_date + 90 AS date) AS closed_date_most_recent
 FROM (
  SELECT x.*, cast(disbursed_amount - repaid_to_ibrd AS decimal(18,2)) AS due_to_ibrd,
   cast(effective_date_most_recent + interval 60 month AS date) AS first_repayment_date,
   greatest(effective_date_most_recent, end_of_period) AS last_disbursement_date
  FROM (
   SELECT x.*,
    cast(original_principal_amount - cancelled_amount - disbursed_amount
         AS decimal(18,2)) AS undisbursed_amount,
    cast(disbursed_amount * cast(l_tax * 10 AS decimal(3,1)) AS decimal(18,2))
     AS repaid_to_ibrd,
    cast(agreement_signing_date + 30 AS date) AS effective_date_most_recent
   FROM (
    SELECT x.*,
     cast((original_principal_amount - cancelled_amount)
          * cast(CASE WHEN l_linestatus = 'O' THEN l_quantity * 0.02 ELSE 1 END
                 AS decimal(3,2)) AS decimal(18,2)) AS disbursed_amount,
     cast(board_approval_date + p_size AS date) AS agreement_signing_date
    FROM (
     SELECT l.*, p_size,
      concat('L', cast(l_orderkey AS varchar)) AS loan_number,
      cast(l_shipdate AS date) AS end_of_period,
      r_name AS region, n.n_name AS country, c_name AS borrower,
      concat('C', lpad(cast(n.n_nationkey AS varchar), 2, '0')) AS country_code,
      concat('C', lpad(cast(g.n_nationkey AS varchar), 2, '0'))
       AS guarantor_country_code,
      g.n_name AS guarantor,
      o_orderpriority AS loan_type, o_orderstatus AS loan_status,
      c_mktsegment AS currency_of_commitment,
      concat('P', lpad(cast(p_partkey AS varchar), 6, '0')) AS project_id,
      p_name AS project_name,
      cast(l_tax * 100 AS decimal(8,4)) AS interest_rate,
      cast(l_discount * 10 AS decimal(8,4)) AS service_charge_rate,
      cast(o_totalprice * 100 AS decimal(18,2)) AS original_principal_amount,
      cast(CASE WHEN l_returnflag = 'R' THEN o_totalprice * 100 * l_discount * 4
                ELSE 0 END AS decimal(18,2)) AS cancelled_amount,
      cast(0 AS decimal(18,2)) AS repaid_3rd_party,
      cast(o_orderdate AS date) AS board_approval_date
     FROM lineitem l
     JOIN orders ON l_orderkey = o_orderkey
     JOIN customer ON o_custkey = c_custkey
     JOIN nation n ON c_nationkey = n.n_nationkey
     JOIN region ON n.n_regionkey = r_regionkey
     JOIN part ON l_partkey = p_partkey
     JOIN supplier ON l_suppkey = s_suppkey
     JOIN nation g ON s_nationkey = g.n_nationkey
    ) x
   ) x
  ) x
 ) x
) x
"""

LATEST = """
SELECT * FROM statements
QUALIFY row_number() OVER (PARTITION BY loan_number
 ORDER BY end_of_period DESC, project_id, l_linenumber, interest_rate,
          service_charge_rate, cancelled_amount, guarantor, l_suppkey, l_quantity,
          l_linestatus) = 1
"""


def _default_order() -> str:
    rest = [c for c in contract.COLUMNS if c not in ("loan_number", "end_of_period")]
    return ", ".join(f"{c} DESC NULLS LAST" for c in ["end_of_period", *rest])


def _date_text(column: str) -> str:
    return (
        f"CASE l_linenumber % 4 WHEN 0 THEN strftime({column}, '%Y-%m-%dT00:00:00.000') "
        f"WHEN 1 THEN strftime({column}, '%Y-%m-%dT00:00:00') "
        f"WHEN 2 THEN strftime({column}, '%m/%d/%Y') "
        f"ELSE strftime({column}, '%Y-%m-%d') END"
    )


def _messy() -> str:
    text = {c: f"cast({c} AS varchar)" for c in contract.NUMERIC}
    text |= {c: _date_text(c) for c in DATES}
    defects = {
        "interest_rate": "CASE WHEN l_suppkey % 17 = 0 THEN 'n/a' ELSE {} END",
        "original_principal_amount": (
            "CASE WHEN l_partkey % 29 = 0 THEN '1,000' ELSE {} END"
        ),
        "cancelled_amount": "CASE WHEN cancelled_amount > 0 THEN {} END",
        "undisbursed_amount": "CASE WHEN l_partkey % 41 = 0 THEN 'NaN' ELSE {} END",
        "disbursed_amount": "CASE WHEN l_partkey % 43 = 0 THEN 'Infinity' ELSE {} END",
        "repaid_to_ibrd": "CASE WHEN l_partkey % 47 = 0 THEN '1e20' ELSE {} END",
        "sold_3rd_party": "CASE WHEN l_partkey % 53 = 0 THEN '12d' ELSE {} END",
        "service_charge_rate": "CASE WHEN l_partkey % 37 = 0 THEN '123456.5' ELSE {} END",
        "closed_date_most_recent": (
            "CASE WHEN l_partkey % 13 = 0 THEN 'not a date' ELSE {} END"
        ),
        "first_repayment_date": (
            "CASE WHEN l_partkey % 19 = 0 THEN '1/5/2024' ELSE {} END"
        ),
        "last_disbursement_date": "CASE WHEN l_suppkey % 11 <> 0 THEN {} END",
        "loan_number": "CASE WHEN l_partkey % 59 <> 0 THEN {} END",
        "region": "CASE WHEN l_partkey % 31 <> 0 THEN {} END",
        "guarantor": "CASE WHEN l_suppkey % 23 <> 0 THEN {} END",
    }
    columns = [
        f"{defects.get(c, '{}').format(text.get(c, c))} AS {c}" for c in contract.COLUMNS
    ]
    return (
        f"SELECT {', '.join(columns)}, l_partkey, l_suppkey, l_linenumber FROM statements"
    )


def _read_date(column: str) -> str:
    """Strict two-digit parts, as the patterns demand."""
    return (
        f"CASE WHEN regexp_full_match({column}, '\\d{{4}}-\\d\\d-\\d\\d.*') "
        f"THEN try_cast(substr({column}, 1, 10) AS date) "
        f"WHEN regexp_full_match({column}, '\\d\\d/\\d\\d/\\d{{4}}') "
        f"THEN cast(try_strptime({column}, '%m/%d/%Y') AS date) END"
    )


def _read_number(column: str) -> str:
    """A plain decimal that the column's declared type can hold."""
    kind = "decimal(8,4)" if column in RATES else "decimal(18,2)"
    return (
        f"CASE WHEN regexp_full_match({column}, '[+-]?[0-9]+(\\.[0-9]+)?([eE][0-9]+)?') "
        f"AND try_cast(try_cast({column} AS double) AS {kind}) IS NOT NULL "
        f"THEN try_cast({column} AS double) END"
    )


def _typed() -> str:
    columns = []
    for c in contract.COLUMNS:
        if c in contract.NUMERIC:
            columns.append(f"{_read_number(c)} AS {c}")
        elif c in DATES:
            columns.append(f"{_read_date(c)} AS {c}")
        else:
            columns.append(c)
    return f"SELECT {', '.join(columns)}, l_partkey, l_suppkey, l_linenumber FROM messy"


def _filled() -> str:
    columns = []
    for c in contract.COLUMNS:
        if c in contract.NUMERIC:
            columns.append(f"coalesce({c}, 0) AS {c}")
        elif c in contract.CATEGORICAL:
            columns.append(f"coalesce({c}, 'Unknown') AS {c}")
        else:
            columns.append(c)
    return f"SELECT {', '.join(columns)}, l_partkey FROM typed"


def _dimension(table: str) -> str:
    key, natural = contract.KEYS[table]
    names = contract.names(table)
    attributes = [c for c in names[1:] if c not in natural]
    order = ", ".join(f"{c} DESC" for c in ["end_of_period", *attributes])
    return f"""
    SELECT row_number() OVER (ORDER BY {', '.join(natural)}) - 1 AS {key},
           {', '.join(names[1:])}
    FROM (SELECT * FROM latest
          QUALIFY row_number() OVER (PARTITION BY {', '.join(natural)}
                                     ORDER BY {order}) = 1)
    """


def _fact() -> str:
    loan = [f"s.{c}" for c in contract.names("fact_loans")[5:]]
    return f"""
    SELECT row_number() OVER (ORDER BY loan_number) - 1 AS loan_fact_key,
           country_key, project_key, loan_type_key, borrower_key, {', '.join(loan)}
    FROM latest s
    LEFT JOIN dim_country c ON s.country_code = c.country_code
    LEFT JOIN dim_project p ON s.project_id = p.project_id
    LEFT JOIN dim_loan_type t ON s.loan_type = t.loan_type
     AND s.loan_status = t.loan_status
     AND s.currency_of_commitment = t.currency_of_commitment
    LEFT JOIN dim_borrower b ON s.borrower = b.borrower
    """


_DIMENSIONS = ["dim_country", "dim_project", "dim_loan_type", "dim_borrower"]

CTES = {
    "statements": (STATEMENTS, []),
    "latest": (LATEST, ["statements"]),
    "messy": (_messy(), ["statements"]),
    "typed": (_typed(), ["messy"]),
    "filled": (_filled(), ["typed"]),
    **{t: (_dimension(t), ["latest"]) for t in _DIMENSIONS},
    "fact": (_fact(), ["latest", *_DIMENSIONS]),
}


def sql(tables: Iterable[str], body: str) -> str:
    """``body`` preceded by the named tables and whatever they need."""
    needed: list[str] = []

    def add(name: str) -> None:
        if name not in needed:
            for other in CTES[name][1]:
                add(other)
            needed.append(name)

    for table in tables:
        add(table)
    parts = ", ".join(f"{name} AS ({CTES[name][0]})" for name in needed)
    return f"WITH {parts} {body}"


def _plain(column: str) -> str:
    if column in contract.NUMERIC:
        return f"cast({column} AS double) AS {column}"
    return f"cast({column} AS varchar) AS {column}" if column in DATES else column


def _plain_list(columns: Iterable[str]) -> str:
    return ", ".join(_plain(c) for c in columns)


def _sum(column: str, alias: str | None = None) -> str:
    return f"cast(sum({column}) AS double) AS {alias or column}"


_P, _C = "sum(original_principal_amount)", "sum(cancelled_amount)"


def _positive_ratio(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN cast({part} AS double) / cast({whole} AS double) END"


_YEARS = "year(last_repayment_date) - year(first_repayment_date)"
_DAYS = "agreement_signing_date - board_approval_date"

MEASURES = {
    "total_loan_amount": f"cast({_P} AS double) / 1e9",
    "total_cancelled_amount": f"cast({_C} AS double) / 1e9",
    "cancellation_rate": _positive_ratio(_C, _P),
    "total_disbursed_amount": "cast(sum(disbursed_amount) AS double) / 1e9",
    "total_repaid": "cast(sum(repaid_to_ibrd) AS double) / 1e9",
    "total_due": "cast(sum(due_to_ibrd) AS double) / 1e6",
    "loan_count": "count(DISTINCT loan_number)",
    "avg_cancellation_per_loan": f"cast({_C} AS double) / count(cancelled_amount)",
    "high_risk_count": (
        "count(DISTINCT loan_number) FILTER (WHERE cancelled_amount > 1000000)"
    ),
    "regional_cancellation_rate": f"coalesce({_positive_ratio(_C, _P)}, 0)",
    "avg_processing_days": f"avg({_DAYS})",
    "avg_disbursement_period": (
        "avg(last_disbursement_date - effective_date_most_recent)"
    ),
    "avg_repayment_years": f"avg({_YEARS})",
    "disbursement_efficiency": _positive_ratio("sum(disbursed_amount)", _P),
    "avg_interest_rate": "cast(sum(interest_rate) AS double) / count(interest_rate)",
    "weighted_avg_interest_rate": _positive_ratio(
        "sum(interest_rate * original_principal_amount)", _P
    ),
}
_COUNTS = {"loan_count", "high_risk_count"}


def measure(name: str) -> str:
    value = MEASURES[name]
    return f"{value if name in _COUNTS else f'round({value}, 6)'} AS {name}"


def measures(*names: str) -> str:
    return ", ".join(measure(n) for n in (names or MEASURES))


_TOTALS = f"""
SELECT count(*) AS row_count, count(DISTINCT loan_number) AS loan_count,
 {', '.join(_sum(c) for c in [
    'original_principal_amount', 'cancelled_amount', 'disbursed_amount',
    'undisbursed_amount', 'repaid_to_ibrd', 'due_to_ibrd', 'sold_3rd_party',
    'loans_held'])},
 cast(min(first_repayment_date) AS varchar) AS first_repayment_date,
 cast(max(last_repayment_date) AS varchar) AS last_repayment_date,
 cast(max(closed_date_most_recent) AS varchar) AS closed_date_most_recent
"""

_YOY = """
SELECT {group} a.year, cast(a.v AS double) AS {name},
 cast(b.v AS double) AS previous_{name},
 CASE WHEN b.v > 0 THEN round(cast(a.v - b.v AS double) / cast(b.v AS double), 6) END
  AS {change}{more}
FROM yearly a LEFT JOIN yearly b ON a.year = b.year + 1 {match}
"""


def _yearly(value: str, group: str = "", where: str = "") -> str:
    by = f"{group}, " if group else ""
    return (
        f", yearly AS (SELECT {by}year(board_approval_date) AS year, sum({value}) AS v "
        f"FROM latest {where} GROUP BY ALL)"
    )


def _ratio(part: str, whole: str) -> str:
    return (
        f"CASE WHEN {whole} > 0 THEN cast({part} AS double) / cast({whole} AS double) "
        f"ELSE 0 END"
    )


def _rounded(value: str, places: int) -> str:
    return f"round(cast({value} AS decimal(30,10)), {places})"


def _percent_text(share: str, places: int) -> str:
    rounded = _rounded(f"({share}) * 100", places)
    return f"printf('%.{places}f%%', cast({rounded} AS double))"


def _signed_text(share: str) -> str:
    plus = f"CASE WHEN {_rounded(f'({share}) * 100', 1)} > 0 THEN '+' ELSE '' END"
    return f"{plus} || {_percent_text(share, 1)}"


def _money_text(value: str, places: int, unit: str) -> str:
    rounded = f"cast({_rounded(value, places)} AS double)"
    return f"concat('$', format('{{:,.{places}f}}', {rounded}), '{unit}')"


_MEASURE_TEXTS = {
    "total_loan_amount": lambda v: _money_text(v, 2, "B"),
    "total_cancelled_amount": lambda v: _money_text(v, 2, "B"),
    "cancellation_rate": lambda v: _percent_text(v, 2),
    "total_disbursed_amount": lambda v: _money_text(v, 2, "B"),
    "total_repaid": lambda v: _money_text(v, 2, "B"),
    "total_due": lambda v: _money_text(v, 2, "M"),
    "avg_cancellation_per_loan": lambda v: _money_text(v, 0, ""),
    "disbursement_efficiency": lambda v: _percent_text(v, 1),
    "avg_interest_rate": lambda v: _percent_text(f"({v}) / 100", 2),
    "weighted_avg_interest_rate": lambda v: _percent_text(f"({v}) / 100", 2),
}

_ALERTS = """
SELECT loan_number, country, borrower, project_name,
 cast(original_principal_amount AS double) AS original_principal_amount,
 cast(cancelled_amount AS double) AS cancelled_amount,
 CASE WHEN original_principal_amount > 0 THEN round(cast(cancelled_amount AS double)
       / cast(original_principal_amount AS double) * 100, 2) ELSE 0 END AS cancellation_ratio,
 CASE WHEN cancelled_amount > 10000000 THEN 'CRITICAL'
      WHEN cancelled_amount > 5000000 THEN 'HIGH' ELSE 'ELEVATED' END AS risk_level,
 loan_status, cast(board_approval_date AS varchar) AS board_approval_date
FROM statements
WHERE cancelled_amount > 1000000
"""


# Loans of the training part.
_TRAIN = "('0x' || substr(md5(loan_number || '|42'), 1, 8))::BIGINT % 100 < 80"

# The same over usable raw rows as cleansing leaves them, a lost principal being 0.
_RAW_ALERTS = (
    _ALERTS.replace("FROM statements", "FROM filled")
    + " AND l_partkey % 97 <> 0 AND loan_number IS NOT NULL"
)


def _null_percentages() -> str:
    rows = []
    for c in contract.COLUMNS:
        n = f"count(*) FILTER (WHERE {c} IS NULL)"
        # Half up in whole numbers.
        share = f"(({n} * 20000 + count(*)) // (2 * count(*))) / 100.0"
        rows.append(
            f"SELECT '{c}' AS column_name, cast({share} AS double) AS null_percent FROM messy"
        )
    return " UNION ALL ".join(rows)


def _cast_failures() -> str:
    rows = []
    for c in contract.NUMERIC + DATES:
        typed = _read_number(c) if c in contract.NUMERIC else _read_date(c)
        rows.append(
            f"SELECT '{c}' AS column_name, "
            f"count(*) FILTER (WHERE {c} IS NOT NULL AND ({typed}) IS NULL) "
            f"AS cast_failures FROM messy"
        )
    return " UNION ALL ".join(rows)


def _lengths() -> str:
    limits = {"project_name": 8, "borrower": 18, "loan_type": 50, "country": 8}
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {n} AS length_limit, "
        f"count(*) FILTER (WHERE length({c}) > {n}) AS violations, "
        f"max(length({c})) AS longest FROM latest"
        for c, n in limits.items()
    )


def _uniqueness() -> str:
    rows = []
    for table, (surrogate, natural) in contract.KEYS.items():
        source = "fact" if table == "fact_loans" else table
        for kind, key in {"surrogate": [surrogate], "natural": natural}.items():
            rows.append(
                f"SELECT '{table}' AS table_name, '{kind}' AS key_kind, "
                f"count(*) AS duplicated_keys FROM (SELECT 1 FROM {source} "
                f"GROUP BY {', '.join(key)} HAVING count(*) > 1)"
            )
    return " UNION ALL ".join(rows)


def _required() -> str:
    rows = []
    for table, fields in contract.WAREHOUSE.items():
        source = "fact" if table == "fact_loans" else table
        rows += [
            f"SELECT '{table}' AS table_name, '{f.name}' AS column_name, "
            f"count(*) FILTER (WHERE {f.name} IS NULL) AS violations FROM {source}"
            for f in fields
            if f.required
        ]
    return " UNION ALL ".join(rows)


def _foreign_keys() -> str:
    return " UNION ALL ".join(
        f"SELECT '{key}' AS foreign_key, "
        f"count(*) FILTER (WHERE f.{key} IS NOT NULL AND d.{key} IS NULL) AS orphans, "
        f"count(*) FILTER (WHERE f.{key} IS NULL) AS missing "
        f"FROM fact f LEFT JOIN {table} d ON f.{key} = d.{key}"
        for table, key in (
            ("dim_country", "country_key"),
            ("dim_project", "project_key"),
            ("dim_loan_type", "loan_type_key"),
            ("dim_borrower", "borrower_key"),
        )
    )


def _loaded_tables() -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, count(*) AS with_time, "
        f"count(*) AS with_file FROM {'fact' if t == 'fact_loans' else t}"
        for t in contract.WAREHOUSE
    )


def _visuals() -> dict[str, str]:
    def grouped(by: str, *aggs: str) -> str:
        return f"SELECT {by}, {', '.join(aggs)} FROM latest GROUP BY {by}"

    types = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    type_columns = []
    for t in types:
        keep = f"FILTER (WHERE loan_type = '{t}')"
        type_columns.append(
            f"round(cast(sum(cancelled_amount) {keep} AS double) / "
            f"cast(sum(original_principal_amount) {keep} AS double), 6) AS \"{t}\""
        )
    cancelled = _sum("cancelled_amount")
    funnel = [
        ("Total Loan Amount", "original_principal_amount"),
        ("Total Disbursed Amount", "disbursed_amount"),
        ("Total Repaid", "repaid_to_ibrd"),
        ("Total Due", "due_to_ibrd"),
    ]
    top_ten = (
        "top AS (SELECT country FROM latest GROUP BY country "
        "ORDER BY sum(original_principal_amount) DESC, country LIMIT 10)"
    )
    parts = [
        ("Total Disbursed Amount", "disbursed_amount"),
        ("Total Cancelled Amount", "cancelled_amount"),
        ("Total Due", "due_to_ibrd"),
    ]
    composition = " UNION ALL ".join(
        f"SELECT country, '{name}' AS component, "
        f"round(cast(sum({c}) AS double) / 1e9, 6) AS amount_billions "
        f"FROM latest WHERE country IN (SELECT country FROM top) GROUP BY country"
        for name, c in parts
    )
    bodies = {
        "total_loan_amount_card": f"SELECT {measures('total_loan_amount')} FROM latest",
        "total_cancelled_card": f"SELECT {measures('total_cancelled_amount')} FROM latest",
        "cancellation_rate_card": (
            f"SELECT {measures('cancellation_rate')}, "
            f"{MEASURES['cancellation_rate']} > 0.15 AS is_alert FROM latest"
        ),
        "loan_count_card": f"SELECT {measures('loan_count')} FROM latest",
        "loan_map": grouped(
            "country", measures("total_loan_amount", "cancellation_rate", "loan_count")
        ),
        "yearly_trend": (
            "SELECT year(board_approval_date) AS approval_year, "
            f"{measures('total_loan_amount', 'total_cancelled_amount')} "
            "FROM latest GROUP BY 1"
        ),
        "cancellations_by_region": grouped("region", cancelled),
        "top_countries_by_cancellation": grouped("country", cancelled)
        + " ORDER BY sum(cancelled_amount) DESC, country LIMIT 10",
        "rate_scatter": grouped(
            "region", measure("avg_interest_rate"), cancelled, measure("loan_count")
        ),
        "region_type_matrix": grouped("region", *type_columns),
        "region_type_rates": grouped(
            "region, loan_type",
            measure("regional_cancellation_rate").replace(
                "AS regional_cancellation_rate", "AS cancellation_rate"
            ),
        ),
        "efficiency_gauge": (
            f"SELECT {measures('disbursement_efficiency')}, cast(0.9 AS double) AS target, "
            f"{MEASURES['disbursement_efficiency']} >= 0.9 AS met FROM latest"
        ),
        "processing_days_card": f"SELECT {measures('avg_processing_days')} FROM latest",
        "repayment_years_card": f"SELECT {measures('avg_repayment_years')} FROM latest",
        "amount_funnel": " UNION ALL ".join(
            f"SELECT {i} AS stage_order, '{name}' AS stage, "
            f"round(cast(sum({c}) AS double) / 1e9, 6) AS amount_billions FROM latest"
            for i, (name, c) in enumerate(funnel, 1)
        ),
        "processing_days_by_region": grouped("region", measure("avg_processing_days")),
        "top_borrowers": grouped(
            "borrower, country",
            measures(
                "total_loan_amount",
                "total_cancelled_amount",
                "cancellation_rate",
                "loan_count",
            ),
        )
        + " ORDER BY sum(original_principal_amount) DESC, borrower, country LIMIT 20",
        "loans_by_region": (
            f"SELECT region, {measure('total_loan_amount')}, "
            "round(cast(sum(original_principal_amount) AS double) / (SELECT "
            "cast(sum(original_principal_amount) AS double) FROM latest), 6) AS share "
            "FROM latest GROUP BY region"
        ),
        "portfolio_composition": f", {top_ten} {composition}",
    }
    return {
        f"visual_{name}": sql(["latest"], body) for name, body in bodies.items()
    }


def _declared_defaults() -> str:
    rows = []
    for table in _DIMENSIONS:
        defaults = {f.name: f.default for f in contract.WAREHOUSE[table] if f.default is not None}
        rows += [
            f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) AS row_count FROM messy "
            f"WHERE l_partkey % {every} = 0 OR coalesce({c}, '{value}') = '{value}'"
            for every, (c, value) in enumerate(defaults.items(), 3)
        ]
    return " UNION ALL ".join(rows)


def _declared_lengths() -> str:
    rows = []
    for table, fields in contract.WAREHOUSE.items():
        for f in fields:
            if f.length:
                rows.append(
                    f"SELECT '{table}' AS table_name, '{f.name}' AS column_name, {f.length} AS length_limit, "
                    f"count(DISTINCT CASE WHEN length({f.name}) > {f.length} THEN {f.name} END) AS violations, "
                    f"cast(max(length({f.name})) AS integer) AS longest FROM latest"
                )
    return " UNION ALL ".join(rows)


def _preparation(share: str) -> str:
    """Deviations of the assembled slots: numbers, then a slot per category by frequency."""
    numbers = {
        "log_principal": "CASE WHEN original_principal_amount > 0 THEN "
        "ln(1 + cast(original_principal_amount AS double)) ELSE 0 END",
        "interest_rate": "cast(interest_rate AS double)",
        "service_charge_rate": "cast(service_charge_rate AS double)",
        "disbursement_ratio": _ratio("disbursed_amount", "original_principal_amount"),
        "repayment_ratio": _ratio("repaid_to_ibrd", "original_principal_amount"),
        "processing_days": f"cast({_DAYS} AS double)",
        "loan_age_days": "cast(DATE '2002-01-01' - board_approval_date AS double)",
        "has_third_party": "CASE WHEN sold_3rd_party > 0 THEN 1.0 ELSE 0.0 END",
    }
    slots = [
        f"SELECT {i} AS part, 0 AS code, '{name}' AS name, stddev_samp({value}) AS deviation, "
        f"true AS in_bound FROM latest WHERE {_TRAIN}"
        for i, (name, value) in enumerate(numbers.items())
    ]
    for i, c in enumerate(("region", "loan_type", "loan_status"), len(numbers)):
        share_of = f"(SELECT count(*) FROM latest WHERE {_TRAIN})"
        slots.append(
            f"SELECT {i}, row_number() OVER (ORDER BY count(*) DESC, {c}) - 1, '{c}_vec_' || {c}, "
            f"sqrt(count(*) * (1.0 - count(*) / cast({share_of} AS double)) / ({share_of} - 1)), "
            f"NULL FROM latest WHERE {_TRAIN} GROUP BY {c} "
            f"UNION ALL SELECT {i}, 1000, '{c}_vec___unknown', 0.0, NULL"
        )
    return (
        "SELECT cast(row_number() OVER (ORDER BY part, code) - 1 AS integer) AS slot, name, "
        f"round(deviation, 6) AS deviation, in_bound FROM ({' UNION ALL '.join(slots)})"
    )


def _oracle() -> dict[str, str]:
    columns = contract.COLUMNS
    share = _ratio("cancelled_amount", "original_principal_amount")
    sparse = ["region", "guarantor", "cancelled_amount", "last_disbursement_date"]
    good = "l_partkey % 97 <> 0"
    keyed = f"{good} AND loan_number IS NOT NULL"
    fact_names = contract.names("fact_loans")

    def empties(alias: str) -> str:
        return ", ".join(
            f"count(*) FILTER (WHERE {c} IS NULL) AS {c}_{alias}" for c in sparse
        )

    zero_base = """, base AS (SELECT * REPLACE (
        CASE WHEN l_orderkey % 7 = 0 THEN 0 ELSE original_principal_amount END
        AS original_principal_amount) FROM latest) """
    result = {
        "cancellation_rate_by_region": sql(
            ["latest"],
            f"SELECT region, {_sum('original_principal_amount', 'principal')}, "
            f"{_sum('cancelled_amount', 'cancelled')}, "
            f"round({MEASURES['regional_cancellation_rate']}, 6) AS cancellation_rate "
            "FROM latest GROUP BY region",
        ),
        "statement_totals": sql(["statements"], f"{_TOTALS} FROM statements"),
        "latest_loans": sql(["latest"], f"SELECT {_plain_list(columns)} FROM latest"),
        "latest_loan_totals": sql(["latest"], f"{_TOTALS} FROM latest"),
        "latest_by_default_order": sql(
            ["statements"],
            f"SELECT {_plain_list(columns)} FROM (SELECT * FROM statements QUALIFY "
            f"row_number() OVER (PARTITION BY loan_number ORDER BY {_default_order()}) = 1)",
        ),
        "distinct_commitments": sql(
            ["statements"],
            "SELECT DISTINCT country_code, loan_type, currency_of_commitment, loan_status "
            "FROM statements",
        ),
        "duplicate_commitments": sql(
            ["statements"],
            "SELECT cast(sum(n - 1) AS bigint) AS exact_duplicates FROM (SELECT count(*) "
            "AS n FROM statements "
            "GROUP BY country_code, loan_type, project_id, loan_status)",
        ),
        "numbers_from_text": sql(
            ["typed"],
            "SELECT l_linenumber, "
            + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}_missing" for c in contract.NUMERIC)
            + ", "
            + ", ".join(_sum(f"cast({c} AS decimal(18,4))", f"{c}_sum") for c in contract.NUMERIC)
            + " FROM typed GROUP BY l_linenumber",
        ),
        "dates_from_text": sql(
            ["typed"],
            "SELECT l_linenumber, "
            + ", ".join(
                f"count({c}) AS {c}_read, cast(min({c}) AS varchar) AS {c}_min, "
                f"cast(max({c}) AS varchar) AS {c}_max"
                for c in DATES
            )
            + " FROM typed GROUP BY l_linenumber",
        ),
        "defaults_filled": sql(
            ["filled"],
            "SELECT region, count(*) FILTER (WHERE guarantor = 'Unknown') "
            "AS unknown_guarantors, "
            "count(*) FILTER (WHERE interest_rate = 0) AS zero_rates, "
            "count(*) FILTER (WHERE cancelled_amount = 0) AS zero_cancelled, "
            "count(*) FILTER (WHERE last_disbursement_date IS NULL) AS no_date, "
            "count(*) AS row_count FROM filled GROUP BY region",
        ),
        "dimension_defaults": sql(
            ["messy"],
            "SELECT coalesce(region, 'Unknown') AS region, "
            "coalesce(guarantor, 'N/A') AS guarantor, count(*) AS row_count "
            "FROM messy GROUP BY 1, 2",
        ),
        "declared_defaults": sql(["messy"], _declared_defaults()),
        "warehouse_dates": sql(
            ["messy"],
            "SELECT loan_type, "
            + ", ".join(f"count(try_cast({c} AS date)) AS {c}_read" for c in DATES)
            + ", "
            + ", ".join(f"cast(max(try_cast({c} AS date)) AS varchar) AS {c}_max" for c in DATES)
            + ", cast("
            + " + ".join(f"count(*) FILTER (WHERE {c} IS NOT NULL AND try_cast({c} AS date) IS NULL)" for c in DATES)
            + " AS bigint) AS cast_failures FROM messy WHERE l_linenumber % 4 = 3 GROUP BY loan_type",
        ),
        "trimmed_text": sql(
            ["statements"],
            "SELECT borrower, country, count(*) AS row_count FROM statements "
            "GROUP BY borrower, country",
        ),
        "warehouse_typing": sql(
            ["messy"],
            "SELECT loan_type, "
            + ", ".join(
                _sum(f"try_cast({c} AS decimal({'8,4' if c in RATES else '18,2'}))", c)
                for c in contract.NUMERIC
            )
            + ", cast(sum(CASE WHEN l_suppkey % 17 = 0 THEN 1 ELSE 0 END "
            + "".join(
                f"+ CASE WHEN l_partkey % {n} = 0 THEN 1 ELSE 0 END "
                for n in (29, 37, 41, 43, 47, 53)
            )
            + ") AS bigint) AS cast_failures "
            "FROM messy GROUP BY loan_type",
        ),
        "bronze_row_counts": sql(
            ["messy"],
            f"SELECT count(*) FILTER (WHERE {good}) AS well_formed, "
            f"count(*) FILTER (WHERE NOT {good}) AS malformed FROM messy",
        ),
        "silver_from_raw_files": sql(
            ["filled"],
            f"SELECT {_plain_list(columns)} FROM (SELECT * FROM filled WHERE {keyed} "
            "QUALIFY row_number() OVER (PARTITION BY loan_number "
            f"ORDER BY {_default_order()}) = 1)",
        ),
        "loaded_after_rebuild": sql(
            ["latest"],
            "SELECT loan_number, cast(cancelled_amount + CASE WHEN l_orderkey % 5 = 0 THEN 1 "
            "ELSE 0 END AS double) AS cancelled_amount FROM latest WHERE l_orderkey % 7 <> 0 "
            "UNION ALL SELECT concat('N', loan_number), cast(cancelled_amount AS double) "
            "FROM latest WHERE l_orderkey % 11 = 0",
        ),
        "loaded_with_bad_file": sql(
            ["latest"],
            "SELECT status, cast(count(*) AS bigint) AS rows FROM (SELECT DISTINCT project_id, "
            "dense_rank() OVER (ORDER BY project_id) - 1 AS k FROM latest) "
            "JOIN (VALUES ('visible', 0), ('LOADED', 0), ('SKIPPED', 1)) s(status, odd) "
            "ON k % 2 = odd GROUP BY status",
        ),
        "recent_load_report": sql(
            ["latest"],
            "SELECT cast(0 AS bigint) AS batch_id, status, cast(count(*) AS bigint) AS rows, "
            "cast(any_value(lost) AS bigint) AS lost_values FROM (SELECT DISTINCT project_id, "
            "dense_rank() OVER (ORDER BY project_id) - 1 AS k FROM latest) "
            "JOIN (VALUES ('LOADED', 0, 0), ('SKIPPED', 1, 1)) s(status, odd, lost) "
            "ON k % 2 = odd GROUP BY status",
        ),
        "fact_from_raw_files": sql(
            ["filled"],
            "SELECT loan_number, "
            + ", ".join(
                f"cast(cast({c} AS decimal({'8,4' if c in RATES else '18,2'})) AS double) AS {c}"
                for c in contract.NUMERIC
            )
            + ", " + _plain_list(DATES)
            + f" FROM (SELECT * FROM filled WHERE {keyed} QUALIFY row_number() OVER "
            f"(PARTITION BY loan_number ORDER BY {_default_order()}) = 1)",
        ),
        "silver_of_one_country": sql(
            ["filled"],
            "SELECT country_code, loan_status, count(*) AS loans, "
            + _sum("cast(disbursed_amount AS decimal(18,2))", "disbursed_amount")
            + f" FROM (SELECT * FROM filled WHERE {keyed} QUALIFY row_number() OVER "
            f"(PARTITION BY loan_number ORDER BY {_default_order()}) = 1) "
            "WHERE country_code = 'C07' GROUP BY country_code, loan_status",
        ),
        "landed_pages": sql(
            ["messy"],
            f"SELECT loan_status, count(*) AS records, {empties('empty')} "
            "FROM messy GROUP BY loan_status",
        ),
        "raw_step_counts": sql(
            ["filled"],
            f"""SELECT count(*) AS loaded, count(*) FILTER (WHERE NOT {good}) AS corrupt,
            count(*) FILTER (WHERE {good} AND loan_number IS NULL) AS without_key,
            count(DISTINCT loan_number) FILTER (WHERE {good}) AS written,
            (SELECT cast(coalesce(sum(n - 1), 0) AS bigint) FROM (SELECT count(*) AS n
             FROM filled WHERE {good} GROUP BY {', '.join(columns)})) AS exact_duplicates
            FROM filled""",
        ),
        "standard_names": sql(
            ["messy"],
            " UNION ALL ".join(
                f"SELECT '{c}' AS column_name, count({c}) AS filled "
                f"FROM messy WHERE {good}"
                for c in columns
            ),
        ),
        "landing_check": sql(
            ["messy"],
            f"SELECT count(*) AS row_count, 33 AS column_count, count(*) > 0 AS passed "
            f"FROM messy WHERE {good}",
        ),
        "copied_csv": sql(
            ["messy"],
            "SELECT loan_status, count(*) AS row_count, 0 AS malformed, "
            f"count(region) AS regions FROM messy WHERE {good} GROUP BY loan_status",
        ),
        "null_percentages": sql(["messy"], _null_percentages()),
        "quality_profile": sql(
            ["latest"],
            "SELECT count(*) AS row_count, 33 AS column_count, "
            + ", ".join(
                f"count(DISTINCT {c}) AS distinct_{c}"
                for c in ("region", "country", "loan_type", "loan_status")
            )
            + " FROM latest",
        ),
        "cast_failures": sql(["messy"], _cast_failures()),
        "length_violations": sql(["latest"], _lengths()),
        "declared_lengths": sql(["latest"], _declared_lengths()),
        "repeated_loan_numbers": sql(
            ["statements"],
            "SELECT loan_number, count(*) AS copies FROM statements "
            "GROUP BY loan_number HAVING count(*) > 1",
        ),
        "key_uniqueness": sql(["fact"], _uniqueness()),
        "required_violations": sql(["fact"], _required()),
        "foreign_key_check": sql(["fact"], _foreign_keys()),
        "orphan_loans": sql(
            ["latest"],
            f"SELECT loan_number, {_plain('original_principal_amount')} FROM latest "
            "WHERE region = 'ASIA'",
        ),
        **{
            t: sql([t], f"SELECT {', '.join(contract.names(t))} FROM {t}")
            for t in _DIMENSIONS
        },
        "fact_loans": sql(["fact"], f"SELECT {_plain_list(fact_names)} FROM fact"),
        "fact_keys_without_broadcast": sql(
            ["fact"], f"SELECT {', '.join(fact_names[:5])} FROM fact"
        ),
        "statement_keys": sql(
            ["statements"],
            "SELECT row_number() OVER (ORDER BY loan_number) - 1 AS loan_key, loan_number "
            "FROM (SELECT DISTINCT loan_number FROM statements)",
        ),
        "star_totals": sql(
            ["latest"],
            "SELECT region, loan_status, count(DISTINCT project_id) AS projects, "
            "count(DISTINCT borrower) AS borrowers, "
            f"{_sum('original_principal_amount', 'principal')} "
            "FROM latest GROUP BY region, loan_status",
        ),
        "clustered_fact": sql(
            ["fact"],
            "SELECT country_key, count(*) AS loans, "
            f"{_sum('loans_held')} FROM fact WHERE country_key BETWEEN 3 AND 7 "
            "AND board_approval_date >= DATE '1998-01-01' GROUP BY country_key",
        ),
        "loan_ratios": sql(
            ["latest"],
            zero_base
            + f"""SELECT loan_number, round({share}, 6) AS cancelled_share,
            round({_ratio('disbursed_amount', 'original_principal_amount')}, 6)
             AS disbursed_share,
            round({_ratio('repaid_to_ibrd', 'original_principal_amount')}, 6)
             AS repaid_share,
            CASE WHEN original_principal_amount <> 0
                 THEN round(cast(cancelled_amount AS double)
                            / cast(original_principal_amount AS double), 6) END AS divided,
            round(({share}) * 100, 2) AS cancelled_percent,
            CASE WHEN cancelled_amount > 10000000 THEN 'CRITICAL'
                 WHEN cancelled_amount > 5000000 THEN 'HIGH' ELSE 'ELEVATED' END
             AS risk_level,
            cast({_DAYS} AS double) AS days,
            CASE WHEN original_principal_amount > 0
                 THEN round(ln(1 + cast(original_principal_amount AS double)), 6)
                 ELSE 0 END AS log_principal,
            cast(CASE WHEN sold_3rd_party > 0 THEN 1 ELSE 0 END AS double) AS third_party,
            cast(CASE WHEN ({share}) > cast(0.1 AS double) THEN 1 ELSE 0 END AS double)
             AS significant,
            {_YEARS} AS years FROM base""",
        ),
        "loan_texts": sql(
            ["latest"],
            f"""SELECT loan_number,
            {_money_text('cast(due_to_ibrd * 0.000001 AS decimal(30,8))', 2, 'B')}
             AS billions,
            {_money_text('cast(due_to_ibrd * 0.001 AS decimal(28,5))', 2, 'M')}
             AS millions,
            {_money_text('due_to_ibrd', 0, '')} AS dollars,
            {_percent_text(share, 2)} AS percent_2, {_percent_text(share, 1)} AS percent_1,
            {_signed_text(f'({share}) - cast(0.1 AS double)')} AS signed,
            {_percent_text('cast(interest_rate AS double) / 100', 2)} AS rate
            FROM latest""",
        ),
        "portfolio_measures": sql(["latest"], f"SELECT {measures()} FROM latest"),
        "statement_measures": sql(
            ["statements"],
            f"SELECT loan_status, {measures()} FROM statements GROUP BY loan_status",
        ),
        "region_measures": sql(
            ["latest"], f"SELECT region, {measures()} FROM latest GROUP BY region"
        ),
        "measure_texts": sql(
            ["latest"],
            "SELECT region, "
            + ", ".join(
                f"{text(MEASURES[name])} AS {name}_text"
                for name, text in _MEASURE_TEXTS.items()
            )
            + " FROM latest GROUP BY region",
        ),
        "dimension_counts": sql(
            ["latest"],
            "SELECT 'country' AS dimension, count(DISTINCT country_code) AS members "
            "FROM latest UNION ALL SELECT 'project', count(DISTINCT project_id) FROM latest",
        ),
        "yoy_cancellation": sql(
            ["latest"],
            _yearly("cancelled_amount")
            + _YOY.format(
                group="",
                name="cancelled_amount",
                change="yoy_cancellation_change",
                more=", CASE WHEN b.v > 0 THEN "
                + _signed_text("cast(a.v - b.v AS double) / cast(b.v AS double)")
                + " ELSE 'N/A' END AS yoy_text",
                match="",
            ),
        ),
        "yoy_cancellation_with_gaps": sql(
            ["latest"],
            _yearly(
                "cancelled_amount", "region", "WHERE year(board_approval_date) % 3 <> 0"
            )
            + _YOY.format(
                group="a.region,",
                name="cancelled_amount",
                change="yoy_cancellation_change",
                more="",
                match="AND a.region = b.region",
            ),
        ),
        "top_three_countries": sql(
            ["latest"],
            "SELECT string_agg(country, ', ' ORDER BY total DESC, country) AS top_countries "
            "FROM (SELECT country, sum(original_principal_amount) AS total FROM latest "
            "GROUP BY country QUALIFY rank() OVER "
            "(ORDER BY sum(original_principal_amount) DESC) <= 3)",
        ),
        "cancellation_ranks": sql(
            ["latest"],
            f"SELECT country, {_sum('cancelled_amount', 'total')}, dense_rank() OVER "
            "(ORDER BY sum(cancelled_amount) DESC) AS cancellation_rank "
            "FROM latest GROUP BY country",
        ),
        "project_ranks_with_ties": sql(
            ["latest"],
            "SELECT project_id, count(*) AS loans, rank() OVER (ORDER BY count(*) DESC) "
            "AS rank FROM latest GROUP BY project_id QUALIFY rank <= 5",
        ),
        "duration_correlations": sql(
            ["latest"],
            f"SELECT region, round(corr(cast({_DAYS} AS double), {share}), 6) "
            f"AS processing_correlation, round(corr(cast({_YEARS} AS double), {share}), 6) "
            "AS repayment_correlation FROM latest GROUP BY region",
        ),
        "declining_borrowers": sql(
            ["latest"],
            _yearly("original_principal_amount", "country")
            + _YOY.format(
                group="a.country,",
                name="principal",
                change="change",
                more="",
                match="AND a.country = b.country",
            )
            + " WHERE b.v > 0 AND a.v < b.v",
        ),
        "cancellation_rate_by_borrower": sql(
            ["latest"],
            "SELECT region, loan_type, borrower, "
            f"round({MEASURES['regional_cancellation_rate']}, 6) AS cancellation_rate "
            "FROM latest GROUP BY region, loan_type, borrower",
        ),
        "repayment_years_by_country": sql(
            ["latest"],
            f"SELECT country, {measure('avg_repayment_years')} FROM latest GROUP BY country",
        ),
        "sliced_measures": sql(
            ["latest"],
            "SELECT country, "
            + measures("total_loan_amount", "cancellation_rate", "loan_count")
            + """ FROM latest WHERE region IN ('ASIA', 'EUROPE') AND country IN
            ('NATION_2', 'NATION_3', 'NATION_7', 'NATION_8', 'NATION_13')
            AND loan_status IN ('O', 'F') AND loan_type = '1-URGENT'
            AND board_approval_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'
            GROUP BY country""",
        ),
        "estimated_loan_counts": sql(
            ["statements"],
            "SELECT region, count(DISTINCT loan_number) AS loan_count, true AS is_close "
            "FROM statements GROUP BY region",
        ),
        "high_risk_alerts": sql(["statements"], _ALERTS),
        "streamed_alerts": sql(["filled"], _RAW_ALERTS),
        "restarted_alerts": sql(["filled"], _RAW_ALERTS),
        "streamed_quarantine": sql(
            ["messy"],
            f"SELECT CASE WHEN {good} THEN 'without_key' ELSE 'corrupt' END AS reason, "
            f"count(*) AS row_count, count(*) FILTER (WHERE NOT ({good})) AS whole_lines, "
            "count(*) AS with_time, count(*) AS with_file FROM messy "
            f"WHERE NOT ({good}) OR loan_number IS NULL GROUP BY 1",
        ),
        "compacted_cleared_source": sql(
            ["latest"],
            "SELECT loan_number, cast(cancelled_amount + CASE WHEN l_orderkey % 15 = 0 THEN 1 "
            "ELSE 0 END AS double) AS cancelled_amount FROM latest",
        ),
        "silver_after_delivery": sql(
            ["filled"],
            f"SELECT {_plain_list(columns)} FROM (SELECT * FROM (SELECT * REPLACE (CASE WHEN "
            "l_partkey % 3 = 0 AND country_code IN ('C01', 'C02', 'C03') AND "
            "cast(substr(loan_number, 2) AS bigint) % 10 = 0 THEN 'C88' ELSE country_code END "
            f"AS country_code) FROM filled WHERE {keyed}) QUALIFY row_number() OVER "
            f"(PARTITION BY loan_number ORDER BY {_default_order()}) = 1)",
        ),
        "copy_audit": sql(
            ["messy"],
            f"SELECT 'PARTIAL' AS status, count(*) AS rows_read, count(*) FILTER (WHERE {good}) "
            "AS rows_copied, true AS has_bytes FROM messy UNION ALL SELECT 'SUCCESS', "
            f"count(*), count(*), true FROM messy WHERE {good}",
        ),
        "rows_across_lines": sql(
            ["filled"],
            "SELECT (SELECT count(*) FROM (SELECT * FROM (SELECT * REPLACE (CASE WHEN "
            "l_partkey % 5 = 0 THEN borrower || chr(10) || country ELSE borrower END AS borrower) "
            f"FROM filled WHERE {keyed}) QUALIFY row_number() OVER (PARTITION BY loan_number "
            f"ORDER BY {_default_order()}) = 1) WHERE contains(borrower, chr(10))) "
            "AS two_line_borrowers, count(*) AS loaded, 0 AS corrupt, "
            "count(*) FILTER (WHERE loan_number IS NULL) AS without_key, "
            f"count(DISTINCT loan_number) AS written FROM filled WHERE {good}",
        ),
        "risk_level_counts": sql(
            ["latest"],
            "SELECT CASE WHEN cancelled_amount > 10000000 THEN 'CRITICAL' "
            "WHEN cancelled_amount > 5000000 THEN 'HIGH' ELSE 'ELEVATED' END AS risk_level, "
            f"count(*) AS loans, {_sum('cancelled_amount')} FROM latest "
            "WHERE cancelled_amount > 1000000 GROUP BY 1",
        ),
        "loaded_fact": sql(["fact"], f"SELECT {_plain_list(fact_names)} FROM fact"),
        "alert_ingestion": sql(
            ["filled"],
            "SELECT CASE WHEN l_partkey % 97 = 0 THEN 'UNREADABLE' "
            "WHEN cancelled_amount > 10000000 THEN 'CRITICAL' "
            "WHEN cancelled_amount > 5000000 THEN 'HIGH' ELSE 'ELEVATED' END AS risk_level, "
            "count(*) AS alerts, count(*) AS with_time, count(*) AS with_file FROM filled "
            "WHERE l_partkey % 97 = 0 OR cancelled_amount > 1000000 GROUP BY 1",
        ),
        "load_history": sql(
            ["latest"],
            "SELECT batch_id, 'LOADED' AS status, count(*) AS rows, 0 AS lost_values "
            "FROM latest, (VALUES (0), (1)) b(batch_id) GROUP BY batch_id",
        ),
        "loaded_tables": sql(["fact"], _loaded_tables()),
        "model_features": sql(
            ["latest"],
            f"""SELECT loan_number,
            CASE WHEN original_principal_amount > 0
                 THEN round(ln(1 + cast(original_principal_amount AS double)), 6)
                 ELSE 0 END AS log_principal,
            cast(interest_rate AS double) AS interest_rate,
            cast(service_charge_rate AS double) AS service_charge_rate,
            round({_ratio('disbursed_amount', 'original_principal_amount')}, 6)
             AS disbursement_ratio,
            round({_ratio('repaid_to_ibrd', 'original_principal_amount')}, 6)
             AS repayment_ratio,
            cast({_DAYS} AS double) AS processing_days,
            cast(DATE '2002-01-01' - board_approval_date AS double) AS loan_age_days,
            cast(CASE WHEN sold_3rd_party > 0 THEN 1 ELSE 0 END AS double)
             AS has_third_party,
            region, loan_type, loan_status,
            cast(CASE WHEN ({share}) > cast(0.1 AS double) THEN 1 ELSE 0 END AS double)
             AS is_high_cancellation FROM latest""",
        ),
        "model_split": sql(
            ["latest"],
            f"""SELECT CASE WHEN {_TRAIN} THEN 'train' ELSE 'test' END AS part,
            cast(sum(y) AS bigint) AS positive, cast(sum(1 - y) AS bigint) AS negative,
            (sum(y) * 20000 + count(*)) // (2 * count(*)) / 100.0 AS positive_percent
            FROM (SELECT loan_number, CASE WHEN ({share}) > cast(0.1 AS double) THEN 1 ELSE 0 END
                  AS y FROM latest) GROUP BY 1""",
        ),
        "scored_loans": sql(
            ["latest"],
            f"""SELECT loan_number, cast(CASE WHEN ({share}) > cast(0.1 AS double) THEN 1
            ELSE 0 END AS double) AS is_high_cancellation, true AS is_scored
            FROM latest WHERE NOT ({_TRAIN})""",
        ),
        "confusion_labels": sql(
            ["latest"],
            f"""SELECT cast(CASE WHEN ({share}) > cast(0.1 AS double) THEN 1 ELSE 0 END
            AS double) AS is_high_cancellation, count(*) AS loans
            FROM latest WHERE NOT ({_TRAIN}) GROUP BY 1""",
        ),
        "model_stages": sql(
            ["latest"],
            " UNION ALL ".join(
                f"SELECT '{c}' AS feature, {c} AS category, cast(row_number() OVER "
                f"(ORDER BY count(*) DESC, {c}) - 1 AS integer) AS code "
                f"FROM latest WHERE {_TRAIN} GROUP BY {c}"
                for c in ("region", "loan_type", "loan_status")
            ),
        ),
        "model_preparation": sql(["latest"], _preparation(share)),
        "class_balance": sql(
            ["latest"],
            f"""SELECT sum(y) AS positive, sum(1 - y) AS negative,
            (sum(y) * 20000 + count(*)) // (2 * count(*)) / 100.0 AS positive_percent
            FROM (SELECT cast(CASE WHEN ({share}) > cast(0.1 AS double) THEN 1 ELSE 0 END
                  AS bigint) AS y FROM latest)""",
        ),
    }
    return {**result, **_visuals()}


ORACLE = _oracle()
