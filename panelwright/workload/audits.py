"""Queries over the data-quality reports, mostly on the raw text panel."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import functions as F

from panelwright.functions import columns as c
from panelwright.operators import auditing, cleaning, profiles
from panelwright.presets import mortgage
from panelwright.session import scratch_folder
from panelwright.sources import sinks
from panelwright.workload import fixture as fx
from panelwright.workload.book import Book

book = Book()
Q = mortgage.QUARTER
RULES = mortgage.CLEAN
KEY = ["loan_id", "monthly_reporting_period"]
ACTIVE = RULES.kept
NUMBERS = RULES.of_kind("float", "int")
PERIOD = "cast(try_strptime(trim(monthly_reporting_period), '%m%Y') as date)"
STATUS, PLAN, MOVED = "current_delinquency_status", "borrower_assistance_plan", "servicing_activity_indicator"


def _raw(spark, sf):
    return fx.bronze_table(spark, sf)


def _period():
    return c.month_to_date(F.trim("monthly_reporting_period"))


def _each(columns: Sequence[str], row: Callable[[str], str], source: str = "raw") -> str:
    """One SELECT per column, stacked."""
    return " UNION ALL ".join(f"SELECT '{n}' AS \"column\", {row(n)} FROM {source}" for n in columns)


def _blank(n: str) -> str:
    return f"({n} IS NULL OR trim({n}) = '')"


@book.query(
    "a01_size",
    f"WITH {fx.silver_cte()} SELECT count(*) AS rows, count(DISTINCT loan_id) AS entities, 72 AS columns, "
    "round(count(*) / count(DISTINCT loan_id), 4) AS periods_per_entity FROM silver",
)
def a01(spark, sf):
    return auditing.size(fx.silver_table(spark, sf), "loan_id")


def _profile_row(n: str) -> str:
    v = f"try_cast({n} as double)"
    hits = ", ".join(f"count(*) FILTER (WHERE {v} = {x}) AS hits_{x}" for x in (99, 999, 9999))
    return (
        f"min({v}) AS \"min\", max({v}) AS \"max\", round(avg({v}), 4) AS \"avg\", "
        f"count(*) FILTER (WHERE NOT {_blank(n)}) AS filled, {hits}"
    )


_PROFILE = _each(NUMBERS, _profile_row)


@book.query("a02_numeric_profile", f"WITH {fx.raw_cte()} {_PROFILE}")
def a02(spark, sf):
    return auditing.numeric_profile(_raw(spark, sf), NUMBERS)


@book.query(
    "a03_sentinel_discovery",
    f"WITH {fx.raw_cte()}, prof AS ({_PROFILE}), marked AS (SELECT *, "
    "CASE WHEN regexp_full_match(cast(cast(floor(\"max\") as bigint) as varchar), '9{2,}') THEN 1 ELSE 0 END AS max_is_nines, "
    "hits_99 + hits_999 + hits_9999 AS hits FROM prof) "
    "SELECT *, round(hits * 100.0 / filled, 3) AS pct_of_filled FROM marked WHERE max_is_nines = 1 OR hits > 0",
)
def a03(spark, sf):
    return auditing.sentinel_candidates(auditing.numeric_profile(_raw(spark, sf), NUMBERS))


@book.query(
    "a04_text_sentinel_count",
    f"WITH {fx.raw_cte()} SELECT count(*) AS rows, count(*) FILTER (WHERE trim({STATUS}) = 'XX') AS hits, "
    f"round(count(*) FILTER (WHERE trim({STATUS}) = 'XX') * 100.0 / count(*), 3) AS pct FROM raw",
)
def a04(spark, sf):
    return auditing.text_hits(_raw(spark, sf), STATUS, "XX")


_NULLS = _each(
    ACTIVE,
    lambda n: (
        f"count(*) AS rows, count(*) FILTER (WHERE {_blank(n)}) AS nulls, "
        f"round(count(*) FILTER (WHERE {_blank(n)}) * 100.0 / count(*), 2) AS pct_null"
    ),
)
_BANDS = (
    "CASE WHEN pct_null > 99 THEN 'EMPTY' WHEN pct_null > 95 THEN 'RARE' WHEN pct_null > 50 THEN 'HIGH' "
    "WHEN pct_null > 10 THEN 'MODERATE' WHEN pct_null > 1 THEN 'LOW' ELSE 'OK' END AS status"
)


@book.query("a05_null_counts", f"WITH {fx.raw_cte()} {_NULLS}")
def a05(spark, sf):
    return auditing.null_counts(_raw(spark, sf), ACTIVE)


@book.query(
    "a06_null_status_bands",
    f"WITH {fx.raw_cte()}, nulls AS ({_NULLS}) SELECT *, {_BANDS} FROM nulls ORDER BY pct_null DESC, \"column\"",
)
def a06(spark, sf):
    return auditing.null_status(auditing.null_counts(_raw(spark, sf), ACTIVE))


@book.query("a07_approximate_distinct")
def a07(spark, sf):
    return auditing.distinct_estimates(fx.read(spark, sf, "lineitem"), fx.read(spark, sf, "lineitem").columns)


@book.query(
    "a08_null_profile_exact_distinct",
    f"WITH {fx.raw_cte()} "
    + _each(
        ACTIVE,
        lambda n: (
            f"round(count(*) FILTER (WHERE {_blank(n)}) * 100.0 / count(*), 2) AS pct_null, "
            f"count(DISTINCT {n}) AS \"distinct\""
        ),
    ),
)
def a08(spark, sf):
    raw = _raw(spark, sf)
    nulls = auditing.null_counts(raw, ACTIVE).select("column", "pct_null")
    return nulls.join(auditing.exact_distinct(raw, ACTIVE), "column")


@book.query(
    "a07_distinct_by_merged_sketches",
    f"WITH {fx.raw_cte()} "
    + _each(
        ACTIVE,
        lambda n: f"count(*) AS rows, count(*) FILTER (WHERE {_blank(n)}) AS nulls, count(DISTINCT {n}) AS exact, 1 AS within",
    ),
)
def a07_merged(spark, sf):
    """Sketches are stored by quarter and merged; ``within`` tells whether the estimate is within 5 % of the exact number."""
    raw = _raw(spark, sf)
    folder = scratch_folder(spark, "sketches")
    sinks.overwrite_partitioned(auditing.distinct_sketches(raw, ACTIVE, mortgage.QUARTER), folder, [mortgage.QUARTER], dynamic=True)
    merged = auditing.merged_distinct(spark.read.parquet(folder))
    exact = auditing.exact_distinct(raw, ACTIVE).select("column", F.col("distinct").alias("exact"))
    near = F.abs(F.col("distinct") - F.col("exact")) <= 0.05 * F.col("exact")
    return merged.join(exact, "column").select("column", "rows", "nulls", "exact", near.cast("int").alias("within"))


@book.query(
    "a09_expected_empty_columns",
    f"WITH {fx.raw_cte()}, filled AS ("
    + _each(
        [*RULES.unused, "months_to_amortization", "mi_type", "principal_forgiveness_amount"],
        lambda n: f"count(nullif(trim({n}), '')) AS filled",
    )
    + ") SELECT * FROM filled WHERE filled > 0",
)
def a09(spark, sf):
    expected = [*RULES.unused, "months_to_amortization", "mi_type", "principal_forgiveness_amount"]
    return auditing.never_filled(_raw(spark, sf), expected)


_WATCHED = (
    "borrower_credit_score co_borrower_credit_score dti current_actual_upb mi_percentage "
    "property_valuation_method borrower_assistance_plan"
).split()


def _epoch_sql() -> str:
    return f"CASE WHEN {Q} < '2005' THEN 'early' WHEN {Q} < '2015' THEN 'middle' ELSE 'late' END"


def _with_epoch(df):
    return df.withColumn("epoch", F.expr(_epoch_sql()))


@book.query(
    "a10_null_share_by_epoch",
    f"WITH {fx.raw_cte()} SELECT {_epoch_sql()} AS epoch, "
    + ", ".join(
        f"round(count(*) FILTER (WHERE {_blank(n)}) * 100.0 / count(*), 1) AS pct_{n}" for n in _WATCHED
    )
    + " FROM raw GROUP BY 1",
)
def a10(spark, sf):
    return auditing.null_share_by(_with_epoch(_raw(spark, sf)), "epoch", _WATCHED)


@book.query(
    "a11_key_uniqueness",
    "SELECT count(*) AS rows, (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS keys, "
    "count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS duplicates, "
    "round((count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))) * 100.0 "
    "/ count(*), 4) AS pct_duplicates FROM lineitem",
)
def a11(spark, sf):
    return auditing.key_uniqueness(fx.read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@book.query(
    "a11_panel_key_uniqueness",
    f"WITH {fx.silver_cte()} SELECT sum(n) AS rows, count(*) AS keys, sum(n) - count(*) AS duplicates, "
    f"round((sum(n) - count(*)) * 100.0 / sum(n), 4) AS pct_duplicates FROM (SELECT count(*) AS n FROM silver GROUP BY {', '.join(KEY)})",
)
def a11_panel(spark, sf):
    return auditing.key_uniqueness(fx.silver_table(spark, sf), KEY)


@book.query(
    "a12_duplicate_sample",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1 "
    "ORDER BY n DESC, 1, 2 LIMIT 10",
)
def a12(spark, sf):
    return auditing.duplicate_keys(fx.read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


_DATES = RULES.of_kind("date")


@book.query(
    "a13_date_format_audit",
    f"WITH {fx.raw_cte()} "
    + _each(
        _DATES,
        lambda n: (
            f"count(*) FILTER (WHERE NOT {_blank(n)}) AS filled, "
            f"count(*) FILTER (WHERE NOT {_blank(n)} AND NOT regexp_full_match({n}, '\\d{{6}}')) AS malformed, "
            f"count(*) FILTER (WHERE NOT {_blank(n)} AND try_strptime(trim({n}), '%m%Y') IS NULL) AS unparsable"
        ),
    ),
)
def a13(spark, sf):
    return auditing.date_format_audit(_raw(spark, sf), _DATES)


@book.query(
    "a13_malformed_examples",
    f"WITH {fx.raw_cte()} SELECT DISTINCT loan_id, dti FROM raw WHERE NOT {_blank('dti')} "
    "AND NOT regexp_full_match(dti, '\\d+') ORDER BY 1, 2 LIMIT 5",
)
def a13_examples(spark, sf):
    return auditing.malformed_examples(_raw(spark, sf), "loan_id", "dti", r"^\d+$")


_STATIC = [*mortgage.STATIC_AUDIT, "servicer_name"]


@book.query(
    "a14_static_consistency",
    f"WITH {fx.raw_cte()}, per_loan AS (SELECT loan_id, "
    + ", ".join(f"count(DISTINCT nullif(trim({n}), '')) AS {n}" for n in _STATIC)
    + " FROM raw GROUP BY 1) "
    + _each(
        _STATIC,
        lambda n: (
            f"count(*) AS entities, count(*) FILTER (WHERE {n} > 1) AS inconsistent, "
            f"round(count(*) FILTER (WHERE {n} > 1) * 100.0 / count(*), 4) AS pct"
        ),
        "per_loan",
    ),
)
def a14(spark, sf):
    return auditing.static_consistency(_raw(spark, sf), "loan_id", _STATIC)


@book.query(
    "a15_code_windows",
    f"WITH {fx.raw_cte()} SELECT trim({PLAN}) AS {PLAN}, min({PERIOD}) AS \"first\", max({PERIOD}) AS \"last\", "
    f"count(*) AS n FROM raw WHERE NOT {_blank(PLAN)} GROUP BY 1",
)
def a15(spark, sf):
    return auditing.code_windows(_raw(spark, sf), PLAN, _period())


_YEARS = (
    f"WITH {fx.raw_cte()} SELECT cast(year({PERIOD}) as integer) AS report_year, trim({PLAN}) AS {PLAN}, "
    "count(*) AS n FROM raw WHERE "
)


@book.query("a16_code_by_year", f"{_YEARS} NOT {_blank(PLAN)} GROUP BY 1, 2")
def a16(spark, sf):
    return auditing.code_by_year(_raw(spark, sf), PLAN, _period())


@book.query("a16_one_code_by_year", f"{_YEARS} trim({PLAN}) = 'Y' GROUP BY 1, 2")
def a16_one(spark, sf):
    return auditing.code_by_year(_raw(spark, sf), PLAN, _period(), only="Y")


_BASE = f"trim({MOVED}) = 'Y'"
_EVENT = f"NOT {_blank(STATUS)} AND trim({STATUS}) NOT IN ('00', 'XX')"


def _rate_sql(base: str, event: str) -> str:
    b, e = f"count(*) FILTER (WHERE {base})", f"count(*) FILTER (WHERE ({base}) AND ({event}))"
    return (
        f"WITH {fx.raw_cte()} SELECT count(*) AS rows, {b} AS base, {e} AS events, "
        f"round({b} * 100.0 / count(*), 3) AS pct_base, round({e} * 100.0 / {b}, 3) AS pct_events FROM raw"
    )


@book.query("a17_conditional_rate", _rate_sql(_BASE, _EVENT))
def a17(spark, sf):
    late = ~c.is_blank(STATUS) & ~F.trim(STATUS).isin("00", "XX")
    return auditing.conditional_rate(_raw(spark, sf), F.trim(MOVED) == "Y", late)


@book.query(
    "a18_masked_balances",
    _rate_sql(
        "try_cast(loan_age as integer) BETWEEN 0 AND 6",
        f"{_blank('current_actual_upb')} OR trim(current_actual_upb) IN ('0', '0.00')",
    ),
)
def a18(spark, sf):
    young = F.coalesce(c.to_int_or_null("loan_age").between(0, 6), F.lit(False))
    return auditing.conditional_rate(_raw(spark, sf), young, cleaning.blank_or_zero("current_actual_upb"))


def _range_row(n: str) -> str:
    low, high = mortgage.AUDIT_BOUNDS[n]
    known = list(mortgage.SENTINELS.get(n, ()))
    v = f"try_cast({n} as double)"
    ok = [f"NOT {_blank(n)}", f"{v} IS NOT NULL"]
    ok += [f"trim({n}) <> '{x}'" for x in known]
    ok += [f"{v} <> {x}" for x in (99, 999, 9999) if x > high and str(x) not in known]
    kept = f"CASE WHEN {' AND '.join(ok)} THEN {v} END"
    out = f"count(*) FILTER (WHERE {kept} < {low} OR {kept} > {high})"
    return (
        f"min({kept}) AS \"min\", max({kept}) AS \"max\", round(avg({kept}), 4) AS \"avg\", count({kept}) AS n, "
        f"{out} AS out_of_range, CASE WHEN {out} = 0 THEN 'OK' ELSE 'OUT OF RANGE' END AS status"
    )


@book.query("a19_range_audit", f"WITH {fx.raw_cte()} {_each(list(mortgage.AUDIT_BOUNDS), _range_row)}")
def a19(spark, sf):
    return auditing.range_audit(_raw(spark, sf), mortgage.AUDIT_BOUNDS, mortgage.SENTINELS)


def _codes_sql(column: str) -> str:
    labels = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mortgage.LABELS[column].items())
    return (
        f"WITH {fx.raw_cte()} SELECT trim({column}) AS code, count(*) AS n, "
        f"round(count(*) * 100.0 / sum(count(*)) OVER (), 3) AS pct, "
        f"CASE trim({column}) {labels} ELSE 'unknown' END AS label FROM raw WHERE NOT {_blank(column)} "
        f"GROUP BY trim({column}) ORDER BY n DESC, code LIMIT 20"
    )


def _codes(column: str):
    def run(spark, sf):
        return auditing.code_distribution(_raw(spark, sf), column, mortgage.LABELS[column])

    return run


for _column in mortgage.LABELS:
    book.query(f"a20_codes_{_column}", _codes_sql(_column))(_codes(_column))


@book.query(
    "a21_partition_balance",
    f"WITH {fx.raw_cte()} SELECT {Q}, count(*) AS rows, count(DISTINCT loan_id) AS entities, "
    "round(count(*) / count(DISTINCT loan_id), 4) AS rows_per_entity FROM raw GROUP BY 1",
)
def a21(spark, sf):
    return auditing.partition_balance(_raw(spark, sf), Q, "loan_id")


@book.query(
    "a22_audit_summary",
    f"WITH {fx.raw_cte()}, nulls AS ({_NULLS}), prof AS ({_PROFILE}) "
    "SELECT 'columns over 99% null' AS measure, count(*) FILTER (WHERE pct_null > 99) AS n FROM nulls UNION ALL "
    "SELECT 'columns 50-99% null', count(*) FILTER (WHERE pct_null > 50 AND pct_null <= 99) FROM nulls UNION ALL "
    "SELECT 'columns with sentinel candidates', count(*) FROM prof WHERE hits_99 + hits_999 + hits_9999 > 0 "
    "OR regexp_full_match(cast(cast(floor(\"max\") as bigint) as varchar), '9{2,}')",
)
def a22(spark, sf):
    raw = _raw(spark, sf)
    return auditing.summary(
        auditing.null_counts(raw, ACTIVE), auditing.sentinel_candidates(auditing.numeric_profile(raw, NUMBERS))
    )


def _loss_row(n: str) -> str:
    kind = RULES.kinds[n]
    cast = fx._CASTS[kind].format(n)
    lost = f"(count({n}) - count({cast}))"
    pct = f"CASE WHEN count({n}) > 0 THEN round({lost} * 100.0 / count({n}), 4) END"
    return (
        f"count({n}) AS filled, count({cast}) AS casted, {lost} AS lost, {pct} AS pct_lost, "
        f"CASE WHEN {pct} > 0.01 THEN 'WARNING' WHEN {lost} > 0 THEN 'MINOR' ELSE 'OK' END AS status"
    )


_TYPED = RULES.of_kind("date", "float", "int")


@book.query("a23_cast_loss_audit", f"WITH {fx.text_cte()} {_each(_TYPED, _loss_row, 'tidy')}")
def a23(spark, sf):
    kinds = {n: k for n, k in RULES.kinds.items() if n in _TYPED}
    text = cleaning.clean_text(_raw(spark, sf), RULES).select(*_TYPED)
    return auditing.cast_loss(text, kinds)


_DESCRIBED = "borrower_credit_score orig_ltv dti orig_interest_rate orig_upb current_actual_upb".split()


@book.query(
    "a24_descriptive_statistics",
    f"WITH {fx.silver_cte()} "
    + _each(
        _DESCRIBED,
        lambda n: (
            f"count({n}) AS n, round(avg({n}), 4) AS mean, round(stddev({n}), 4) AS stddev, "
            f"min({n})::double AS \"min\", round(quantile_cont({n}, 0.25), 4)::double AS p25, "
            f"round(quantile_cont({n}, 0.5), 4)::double AS p50, round(quantile_cont({n}, 0.75), 4)::double AS p75, "
            f"max({n})::double AS \"max\""
        ),
        "silver",
    ),
)
def a24(spark, sf):
    stats = profiles.describe(fx.silver_table(spark, sf), _DESCRIBED)
    rounded = {n: F.round(n, 4) for n in ("mean", "stddev", "p25", "p50", "p75")}
    return stats.withColumns(rounded)


@book.query(
    "a25_terminal_event_rate",
    f"WITH {fx.raw_cte()}, done AS (SELECT trim(zero_balance_code) AS z FROM raw WHERE NOT {_blank('zero_balance_code')}) "
    "SELECT count(*) AS ended, count(*) FILTER (WHERE z IN ('02','03','09','15','16')) AS events, "
    "round(count(*) FILTER (WHERE z IN ('02','03','09','15','16')) * 100.0 / count(*), 2) AS pct_events FROM done",
)
def a25(spark, sf):
    return auditing.event_rate(_raw(spark, sf), "zero_balance_code", mortgage.CREDIT_EVENT_CODES)


@book.query(
    "a26_assistance_rates",
    f"WITH {fx.raw_cte()} SELECT round(count(*) FILTER (WHERE trim(modification_flag) = 'Y') * 100.0 / count(*), 2) AS pct_modified, "
    f"round(count(*) FILTER (WHERE trim({PLAN}) NOT IN ('', '7', '9', 'N')) * 100.0 / count(*), 2) AS pct_assisted, "
    + ", ".join(f"count(*) FILTER (WHERE trim({PLAN}) = '{p}') AS n_plan_{p.lower()}" for p in "FRT")
    + " FROM raw",
)
def a26(spark, sf):
    return auditing.assistance_rates(_raw(spark, sf), "modification_flag", PLAN, ["F", "R", "T"])


_MEANS = {"borrower_credit_score": 1, "orig_ltv": 1, "dti": 1, "orig_interest_rate": 2, "orig_upb": 0}


@book.query(
    "a27_u01_epoch_summary",
    f"WITH {fx.raw_cte()} SELECT {_epoch_sql()} AS epoch, count(*) AS rows, count(DISTINCT loan_id) AS entities, "
    + ", ".join(f"round(avg(try_cast({n} as double)), {d}) AS avg_{n}" for n, d in _MEANS.items())
    + f", round(count(*) FILTER (WHERE try_cast(trim({STATUS}) as integer) >= 3) * 100.0 / count(*), 2) AS pct_90plus, "
    "round(count(*) FILTER (WHERE trim(modification_flag) = 'Y') * 100.0 / count(*), 2) AS pct_modified "
    "FROM raw GROUP BY 1",
)
def a27(spark, sf):
    rows = _with_epoch(_raw(spark, sf))
    return auditing.epoch_summary(rows, "epoch", "loan_id", _MEANS, STATUS, "modification_flag")


@book.query(
    "a28_monthly_delinquency_rate",
    f"WITH {fx.raw_cte()} SELECT {PERIOD} AS period, count(*) AS n, round(count(*) FILTER "
    f"(WHERE try_cast(trim({STATUS}) as integer) >= 3) * 100.0 / count(*), 2) AS pct FROM raw GROUP BY 1 ORDER BY 1",
)
def a28(spark, sf):
    late = c.to_int_or_null(F.trim(STATUS)) >= 3
    return auditing.monthly_rate(_raw(spark, sf), _period(), late)


@book.query(
    "a29_history_length",
    f"WITH {fx.raw_cte()} SELECT length(loan_payment_history) AS length, count(*) AS n FROM raw "
    f"WHERE NOT {_blank('loan_payment_history')} GROUP BY 1",
)
def a29(spark, sf):
    return auditing.length_distribution(_raw(spark, sf), "loan_payment_history")
