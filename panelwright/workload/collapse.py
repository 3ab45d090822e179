"""Queries over the collapse to one row per loan and the derived features."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from panelwright.functions import columns as c
from panelwright.operators import auditing, cleaning, collapse, risk
from panelwright.presets import mortgage
from panelwright.session import scratch_folder
from panelwright.sources import sinks
from panelwright.workload import fixture as fx
from panelwright.workload.book import Book

book = Book()
SPEC = mortgage.PANEL


@book.query("c01_c10_collapse_loans", f"WITH {fx.loans_cte()} SELECT * FROM loans")
def c01(spark, sf):
    return collapse.collapse(fx.silver_table(spark, sf), SPEC)


#: Buckets of the stored partial rows; at full size as many as keep a bucket within a task's memory.
BUCKETS = 32
#: Rows from this date on come as the late part.
LATE = "2015-01-01"


def stored_partials(spark, rows):
    name = f"partials_{uuid.uuid4().hex}"
    return sinks.write_bucketed(collapse.partial(rows, SPEC), name, scratch_folder(spark, "partials"), SPEC.entity, BUCKETS)


@book.query("c01_merged_collapse", f"WITH {fx.loans_cte()} SELECT * FROM loans")
def c01_merged(spark, sf):
    """The earlier months are stored as partial rows in buckets; the later ones are merged into them."""
    silver = fx.silver_table(spark, sf)
    early = F.col(SPEC.period) < F.lit(LATE).cast("date")
    stored = stored_partials(spark, silver.where(early))
    late = collapse.partial(silver.where(~F.coalesce(early, F.lit(False))), SPEC)
    return collapse.finish(collapse.merge_partials(stored, late, SPEC, BUCKETS), SPEC)


@book.query(
    "c03_latest_by_condition",
    f"WITH {fx.silver_cte()} SELECT loan_id, "
    "arg_max(servicer_name, monthly_reporting_period) AS last_servicer, "
    "arg_max(current_actual_upb, monthly_reporting_period) FILTER (WHERE current_actual_upb > 0) "
    "AS last_balance FROM silver GROUP BY 1",
)
def c03(spark, sf):
    return fx.silver_table(spark, sf).groupBy("loan_id").agg(
        c.value_at_latest("servicer_name", SPEC.period).alias("last_servicer"),
        c.value_at_latest("current_actual_upb", SPEC.period, F.col("current_actual_upb") > 0).alias(
            "last_balance"
        ),
    )


def _distribution_sql(column: str, limit: str = "") -> str:
    return (
        f"WITH {fx.gold_cte()} SELECT {column}, count(*) AS n, "
        "round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct FROM gold GROUP BY 1 "
        f"ORDER BY n DESC, {column} ASC NULLS FIRST {limit}"
    )


@book.query("c11_default_distribution", _distribution_sql("is_default"))
def c11_default(spark, sf):
    return collapse.distribution(fx.loan_table(spark, sf, "is_default"), "is_default")


@book.query("c11_final_code_top10", _distribution_sql("final_zero_balance_code", "LIMIT 10"))
def c11_codes(spark, sf):
    return collapse.distribution(fx.loan_table(spark, sf, "final_zero_balance_code"), "final_zero_balance_code", top=10)


@book.query("c11_stratum_distribution", _distribution_sql("stratum"))
def c11_stratum(spark, sf):
    return collapse.distribution(fx.loan_table(spark, sf, "stratum"), "stratum")


_CELLS = (
    f"WITH {fx.gold_cte()} SELECT stratum, vintage_bin, sample_key, count(*) AS n, "
    "round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct FROM gold GROUP BY 1, 2, 3"
)


@book.query("c11_stratum_by_vintage", _CELLS)
def cells(spark, sf):
    counts = (
        fx.gold(spark, sf)
        .groupBy("stratum", "vintage_bin", "sample_key")
        .agg(F.count("*").alias("n"))
    )
    return auditing.with_share(counts, "n", "pct")


_MONEY = ["net_loss", "net_severity", "rate_spread", "upb_paydown_pct"]
_DERIVED = (
    "origination_year vintage_bin is_default ever_foreclosed is_clean_liquidation has_coborrower "
    "lph_available stratum sample_key"
).split()


@book.query(
    "d01_d11_derived_features",
    f"WITH {fx.gold_cte()} SELECT loan_id, {', '.join(_DERIVED)}, "
    + ", ".join(f"round({m}, 4) AS {m}" for m in _MONEY)
    + " FROM gold",
)
def d01(spark, sf):
    loans = collapse.collapse(fx.silver_table(spark, sf), SPEC)
    derived = risk.strata(risk.losses(risk.outcomes(loans, mortgage.RISK), mortgage.RISK), mortgage.RISK)
    return derived.select("loan_id", *_DERIVED, *[F.round(m, 4).alias(m) for m in _MONEY])


@book.query(
    "d12_d16_history_features",
    f"WITH {fx.gold_cte()} SELECT loan_id, last_loan_payment_history, "
    f"{', '.join(mortgage.HISTORY_FEATURES)} FROM gold",
)
def d12(spark, sf):
    period = SPEC.period
    history = (
        fx.silver_table(spark, sf)
        .groupBy("loan_id")
        .agg(c.value_at_latest("loan_payment_history", period).alias("last_loan_payment_history"))
    )
    return risk.history_features(history)


_SKEW = ["log_upb", "sqrt_months_30plus", "sqrt_months_90plus"]


@book.query(
    "d17_skew_transforms",
    f"WITH {fx.gold_cte()} SELECT loan_id, round(ln(orig_upb), 6) AS log_upb, "
    "round(sqrt(months_delinquent_30plus), 6) AS sqrt_months_30plus, "
    "round(sqrt(months_delinquent_90plus), 6) AS sqrt_months_90plus, "
    "least(max_delinquency_status, 12) AS capped_status, orig_cltv - orig_ltv AS ltv_gap FROM gold",
)
def d17(spark, sf):
    out = risk.skew_transforms(fx.loan_table(spark, sf))
    return out.select(
        "loan_id", *[F.round(n, 6).alias(n) for n in _SKEW], "capped_status", "ltv_gap"
    )


def _subset_sql(columns: list[str]) -> str:
    items = [f"round({n}, 4) AS {n}" if n in _MONEY else n for n in columns]
    return f"WITH {fx.gold_cte()} SELECT {', '.join(items)} FROM gold"


@book.query("p19_subset_a_contract", _subset_sql(mortgage.SUBSET_A))
def p19a(spark, sf):
    rows = cleaning.contract(fx.loan_table(spark, sf), mortgage.SUBSET_A)
    return rows.withColumns({m: F.round(m, 4) for m in _MONEY if m in rows.columns})


@book.query("p19_subset_b_contract", _subset_sql(mortgage.SUBSET_B))
def p19b(spark, sf):
    rows = cleaning.contract(fx.loan_table(spark, sf), mortgage.SUBSET_B)
    return rows.withColumns({m: F.round(m, 4) for m in _MONEY if m in rows.columns})
