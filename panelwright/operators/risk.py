"""Entity-level features derived from the collapsed panel. Row-wise only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions import columns as c
from panelwright.spec import RiskRules


def stratum(rules: RiskRules) -> Column:
    default, serious, early, performing = rules.strata
    worst = F.col("max_delinquency_status")
    return c.first_matching(
        [
            (F.col("is_default") == 1, default),
            (worst >= rules.serious_from, serious),
            (worst.between(1, rules.serious_from - 1), early),
        ],
        otherwise=performing,
    )


def outcomes(df: DataFrame, rules: RiskRules) -> DataFrame:
    code = F.col("final_zero_balance_code")
    return df.withColumn("origination_year", F.year("origination_date")).withColumns(
        {
            "vintage_bin": c.in_ranges("origination_year", rules.vintages),
            "is_default": c.flag(
                code.isin(*rules.default_codes) & F.col("final_disposition_date").isNotNull()
            ),
            "ever_foreclosed": c.flag(F.col("final_foreclosure_date").isNotNull()),
            "is_clean_liquidation": c.flag(code.isin(*rules.clean_codes)),
            "has_coborrower": c.flag(F.col("co_borrower_credit_score").isNotNull()),
            "lph_available": c.flag(F.col("last_loan_payment_history").isNotNull()),
        }
    )


def losses(df: DataFrame, rules: RiskRules) -> DataFrame:
    removed = F.col("final_upb_at_removal")
    loss = removed + c.zero_sum(rules.costs) - c.zero_sum(rules.proceeds)
    original, active = F.col("orig_upb"), F.col("last_active_upb")
    return (
        df.withColumn("net_loss", F.when((F.col("is_default") == 1) & removed.isNotNull(), loss))
        .withColumn("net_severity", c.ratio("net_loss", removed))
        .withColumn("rate_spread", F.col("orig_interest_rate") - F.col("last_interest_rate"))
        .withColumn("upb_paydown_pct", c.ratio(original - F.coalesce(active, original), original))
    )


def strata(df: DataFrame, rules: RiskRules) -> DataFrame:
    """Risk stratum and the sampling key; the key of a loan without a vintage has no bar."""
    return df.withColumn("stratum", stratum(rules)).withColumn(
        "sample_key", F.concat_ws("|", "stratum", "vintage_bin")
    )


def history_features(df: DataFrame, column: str = "last_loan_payment_history") -> DataFrame:
    """Four counts from the packed history; all NULL where there is no history."""
    codes = F.col("history_codes")
    return (
        df.withColumn("history_codes", F.when(F.col(column).isNotNull(), c.history_codes(column)))
        .withColumns(
            {
                "ph_months_current_24": F.when(codes.isNotNull(), c.months_current(codes)),
                "ph_months_delinquent_24": F.when(codes.isNotNull(), c.months_behind(codes)),
                "ph_max_delinquency_24": c.worst_month(codes),
                "ph_recent_delinquency_3m": c.behind_recently(codes),
            }
        )
        .drop("history_codes")
    )


def derive(df: DataFrame, rules: RiskRules) -> DataFrame:
    return history_features(strata(losses(outcomes(df, rules), rules), rules))


def skew_transforms(df: DataFrame, status_cap: int = 12) -> DataFrame:
    """Transforms that tame heavy tails before a factor analysis."""
    return df.withColumns(
        {
            "log_upb": F.when(F.col("orig_upb") > 0, F.ln("orig_upb")),
            "sqrt_months_30plus": F.sqrt("months_delinquent_30plus"),
            "sqrt_months_90plus": F.sqrt("months_delinquent_90plus"),
            "capped_status": F.least(F.col("max_delinquency_status"), F.lit(status_cap)),
            "ltv_gap": F.col("orig_cltv") - F.col("orig_ltv"),
        }
    )
