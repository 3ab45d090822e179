"""Queries over the cleaning steps and the typed panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelwright.functions import columns as c
from panelwright.operators import cleaning, collapse
from panelwright.presets import mortgage
from panelwright.workload import fixture as fx
from panelwright.workload import ingest
from panelwright.workload.book import Book

book = Book()
KEY = ["loan_id", "monthly_reporting_period"]
RULES = mortgage.CLEAN


def _raw(spark, sf):
    return fx.bronze_table(spark, sf)


def _text(spark, sf):
    return cleaning.clean_text(fx.bronze_table(spark, sf), RULES)


@book.query(
    "p01_drop_unused",
    f"WITH {fx.raw_cte()} SELECT {', '.join(RULES.kept)} FROM raw",
)
def p01(spark, sf):
    return cleaning.drop_columns(_raw(spark, sf), RULES.unused)


@book.query(
    "p02_positional_rename",
    f"WITH {fx.raw_cte()} SELECT loan_id AS id, monthly_reporting_period AS period, "
    "orig_upb AS amount, current_delinquency_status AS status FROM raw",
)
def p02(spark, sf):
    raw = _raw(spark, sf)
    unnamed = raw.toDF(*[f"_c{i}" for i in range(len(raw.columns))])
    return cleaning.rename_positional(unnamed, {1: "id", 2: "period", 9: "amount", 39: "status"})


_SENTINEL_SQL = ", ".join(
    f"nullif(trim({n}), '{codes[0]}') AS {n}" for n, codes in mortgage.SENTINELS.items()
)


@book.query(
    "p03_sentinels_to_null",
    f"WITH {fx.raw_cte()} SELECT {', '.join(KEY)}, {_SENTINEL_SQL} FROM raw",
)
def p03(spark, sf):
    columns = list(mortgage.SENTINELS)
    trimmed = _raw(spark, sf).select(*KEY, *[F.trim(F.col(n)).alias(n) for n in columns])
    return cleaning.null_sentinels(trimmed, mortgage.SENTINELS)


@book.query(
    "p04_recode_plan",
    f"WITH {fx.raw_cte()} SELECT p AS borrower_assistance_plan, count(*) AS n FROM "
    "(SELECT CASE WHEN trim(borrower_assistance_plan) = 'Y' THEN 'F' "
    "ELSE trim(borrower_assistance_plan) END AS p FROM raw) GROUP BY 1",
)
def p04(spark, sf):
    plan = "borrower_assistance_plan"
    trimmed = _raw(spark, sf).select(F.trim(F.col(plan)).alias(plan))
    return cleaning.recode_columns(trimmed, RULES.recodes).groupBy(plan).agg(F.count("*").alias("n"))


@book.query(
    "p05_trim_blanks",
    f"WITH {fx.raw_cte()} SELECT "
    + ", ".join(f"nullif(trim({n}), '') AS {n}" for n in RULES.kept)
    + " FROM raw",
)
def p05(spark, sf):
    return cleaning.trim_blanks(_raw(spark, sf).select(*RULES.kept))


_DATES = RULES.of_kind("date")
_NUMBERS = RULES.of_kind("float", "int")


@book.query(
    "p06_parse_month_dates",
    f"WITH {fx.silver_cte()} SELECT loan_id, {', '.join(_DATES)} FROM casted",
)
def p06(spark, sf):
    kinds = {n: k for n, k in RULES.kinds.items() if k == "date"}
    return cleaning.cast_columns(_text(spark, sf).select("loan_id", *_DATES), kinds)


@book.query(
    "p07_cast_numbers",
    f"WITH {fx.silver_cte()} SELECT loan_id, {', '.join(_NUMBERS)} FROM casted",
)
def p07(spark, sf):
    kinds = {n: k for n, k in RULES.kinds.items() if k in ("float", "int")}
    return cleaning.cast_columns(_text(spark, sf).select("loan_id", *_NUMBERS), kinds)


@book.query(
    "p08_range_to_null",
    f"WITH {fx.silver_cte()} SELECT loan_id, {', '.join(mortgage.BOUNDS)} FROM silver",
)
def p08(spark, sf):
    columns = list(mortgage.BOUNDS)
    casted = cleaning.cast_columns(_text(spark, sf).select("loan_id", *columns), RULES.kinds)
    return cleaning.null_out_of_range(casted, mortgage.BOUNDS)


@book.query("p10_silver_panel", f"WITH {fx.silver_cte()} SELECT * FROM silver")
def p10(spark, sf):
    return cleaning.enforce(cleaning.clean(_raw(spark, sf), RULES), RULES)


@book.query(
    "p11_partition_preview",
    f"WITH {fx.silver_cte()} SELECT loan_id, monthly_reporting_period, orig_upb FROM silver "
    "WHERE acquisition_quarter = '2005Q1' ORDER BY 1, 2, 3 LIMIT 5",
)
def p11(spark, sf):
    return cleaning.preview(
        spark.read.parquet(ingest.silver_folder(spark, sf)), mortgage.QUARTER, "2005Q1", [*KEY, "orig_upb"], rows=5
    )


_FLAGS = (
    "status_clean in_transfer behind_30 behind_60 behind_90 in_plan is_modified "
    "first_behind_age default_age"
).split()
_FLAG_SQL = """
SELECT loan_id, monthly_reporting_period, sc AS status_clean,
  CASE WHEN servicing_activity_indicator = 'Y' THEN 1 ELSE 0 END AS in_transfer,
  CASE WHEN sc >= 1 THEN 1 ELSE 0 END AS behind_30,
  CASE WHEN sc >= 2 THEN 1 ELSE 0 END AS behind_60,
  CASE WHEN sc >= 3 THEN 1 ELSE 0 END AS behind_90,
  CASE WHEN borrower_assistance_plan IN ('F','R','T','O') THEN 1 ELSE 0 END AS in_plan,
  CASE WHEN modification_flag = 'Y' THEN 1 ELSE 0 END AS is_modified,
  CASE WHEN sc >= 1 THEN loan_age END AS first_behind_age,
  CASE WHEN zero_balance_code IN ('02','03','09','15') THEN loan_age END AS default_age
FROM flagged"""


@book.query("p12_p15_row_flags", f"WITH {fx.loans_cte()} {_FLAG_SQL}")
def p12(spark, sf):
    return collapse.row_flags(fx.silver_table(spark, sf), mortgage.PANEL).select(*KEY, *_FLAGS)


@book.query(
    "p16_complete_cases",
    f"WITH {fx.silver_cte()} SELECT loan_id, monthly_reporting_period, dti, orig_ltv FROM silver "
    "WHERE dti IS NOT NULL AND orig_ltv IS NOT NULL AND mi_percentage IS NOT NULL",
)
def p16(spark, sf):
    panel = fx.silver_table(spark, sf)
    return cleaning.complete_cases(panel, ["dti", "orig_ltv", "mi_percentage"]).select(
        *KEY, "dti", "orig_ltv"
    )


@book.query(
    "p17_plausible_rows",
    f"WITH {fx.silver_cte()} SELECT loan_id, monthly_reporting_period, borrower_credit_score, dti "
    "FROM silver WHERE borrower_credit_score BETWEEN 300 AND 850 AND dti BETWEEN 0 AND 65 "
    "AND orig_ltv BETWEEN 1 AND 97 AND orig_upb > 1000",
)
def p17(spark, sf):
    kept = cleaning.plausible(
        fx.silver_table(spark, sf),
        between={"borrower_credit_score": (300, 850), "dti": (0, 65), "orig_ltv": (1, 97)},
        above={"orig_upb": 1000},
    )
    return kept.select(*KEY, "borrower_credit_score", "dti")


@book.query(
    "p18_blank_or_zero",
    f"WITH {fx.raw_cte()} SELECT loan_id, monthly_reporting_period, current_actual_upb FROM raw "
    "WHERE current_actual_upb IS NULL OR trim(current_actual_upb) IN ('', '0', '0.00')",
)
def p18(spark, sf):
    return (
        _raw(spark, sf)
        .where(cleaning.blank_or_zero("current_actual_upb"))
        .select(*KEY, "current_actual_upb")
    )


@book.query(
    "x01_text_functions",
    f"WITH {fx.raw_cte()} SELECT loan_id, ltrim(loan_id, '0') AS short_id, length(loan_id) AS width, "
    "cast(substr(monthly_reporting_period, 3, 4) as integer) AS report_year, "
    "cast(regexp_extract(acquisition_quarter, '(\\d{4})Q(\\d)', 2) as integer) AS quarter, "
    "concat_ws('|', trim(channel), nullif(trim(zero_balance_code), '')) AS pair, "
    "len(string_split(monthly_reporting_period || '||', '|')) AS parts FROM raw",
)
def x01(spark, sf):
    period = F.col("monthly_reporting_period")
    return _raw(spark, sf).select(
        "loan_id",
        F.ltrim(F.col("loan_id"), F.lit("0")).alias("short_id"),
        F.length("loan_id").alias("width"),
        F.substring(period, 3, 4).cast("int").alias("report_year"),
        F.regexp_extract("acquisition_quarter", r"(\d{4})Q(\d)", 2).cast("int").alias("quarter"),
        F.concat_ws("|", F.trim("channel"), c.blank_to_null("zero_balance_code")).alias("pair"),
        F.size(F.split(F.concat(period, F.lit("||")), r"\|")).alias("parts"),
    )
