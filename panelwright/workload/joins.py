"""Joins, set operations, limits and ordered distincts."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelwright.operators import auditing, joins
from panelwright.presets import mortgage
from panelwright.workload import fixture as fx
from panelwright.workload.book import Book

book = Book()
Q = mortgage.QUARTER


@book.query(
    "j01_semi_join_of_entities",
    f"WITH {fx.silver_cte()}, picked AS (SELECT DISTINCT loan_id FROM silver WHERE modification_flag = 'Y') "
    "SELECT property_state, count(*) AS n FROM silver WHERE loan_id IN (SELECT loan_id FROM picked) GROUP BY 1",
)
def j01(spark, sf):
    panel = fx.silver_table(spark, sf)
    picked = panel.where(F.col("modification_flag") == "Y").select("loan_id").distinct()
    kept = joins.rows_of(panel, picked, "loan_id")
    return kept.groupBy("property_state").agg(F.count("*").alias("n"))


@book.query(
    "j02_inner_join",
    f"WITH {fx.silver_cte()}, a AS (SELECT loan_id, max(loan_age) AS age FROM silver GROUP BY 1), "
    "b AS (SELECT loan_id, count(*) AS months FROM silver WHERE modification_flag = 'Y' GROUP BY 1) "
    "SELECT loan_id, age, months FROM a JOIN b USING (loan_id)",
)
def j02(spark, sf):
    panel = fx.silver_table(spark, sf)
    a = panel.groupBy("loan_id").agg(F.max("loan_age").alias("age"))
    b = panel.where(F.col("modification_flag") == "Y").groupBy("loan_id").agg(F.count("*").alias("months"))
    return a.join(b, "loan_id")


@book.query(
    "j03_three_way_join_without_zeros",
    f"WITH {fx.gold_cte()} SELECT ltrim(loan_id, '0') AS id, stratum, vintage_bin, ever_d90 FROM gold "
    "WHERE lph_available = 1",
)
def j03(spark, sf):
    loans = joins.normalise_key(fx.loan_table(spark, sf), "loan_id", "id")
    return joins.align(
        [
            loans.select("id", "stratum"),
            loans.select("id", "vintage_bin"),
            loans.where(F.col("lph_available") == 1).select("id", "ever_d90"),
        ],
        "id",
    )


@book.query(
    "j04_left_join_covariate",
    f"WITH {fx.gold_cte()} SELECT g.loan_id, g.stratum, s.property_state FROM gold g LEFT JOIN "
    "(SELECT loan_id, property_state FROM gold WHERE is_default = 1) s ON g.loan_id = s.loan_id",
)
def j04(spark, sf):
    loans = fx.loan_table(spark, sf)
    states = loans.where(F.col("is_default") == 1).select("loan_id", "property_state")
    return loans.select("loan_id", "stratum").join(states, "loan_id", "left")


_BLOCKS = (["dti", "orig_ltv"], ["ph_max_delinquency_24"], ["origination_year", "mi_percentage"])


@book.query(
    "j05_u03_blocks_complete_in_common",
    f"WITH {fx.gold_cte()} SELECT loan_id, dti, orig_ltv, ph_max_delinquency_24, origination_year, "
    "mi_percentage FROM gold WHERE dti IS NOT NULL AND orig_ltv IS NOT NULL AND "
    "ph_max_delinquency_24 IS NOT NULL AND origination_year IS NOT NULL AND mi_percentage IS NOT NULL",
)
def j05(spark, sf):
    loans = fx.loan_table(spark, sf)
    return joins.align([loans.select("loan_id", *b).na.drop() for b in _BLOCKS], "loan_id")


@book.query(
    "j06_u04_anti_join",
    f"WITH {fx.silver_cte()} SELECT DISTINCT {Q} FROM silver WHERE {Q} NOT IN "
    f"(SELECT {Q} FROM silver WHERE property_state = 'CA' AND modification_flag = 'Y')",
)
def j06(spark, sf):
    panel = fx.silver_table(spark, sf)
    done = panel.where("property_state = 'CA' AND modification_flag = 'Y'").select(Q).distinct()
    return joins.rows_without(panel.select(Q).distinct(), done, [Q])


@book.query(
    "u01_union_all",
    f"WITH {fx.silver_cte()} SELECT 'first' AS part, property_state, count(*) AS n FROM silver "
    f"WHERE {Q} < '2005' GROUP BY 2 UNION ALL SELECT 'second', property_state, count(*) FROM silver "
    f"WHERE {Q} >= '2005' GROUP BY 2",
)
def u01(spark, sf):
    panel = fx.silver_table(spark, sf)

    def counts(name, rows):
        return rows.groupBy("property_state").agg(F.count("*").alias("n")).select(
            F.lit(name).alias("part"), "property_state", "n"
        )

    return counts("first", panel.where(F.col(Q) < "2005")).unionByName(
        counts("second", panel.where(F.col(Q) >= "2005"))
    )


@book.query(
    "u02_distinct",
    f"WITH {fx.silver_cte()} SELECT DISTINCT channel, loan_purpose, occupancy_status FROM silver",
)
def u02(spark, sf):
    return fx.silver_table(spark, sf).select("channel", "loan_purpose", "occupancy_status").distinct()


@book.query(
    "u03_intersect",
    f"WITH {fx.gold_cte()} SELECT loan_id FROM gold WHERE dti IS NOT NULL INTERSECT "
    "SELECT loan_id FROM gold WHERE lph_available = 1",
)
def u03(spark, sf):
    loans = fx.loan_table(spark, sf)
    return (
        loans.where("dti IS NOT NULL").select("loan_id").intersect(loans.where("lph_available = 1").select("loan_id"))
    )


@book.query(
    "u04_except",
    f"WITH {fx.gold_cte()} SELECT loan_id FROM gold WHERE ever_d90 = 1 EXCEPT "
    "SELECT loan_id FROM gold WHERE is_default = 1",
)
def u04(spark, sf):
    loans = fx.loan_table(spark, sf)
    late, gone = (loans.where(x).select("loan_id") for x in ("ever_d90 = 1", "is_default = 1"))
    return late.exceptAll(gone)


@book.query(
    "o01_top_k",
    f"WITH {fx.silver_cte()} SELECT loan_payment_history, count(*) AS n FROM silver "
    "WHERE loan_payment_history IS NOT NULL GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10",
)
def o01(spark, sf):
    history = "loan_payment_history"
    counts = fx.silver_table(spark, sf).where(F.col(history).isNotNull()).groupBy(history).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), history).limit(10)


@book.query(
    "o02_w01_status_order",
    f"WITH {fx.raw_cte()} SELECT trim(current_delinquency_status) AS status, count(*) AS n, "
    "round(count(*) * 100.0 / sum(count(*)) OVER (), 3) AS pct FROM raw GROUP BY 1 "
    "ORDER BY CASE WHEN trim(current_delinquency_status) = 'XX' THEN 999 "
    "ELSE try_cast(trim(current_delinquency_status) AS integer) END LIMIT 15",
)
def o02(spark, sf):
    status = F.trim("current_delinquency_status").alias("status")
    counts = fx.bronze_table(spark, sf).groupBy(status).agg(F.count("*").alias("n"))
    order = F.when(F.col("status") == "XX", 999).otherwise(F.col("status").try_cast("int"))
    return auditing.with_share(counts, "n", "pct", 3).orderBy(order).limit(15)


@book.query(
    "o03_ordered_distinct",
    f"WITH {fx.silver_cte()} SELECT DISTINCT {Q} FROM silver ORDER BY 1",
)
def o03(spark, sf):
    return fx.silver_table(spark, sf).select(Q).distinct().orderBy(Q)
