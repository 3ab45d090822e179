import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.operators import collapse, risk
from panelwright.presets import mortgage
from panelwright.spec import SPARK_TYPES

SCHEMA = T.StructType([T.StructField(n, SPARK_TYPES[k]) for n, k in mortgage.CLEAN.kinds.items()])


def panel(spark, *rows):
    return spark.createDataFrame([tuple(r.get(n) for n in SCHEMA.names) for r in rows], SCHEMA)


def month(i):
    return dt.date(2018 + i // 12, i % 12 + 1, 1)


def record(loan="000001", at=0, **values):
    return {"loan_id": loan, "monthly_reporting_period": month(at), "loan_age": at} | values


def one(spark, *rows):
    out = risk.derive(collapse.collapse(panel(spark, *rows), mortgage.PANEL), mortgage.RISK).collect()
    assert len(out) == 1
    return out[0]


def test_transfer_months_do_not_count_as_late(spark):
    row = one(
        spark,
        record(at=0, current_delinquency_status=4, servicing_activity_indicator="Y"),
        record(at=1, current_delinquency_status=1, servicing_activity_indicator="N"),
    )
    assert row["max_delinquency_status"] == 1
    assert (row["months_delinquent_30plus"], row["months_delinquent_60plus"]) == (1, 0)
    assert row["time_to_first_delinquency"] == 1
    assert (row["had_servicing_transfer"], row["ever_d90"]) == (1, 0)


def test_unknown_status_stays_null_and_is_performing(spark):
    row = one(spark, record(at=0), record(at=1))
    assert row["max_delinquency_status"] is None
    assert row["time_to_first_delinquency"] is None
    assert (row["ever_d90"], row["stratum"]) == (0, "performing")


def test_last_values_are_the_latest_set_ones(spark):
    row = one(
        spark,
        record(at=0, zero_balance_code="01", current_actual_upb=500.0, current_interest_rate=4.0),
        record(at=1, zero_balance_code="09", current_actual_upb=0.0, current_interest_rate=3.0),
        record(at=2, zero_balance_code=None, current_actual_upb=None),
    )
    assert row["final_zero_balance_code"] == "09"
    assert row["last_active_upb"] == 500.0
    assert row["last_interest_rate"] == 3.0


def test_static_values_are_the_earliest_set_ones(spark):
    row = one(spark, record(at=0), record(at=1, channel="R"), record(at=2, channel="C"))
    assert row["channel"] == "R"


def test_default_needs_code_and_date_but_its_time_only_the_code(spark):
    row = one(spark, record(at=7, zero_balance_code="09", upb_at_time_of_removal=100.0))
    assert (row["is_default"], row["time_to_default"], row["net_loss"]) == (0, 7, None)
    row = one(
        spark,
        record(
            at=7,
            zero_balance_code="09",
            disposition_date=month(7),
            upb_at_time_of_removal=100.0,
            foreclosure_costs=20.0,
            net_sales_proceeds=70.0,
        ),
    )
    assert (row["is_default"], row["net_loss"], row["net_severity"]) == (1, 50.0, 0.5)
    assert row["stratum"] == "default"


def test_no_vintage_outside_the_ranges(spark):
    row = one(spark, record(at=0, origination_date=dt.date(1999, 12, 1), current_delinquency_status=2))
    assert (row["vintage_bin"], row["sample_key"]) == (None, "early_dlq")
    row = one(spark, record(at=0, origination_date=dt.date(2008, 12, 1), current_delinquency_status=3))
    assert row["sample_key"] == "serious_dlq|Pre-crisis"


def test_history_features(spark):
    def features(history):
        row = one(spark, record(at=0, loan_payment_history=history))
        return tuple(row[n] for n in mortgage.HISTORY_FEATURES)

    assert features(None) == (None, None, None, None)
    assert features("00" * 24) == (24, 0, 0, 0)
    assert features("XX" * 24) == (0, 0, None, 0)
    assert features("XX" * 12 + "  " * 4 + "00" * 4 + "01" + "00" * 3) == (7, 1, 1, 0)
    assert features("12" + "00" * 22 + "03") == (22, 2, 12, 1)


def test_result_does_not_depend_on_row_order(spark):
    rows = [
        record(f"{i % 5:06d}", i // 5, current_delinquency_status=i % 7, channel="RCB"[i % 3], orig_upb=float(i))
        for i in range(100)
    ]
    a = collapse.collapse(panel(spark, *rows), mortgage.PANEL)
    b = collapse.collapse(panel(spark, *reversed(rows)).repartition(7, F.rand(3)), mortgage.PANEL)
    assert sorted(a.collect()) == sorted(b.collect()) or {str(r) for r in a.collect()} == {str(r) for r in b.collect()}


def test_one_loan_may_hold_most_rows(spark):
    rows = [record("000009", i, current_delinquency_status=1) for i in range(600)]
    rows += [record(f"{i:06d}", 0, current_delinquency_status=0) for i in range(100, 130)]
    out = collapse.collapse(panel(spark, *rows), mortgage.PANEL)
    hot = out.where("loan_id = '000009'").first()
    assert out.count() == 31
    assert hot["months_delinquent_30plus"] == 600


def test_the_collapse_shuffles_once(spark):
    out = collapse.collapse(panel(spark, record()), mortgage.PANEL)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
