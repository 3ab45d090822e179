from collections import Counter

import pytest

from panelwright.operators import cleaning
from panelwright.presets import mortgage
from panelwright.spec import CleanRules, Field


def test_layout_sizes():
    rules = mortgage.CLEAN
    assert len(rules.raw_names) == 110
    assert len(rules.unused) == 39
    assert len(rules.kept) == 72
    assert Counter(rules.kinds.values()) == {"text": 29, "float": 20, "int": 14, "date": 9}


def test_positions_of_key_fields():
    at = {n: i + 1 for i, n in enumerate(mortgage.CLEAN.raw_names)}
    assert at["loan_id"] == 2
    assert at["monthly_reporting_period"] == 3
    assert at["current_delinquency_status"] == 40
    assert at["loan_payment_history"] == 41
    assert at["zero_balance_code"] == 44
    assert at["net_sales_proceeds"] == 59
    assert at["borrower_assistance_plan"] == 102
    assert at["interest_bearing_upb"] == 110


def test_collapse_and_subset_sizes():
    assert len(mortgage.PANEL.static) == 21
    assert len(mortgage.PANEL.last) == 16
    assert len(mortgage.SUBSET_A) == 41
    assert len(mortgage.SUBSET_B) == 51
    assert mortgage.SUBSET_B[:41] == mortgage.SUBSET_A


def test_rules_reject_overlap_and_unknown_columns():
    with pytest.raises(ValueError):
        CleanRules(layout=(Field("a", "text"), Field("a", "int")))
    with pytest.raises(ValueError):
        CleanRules(layout=(Field("a", "text"),), bounds={"b": (0, 1)})
    with pytest.raises(ValueError):
        CleanRules(layout=(Field("a", "words"),))


def test_enforce_reports_missing_extra_and_wrong_types(spark):
    rules = CleanRules(layout=(Field("a", "text"), Field("b", "int"), Field("c", "date")))
    df = spark.createDataFrame([("x", "1", 2)], "a string, b string, d int")
    assert sorted(cleaning.schema_problems(df, rules)) == [
        ("b", "expected int, found string"),
        ("c", "missing"),
        ("d", "extra"),
    ]
    with pytest.raises(ValueError):
        cleaning.enforce(df, rules)
