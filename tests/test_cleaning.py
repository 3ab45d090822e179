import datetime as dt

from panelwright.operators import auditing, cleaning
from panelwright.spec import CleanRules, Field

RULES = CleanRules(
    layout=(
        Field("id", "text"),
        Field("gone", "unused"),
        Field("month", "date"),
        Field("score", "int"),
        Field("rate", "float"),
        Field("plan", "text"),
        Field("status", "int"),
    ),
    sentinels={"score": ("9999",), "status": ("XX",)},
    recodes={"plan": {"Y": "F"}},
    bounds={"score": (300, 850), "rate": (0, 20)},
)


def _clean(spark, *rows):
    raw = spark.createDataFrame(rows, "id string, gone string, month string, score string, rate string, plan string, status string")
    return cleaning.clean(raw, RULES)


def test_each_kind_of_dirty_value(spark):
    out = _clean(
        spark,
        ("0001", "z", "092018", " 700 ", "3.625", "Y", "02"),
        ("0002", None, "132018", "9999", "20", " Y", "XX"),
        ("0003", "", "92018", "299", "20.01", "N", " XX"),
        ("0004", "", "000000", "abc", "-0.1", "", "ab"),
        ("0005", "", None, "85.7", "  ", None, None),
        ("0006", "", "010000", "850", "0", "F", "00"),
    ).orderBy("id")
    rows = [tuple(r) for r in out.collect()]
    assert out.columns == ["id", "month", "score", "rate", "plan", "status"]
    assert rows == [
        ("0001", dt.date(2018, 9, 1), 700, 3.625, "F", 2),
        ("0002", None, None, 20.0, "F", None),
        ("0003", None, None, None, "N", None),
        ("0004", None, None, None, None, None),
        ("0005", None, None, None, None, None),
        ("0006", None, 850, 0.0, "F", 0),
    ]


def test_decimal_text_is_cut_to_an_integer(spark):
    raw = spark.createDataFrame([("700.9",), ("-3.9",), ("3000000000",), ("1e2",)], "score string")
    out = cleaning.cast_columns(raw, {"score": "int"}).collect()
    assert [r[0] for r in out] == [700, -3, None, 100]


def test_other_date_formats_go_through_the_formatter(spark):
    raw = spark.createDataFrame([("2018-09-30",), ("x",)], "d string")
    out = cleaning.cast_columns(raw, {"d": "date"}, "yyyy-MM-dd").collect()
    assert [r[0] for r in out] == [dt.date(2018, 9, 30), None]


def test_cleaning_keeps_rows_and_is_idempotent_on_text(spark):
    raw = spark.createDataFrame(
        [("a", "", "092018", " 1 ", "2", "Y", "XX")] * 3,
        "id string, gone string, month string, score string, rate string, plan string, status string",
    )
    once = cleaning.clean_text(raw, RULES)
    twice = cleaning.recode_columns(
        cleaning.null_sentinels(cleaning.trim_blanks(once), RULES.sentinels), RULES.recodes
    )
    assert once.count() == 3
    assert once.collect() == twice.collect()


def test_cast_loss_counts_filled_cells_that_do_not_parse(spark):
    raw = spark.createDataFrame(
        [("a", "", "092018", "1", "x", "N", "0"), ("b", "", "132018", "", "2", "N", "0")],
        "id string, gone string, month string, score string, rate string, plan string, status string",
    )
    report = {r["column"]: r for r in auditing.cast_loss(cleaning.clean_text(raw, RULES), RULES.kinds).collect()}
    assert (report["month"]["lost"], report["rate"]["lost"], report["score"]["lost"]) == (1, 1, 0)
    assert report["rate"]["status"] == "WARNING"
    assert report["score"]["status"] == "OK"
