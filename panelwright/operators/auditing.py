"""Data-quality reports.

A report over many columns is one aggregate per batch of columns that returns an
array of structs, unfolded into one row per column. The batches keep the generated
aggregate small; with a columnar source each batch reads only its own columns, so
the batches together read the data once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions import columns as c

MAX_EXPRESSIONS = 80


def per_column(
    df: DataFrame,
    columns: Sequence[str],
    measures: Callable[[str], Mapping[str, Column]],
) -> DataFrame:
    """One row per column with the named aggregate measures."""
    width = max(len(measures(columns[0])), 1)
    step = max(MAX_EXPRESSIONS // width, 1)
    parts = []
    for start in range(0, len(columns), step):
        batch = columns[start : start + step]
        rows = [
            F.struct(F.lit(n).alias("column"), *[m.alias(a) for a, m in measures(n).items()])
            for n in batch
        ]
        parts.append(df.agg(F.array(*rows).alias("rows")).selectExpr("inline(rows)"))
    return reduce(DataFrame.unionByName, parts)


def with_share(counts: DataFrame, n: str, alias: str, digits: int = 2) -> DataFrame:
    """Share of the total in percent. The total is a scalar subquery, so any number of groups will do."""
    total = counts.agg(F.sum(n)).scalar()
    return counts.withColumn(alias, F.round(F.col(n) * 100.0 / total, digits))


def size(df: DataFrame, entity: str) -> DataFrame:
    """Rows, entities, columns and mean periods per entity."""
    per_entity = df.groupBy(entity).agg(F.count("*").alias("n"))
    return per_entity.agg(
        F.sum("n").alias("rows"),
        F.count(entity).alias("entities"),
        F.lit(len(df.columns)).alias("columns"),
        F.round(F.sum("n") / F.count(entity), 4).alias("periods_per_entity"),
    )


def numeric_profile(
    df: DataFrame, columns: Sequence[str], nines: Sequence[int] = (99, 999, 9999)
) -> DataFrame:
    """Min, max, mean, filled cells and hits of each all-nines value, over text columns."""

    # each cell is parsed once, in a projection below the aggregate
    parsed = df.select(*columns, *[c.to_float_or_null(n).alias(f"_value_{n}") for n in columns])

    def measures(n: str) -> dict[str, Column]:
        value = F.col(f"_value_{n}")
        return {
            "min": F.min(value),
            "max": F.max(value),
            "avg": F.round(F.avg(value), 4),
            "filled": F.count_if(~c.is_blank(n)),
        } | {f"hits_{x}": F.count_if(value == x) for x in nines}

    return per_column(parsed, columns, measures)


def sentinel_candidates(profile: DataFrame, nines: Sequence[int] = (99, 999, 9999)) -> DataFrame:
    """Columns whose maximum is all nines, or that hold an all-nines value at all."""
    hits = reduce(lambda a, b: a + b, [F.col(f"hits_{x}") for x in nines])
    as_text = F.col("max").cast("bigint").cast("string")
    all_nines = F.coalesce(as_text.rlike("^9{2,}$"), F.lit(False))
    return (
        profile.withColumn("max_is_nines", c.flag(all_nines))
        .withColumn("hits", hits)
        .where(all_nines | (F.col("hits") > 0))
        .withColumn("pct_of_filled", c.percent("hits", "filled", 3))
    )


def text_hits(df: DataFrame, column: str, code: str) -> DataFrame:
    return df.agg(
        F.count("*").alias("rows"), F.count_if(F.trim(F.col(column)) == code).alias("hits")
    ).withColumn("pct", c.percent("hits", "rows", 3))


def _null_status(pct: Column) -> Column:
    return c.first_matching(
        [
            (pct > 99, "EMPTY"),
            (pct > 95, "RARE"),
            (pct > 50, "HIGH"),
            (pct > 10, "MODERATE"),
            (pct > 1, "LOW"),
        ],
        otherwise="OK",
    )


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return per_column(
        df, columns, lambda n: {"rows": F.count("*"), "nulls": F.count_if(c.is_blank(n))}
    ).withColumn("pct_null", c.percent("nulls", "rows"))


def distinct_estimates(df: DataFrame, columns: Sequence[str], rsd: float = 0.05) -> DataFrame:
    return per_column(df, columns, lambda n: {"distinct": F.approx_count_distinct(n, rsd)})


def distinct_sketches(df: DataFrame, columns: Sequence[str], by: str, precision: int = 14) -> DataFrame:
    """(by, column, rows, nulls, sketch): a mergeable sketch of the distinct values of every column and quarter.

    Stored by quarter, the sketches let a new quarter cost the scan of that quarter alone. A sketch takes at most
    2^precision bytes, whatever the number of rows, and only one per task, quarter and column is shuffled.
    """
    cells = [
        F.struct(
            F.lit(n).alias("column"),
            F.count_if(c.is_blank(n)).alias("nulls"),
            # by the text's hash, which costs less than the text and lets empty text count as a value
            F.hll_sketch_agg(F.when(F.col(n).isNotNull(), F.xxhash64(F.col(n).cast("string"))), precision).alias("sketch"),
        )
        for n in columns
    ]
    grouped = df.groupBy(by).agg(F.count("*").alias("rows"), F.array(*cells).alias("cells"))
    return grouped.select(by, "rows", F.explode("cells").alias("cell")).select(by, "cell.column", "rows", "cell.nulls", "cell.sketch")


def merged_distinct(sketches: DataFrame) -> DataFrame:
    """Rows, nulls and estimated distinct values per column over all quarters whose sketches are given."""
    merged = F.hll_sketch_estimate(F.hll_union_agg("sketch"))
    return sketches.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), merged.alias("distinct")
    )


def null_profile(df: DataFrame, columns: Sequence[str], rsd: float = 0.05) -> DataFrame:
    """Null share, estimated distinct values and a status band, worst column first."""

    def measures(n: str) -> dict[str, Column]:
        return {
            "rows": F.count("*"),
            "nulls": F.count_if(c.is_blank(n)),
            "distinct": F.approx_count_distinct(n, rsd),
        }

    profile = per_column(df, columns, measures).withColumn("pct_null", c.percent("nulls", "rows"))
    return profile.withColumn("status", _null_status(F.col("pct_null"))).orderBy(
        F.desc("pct_null"), "column"
    )


def null_status(counts: DataFrame) -> DataFrame:
    return counts.withColumn("status", _null_status(F.col("pct_null"))).orderBy(
        F.desc("pct_null"), "column"
    )


def exact_distinct(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact distinct values per column. Every column is grouped by itself, on the map side first: a scan of a columnar source
    reads that column only, and one with few values keeps its small table whatever the others hold."""
    parts = [
        df.groupBy(F.col(n).cast("string").alias("value")).agg(F.count("*").alias("n")).select(F.lit(n).alias("column"), "value")
        for n in columns
    ]
    return reduce(DataFrame.unionByName, parts).groupBy("column").agg(F.count("value").alias("distinct"))


def never_filled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns expected to be empty that are not."""
    filled = per_column(df, columns, lambda n: {"filled": F.count(c.blank_to_null(n))})
    return filled.where("filled > 0").orderBy("column")


def null_share_by(df: DataFrame, by: str, columns: Sequence[str], digits: int = 1) -> DataFrame:
    share = {n: F.round(F.count_if(c.is_blank(n)) * 100.0 / F.count("*"), digits) for n in columns}
    return df.groupBy(by).agg(*[s.alias(f"pct_{n}") for n, s in share.items()])


def key_counts(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n"))


def key_uniqueness(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and duplicates, from one grouping on the key."""
    return (
        key_counts(df, key)
        .agg(F.sum("n").alias("rows"), F.count("*").alias("keys"))
        .withColumn("duplicates", F.col("rows") - F.col("keys"))
        .withColumn("pct_duplicates", c.percent("duplicates", "rows", 4))
    )


def duplicate_keys(df: DataFrame, key: Sequence[str], top: int = 10) -> DataFrame:
    return key_counts(df, key).where("n > 1").orderBy(F.desc("n"), *key).limit(top)


def date_format_audit(df: DataFrame, columns: Sequence[str], pattern: str = r"^\d{6}$") -> DataFrame:
    def measures(n: str) -> dict[str, Column]:
        filled = ~c.is_blank(n)
        return {
            "filled": F.count_if(filled),
            "malformed": F.count_if(filled & ~F.col(n).rlike(pattern)),
            "unparsable": F.count_if(filled & c.to_date_or_null(F.trim(F.col(n)), "MMyyyy").isNull()),
        }

    return per_column(df, columns, measures)


def malformed_examples(
    df: DataFrame, entity: str, column: str, pattern: str = r"^\d{6}$", top: int = 5
) -> DataFrame:
    bad = ~c.is_blank(column) & ~F.col(column).rlike(pattern)
    return df.where(bad).select(entity, column).distinct().orderBy(entity, column).limit(top)


def static_consistency(df: DataFrame, entity: str, columns: Sequence[str]) -> DataFrame:
    """Entities that show more than one non-blank value, per supposedly static column.

    Comparing the least and the greatest value needs two fixed aggregates per
    column and no distinct sets, so it runs over all entities.
    """
    # packed batches keep each grouping narrow
    parts = []
    for start in range(0, len(columns), MAX_EXPRESSIONS // 2):
        batch = columns[start : start + MAX_EXPRESSIONS // 2]
        values = {n: c.blank_to_null(F.col(n).cast("string")) for n in batch}
        spread = df.groupBy(entity).agg(
            *[c.flag(F.min(v) != F.max(v)).alias(n) for n, v in values.items()]
        )
        parts.append(
            per_column(
                spread,
                batch,
                lambda n: {"entities": F.count("*"), "inconsistent": F.count_if(F.col(n) == 1)},
            )
        )
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumn("pct", c.percent("inconsistent", "entities", 4))


def code_windows(df: DataFrame, code: str, period: Column) -> DataFrame:
    """First and last period and row count of each code, on parsed dates."""
    tidy = c.blank_to_null(code)
    return (
        df.select(tidy.alias(code), period.alias("period"))
        .where(F.col(code).isNotNull())
        .groupBy(code)
        .agg(F.min("period").alias("first"), F.max("period").alias("last"), F.count("*").alias("n"))
        .orderBy(code)
    )


def code_by_year(df: DataFrame, code: str, period: Column, only: str | None = None) -> DataFrame:
    tidy = df.select(c.blank_to_null(code).alias(code), F.year(period).alias("report_year"))
    kept = tidy.where(F.col(code).isNotNull() if only is None else F.col(code) == only)
    return kept.groupBy("report_year", code).agg(F.count("*").alias("n")).orderBy("report_year", code)


def conditional_rate(df: DataFrame, base: Column, event: Column) -> DataFrame:
    """How many rows meet the base condition, and how many of those the event."""
    return df.agg(
        F.count("*").alias("rows"),
        F.count_if(base).alias("base"),
        F.count_if(base & event).alias("events"),
    ).withColumns({"pct_base": c.percent("base", "rows", 3), "pct_events": c.percent("events", "base", 3)})


def range_audit(
    df: DataFrame,
    bounds: Mapping[str, tuple[float, float]],
    sentinels: Mapping[str, Sequence[str]],
    nines: Sequence[int] = (99, 999, 9999),
) -> DataFrame:
    """Spread of the plausible values and how many fall outside the bounds.

    Declared sentinels never count; other all-nines values are left out only
    where they lie above the upper bound.
    """

    def plausible(n: str) -> Column:
        known = list(sentinels.get(n, ()))
        above = [float(x) for x in nines if x > bounds[n][1] and str(x) not in known]
        value = c.to_float_or_null(n)
        valid = ~c.is_blank(n)
        if known:
            valid = valid & ~F.trim(F.col(n)).isin(*known)
        if above:
            valid = valid & ~value.isin(*above)
        return F.when(valid, value)

    def measures(n: str) -> dict[str, Column]:
        kept = F.col(n)
        return {
            "min": F.min(kept),
            "max": F.max(kept),
            "avg": F.round(F.avg(kept), 4),
            "n": F.count(kept),
            "out_of_range": F.count_if(~kept.between(*bounds[n])),
        }

    # each cell is judged once, in a projection below the aggregate
    values = df.select(*[plausible(n).alias(n) for n in bounds])
    return per_column(values, list(bounds), measures).withColumn(
        "status", F.when(F.col("out_of_range") == 0, "OK").otherwise("OUT OF RANGE")
    )


def code_distribution(
    df: DataFrame, column: str, labels: Mapping[str, str], top: int = 20, blanks: bool = False
) -> DataFrame:
    """Count, share and meaning of each code, most frequent first."""
    codes = df.select(F.trim(F.col(column)).alias("code"))
    if not blanks:
        codes = codes.where(~c.is_blank("code"))
    counts = with_share(codes.groupBy("code").agg(F.count("*").alias("n")), "n", "pct", 3)
    named = counts.withColumn("label", F.coalesce(c.label("code", labels), F.lit("unknown")))
    return named.orderBy(F.desc("n"), F.asc_nulls_first("code")).limit(top)


def partition_balance(df: DataFrame, by: str, entity: str) -> DataFrame:
    """Rows and entities per partition value. Rows are first counted per (value,
    entity), so that a heavy partition value is spread over many tasks."""
    return (
        df.groupBy(by, entity)
        .agg(F.count("*").alias("n"))
        .groupBy(by)
        .agg(F.sum("n").alias("rows"), F.count(entity).alias("entities"))
        .withColumn("rows_per_entity", F.round(F.col("rows") / F.col("entities"), 4))
        .orderBy(by)
    )


def summary(nulls: DataFrame, candidates: DataFrame) -> DataFrame:
    """Headline figures of the audit as (measure, n) rows."""
    bands = nulls.agg(
        F.array(
            F.struct(
                F.lit("columns over 99% null").alias("measure"),
                F.count_if(F.col("pct_null") > 99).alias("n"),
            ),
            F.struct(
                F.lit("columns 50-99% null").alias("measure"),
                F.count_if((F.col("pct_null") > 50) & (F.col("pct_null") <= 99)).alias("n"),
            ),
        ).alias("rows")
    ).selectExpr("inline(rows)")
    found = candidates.agg(F.count("*").alias("n")).select(
        F.lit("columns with sentinel candidates").alias("measure"), "n"
    )
    return bands.unionByName(found)


def cast_loss(df: DataFrame, kinds: Mapping[str, str], date_format: str = "MMyyyy") -> DataFrame:
    """Filled cells before and after the cast of each non-text column of tidy text."""
    from panelwright.operators.cleaning import typed

    columns = [n for n, k in kinds.items() if k != "text"]

    def measures(n: str) -> dict[str, Column]:
        return {"filled": F.count(n), "casted": F.count(F.expr(typed(n, kinds[n], date_format)))}

    report = per_column(df, columns, measures).withColumn("lost", F.col("filled") - F.col("casted"))
    pct = c.percent("lost", "filled", 4)
    return report.withColumn("pct_lost", pct).withColumn(
        "status",
        c.first_matching([(F.col("pct_lost") > 0.01, "WARNING"), (F.col("lost") > 0, "MINOR")], "OK"),
    )


def event_rate(df: DataFrame, code: str, events: Sequence[str]) -> DataFrame:
    tidy = c.blank_to_null(code)
    return df.agg(
        F.count(tidy).alias("ended"), F.count_if(tidy.isin(*events)).alias("events")
    ).withColumn("pct_events", c.percent("events", "ended"))


def assistance_rates(df: DataFrame, modified: str, plan: str, plans: Sequence[str]) -> DataFrame:
    tidy = c.blank_to_null(plan)
    helped = tidy.isNotNull() & ~tidy.isin("7", "9", "N")
    return df.agg(
        F.round(F.count_if(F.trim(F.col(modified)) == "Y") * 100.0 / F.count("*"), 2).alias("pct_modified"),
        F.round(F.count_if(helped) * 100.0 / F.count("*"), 2).alias("pct_assisted"),
        *[F.count_if(tidy == p).alias(f"n_plan_{p.lower()}") for p in plans],
    )


def epoch_summary(df: DataFrame, epoch: str, entity: str, means: Mapping[str, int], status: str, modified: str) -> DataFrame:
    """Rows, entities, means and risk shares per epoch.

    Entities are counted through a first grouping on (epoch, entity), which also
    carries sums and counts of the averaged columns.
    """
    numbers = {n: c.to_float_or_null(n) for n in means}
    first = df.groupBy(epoch, entity).agg(
        F.count("*").alias("n"),
        F.count_if(c.to_int_or_null(F.trim(F.col(status))) >= 3).alias("late"),
        F.count_if(F.trim(F.col(modified)) == "Y").alias("modified"),
        *[F.sum(v).alias(f"sum_{n}") for n, v in numbers.items()],
        *[F.count(v).alias(f"cnt_{n}") for n, v in numbers.items()],
    )
    return first.groupBy(epoch).agg(
        F.sum("n").alias("rows"),
        F.count(entity).alias("entities"),
        *[
            F.round(F.sum(f"sum_{n}") / F.sum(f"cnt_{n}"), digits).alias(f"avg_{n}")
            for n, digits in means.items()
        ],
        F.round(F.sum("late") * 100.0 / F.sum("n"), 2).alias("pct_90plus"),
        F.round(F.sum("modified") * 100.0 / F.sum("n"), 2).alias("pct_modified"),
    )


def monthly_rate(df: DataFrame, period: Column, event: Column) -> DataFrame:
    return (
        df.select(period.alias("period"), c.flag(event).alias("event"))
        .where(F.col("period").isNotNull())
        .groupBy("period")
        .agg(F.count("*").alias("n"), F.round(F.sum("event") * 100.0 / F.count("*"), 2).alias("pct"))
        .orderBy("period")
    )


def length_distribution(df: DataFrame, column: str) -> DataFrame:
    return (
        df.where(~c.is_blank(column))
        .groupBy(F.length(column).alias("length"))
        .agg(F.count("*").alias("n"))
        .orderBy("length")
    )
