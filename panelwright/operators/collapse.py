"""Entity-by-period panel -> one row per entity.

Everything is one ``groupBy(entity).agg(...)``: partial aggregation on the map
side, one exchange on the entity, final aggregation. A single entity that holds a
large share of the rows therefore reaches its reducer as one partial row per task.

Values at the first and last period are ``min``/``max`` over (period, value)
structs, so they do not depend on row order. Struct and text buffers put the
aggregate on Spark's sort path. Packing the text into numbers to stay on the hash
path was measured and was slower (README), so it is not done.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.operators.auditing import with_share
from panelwright.spec import Last, PanelSpec


def clear_transfer_status(spec: PanelSpec) -> Column:
    """Status with the months of a servicer transfer reset to current."""
    moved = (F.col(spec.transfer) == spec.yes) & (F.col(spec.status) > 0)
    return F.when(moved, 0).otherwise(F.col(spec.status))


def row_flags(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Per-month indicators that the collapse sums, maximises or minimises."""
    plans = ", ".join(f"'{p}'" for p in spec.active_plans)
    codes = ", ".join(f"'{x}'" for x in spec.default_codes)
    return df.withColumn("status_clean", clear_transfer_status(spec)).selectExpr(
        "*",
        f"if({spec.transfer} = '{spec.yes}', 1, 0) AS in_transfer",
        "if(status_clean >= 1, 1, 0) AS behind_30",
        "if(status_clean >= 2, 1, 0) AS behind_60",
        "if(status_clean >= 3, 1, 0) AS behind_90",
        "if(status_clean >= 6, 1, 0) AS behind_180",
        f"if({spec.plan} IN ({plans}), 1, 0) AS in_plan",
        f"if({spec.modified} = '{spec.yes}', 1, 0) AS is_modified",
        f"if(status_clean >= 1, {spec.age}, NULL) AS first_behind_age",
        f"if({spec.code} IN ({codes}), {spec.age}, NULL) AS default_age",
    )


def behaviour(spec: PanelSpec) -> list[Column]:
    return [
        F.max("status_clean").alias("max_delinquency_status"),
        F.sum("behind_30").alias("months_delinquent_30plus"),
        F.sum("behind_60").alias("months_delinquent_60plus"),
        F.sum("behind_90").alias("months_delinquent_90plus"),
        F.max("is_modified").alias("ever_modified"),
        F.max("in_plan").alias("had_forbearance"),
        F.max(spec.age).alias("loan_duration_months"),
        F.min("first_behind_age").alias("time_to_first_delinquency"),
        F.max("in_transfer").alias("had_servicing_transfer"),
        F.max("behind_90").alias("ever_d90"),
        F.max("behind_180").alias("ever_d180"),
        F.min("default_age").alias("time_to_default"),
    ]


def _condition(last: Last) -> str:
    return f"{last.column} > 0" if last.positive else f"{last.column} IS NOT NULL"


def _dated(pick: str, value: str, period: str, condition: str) -> str:
    return f"{pick}(CASE WHEN {condition} THEN struct({period} AS p, {value} AS v) END)"


def _at(pick: str, value: str, period: str, condition: str) -> str:
    return f"{_dated(pick, value, period, condition)}.v"


def collapse(df: DataFrame, spec: PanelSpec) -> DataFrame:
    static = [
        F.expr(_at("min", s, spec.period, f"{s} IS NOT NULL")).alias(s) for s in spec.static
    ]
    last = [
        F.expr(_at("max", x.column, spec.period, _condition(x))).alias(x.alias) for x in spec.last
    ]
    return row_flags(df, spec).groupBy(spec.entity).agg(*static, *behaviour(spec), *last)


# --- partial collapse: later periods are merged into what is stored ------------------------

COUNTED = ("months_delinquent_30plus", "months_delinquent_60plus", "months_delinquent_90plus")
LEAST = ("time_to_first_delinquency", "time_to_default")


def partial(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """One row per entity as ``collapse`` gives, but with (period, value) structs for first and last values, so that
    two partial rows of an entity can be merged. The same single exchange."""
    first = [F.expr(_dated("min", s, spec.period, f"{s} IS NOT NULL")).alias(s) for s in spec.static]
    last = [F.expr(_dated("max", x.column, spec.period, _condition(x))).alias(x.alias) for x in spec.last]
    return row_flags(df, spec).groupBy(spec.entity).agg(*first, *behaviour(spec), *last)


def merge_partials(stored: DataFrame, new: DataFrame, spec: PanelSpec, buckets: int | None = None) -> DataFrame:
    """Partial rows of both frames, one per entity, by one full outer join on the entity.

    The frames have to come from rows of different periods; a period in both would count twice. A stored side that lies
    in ``buckets`` of the entity is not shuffled: the new partial rows are dealt to its buckets, whatever number of
    shuffle partitions the session asks for.
    """
    if buckets:
        new = new.repartition(buckets, spec.entity)
    first = set(spec.static) | set(LEAST)

    def merged(n: str) -> Column:
        a, b = F.col(f"s.{n}"), F.col(f"n.{n}")
        if n in COUNTED:
            return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
        return F.least(a, b) if n in first else F.greatest(a, b)

    key = spec.entity
    joined = stored.alias("s").join(new.alias("n"), F.col(f"s.{key}") == F.col(f"n.{key}"), "full_outer")
    values = [merged(n).alias(n) for n in stored.columns if n != key]
    return joined.select(F.coalesce(f"s.{key}", f"n.{key}").alias(key), *values)


def finish(partials: DataFrame, spec: PanelSpec) -> DataFrame:
    """The collapsed rows behind partial ones; a projection."""
    dated = {*spec.static, *(x.alias for x in spec.last)}
    return partials.select(*[F.col(f"{n}.v").alias(n) if n in dated else F.col(n) for n in partials.columns])


def distribution(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Count and share per value, most frequent first."""
    counts = with_share(df.groupBy(column).agg(F.count("*").alias("n")), "n", "pct")
    ordered = counts.orderBy(F.desc("n"), F.asc_nulls_first(column))
    return ordered.limit(top) if top else ordered
