"""Column builders shared by the operators. Each returns a JVM-side ``Column``."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


MONTH_PATTERN = "^(0[1-9]|1[0-2])(?!0000)[0-9]{4}$"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: str | Column) -> Column:
    return F.nullif(F.trim(col(c)), F.lit(""))


def is_blank(c: str | Column) -> Column:
    """True for NULL and for whitespace-only text."""
    return F.coalesce(F.trim(col(c)) == "", F.lit(True))


def null_if_in(c: str | Column, codes: Sequence[str]) -> Column:
    return F.when(~col(c).isin(*codes), col(c))


def recode(c: str | Column, mapping: Mapping[str, str]) -> Column:
    """Replace the listed codes and leave all other values as they are."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.coalesce(F.element_at(F.create_map(*pairs), col(c)), col(c))


def label(c: str | Column, mapping: Mapping[str, str]) -> Column:
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.element_at(F.create_map(*pairs), col(c))


def to_date_or_null(c: str | Column, fmt: str) -> Column:
    return F.try_to_date(col(c), fmt)


def month_to_date(c: str | Column) -> Column:
    """First day of a six-digit MMYYYY month; NULL for anything else."""
    v = col(c)
    parts = F.make_date(F.substring(v, 3, 4).cast("int"), F.substring(v, 1, 2).cast("int"), F.lit(1))
    return F.when(v.rlike(MONTH_PATTERN), parts)


def to_float_or_null(c: str | Column) -> Column:
    return col(c).try_cast("double")


def to_int_or_null(c: str | Column) -> Column:
    """Integer text, or decimal text cut towards zero; NULL for anything else."""
    return F.coalesce(col(c).try_cast("int"), col(c).try_cast("double").try_cast("int"))


def keep_between(c: str | Column, low: float, high: float) -> Column:
    return F.when(col(c).between(low, high), col(c))


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it fails or is unknown."""
    return F.when(condition, 1).otherwise(0)


def ratio(top: str | Column, bottom: str | Column) -> Column:
    """``top / bottom`` where the divisor is positive, else NULL."""
    return F.when(col(bottom) > 0, col(top) / col(bottom))


def percent(part: str | Column, whole: str | Column, digits: int = 2) -> Column:
    return F.round(F.when(col(whole) > 0, col(part) * 100.0 / col(whole)), digits)


def value_at_latest(value: str | Column, period: str, condition: Column | None = None) -> Column:
    """Aggregate: the value at the greatest period that satisfies the condition."""
    v = col(value)
    ok = v.isNotNull() if condition is None else condition
    return F.max(F.when(ok, F.struct(F.col(period).alias("p"), v.alias("v"))))["v"]


def value_at_earliest(value: str | Column, period: str) -> Column:
    v = col(value)
    return F.min(F.when(v.isNotNull(), F.struct(F.col(period).alias("p"), v.alias("v"))))["v"]


def first_matching(cases: Iterable[tuple[Column, object]], otherwise: object = None) -> Column:
    """Value of the first condition that holds."""
    chain = reduce(lambda acc, cv: acc.when(cv[0], cv[1]), cases, F)
    return chain if otherwise is None else chain.otherwise(otherwise)


def in_ranges(c: str | Column, ranges: Mapping[str, tuple[int, int]]) -> Column:
    """Name of the inclusive range that holds the value; NULL outside all of them."""
    return first_matching((col(c).between(lo, hi), name) for name, (lo, hi) in ranges.items())


def ordinal(c: str | Column, levels: Sequence[str]) -> Column:
    """Position (from 1) in an ordered list of levels; unknown values give NULL."""
    position = F.array_position(F.array(*[F.lit(x) for x in levels]), col(c))
    return F.nullif(position, F.lit(0).cast("bigint")).cast("int")


def yes_no(c: str | Column) -> Column:
    """Y gives 1, everything else including NULL gives 0."""
    return flag(col(c) == "Y")


def zero_sum(columns: Sequence[str]) -> Column:
    """Sum in which a missing value counts as zero."""
    return reduce(add, [F.coalesce(F.col(c), F.lit(0.0)) for c in columns])


# --- packed payment history: two characters per month, oldest first -------------


def history_codes(history: str | Column, months: int = 24) -> Column:
    return F.transform(
        F.sequence(F.lit(0), F.lit(months - 1)),
        lambda i: F.substring(col(history), i * 2 + 1, F.lit(2)),
    )


def behind(code: Column) -> Column:
    """True for a two-digit count of months behind other than 00."""
    return code.rlike("^[0-9]{2}$") & (code != "00")


def months_current(codes: Column) -> Column:
    return F.size(F.filter(codes, lambda x: x == "00"))


def months_behind(codes: Column) -> Column:
    return F.size(F.filter(codes, behind))


def worst_month(codes: Column) -> Column:
    return F.array_max(F.transform(codes, lambda x: F.when(x.rlike("^[0-9]{2}$"), x.try_cast("int"))))


def behind_recently(codes: Column, months: int = 3, of: int = 24) -> Column:
    return F.exists(F.slice(codes, of - months + 1, months), behind).cast("int")


# --- reproducible pseudo-random numbers ------------------------------------------


def hash_fraction(key: str | Column, seed: int) -> Column:
    """Uniform number in [0, 1) that depends on the key and the seed only."""
    bits = F.shiftrightunsigned(F.xxhash64(col(key), F.lit(seed)), 11)
    return bits.cast("double") / float(1 << 53)


def modular_fraction(key: str | Column, seed: int) -> Column:
    """Like :func:`hash_fraction` for integer keys, in arithmetic any engine repeats."""
    return F.pmod((F.pmod(col(key), F.lit(1_000_003)) + seed) * 2654435761, F.lit(1_000_000)) / 1e6
