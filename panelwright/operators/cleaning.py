"""Raw text panel -> typed, cleaned panel. Map-only: no step shuffles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions import columns as c
from panelwright.spec import DATE, FLOAT, INT, SPARK_TYPES, CleanRules


def _replace(df: DataFrame, new: Mapping[str, str]) -> DataFrame:
    """One projection that swaps some columns for SQL expressions and keeps the order."""
    return df.selectExpr(*[f"{new[n]} AS `{n}`" if n in new else f"`{n}`" for n in df.columns])


def _quoted(values: Sequence[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.drop(*names)


def rename_positional(df: DataFrame, positions: Mapping[int, str]) -> DataFrame:
    """Pick unnamed columns by their position (from 0) and name them."""
    return df.select(*[F.col(df.columns[i]).alias(n) for i, n in positions.items()])


def trim_blanks(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return _replace(df, {n: f"nullif(trim(`{n}`), '')" for n in (columns or df.columns)})


def null_sentinels(df: DataFrame, sentinels: Mapping[str, Sequence[str]]) -> DataFrame:
    return _replace(
        df, {n: f"if(`{n}` IN ({_quoted(x)}), NULL, `{n}`)" for n, x in sentinels.items()}
    )


def recode_columns(df: DataFrame, recodes: Mapping[str, Mapping[str, str]]) -> DataFrame:
    def case(n: str) -> str:
        whens = " ".join(f"WHEN '{old}' THEN '{new}'" for old, new in recodes[n].items())
        return f"CASE `{n}` {whens} ELSE `{n}` END"

    return _replace(df, {n: case(n) for n in recodes})


def typed(name: str, kind: str, date_format: str) -> str:
    """SQL for the typed value; text that does not parse gives NULL.

    A month without separators is put together from its digits, which costs far
    less per row than a date formatter.
    """
    if kind == DATE and date_format == "MMyyyy":
        parts = f"int(substr(`{name}`, 3, 4)), int(substr(`{name}`, 1, 2)), 1"
        return f"if(`{name}` rlike '{c.MONTH_PATTERN}', make_date({parts}), NULL)"
    if kind == DATE:
        return f"try_to_date(`{name}`, '{date_format}')"
    if kind == FLOAT:
        return f"try_cast(`{name}` AS double)"
    if kind == INT:
        return (
            f"coalesce(try_cast(`{name}` AS int), try_cast(try_cast(`{name}` AS double) AS int))"
        )
    return f"`{name}`"


def cast_columns(df: DataFrame, kinds: Mapping[str, str], date_format: str = "MMyyyy") -> DataFrame:
    present = {n: k for n, k in kinds.items() if n in df.columns}
    return _replace(df, {n: typed(n, k, date_format) for n, k in present.items()})


def null_out_of_range(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    return _replace(
        df, {n: f"if(`{n}` BETWEEN {lo} AND {hi}, `{n}`, NULL)" for n, (lo, hi) in bounds.items()}
    )


def clean_text(df: DataFrame, rules: CleanRules) -> DataFrame:
    """Drop unused columns, trim, blank to NULL, sentinels to NULL, recode; still text."""
    kept = df.select(*rules.kept)
    return recode_columns(null_sentinels(trim_blanks(kept), rules.sentinels), rules.recodes)


def clean(df: DataFrame, rules: CleanRules) -> DataFrame:
    text = clean_text(df, rules)
    return null_out_of_range(cast_columns(text, rules.kinds, rules.date_format), rules.bounds)


def schema_problems(df: DataFrame, rules: CleanRules) -> list[tuple[str, str]]:
    """(column, problem) pairs found in the metadata alone."""
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {n: SPARK_TYPES[k] for n, k in rules.kinds.items()}
    problems = [(n, "missing") for n in want if n not in have]
    problems += [(n, "extra") for n in have if n not in want]
    problems += [
        (n, f"expected {t.simpleString()}, found {have[n].simpleString()}")
        for n, t in want.items()
        if n in have and have[n] != t
    ]
    return problems


def enforce(df: DataFrame, rules: CleanRules) -> DataFrame:
    problems = schema_problems(df, rules)
    if problems:
        raise ValueError(f"schema does not follow the rules: {problems}")
    return df.select(*rules.kept)


def complete_cases(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))


def plausible(
    df: DataFrame,
    between: Mapping[str, tuple[float, float]],
    above: Mapping[str, float] | None = None,
) -> DataFrame:
    """Rows whose values lie in all inclusive ranges and above all minimums."""
    for name, (low, high) in between.items():
        df = df.where(F.col(name).between(low, high))
    for name, low in (above or {}).items():
        df = df.where(F.col(name) > low)
    return df


def blank_or_zero(name: str) -> Column:
    return c.is_blank(name) | F.trim(F.col(name)).isin("0", "0.00")


def preview(df: DataFrame, column: str, value: object, columns: Sequence[str], rows: int) -> DataFrame:
    """A few columns of a few rows of one partition; the filter prunes directories."""
    return df.where(F.col(column) == value).select(*columns).orderBy(*columns).limit(rows)


def contract(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)
