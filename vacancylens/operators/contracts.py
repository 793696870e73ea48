"""Table contracts: coerce columns, then report what breaks the rules."""

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ContractViolation(ValueError):
    """Raised in strict mode when a table breaks its contract."""


@dataclass(frozen=True)
class Rule:
    """What one column has to satisfy."""

    name: str
    dtype: str
    nullable: bool = False
    unique: bool = False
    at_least: float | None = None
    at_most: float | None = None
    coerce: bool = False


@dataclass(frozen=True)
class Contract:
    table: str
    rules: tuple[Rule, ...] = field(default_factory=tuple)


POSTINGS = Contract(
    "postings",
    (
        Rule("id", "string", unique=True),
        Rule("name", "string", nullable=True),
        Rule("posted", "timestamp", nullable=True, coerce=True),
        Rule("title", "string", nullable=True),
        Rule("technology", "string", nullable=True),
        Rule("category", "string", nullable=True),
        Rule("url", "string", nullable=True),
        Rule("remote", "boolean", coerce=True),
    ),
)
SALARIES = Contract(
    "salaries",
    (
        Rule("id", "string", unique=True),
        Rule("contract_type", "string"),
        Rule("salary_min", "double", at_least=0, coerce=True),
        Rule("salary_max", "double", at_least=0, coerce=True),
        Rule("salary_mean", "double", at_least=0, coerce=True),
    ),
)
LOCATIONS = Contract(
    "locations",
    (
        Rule("id", "string"),
        Rule("city", "string"),
        Rule("lat", "double", at_least=-90, at_most=90, coerce=True),
        Rule("lon", "double", at_least=-180, at_most=180, coerce=True),
    ),
)
SENIORITIES = Contract("seniorities", (Rule("id", "string"), Rule("seniority", "string")))


def _coerced(given: Column, have: str, rule: Rule) -> Column:
    """The column in the contract's type; what cannot be converted is NULL."""
    column = _present(given, have, rule.dtype)
    if have == rule.dtype:
        return column
    if rule.dtype == "timestamp" and have in ("bigint", "int"):
        return F.timestamp_millis(column)
    return column.try_cast(rule.dtype)


def _present(column: Column, dtype: str, wanted: str) -> Column:
    """NaN, as a number or as text for one, is missing, as it is in the tables' source."""
    if dtype in ("double", "float"):
        return F.when(~F.isnan(column), column)
    if dtype == "string" and wanted == "double":
        return F.when(~F.coalesce(F.isnan(column.try_cast("double")), F.lit(False)), column)
    return column


def check_schema(have: Mapping[str, str], contract: Contract) -> None:
    """Columns and types; no data is read."""
    absent = [r.name for r in contract.rules if r.name not in have]
    if absent:
        raise ContractViolation(f"{contract.table}: columns are absent: {absent}")
    wrong = [f"{r.name} is {have[r.name]}" for r in contract.rules if not r.coerce and have[r.name] != r.dtype]
    if wrong:
        raise ContractViolation(f"{contract.table}: wrong types: {wrong}")


def row_checks(row: Callable[[str], Column], have: Mapping[str, str], contract: Contract) -> list[tuple[str, str, Column]]:
    """``(column, rule, broken)`` for every rule that one row breaks by itself.

    ``row`` gives a column of the row by its name, so a row may also be an element
    of an array.
    """
    checks: list[tuple[str, str, Column]] = []
    for rule in contract.rules:
        given = _present(row(rule.name), have[rule.name], rule.dtype)
        value = _coerced(row(rule.name), have[rule.name], rule) if rule.coerce else given
        present = given.isNotNull()
        if rule.coerce:
            checks.append((rule.name, "coercible", present & value.isNull()))
        if not rule.nullable:
            checks.append((rule.name, "not_null", ~present))
        if rule.at_least is not None:
            checks.append((rule.name, "at_least", value < rule.at_least))
        if rule.at_most is not None:
            checks.append((rule.name, "at_most", value > rule.at_most))
    return checks


def coerced(df: DataFrame, contract: Contract) -> DataFrame:
    """``df`` in the contract's types, without looking at its rules."""
    have = dict(df.dtypes)
    check_schema(have, contract)
    changed = {r.name: _coerced(F.col(r.name), have[r.name], r) for r in contract.rules if r.coerce}
    return df.withColumns(changed) if changed else df


def violation_rows(counted: DataFrame, counts: Mapping[tuple[str, str, str], Column]) -> DataFrame:
    """``(table_name, column_name, rule, n)`` with ``n > 0`` from one row of counts."""
    cells = [
        F.struct(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), F.lit(rule).alias("rule"), n.alias("n"))
        for (table, column, rule), n in counts.items()
    ]
    return counted.select(F.inline(F.array(*cells))).where("n > 0")


def validate(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """``(coerced table, violations)``; columns the contract does not name pass through.

    ``violations`` has ``(table_name, column_name, rule, n)`` with ``n > 0``.
    All row rules are counted in one aggregate pass. Uniqueness is one
    aggregation by the key, combined before its shuffle.
    """
    table = coerced(df, contract)
    checks = row_checks(F.col, dict(df.dtypes), contract)
    counted = df.agg(*[F.count_if(broken).alias(f"c{i}") for i, (_, _, broken) in enumerate(checks)])
    parts = [violation_rows(counted, {(contract.table, c, rule): F.col(f"c{i}") for i, (c, rule, _) in enumerate(checks)})]
    for rule in contract.rules:
        if rule.unique:
            # Every row of a repeated key breaks the rule.
            repeated = df.where(F.col(rule.name).isNotNull()).groupBy(rule.name).agg(F.count(F.lit(1)).alias("_n"))
            rows = repeated.agg(F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("n"))
            parts.append(violation_rows(rows, {(contract.table, rule.name, "unique"): F.col("n")}))
    return table, reduce(DataFrame.unionByName, parts)


def raise_violations(violations: DataFrame) -> None:
    """Run the checks; the driver sees at most one row per rule."""
    raise_counts({(r.table_name, r.column_name, r.rule): r.n for r in violations.collect()})


def raise_counts(counts: Mapping[tuple[str, str, str], int]) -> None:
    """Fail if any ``(table, column, rule)`` was broken."""
    told = ", ".join(f"{table}.{column} {rule} ({n} rows)" for (table, column, rule), n in counts.items() if n)
    if told:
        raise ContractViolation(told)


def require(df: DataFrame, contract: Contract) -> DataFrame:
    """Strict mode: the coerced table, or :class:`ContractViolation`."""
    table, violations = validate(df, contract)
    raise_violations(violations)
    return table


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Raise when a table is empty; reads at most one row."""
    if df.isEmpty():
        raise RuntimeError(f"{what} is empty")
    return df
