"""Relational warehouse tables from cleaned postings."""

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from vacancylens import fixed_values as fixed
from vacancylens.operators import contracts
from vacancylens.operators.filters import explode_list


def postings_table(documents: DataFrame) -> DataFrame:
    return documents.select(*fixed.POSTINGS_COLUMNS)


def salaries_table(documents: DataFrame) -> DataFrame:
    return documents.select(*fixed.SALARIES_COLUMNS)


def exploded_cities(documents: DataFrame) -> DataFrame:
    """One row per posting and place, with ``city, lat, lon`` as columns.

    Postings without places have no such row.
    """
    others = [c for c in documents.columns if c != "city"]
    return documents.select(*others, F.inline("city"))


def locations_table(documents: DataFrame) -> DataFrame:
    return exploded_cities(documents.select("id", "city")).dropna().select(*fixed.LOCATIONS_COLUMNS)


def seniorities_table(documents: DataFrame) -> DataFrame:
    """One row per posting and level; a posting without levels has one, NULL."""
    return explode_list(documents.select(*fixed.SENIORITIES_COLUMNS), "seniority")


TABLES = {
    "postings": (postings_table, contracts.POSTINGS),
    "salaries": (salaries_table, contracts.SALARIES),
    "locations": (locations_table, contracts.LOCATIONS),
    "seniorities": (seniorities_table, contracts.SENIORITIES),
}


def _location_rows() -> Column:
    """A document's rows of ``locations`` as an array: its places without anything missing."""
    place = F.transform("city", lambda c: F.struct(F.col("id"), c["city"].alias("city"), c["lat"].alias("lat"), c["lon"].alias("lon")))

    def whole(p: Column) -> Column:
        numbers = ~F.coalesce(F.isnan(p["lat"].try_cast("double")), F.lit(True)) & ~F.coalesce(F.isnan(p["lon"].try_cast("double")), F.lit(True))
        return p["id"].isNotNull() & p["city"].isNotNull() & p["lat"].isNotNull() & p["lon"].isNotNull() & numbers

    return F.filter(place, whole)


def _seniority_rows() -> Column:
    """A document's rows of ``seniorities`` as an array; without levels it is one row, NULL."""
    levels = F.when(F.size("seniority") > 0, F.col("seniority")).otherwise(F.array(F.lit(None)))
    return F.transform(levels, lambda s: F.struct(F.col("id"), s.alias("seniority")))


#: Tables with rows of their own for the elements of an array.
_NESTED = {"locations": _location_rows, "seniorities": _seniority_rows}


def rule_counts(documents: DataFrame) -> dict[tuple[str, str, str], Column]:
    """Aggregates over documents that count what breaks each row rule of the four tables.

    Rules on elements of arrays are counted inside the document, so nothing is
    exploded and one pass over the documents serves all tables.
    """
    counts: dict[tuple[str, str, str], Column] = {}
    for table, (build, contract) in TABLES.items():
        have = dict(build(documents).dtypes)
        contracts.check_schema(have, contract)
        if table not in _NESTED:
            for column, rule, broken in contracts.row_checks(F.col, have, contract):
                counts[table, column, rule] = F.count_if(broken)
            continue
        rows = _NESTED[table]()
        names = [(column, rule) for column, rule, _ in contracts.row_checks(F.col, have, contract)]
        for place, (column, rule) in enumerate(names):
            counts[table, column, rule] = F.coalesce(F.sum(F.coalesce(_n_breaking(rows, have, contract, place), F.lit(0))), F.lit(0))
    return counts


def _n_breaking(rows: Column, have: dict[str, str], contract: contracts.Contract, place: int) -> Column:
    """How many elements of an array of rows break the contract's rule at some place."""

    def breaks(row: Column) -> Column:
        return F.coalesce(contracts.row_checks(row.getField, have, contract)[place][2], F.lit(False))

    return F.size(F.filter(rows, breaks))


_UNIQUE = [(table, rule.name, "unique") for table, (_, contract) in TABLES.items() for rule in contract.rules if rule.unique]


def _repeated(n: str) -> Column:
    """Rows of repeated ids, from their counts."""
    return F.coalesce(F.sum(F.when(F.col("id").isNotNull() & (F.col(n) > 1), F.col(n))), F.lit(0))


def all_violations(documents: DataFrame) -> DataFrame:
    """What breaks the contracts, over all four tables: one scan and one exchange by id.

    Row rules are counted along with the ids whose uniqueness is asked, combined
    before they are shuffled.
    """
    counts = rule_counts(documents)
    named = {f"c{i}": count for i, count in enumerate(counts.values())}
    by_id = documents.groupBy("id").agg(F.count(F.lit(1)).alias("_n"), *[c.alias(n) for n, c in named.items()])
    whole = by_id.agg(_repeated("_n").alias("_unique"), *[F.sum(n).alias(n) for n in named])
    found = {where: F.col(n) for where, n in zip(counts, named, strict=True)}
    return contracts.violation_rows(whole, found | {where: F.col("_unique") for where in _UNIQUE})


class ObservedContracts:
    """The row rules, counted while documents are written.

    Write :attr:`documents` and call :meth:`require` with what was written: no
    further pass looks at the row rules, and one narrow pass over the ids at
    uniqueness.
    """

    def __init__(self, documents: DataFrame) -> None:
        self._counts = rule_counts(documents)
        self._seen = Observation("contracts")
        self.documents = documents.observe(self._seen, *[c.alias(f"c{i}") for i, c in enumerate(self._counts.values())])

    def require(self, written: DataFrame) -> None:
        seen = self._seen.get
        found = {where: seen[f"c{i}"] for i, where in enumerate(self._counts)}
        ids = written.groupBy("id").agg(F.count(F.lit(1)).alias("_n"))
        repeated = ids.agg(_repeated("_n").alias("n")).first().n
        contracts.raise_counts(found | dict.fromkeys(_UNIQUE, repeated))


def warehouse_tables(documents: DataFrame, strict: bool = True) -> dict[str, DataFrame]:
    """The four tables in their contract's types; strict mode checks them first, in one job."""
    if strict:
        contracts.raise_violations(all_violations(documents))
    return {name: contracts.coerced(build(documents), contract) for name, (build, contract) in TABLES.items()}
