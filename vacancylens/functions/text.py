"""Column expressions for names: all run inside the JVM."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacancylens.fixed_values import MISSING_TEXTS

# Letters that have a case; every other character ends a word in title case.
_CASED = r"\p{IsUppercase}\p{IsLowercase}\p{Lt}"
# Private-use characters, which text does not contain.
_WORD_MARK = "\ue000\uf8ff\ue000"


def split_before_capitals(text: Column) -> Column:
    """``businessAnalyst`` to ``business Analyst``; matches do not overlap."""
    return F.regexp_replace(text, r"([\p{L}\p{N}_])([A-Z])", "$1 $2")


def title_case(text: Column) -> Column:
    """Capitalise every run of cased letters: ``ux/ui`` to ``Ux/Ui``.

    ``initcap`` only starts a word after a space, so one is put, with a mark to
    find it again, wherever a cased letter follows anything else.
    """
    spaced = F.regexp_replace(text, f"([^{_CASED}])(?=[{_CASED}])", f"$1{_WORD_MARK} ")
    return F.replace(F.initcap(spaced), F.lit(f"{_WORD_MARK} "), F.lit(""))


def capitalize(text: Column, special: dict[str, str] | None = None) -> Column:
    """First letter upper, rest lower, unless the whole text is a special name."""
    plain = F.concat(F.initcap(F.substr(text, F.lit(1), F.lit(1))), F.lower(F.substr(text, F.lit(2))))
    if not special:
        return plain
    known = F.create_map(*[F.lit(part) for pair in special.items() for part in pair])
    return F.coalesce(known[text], plain)


def keyword(text: Column) -> Column:
    """Lower-case keyword without surrounding white space (any kind of it)."""
    return F.regexp_replace(F.lower(text), r"(?U)^[\s\x{1C}-\x{1F}]+|[\s\x{1C}-\x{1F}]+$", "")


def yes_no(flag: Column) -> Column:
    return F.when(flag, "Yes").when(~flag, "No")


def address_city_country(address: Column) -> tuple[Column, Column]:
    """First and last comma-separated part of an address, trimmed."""
    parts = F.split(address, ",")
    return F.trim(F.element_at(parts, 1)), F.trim(F.element_at(parts, -1))


def place_key(name: Column) -> Column:
    """The form under which place names are looked up."""
    return F.lower(F.trim(name))


def string_columns(df: DataFrame) -> list[str]:
    return [field.name for field in df.schema if isinstance(field.dataType, T.StringType)]


def replace_values(df: DataFrame, values: dict[str, str], subset: list[str] | None = None) -> DataFrame:
    """Replace whole cells in one pass, on every string column by default."""
    return df.replace(values, subset=subset or string_columns(df))


def unify_missing(df: DataFrame) -> DataFrame:
    """Turn the texts that mean "nothing" and floating NaN into NULL."""
    fixed = {}
    for field in df.schema:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            fixed[field.name] = F.when(~value.isin(MISSING_TEXTS), value)
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            fixed[field.name] = F.when(~F.isnan(value), value)
    return df.withColumns(fixed)
