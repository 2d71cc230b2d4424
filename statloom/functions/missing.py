"""Missing values: declared ones (SPSS) as predicates, tagged ones (Stata) as ``struct<value, tag>``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from ..metadata import Missingness, Value


#: The forms of a declaration: keys that must be there, and how many single values it may have.
_FORMS = [({"values"}, 3), ({"lo", "hi"}, 1)]


def parts(missing: Missingness | None, name: str) -> tuple[list[Value], tuple[Value, Value] | None]:
    """The single values and the range that ``name`` declares missing; ValueError if it has neither form."""
    if not missing:
        return [], None
    single = [*missing.get("values", ()), *(v for v in (missing.get("value"),) if v is not None)]
    span = (missing["lo"], missing["hi"]) if {"lo", "hi"} <= missing.keys() else None
    most = next((n for keys, n in _FORMS if keys <= missing.keys()), None)
    if most is None:
        raise ValueError(f"{name!r}: missing values are declared by the keys {sorted(missing)}, not by 'values', nor by 'lo' and 'hi'")
    if len(single) > most:
        raise ValueError(f"{name!r} declares {len(single)} missing values; {'three is' if most == 3 else 'one beside a range is'} the most")
    return single, span


def is_missing(value: Column, missing: Missingness | None, name: str = "") -> Column:
    """Whether a value is declared missing: never null, false for nulls and NaN; range ends belong to the range."""
    single, span = parts(missing, name)
    found = value.isin(*single) if single else F.lit(False)
    if span:
        lo, hi = map(F.lit, span)
        found |= (value >= lo) & (value <= hi)
    numeric = not any(isinstance(v, str) for v in [*single, *(span or ())])
    return F.coalesce(found & ~F.isnan(value) if numeric else found, F.lit(False))


def mask(value: Column, missing: Missingness | None, name: str = "") -> Column:
    """``value`` with declared-missing values as null."""
    return F.when(~is_missing(value, missing, name), value) if missing else value


def is_tagged(kind: T.DataType) -> bool:
    return isinstance(kind, T.StructType) and kind.fieldNames() == ["value", "tag"]


def wrap(value: Column, tag: Column) -> Column:
    """``struct<value, tag>``, null where both are."""
    return F.when(value.isNotNull() | tag.isNotNull(), F.struct(value.alias("value"), tag.alias("tag")))


def tag_code(cell: Column, name: str) -> Column:
    """1 to 26 for the tags a to z, null without one; an error for any other tag, or for a tag beside a value."""
    value, tag = cell["value"], cell["tag"]
    return (
        F.when(value.isNotNull() & tag.isNotNull(), F.raise_error(F.lit(f"column {name!r}: a tagged cell has a value, too")))
        .when(~tag.rlike("^[a-z]$"), F.raise_error(F.lit(f"column {name!r}: a tag is not one of the letters a to z")))
        .otherwise(F.ascii(tag) - 96)
        .cast("tinyint")
    )


def letter(code: Column) -> Column:
    """The tag of a code from 1 to 26; null for none."""
    return F.when(code > 0, F.char(code + 96))
