"""One-pass profiles of numeric columns and lossless narrowing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.missing import mask
from ..metadata import Missingness

_INTEGERS: list[tuple[str, int]] = [("tinyint", 7), ("smallint", 15), ("int", 31), ("bigint", 63)]


@dataclass(frozen=True)
class Profile:
    """Range and nature of a column's values that are not null; infinities and NaN are outside of the range."""

    low: float | None
    high: float | None
    integral: bool
    float32_exact: bool

    def narrow_type(self) -> str:
        """The smallest type that keeps all values: integers by range, else float if exact, else double."""
        if self.integral and self.low is None:
            return "tinyint"
        fits = [t for t, bits in _INTEGERS if self.integral and -(1 << bits) <= self.low and self.high < 1 << bits]
        return fits[0] if fits else "float" if self.float32_exact else "double"


def profile_columns(value: Column, name: str) -> list[Column]:
    """The four aggregates of a column, named ``name_min, name_max, name_integral, name_float32``."""
    x = value.cast("double")
    finite = F.abs(x) < float("inf")
    # rint, not floor: floor to bigint would stop at 2^63
    return [
        F.min(F.when(finite, x)).alias(f"{name}_min"),
        F.max(F.when(finite, x)).alias(f"{name}_max"),
        F.coalesce(F.bool_and(finite & (F.rint(x) == x)), F.lit(True)).alias(f"{name}_integral"),
        F.coalesce(F.bool_and(~finite | (x.cast("float").cast("double") == x)), F.lit(True)).alias(f"{name}_float32"),
    ]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and not isinstance(f.dataType, T.DecimalType)]


def profile(df: DataFrame, columns: Sequence[str] | None = None, missing: Mapping[str, Missingness | None] | None = None) -> dict[str, Profile]:
    """Profiles of numeric columns (all, unless named) by one aggregation; declared-missing values don't count."""
    names = list(columns) if columns is not None else numeric_columns(df)
    if not names:
        return {}
    exprs = [e.alias(f"c{i}_{k}") for i, n in enumerate(names) for k, e in enumerate(profile_columns(mask(df[n], (missing or {}).get(n), n), n))]
    row = df.agg(*exprs).first()
    return {n: Profile(*(row[f"c{i}_{k}"] for k in range(4))) for i, n in enumerate(names)}


#: Types that a column can be read as.
READABLE = ("string", *(t for t, _ in _INTEGERS), "float", "double")


def readable_as(kind: T.DataType, to: str, name: str = "") -> str:
    """``to``, if a stored column of this type can be read as it; texts stay texts and numbers numbers."""
    if to not in READABLE:
        raise ValueError(f"column {name!r}: no column is read as {to!r}, but as one of {', '.join(READABLE)}")
    if (to == "string") != isinstance(kind, T.StringType):
        raise ValueError(f"column {name!r} is stored as {kind.simpleString()}, which is not read as {to}")
    return to


def checked_cast(value: Column, to: str, name: str = "") -> Column:
    """A cast that raises an error where it would lose anything: fractions, range, or overflow to infinity."""
    if to == "string":
        return value
    if to not in READABLE:
        raise ValueError(f"column {name!r}: no column is read as {to!r}, but as one of {', '.join(READABLE)}")
    if to == "double":
        return value.cast(to)
    x = value.cast("double")
    if to == "float":
        lost = (F.abs(x) < float("inf")) & (F.abs(x.cast("float").cast("double")) == float("inf"))
    else:
        bits = dict(_INTEGERS)[to]
        lost = ~((F.rint(x) == x) & (x >= -float(1 << bits)) & (x < float(1 << bits)))
    return F.when(lost, F.raise_error(F.format_string(f"column {name!r}: %s does not fit {to}", x.cast("string")))).otherwise(value).cast(to)


def narrow(df: DataFrame, columns: Sequence[str] | None = None, missing: Mapping[str, Missingness | None] | None = None) -> DataFrame:
    """``df`` with numeric columns in the smallest types that keep their values, declared-missing ones as null."""
    found = profile(df, columns, missing)
    masked = {n: mask(df[n], (missing or {}).get(n), n) for n in found}
    return df.select(*(checked_cast(masked[n], found[n].narrow_type(), n).alias(n) if n in found else df[n] for n in df.columns))
