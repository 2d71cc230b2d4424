"""Arrow batches as the stored values of a plan, for tasks that have no DataFrame to encode."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import types as T

from ..errors import StatError
from ..formats import STATA_RANGES, Family
from ..functions import missing as M
from ..functions.temporal import DAY
from .write_plan import STORED, ColumnPlan, Measured, WritePlan

_ARROW = {"byte": pa.int8(), "int": pa.int16(), "long": pa.int32(), "float": pa.float32(), "double": pa.float64()}
#: The least and largest value of Spark's integer types.
_BOUNDS = {kind: (-(1 << bits - 1), (1 << bits - 1) - 1) for kind, bits in ((T.ByteType(), 8), (T.ShortType(), 16), (T.IntegerType(), 32), (T.LongType(), 64))}


def by_type(schema: T.StructType) -> Measured:
    """Ranges of integers as wide as their types, so that files written apart from each other store them alike."""
    inner = lambda kind: kind["value"].dataType if M.is_tagged(kind) else kind
    return Measured(ranges={f.name: _BOUNDS[inner(f.dataType)] for f in schema.fields if inner(f.dataType) in _BOUNDS})


def _micros(value: pa.Array, p: ColumnPlan, family: Family) -> pa.Array:
    """What ``temporal.to_raw`` gives: days, or units since the family's epoch."""
    if p.temporal == "date":
        days = pc.add(value.cast(pa.int32()).cast(pa.int64()), family.epoch_days)
        return days if family.key == "dta" else pc.multiply(days.cast(pa.float64()), 86400.0)
    micros = value.cast(pa.int64())
    if p.temporal == "datetime":
        micros = pc.add(micros, family.epoch_days * DAY)
    return pc.divide(micros.cast(pa.float64(), safe=False), float(family.unit))


def _refuse(value: pa.Array, outside: pa.Array, told: str) -> None:
    found = value.filter(pc.fill_null(outside, False))
    if len(found):
        raise StatError(told.format(found[0].as_py()))


def _value(value: pa.Array, p: ColumnPlan, family: Family) -> pa.Array:
    if p.stored == "string":
        return pc.fill_null(value.cast(pa.string()), "")
    if p.temporal:
        value = _micros(value, p, family)
    if pa.types.is_boolean(value.type):
        value = value.cast(pa.int8())
    if pa.types.is_integer(value.type):
        lo, hi = STATA_RANGES[STORED[p.stored]] if family.key == "dta" and STORED[p.stored] in STATA_RANGES else (-(1 << 53), 1 << 53)
        wide = value.cast(pa.int64())
        _refuse(wide, pc.or_(pc.less(wide, lo), pc.greater(wide, hi)), f"column {p.source!r}: {{}} can't be stored exactly as {p.stored}")
    return value.cast(_ARROW[p.stored])


def _tags(cell: pa.Array, p: ColumnPlan) -> pa.Array:
    tag = cell.field("tag")
    code = pc.index_in(tag, pa.array([chr(c) for c in range(ord("a"), ord("z") + 1)]))
    _refuse(tag, pc.and_(pc.is_valid(tag), pc.is_null(code)), f"column {p.source!r}: {{!r}} is no tag, which are a to z")
    _refuse(tag, pc.and_(pc.is_valid(tag), pc.is_valid(cell.field("value"))), f"column {p.source!r}: the tag {{!r}} stands beside a value")
    return pc.add(code, 1).cast(pa.int8())


def stored(batch: pa.RecordBatch, plan: WritePlan) -> pa.RecordBatch:
    """The batch that ``WritePlan.encode`` would give for the same rows."""
    arrays, names = [], []
    for p, cell in zip(plan.columns, batch.columns, strict=True):
        if p.tagged:
            cell = pa.StructArray.from_arrays(cell.flatten(), fields=list(cell.type))  # a null struct has null fields
        arrays.append(_value(cell.field("value") if p.tagged else cell, p, plan.family))
        names.append(f"v{p.name}")
        if p.tagged:
            arrays.append(_tags(cell, p))
            names.append(f"t{p.name}")
    return pa.RecordBatch.from_arrays(arrays, names=names)
