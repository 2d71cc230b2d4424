"""How a DataFrame becomes the variables of a file: types, formats, widths, labels and names, checked before a byte is written."""

from __future__ import annotations

import math
import warnings
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..errors import StatWarning
from ..formats import STATA_RANGES, Family, Kind, Limit, TextLimitPolicy
from ..functions import missing as M, temporal, text
from ..metadata import Code, Metadata, Value

STORED = {"byte": "tinyint", "int": "smallint", "long": "int", "float": "float", "double": "double", "string": "string"}
_STATA = {T.ByteType(): "byte", T.BooleanType(): "byte", T.ShortType(): "int", T.IntegerType(): "long", T.FloatType(): "float"}
_TEMPORAL = {"sav": {}, "dta": {"date": "long"}}


@dataclass
class Measured:
    """What one pass over the data tells the planner."""

    rows: int = 0
    widths: dict[str, int] = field(default_factory=dict)
    ranges: dict[str, tuple[int, int]] = field(default_factory=dict)


@dataclass(frozen=True)
class Label:
    """A code and its text; ``group`` is what the code is: text, tag, whole, fraction or far (beyond Stata's integers)."""

    code: Value
    text: str
    group: str


@dataclass
class LabelSet:
    name: str
    members: list[Label] = field(default_factory=list)

    @property
    def labels(self) -> list[tuple[Value, str]]:
        return [(x.code, x.text) for x in self.members if x.group != "tag"]

    @property
    def tags(self) -> list[tuple[str, str]]:
        return [(x.code, x.text) for x in self.members if x.group == "tag"]


@dataclass
class ColumnPlan:
    """One variable of the file."""

    source: str
    name: str
    stored: str
    width: int
    display: str | None
    temporal: Kind | None
    tagged: bool
    label: str | None
    measure: str
    alignment: str
    display_width: int
    discrete: list[Value]
    span: tuple[Value, Value] | None
    label_set: str | None = None
    cut: bool = False

    def columns(self, df: DataFrame, family: Family) -> list[Column]:
        """The stored value, named by the variable, and for tagged columns the tag's code beside it."""
        cell = df[_quoted(self.source)]
        value = cell["value"] if self.tagged else cell
        if self.temporal:
            value = temporal.to_raw(value, family, self.temporal)
        if self.stored == "string":
            value = F.coalesce(text.cut_utf8(value, self.width) if self.cut else value, F.lit(""))
        elif self.stored == "double":
            big = F.abs(value.cast("decimal(38,0)")) > (1 << 53) if isinstance(_value_type(df.schema[self.source].dataType), T.LongType) else None
            value = value.cast("double") if big is None else F.when(big, F.raise_error(F.lit(f"column {self.source!r}: an integer beyond 2**53 is not exact as a double"))).otherwise(value).cast("double")
        elif family.key == "dta" and STORED[self.stored] in STATA_RANGES:
            lo, hi = STATA_RANGES[STORED[self.stored]]
            whole = value.cast("bigint")
            value = F.when((whole < lo) | (whole > hi), F.raise_error(F.format_string(f"column {self.source!r}: %s is outside of Stata's {self.stored}", whole.cast("string")))).otherwise(whole).cast(STORED[self.stored])
        else:
            value = value.cast(STORED[self.stored])
        out = [value.alias(f"v{self.name}")]
        if self.tagged:
            out.append(M.tag_code(cell, self.source).alias(f"t{self.name}"))
        return out


@dataclass
class WritePlan:
    family: Family
    columns: list[ColumnPlan]
    label_sets: list[LabelSet]
    file_label: str | None
    notes: list[str]
    renamed: dict[str, str]
    rows: int

    def encode(self, df: DataFrame) -> DataFrame:
        """Stored values in the order of the plan."""
        return df.select(*(c for p in self.columns for c in p.columns(df, self.family)))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _value_type(kind: T.DataType) -> T.DataType:
    return kind["value"].dataType if M.is_tagged(kind) else kind


def _whole(kind: T.DataType) -> bool:
    return isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def measure(df: DataFrame) -> Measured:
    """Rows, byte widths of strings and ranges of integers (also inside tagged columns) by one aggregation."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    integers = [f.name for f in df.schema.fields if _whole(_value_type(f.dataType))]
    cell = lambda n: df[_quoted(n)]["value"] if M.is_tagged(df.schema[n].dataType) else df[_quoted(n)]
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        *(text.width(cell(n)).alias(f"w{i}") for i, n in enumerate(strings)),
        *(f(cell(n)).alias(f"{k}{i}") for i, n in enumerate(integers) for k, f in (("lo", F.min), ("hi", F.max))),
    ).first()
    ranges = {n: (row[f"lo{i}"], row[f"hi{i}"]) for i, n in enumerate(integers) if row[f"lo{i}"] is not None}
    return Measured(row["n"], {n: row[f"w{i}"] for i, n in enumerate(strings)}, ranges)


def stata_type(kind: T.DataType, lo: int, hi: int) -> str | None:
    """What a Stata column of this integer type needs for values from ``lo`` to ``hi``; None if it has none of its own."""
    order = ["byte", "int", "long"]
    own = _STATA.get(kind)
    if own not in order or isinstance(kind, T.BooleanType):
        return None
    wide = [s for s in order[order.index(own) :] if STATA_RANGES[STORED[s]][0] <= lo and hi <= STATA_RANGES[STORED[s]][1]]
    return wide[0] if wide else "double"


class _Shape(NamedTuple):
    """How a column's values are stored and shown."""

    stored: str
    width: int = 8
    display: str | None = None
    temporal: Kind | None = None


def _shape(name: str, kind: T.DataType, metadata: Metadata, family: Family, measured: Measured) -> _Shape | None:
    """None for types that no variable of the family can hold."""
    display = next((x for x in [metadata.formats.get(name)] if x and family.is_native(x)), None)
    shown = temporal.classify(family, display)
    # times come as microseconds of the day where the session has no type for them
    when = "time" if shown == "time" and isinstance(kind, T.LongType) else temporal.kind_of(kind)
    if when:
        return _Shape(_TEMPORAL[family.key].get(when, "double"), 8, display if shown == when else family.default_formats[when], when)
    if isinstance(kind, T.StringType):
        known = (x for x in (measured.widths.get(name), metadata.storage_widths.get(name), family.default_width) if x)
        return _Shape("string", max(1, next(known)), display)
    real = isinstance(kind, (T.FloatType, T.DoubleType))
    if not (real or _whole(kind) or isinstance(kind, (T.NullType, T.BooleanType))):
        return None
    if family.key == "sav":
        return _Shape("double", 8, display if display or real else f"F{metadata.display_widths.get(name) or 8}.0")
    needed = stata_type(kind, *measured.ranges[name]) if name in measured.ranges else None
    return _Shape(needed or _STATA.get(kind, "double"), 8, display)


class _Draft(NamedTuple):
    """A column with all that is declared of it, before it is known to fit."""

    name: str
    kind: T.DataType
    tagged: bool
    shape: _Shape | None
    declared: list[Value]
    family: Family

    @property
    def text(self) -> bool:
        return isinstance(self.kind, T.StringType)


#: What no column may be: a condition, and how it is told.
_REFUSED: list[tuple[Callable[[_Draft], bool], str]] = [
    (lambda d: d.shape is None, "no {family.key} variable can hold {type}"),
    (lambda d: d.tagged and not d.family.tagged_missing, "it has tags of missing values, for which {family.title} files have no place"),
    (lambda d: d.tagged and d.text, "it holds text, which can't be tagged missing"),
    (lambda d: bool(d.declared) and not d.family.user_missing, "it declares missing values, which {family.title} files do not know"),
    (lambda d: d.text and any(not isinstance(v, str) for v in d.declared), "it holds text, but declares a number missing"),
    (lambda d: not d.text and any(isinstance(v, str) for v in d.declared), "it holds numbers, but declares a text missing"),
]


def _column(f: T.StructField, metadata: Metadata, family: Family, measured: Measured, policy: TextLimitPolicy) -> ColumnPlan:
    name, kind = f.name, _value_type(f.dataType)
    discrete, span = M.parts(metadata.missing_values.get(name), name)
    draft = _Draft(name, kind, M.is_tagged(f.dataType), _shape(name, kind, metadata, family, measured), [*discrete, *(span or ())], family)
    problems = [told.format(family=family, type=kind.simpleString()) for refused, told in _REFUSED if refused(draft)]
    if problems:
        raise (TypeError if draft.shape is None else ValueError)(f"column {name!r}: {'; '.join(problems)}")
    shape = draft.shape
    if shape.stored == "string":
        shape = shape._replace(width=family.at_most(shape.width, "string value", f"column {name!r}", policy))
        discrete = [family.fit(v, "missing value", f"column {name!r}", policy) for v in discrete]
        if span:
            span = tuple(family.fit(v, "missing value", f"column {name!r}", policy) for v in span)
    of = {k: getattr(metadata, k).get(name) for k in ("variable_labels", "measures", "alignments", "display_widths")}
    return ColumnPlan(
        source=name,
        name=name,
        **shape._asdict(),
        tagged=draft.tagged,
        label=family.fit(of["variable_labels"], "variable label", name, policy),
        measure=of["measures"] or "unknown",
        alignment=of["alignments"] or "unknown",
        display_width=of["display_widths"] or 0,
        discrete=discrete,
        span=span,
        cut=policy == "truncate",
    )


def _group(code: Value, family: Family) -> str:
    if isinstance(code, str):
        return "tag" if family.key == "dta" and len(code) == 1 and "a" <= code <= "z" else "text"
    if math.isfinite(code) and code == int(code):
        lo, hi = STATA_RANGES["int"]
        return "whole" if family.key == "sav" or lo <= code <= hi else "far"
    return "fraction"


#: Groups of codes that a set of labels may have together.
_TOGETHER = {"sav": [{"text"}, {"whole", "fraction"}], "dta": [{"whole", "tag"}]}
_WHY = {
    "text": "a text such as {code!r} can't have a label in Stata, only integers and the tags a to z",
    "fraction": "{code!r} is labelled, but is no integer",
    "far": "{code!r} is labelled, but outside of Stata's integers",
}


def label_set(name: str, codes: list[Code], family: Family, policy: TextLimitPolicy, width: int | None = None) -> LabelSet:
    """The labels of a variable as the family stores them; ``width`` is that of a text variable."""
    found = LabelSet(name)
    for c in codes:
        code, group = c["value"], _group(c["value"], family)
        if group == "text" and width is not None and family.key == "sav":
            # shorter variables still have a cell of eight bytes
            code = family.fit_to(code, Limit(max(8, width)), "labelled value", f"variable {name!r}", policy)
        code = int(code) if group == "whole" and family.key == "dta" else code
        found.members.append(Label(code, family.fit(c["label"], "value label", f"variable {name!r}", policy) or "", group))
    groups = {x.group for x in found.members}
    if not any(groups <= allowed for allowed in _TOGETHER[family.key]):
        wrong = next((x for x in found.members if x.group in _WHY and not any(x.group in allowed for allowed in _TOGETHER[family.key])), None)
        raise ValueError(f"{name!r}: {_WHY[wrong.group].format(code=wrong.code)}" if wrong else f"{name!r} labels both texts and numbers")
    counts = Counter(x.code for x in found.members)  # 1 and 1.0 are one code
    if twice := next((code for code, n in counts.items() if n > 1), None):
        raise ValueError(f"{name!r}: {twice!r} has two labels")
    if counts[0] > 1:
        raise ValueError(f"{name!r}: 0 has two labels")
    return found


def plan_labels(columns: list[ColumnPlan], metadata: Metadata, family: Family, policy: TextLimitPolicy) -> list[LabelSet]:
    """One set for each distinct list of codes (and width of text), named after the first variable that has it."""
    by_codes: dict[tuple, list[ColumnPlan]] = {}
    for c in columns:
        if codes := metadata.value_labels.get(c.source):
            by_codes.setdefault((c.width if c.stored == "string" else None, *((v["value"], v["label"]) for v in codes)), []).append(c)
    out = []
    for (width, *_), members in by_codes.items():
        out.append(label_set(members[0].name, metadata.value_labels[members[0].source], family, policy, width))
        for c in members:
            c.label_set = out[-1].name
    return out


def _named(names: list[str], family: Family, rename: bool) -> dict[str, str]:
    """The variable of each column; illegal names are changed with a warning, or an error."""
    illegal = {n: faults for n in names if (faults := family.names.faults(n))}
    if illegal and not rename:
        told = "; ".join(f"{n!r} {', '.join(faults)}" for n, faults in illegal.items())
        raise ValueError(f"no legal {family.title} variable names (writing header): {told}; pass rename_invalid_names=True to change them")
    new = family.legal_names(names)
    if illegal:
        few = [f"{n!r} -> {new[n]!r}" for n in illegal][:3]
        rest = f" and {len(illegal) - len(few)} more" if len(illegal) > len(few) else ""
        warnings.warn(f"{len(illegal)} names are not legal in .{family.key} files and were changed: {', '.join(few)}{rest}", StatWarning, stacklevel=4)
    return new


def plan(schema: T.StructType, metadata: Metadata | None, family: Family, measured: Measured, *, rename_invalid_names: bool = False, on_text_limits_exceeded: TextLimitPolicy = "error") -> WritePlan:
    """Plan and check a file for rows of ``schema``; nothing is written before this returns."""
    if on_text_limits_exceeded not in ("error", "truncate"):
        raise ValueError(f"on_text_limits_exceeded is {on_text_limits_exceeded!r}, neither 'error' nor 'truncate'")
    metadata, policy = metadata or Metadata(), on_text_limits_exceeded
    names = _named(schema.fieldNames(), family, rename_invalid_names)
    columns = [replace(_column(f, metadata, family, measured, policy), name=names[f.name]) for f in schema.fields]
    return WritePlan(
        family,
        columns,
        plan_labels(columns, metadata, family, policy),
        family.fit(metadata.file_label, "file label", "the file", policy),
        [family.fit(n, "note", "the file", policy) or "" for n in metadata.notes],
        {old: new for old, new in names.items() if old != new},
        measured.rows,
    )
