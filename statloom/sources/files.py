"""Reading and writing whole files: DataFrames with their metadata."""

from __future__ import annotations

import atexit
import contextlib
import dataclasses
import json
import os
import tempfile
import uuid
import warnings
from collections.abc import Iterable, Iterator
from typing import Any, BinaryIO, get_args

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..errors import StatError, StatWarning, told_by_executors
from ..formats import DTA, FAMILIES, SAV, Family, SavCompression, TextLimitPolicy
from ..functions import missing as M, temporal
from ..metadata import Metadata
from ..operators.profile import checked_cast, profile, readable_as
from ..plans import write_plan
from ..plans.write_plan import Measured, WritePlan
from . import dta, sav
from .base import Dictionary, local_path
from .datasource import load_dictionary, register

Where = str | bytes | os.PathLike | BinaryIO


def shared_folder(spark: SparkSession) -> str:
    """A folder that the executors see, too: ``spark.checkpoint.dir``; only where it is unset, a temporary one."""
    sc = spark.sparkContext
    set_folder = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not set_folder and not sc.master.startswith("local[") and sc.master != "local":
        raise StatError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = (set_folder or tempfile.gettempdir()).removeprefix("file://")
    if "://" in folder:
        raise StatError(f"file objects need a shared folder that is mounted; spark.checkpoint.dir is {folder}")
    os.makedirs(folder, exist_ok=True)
    return folder


def _spooled(spark: SparkSession, where: Where) -> str:
    """A path for ``where``; the rest of a file object is copied into the shared folder, its position kept."""
    if isinstance(where, (str, bytes, os.PathLike)):
        return local_path(where)
    if not (getattr(where, "seekable", None) is None or where.seekable()):
        raise ValueError("a file object must be seekable")
    start = where.tell()
    path = os.path.join(shared_folder(spark), f"statloom-{uuid.uuid4().hex}")
    try:
        with open(path, "wb") as out:
            while part := where.read(1 << 20):
                out.write(part)
    finally:
        where.seek(start)
    atexit.register(_removed, path)  # tables that are read from it may run until then
    return path


def _removed(path: str) -> None:
    with contextlib.suppress(OSError):
        os.remove(path)


def _declared_widths(family: Family, metadata: Metadata) -> Metadata:
    """Storage widths as the display formats of strings declare them."""
    widths = dict(metadata.storage_widths)
    for name, display in metadata.formats.items():
        text = display or ""
        if family.key == "sav" and text[:1] == "A" and text[1:].isdigit():
            widths[name] = int(text[1:])
    metadata.storage_widths = widths
    return metadata


class StatFile:
    """A file whose dictionary is known and whose rows are yet to be read.

    ``schema`` is that of the DataFrame, ``num_rows`` what the file's header counts (None if it doesn't),
    ``metadata`` what it says about the wanted columns.
    """

    def __init__(self, spark: SparkSession, where: Where, family: Family, columns: Iterable[str] | None = None, row_limit: int = 0, row_offset: int = 0, encoding: str | None = None, scan_and_narrow_types: bool = False, preserve_user_missing: bool = False):
        self.spark, self.family, self.encoding = spark, family, encoding
        self.path = _spooled(spark, where)
        self.limit, self.offset, self.preserve = row_limit, row_offset, preserve_user_missing
        d: Dictionary = load_dictionary(self.path, family.key, encoding)
        for text in d.warnings:
            warnings.warn(text, StatWarning, stacklevel=4)
        wanted = None if columns is None else set(columns)
        self.names = [v.name for v in d.variables if wanted is None or v.name in wanted]
        metadata = _declared_widths(family, d.metadata)
        self.metadata = metadata if wanted is None else metadata.select(self.names)
        self.num_rows, self.splittable = d.rows, d.splittable()
        self.tagged = family.tagged_missing and preserve_user_missing
        self.types: dict[str, str] = {}
        if scan_and_narrow_types:
            plain = self._masked(row_offset, row_limit)
            numbers = [f.name for f in plain.schema.fields if isinstance(f.dataType, T.NumericType)]
            now = {f.name: f.dataType.simpleString() for f in plain.schema.fields}
            with told_by_executors():
                found = {n: p.narrow_type() for n, p in profile(plain, numbers).items()}
            self.types = {n: t for n, t in found.items() if t != now[n]}
            whole = [n for n, t in self.types.items() if t not in ("float", "double")]
            self.metadata = self.metadata.with_integer_codes(whole)
        self.schema = self._converted(0, 1).schema

    def _raw(self, offset: int, limit: int) -> DataFrame:
        register(self.spark)
        reader = self.spark.read.format(self.family.key).option("columns", json.dumps(self.names)).option("rowOffset", offset).option("rowLimit", limit)
        if self.encoding:
            reader = reader.option("encoding", self.encoding)
        return reader.option("tags", str(self.tagged).lower()).load(self.path)

    def _masked(self, offset: int, limit: int) -> DataFrame:
        """Stored values; what is declared missing is null unless it is to be kept."""
        raw = self._raw(offset, limit)
        out = []
        for name in raw.columns:
            declared = None if self.preserve else self.metadata.missing_values.get(name)
            out.append(M.mask(raw[f"`{name.replace('`', '``')}`"], declared, name).alias(name))
        return raw.select(*out)

    def _converted(self, offset: int, limit: int) -> DataFrame:
        rows = self._masked(offset, limit)
        out = []
        for name in self.names:
            cell = rows[f"`{name.replace('`', '``')}`"]
            kind = rows.schema[name].dataType
            if name in self.types:
                cell = checked_cast(cell, readable_as(kind, self.types[name], name), name)
            when = None if isinstance(kind, T.StringType) else temporal.classify(self.family, self.metadata.formats.get(name))
            if when:
                cell = temporal.to_temporal(cell, self.family, when)
            if self.tagged and not isinstance(kind, T.StringType):
                cell = M.wrap(cell, M.letter(rows[f"`{name.replace('`', '``')}\0tag`"]))
            out.append(cell.alias(name))
        return rows.select(*out)

    def read_all(self) -> DataFrame:
        """All rows, lazily; it may be called again."""
        return self._converted(self.offset, self.limit)


def _read(spark: SparkSession, where: Where, family: Family, options: dict[str, Any]) -> tuple[DataFrame, Metadata]:
    file = StatFile(spark, where, family, **options)
    return file.read_all(), file.metadata


def read_sav(spark: SparkSession, where: Where, *, columns: Iterable[str] | None = None, row_limit: int = 0, row_offset: int = 0, encoding: str | None = None, scan_and_narrow_types: bool = False, preserve_user_missing: bool = False) -> tuple[DataFrame, Metadata]:
    """A ``.sav`` or ``.zsav`` file as a DataFrame, with its metadata.

    ``columns`` picks variables (in file order, unknown names ignored); ``row_limit`` 0 is none. Values
    declared missing are null unless ``preserve_user_missing``. With ``scan_and_narrow_types`` a pass
    over the rows finds the smallest types that keep all values.
    """
    return _read(spark, where, SAV, dict(columns=columns, row_limit=row_limit, row_offset=row_offset, encoding=encoding, scan_and_narrow_types=scan_and_narrow_types, preserve_user_missing=preserve_user_missing))


def read_dta(spark: SparkSession, where: Where, *, columns: Iterable[str] | None = None, row_limit: int = 0, row_offset: int = 0, encoding: str | None = None, scan_and_narrow_types: bool = False, preserve_user_missing: bool = False) -> tuple[DataFrame, Metadata]:
    """A ``.dta`` file as a DataFrame, with its metadata; options as for ``read_sav``.

    With ``preserve_user_missing`` every column but strings is ``struct<value, tag>``: ``.`` is a null
    struct, ``.a`` has the tag ``a``.
    """
    return _read(spark, where, DTA, dict(columns=columns, row_limit=row_limit, row_offset=row_offset, encoding=encoding, scan_and_narrow_types=scan_and_narrow_types, preserve_user_missing=preserve_user_missing))


def read_sav_metadata(spark: SparkSession, where: Where, *, encoding: str | None = None) -> tuple[T.StructType, int | None, Metadata]:
    """Schema, number of rows (None if the file doesn't say) and metadata, without reading a row."""
    file = StatFile(spark, where, SAV, encoding=encoding)
    return file.schema, file.num_rows, file.metadata


def read_dta_metadata(spark: SparkSession, where: Where, *, encoding: str | None = None) -> tuple[T.StructType, int | None, Metadata]:
    """Schema, number of rows and metadata, without reading a row."""
    file = StatFile(spark, where, DTA, encoding=encoding)
    return file.schema, file.num_rows, file.metadata


# ---- writing


class _Sink:
    """A file that grows part by part, at its place only once it is whole."""

    def __init__(self, where: Where):
        self.path = local_path(where) if isinstance(where, (str, bytes, os.PathLike)) else None
        self.temporary = f"{self.path}.{uuid.uuid4().hex[:8]}.part"
        self.out: BinaryIO = open(self.temporary, "w+b") if self.path else tempfile.TemporaryFile()
        self.target = where

    def finish(self) -> None:
        if self.path:
            self.out.close()
            os.replace(self.temporary, self.path)
            return
        self.out.seek(0)
        while part := self.out.read(1 << 20):
            self.target.write(part)
        self.out.close()

    def drop(self) -> None:
        self.out.close()
        if self.path and os.path.exists(self.temporary):
            os.remove(self.temporary)


def compression_level(compression: SavCompression) -> int:
    """0 to 2, as the header of a ``.sav`` file has it."""
    known = get_args(SavCompression)
    if compression not in known:
        raise ValueError(f"no compression {compression!r}; there are {', '.join(known)}")
    return known.index(compression)


class FileWriter:
    """Writes planned rows in parts; the file appears when it is closed with as many rows as were promised."""

    def __init__(self, where: Where, plan: WritePlan, compression: SavCompression = "none"):
        self.plan, self.level = plan, compression_level(compression)
        self.rows_written, self.open = 0, True
        if plan.family.key == "dta":
            head = dta.header(plan, plan.rows)
        else:
            head = sav.header(plan, plan.rows, self.level)
        self.sink = _Sink(where)
        self.sink.out.write(head)
        self.zlib = sav.Zlib(len(head)) if self.level == 2 else None
        if self.zlib:
            self.sink.out.write(b"\0" * 24)

    def encode(self, batch: pa.RecordBatch) -> bytes:
        if self.plan.family.key == "dta":
            return dta.encode_rows(batch, self.plan)
        raw = sav.encode_rows(batch, self.plan)
        return sav.compress_rows(raw, sav.string_cells(self.plan)) if self.level else raw

    def append(self, data: bytes, rows: int) -> None:
        if self.rows_written + rows > self.plan.rows:
            raise StatError(f"more rows than the {self.plan.rows} that the header counts")
        self.rows_written += rows
        self.sink.out.write(self.zlib.add(data) if self.zlib else data)

    def close(self) -> None:
        if not self.open:
            return
        self.open = False
        try:
            if self.rows_written != self.plan.rows:
                raise StatError(f"{self.rows_written} rows were written where the header counts {self.plan.rows}")
            out = self.sink.out
            if self.plan.family.key == "dta":
                out.write(dta.footer(self.plan, self.plan.rows))
            elif self.zlib:
                out.write(self.zlib.add(b"", last=True))
                out.write(self.zlib.trailer())
                out.seek(self.zlib.start)
                out.write(self.zlib.head())
            self.sink.finish()
        except BaseException:
            self.sink.drop()
            raise

    def abandon(self) -> None:
        if self.open:
            self.open = False
            self.sink.drop()


def _encoded(df: DataFrame, plan: WritePlan, level: int) -> Iterator[tuple[bytes, int]]:
    """Encoded parts in the order of the rows; executors encode, the driver holds one part at a time."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if plan.family.key == "dta":
                data = dta.encode_rows(batch, plan)
            else:
                data = sav.encode_rows(batch, plan)
                data = sav.compress_rows(data, sav.string_cells(plan)) if level else data
            yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary()), pa.array([batch.num_rows], pa.int64())], names=["data", "n"])

    with told_by_executors():
        for row in plan.encode(df).mapInArrow(run, "data binary, n long").toLocalIterator():
            yield bytes(row.data), row.n


def _write(where: Where, df: DataFrame, metadata: Metadata | None, family: Family, compression: SavCompression, rename: bool, policy: TextLimitPolicy) -> WritePlan:
    compression_level(compression)
    with told_by_executors():
        measured = write_plan.measure(df)
    plan = write_plan.plan(df.schema, metadata, family, measured, rename_invalid_names=rename, on_text_limits_exceeded=policy)
    for p in plan.columns:
        p.cut = p.cut and p.stored == "string"
    writer = FileWriter(where, plan, compression)
    try:
        if plan.columns:
            for data, rows in _encoded(df, plan, writer.level):
                writer.append(data, rows)
        else:
            writer.append(b"", plan.rows)
        writer.close()
    finally:
        writer.abandon()
    return plan


def write_sav(where: Where, df: DataFrame, metadata: Metadata | None = None, *, rename_invalid_names: bool = False, on_text_limits_exceeded: TextLimitPolicy = "error", compression: SavCompression = "none") -> dict[str, str]:
    """Write ``df`` as a ``.sav`` (or, with ``compression="zlib"``, ``.zsav``) file; returns renamed variables.

    One aggregation counts rows and measures strings, then everything is planned and checked, and only then
    is the file begun. It is written beside its place and moved there when whole.
    """
    return _write(where, df, metadata, SAV, compression, rename_invalid_names, on_text_limits_exceeded).renamed


def write_dta(where: Where, df: DataFrame, metadata: Metadata | None = None, *, rename_invalid_names: bool = False, on_text_limits_exceeded: TextLimitPolicy = "error") -> dict[str, str]:
    """Write ``df`` as a Stata 118 file; integers that Stata's types don't hold are widened; returns renamed variables."""
    return _write(where, df, metadata, DTA, "none", rename_invalid_names, on_text_limits_exceeded).renamed


def write_parts(folder: str | os.PathLike, df: DataFrame, metadata: Metadata | None = None, *, kind: str = "dta", rename_invalid_names: bool = False, on_text_limits_exceeded: TextLimitPolicy = "error", compression: SavCompression = "none") -> int:
    """Write every partition of ``df`` as a file of its own into a new folder that all executors share; returns the rows.

    For data that no single file should hold. All parts have one plan, so the folder reads as one table.
    A part is renamed when whole; a task that runs again replaces its part.
    """
    family = FAMILIES[kind]
    path = local_path(folder)
    os.makedirs(path)
    plan = write_plan.plan(df.schema, metadata, family, write_plan.measure(df), rename_invalid_names=rename_invalid_names, on_text_limits_exceeded=on_text_limits_exceeded)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = dataclasses.replace(plan, rows=0)
        writer = FileWriter(os.path.join(path, f"part-{TaskContext.get().partitionId():06d}.{kind}"), own, compression)
        try:
            for batch in batches:
                own.rows += batch.num_rows
                writer.append(writer.encode(batch), batch.num_rows)
            head = dta.header(own, own.rows) if kind == "dta" else sav.header(own, own.rows, writer.level)
            writer.sink.out.seek(0)
            writer.sink.out.write(head)  # as long as the one for no rows
            writer.sink.out.seek(0, os.SEEK_END)
            writer.close()
        finally:
            writer.abandon()
        yield pa.RecordBatch.from_arrays([pa.array([own.rows], pa.int64())], names=["n"])

    with told_by_executors():
        return plan.encode(df).mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


class StatWriter:
    """Writes a file from DataFrames handed over one after the other.

    The schema and the number of rows are fixed from the start: more rows are an error when they come,
    fewer when the writer is closed. Use it as a context manager; an exception leaves no file.
    """

    family: Family

    def __init__(self, where: Where, schema: T.StructType, num_rows: int, metadata: Metadata | None = None, *, rename_invalid_names: bool = False, on_text_limits_exceeded: TextLimitPolicy = "error", compression: SavCompression = "none", variable_ranges: dict[str, tuple[int, int]] | None = None):
        if num_rows < 0:
            raise ValueError(f"num_rows must not be negative, got {num_rows}")
        self.schema = schema
        measured = Measured(num_rows, {}, dict(variable_ranges or {}))
        self.plan = write_plan.plan(schema, metadata, self.family, measured, rename_invalid_names=rename_invalid_names, on_text_limits_exceeded=on_text_limits_exceeded)
        self.renamed_variables = self.plan.renamed
        self.writer = FileWriter(where, self.plan, compression)

    @property
    def rows_written(self) -> int:
        return self.writer.rows_written

    def write(self, df: DataFrame) -> None:
        """Append the rows of ``df``, whose names and types must be those of the writer."""
        plain = lambda s: [(f.name, f.dataType) for f in s.fields]
        if plain(df.schema) != plain(self.schema):
            raise ValueError(f"the schema {df.schema.simpleString()} is not the writer's {self.schema.simpleString()}")
        for data, rows in _encoded(df, self.plan, self.writer.level):
            self.writer.append(data, rows)

    def close(self) -> None:
        self.writer.close()

    def __enter__(self) -> StatWriter:
        return self

    def __exit__(self, kind: type | None, *_: object) -> None:
        self.writer.abandon() if kind else self.writer.close()


class SavWriter(StatWriter):
    family = SAV


class DtaWriter(StatWriter):
    family = DTA
