"""Spark data sources ``sav`` and ``dta``: stored numbers of a file, read in parallel by ranges of rows; folders of part files, written in parallel."""

from __future__ import annotations

import glob
import json
import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import SparkSession, types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from ..errors import StatError
from ..formats import FAMILIES
from ..plans import write_plan
from ..plans.stored import by_type, stored
from . import dta, sav
from .base import KINDS, Dictionary, open_path

CODECS = {"sav": sav, "dta": dta}


def parts(path: str, family: str) -> list[str]:
    """The file itself, or the part files of a folder in order."""
    if not os.path.isdir(path):
        return [path]
    found = sorted(glob.glob(os.path.join(glob.escape(path), f"part-*.{family}")))
    if not found:
        raise StatError(f"{path}: no part files")
    return found


def load_dictionary(path: str, family: str, encoding: str | None = None) -> Dictionary:
    """The dictionary of a file, or of the first part in a folder with the rows of all."""
    try:
        first, *rest = parts(path, family)
        if rest:
            d = load_dictionary(first, family, encoding)
            counts = [d.rows, *(load_dictionary(p, family, encoding).rows for p in rest)]
            d.rows = None if None in counts else sum(counts)
            return d
        with open_path(first) as file:
            return CODECS[family].read_dictionary(file, encoding)
    except OSError as e:
        raise StatError(f"{path}: {e.strerror or e}") from e


def raw_schema(d: Dictionary, columns: list[str] | None, tags: bool) -> T.StructType:
    """Stored types of the wanted columns in file order; with ``tags`` a code beside each number."""
    fields = []
    for v in d.variables:
        if columns is None or v.name in columns:
            fields.append(T.StructField(v.name, KINDS[v.kind][0]))
            if tags and v.kind != "string":
                fields.append(T.StructField(f"{v.name}\0tag", T.ByteType()))
    return T.StructType(fields)


class Rows(InputPartition):
    def __init__(self, path: str, first: int, count: int):
        self.path, self.first, self.count = path, first, count


class FileReader(DataSourceReader):
    def __init__(self, options: dict[str, str], family: str):
        self.path, self.family = options["path"], family
        self.encoding = options.get("encoding")
        self.columns = json.loads(options["columns"]) if "columns" in options else None
        self.offset, self.limit = int(options.get("rowoffset", 0)), int(options.get("rowlimit", 0))
        self.tags = options.get("tags", "false") == "true"
        self.size = int(options.get("rowsperpartition", 1_000_000))

    def partitions(self) -> list[Rows]:
        """Ranges of rows, of each file in turn; a negative count means all that follow."""
        out: list[Rows] = []
        skip, left = self.offset, self.limit or None
        for path in parts(self.path, self.family):
            d = load_dictionary(path, self.family, self.encoding)
            if d.rows is None:
                return [*out, Rows(path, skip, -1 if left is None else left)]
            first = min(skip, d.rows)
            count = d.rows - first if left is None else min(d.rows - first, left)
            skip -= first
            left = None if left is None else left - count
            step = self.size if d.splittable() else max(count, 1)
            out += [Rows(path, k, min(step, first + count - k)) for k in range(first, first + count, step)]
        return out or [Rows(path, 0, 0)]

    def read(self, partition: Rows) -> Iterator[pa.RecordBatch]:
        with open_path(partition.path) as file:
            d = CODECS[self.family].read_dictionary(file, self.encoding)
            names = [v.name for v in d.variables if self.columns is None or v.name in self.columns]
            if partition.count:
                yield from CODECS[self.family].read_rows(file, d, names, partition.first, partition.count, self.tags)


@dataclass
class Written(WriterCommitMessage):
    partition: int
    file: str


class PartWriter(DataSourceArrowWriter):
    """A part file for each task, in a folder that all executors share.

    A task first keeps its rows beside the parts, as the widths of texts stand before the rows of a file. Every
    attempt has files of its own; the driver names those of the tasks that succeeded, in the order
    of the partitions, and removes the rest. Integers get the type that holds all values of theirs.
    """

    def __init__(self, options: dict[str, str], family: str, schema: T.StructType, overwrite: bool):
        path = options["path"].removeprefix("file://").removeprefix("file:")
        if "://" in path:
            raise StatError(f"{path}: files are written to folders that are mounted")
        if os.path.isfile(path):
            raise StatError(f"{path} is a file; parts are written to a folder")
        self.path, self.family, self.schema, self.overwrite = path, family, schema, overwrite
        self.compression = options.get("compression", "none")
        self.own = os.path.join(path, f"_unfinished-{uuid.uuid4().hex}")
        self.planned({}, 0)  # what can't be written is told before any task runs

    def planned(self, widths: dict[str, int], rows: int) -> write_plan.WritePlan:
        measured = by_type(self.schema)
        measured.widths, measured.rows = widths, rows
        return write_plan.plan(self.schema, None, FAMILIES[self.family], measured)

    def file(self, batches: Iterator[pa.RecordBatch]) -> str:
        from .files import FileWriter  # which needs the sources

        os.makedirs(self.own, exist_ok=True)
        texts = [(i, f.name) for i, f in enumerate(self.schema.fields) if isinstance(f.dataType, T.StringType)]
        widths, rows, kept, held = dict.fromkeys((n for _, n in texts), 1), 0, None, os.path.join(self.own, uuid.uuid4().hex)
        for batch in batches:
            rows += batch.num_rows
            for i, n in texts:
                widths[n] = max(widths[n], pc.max(pc.binary_length(batch.column(i))).as_py() or 0)
            kept = kept or pa.ipc.new_file(held, batch.schema)
            kept.write_batch(batch)
        plan = self.planned(widths, rows)
        writer = FileWriter(f"{held}.{self.family}", plan, self.compression)
        try:
            if kept:
                kept.close()
                with pa.memory_map(held) as file:
                    again = pa.ipc.open_file(file)
                    for k in range(again.num_record_batches):
                        batch = stored(again.get_batch(k), plan)
                        writer.append(writer.encode(batch), batch.num_rows)
                os.remove(held)
            writer.close()
        finally:
            writer.abandon()
        return f"{held}.{self.family}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return Written(TaskContext.get().partitionId(), self.file(iterator))

    def commit(self, messages: list[Written | None]) -> None:
        there = glob.glob(os.path.join(glob.escape(self.path), f"part-*.{self.family}"))
        if self.overwrite:
            for old in there:
                os.remove(old)
            there = []
        first = 1 + max((int(os.path.basename(p)[5:].split(".")[0]) for p in there), default=-1)
        new = [m.file for m in sorted((m for m in messages if m), key=lambda m: m.partition)]
        if not new and not there:
            new = [self.file(iter(()))]  # no rows, but columns
        for k, file in enumerate(new, first):
            os.replace(file, os.path.join(self.path, f"part-{k:06d}.{self.family}"))
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        shutil.rmtree(self.own, ignore_errors=True)


class SavSource(DataSource):
    """Options: ``path``, ``encoding``, ``columns`` (JSON list), ``rowOffset``, ``rowLimit``, ``rowsPerPartition``; for writing ``path`` and ``compression``."""

    family = "sav"

    @classmethod
    def name(cls) -> str:
        return cls.family

    def schema(self) -> T.StructType:
        o = self.options
        columns = json.loads(o["columns"]) if "columns" in o else None
        return raw_schema(load_dictionary(o["path"], self.family, o.get("encoding")), columns, o.get("tags", "false") == "true")

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return FileReader({k.lower(): v for k, v in self.options.items()}, self.family)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return PartWriter({k.lower(): v for k, v in self.options.items()}, self.family, schema, overwrite)


class DtaSource(SavSource):
    """The same options, and ``tags``: a code column beside each number."""

    family = "dta"


def register(spark: SparkSession) -> None:
    """Make the formats ``sav`` and ``dta`` known to this session, for ``spark.read`` and ``df.write``."""
    for source in (SavSource, DtaSource):
        spark.dataSource.register(source)
