"""Files read in batches of a fixed size, in order and with bounded memory."""

from __future__ import annotations

import glob
import os
import shutil
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession

from ..errors import StatError, told_by_executors
from ..formats import DTA, SAV
from ..sources.files import StatFile, Where, shared_folder

#: Batches that one job fetches.
TOGETHER = 16


def _batch(table: pa.Table) -> pa.RecordBatch:
    return table.combine_chunks().to_batches()[0]


class StatReader(StatFile):
    """A file opened for batches; schema and metadata are complete before the first one."""

    def _spooled(self, batch_rows: int) -> Iterator[pa.RecordBatch]:
        """Of a compressed file, which only one task can read: its rows are written once, in order, and then fetched."""
        folder = os.path.join(shared_folder(self.spark), f"statloom-rows-{uuid.uuid4().hex}")
        try:
            with told_by_executors():
                self.read_all().write.parquet(f"file://{os.path.abspath(folder)}")
            held: list[pa.RecordBatch] = []
            rows = 0
            for part in sorted(glob.glob(os.path.join(glob.escape(folder), "part-*.parquet"))):
                for batch in pq.ParquetFile(part).iter_batches(batch_rows):
                    held.append(batch)
                    rows += batch.num_rows
                    if rows >= batch_rows:
                        table = pa.Table.from_batches(held)
                        yield _batch(table.slice(0, batch_rows))
                        held, rows = table.slice(batch_rows).to_batches(), rows - batch_rows
            if rows:
                yield _batch(pa.Table.from_batches(held))
        finally:
            shutil.rmtree(folder, ignore_errors=True)

    def _fetched(self, batch_rows: int) -> Iterator[pa.RecordBatch]:
        at, left, together = self.offset, self.limit or None, TOGETHER
        while left is None or left > 0:
            want = batch_rows * together if left is None else min(batch_rows * together, left)
            try:
                with told_by_executors():
                    table = self._converted(at, want).toArrow()
            except StatError:
                if together == 1:
                    raise
                together = 1  # what stands before the damage is still to be delivered
                continue
            for k in range(0, len(table), batch_rows):
                yield _batch(table.slice(k, batch_rows))
            at += len(table)
            left = None if left is None else left - len(table)
            if len(table) < want:
                return

    def batches(self, batch_rows: int = 65_536) -> Iterator[pa.RecordBatch]:
        """Batches of ``batch_rows`` rows, the last one maybe shorter, none empty."""
        if batch_rows < 1:
            raise ValueError(f"a batch of {batch_rows} rows: batch_rows is 1 at least")
        return self._fetched(batch_rows) if self.splittable else self._whole_or_begun(batch_rows)

    def _whole_or_begun(self, batch_rows: int) -> Iterator[pa.RecordBatch]:
        spooled = self._spooled(batch_rows)
        try:
            first = next(spooled, None)
        except StatError:  # damaged: what stands before is still to be delivered
            yield from self._fetched(batch_rows)
            return
        if first is not None:
            yield first
            yield from spooled

    def read_batches(self, callback: Callable[[pa.RecordBatch], object], *, batch_rows: int = 65_536) -> int:
        """Hand every batch to ``callback`` on the driver; returns the rows read. Its exceptions end the reading."""
        rows = 0
        for batch in self.batches(batch_rows):
            callback(batch)
            rows += batch.num_rows
        return rows


class SavStreamingReader(StatReader):
    def __init__(self, spark: SparkSession, where: Where, **options):
        super().__init__(spark, where, SAV, **options)


class DtaStreamingReader(StatReader):
    def __init__(self, spark: SparkSession, where: Where, **options):
        super().__init__(spark, where, DTA, **options)


def open_sav(spark: SparkSession, where: Where, *, columns: Iterable[str] | None = None, row_limit: int = 0, row_offset: int = 0, encoding: str | None = None, scan_and_narrow_types: bool = False, preserve_user_missing: bool = False) -> SavStreamingReader:
    """Open a ``.sav`` file; no row is read unless types are to be narrowed."""
    return SavStreamingReader(spark, where, columns=columns, row_limit=row_limit, row_offset=row_offset, encoding=encoding, scan_and_narrow_types=scan_and_narrow_types, preserve_user_missing=preserve_user_missing)


def open_dta(spark: SparkSession, where: Where, *, columns: Iterable[str] | None = None, row_limit: int = 0, row_offset: int = 0, encoding: str | None = None, scan_and_narrow_types: bool = False, preserve_user_missing: bool = False) -> DtaStreamingReader:
    """Open a ``.dta`` file; options as for ``open_sav``."""
    return DtaStreamingReader(spark, where, columns=columns, row_limit=row_limit, row_offset=row_offset, encoding=encoding, scan_and_narrow_types=scan_and_narrow_types, preserve_user_missing=preserve_user_missing)


def batch_numbers(rows: DataFrame, row: str, batch_rows: int) -> DataFrame:
    """The sizes of the batches that rows numbered from 0 fall into: ``batch, rows``."""
    return rows.groupBy((rows[row] / batch_rows).cast("long").alias("batch")).count().withColumnRenamed("count", "rows")
