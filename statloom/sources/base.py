"""What the codecs of both families share: file dictionaries, byte sources and Arrow types."""

from __future__ import annotations

import codecs
import os
from dataclasses import dataclass, field
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T

from ..metadata import Metadata, Missingness

ROWS = 65_536

#: Stored kinds: Spark type, Arrow type.
KINDS: dict[str, tuple[T.DataType, pa.DataType]] = {
    "byte": (T.ByteType(), pa.int8()),
    "int": (T.ShortType(), pa.int16()),
    "long": (T.IntegerType(), pa.int32()),
    "float": (T.FloatType(), pa.float32()),
    "double": (T.DoubleType(), pa.float64()),
    "string": (T.StringType(), pa.string()),
}


@dataclass
class Variable:
    """A variable of a file's dictionary."""

    name: str
    kind: str
    width: int = 8  #: bytes of a string value
    start: int = 0  #: of the cell in a row
    long_string: bool = False  #: a reference into the file's table of long strings
    missing: Missingness | None = None


@dataclass
class Dictionary:
    """All that a file says before its rows."""

    family: str
    variables: list[Variable]
    metadata: Metadata
    rows: int | None
    row_size: int
    data_start: int
    encoding: str = "utf-8"
    order: str = "<"
    compression: int = 0
    bias: float = 100.0
    long_strings: tuple[int, int] = (0, 0)  #: where the table of long strings begins and ends
    version: int = 118
    warnings: list[str] = field(default_factory=list)

    def splittable(self) -> bool:
        return not self.compression and self.rows is not None


def open_path(path: str) -> BinaryIO:
    """A local file, or one of a file system that Arrow can reach by its address."""
    if "://" in path and not path.startswith("file:"):
        from pyarrow import fs

        system, inner = fs.FileSystem.from_uri(path)
        return system.open_input_file(inner)
    return open(path.removeprefix("file://").removeprefix("file:"), "rb")


def known_encoding(name: str, usual: str) -> tuple[str, list[str]]:
    """The encoding by a name that Python knows, else the usual one and a warning."""
    try:
        codecs.lookup(name)
    except LookupError:
        return usual, [f"unknown encoding {name!r}, read as {usual}"]
    return name, []


def local_path(where: str | bytes | os.PathLike) -> str:
    return os.path.expanduser(os.fsdecode(where))


def exactly(file: BinaryIO, n: int) -> bytes:
    """``n`` bytes, however few the file gives at a time; fewer at its end."""
    parts = []
    while n > 0:
        part = file.read(n)
        if not part:
            break
        parts.append(part)
        n -= len(part)
    return b"".join(parts)


def strings(cells: np.ndarray, encoding: str) -> pa.Array:
    """Fixed-width byte cells, their padding removed, as an Arrow array."""
    raw = cells.tolist()
    if encoding.lower().replace("_", "-") in ("utf-8", "utf8", "ascii", "us-ascii"):
        try:
            return pa.array(raw, pa.binary()).cast(pa.string())
        except pa.ArrowInvalid:
            pass
    return pa.array([x.decode(encoding, "replace") for x in raw], pa.string())
