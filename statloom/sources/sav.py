"""SPSS's ``.sav`` and ``.zsav`` files, by the published description of the system file format."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from typing import Any, BinaryIO

import numpy as np
import pyarrow as pa

from ..errors import StatError
from ..metadata import Metadata
from ..plans.write_plan import ColumnPlan, WritePlan
from .base import KINDS, ROWS, Dictionary, Variable, exactly, known_encoding, strings

# Fixed values of the format.
SYSMIS = -1.7976931348623157e308
LOWEST = struct.unpack("<d", struct.pack("<Q", 0xFFEFFFFFFFFFFFFE))[0]
HIGHEST = 1.7976931348623157e308
_SEGMENT, _STEP = 255, 252
_MEASURES = ("unknown", "nominal", "ordinal", "scale")
_ALIGNMENTS = ("left", "right", "center")
_BLOCK = 0x3FF000
#: Names of display formats by their codes.
_FORMATS = {
    1: "A", 2: "AHEX", 3: "COMMA", 4: "DOLLAR", 5: "F", 6: "IB", 7: "PIBHEX", 8: "P", 9: "PIB", 10: "PK", 11: "RB", 12: "RBHEX",
    15: "Z", 16: "N", 17: "E", 20: "DATE", 21: "TIME", 22: "DATETIME", 23: "ADATE", 24: "JDATE", 25: "DTIME", 26: "WKDAY", 27: "MONTH",
    28: "MOYR", 29: "QYR", 30: "WKYR", 31: "PCT", 32: "DOT", 33: "CCA", 34: "CCB", 35: "CCC", 36: "CCD", 37: "CCE", 38: "EDATE", 39: "SDATE", 40: "MTIME", 41: "YMDHMS",
}
_FORMAT_CODES = {name: code for code, name in _FORMATS.items()}
#: Code pages by the numbers of the machine record.
_PAGES = {1: "cp037", 2: "ascii", 3: "cp1252", 65001: "utf-8", 28591: "iso8859-1"}


def format_text(code: int) -> str | None:
    """``F8.2`` for a packed format; nothing after the width where there are no decimals and none are usual."""
    kind, width, decimals = code >> 16 & 255, code >> 8 & 255, code & 255
    name = _FORMATS.get(kind)
    if not name:
        return None
    plain = name in ("A", "AHEX") or (20 <= kind <= 30 or kind >= 38) and not decimals
    return f"{name}{width or ''}" if plain else f"{name}{width}.{decimals}"


def format_code(text: str | None, width: int, string: bool) -> int:
    """A packed format from its text, or the usual one."""
    name = (text or "").upper().rstrip("0123456789.")
    rest = (text or "")[len(name) :]
    if name not in _FORMAT_CODES:
        name, rest = ("A", str(width)) if string else ("F", "8.2")
    w, _, d = rest.partition(".")
    usual = {"DATE": 11, "DATETIME": 20, "TIME": 8, "DTIME": 11, "ADATE": 10, "EDATE": 10, "SDATE": 10, "JDATE": 7}.get(name, 8)
    return _FORMAT_CODES[name] << 16 | min(int(w) if w else width if string else usual, 255) << 8 | min(int(d or 0), 255)


class _Reader:
    def __init__(self, file: BinaryIO):
        self.file, self.order = file, "<"

    def take(self, n: int) -> bytes:
        data = exactly(self.file, n)
        if len(data) < n:
            raise StatError("the file ends within its dictionary")
        return data

    def int(self) -> int:
        return struct.unpack(self.order + "i", self.take(4))[0]

    def ints(self, n: int) -> tuple[int, ...]:
        return struct.unpack(f"{self.order}{n}i", self.take(4 * n))

    def doubles(self, n: int) -> tuple[float, ...]:
        return struct.unpack(f"{self.order}{n}d", self.take(8 * n))


def _missing(count: int, raw: bytes, string: bool, order: str, encoding: str) -> dict | None:
    if not count:
        return None
    if string:
        return {"values": [raw[k : k + 8].decode(encoding, "replace").rstrip() for k in range(0, len(raw), 8)]}
    values = struct.unpack(f"{order}{abs(count)}d", raw)
    if count > 0:
        return {"values": list(values)}
    lo, hi = values[0], values[1]
    if lo == hi:  # a range of one value is that value
        return {"values": list(values[1:])}
    found: dict[str, Any] = {"lo": float("-inf") if lo <= LOWEST else lo, "hi": float("inf") if hi >= HIGHEST else hi}
    return found | ({"value": values[2]} if count == -3 else {})


def read_dictionary(file: BinaryIO, encoding: str | None = None) -> Dictionary:
    """All records before the rows; the file is left at the first row."""
    r = _Reader(file)
    magic = r.take(4)
    if magic not in (b"$FL2", b"$FL3"):
        raise StatError(f"not an SPSS system file: it begins with {magic!r}")
    r.take(60)
    layout = r.take(4)
    r.order = "<" if struct.unpack("<i", layout)[0] in (2, 3) else ">"
    _, compression, _, cases = r.ints(4)
    (bias,) = r.doubles(1)
    r.take(17)
    label = r.take(64)
    r.take(3)
    raw: list[dict] = []  # of each 8-byte cell that begins a variable
    cells = 0
    sets: list[tuple[list[tuple[bytes, bytes]], tuple[int, ...]]] = []
    notes: list[bytes] = []
    more: dict[int, bytes] = {}
    while (kind := r.int()) != 999:
        if kind == 2:
            width, labelled, missing, shown, _ = r.ints(5)
            name = r.take(8)
            v = {"cell": cells, "width": width, "shown": shown, "name": name, "label": b"", "count": missing}
            if labelled:
                size = r.int()
                v["label"] = r.take(-(-size // 4) * 4)[:size]
            v["missing"] = r.take(8 * abs(missing))
            if width >= 0:
                raw.append(v)
            cells += 1
        elif kind == 3:
            entries = []
            for _ in range(r.int()):
                value, size = r.take(8), r.take(1)[0]
                entries.append((value, r.take(-(-(size + 1) // 8) * 8 - 1)[:size]))
            if r.int() != 4:
                raise StatError("value labels without the variables they belong to")
            sets.append((entries, r.ints(r.int())))
        elif kind == 6:
            notes += [r.take(80) for _ in range(r.int())]
        elif kind == 7:
            sub, size, count = r.ints(3)
            more[sub] = r.take(size * count)
        else:
            raise StatError(f"unknown record {kind} in the dictionary")
    r.int()
    if encoding is None:
        encoding = more[20].decode("ascii", "replace").strip() if 20 in more else None
    if encoding is None and 3 in more:
        page = struct.unpack(r.order + "8i", more[3][:32])[7]
        encoding = _PAGES.get(page, f"cp{page}")
    encoding, warned = known_encoding(encoding or "cp1252", "cp1252")
    text = lambda b: b.decode(encoding, "replace").rstrip(" \0")

    long_names = {}
    for pair in more.get(13, b"").decode(encoding, "replace").split("\t"):
        short, eq, name = pair.partition("=")
        if eq:
            long_names[short.strip().upper()] = name.rstrip("\0")
    very_long = {}
    for pair in more.get(14, b"").decode(encoding, "replace").replace("\0", "").split("\t"):
        short, eq, width = pair.partition("=")
        if eq:
            very_long[short.strip().upper()] = int(width)
    shown = struct.unpack(f"{r.order}{len(more[11]) // 4}i", more[11]) if 11 in more else ()
    step = 3 if len(shown) == 3 * len(raw) else 2 if len(shown) == 2 * len(raw) else 0

    variables: list[Variable] = []
    metadata = Metadata(file_label=text(label) or None, notes=[text(n) for n in notes])
    maps: dict[str, dict] = {m: {} for m in ("variable_labels", "formats", "storage_widths", "display_widths", "measures", "alignments", "missing_values", "value_labels")}
    by_cell, by_short, skip = {}, {}, 0
    for i, v in enumerate(raw):
        if skip:
            skip -= 1
            continue
        short = text(v["name"])
        width = v["width"]
        if short.upper() in very_long:
            width = very_long[short.upper()]
            skip = -(-width // _STEP) - 1
        name = long_names.get(short.upper(), short) or f"V{len(variables)}"
        var = Variable(name, "string" if width else "double", width or 8, 8 * v["cell"], width > _SEGMENT, _missing(v["count"], v["missing"], bool(width), r.order, encoding))
        variables.append(var)
        by_cell[v["cell"]] = var
        by_short[short.upper()] = var
        for key, value in (("variable_labels", text(v["label"])), ("formats", f"A{width}" if width > _SEGMENT and v["shown"] >> 16 & 255 == 1 else format_text(v["shown"])), ("storage_widths", var.width), ("missing_values", var.missing)):
            if value:
                maps[key][name] = value
        if step:
            at = shown[step * i : step * (i + 1)]
            if 0 < at[0] < 4:
                maps["measures"][name] = _MEASURES[at[0]]
            if step == 3 and at[1]:
                maps["display_widths"][name] = at[1]
            if 0 <= at[-1] < 3:
                maps["alignments"][name] = _ALIGNMENTS[at[-1]]
    for entries, members in sets:
        for cell in members:
            if (var := by_cell.get(cell - 1)) is not None:
                value = (lambda b: text(b)) if var.kind == "string" else (lambda b: struct.unpack(r.order + "d", b)[0])
                maps["value_labels"][var.name] = [{"value": value(b), "label": text(t)} for b, t in entries]
    at, block = 0, more.get(21, b"")
    while at < len(block):  # labels of strings wider than eight bytes
        sizes = []

        def sized() -> bytes:
            nonlocal at
            (n,) = struct.unpack_from(r.order + "i", block, at)
            at += 4 + n
            sizes.append(n)
            return block[at - n : at]

        name = text(sized())
        _, count = struct.unpack_from(r.order + "2i", block, at)
        at += 8
        maps["value_labels"][name] = [{"value": text(sized()), "label": text(sized())} for _ in range(count)]
    at, block = 0, more.get(22, b"")
    while at < len(block):  # missing values of such strings
        (n,) = struct.unpack_from(r.order + "i", block, at)
        name = text(block[at + 4 : at + 4 + n])
        at += 4 + n
        count = block[at]
        (n,) = struct.unpack_from(r.order + "i", block, at + 1)
        at += 5
        values = [text(block[at + k * n : at + (k + 1) * n]) for k in range(count)]
        at += count * n
        for v in variables:
            if v.name == name:
                v.missing = maps["missing_values"][name] = {"values": values}
    for key, value in maps.items():
        setattr(metadata, key, value)
    metadata.multiple_response_sets = [s for sub in (5, 7, 19) for s in _response_sets(more.get(sub, b"").decode(encoding, "replace"), by_short)]
    rows = struct.unpack(r.order + "2q", more[16][:16])[1] if 16 in more else cases
    return Dictionary("sav", variables, metadata, rows if rows >= 0 else None, 8 * cells, file.tell(), encoding, r.order, compression, bias, warnings=warned)


def _response_sets(text: str, by_short: dict[str, Variable]) -> list[dict]:
    found = []
    for line in text.split("\n"):
        name, eq, rest = line.partition("=")
        if not eq:
            continue
        kind, rest = rest[:1], rest[1:]
        counted = None
        if kind == "E":
            rest = rest.split(" ", 2)[-1]
        if kind in "DE":
            size, _, rest = rest.strip().partition(" ")
            counted, rest = rest[: int(size)], rest[int(size) :]
        size, _, rest = rest.strip().partition(" ")
        label, rest = rest[: int(size)], rest[int(size) :]
        members = [by_short[s.upper()].name for s in rest.split() if s.upper() in by_short]
        found.append({"name": name.lstrip("$"), "label": label or None, "type": "C" if kind == "C" else "D", "is_dichotomy": kind != "C", "counted_value": counted, "variables": members})
    return found


def _inflated(file: BinaryIO, d: Dictionary) -> Iterator[bytes]:
    """The blocks of a ``.zsav`` file, one at a time."""
    _, trailer, _ = struct.unpack(d.order + "3q", exactly(file, 24))
    file.seek(trailer)
    head = exactly(file, 24)
    if len(head) < 24:
        raise StatError("the file ends before its list of blocks")
    (blocks,) = struct.unpack(d.order + "i", head[20:])
    entries = [struct.unpack(d.order + "2q2i", exactly(file, 24)) for _ in range(blocks)]
    for _, at, _, size in entries:
        file.seek(at)
        try:
            yield zlib.decompress(exactly(file, size))
        except zlib.error as e:
            raise StatError(f"a damaged block: {e}") from e


def _chunks(file: BinaryIO) -> Iterator[bytes]:
    while data := exactly(file, 1 << 20):
        yield data


def _plain_rows(source: Iterator[bytes], d: Dictionary, rows: int) -> Iterator[bytes]:
    """Rows of byte-compressed cells, a piece of the source at a time, until ``rows`` or more are given; a negative number: all.

    Eight codes fill a cell of the file, and the literal cells that they call for follow. Where each group begins
    depends on the one before; all else is done for a piece at once.
    """
    fill, spaces = struct.pack(d.order + "d", SYSMIS), b" " * 8
    plain = np.frombuffer(b"".join([spaces, *(struct.pack(d.order + "d", code - d.bias) for code in range(1, 252)), spaces, spaces, spaces, fill]), dtype="V8")
    held, out, given, ended = b"", b"", 0, False
    while not ended and (rows < 0 or given < rows):
        piece = next(source, b"")
        held += piece
        cells = np.frombuffer(held, dtype="V8", count=len(held) // 8)
        codes = cells.view(np.uint8).reshape(-1, 8)
        literal = (codes == 253).sum(axis=1)
        steps, groups, at = (literal + 1).tolist(), [], 0
        while at < len(steps) and at + steps[at] <= len(steps):
            groups.append(at)
            at += steps[at]
        begun = not piece and at < len(steps)  # the last group lacks cells
        if begun:
            groups.append(at)
        first = np.array(groups, dtype=np.int64)
        own, calls = codes[first].reshape(-1), (codes[first] == 253).reshape(-1)
        rank = np.cumsum(calls.reshape(-1, 8), axis=1).reshape(-1)
        found = plain[own]
        places = np.repeat(first, 8)[calls] + rank[calls]
        there = places < len(cells)
        stop = np.flatnonzero(own == 252).tolist() + np.flatnonzero(calls)[~there].tolist()
        found[np.flatnonzero(calls)[there]] = cells[places[there]]
        kept = own != 0
        if stop:
            kept[min(stop) :] = False
            ended = True
        out += found[kept].tobytes()
        held = held[8 * at :]
        cut = len(out) // d.row_size * d.row_size if d.row_size else 0
        if cut:
            given += cut // d.row_size
            yield out[:cut]
            out = out[cut:]
        ended = ended or not piece


def _blocks(file: BinaryIO, d: Dictionary, first: int, count: int) -> Iterator[bytes]:
    """Bytes of whole rows from ``first`` on."""
    if not d.compression:
        file.seek(d.data_start + first * d.row_size)
        left = count
        while left:
            n = min(ROWS, left) if left > 0 else ROWS
            raw = exactly(file, n * d.row_size)
            yield raw[: len(raw) // d.row_size * d.row_size]
            if len(raw) < n * d.row_size:
                return
            left -= n if left > 0 else 0
        return
    file.seek(d.data_start)
    skip = first * d.row_size
    for raw in _plain_rows(_inflated(file, d) if d.compression == 2 else _chunks(file), d, first + count if count >= 0 else -1):
        if skip >= len(raw):
            skip -= len(raw)
        else:
            yield raw[skip:]
            skip = 0


def read_rows(file: BinaryIO, d: Dictionary, names: list[str], first: int, count: int, tags: bool = False) -> Iterator[pa.RecordBatch]:
    """Batches of rows with stored numbers, system-missing ones null; a negative count: all that follow."""
    by_name = {v.name: v for v in d.variables}
    wanted = [by_name[n] for n in names]
    fields, at = [], []
    for i, v in enumerate(wanted):
        if v.kind == "double":
            fields.append((f"f{i}", d.order + "f8", v.start))
        elif not v.long_string:
            fields.append((f"f{i}", f"S{v.width}", v.start))
        else:  # segments of 255 bytes in cells of 256
            fields += [(f"f{i}_{k}", f"S{_SEGMENT}", v.start + k * 256) for k in range(-(-v.width // _STEP))]
    at = [f[0] for f in fields]
    limit = d.row_size
    dtype = np.dtype({"names": at, "formats": [f"S{min(int(f[1][1:]), limit - f[2])}" if f[1][0] == "S" else f[1] for f in fields], "offsets": [f[2] for f in fields], "itemsize": limit}) if limit else np.dtype([])
    left = count
    for raw in _blocks(file, d, first, count):
        n = len(raw) // limit if limit else 0
        n = min(n, left) if count >= 0 else n
        left -= n
        table = np.frombuffer(raw, dtype=dtype, count=n)
        arrays = []
        for i, v in enumerate(wanted):
            if v.kind == "double":
                values = table[f"f{i}"].astype("=f8")
                arrays.append(pa.array(values, KINDS["double"][1], mask=values == SYSMIS))
            elif not v.long_string:
                arrays.append(strings(np.array([x.rstrip(b" \0") for x in table[f"f{i}"].tolist()], dtype=object), d.encoding))
            else:
                parts = [[x.ljust(_SEGMENT) for x in table[f"f{i}_{k}"].tolist()] for k in range(-(-v.width // _STEP))]
                arrays.append(strings(np.array([b"".join(x)[: v.width].rstrip(b" \0") for x in zip(*parts, strict=True)], dtype=object), d.encoding))
        yield pa.RecordBatch.from_arrays(arrays, names=list(names)) if arrays else pa.RecordBatch.from_struct_array(pa.array([{}] * n, pa.struct([])))
        if count >= 0 and left <= 0:
            return
    if count > 0 and left > 0:
        raise StatError("the file ends within its rows")


def segments(width: int) -> list[int]:
    """Widths of the variables that hold a string of ``width`` bytes."""
    if width <= _SEGMENT:
        return [width]
    n = -(-width // _STEP)
    return [_SEGMENT] * (n - 1) + [width - (n - 1) * _STEP]


def _cells(p: ColumnPlan) -> list[int]:
    """Bytes of each segment in a row; numbers have one cell."""
    return [-(-w // 8) * 8 for w in segments(p.width)] if p.stored == "string" else [8]


def row_size(plan: WritePlan) -> int:
    return sum(sum(_cells(p)) for p in plan.columns)


def encode_rows(batch: pa.RecordBatch, plan: WritePlan) -> bytes:
    """Rows of planned values as they stand in an uncompressed file."""
    out = np.full((batch.num_rows, row_size(plan)), 32, dtype=np.uint8)
    at = 0
    for column, p in zip(batch.columns, plan.columns, strict=True):
        cells = _cells(p)
        if p.stored == "string":
            raw = column.cast(pa.binary()).to_pylist()
            for x in raw:
                if len(x) > p.width:
                    raise StatError(f"column {p.source!r}: a value of {len(x)} bytes is wider than the column's {p.width}")
            for k, size in enumerate(cells):
                used = min(_SEGMENT, size)
                part = [x[k * _SEGMENT : (k + 1) * _SEGMENT][:used].ljust(used) for x in raw]
                if part:
                    out[:, at : at + used] = np.frombuffer(b"".join(part), dtype=np.uint8).reshape(len(raw), used)
                at += size
        else:
            null = column.is_null().to_numpy(zero_copy_only=False)
            values = column.fill_null(0).to_numpy(zero_copy_only=False).astype("<f8")
            values[null | np.isnan(values)] = SYSMIS
            out[:, at : at + 8] = values.view(np.uint8).reshape(-1, 8)
            at += 8
    return out.tobytes()


def compress_rows(raw: bytes, strings_at: np.ndarray) -> bytes:
    """Cells of whole rows as byte codes, eight to a group, with literal cells behind each group.

    ``strings_at`` marks the cells of a row that hold text. The last group is filled up with codes
    that stand for nothing, so parts can follow each other.
    """
    cells = np.frombuffer(raw, dtype="<u8")
    text = np.tile(strings_at, len(cells) // max(1, len(strings_at)))
    numbers = cells.view("<f8")
    with np.errstate(invalid="ignore"):
        small = ~text & (numbers >= -99) & (numbers <= 151) & (np.rint(numbers) == numbers) & ~((numbers == 0) & (cells != 0))
    codes = np.full(len(cells), 253, dtype=np.uint8)
    codes[small] = (numbers[small] + 100).astype(np.uint8)
    codes[~text & (numbers == SYSMIS)] = 255
    codes[text & (cells == 0x2020202020202020)] = 254
    pad = -len(codes) % 8
    codes = np.append(codes, np.zeros(pad, dtype=np.uint8)).reshape(-1, 8)
    literal = codes == 253
    counts = literal.sum(axis=1)
    sizes = 1 + counts
    out = np.zeros(int(sizes.sum()), dtype="<u8")
    starts = np.cumsum(sizes) - sizes
    out[starts] = codes.reshape(-1).view("<u8")
    kept = cells[literal.reshape(-1)[: len(cells)]]
    within = np.arange(len(kept)) - np.repeat(np.cumsum(counts) - counts, counts)
    out[np.repeat(starts, counts) + 1 + within] = kept
    return out.tobytes()


def string_cells(plan: WritePlan) -> np.ndarray:
    return np.array([p.stored == "string" for p in plan.columns for size in _cells(p) for _ in range(size // 8)], dtype=bool)


def _record(sub: int, size: int, body: bytes) -> bytes:
    return struct.pack("<4i", 7, sub, size, len(body) // size) + body


def header(plan: WritePlan, rows: int, compression: int = 0) -> bytes:
    """The whole dictionary."""
    out = [struct.pack("<4s60s4i", b"$FL3" if compression == 2 else b"$FL2", b"@(#) SPSS DATA FILE statloom".ljust(60), 2, row_size(plan) // 8, compression, 0)]
    out.append(struct.pack("<id9s8s64s3s", rows if rows < 1 << 31 else -1, 100.0, b"01 Jan 70", b"00:00:00", (plan.file_label or "").encode().ljust(64), b"   "))
    shorts, display, cell = {}, [], 1
    long_names, very_long, index = [], [], {}
    for i, p in enumerate(plan.columns):
        shorts[p.name] = short = f"V{i:07d}"
        long_names.append(f"{short}={p.name}")
        index[p.name] = cell
        parts = segments(p.width) if p.stored == "string" else [0]
        if len(parts) > 1:
            very_long.append(f"{short}={p.width:05d}\0\t")
        code = format_code(p.display, min(p.width, 255), p.stored == "string")
        for k, width in enumerate(parts):
            label = (p.label or "").encode() if not k else b""
            wide = p.stored == "string" and p.width > 8
            discrete = [] if k or wide else p.discrete
            span = None if k else p.span
            count = len(discrete) if span is None else -2 - len(discrete)
            shown = code if len(parts) == 1 else format_code(None, min(width, 255), True)
            name = short if not k else f"S{cell:07d}"
            out.append(struct.pack("<6i8s", 2, width, bool(label), count, shown, shown, name.encode()))
            if label:
                out.append(struct.pack("<i", len(label)) + label.ljust(-(-len(label) // 4) * 4))
            ends = [] if span is None else [LOWEST if span[0] == float("-inf") else span[0], HIGHEST if span[1] == float("inf") else span[1]]
            for v in [*ends, *discrete]:
                out.append(v.encode().ljust(8)[:8] if isinstance(v, str) else struct.pack("<d", float(v)))
            cells = -(-width // 8) if width else 1
            out += [struct.pack("<6i8s", 2, -1, 0, 0, 0, 0, b" " * 8)] * (cells - 1)
            cell += cells
            alignment = p.alignment if p.alignment != "unknown" else "left" if p.stored == "string" else "right"
            display += [_MEASURES.index(p.measure), p.display_width or min(max(width, 1), 40) if p.stored == "string" else p.display_width or 8, _ALIGNMENTS.index(alignment)]
    wide_labels = b""
    by_name = {p.name: p for p in plan.columns}
    for s in plan.label_sets:
        members = [p for p in plan.columns if p.label_set == s.name]
        narrow = [index[p.name] for p in members if p.stored != "string" or p.width <= 8]
        if narrow:
            out.append(struct.pack("<2i", 3, len(s.labels)))
            for value, label in s.labels:
                raw = label.encode()
                size = -(-(len(raw) + 1) // 8) * 8 - 1
                out.append((value.encode().ljust(8)[:8] if isinstance(value, str) else struct.pack("<d", float(value))) + bytes([len(raw)]) + raw.ljust(size))
            out.append(struct.pack(f"<2i{len(narrow)}i", 4, len(narrow), *narrow))
        for p in members:
            if index[p.name] not in narrow:
                sized = lambda b: struct.pack("<i", len(b)) + b
                wide_labels += sized(p.name.encode()) + struct.pack("<2i", p.width, len(s.labels))
                wide_labels += b"".join(sized(str(v).encode().ljust(min(p.width, 255))) + sized(t.encode()) for v, t in s.labels)
    if plan.notes:
        out.append(struct.pack("<2i", 6, len(plan.notes)) + b"".join(n.encode().ljust(80)[:80] for n in plan.notes))
    out.append(_record(3, 4, struct.pack("<8i", 1, 0, 0, -1, 1, 1, 2, 65001)))
    out.append(_record(4, 8, struct.pack("<3d", SYSMIS, HIGHEST, LOWEST)))
    out.append(_record(11, 4, struct.pack(f"<{len(display)}i", *display)))
    out.append(_record(13, 1, "\t".join(long_names).encode()))
    if very_long:
        out.append(_record(14, 1, "".join(very_long).encode()))
    out.append(_record(16, 8, struct.pack("<2q", 1, rows)))
    out.append(_record(20, 1, b"UTF-8"))
    if wide_labels:
        out.append(_record(21, 1, wide_labels))
    wide_missing = b""
    for p in by_name.values():
        if p.stored == "string" and p.width > 8 and p.discrete:
            name = p.name.encode()
            wide_missing += struct.pack("<i", len(name)) + name + bytes([len(p.discrete)]) + struct.pack("<i", 8) + b"".join(str(v).encode().ljust(8)[:8] for v in p.discrete)
    if wide_missing:
        out.append(_record(22, 1, wide_missing))
    out.append(struct.pack("<2i", 999, 0))
    return b"".join(out)


class Zlib:
    """Parts of a ``.zsav`` file's data: blocks behind a header, and a list of them at the end."""

    def __init__(self, start: int):
        self.start, self.plain, self.at, self.held, self.entries = start, start, start + 24, b"", []

    def add(self, data: bytes, last: bool = False) -> bytes:
        self.held += data
        out = []
        while len(self.held) >= _BLOCK or last and self.held:
            block, self.held = self.held[:_BLOCK], self.held[_BLOCK:]
            packed = zlib.compress(block)
            self.entries.append((self.plain, self.at, len(block), len(packed)))
            self.plain += len(block)
            self.at += len(packed)
            out.append(packed)
        return b"".join(out)

    def trailer(self) -> bytes:
        return struct.pack("<2q2i", -100, 0, _BLOCK, len(self.entries)) + b"".join(struct.pack("<2q2i", *e) for e in self.entries)

    def head(self) -> bytes:
        return struct.pack("<3q", self.start, self.at, 24 + 24 * len(self.entries))
