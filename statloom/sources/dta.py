"""Stata's ``.dta`` files, releases 104 to 119 to read and 118 to write, by the published descriptions of the format."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa

from ..errors import StatError
from ..metadata import Metadata
from ..plans.write_plan import WritePlan
from .base import KINDS, ROWS, Dictionary, Variable, exactly, known_encoding, strings

# Fixed values of the format.
_TYPES = {65530: ("byte", 1), 65529: ("int", 2), 65528: ("long", 4), 65527: ("float", 4), 65526: ("double", 8)}
_CODES = {kind: code for code, (kind, _) in _TYPES.items()}
_STRL = 32768
_LAYOUT = {  # bytes of a name, format, label of a variable
    117: (33, 49, 81),
    118: (129, 57, 321),
    119: (129, 57, 321),
}
#: The code of ``.``, and the distance to ``.a``, ``.b``, ..., as unsigned numbers.
_DOT = {"byte": (101, 1), "int": (32_741, 1), "long": (2_147_483_621, 1), "float": (0x7F000000, 0x800), "double": (0x7FE0000000000000, 0x10000000000)}
#: Before release 113 there was one missing value, and it stood one higher.
_OLD_DOT = _DOT | {"byte": (127, 1), "int": (32_767, 1), "long": (2_147_483_647, 1)}
_OLD = (104, 105, 108, 111, 113, 114, 115)
#: Types of variables in releases 111 to 115, and the letters of those before; others are the bytes of a text.
_OLD_TYPES = {251: ("byte", 1), 252: ("int", 2), 253: ("long", 4), 254: ("float", 4), 255: ("double", 8)}
_LETTERS = {ord(letter): shape for letter, shape in zip("bilfd", _OLD_TYPES.values(), strict=True)}
_DTYPE = {"byte": "i1", "int": "i2", "long": "i4", "float": "f4", "double": "f8"}
_BITS = {"float": "u4", "double": "u8"}


class _Cursor:
    def __init__(self, file: BinaryIO):
        self.file, self.order, self.encoding = file, "<", "utf-8"

    def take(self, n: int) -> bytes:
        data = exactly(self.file, n)
        if len(data) < n:
            raise StatError("the file ends within its header")
        return data

    def tag(self, name: str) -> None:
        wanted = f"<{name}>".encode()
        if (found := self.take(len(wanted))) != wanted:
            raise StatError(f"expected {wanted.decode()}, found {found[:40]!r}")

    def number(self, code: str) -> int:
        return struct.unpack(self.order + code, self.take(struct.calcsize("<" + code)))[0]

    def text(self, size: int) -> str:
        return self.words(self.take(size))

    def words(self, raw: bytes) -> str:
        """Up to the first zero byte, in the file's encoding."""
        return raw.split(b"\0", 1)[0].decode(self.encoding, "replace")


def read_dictionary(file: BinaryIO, encoding: str | None = None) -> Dictionary:
    """Header, names, formats and labels; the position of the file is lost."""
    c = _Cursor(file)
    start = file.tell()
    if (release := c.take(1)[0]) in _OLD:
        return _old_dictionary(c, release, encoding)
    file.seek(start)
    c.tag("stata_dta"), c.tag("header"), c.tag("release")
    try:
        version = int(c.take(3))
    except ValueError:
        raise StatError("the file has no release number") from None
    if version not in _LAYOUT:
        raise StatError(f"release {version} of .dta is not supported")
    usual = "utf-8" if version > 117 else "cp1252"
    c.encoding, warned = known_encoding(encoding or usual, usual)
    c.tag("/release"), c.tag("byteorder")
    c.order = "<" if c.take(3) == b"LSF" else ">"
    c.tag("/byteorder"), c.tag("K")
    k = c.number("I" if version == 119 else "H")
    c.tag("/K"), c.tag("N")
    n = c.number("I" if version == 117 else "Q")
    c.tag("/N"), c.tag("label")
    file_label = c.take(c.number("B" if version == 117 else "H")).decode(c.encoding, "replace")
    c.tag("/label"), c.tag("timestamp")
    c.take(c.number("B"))
    c.tag("/timestamp"), c.tag("/header"), c.tag("map")
    places = [c.number("Q") for _ in range(14)]
    c.tag("/map"), c.tag("variable_types")
    codes = [c.number("H") for _ in range(k)]
    name, form, label = _LAYOUT[version]
    c.tag("/variable_types"), c.tag("varnames")
    names = [c.text(name) for _ in range(k)]
    c.tag("/varnames"), c.tag("sortlist")
    c.take((k + 1) * (4 if version == 119 else 2))
    c.tag("/sortlist"), c.tag("formats")
    formats = [c.text(form) for _ in range(k)]
    c.tag("/formats"), c.tag("value_label_names")
    sets = [c.text(name) for _ in range(k)]
    c.tag("/value_label_names"), c.tag("variable_labels")
    labels = [c.text(label) for _ in range(k)]
    c.tag("/variable_labels"), c.tag("characteristics")
    notes: dict[int, str] = {}
    while (mark := c.take(4)) == b"<ch>":
        body = c.take(c.number("I"))
        owner, key, text = c.words(body[:name]), c.words(body[name : 2 * name]), c.words(body[2 * name :])
        if owner == "_dta" and key[:4] == "note" and key[4:].isdigit() and key != "note0":
            notes[int(key[4:])] = text
        c.tag("/ch")
    c.take(len("</characteristics>") - len(mark))
    c.tag("data")
    data_start = file.tell()
    variables, at = [], 0
    for i, code in enumerate(codes):
        kind, size = _TYPES.get(code, ("string", 8 if code == _STRL else code))
        if kind == "string" and code != _STRL and not 0 < code <= 2045:
            raise StatError(f"variable {names[i]!r} has the unknown type {code}")
        variables.append(Variable(names[i] or f"V{i}", kind, size, at, code == _STRL))
        at += size
    metadata = Metadata(
        variable_labels={v.name: x for v, x in zip(variables, labels, strict=True) if x},
        formats={v.name: x for v, x in zip(variables, formats, strict=True) if x},
        storage_widths={v.name: v.width for v in variables},
        file_label=file_label or None,
        notes=[notes[i] for i in sorted(notes)],
    )
    # labels stand behind the rows
    file.seek(start + places[11])
    found = _value_labels(c, name)
    metadata.value_labels = {v.name: [dict(x) for x in found[s]] for v, s in zip(variables, sets, strict=True) if s in found}
    return Dictionary("dta", variables, metadata, n, at, data_start, c.encoding, c.order, version=version, long_strings=(start + places[10], start + places[11]), warnings=warned)


def _value_labels(c: _Cursor, name: int) -> dict[str, list[dict]]:
    found = {}
    c.tag("value_labels")
    while c.take(5) == b"<lbl>":
        c.number("I")
        title, codes = _label_table(c, name)
        c.tag("/lbl")
        found[title] = codes
    return found


def _label_table(c: _Cursor, name: int) -> tuple[str, list[dict]]:
    title = c.text(name)
    c.take(3)
    n, size = c.number("I"), c.number("I")
    at = [c.number("I") for _ in range(n)]
    values = [c.number("i") for _ in range(n)]
    texts = c.take(size)
    dot = _DOT["long"][0]
    return title, [{"value": chr(96 + v - dot) if dot < v <= dot + 26 else v, "label": c.words(texts[o:])} for v, o in sorted(zip(values, at, strict=True))]


def _old_dictionary(c: _Cursor, release: int, encoding: str | None) -> Dictionary:
    """Of a release up to 115, where all has a fixed place and labels of values stand behind the rows."""
    c.encoding, warned = known_encoding(encoding or "cp1252", "cp1252")
    c.order = ">" if c.take(1) == b"\1" else "<"
    c.take(2)
    k, n = c.number("H"), c.number("I")
    name, title = (33 if release > 108 else 9), (81 if release > 105 else 32)
    file_label = c.text(title)
    if release > 104:
        c.text(18)  # when it was written
    codes = c.take(k)
    names = [c.text(name) for _ in range(k)]
    c.take(2 * (k + 1))
    formats = [c.text(49 if release > 113 else 12 if release > 104 else 7) for _ in range(k)]
    sets = [c.text(name) for _ in range(k)]
    labels = [c.text(title) for _ in range(k)]
    notes: dict[int, str] = {}
    while release > 104:
        kind, size = c.number("B"), c.number("I" if release > 108 else "H")
        if not kind and not size:
            break
        body = c.take(size)
        owner, key, text = c.words(body[:name]), c.words(body[name : 2 * name]), c.words(body[2 * name :])
        if owner == "_dta" and key[:4] == "note" and key[4:].isdigit() and key != "note0":
            notes[int(key[4:])] = text
    variables, at = [], 0
    for i, code in enumerate(codes):
        kind, size = (_OLD_TYPES if release > 108 else _LETTERS).get(code, ("string", code if release > 108 else code - 127))
        if kind == "string" and not 0 < size <= 244:
            raise StatError(f"variable {names[i]!r} has the unknown type {code}")
        variables.append(Variable(names[i] or f"V{i}", kind, size, at))
        at += size
    metadata = Metadata(
        variable_labels={v.name: x for v, x in zip(variables, labels, strict=True) if x},
        formats={v.name: x for v, x in zip(variables, formats, strict=True) if x},
        storage_widths={v.name: v.width for v in variables},
        file_label=file_label or None,
        notes=[notes[i] for i in sorted(notes)],
    )
    data_start = c.file.tell()
    if release > 105:
        c.file.seek(data_start + n * at)
        found = {}
        while len(exactly(c.file, 4)) == 4:  # the length of the next table
            of, codes_of = _label_table(c, name)
            found[of] = codes_of
        metadata.value_labels = {v.name: [dict(x) for x in found[s]] for v, s in zip(variables, sets, strict=True) if s in found}
    elif any(sets):
        warned = [*warned, f"labels of values are not read from release {release} of .dta"]
    return Dictionary("dta", variables, metadata, n, at, data_start, c.encoding, c.order, version=release, warnings=warned)


def _long_strings(file: BinaryIO, d: Dictionary) -> dict[bytes, str]:
    """Long strings by their references as they stand in the rows."""
    file.seek(d.long_strings[0])
    c = _Cursor(file)
    c.order = d.order
    c.tag("strls")
    found = {}
    wide = 8 if d.version == 117 else 12
    while c.take(3) == b"GSO":
        key = c.take(wide)
        kind, size = c.number("B"), c.number("I")
        body = c.take(size)
        v, o = struct.unpack(d.order + ("II" if wide == 8 else "IQ"), key)
        if wide == 8:
            cell = struct.pack(d.order + "II", v, o)
        else:
            n = 3 if d.version == 119 else 2
            a, b = v.to_bytes(4, "little")[:n], o.to_bytes(8, "little")[: 8 - n]
            cell = a + b if d.order == "<" else a[::-1] + b[::-1]
        found[cell] = (body[:-1] if kind == 130 else body).decode(d.encoding, "replace")
    return found


def read_rows(file: BinaryIO, d: Dictionary, names: list[str], first: int, count: int, tags: bool = False) -> Iterator[pa.RecordBatch]:
    """Batches of rows ``first`` to ``first + count`` with stored numbers; with ``tags`` a code column beside each number."""
    by_name = {v.name: v for v in d.variables}
    wanted = [by_name[n] for n in names]
    texts = _long_strings(file, d) if any(v.long_string for v in wanted) else {}
    dots = _DOT if d.version > 112 else _OLD_DOT
    dtype = np.dtype({"names": [f"f{i}" for i in range(len(wanted))], "formats": [f"S{v.width}" if v.kind == "string" else d.order + _DTYPE[v.kind] for v in wanted], "offsets": [v.start for v in wanted], "itemsize": d.row_size})
    file.seek(d.data_start + first * d.row_size)
    while count > 0:
        n = min(ROWS, count)
        raw = exactly(file, n * d.row_size)
        short, n = len(raw) < n * d.row_size, len(raw) // d.row_size if d.row_size else n
        table = np.frombuffer(raw, dtype=dtype, count=n) if d.row_size and n else np.zeros(n, dtype=dtype)
        arrays, titles = [], []
        for i, v in enumerate(wanted):
            if v.long_string:
                cells = np.frombuffer(raw, dtype=np.dtype({"names": ["x"], "formats": ["V8"], "offsets": [v.start], "itemsize": d.row_size}), count=n)["x"]
                arrays.append(pa.array([texts.get(x.tobytes(), "") for x in cells], pa.string()))
            elif v.kind == "string":
                arrays.append(strings(np.array([x.split(b"\0", 1)[0] for x in table[f"f{i}"].tolist()], dtype=object), d.encoding))
            else:
                values = table[f"f{i}"]
                dot, step = dots[v.kind]
                code = values.astype(values.dtype.newbyteorder("=")).view(_BITS[v.kind]).astype(np.uint64) if v.kind in _BITS else values.astype(np.int64)
                missing = (code >= dot) & (code < 1 << (np.dtype(_BITS[v.kind]).itemsize * 8 - 1)) if v.kind in _BITS else code >= dot
                arrays.append(pa.array(values.astype(values.dtype.newbyteorder("=")), KINDS[v.kind][1], mask=missing))
                if tags:
                    titles.append(v.name)
                    arrays.append(pa.array(np.where(missing, (code.astype(object) - dot) // step if v.kind == "double" else (code.astype(np.int64) - dot) // step, 0).astype(np.int8) if missing.any() else np.zeros(n, dtype=np.int8)))
                    titles.append(f"{v.name}\0tag")
                    continue
            titles.append(v.name)
        yield pa.RecordBatch.from_arrays(arrays, names=titles) if arrays else pa.RecordBatch.from_struct_array(pa.array([{}] * n, pa.struct([])))
        if short:
            raise StatError("the file ends within its rows")
        count -= n


def _default_format(kind: str, width: int) -> str:
    # Stata's own defaults; fixed values
    return {"byte": "%8.0g", "int": "%8.0g", "long": "%12.0g", "float": "%9.0g", "double": "%10.0g"}.get(kind) or f"%{max(1, min(width, 244))}s"


def _field(text: str, size: int) -> bytes:
    return text.encode()[: size - 1].ljust(size, b"\0")


def row_dtype(plan: WritePlan) -> np.dtype:
    return np.dtype([(f"f{i}", f"S{p.width}" if p.stored == "string" else "<" + _DTYPE[p.stored]) for i, p in enumerate(plan.columns)])


def encode_rows(batch: pa.RecordBatch, plan: WritePlan) -> bytes:
    """Rows of planned values as they stand in the file."""
    dtype = row_dtype(plan)
    out = np.zeros(batch.num_rows, dtype=dtype)
    at = 0
    for i, p in enumerate(plan.columns):
        column = batch.column(at)
        at += 1
        if p.stored == "string":
            raw = column.cast(pa.binary()).to_pylist()
            for x in raw:
                if len(x) > p.width:
                    raise StatError(f"column {p.source!r}: a value of {len(x)} bytes is wider than the column's {p.width}")
            out[f"f{i}"] = raw
            continue
        dot, step = _DOT[p.stored]
        null = column.is_null().to_numpy(zero_copy_only=False)
        values = column.fill_null(0).to_numpy(zero_copy_only=False)
        code = np.zeros(len(values), dtype=np.int64)
        if p.tagged:
            code = batch.column(at).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            at += 1
        if p.stored in _BITS:
            null = null | np.isnan(values)
            bits = np.array(values, dtype=_DTYPE[p.stored]).view(_BITS[p.stored])
            # what lies beyond the largest legal value would read as missing
            high = (bits >= dot) & (bits < np.array(1 << (bits.itemsize * 8 - 1), dtype=bits.dtype)) & ~null
            if high.any():
                raise StatError(f"column {p.source!r}: {values[high][0]} is outside of Stata's {p.stored}")
            bits = bits.copy()
            bits[null] = (dot + code[null] * step).astype(bits.dtype)
            out[f"f{i}"] = bits.view(_DTYPE[p.stored])
        else:
            out[f"f{i}"] = np.where(null, dot + code * step, values)
    return out.tobytes()


def header(plan: WritePlan, rows: int) -> bytes:
    """All that stands before the rows; ``footer`` ends the file."""
    return _ends(plan, rows)[0]


def footer(plan: WritePlan, rows: int) -> bytes:
    return _ends(plan, rows)[1]


def _ends(plan: WritePlan, rows: int) -> tuple[bytes, bytes]:
    name, form, label = _LAYOUT[118]
    columns = plan.columns
    k = len(columns)
    wrap = lambda tag, body: f"<{tag}>".encode() + body + f"</{tag}>".encode()
    title = (plan.file_label or "").encode()
    head = b"<stata_dta>" + wrap("header", wrap("release", b"118") + wrap("byteorder", b"LSF") + wrap("K", struct.pack("<H", k)) + wrap("N", struct.pack("<Q", rows)) + wrap("label", struct.pack("<H", len(title)) + title) + wrap("timestamp", b"\0"))
    formats = [p.display or _default_format(p.stored, p.width) for p in columns]
    chars = [("note0", str(len(plan.notes)))] if plan.notes else []
    chars += [(f"note{i}", n) for i, n in enumerate(plan.notes, 1)]
    bodies = [_field("_dta", name) + _field(key, name) + text.encode() + b"\0" for key, text in chars]
    sections = [
        wrap("variable_types", struct.pack(f"<{k}H", *(p.width if p.stored == "string" else _CODES[p.stored] for p in columns))),
        wrap("varnames", b"".join(_field(p.name, name) for p in columns)),
        wrap("sortlist", b"\0\0" * (k + 1)),
        wrap("formats", b"".join(_field(f, form) for f in formats)),
        wrap("value_label_names", b"".join(_field(p.label_set or "", name) for p in columns)),
        wrap("variable_labels", b"".join(_field(p.label or "", label) for p in columns)),
        wrap("characteristics", b"".join(wrap("ch", struct.pack("<I", len(b)) + b) for b in bodies)),
    ]
    tables = []
    for s in plan.label_sets:
        entries = sorted([(v, t) for v, t in s.labels] + [(_DOT["long"][0] + ord(tag) - 96, t) for tag, t in s.tags])
        texts = [t.encode() + b"\0" for _, t in entries]
        offsets = np.cumsum([0, *map(len, texts)])[:-1].tolist() if texts else []
        body = struct.pack(f"<II{len(entries)}I{len(entries)}i", len(entries), sum(map(len, texts)), *offsets, *(v for v, _ in entries)) + b"".join(texts)
        tables.append(wrap("lbl", struct.pack("<I", len(body)) + _field(s.name, name) + b"\0\0\0" + body))
    data = len(b"<data></data>") + rows * row_dtype(plan).itemsize
    tail = [wrap("strls", b""), wrap("value_labels", b"".join(tables))]
    places, at = [0, len(head)], len(head) + len(wrap("map", b"\0" * 112))
    for part in [*map(len, sections), data, *map(len, tail)]:
        places.append(at)
        at += part
    places += [at, at + len(b"</stata_dta>")]
    return head + wrap("map", struct.pack("<14Q", *places)) + b"".join(sections) + b"<data>", b"</data>" + b"".join(tail) + b"</stata_dta>"
