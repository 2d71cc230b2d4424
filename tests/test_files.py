import datetime as dt
import io
import math
import struct
import zipfile

import pandas as pd
import numpy as np
import pytest

import statloom as sl

ROWS = [
    ("a", 1.1, dt.date(2018, 5, 6), dt.datetime(2018, 5, 6, 10, 10, 10), 1.0, 1.0, "x" * 300),
    ("b", 1.2, dt.date(1880, 5, 6), dt.datetime(1880, 5, 6, 10, 10, 10), 2.0, 2.0, ""),
    ("日本", -1000.3, dt.date(1960, 1, 1), dt.datetime(1960, 1, 1), 1.0, 3.0, "é" * 400),
    ("d", -1.4, dt.date(1583, 1, 1), dt.datetime(1583, 1, 1), 2.0, 1.0, None),
    (None, None, None, None, None, None, "end"),
]
SCHEMA = "mychar string, mynum double, mydate date, dtime timestamp_ntz, mylabl double, myord double, wide string"
EXPECTED = [tuple("" if v is None and k in (0, 6) else v for k, v in enumerate(r)) for r in ROWS]
META = sl.Metadata(
    variable_labels={"mynum": "A number"},
    value_labels={"mylabl": [{"value": 1, "label": "Male"}, {"value": 2, "label": "Female"}]},
    measures={"myord": "ordinal"},
    alignments={"mynum": "center"},
    display_widths={"mynum": 12},
    file_label="Survey",
    notes=["first", "second"],
)
KINDS = [("sav", "none"), ("sav", "rows"), ("zsav", "zlib"), ("dta", "none")]


def write(kind, path, df, metadata=None, compression="none", **options):
    if kind == "dta":
        return sl.write_dta(path, df, metadata, **options)
    return sl.write_sav(path, df, metadata, compression=compression, **options)


def reader(kind):
    return sl.read_dta if kind == "dta" else sl.read_sav


@pytest.fixture(scope="module")
def survey(spark):
    return spark.createDataFrame(ROWS, SCHEMA).coalesce(1)


@pytest.fixture(params=KINDS, ids=lambda k: "-".join(k), scope="module")
def file(request, survey, tmp_path_factory):
    kind, compression = request.param
    path = tmp_path_factory.mktemp("files") / f"survey.{kind}"
    write(kind, path, survey, META, compression)
    return kind, path


def test_round_trip(spark, file):
    kind, path = file
    df, meta = reader(kind)(spark, path)
    assert [tuple(r) for r in df.collect()] == EXPECTED
    assert df.schema.simpleString() == "struct<mychar:string,mynum:double,mydate:date,dtime:timestamp_ntz,mylabl:double,myord:double,wide:string>"
    assert meta.variable_labels == {"mynum": "A number"} and meta.file_label == "Survey" and meta.notes == ["first", "second"]
    assert meta.value_labels == META.value_labels
    if kind != "dta":
        assert meta.measures == {"myord": "ordinal"} and meta.alignments["mynum"] == "center" and meta.display_widths["mynum"] == 12
        assert meta.storage_widths["wide"] == 800 and meta.formats["wide"] == "A800"


def test_stored_layout(file):
    kind, path = file
    raw = path.read_bytes()
    if kind == "dta":
        assert raw.startswith(b"<stata_dta><header><release>118</release>")
        found = pd.read_stata(path)
        assert found["mychar"].tolist() == ["a", "b", "日本", "d", ""] and found["mynum"].tolist()[:4] == [1.1, 1.2, -1000.3, -1.4]
        assert found["mylabl"].tolist()[:2] == ["Male", "Female"]
    else:
        assert raw[:4] == (b"$FL3" if kind == "zsav" else b"$FL2") and struct.unpack_from("<i", raw, 72)[0] in ((2,) if kind == "zsav" else (0, 1))


def test_options(spark, file):
    kind, path = file
    read = reader(kind)
    df, meta = read(spark, path, columns=["wide", "mynum", "nowhere"], row_offset=1, row_limit=2)
    assert df.columns == ["mynum", "wide"] and [r.mynum for r in df.collect()] == [1.2, -1000.3] and meta.value_labels == {}
    assert read(spark, path, row_limit=0)[0].count() == 5 and read(spark, path, row_offset=9)[0].count() == 0
    narrow, meta = read(spark, path, scan_and_narrow_types=True)
    assert narrow.schema["mylabl"].dataType.simpleString() == "tinyint" and narrow.schema["mynum"].dataType.simpleString() == "double"
    assert all(isinstance(c["value"], int) for c in meta.value_labels["mylabl"])
    wide, _ = read(spark, path)
    assert narrow.select(*(narrow[f.name].cast(f.dataType).alias(f.name) for f in wide.schema.fields)).collect() == wide.collect()


def test_metadata_only(spark, file):
    kind, path = file
    schema, rows, meta = (sl.read_dta_metadata if kind == "dta" else sl.read_sav_metadata)(spark, path)
    assert rows == 5 and schema.fieldNames()[0] == "mychar" and meta.file_label == "Survey"


def test_batches(spark, file):
    kind, path = file
    opened = (sl.open_dta if kind == "dta" else sl.open_sav)(spark, str(path))
    for size, sizes in ((1, [1] * 5), (2, [2, 2, 1]), (5, [5]), (1000, [5])):
        got = []
        assert opened.read_batches(got.append, batch_rows=size) == 5
        assert [b.num_rows for b in got] == sizes and len({str(b.schema) for b in got}) == 1
        assert [v for b in got for v in b.column("mynum").to_pylist()] == [r[1] for r in ROWS]
    with pytest.raises(ValueError, match="batch_rows"):
        opened.read_batches(print, batch_rows=0)
    with pytest.raises(ZeroDivisionError):
        opened.read_batches(lambda b: 1 / 0)
    assert opened.num_rows == 5 and opened.read_all().count() == 5


def test_file_objects(spark, file):
    kind, path = file
    held = io.BytesIO(b"before" + path.read_bytes())
    held.seek(6)
    assert reader(kind)(spark, held)[0].count() == 5 and held.tell() == 6 and not held.closed
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        z.write(path, "inside")
    with zipfile.ZipFile(packed) as z, z.open("inside") as inside:
        assert reader(kind)(spark, inside)[0].count() == 5

    class Pipe(io.BytesIO):
        def seekable(self):
            return False

    with pytest.raises(ValueError, match="seekable"):
        reader(kind)(spark, Pipe(b""))
    with pytest.raises(sl.StatError):
        reader(kind)(spark, str(path) + ".none")


@pytest.mark.parametrize(("kind", "compression"), KINDS)
def test_no_rows_and_file_objects_out(spark, kind, compression):
    out = io.BytesIO()
    write(kind, out, spark.createDataFrame([], "a double, s string"), None, compression)
    out.seek(0)
    df, _ = reader(kind)(spark, out)
    assert df.count() == 0 and df.columns == ["a", "s"]


def test_truncated_files(spark, survey, tmp_path):
    for kind in ("sav", "dta"):
        path = tmp_path / f"t.{kind}"
        write(kind, path, survey)
        raw = path.read_bytes()
        path.write_bytes(raw[:200])
        with pytest.raises(sl.StatError):
            reader(kind)(spark, path)
    sl.write_sav(tmp_path / "t.sav", survey)
    raw = (tmp_path / "t.sav").read_bytes()
    (tmp_path / "t.sav").write_bytes(raw[:-100])
    with pytest.raises(Exception, match="ends within its rows"):
        sl.read_sav(spark, tmp_path / "t.sav")[0].collect()
    got = []
    with pytest.raises(Exception, match="ends within its rows"):
        sl.open_sav(spark, tmp_path / "t.sav").read_batches(got.append, batch_rows=2)
    assert sum(b.num_rows for b in got) == 4


def test_user_missing(spark, tmp_path):
    df = spark.createDataFrame([(1.0, "Z"), (-1.0, "a"), (2500.0, "b"), (999.0, None)], "n double, s string").coalesce(1)
    meta = sl.Metadata(missing_values={"n": {"lo": 2000, "hi": math.inf, "value": -1}, "s": {"values": ["Z"]}})
    sl.write_sav(tmp_path / "m.sav", df, meta)
    read, back = sl.read_sav(spark, tmp_path / "m.sav")
    assert [tuple(r) for r in read.collect()] == [(1.0, None), (None, "a"), (None, "b"), (999.0, "")]
    assert back.missing_values == meta.missing_values
    kept, _ = sl.read_sav(spark, tmp_path / "m.sav", preserve_user_missing=True)
    assert [r.n for r in kept.collect()] == [1.0, -1.0, 2500.0, 999.0]


def test_tags_and_their_labels(spark, tmp_path):
    cells = [((1, None),), ((None, "a"),), (None,), ((None, "z"),), ((101, None),)]
    for inner in ("tinyint", "smallint", "int", "float", "double"):
        df = spark.createDataFrame([c if c[0] is None or "float" not in inner and inner != "double" else ((c[0][0] and float(c[0][0]), c[0][1]),) for c in cells], f"v struct<value:{inner},tag:string>").coalesce(1)
        labels = [{"value": 1, "label": "one"}, {"value": "a", "label": "refused"}]
        sl.write_dta(tmp_path / "t.dta", df, sl.Metadata(value_labels={"v": labels}))
        read, meta = sl.read_dta(spark, tmp_path / "t.dta", preserve_user_missing=True)
        assert [r.v and tuple(r.v) for r in read.collect()] == [(1, None), (None, "a"), None, (None, "z"), (101, None)]
        assert meta.value_labels["v"] == labels
        assert [r.v for r in sl.read_dta(spark, tmp_path / "t.dta")[0].collect()] == [1, None, None, None, 101]


def test_numbers_at_the_edges(spark, tmp_path):
    df = spark.createDataFrame([(-0.0, 1e300), (151.0, -1e300), (152.0, 0.1), (-99.0, float("nan")), (-100.0, None)], "a double, b double").coalesce(1)
    for kind, compression in KINDS:
        if kind == "dta":
            continue
        write(kind, tmp_path / "e", df, None, compression)
        found = [tuple(r) for r in sl.read_sav(spark, tmp_path / "e")[0].collect()]
        assert found == [(0.0, 1e300), (151.0, -1e300), (152.0, 0.1), (-99.0, None), (-100.0, None)] and math.copysign(1, found[0][0]) == -1
    with pytest.raises(Exception, match="outside of Stata's double"):
        sl.write_dta(tmp_path / "e", spark.createDataFrame([(float("inf"),)], "a double"))
    with pytest.raises(Exception, match="not exact as a double"):
        sl.write_sav(tmp_path / "e", spark.createDataFrame([(2**53 + 1,)], "a bigint"))


def test_many_parts_keep_their_order(spark, tmp_path):
    df = spark.range(0, 150_000, 1, 7).selectExpr("id AS n", "concat('row ', id) AS s")
    for kind, compression in KINDS:
        path = tmp_path / f"many.{kind}"
        write(kind, path, df, None, compression)
        read = spark.read.format("dta" if kind == "dta" else "sav").option("rowsPerPartition", 40_000).load(str(path)) if compression == "none" else sl.read_sav(spark, path)[0]
        assert read.rdd.getNumPartitions() == (4 if compression == "none" else 1)
        found = read.toArrow()
        assert found.column("n").to_pylist() == list(range(150_000)) and found.column("s")[149_999].as_py() == "row 149999"


def test_incremental_writers(spark, tmp_path):
    one, two = (spark.createDataFrame([(k, f"s{k}")], "b tinyint, s string") for k in (1, 2))
    for cls, read in ((sl.SavWriter, sl.read_sav), (sl.DtaWriter, sl.read_dta)):
        path = tmp_path / cls.__name__
        with cls(path, one.schema, 2) as w:
            w.write(one), w.write(two)
            assert w.rows_written == 2
        w.close()
        assert [r.s for r in read(spark, path)[0].collect()] == ["s1", "s2"]
        path.unlink()
        with pytest.raises(sl.StatError, match="more rows"), cls(path, one.schema, 1) as w:
            w.write(one), w.write(two)
        with pytest.raises(sl.StatError, match="1 rows were written"), cls(path, one.schema, 3) as w:
            w.write(one)
        with pytest.raises(ValueError, match="schema"), cls(path, one.schema, 1) as w:
            w.write(one.select("s"))
        with pytest.raises(ValueError, match="negative"):
            cls(path, one.schema, -1)
        assert not list(tmp_path.iterdir()) or not path.exists()
    with pytest.raises(Exception, match="outside of Stata's byte"), sl.DtaWriter(tmp_path / "w", one.schema, 1) as w:
        w.write(spark.createDataFrame([(101, "")], "b tinyint, s string"))
    with sl.DtaWriter(tmp_path / "w", one.schema, 1, variable_ranges={"b": (0, 101)}) as w:
        w.write(spark.createDataFrame([(101, "")], "b tinyint, s string"))
    assert sl.read_dta(spark, tmp_path / "w")[0].first().b == 101


def test_long_values_are_cut_on_request(spark, tmp_path):
    df = spark.createDataFrame([("日" * 1000,)], "s string")
    with pytest.raises(ValueError, match="3000 bytes wide"):
        sl.write_dta(tmp_path / "c", df)
    with pytest.warns(sl.StatWarning):
        sl.write_dta(tmp_path / "c", df, on_text_limits_exceeded="truncate")
    assert sl.read_dta(spark, tmp_path / "c")[0].first().s == "日" * 681


def test_renaming(spark, tmp_path):
    df = spark.createDataFrame([(1.0,)], "`my var` double")
    with pytest.warns(sl.StatWarning, match="1 names are"):
        assert sl.write_sav(tmp_path / "r", df, sl.Metadata(variable_labels={"my var": "V"}), rename_invalid_names=True) == {"my var": "my_var"}
    read, meta = sl.read_sav(spark, tmp_path / "r")
    assert read.columns == ["my_var"] and meta.variable_labels == {"my_var": "V"}


def test_long_string_labels(spark, tmp_path):
    df = spark.createDataFrame([("a long answer",)], "s string")
    labels = [{"value": "a long answer", "label": "long"}]
    sl.write_sav(tmp_path / "l", df, sl.Metadata(value_labels={"s": labels}))
    assert sl.read_sav(spark, tmp_path / "l")[1].value_labels == {"s": labels}


def test_encoding_override(spark, tmp_path):
    sl.write_sav(tmp_path / "x", spark.createDataFrame([("é",)], "s string"))
    assert sl.read_sav(spark, tmp_path / "x", encoding="latin-1")[0].first().s == "Ã©"


def test_tagged_integers_beyond_doubles(spark, tmp_path):
    for schema, row in (("x bigint", (2**53 + 1,)), ("x struct<value:bigint,tag:string>", ((2**53 + 1, None),))):
        with pytest.raises(sl.StatError, match="not exact as a double"):
            sl.write_dta(tmp_path / "x.dta", spark.createDataFrame([row], schema))
    assert not (tmp_path / "x.dta").exists()
    sl.write_dta(tmp_path / "y.dta", spark.createDataFrame([((2**53, None),), ((None, "c"),)], "x struct<value:bigint,tag:string>"))
    back = sl.read_dta(spark, tmp_path / "y.dta", preserve_user_missing=True)[0].collect()
    assert [tuple(r.x) for r in back] == [(2.0**53, None), (None, "c")]


def test_numbers_that_are_no_dates(spark, tmp_path):
    odd = [float("nan"), 1e20, float("inf"), -1e20, None, 86_400.0]
    for kind, write, read, formats in (("sav", sl.write_sav, sl.read_sav, ("DATE11", "DATETIME20", "TIME8", "DTIME11")), ("dta", sl.write_dta, sl.read_dta, ("%td", "%tc", "%tcHH:MM:SS", None))):
        values = odd if kind == "sav" else [None, 8e307, -8e307, 1e20, 1.0]
        df = spark.createDataFrame([(x,) * 4 for x in values], "a double, b double, c double, d double")
        write(tmp_path / f"odd.{kind}", df, sl.Metadata(formats={k: v for k, v in zip("abcd", formats, strict=True) if v}))
        rows = read(spark, tmp_path / f"odd.{kind}")[0].drop("d").collect()
        assert [tuple(r) for r in rows[:-1]] == [(None, None, None)] * (len(values) - 1) and None not in tuple(rows[-1])


def test_missing_ranges_of_one_value(spark, tmp_path):
    df = spark.createDataFrame([(float(k),) for k in range(5)], "x double")
    sl.write_sav(tmp_path / "x.sav", df, sl.Metadata(missing_values={"x": {"lo": 2, "hi": 2, "value": 4}}))
    back, meta = sl.read_sav(spark, tmp_path / "x.sav")
    assert meta.missing_values["x"] == {"values": [2.0, 4.0]} and [r.x for r in back.collect()] == [0, 1, None, 3, None]


def test_long_texts_that_are_missing(spark, tmp_path):
    df = spark.createDataFrame([("abcdefghijkl",), ("abcdefgh",), ("other",)], "x string")
    with pytest.raises(ValueError, match="missing value of column 'x'"):
        sl.write_sav(tmp_path / "x.sav", df, sl.Metadata(missing_values={"x": {"values": ["abcdefghijkl"]}}))
    sl.write_sav(tmp_path / "y.sav", df, sl.Metadata(missing_values={"x": {"values": ["abcdefgh"]}}))
    assert [r.x for r in sl.read_sav(spark, tmp_path / "y.sav")[0].collect()] == ["abcdefghijkl", None, "other"]


def test_encoding_of_names_and_labels(spark, tmp_path):
    import pandas as pd

    path = tmp_path / "old.dta"
    pd.DataFrame({"größe": ["süß", "b"], "n": [1, 2]}).to_stata(path, version=118, write_index=False, variable_labels={"n": "Größe"})
    raw = path.read_bytes()
    df, meta = sl.read_dta(spark, path, encoding="cp1252")
    assert meta.variable_labels["n"] == "Größe".encode().decode("cp1252") and df.columns[0] == "größe".encode().decode("cp1252")
    with pytest.warns(sl.StatWarning, match="unknown encoding"):
        assert sl.read_dta(spark, path, encoding="no-such")[1].variable_labels["n"] == "Größe"
    assert raw == path.read_bytes()


@pytest.mark.parametrize("piece", [24, 100, 1 << 20])
def test_compressed_cells_come_back(piece):
    from statloom.sources import sav
    from statloom.sources.base import Dictionary

    rng = np.random.default_rng(piece)
    for cells in (1, 3, 8):
        numbers = rng.choice([0.0, 1.0, -99.0, 151.0, 152.0, 0.5, sav.SYSMIS, -0.0], (57, cells)).astype("<f8")
        text = rng.random(cells) < 0.4
        numbers[:, text] = np.frombuffer(b"        ", dtype="<f8")[0] if cells % 2 else np.frombuffer(b"abc     ", dtype="<f8")[0]
        raw = numbers.tobytes()
        packed = sav.compress_rows(raw, text)
        d = Dictionary("sav", [], None, 57, 8 * cells, 0, compression=1)
        pieces = iter([packed[k : k + piece] for k in range(0, len(packed), piece)])
        assert b"".join(sav._plain_rows(pieces, d, 57)) == raw
        cut = packed[: len(packed) - 8] if len(packed) > 16 else packed
        assert raw.startswith(b"".join(sav._plain_rows(iter([cut]), d, -1)))


def test_types_that_columns_are_read_as():
    from pyspark.sql import types as T

    from statloom.operators.profile import readable_as

    assert readable_as(T.DoubleType(), "int", "x") == "int" and readable_as(T.StringType(), "string", "x") == "string"
    for kind, to in ((T.StringType(), "int"), (T.DoubleType(), "string"), (T.DoubleType(), "decimal(5,2)")):
        with pytest.raises(ValueError, match="column 'x'"):
            readable_as(kind, to, "x")


@pytest.mark.parametrize(("kind", "compression"), [("dta", "none"), ("sav", "none"), ("sav", "zlib")])
def test_a_folder_of_parts_reads_as_one_table(spark, tmp_path, kind, compression):
    df = spark.range(0, 1000, 1, 5).selectExpr("id AS n", "if(id % 7 = 0, NULL, concat('row ', id)) AS s")
    meta = sl.Metadata(variable_labels={"n": "number"})
    assert sl.write_parts(tmp_path / "parts", df, meta, kind=kind, compression=compression) == 1000
    assert len(list((tmp_path / "parts").iterdir())) == 5
    read, back = reader(kind)(spark, tmp_path / "parts", row_offset=150, row_limit=700)
    assert [r.n for r in read.collect()] == list(range(150, 850)) and back.variable_labels == {"n": "number"}
    everything = reader(kind)(spark, tmp_path / "parts")[0]
    assert everything.count() == 1000 and everything.where("n = 999").first().s == "row 999"
    with pytest.raises(FileExistsError):
        sl.write_parts(tmp_path / "parts", df, kind=kind)
    (tmp_path / "none").mkdir()
    with pytest.raises(sl.StatError, match="no part files"):
        reader(kind)(spark, tmp_path / "none")


def _old_file(release, order, rows):
    """A file of an old release with an int, a double and a text of three bytes; the int has the labels ``yn``."""
    late = release > 108
    name, title, form = (33 if late else 9), (81 if release > 105 else 32), (49 if release > 113 else 12 if release > 104 else 7)
    field = lambda text, size: text.encode("cp1252").ljust(size, b"\0")
    out = bytes([release, 1 if order == ">" else 2, 1, 0]) + struct.pack(order + "HI", 3, len(rows)) + field("Old", title)
    out += field("01 Jan 1999 12:00", 18) if release > 104 else b""
    out += bytes([252, 255, 3]) if late else b"id" + bytes([130])
    out += b"".join(field(n, name) for n in ("code", "score", "word")) + b"\0" * 8
    out += b"".join(field(f, form) for f in ("%8.0g", "%9.0g", "%3s"))
    out += field("yn", name) + b"\0" * (2 * name) + field("The code", title) + b"\0" * (2 * title)
    if release > 104:
        note = field("_dta", name) + field("note1", name) + b"said\0"
        out += b"\1" + struct.pack(order + ("I" if late else "H"), len(note)) + note + b"\0" * (5 if late else 3)
    out += b"".join(struct.pack(order + "hd", code, score) + field(word, 3) for code, score, word in rows)
    if release > 105:
        table = struct.pack(order + "II2I2i", 2, 7, 0, 4, 1, 2) + b"yes\0no\0"
        out += struct.pack(order + "I", len(table)) + field("yn", name) + b"\0" * 3 + table
    return out


@pytest.mark.parametrize("release", [104, 105, 108, 111, 113, 114, 115])
@pytest.mark.parametrize("order", "<>")
def test_old_releases(spark, tmp_path, release, order):
    nothing = 32_741 if release > 112 else 32_767
    path = tmp_path / "old.dta"
    path.write_bytes(_old_file(release, order, [(1, 0.5, "é"), (2, 2.0**1023, "abc"), (nothing, -1.0, ""), (32_740, 0.0, "x")]))
    if release > 105:
        df, meta = sl.read_dta(spark, path)
        assert meta.value_labels == {"code": [{"value": 1, "label": "yes"}, {"value": 2, "label": "no"}]}
    else:
        with pytest.warns(sl.StatWarning, match="labels of values"):
            df, meta = sl.read_dta(spark, path)
    assert [tuple(r) for r in df.collect()] == [(1, 0.5, "é"), (2, None, "abc"), (None, -1.0, ""), (32_740, 0.0, "x")]
    assert df.schema.simpleString() == "struct<code:smallint,score:double,word:string>" and meta.file_label == "Old"
    assert meta.variable_labels == {"code": "The code"} and meta.notes == (["said"] if release > 104 else [])
    assert [tuple(r) for r in sl.read_dta(spark, path, row_offset=1, row_limit=1, columns=["word"])[0].collect()] == [("abc",)]


def test_old_releases_of_pandas(spark, tmp_path):
    frame = pd.DataFrame({"a": np.array([1, -5, 100], dtype="int8"), "b": [1.5, np.nan, -2.0], "c": ["x", "", "long text"], "d": pd.Categorical(["u", "v", "u"])})
    frame.to_stata(tmp_path / "p.dta", version=114, write_index=False, variable_labels={"b": "A number"})
    df, meta = sl.read_dta(spark, tmp_path / "p.dta")
    assert [tuple(r) for r in df.collect()] == [(1, 1.5, "x", 0), (-5, None, "", 1), (100, -2.0, "long text", 0)]
    assert meta.value_labels == {"d": [{"value": 0, "label": "u"}, {"value": 1, "label": "v"}]} and meta.variable_labels == {"b": "A number"}


@pytest.mark.parametrize("kind,compression", KINDS[:2] + KINDS[3:])
def test_spark_writes_folders(spark, survey, tmp_path, kind, compression):
    sl.register(spark)
    path = str(tmp_path / "out")
    options = {"compression": compression} if kind == "sav" else {}
    rows = survey.select("mychar", "mynum", "mydate", "dtime", "wide")
    rows.repartition(3).write.format(kind).options(**options).mode("overwrite").save(path)
    found, _ = reader(kind)(spark, path)
    expected = {(*r[:4], r[6]) for r in EXPECTED}
    assert {tuple(r) for r in found.collect()} == expected
    rows.limit(2).write.format(kind).options(**options).mode("append").save(path)
    assert spark.read.format(kind).load(path).count() == 7
    rows.where("false").write.format(kind).options(**options).mode("overwrite").save(path)
    again, _ = reader(kind)(spark, path)
    assert again.count() == 0 and again.schema == found.schema
    assert all(p.name.startswith("part-") for p in (tmp_path / "out").iterdir())


def test_stored_batches_are_those_of_data_frames(spark, survey):
    from statloom.formats import FAMILIES
    from statloom.plans import write_plan
    from statloom.plans.stored import by_type, stored

    rows = survey.selectExpr("*", "named_struct('value', mynum, 'tag', case when mynum is null then 'c' end) tagged")
    rows = rows.selectExpr("*", "make_dt_interval(1, 2, 3, 4.5) span", "cast(mylabl as int) whole", "cast(mylabl as tinyint) tiny", "mynum > 0 as yes", "null as nothing", "cast(myord as bigint) far")
    for key, df in (("dta", rows), ("sav", rows.drop("tagged"))):
        plan = write_plan.plan(df.schema, None, FAMILIES[key], by_type(df.schema))
        table = df.toArrow()
        batch = stored(table.combine_chunks().to_batches()[0], plan)
        assert [str(t.dataType.simpleString()) for t in plan.encode(df).schema] == [str(t).replace("int8", "tinyint").replace("int16", "smallint").replace("int32", "int") for t in batch.schema.types]
        for one, other in zip(batch.to_pylist(), plan.encode(df).toArrow().to_pylist(), strict=True):
            assert {k: (one[k], other[k]) for k in one if one[k] != other[k]} == {}


@pytest.mark.parametrize("kind,column", [("dta", "cast(9007199254740993 as bigint)"), ("sav", "cast(9007199254740993 as bigint)"), ("dta", "named_struct('value', cast(null as double), 'tag', 'A')"), ("dta", "named_struct('value', 1.0D, 'tag', 'a')")])
def test_spark_refuses_what_is_not_exact(spark, tmp_path, kind, column):
    sl.register(spark)
    with pytest.raises(Exception, match="column 'x'"):
        spark.sql(f"SELECT {column} AS x").write.format(kind).mode("append").save(str(tmp_path / "out"))
    assert not list((tmp_path / "out").iterdir())
