import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from statloom.formats import DTA, SAV
from statloom.functions import missing, temporal, text
from statloom.operators import project


def column(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def values(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_missing_predicates(spark):
    df = column(spark, [1.0, 7.0, -999.0, 0.0, 999.0, None, math.nan])
    v = df["v"]
    assert values(df, missing.is_missing(v, {"values": [7, 999]})) == [False, True, False, False, True, False, False]
    assert values(df, missing.is_missing(v, {"lo": -999, "hi": 0, "value": 999})) == [False, False, True, True, True, False, False]
    assert values(df, missing.is_missing(v, {"lo": -math.inf, "hi": 0})) == [False, False, True, True, False, False, False]
    assert values(df, missing.is_missing(v, {"lo": 5, "hi": math.inf})) == [False, True, False, False, True, False, False]
    assert values(df, missing.mask(v, None))[:2] == [1.0, 7.0]
    texts = column(spark, ["a", "Z", None], "string")
    assert values(texts, missing.mask(texts["v"], {"values": ["Z"]})) == ["a", None, None]


def test_missing_parts():
    assert missing.parts(None, "v") == ([], None) and missing.parts({"values": []}, "v") == ([], None)
    assert missing.parts({"lo": 1, "hi": 2, "value": 9}, "v") == ([9], (1, 2))
    with pytest.raises(ValueError, match="three is the most"):
        missing.parts({"values": [1, 2, 3, 4]}, "v")
    with pytest.raises(ValueError, match="not by 'values', nor by 'lo' and 'hi'"):
        missing.parts({"lo": 1}, "v")


def test_tags(spark):
    df = spark.createDataFrame([(1.0, None), (None, "a"), (None, None), (None, "z")], "v double, t string")
    wrapped = df.select(missing.wrap(df["v"], df["t"]).alias("c"))
    assert [r.c and tuple(r.c) for r in wrapped.collect()] == [(1.0, None), (None, "a"), None, (None, "z")]
    assert missing.is_tagged(wrapped.schema["c"].dataType)
    assert values(wrapped, missing.tag_code(F.col("c"), "c")) == [None, 1, None, 26]
    assert values(spark.createDataFrame([(0,), (1,), (26,), (None,)], "k int"), missing.letter(F.col("k"))) == [None, "a", "z", None]
    for bad in ((1.0, "a"), (None, "ab"), (None, "A")):
        one = spark.createDataFrame([(bad,)], "c struct<value:double,tag:string>")
        with pytest.raises(Exception, match="column 'c'"):
            one.select(missing.tag_code(one["c"], "c")).collect()


def test_temporal_round_trips(spark):
    days = [dt.date(1583, 1, 1), dt.date(1960, 1, 1), dt.date(2018, 5, 6), None]
    stamps = [dt.datetime(1583, 1, 1, 10, 10, 10), dt.datetime(1969, 12, 31, 23, 59, 59), dt.datetime(2018, 5, 6, 10, 10, 10), None]
    for family in (SAV, DTA):
        df = column(spark, days, "date")
        assert values(df, temporal.to_temporal(temporal.to_raw(df["v"], family, "date"), family, "date")) == days
        df = column(spark, stamps, "timestamp_ntz")
        assert values(df, temporal.to_temporal(temporal.to_raw(df["v"], family, "datetime"), family, "datetime")) == stamps


def test_stored_numbers(spark):
    day = column(spark, [dt.date(1960, 1, 2)], "date")
    assert values(day, temporal.to_raw(day["v"], DTA, "date")) == [1]
    assert values(day, temporal.to_raw(day["v"], SAV, "date")) == [float((dt.date(1960, 1, 2) - dt.date(1582, 10, 14)).days * 86400)]
    span = spark.sql("SELECT interval '1 01:00:00.5' day to second AS v")
    assert values(span, temporal.to_raw(span["v"], SAV, "duration")) == [90000.5]
    assert values(span, temporal.to_raw(span["v"], DTA, "duration")) == [90000500.0]


def test_rounding_is_half_even_and_times_wrap(spark):
    df = column(spark, [0.5, 1.5, 2.5])
    assert values(df, temporal.to_temporal(df["v"], DTA, "date")) == [dt.date(1960, 1, 1), dt.date(1960, 1, 3), dt.date(1960, 1, 3)]
    df = column(spark, [86399.0, 86400.0, 90000.25, -1.0])
    assert values(df, temporal.to_temporal(df["v"], SAV, "time")) == [86_399_000_000, 0, 3_600_250_000, None]
    assert values(column(spark, [90000.25]), temporal.to_temporal(F.col("v"), SAV, "duration")) == [dt.timedelta(seconds=90000.25)]
    # SPSS dates drop the time of day
    assert values(column(spark, [86400.0 * 141_428 + 86399]), temporal.to_temporal(F.col("v"), SAV, "date")) == [dt.date(1970, 1, 1)]


@pytest.mark.parametrize("size", [0, 1, 2, 3, 4, 7, 12, 100])
def test_utf8_cut(spark, size):
    texts = ["", "abc", "日本語テキスト", "é" * 9, "a🙂b🙂c", None]
    df = column(spark, texts, "string")
    assert values(df, text.cut_utf8(df["v"], size)) == [t and t.encode()[:size].decode("utf-8", "ignore") for t in texts]


def test_string_width(spark):
    assert column(spark, ["é", "abc", None], "string").agg(text.width(F.col("v"))).first()[0] == 3
    assert column(spark, ["", None], "string").agg(text.width(F.col("v"))).first()[0] == 1
    assert column(spark, [], "string").agg(text.width(F.col("v"))).first()[0] == 1


def test_projection_and_slices(spark):
    df = spark.range(10).selectExpr("id AS a", "id * 2 AS b", "id * 3 AS c")
    assert project.in_file_order(df, ["c", "zz", "a"]).columns == ["a", "c"] and project.in_file_order(df, None).columns == ["a", "b", "c"]
    assert [r.a for r in project.rows(df, "a", offset=3, limit=2).collect()] == [3, 4]
    assert project.rows(df, "a").count() == 10 and project.rows(df, "a", offset=20).count() == 0
    numbered = project.row_numbers(df.orderBy(F.rand(1)), "a")
    assert sorted((r.a, r.row) for r in numbered.collect()) == [(k, k) for k in range(10)]
