import math

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from statloom.operators.profile import checked_cast, narrow, profile


def frame(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


@pytest.mark.parametrize(
    ("values", "kind"),
    [
        ([1.0, 2.0, None], "tinyint"), ([-128.0, 127.0], "tinyint"), ([128.0], "smallint"), ([1.0, 2.0, 5000.0], "smallint"), ([40000.0], "int"),
        ([1e15, -2e15, 3.0, None], "bigint"), ([-(2.0**63)], "bigint"), ([2.0**63], "float"), ([1e20], "double"), ([None, None], "tinyint"), ([], "tinyint"),
        ([0.5, -1.25, None], "float"), ([1.1], "double"), ([math.nan], "float"), ([1.0, math.nan], "float"), ([1.0, math.inf], "float"), ([1e39], "double"),
        ([-0.0], "tinyint"), ([0.1, math.nan], "double"),
    ],
)
def test_ladder(spark, values, kind):
    assert profile(frame(spark, values))["v"].narrow_type() == kind


def test_range_leaves_out_what_is_not_finite(spark):
    found = profile(frame(spark, [math.inf, 3.0, math.nan, -2.0, -math.inf]))["v"]
    assert (found.low, found.high, found.integral) == (-2.0, 3.0, False)


def test_missing_counts_as_null(spark):
    df = frame(spark, [1.0, 999.0])
    assert profile(df)["v"].narrow_type() == "smallint"
    assert profile(df, missing={"v": {"values": [999]}})["v"].narrow_type() == "tinyint"
    assert [r.v for r in narrow(df, missing={"v": {"values": [999]}}).collect()] == [1, None]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-(2**40), 2**40).map(float), st.floats()), max_size=6))
def test_narrowing_loses_nothing(spark, values):
    df = frame(spark, values)
    back = [r.v for r in narrow(df).selectExpr("cast(v AS double) v").collect()]
    assert all(v == w or v != v and w != w for v, w in zip(back, values, strict=True))


@pytest.mark.parametrize(("value", "to"), [(1000.0, "tinyint"), (1.1, "tinyint"), (1e39, "float"), (math.nan, "int"), (2.0**63, "bigint")])
def test_checked_cast_raises(spark, value, to):
    df = frame(spark, [value])
    with pytest.raises(Exception, match=f"does not fit {to}"):
        df.select(checked_cast(df["v"], to, "v")).collect()


def test_checked_cast_keeps(spark):
    df = frame(spark, [math.inf, math.nan, 1.5, None])
    assert [repr(r[0]) for r in df.select(checked_cast(df["v"], "float")).collect()] == ["inf", "nan", "1.5", "None"]


def test_other_columns_stay(spark):
    df = spark.createDataFrame([("a", 1.0, True)], "s string, v double, b boolean")
    assert narrow(df).schema.simpleString() == "struct<s:string,v:tinyint,b:boolean>"
    assert narrow(df.select("s")).columns == ["s"]
