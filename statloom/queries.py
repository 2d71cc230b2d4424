"""The library's operators as queries over the driver's tables, each with the SQL that gives the same rows."""

from __future__ import annotations

import atexit
import os
import shutil
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import open_sav, read_dta, read_sav, register, write_dta, write_sav
from .formats import DTA, SAV, Family
from .functions import missing, temporal, text
from .metadata import Metadata
from .operators import profile, project
from .plans import write_plan
from .sources.files import shared_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _with_types(df: DataFrame, *names: str) -> DataFrame:
    """These columns as doubles, and the types they have beside them."""
    return df.withColumns({f"{n}_type": F.typeof(n) for n in names} | {n: F.col(n).cast("double") for n in names})


# ---- declared and tagged missing values

_KEY = ("l_orderkey", "l_linenumber")


def _masked(spark: SparkSession, sf_dir: str, column: str, spec: dict) -> DataFrame:
    rows = _table(spark, sf_dir, "lineitem")
    return rows.select(*_KEY, missing.mask(rows[column], spec, column).alias(column))


@_query("SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity IN (7, 8, 9) THEN NULL ELSE l_quantity END AS l_quantity FROM lineitem")
def missing_discrete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _masked(spark, sf_dir, "l_quantity", {"values": [7, 8, 9]})


@_query("SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity BETWEEN 10 AND 20 OR l_quantity = 50 THEN NULL ELSE l_quantity END AS l_quantity FROM lineitem")
def missing_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _masked(spark, sf_dir, "l_quantity", {"lo": 10, "hi": 20, "value": 50})


@_query("SELECT l_orderkey, l_linenumber, CASE WHEN l_extendedprice <= 20000 THEN NULL ELSE l_extendedprice END AS l_extendedprice FROM lineitem")
def missing_lo_thru(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _masked(spark, sf_dir, "l_extendedprice", {"lo": float("-inf"), "hi": 20000})


@_query("SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END AS l_returnflag FROM lineitem")
def missing_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _masked(spark, sf_dir, "l_returnflag", {"values": ["N"]})


@_query("SELECT l_orderkey, l_linenumber, l_quantity, coalesce(l_quantity BETWEEN 1 AND 5, false) AS declared FROM lineitem")
def preserve_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "lineitem")
    return rows.select(*_KEY, "l_quantity", missing.is_missing(rows["l_quantity"], {"lo": 1, "hi": 5}).alias("declared"))


def _tagged(rows: DataFrame) -> DataFrame:
    """Balances below zero become ``.a``, those above 9000 ``.z``."""
    tag = F.when(F.col("c_acctbal") < 0, "a").when(F.col("c_acctbal") > 9000, "z")
    return rows.select("c_custkey", missing.wrap(F.when(tag.isNull(), F.col("c_acctbal")), tag).alias("cell"))


@_query("SELECT c_custkey, CASE WHEN c_acctbal BETWEEN 0 AND 9000 THEN c_acctbal END AS value, CASE WHEN c_acctbal < 0 THEN 'a' WHEN c_acctbal > 9000 THEN 'z' END AS tag FROM customer")
def tagged_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tagged(_table(spark, sf_dir, "customer")).select("c_custkey", "cell.value", "cell.tag")


@_query("SELECT c_custkey, (CASE WHEN c_acctbal < 0 THEN 1 WHEN c_acctbal > 9000 THEN 26 END)::DOUBLE AS code FROM customer")
def tag_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _tagged(_table(spark, sf_dir, "customer"))
    return rows.select("c_custkey", missing.tag_code(F.col("cell"), "cell").cast("double").alias("code"))


# ---- profiles and narrowing

_PROFILED = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _profile_sql(value: str, column: str) -> str:
    finite = f"abs({value}) < 'Infinity'::DOUBLE"
    return (
        f"SELECT '{column}' AS name, min({value}) FILTER ({finite}) AS low, max({value}) FILTER ({finite}) AS high, "
        f"coalesce(bool_and({finite} AND round_even({value}, 0) = {value}), true) AS integral, "
        f"coalesce(bool_and(NOT {finite} OR {value}::FLOAT::DOUBLE = {value}), true) AS float32_exact FROM lineitem"
    )


@_query(" UNION ALL ".join(_profile_sql(c, c) for c in _PROFILED))
def profile_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One aggregation for all columns, then a row for each."""
    rows = _table(spark, sf_dir, "lineitem")
    one = rows.agg(*(e for c in _PROFILED for e in profile.profile_columns(rows[c], c)))
    each = [F.struct(F.lit(c).alias("name"), F.col(f"{c}_min").alias("low"), F.col(f"{c}_max").alias("high"), F.col(f"{c}_integral").alias("integral"), F.col(f"{c}_float32").alias("float32_exact")) for c in _PROFILED]
    return one.select(F.inline(F.array(*each)))


@_query("SELECT l_orderkey, l_linenumber, l_quantity, 'tinyint' AS l_quantity_type, l_discount, 'double' AS l_discount_type FROM lineitem")
def narrow_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "lineitem").select(*_KEY, "l_quantity", "l_discount")
    return _with_types(profile.narrow(rows, ["l_quantity", "l_discount"]), "l_quantity", "l_discount")


@_query("SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity IN (7, 8, 9) THEN NULL ELSE l_quantity END AS l_quantity, 'tinyint' AS l_quantity_type, l_discount, 'double' AS l_discount_type FROM lineitem")
def narrow_with_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "lineitem").select(*_KEY, "l_quantity", "l_discount")
    found = profile.narrow(rows, ["l_quantity", "l_discount"], {"l_quantity": {"values": [7, 8, 9]}})
    return _with_types(found, "l_quantity", "l_discount")


@_query("SELECT p_size, bool_and(p_retailprice::FLOAT::DOUBLE = p_retailprice) AS exact FROM part GROUP BY p_size")
def float32_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the prices of each size are exact as float32, by the profile's own aggregate."""
    rows = _table(spark, sf_dir, "part")
    found = rows.groupBy("p_size").agg(*profile.profile_columns(rows["p_retailprice"], "price"))
    return found.select("p_size", F.col("price_float32").alias("exact"))


@_query("SELECT r_regionkey, NULL::DOUBLE AS nothing, 'tinyint' AS nothing_type FROM region")
def all_null_int8(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "region").select("r_regionkey", F.lit(None).cast("double").alias("nothing"))
    return _with_types(profile.narrow(rows, ["nothing"]), "nothing")


@_query("SELECT p_partkey, p_size::DOUBLE AS size, 'smallint' AS size_type FROM part")
def checked_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "part")
    return _with_types(rows.select("p_partkey", profile.checked_cast(rows["p_size"].cast("double"), "smallint", "p_size").alias("size")), "size")


# ---- temporal conversion


def _stored(spark: SparkSession, sf_dir: str, table: str, key: str, value: Column, family: Family, kind: temporal.Kind, back: bool) -> DataFrame:
    rows = _table(spark, sf_dir, table)
    raw = temporal.to_raw(value, family, kind)
    return rows.select(key, (temporal.to_temporal(raw, family, kind) if back else raw).alias("value"))


def _date(column: str) -> Column:
    return F.col(column).cast("date")


@_query("SELECT o_orderkey, (o_orderdate::DATE - DATE '1582-10-14') * 86400.0::DOUBLE AS value FROM orders")
def sav_date_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "orders", "o_orderkey", _date("o_orderdate"), SAV, "date", False)


@_query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS value FROM orders")
def sav_date_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "orders", "o_orderkey", _date("o_orderdate"), SAV, "date", True).withColumn("value", F.col("value").cast("string"))


@_query("SELECT o_orderkey, (o_orderdate::DATE - DATE '1960-01-01')::INTEGER AS value FROM orders")
def dta_date_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "orders", "o_orderkey", _date("o_orderdate"), DTA, "date", False)


@_query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS value FROM orders")
def dta_date_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "orders", "o_orderkey", _date("o_orderdate"), DTA, "date", True).withColumn("value", F.col("value").cast("string"))


@_query("SELECT event_id, (epoch_us(ts) + 141428 * 86400000000)::DOUBLE / 1000000.0::DOUBLE AS value FROM events")
def sav_datetime_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "events", "event_id", F.col("ts"), SAV, "datetime", False)


@_query("SELECT event_id, date_trunc('second', ts) AS value FROM events")
def sav_datetime_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole seconds: a double holds seconds since 1582 to about two microseconds only."""
    return _stored(spark, sf_dir, "events", "event_id", F.date_trunc("second", F.col("ts")).cast("timestamp_ntz"), SAV, "datetime", True)


@_query("SELECT event_id, (epoch_us(ts) + 3653 * 86400000000)::DOUBLE / 1000.0::DOUBLE AS value FROM events")
def dta_datetime_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "events", "event_id", F.col("ts"), DTA, "datetime", False)


@_query("SELECT event_id, ts AS value FROM events")
def dta_datetime_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "events", "event_id", F.col("ts"), DTA, "datetime", True)


def _micros_of_day() -> Column:
    return F.unix_micros(F.col("ts").cast("timestamp")) % temporal.DAY


@_query("SELECT event_id, round_even(((epoch_us(ts) % 86400000000)::DOUBLE / 1000.0::DOUBLE) * 1000, 0)::BIGINT % 86400000000 AS value FROM events")
def time_of_day_micros(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "events", "event_id", _micros_of_day(), DTA, "time", True)


@_query("SELECT event_id, epoch_us(ts) % 86400000000 / 1000.0::DOUBLE AS value FROM events")
def duration_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    interval = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (_micros_of_day() / F.lit(1_000_000).cast("decimal(20,0)")).cast("decimal(18,6)"))
    return _stored(spark, sf_dir, "events", "event_id", interval, DTA, "duration", False)


# ---- planning of writes


@_query("SELECT name, width FROM (SELECT greatest(max(strlen(c_name)), 1)::INTEGER AS c_name, greatest(max(strlen(c_mktsegment)), 1)::INTEGER AS c_mktsegment FROM customer) UNPIVOT (width FOR name IN (c_name, c_mktsegment))")
def string_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "customer")
    names = ("c_name", "c_mktsegment")
    return rows.agg(*(text.width(rows[n]).alias(n) for n in names)).select(F.inline(F.array(*(F.struct(F.lit(n).alias("name"), F.col(n).alias("width")) for n in names))))


#: Columns of 1 to 50 and 1 to 7 in several types and, shifted, near the ends of these.
_WIDENED = {"small": ("p_size", "tinyint", 0), "edge": ("p_size", "tinyint", 70), "wide": ("p_size", "smallint", 32_600), "beyond": ("p_size", "smallint", 32_717), "whole": ("p_size", "int", 0), "far": ("p_size", "int", 2_147_483_590)}
_STATA_SQL = """
SELECT name, low, high, CASE
  WHEN spark = 'tinyint' AND low >= -127 AND high <= 100 THEN 'byte'
  WHEN spark <> 'int' AND low >= -32767 AND high <= 32740 THEN 'int'
  WHEN low >= -2147483647 AND high <= 2147483620 THEN 'long' ELSE 'double' END AS stored
FROM ({})"""


@_query(_STATA_SQL.format(" UNION ALL ".join(f"SELECT '{n}' AS name, '{t}' AS spark, min({c})::BIGINT + {by} AS low, max({c})::BIGINT + {by} AS high FROM part" for n, (c, t, by) in _WIDENED.items())))
def stata_widen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the planner stores integers as; never narrower than their own type."""
    rows = _table(spark, sf_dir, "part").select(*((F.col(c) + by).cast(t).alias(n) for n, (c, t, by) in _WIDENED.items()))
    measured = write_plan.measure(rows)
    columns = write_plan.plan(rows.schema, None, DTA, measured).columns
    return spark.createDataFrame([(p.name, *measured.ranges[p.name], p.stored) for p in columns], "name string, low long, high long, stored string")


@_query("SELECT doc_id, left(text, list_max(list_filter(range(41), lambda n: strlen(left(text, n)) <= 40))) AS part FROM documents")
def utf8_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts cut to 40 bytes, between characters."""
    return _table(spark, sf_dir, "documents").select("doc_id", text.cut_utf8(F.col("text"), 40).alias("part"))


@_query("SELECT p_partkey AS v1_key, p_name AS p_name FROM part")
def legal_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns under the names that the planner makes of illegal ones."""
    rows = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("1 key"), "p_name")
    return rows.toDF(*SAV.legal_names(rows.columns).values())


# ---- projection, slices and batches


@_query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def project_file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project.in_file_order(_table(spark, sf_dir, "customer"), ["c_acctbal", "not_there", "c_name", "c_custkey"])


@_query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 500 OFFSET 1000")
def slice_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project.rows(_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", offset=1000, limit=500)


# ---- files: written and read again


def _removed(path: str) -> None:
    if os.path.isdir(path):
        shutil.rmtree(path, ignore_errors=True)
    elif os.path.exists(path):
        os.remove(path)


def _place(spark: SparkSession, suffix: str) -> str:
    """A path in the shared folder for a file that results are read from, so it goes when the driver ends."""
    path = os.path.join(shared_folder(spark), f"statloom-{uuid.uuid4().hex}.{suffix}")
    atexit.register(_removed, path)
    return path


def _through(spark: SparkSession, df: DataFrame, suffix: str, metadata: Metadata | None = None, write: dict | None = None, read: dict | None = None) -> DataFrame:
    path = _place(spark, suffix)
    (write_dta if suffix == "dta" else write_sav)(path, df, metadata, **(write or {}))
    return (read_dta if suffix == "dta" else read_sav)(spark, path, **(read or {}))[0]


@_query("SELECT p_partkey::DOUBLE AS p_partkey, p_name, p_size, p_retailprice FROM part")
def dta_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through(spark, _table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice"), "dta")


_PART_SQL = "SELECT p_partkey::DOUBLE AS p_partkey, p_name, p_size::DOUBLE AS p_size, p_retailprice FROM part"


@_query(_PART_SQL)
def sav_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through(spark, _table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice"), "sav")


@_query(_PART_SQL)
def sav_rows_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through(spark, _table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice"), "sav", write={"compression": "rows"})


@_query(_PART_SQL)
def zsav_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through(spark, _table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice"), "zsav", write={"compression": "zlib"})


@_query("SELECT p_partkey::INTEGER::VARCHAR AS p_partkey, (CASE WHEN p_size BETWEEN 1 AND 10 OR p_size = 50 THEN NULL ELSE p_size END)::DOUBLE AS p_size, 'tinyint' AS p_size_type FROM part")
def sav_scan_and_narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared-missing values are null before the profile is taken."""
    rows = _table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("p_partkey"), "p_size", "p_retailprice")
    found = _through(spark, rows, "sav", Metadata(missing_values={"p_size": {"lo": 1, "hi": 10, "value": 50}}), read={"columns": ["p_size", "p_partkey"], "scan_and_narrow_types": True})
    return _with_types(found, "p_size")


@_query("SELECT o_orderkey::DOUBLE AS o_orderkey, o_orderdate, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def dta_temporal_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through(spark, _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", _date("o_orderdate").alias("day")), "dta").withColumn("day", F.col("day").cast("string"))


@_query("SELECT c_custkey::DOUBLE AS c_custkey, CASE WHEN c_acctbal BETWEEN 0 AND 9000 THEN c_acctbal END AS value, CASE WHEN c_acctbal < 0 THEN 'a' WHEN c_acctbal > 9000 THEN 'z' END AS tag FROM customer")
def dta_tagged_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _through(spark, _tagged(_table(spark, sf_dir, "customer")), "dta", read={"preserve_user_missing": True})
    return rows.select(F.col("c_custkey.value").alias("c_custkey"), "cell.value", "cell.tag")


@_query("SELECT n_nationkey::DOUBLE AS n_nationkey, n_name FROM nation")
def sav_to_dta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file of one family read and written as one of the other."""
    return _through(spark, _through(spark, _table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), "sav"), "dta")


@_query("SELECT o_orderkey::DOUBLE AS o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 500 OFFSET 1000")
def dta_rows_of_a_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reader's own offset and limit."""
    return _through(spark, _table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").sort("o_orderkey"), "dta", read={"row_offset": 1000, "row_limit": 500})


@_query("SELECT batch, count(*) AS rows, min(o_orderkey)::DOUBLE AS first FROM (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 4096 AS batch FROM orders) GROUP BY batch")
def batch_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of a compressed file, as its reader hands them over."""
    path = _place(spark, "sav")
    write_sav(path, _table(spark, sf_dir, "orders").select("o_orderkey").sort("o_orderkey"), compression="rows")
    found: list[tuple[int, int, float]] = []
    open_sav(spark, path).read_batches(lambda b: found.append((len(found), b.num_rows, b.column(0)[0].as_py())), batch_rows=4096)
    return spark.createDataFrame(found, "batch long, rows long, first double")


_STATUS = [("F", "Finished"), ("O", "Open"), ("P", "Pending")]
_STATUS_SQL = "CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' WHEN 'P' THEN 'Pending' END"


def _labelled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Column]:
    """Orders from a file whose dictionary labels their status, and the label by that dictionary."""
    path = _place(spark, "sav")
    codes = [{"value": v, "label": x} for v, x in _STATUS]
    write_sav(path, _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), Metadata(value_labels={"o_orderstatus": codes}))
    rows, meta = read_sav(spark, path)
    pairs = [x for c in meta.value_labels["o_orderstatus"] for x in (F.lit(c["value"]), F.lit(c["label"]))]
    return rows, F.try_element_at(F.create_map(*pairs), rows["o_orderstatus"])


@_query(f"SELECT o_orderkey::DOUBLE AS o_orderkey, {_STATUS_SQL} AS status FROM orders")
def value_labels_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, label = _labelled(spark, sf_dir)
    return rows.select("o_orderkey", label.alias("status"))


@_query(f"SELECT o_orderstatus AS code, {_STATUS_SQL} AS label, count(*) AS n FROM orders GROUP BY o_orderstatus")
def dictionary_of_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, label = _labelled(spark, sf_dir)
    return rows.groupBy(rows["o_orderstatus"].alias("code"), label.alias("label")).agg(F.count("*").alias("n"))


def _by_format(spark: SparkSession, df: DataFrame, kind: str, **options: str) -> DataFrame:
    """Written and read by Spark's own interface."""
    register(spark)
    path = _place(spark, kind)
    df.write.format(kind).options(**options).mode("append").save(path)
    return spark.read.format(kind).load(path)


@_query("SELECT o_orderkey::DOUBLE AS o_orderkey, o_orderstatus, (o_orderdate::DATE - DATE '1960-01-01')::INTEGER AS day FROM orders")
def dta_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_format(spark, _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", _date("o_orderdate").alias("day")).repartition(4), "dta")


@_query("SELECT o_orderkey::DOUBLE AS o_orderkey, o_orderstatus, (o_orderdate::DATE - DATE '1582-10-14') * 86400.0::DOUBLE AS day FROM orders")
def sav_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_format(spark, _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", _date("o_orderdate").alias("day")).repartition(4), "sav", compression="rows")
