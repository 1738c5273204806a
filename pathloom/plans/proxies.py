"""Views of the driver's tables as tracking data, each with the DuckDB text that makes the same view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as observations: entity, team, role, sec, hourly frame, x, y and the number rn of the row within its entity."""
    e = table(spark, sf_dir, "events")
    sec = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).cast("long")
    y = F.regexp_extract("props", r"(-?\d+)", 1).cast("double")
    out = e.select("event_id", F.col("user_id").alias("entity"), (F.col("user_id") % 2).alias("team"), F.col("event_type").alias("role"), sec.alias("sec"), F.floor(sec / 3600).cast("long").alias("frame"), F.col("value").alias("x"), y.alias("y"))
    return out.withColumn("rn", F.row_number().over(Window.partitionBy("entity").orderBy("sec", "event_id")).cast("long"))


OBS = r"""obs AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY sec, event_id) AS rn FROM (
  SELECT event_id, user_id AS entity, user_id % 2 AS team, event_type AS role, epoch_us(ts) // 1000000 AS sec, (epoch_us(ts) // 1000000) // 3600 AS frame,
         value AS x, CAST(regexp_extract(props, '(-?\d+)', 1) AS DOUBLE) AS y FROM events))"""


def track(o: DataFrame) -> DataFrame:
    """One observation for each entity and frame, the first."""
    w = Window.partitionBy("entity", "frame").orderBy("sec", "event_id")
    return o.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


TRACK = "track AS (SELECT * FROM obs QUALIFY row_number() OVER (PARTITION BY entity, frame ORDER BY sec, event_id) = 1)"


def ball(o: DataFrame) -> DataFrame:
    """At most one ball for each frame: the first observation of role purchase."""
    w = Window.partitionBy("frame").orderBy("event_id")
    out = o.filter("role = 'purchase'").withColumn("_r", F.row_number().over(w)).filter("_r = 1")
    return out.select("frame", F.col("x").alias("bx"), F.col("y").alias("by"))


BALL = "ball AS (SELECT frame, x AS bx, y AS b_y FROM obs WHERE role = 'purchase' QUALIFY row_number() OVER (PARTITION BY frame ORDER BY event_id) = 1)"


def box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as detections; of rows that share (order, line) the dearest stays."""
    li = table(spark, sf_dir, "lineitem")
    w = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(F.desc("l_extendedprice"), "l_partkey", "l_suppkey", "l_quantity", "l_tax", "l_returnflag")
    li = li.withColumn("_r", F.row_number().over(w)).filter("_r = 1")
    x, y = (F.col("l_partkey") % 100).cast("double"), (F.col("l_suppkey") % 100).cast("double")
    return li.select(F.col("l_orderkey").alias("image"), F.col("l_linenumber").cast("long").alias("det"), x.alias("x1"), y.alias("y1"), (x + F.col("l_quantity")).alias("x2"), (y + F.col("l_quantity") * (1 + F.col("l_tax"))).alias("y2"), F.col("l_extendedprice").alias("conf"), F.col("l_returnflag").alias("cls"))


BOX = """box AS (SELECT l_orderkey AS image, CAST(l_linenumber AS BIGINT) AS det, CAST(l_partkey % 100 AS DOUBLE) AS x1, CAST(l_suppkey % 100 AS DOUBLE) AS y1,
  CAST(l_partkey % 100 AS DOUBLE) + l_quantity AS x2, CAST(l_suppkey % 100 AS DOUBLE) + l_quantity * (1 + l_tax) AS y2, l_extendedprice AS conf, l_returnflag AS cls
  FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_extendedprice DESC, l_partkey, l_suppkey, l_quantity, l_tax, l_returnflag) = 1)"""


def seg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as intervals of days: from the order date on, as many days as the key's last digit and one."""
    o = table(spark, sf_dir, "orders")
    day = F.floor(F.unix_micros(F.col("o_orderdate").cast("timestamp")) / 86_400_000_000).cast("long")
    return o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("entity"), F.col("o_totalprice").alias("conf"), day.alias("start"), (day + F.col("o_orderkey") % 30 + 1).alias("end"))


SEG = """seg AS (SELECT o_orderkey AS id, o_custkey AS entity, o_totalprice AS conf, epoch_us(o_orderdate) // 86400000000 AS start,
  epoch_us(o_orderdate) // 86400000000 + o_orderkey % 30 + 1 AS "end" FROM orders)"""
