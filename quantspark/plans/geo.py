"""GEO1 / J19 on synthetic coordinates derived from the keys: suppliers are
points, parts are line segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantspark.operators.geo import DEG, KM_PER_DEG_LAT, KM_PER_DEG_LON_EQ, NEARBY_KM, assign_regions, nearest_line
from quantspark.plans.common import round_doubles, sql_round_select
from quantspark.sources.tables import table


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").alias("pid"), (-124.0 + (F.col("s_suppkey") % 89) * 0.1).alias("lon"),
                    (32.0 + (F.col("s_suppkey") % 97) * 0.1).alias("lat"))


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    x1 = -124.0 + (F.col("p_partkey") % 83) * 0.1
    y1 = 32.0 + (F.col("p_partkey") % 71) * 0.1
    return p.select(F.col("p_partkey").alias("sid"), x1.alias("x1"), y1.alias("y1"),
                    (x1 + F.col("p_size") * 0.01).alias("x2"), (y1 + (F.col("p_partkey") % 13) * 0.01 - 0.06).alias("y2"))


def q_geo1(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = nearest_line(points(spark, sf_dir), segments(spark, sf_dir))
    return round_doubles(r.drop("nearest_sid"))


SQL_GEO1 = sql_round_select(f"""
WITH p AS (SELECT s_suppkey AS pid, -124.0::DOUBLE + (s_suppkey % 89) * 0.1::DOUBLE AS lon,
                  32.0::DOUBLE + (s_suppkey % 97) * 0.1::DOUBLE AS lat FROM supplier),
s AS (SELECT p_partkey AS sid, -124.0::DOUBLE + (p_partkey % 83) * 0.1::DOUBLE AS x1, 32.0::DOUBLE + (p_partkey % 71) * 0.1::DOUBLE AS y1,
             -124.0::DOUBLE + (p_partkey % 83) * 0.1::DOUBLE + p_size * 0.01::DOUBLE AS x2,
             32.0::DOUBLE + (p_partkey % 71) * 0.1::DOUBLE + (p_partkey % 13) * 0.01::DOUBLE - 0.06::DOUBLE AS y2 FROM part),
a AS (SELECT pid, {KM_PER_DEG_LON_EQ} * cos(lat * {DEG}) AS kx, (x1 - lon) * ({KM_PER_DEG_LON_EQ} * cos(lat * {DEG})) AS ax,
             (y1 - lat) * {KM_PER_DEG_LAT} AS ay, (x2 - x1) * ({KM_PER_DEG_LON_EQ} * cos(lat * {DEG})) AS dx,
             (y2 - y1) * {KM_PER_DEG_LAT} AS dy FROM p, s),
b AS (SELECT *, dx * dx + dy * dy AS dd FROM a),
c AS (SELECT pid, ax, ay, dx, dy, CASE WHEN dd > 0 THEN least(greatest(-(ax * dx + ay * dy) / dd, 0.0), 1.0) ELSE 0.0 END AS t FROM b)
SELECT pid, min(sqrt((ax + t * dx) * (ax + t * dx) + (ay + t * dy) * (ay + t * dy))) AS km_to_line,
       min(sqrt((ax + t * dx) * (ax + t * dx) + (ay + t * dy) * (ay + t * dy))) <= {NEARBY_KM} AS line_nearby
FROM c GROUP BY pid""", ["pid", "line_nearby"], ["km_to_line"])

QUERIES = {"geo1": q_geo1}
ORACLE = {"geo1": SQL_GEO1}


# --- GEO2: fire triangles (parts) against region quadrilaterals (nations) ---

def _pt(x, y):
    return F.struct(x.alias("x"), y.alias("y"))


def fire_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    x = -124.0 + (F.col("p_partkey") % 97) * 0.1
    y = 32.0 + (F.col("p_partkey") % 89) * 0.1
    return p.select(F.col("p_partkey").alias("eid"),
                    F.array(_pt(x, y), _pt(x + F.col("p_size") * 0.02, y),
                            _pt(x, y + (F.col("p_partkey") % 7) * 0.05 + 0.05)).alias("poly"))


def region_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    cx = -123.0 + (k % 5) * 2.0
    cy = 33.0 + F.floor(k / 5) * 2.0
    return n.select(k.alias("rid"), F.array(
        _pt(cx - 1 + (k % 3) * 0.1, cy - 1), _pt(cx + 1, cy - 1 + (k % 4) * 0.1),
        _pt(cx + 1 - (k % 2) * 0.05, cy + 1), _pt(cx - 1, cy + 1 - (k % 3) * 0.1)).alias("rpoly"))


def q_geo2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_regions(fire_polygons(spark, sf_dir), region_polygons(spark, sf_dir))


_D = "::DOUBLE"
SQL_GEO2 = f"""
WITH fv AS (
  SELECT p_partkey AS eid, i, CASE i WHEN 0 THEN x WHEN 1 THEN x + p_size * 0.02{_D} ELSE x END AS x,
         CASE i WHEN 0 THEN y WHEN 1 THEN y ELSE y + (p_partkey % 7) * 0.05{_D} + 0.05{_D} END AS y, 3 AS n
  FROM (SELECT *, -124.0{_D} + (p_partkey % 97) * 0.1{_D} AS x, 32.0{_D} + (p_partkey % 89) * 0.1{_D} AS y FROM part) p,
       (SELECT unnest([0, 1, 2]) AS i) ii),
rv AS (
  SELECT n_nationkey AS rid, i,
    CASE i WHEN 0 THEN cx - 1 + (n_nationkey % 3) * 0.1{_D} WHEN 1 THEN cx + 1 WHEN 2 THEN cx + 1 - (n_nationkey % 2) * 0.05{_D}
           ELSE cx - 1 END AS x,
    CASE i WHEN 0 THEN cy - 1 WHEN 1 THEN cy - 1 + (n_nationkey % 4) * 0.1{_D} WHEN 2 THEN cy + 1
           ELSE cy + 1 - (n_nationkey % 3) * 0.1{_D} END AS y, 4 AS n
  FROM (SELECT *, -123.0{_D} + (n_nationkey % 5) * 2.0{_D} AS cx, 33.0{_D} + floor(n_nationkey / 5) * 2.0{_D} AS cy FROM nation) q,
       (SELECT unnest([0, 1, 2, 3]) AS i) ii),
fe AS (SELECT a.eid, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM fv a JOIN fv b ON a.eid = b.eid AND b.i = (a.i + 1) % a.n),
re AS (SELECT a.rid, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM rv a JOIN rv b ON a.rid = b.rid AND b.i = (a.i + 1) % a.n),
pip_f AS (SELECT v.eid, e.rid, v.i,
                 sum(CASE WHEN (e.y1 > v.y) <> (e.y2 > v.y) AND v.x < (e.x2 - e.x1) * (v.y - e.y1) / (e.y2 - e.y1) + e.x1
                          THEN 1 ELSE 0 END) AS hits FROM fv v, re e GROUP BY 1, 2, 3),
pip_r AS (SELECT e.eid, v.rid, v.i,
                 sum(CASE WHEN (e.y1 > v.y) <> (e.y2 > v.y) AND v.x < (e.x2 - e.x1) * (v.y - e.y1) / (e.y2 - e.y1) + e.x1
                          THEN 1 ELSE 0 END) AS hits FROM rv v, fe e GROUP BY 1, 2, 3),
cr AS (SELECT a.eid, b.rid FROM fe a, re b
       WHERE sign((a.x2 - a.x1) * (b.y1 - a.y1) - (a.y2 - a.y1) * (b.x1 - a.x1))
             * sign((a.x2 - a.x1) * (b.y2 - a.y1) - (a.y2 - a.y1) * (b.x2 - a.x1)) < 0
         AND sign((b.x2 - b.x1) * (a.y1 - b.y1) - (b.y2 - b.y1) * (a.x1 - b.x1))
             * sign((b.x2 - b.x1) * (a.y2 - b.y1) - (b.y2 - b.y1) * (a.x2 - b.x1)) < 0),
hit AS (SELECT eid, rid FROM pip_f WHERE hits % 2 = 1 UNION SELECT eid, rid FROM pip_r WHERE hits % 2 = 1
        UNION SELECT eid, rid FROM cr)
SELECT p_partkey AS eid, hit.rid FROM part LEFT JOIN hit ON hit.eid = p_partkey"""

QUERIES["geo2"] = q_geo2
ORACLE["geo2"] = SQL_GEO2
