"""Region-year risk features and pricing categories (A4-A6, A10, J5, J20,
P11, P13, P17, F5, D7, C4-C7, C11, C15, C19, B26, E3, V10, P23).

Mapping: zip = customer nation; premium panel = orders per (nation, year)
(premium = total price sum, exposure = order count); fire events = returned
line items per (supplier nation, ship year); census = customer aggregates
per (nation, market segment), joined on nation only so that it fans out
and is collapsed again by A5; fault layer = fixed per-nation coordinates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quantspark.functions.clean import bool_text_to_int
from quantspark.functions.numeric import clip, safe_div
from quantspark.operators.stats import global_quantiles, minmax_winsorized, vif_elimination
from quantspark.plans.common import rnd, round_doubles, sql_rnd, sql_round_select
from quantspark.session import materialize
from quantspark.sources.tables import table

INSURANCE = ["Earned_Premium", "Earned_Exposure", "Fire_Risk", "total_wildfire_days", "wildfire_events",
             "lat", "lon", "km_to_fault", "fault_nearby"]
DEMO = ["median_income", "population", "median_home_value", "total_housing_units", "median_year_built",
        "median_rooms", "population_density"]
RISK_FACTORS = ["Wildfire_Risk_per_House", "Earthquake_Risk", "Building_Age", "population_density",
                "High_Risk_Dense_Area"]
TRAIN_YEARS = (1995, 1996, 1997, 1998, 1999)
TEST_YEARS = (2000, 2001)
REFERENCE_YEAR = 2025


def zip_year_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    li = table(spark, sf_dir, "lineitem")
    s = table(spark, sf_dir, "supplier")
    prem = (o.join(c.select("c_custkey", "c_nationkey"), o.o_custkey == c.c_custkey)
             .groupBy(F.col("c_nationkey").alias("zip_code"), F.year("o_orderdate").alias("year"))
             .agg(F.sum("o_totalprice").alias("Earned_Premium"), F.count(F.lit(1)).cast("double").alias("Earned_Exposure"),
                  (F.avg("o_totalprice") / 100000).alias("Fire_Risk")))
    # A4: aggregate events before joining
    fire = (li.filter(F.col("l_returnflag") == "R")
              .join(s.select("s_suppkey", "s_nationkey"), li.l_suppkey == s.s_suppkey)
              .groupBy(F.col("s_nationkey").alias("zip_code"), F.year("l_shipdate").alias("year"))
              .agg(F.sum("l_quantity").alias("total_wildfire_days"), F.count(F.lit(1)).cast("double").alias("wildfire_events")))
    census = (c.groupBy(F.col("c_nationkey").alias("zip_code"), F.col("c_mktsegment").alias("acs_year"))
               .agg(F.avg("c_acctbal").alias("median_income"), F.count(F.lit(1)).cast("double").alias("population"),
                    (F.avg("c_acctbal") * 50).alias("median_home_value"),
                    (F.count(F.lit(1)) / 2.0).alias("total_housing_units"),
                    (1950 + F.max("c_acctbal") / 250).alias("median_year_built"),
                    (F.count(F.lit(1)) % 7 + 2).cast("double").alias("median_rooms"),
                    (F.count(F.lit(1)) * 3.5).alias("population_density")))
    faults = n.select(F.col("n_nationkey").alias("zip_code"),
                      (32.5 + F.col("n_nationkey") * 0.35).alias("lat"),
                      (-124.0 + F.col("n_regionkey") * 1.1).alias("lon"),
                      F.when(F.col("n_nationkey") % 6 == 0, None)
                       .otherwise(F.col("n_nationkey") * 3.0 + 1).alias("km_to_fault"))
    faults = faults.withColumn("fault_nearby", F.when(F.col("km_to_fault") <= 10, "True").otherwise("False"))
    # (zip, year) left join, then zip-only left joins (census fans out)
    d = (prem.join(fire, ["zip_code", "year"], "left")
             .fillna(0.0, subset=["total_wildfire_days", "wildfire_events"])
             .join(census.drop("acs_year"), ["zip_code"], "left")
             .join(faults, ["zip_code"], "left"))
    return d


def zip_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: collapse the fan-out: insurance columns are equal inside a group
    (taken with ``min_by`` on a fixed order), demographics are averaged."""
    d = zip_year_raw(spark, sf_dir)
    aggs = [F.min_by(c, F.struct(*INSURANCE[:2])).alias(c) for c in INSURANCE]
    aggs += [F.avg(c).alias(c) for c in DEMO]
    return d.groupBy("zip_code", "year").agg(*aggs)


def risk_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D7 with the whole-data statistics of the source.
    The collapsed table is written once: several exact quantile passes
    read it."""
    d = materialize(zip_year(spark, sf_dir))
    d = d.withColumn("Revenue_per_Exposure", safe_div("Earned_Premium", "Earned_Exposure"))
    lo, hi = global_quantiles(d, "Revenue_per_Exposure", [0.005, 0.995])
    d = d.filter((F.col("Revenue_per_Exposure") >= lo) & (F.col("Revenue_per_Exposure") <= hi))
    d = d.withColumn("fault_nearby", bool_text_to_int("fault_nearby"))
    d = d.withColumn("Wildfire_Risk_per_House",
                     F.col("total_wildfire_days") / F.when(F.col("total_housing_units") == 0, 1.0)
                     .otherwise(F.col("total_housing_units")))
    (q,) = global_quantiles(d, "Wildfire_Risk_per_House", [0.99])
    d = d.withColumn("Wildfire_Risk_per_House", clip("Wildfire_Risk_per_House", hi=q))
    d = d.withColumn("Building_Age", clip(REFERENCE_YEAR - F.col("median_year_built"), 0.0, 150.0))
    (med,) = global_quantiles(d, "km_to_fault", [0.5])
    d = d.withColumn("km_to_fault", F.coalesce("km_to_fault", F.lit(med)))
    d = d.withColumn("Earthquake_Risk", 1 / (F.col("km_to_fault") + 1))
    (q,) = global_quantiles(d, "Earthquake_Risk", [0.99])
    d = d.withColumn("Earthquake_Risk", clip("Earthquake_Risk", hi=q))
    one_if_zero = lambda c: F.when(F.col(c) == 0, 1.0).otherwise(F.col(c))
    d = d.select("*",
                 clip(F.col("median_income") / one_if_zero("median_home_value"), 0.0, 1.0).alias("Income_to_Home_Value"),
                 clip(F.col("total_housing_units") / one_if_zero("population") * 1000, 0.0, 1000.0).alias("Housing_Density"),
                 clip("median_rooms", 1.0, 15.0).alias("Rooms_per_Unit"),
                 (F.col("Wildfire_Risk_per_House") * F.col("population_density")).alias("High_Risk_Dense_Area"),
                 (F.col("median_income") / 10000 * F.col("Wildfire_Risk_per_House")).alias("Wealth_Risk_Score"))
    q1, = global_quantiles(d, "High_Risk_Dense_Area", [0.99])
    q2, = global_quantiles(d, "Wealth_Risk_Score", [0.99])
    stats = d.agg(F.avg("lat"), F.stddev_samp("lat"), F.avg("lon"), F.stddev_samp("lon")).first()
    d = d.select(*[c for c in d.columns if c not in ("High_Risk_Dense_Area", "Wealth_Risk_Score")],
                 clip("High_Risk_Dense_Area", hi=q1).alias("High_Risk_Dense_Area"),
                 clip("Wealth_Risk_Score", hi=q2).alias("Wealth_Risk_Score"),
                 ((F.col("lat") - stats[0]) / stats[1]).alias("lat_norm"),
                 ((F.col("lon") - stats[2]) / stats[3]).alias("lon_norm"))
    return d.filter(F.col("Revenue_per_Exposure").isNotNull())


def q_d7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(risk_features(spark, sf_dir), 6, {"Earned_Premium": 2})


def pricing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B26 + C4-C6 + C19 + V10: a target-encoding baseline (train-year mean
    per zip, global train mean for unseen), MAE on test years, pricing
    categories, and a composite risk score whose weights are normalised
    absolute train correlations of each risk factor with the target."""
    d = risk_features(spark, sf_dir)
    y = "Revenue_per_Exposure"
    train = d.filter(F.col("year").isin(*TRAIN_YEARS))
    enc = train.groupBy("zip_code").agg(F.avg(y).alias("_zip_mean"))
    gmean = train.agg(F.avg(y)).first()[0]
    t = (d.filter(F.col("year").isin(*TEST_YEARS)).join(enc, "zip_code", "left")
          .withColumn("Predicted", F.coalesce("_zip_mean", F.lit(gmean))).drop("_zip_mean"))
    mae = t.agg(F.avg(F.abs(F.col(y) - F.col("Predicted")))).first()[0]
    # C6 weights from the train rows, C4 normalisation over all rows
    corr = train.agg(*[F.abs(F.corr(f, y)).alias(f) for f in RISK_FACTORS]).first()
    raw = {f: (corr[f] or 0.0) for f in RISK_FACTORS}
    total = sum(raw.values()) or 1.0
    weights = {f: raw[f] / total for f in RISK_FACTORS}
    score = F.lit(0.0)
    for f in RISK_FACTORS:
        lo, hi = global_quantiles(d, f, [0.01, 0.99])
        score = score + minmax_winsorized(F.col(f), F.lit(lo), F.lit(hi)) * weights[f]
    err = F.col(y) - F.col("Predicted")
    return t.select(
        "zip_code", "year", "Earned_Premium", "Earned_Exposure", score.alias("Composite_Risk_Score"),
        F.col(y).alias("Actual_Premium_per_Exposure"), F.col("Predicted").alias("Predicted_Premium_per_Exposure"),
        err.alias("Prediction_Error"), rnd(err / F.col(y) * 100, 2).alias("Prediction_Error_Pct"),
        F.abs(err).alias("Absolute_Error"),
        F.when(F.col(y) < F.col("Predicted") - mae, "UNDERPRICED")
         .when(F.col(y) > F.col("Predicted") + mae, "OVERPRICED").otherwise("Adequate").alias("Pricing_Category"),
        rnd((F.col("Predicted") - F.col(y)) / F.col(y) * 100, 1).alias("Recommended_Rate_Change_Pct"))


def q_b26(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(pricing(spark, sf_dir), 6, {"Earned_Premium": 2})


def q_a10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: dashboard totals per pricing category."""
    p = pricing(spark, sf_dir)
    return round_doubles(p.groupBy("Pricing_Category").agg(
        F.count(F.lit(1)).alias("zips"), F.avg("Composite_Risk_Score").alias("avg_risk"),
        F.sum("Earned_Premium").alias("total_premium"), F.avg("Recommended_Rate_Change_Pct").alias("avg_rate_change")),
        6, {"total_premium": 2})


def q_p23(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P23 + K2: zip codes whose text starts with '1', first 20 in order."""
    d = zip_year(spark, sf_dir)
    z = d.select("zip_code").distinct().filter(F.col("zip_code").cast("string").startswith("1"))
    return z.orderBy("zip_code").limit(20)


def q_c15(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Iterative uncentred VIF elimination over the engineered features
    (one distributed Gram pass, k x k on the driver)."""
    d = risk_features(spark, sf_dir)
    cols = ["Wildfire_Risk_per_House", "Building_Age", "Earthquake_Risk", "Income_to_Home_Value",
            "Housing_Density", "Rooms_per_Unit", "High_Risk_Dense_Area", "Wealth_Risk_Score",
            "median_income", "population", "median_home_value", "total_housing_units",
            "median_year_built", "population_density", "lat_norm", "lon_norm"]
    kept, removed = vif_elimination(d, cols)
    rows = [(c, float(v), i + 1) for i, (c, v) in enumerate(removed)] + [(c, None, None) for c in kept]
    return spark.createDataFrame(rows, "feature string, vif_at_removal double, removal_order int")


# --- DuckDB oracles ---------------------------------------------------------

SQL_RAW = """
WITH prem AS (SELECT c_nationkey AS zip_code, CAST(year(o_orderdate) AS INTEGER) AS year, sum(o_totalprice) AS Earned_Premium,
                     CAST(count(*) AS DOUBLE) AS Earned_Exposure, avg(o_totalprice) / 100000 AS Fire_Risk
              FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
fire AS (SELECT s_nationkey AS zip_code, CAST(year(l_shipdate) AS INTEGER) AS year, sum(l_quantity) AS total_wildfire_days,
                CAST(count(*) AS DOUBLE) AS wildfire_events
         FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_returnflag = 'R' GROUP BY 1, 2),
census AS (SELECT c_nationkey AS zip_code, c_mktsegment AS acs_year, avg(c_acctbal) AS median_income,
                  CAST(count(*) AS DOUBLE) AS population, avg(c_acctbal) * 50 AS median_home_value,
                  CAST(count(*) AS DOUBLE) / 2 AS total_housing_units, 1950 + max(c_acctbal) / 250 AS median_year_built,
                  CAST(count(*) % 7 + 2 AS DOUBLE) AS median_rooms, CAST(count(*) AS DOUBLE) * CAST(3.5 AS DOUBLE) AS population_density
           FROM customer GROUP BY 1, 2),
faults AS (SELECT n_nationkey AS zip_code, CAST(32.5 AS DOUBLE) + n_nationkey * CAST(0.35 AS DOUBLE) AS lat, CAST(-124.0 AS DOUBLE) + n_regionkey * CAST(1.1 AS DOUBLE) AS lon,
                  CASE WHEN n_nationkey % 6 = 0 THEN NULL ELSE n_nationkey * CAST(3.0 AS DOUBLE) + 1 END AS km_to_fault
           FROM nation)
SELECT p.zip_code, p.year, Earned_Premium, Earned_Exposure, Fire_Risk,
       coalesce(total_wildfire_days, 0.0) AS total_wildfire_days, coalesce(wildfire_events, 0.0) AS wildfire_events,
       median_income, population, median_home_value, total_housing_units, median_year_built, median_rooms,
       population_density, lat, lon, km_to_fault,
       CASE WHEN km_to_fault <= 10 THEN 'True' ELSE 'False' END AS fault_nearby
FROM prem p LEFT JOIN fire f ON p.zip_code = f.zip_code AND p.year = f.year
LEFT JOIN census c ON c.zip_code = p.zip_code LEFT JOIN faults x ON x.zip_code = p.zip_code"""

_ins = ", ".join(f"arg_min({c}, (Earned_Premium, Earned_Exposure)) AS {c}" for c in INSURANCE)
_dem = ", ".join(f"avg({c}) AS {c}" for c in DEMO)
SQL_ZIP = f"SELECT zip_code, year, {_ins}, {_dem} FROM ({SQL_RAW}) r GROUP BY 1, 2"


def _clip(x: str, lo: str | None, hi: str | None) -> str:
    out = f"CASE WHEN {x} IS NULL THEN NULL"
    if lo is not None:
        out += f" WHEN {x} < {lo} THEN {lo}"
    if hi is not None:
        out += f" WHEN {x} > {hi} THEN {hi}"
    return out + f" ELSE {x} END"


SQL_RISK = f"""
WITH a AS (SELECT *, Earned_Premium / nullif(Earned_Exposure, 0) AS Revenue_per_Exposure FROM ({SQL_ZIP}) z),
b AS (SELECT * EXCLUDE (fault_nearby), CASE WHEN lower(fault_nearby) = 'true' THEN 1 ELSE 0 END AS fault_nearby
      FROM a WHERE Revenue_per_Exposure >= (SELECT quantile_cont(Revenue_per_Exposure, 0.005) FROM a)
               AND Revenue_per_Exposure <= (SELECT quantile_cont(Revenue_per_Exposure, 0.995) FROM a)),
c0 AS (SELECT *, total_wildfire_days / CASE WHEN total_housing_units = 0 THEN 1.0 ELSE total_housing_units END AS w0 FROM b),
c AS (SELECT * EXCLUDE (w0, km_to_fault), {_clip('w0', None, '(SELECT quantile_cont(w0, 0.99) FROM c0)')} AS Wildfire_Risk_per_House,
             {_clip(f'{REFERENCE_YEAR} - median_year_built', '0.0', '150.0')} AS Building_Age,
             coalesce(km_to_fault, (SELECT quantile_cont(km_to_fault, 0.5) FROM c0)) AS km_to_fault FROM c0),
d0 AS (SELECT *, 1 / (km_to_fault + 1) AS e0 FROM c),
d AS (SELECT * EXCLUDE (e0), {_clip('e0', None, '(SELECT quantile_cont(e0, 0.99) FROM d0)')} AS Earthquake_Risk FROM d0),
e AS (SELECT *,
        {_clip('median_income / CASE WHEN median_home_value = 0 THEN 1.0 ELSE median_home_value END', '0.0', '1.0')} AS Income_to_Home_Value,
        {_clip('total_housing_units / CASE WHEN population = 0 THEN 1.0 ELSE population END * 1000', '0.0', '1000.0')} AS Housing_Density,
        {_clip('median_rooms', '1.0', '15.0')} AS Rooms_per_Unit,
        Wildfire_Risk_per_House * population_density AS h0,
        median_income / 10000 * Wildfire_Risk_per_House AS w1 FROM d)
SELECT * EXCLUDE (h0, w1),
  {_clip('h0', None, '(SELECT quantile_cont(h0, 0.99) FROM e)')} AS High_Risk_Dense_Area,
  {_clip('w1', None, '(SELECT quantile_cont(w1, 0.99) FROM e)')} AS Wealth_Risk_Score,
  (lat - (SELECT avg(lat) FROM e)) / (SELECT stddev_samp(lat) FROM e) AS lat_norm,
  (lon - (SELECT avg(lon) FROM e)) / (SELECT stddev_samp(lon) FROM e) AS lon_norm
FROM e WHERE Revenue_per_Exposure IS NOT NULL"""

_RISK_DOUBLES = ["Earned_Premium", "Earned_Exposure", "Fire_Risk", "total_wildfire_days", "wildfire_events", "lat",
                 "lon", "km_to_fault", *DEMO, "Revenue_per_Exposure", "Wildfire_Risk_per_House", "Building_Age",
                 "Earthquake_Risk", "Income_to_Home_Value", "Housing_Density", "Rooms_per_Unit",
                 "High_Risk_Dense_Area", "Wealth_Risk_Score", "lat_norm", "lon_norm"]
SQL_D7 = sql_round_select(SQL_RISK, ["zip_code", "year", "fault_nearby"], _RISK_DOUBLES, 6, {"Earned_Premium": 2})


def _pricing_sql() -> str:
    tr = ", ".join(str(y) for y in TRAIN_YEARS)
    te = ", ".join(str(y) for y in TEST_YEARS)
    y = "Revenue_per_Exposure"
    corr = ", ".join(f"abs(corr({f}, {y})) AS {f}" for f in RISK_FACTORS)
    tot = " + ".join(f"coalesce(w.{f}, 0)" for f in RISK_FACTORS)
    bounds = ", ".join(f"quantile_cont({f}, 0.01) AS lo_{f}, quantile_cont({f}, 0.99) AS hi_{f}" for f in RISK_FACTORS)
    terms = " + ".join(
        f"(CASE WHEN d.{f} IS NULL THEN NULL WHEN hi_{f} = lo_{f} THEN 0.5 ELSE "
        f"(least(greatest(d.{f}, lo_{f}), hi_{f}) - lo_{f}) / (hi_{f} - lo_{f}) END) * "
        f"(coalesce(w.{f}, 0) / nullif({tot}, 0))" for f in RISK_FACTORS)
    return f"""
WITH d AS ({SQL_RISK}),
tr AS (SELECT * FROM d WHERE year IN ({tr})),
enc AS (SELECT zip_code, avg({y}) AS zm FROM tr GROUP BY 1),
w AS (SELECT {corr} FROM tr),
q AS (SELECT {bounds} FROM d),
t AS (SELECT d.*, coalesce(enc.zm, (SELECT avg({y}) FROM tr)) AS Predicted FROM d LEFT JOIN enc USING (zip_code)
      WHERE year IN ({te})),
m AS (SELECT avg(abs({y} - Predicted)) AS mae FROM t)
SELECT zip_code, year, Earned_Premium, Earned_Exposure, 0.0 + {terms} AS Composite_Risk_Score,
  {y} AS Actual_Premium_per_Exposure, Predicted AS Predicted_Premium_per_Exposure,
  {y} - Predicted AS Prediction_Error, {sql_rnd(f'({y} - Predicted) / {y} * 100', 2)} AS Prediction_Error_Pct,
  abs({y} - Predicted) AS Absolute_Error,
  CASE WHEN {y} < Predicted - m.mae THEN 'UNDERPRICED' WHEN {y} > Predicted + m.mae THEN 'OVERPRICED'
       ELSE 'Adequate' END AS Pricing_Category,
  {sql_rnd(f'(Predicted - {y}) / {y} * 100', 1)} AS Recommended_Rate_Change_Pct
FROM t d, w, q, m"""


SQL_PRICING = _pricing_sql()
SQL_B26 = sql_round_select(SQL_PRICING, ["zip_code", "year", "Pricing_Category"],
                           ["Earned_Premium", "Earned_Exposure", "Composite_Risk_Score", "Actual_Premium_per_Exposure",
                            "Predicted_Premium_per_Exposure", "Prediction_Error", "Prediction_Error_Pct",
                            "Absolute_Error", "Recommended_Rate_Change_Pct"], 6, {"Earned_Premium": 2})
SQL_A10 = sql_round_select(f"""
SELECT Pricing_Category, count(*) AS zips, avg(Composite_Risk_Score) AS avg_risk, sum(Earned_Premium) AS total_premium,
       avg(Recommended_Rate_Change_Pct) AS avg_rate_change FROM ({SQL_PRICING}) p GROUP BY 1""",
    ["Pricing_Category", "zips"], ["avg_risk", "total_premium", "avg_rate_change"], 6, {"total_premium": 2})
SQL_P23 = f"""SELECT DISTINCT zip_code FROM ({SQL_ZIP}) z WHERE CAST(zip_code AS VARCHAR) LIKE '1%'
ORDER BY zip_code LIMIT 20"""

QUERIES = {"d7": q_d7, "b26": q_b26, "a10": q_a10, "p23": q_p23, "c15": q_c15}
ORACLE = {"d7": SQL_D7, "b26": SQL_B26, "a10": SQL_A10, "p23": SQL_P23}


EXPORT_COLUMNS = ["zip_code", "year", "Revenue_per_Exposure", "Earthquake_Risk", "Wildfire_Risk_per_House",
                  "Building_Age", "fault_nearby"]


def missing_columns(df: DataFrame, required) -> list[str]:
    """Required columns absent from the schema (driver-side,
    metadata only)."""
    have = set(df.columns)
    return [c for c in required if c not in have]


def q_p26(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P26 + A20: record export of the risk table: required columns
    checked, null / infinite numbers written as 0, flags as integers."""
    d = risk_features(spark, sf_dir)
    missing = missing_columns(d, EXPORT_COLUMNS)
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    num = [c for c in EXPORT_COLUMNS if c not in ("zip_code", "year", "fault_nearby")]
    out = d.select("zip_code", "year",
                   *[F.when(F.col(c).isNull() | F.col(c).isin(float("inf"), float("-inf")), F.lit(0.0))
                      .otherwise(F.col(c)).alias(c) for c in num],
                   F.col("fault_nearby").cast("int").alias("fault_nearby"))
    return round_doubles(out)


SQL_P26 = sql_round_select(f"""SELECT zip_code, year,
  {', '.join(f"CASE WHEN {c} IS NULL OR isinf({c}) THEN 0.0 ELSE {c} END AS {c}"
             for c in ["Revenue_per_Exposure", "Earthquake_Risk", "Wildfire_Risk_per_House", "Building_Age"])},
  CAST(fault_nearby AS INTEGER) AS fault_nearby FROM ({SQL_RISK}) r""",
    ["zip_code", "year", "fault_nearby"], ["Revenue_per_Exposure", "Earthquake_Risk", "Wildfire_Risk_per_House",
                                           "Building_Age"])

QUERIES["p26"] = q_p26
ORACLE["p26"] = SQL_P26
