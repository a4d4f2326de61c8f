"""Round trips through file formats (S1, S3, S4, S6, S8-S10, S12, R1, R3,
P2, P6, P22, U1, J7). Each query writes a table derived from the driver
tables to the shared checkpoint folder in a messy layout and reads it back
through the cleaning readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantspark.plans.common import round_doubles, sql_round_select
from quantspark.session import ensure_checkpoint_dir
from quantspark.sources import files as FS
from quantspark.sources.tables import daily_prices, table

TICKERS = ("click", "error", "purchase", "signup", "view")
FACTORS = ("Mkt-RF", "SMB", "HML", "RF")


def q_s4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide price file: R3 pivot of daily closes, two header-like junk rows
    (U1), CSV write (S9), all-string read (S1, S3), junk filter (S4),
    wide-to-long with nulls kept (R1), lenient cast (P2)."""
    ensure_checkpoint_dir(spark)
    px = daily_prices(spark, sf_dir)
    wide = px.groupBy(F.date_format("date", "yyyy-MM-dd").alias("Date")).pivot("ticker", list(TICKERS)).agg(F.max("close"))
    wide = wide.select("Date", *[F.col(t).cast("string").alias(t) for t in TICKERS])
    junk = spark.createDataFrame([("Ticker", *TICKERS), ("Field", *["PX_LAST"] * len(TICKERS))],
                                 T.StructType([T.StructField(c, T.StringType()) for c in ("Date", *TICKERS)]))
    path = FS.write_csv(junk.unionByName(wide), FS.scratch_path(spark, "wide-prices"))
    back = FS.drop_junk_rows(FS.read_csv_strings(spark, path, ["Date", *TICKERS]), "Date", "yyyy-MM-dd")
    long = back.unpivot("Date", list(TICKERS), "ticker", "close_text")
    return round_doubles(long.select(F.col("Date").alias("date"), "ticker",
                                     F.col("close_text").try_cast("double").alias("close")))


def q_s6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Factor file with a preamble and yyyyMMdd dates (S6), read back and
    inner-joined on date with daily market returns (J7)."""
    ensure_checkpoint_dir(spark)
    li = table(spark, sf_dir, "lineitem")
    day = F.to_date("l_shipdate")
    f = li.groupBy(day.alias("d")).agg((F.avg("l_discount") * 100).alias("m"), (F.avg("l_tax") * 100).alias("s"),
                                      (F.avg("l_quantity") - 25).alias("h"), F.lit(0.01).alias("r"))
    lines = f.select(F.concat_ws(",", F.date_format("d", "yyyyMMdd"), *[F.col(c).cast("string") for c in "mshr"]).alias("value"))
    pre = spark.createDataFrame([("This file was created from the line items",), ("Daily factors",), ("",),
                                 (",Mkt-RF,SMB,HML,RF",)], "value string")
    path = FS.scratch_path(spark, "factors")
    pre.unionByName(lines).write.mode("overwrite").text(path)
    fac = FS.read_factor_file(spark, path, ["date_text", *[c.replace("-", "_") for c in FACTORS]])
    mkt = li.groupBy(day.alias("date")).agg(F.avg(F.col("l_extendedprice") / F.col("l_quantity")).alias("px"))
    return round_doubles(fac.join(mkt, "date", "inner"))


def q_s8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitioned parquet write of the daily prices (S8), a pruned read of
    two tickers (P22 membership), JSON write/read of the result (S10), and
    time-column discovery on the JSON header (S12)."""
    ensure_checkpoint_dir(spark)
    px = daily_prices(spark, sf_dir).withColumn("timestamp", F.unix_timestamp(F.col("date").cast("timestamp")))
    path = FS.write_partitioned_parquet(px, FS.scratch_path(spark, "prices"), ["ticker"])
    sel = spark.read.parquet(path).filter(F.col("ticker").isin("click", "view"))
    jpath = FS.write_json(sel, FS.scratch_path(spark, "prices-json"))
    back = spark.read.schema("ticker string, timestamp long, open double, close double").json(jpath)
    tcol = FS.discover(back.columns, FS.TIME_CANDIDATES)
    ccol = FS.discover(back.columns, FS.CLOSE_CANDIDATES)
    out = back.select("ticker", FS.parse_time(tcol).cast("timestamp_ntz").alias("ts"), F.col(ccol).alias("close"), "open")
    return round_doubles(out)


# --- DuckDB oracles ---------------------------------------------------------

_PX = """SELECT event_type AS ticker, CAST(ts AS DATE) AS date, arg_min(value + 1.0, (ts, event_id)) AS open,
  arg_max(value + 1.0, (ts, event_id)) AS close FROM events GROUP BY 1, 2"""
_TICK_VALUES = ", ".join(f"('{t}')" for t in TICKERS)
SQL_S4 = sql_round_select(f"""
WITH px AS ({_PX}), d AS (SELECT DISTINCT date FROM px)
SELECT strftime(d.date, '%Y-%m-%d') AS date, t.ticker, px.close
FROM d CROSS JOIN (VALUES {_TICK_VALUES}) t(ticker) LEFT JOIN px ON px.date = d.date AND px.ticker = t.ticker""",
    ["date", "ticker"], ["close"])
SQL_S6 = sql_round_select("""
WITH f AS (SELECT CAST(l_shipdate AS DATE) AS date, avg(l_discount) * 100 / 100 AS Mkt_RF, avg(l_tax) * 100 / 100 AS SMB,
                  (avg(l_quantity) - 25) / 100 AS HML, 0.01 / 100 AS RF FROM lineitem GROUP BY 1),
m AS (SELECT CAST(l_shipdate AS DATE) AS date, avg(l_extendedprice / l_quantity) AS px FROM lineitem GROUP BY 1)
SELECT * FROM f JOIN m USING (date)""", ["date"], ["Mkt_RF", "SMB", "HML", "RF", "px"], dates=["date"])
SQL_S8 = sql_round_select(f"""SELECT ticker, CAST(date AS TIMESTAMP) AS ts, close, open FROM ({_PX}) p
WHERE ticker IN ('click', 'view')""", ["ticker", "ts"], ["close", "open"])

QUERIES = {"s4": q_s4, "s6": q_s6, "s8": q_s8}
ORACLE = {"s4": SQL_S4, "s6": SQL_S6, "s8": SQL_S8}


FIELDS = ("OPEN", "CLOSE")


def q_s5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A price file whose header spans rows: a 'Ticker' row naming each
    ticker once (blank cells continue it to the right) and a 'Date' row of
    field codes. The two header rows are found by their marker cell (two
    small rows reach the driver), the column -> (ticker, field) map is built
    with a forward fill across columns, and the data rows are unpivoted to
    long form (nulls kept) and widened to one row per (date, ticker)."""
    ensure_checkpoint_dir(spark)
    px = daily_prices(spark, sf_dir)
    n_cols = 1 + len(TICKERS) * len(FIELDS)
    names = [f"c{i}" for i in range(n_cols)]
    wide = px.groupBy(F.date_format("date", "yyyy-MM-dd").alias("c0")).pivot("ticker", list(TICKERS)).agg(
        F.max("open").alias("o"), F.max("close").alias("c"))
    data_cols = [F.col(f"{t}_{f}").cast("string") for t in TICKERS for f in ("o", "c")]
    wide = wide.select("c0", *[c.alias(names[i + 1]) for i, c in enumerate(data_cols)])
    ticker_row = ["Ticker"] + [t if j == 0 else "" for t in TICKERS for j in range(len(FIELDS))]
    field_row = ["Date"] + [f for _ in TICKERS for f in FIELDS]
    head = spark.createDataFrame([("Exported prices",) + ("",) * (n_cols - 1), tuple(ticker_row), tuple(field_row)],
                                 ", ".join(f"{n} string" for n in names))
    path = FS.write_csv(head.unionByName(wide), FS.scratch_path(spark, "two-level-header"))
    raw = FS.read_csv_strings(spark, path, names, header=True)
    hdr = {r["c0"]: r for r in raw.filter(F.col("c0").isin("Ticker", "Date")).collect()}
    cur, mapping = None, {}
    for n in names[1:]:
        t = hdr["Ticker"][n]
        cur = t if t else cur
        mapping[n] = (cur, hdr["Date"][n])
    body = FS.drop_junk_rows(raw, "c0", "yyyy-MM-dd")
    long = body.unpivot("c0", names[1:], "col", "v")
    m = spark.createDataFrame([(k, t, f) for k, (t, f) in mapping.items()], "col string, ticker string, field string")
    long = long.join(F.broadcast(m), "col")
    out = long.groupBy(F.col("c0").alias("date"), "ticker").pivot("field", list(FIELDS)).agg(
        F.first(F.col("v").try_cast("double")))
    return round_doubles(out.select("date", "ticker", F.col("OPEN").alias("open"), F.col("CLOSE").alias("close")))


SQL_S5 = sql_round_select(f"""
WITH px AS ({_PX}), d AS (SELECT DISTINCT date FROM px)
SELECT strftime(d.date, '%Y-%m-%d') AS date, t.ticker, px.open, px.close
FROM d CROSS JOIN (VALUES {_TICK_VALUES}) t(ticker) LEFT JOIN px ON px.date = d.date AND px.ticker = t.ticker""",
    ["date", "ticker"], ["open", "close"])

QUERIES["s5"] = q_s5
ORACLE["s5"] = SQL_S5


def q_s13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer extract whose ZIP-like column is found by name
    pattern and content (5 digits); a look-alike column with the right name
    but other content is skipped."""
    ensure_checkpoint_dir(spark)
    c = table(spark, sf_dir, "customer")
    ext = c.select(F.col("c_custkey").cast("string").alias("id"),
                   F.concat(F.lit("G"), F.col("c_nationkey").cast("string")).alias("GEOID_zip"),
                   F.lpad((F.col("c_custkey") % 100000).cast("string"), 5, "0").alias("ZCTA5CE20"),
                   F.col("c_acctbal").cast("string").alias("balance"))
    path = FS.write_csv(ext, FS.scratch_path(spark, "zcta"))
    back = FS.read_csv_strings(spark, path, ["id", "GEOID_zip", "ZCTA5CE20", "balance"])
    col = FS.discover_by_content(back, r"zip|zcta", r"\d{5}")
    return round_doubles(back.select(F.col("id").cast("long").alias("id"), F.col(col).alias("zip_code"),
                                     F.col("balance").try_cast("double").alias("balance")))


SQL_S13 = sql_round_select("""SELECT c_custkey AS id, lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS zip_code,
  c_acctbal AS balance FROM customer""", ["id", "zip_code"], ["balance"])

QUERIES["s13"] = q_s13
ORACLE["s13"] = SQL_S13
