"""Market-data shaped views of the star-schema tables: prices, statements, profiles, events, chains, macro series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _symbol(c: str) -> F.Column:
    return F.concat(F.lit("S"), F.col(c).cast("string"))


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars: a supplier's line items of one ship day.

    Rows are shuffled once, by symbol and as they are read: a day has hardly more than one, whose sums in parts would be larger. What follows by symbol and date finds them in place and in order.
    """
    px = F.col("l_extendedprice") / F.col("l_quantity")
    order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    rows = table(spark, sf_dir, "lineitem").withColumns({"symbol": _symbol("l_suppkey"), "date": F.to_date("l_shipdate")}).repartition("symbol")
    return rows.groupBy("symbol", "date").agg(
        F.min_by(px, order).alias("open"), F.max(px).alias("high"), F.min(px).alias("low"), F.max_by(px, order).alias("close"), F.sum("l_quantity").alias("volume")
    )


PRICES = """prices AS (SELECT concat('S', l_suppkey) AS symbol, cast(l_shipdate AS DATE) AS date,
  arg_min(l_extendedprice / l_quantity, (l_orderkey, l_linenumber, l_partkey, l_extendedprice)) AS open, max(l_extendedprice / l_quantity) AS high,
  min(l_extendedprice / l_quantity) AS low, arg_max(l_extendedprice / l_quantity, (l_orderkey, l_linenumber, l_partkey, l_extendedprice)) AS close,
  sum(l_quantity) AS volume FROM lineitem GROUP BY ALL)"""


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarterly statements: a supplier's line items by quarter end of the ship day."""
    li = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    end = F.last_day(F.add_months(F.date_trunc("quarter", F.col("l_shipdate").cast("timestamp")).cast("date"), 2))
    revenue = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return li.groupBy(_symbol("l_suppkey").alias("symbol"), end.alias("period_ending")).agg(
        F.sum(revenue).alias("revenue"), F.sum(F.col("p_retailprice") * F.col("l_quantity") * 0.5).alias("cost"), F.sum("l_quantity").alias("shares"),
        F.sum(F.col("l_tax") * F.col("l_extendedprice")).alias("debt"), F.sum(F.col("l_discount") * F.col("l_extendedprice")).alias("cash"),
    ).withColumn("net_income", F.col("revenue") - F.col("cost"))


STATEMENTS = """statements AS (SELECT *, revenue - cost AS net_income FROM (SELECT concat('S', l_suppkey) AS symbol,
  cast(date_trunc('quarter', l_shipdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS period_ending, sum(l_extendedprice * (1 - l_discount)) AS revenue,
  sum(p_retailprice * l_quantity * 0.5) AS cost, sum(l_quantity) AS shares, sum(l_tax * l_extendedprice) AS debt, sum(l_discount * l_extendedprice) AS cash
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL))"""


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each supplier: sector is the region, country the nation, market cap the balance."""
    s = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    exchange = F.when(F.col("s_suppkey") % 3 == 0, "NYSE").when(F.col("s_suppkey") % 3 == 1, "NASDAQ").otherwise("AMEX")
    return s.select(_symbol("s_suppkey").alias("symbol"), F.col("r_name").alias("sector"), F.col("n_name").alias("country"), F.col("s_acctbal").alias("market_cap"), exchange.alias("exchange"), (F.col("s_suppkey") % 10 == 7).alias("is_etf"))


PROFILES = """profiles AS (SELECT concat('S', s_suppkey) AS symbol, r_name AS sector, n_name AS country, s_acctbal AS market_cap,
  CASE s_suppkey % 3 WHEN 0 THEN 'NYSE' WHEN 1 THEN 'NASDAQ' ELSE 'AMEX' END AS exchange, s_suppkey % 10 = 7 AS is_etf
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Disclosed trades: who bought or sold what, when, and when it was reported."""
    o, li, c = (table(spark, sf_dir, t) for t in ("orders", "lineitem", "customer"))
    rows = o.join(li, F.col("o_orderkey") == F.col("l_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey"))
    side = F.when(F.col("o_orderstatus") == "F", "P-Purchase").when(F.col("o_orderstatus") == "O", "S-Sale").otherwise("M-Exempt")
    return rows.select(_symbol("l_suppkey").alias("symbol"), F.to_date("o_orderdate").alias("event_date"), F.to_date("l_shipdate").alias("reported_date"), F.col("c_name").alias("actor"), F.col("c_mktsegment").alias("role"), side.alias("transaction"), F.col("l_quantity").alias("shares"), F.col("l_extendedprice").alias("value"))


EVENTS = """raw_events AS (SELECT concat('S', l_suppkey) AS symbol, cast(o_orderdate AS DATE) AS event_date, cast(l_shipdate AS DATE) AS reported_date, c_name AS actor,
  c_mktsegment AS role, CASE o_orderstatus WHEN 'F' THEN 'P-Purchase' WHEN 'O' THEN 'S-Sale' ELSE 'M-Exempt' END AS transaction, l_quantity AS shares, l_extendedprice AS value
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey)"""


def chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Option quotes: a supplier's line items, the part being the contract; the last item of a day and contract counts."""
    li = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    day, px = F.to_date("l_shipdate"), F.col("l_extendedprice") / F.col("l_quantity")
    last = F.max_by(F.struct(px.alias("ask"), (px * (1 - F.col("l_discount"))).alias("bid"), F.col("l_quantity").alias("volume")), F.struct("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_discount"))
    rows = li.groupBy(_symbol("l_suppkey").alias("underlying"), day.alias("snapshot_date"), F.col("l_partkey").alias("part"), "p_retailprice", "p_size").agg(last.alias("q"))
    return rows.select("underlying", "snapshot_date", F.date_add("snapshot_date", F.col("p_size") + 30).alias("expiration"), F.col("p_retailprice").alias("strike"), F.when(F.col("p_size") % 2 == 0, "CALL").otherwise("PUT").alias("right"), "part", "q.ask", "q.bid", "q.volume")


CHAIN = """chain AS (SELECT underlying, snapshot_date, cast(snapshot_date + INTERVAL 1 DAY * (p_size + 30) AS DATE) AS expiration, strike, "right", part, q.ask AS ask, q.bid AS bid, q.volume AS volume FROM (
  SELECT concat('S', l_suppkey) AS underlying, cast(l_shipdate AS DATE) AS snapshot_date, p_size, p_retailprice AS strike, CASE WHEN p_size % 2 = 0 THEN 'CALL' ELSE 'PUT' END AS "right", l_partkey AS part,
  arg_max({'ask': l_extendedprice / l_quantity, 'bid': l_extendedprice / l_quantity * (1 - l_discount), 'volume': l_quantity}, (l_orderkey, l_linenumber, l_extendedprice, l_quantity, l_discount)) AS q
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL))"""


def macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly series: a region's mean order price."""
    o, c, n, r = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation", "region"))
    rows = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.groupBy(F.concat(F.lit("macro__"), F.lower(F.regexp_replace("r_name", " ", "_"))).alias("series_code"), F.last_day("o_orderdate").alias("date")).agg(F.avg("o_totalprice").alias("value"))


MACRO = """macro AS (SELECT concat('macro__', lower(replace(r_name, ' ', '_'))) AS series_code, cast(last_day(o_orderdate) AS DATE) AS date, avg(o_totalprice) AS value
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL)"""
