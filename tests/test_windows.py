import datetime as dt
import os

import duckdb
import pytest

import __spark_entry__ as entry
from lodestone.operators import asof
from lodestone.plans import tables

SF = "/root/testdata/sf0.001"
D = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)


def test_every_trade_meets_its_quotes(spark):
    trades = [(s, D(n)) for s in "AB" for n in range(0, 62, 3)] + [("A", D(3)), ("C", D(1)), (None, D(1)), ("A", None)]
    quotes = [(s, D(n), p) for s in "AB" for n in range(70) if n % 4 for p in range(1 + n % 2)] + [(None, D(1), 1), ("B", None, 2)]
    got = tables.trade_window_quotes(spark.createDataFrame(trades, "symbol string, event_date date"), spark.createDataFrame(quotes, "underlying string, snapshot_date date, part int"))
    want = {(s, a, d, p) for s, a in trades if s and a for u, d, p in quotes if u == s and d and a <= d <= a + dt.timedelta(5)}
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(want) and set(rows) == want and len({a.day for _, a, _, _ in want}) > 15


def test_window_that_stops_before_it_starts(spark):
    trades = spark.createDataFrame([("A", D(5), D(3)), ("A", D(3), D(3)), ("A", D(3), None)], "symbol string, a date, z date")
    quotes = spark.createDataFrame([("A", D(n)) for n in range(9)], "symbol string, day date")
    assert [(r.a, r.day) for r in asof.window_join(trades, quotes, start="a", stop="z", on="day").collect()] == [(D(3), D(3))]


def test_all_trades_equal_their_sql(spark):
    if not os.path.exists(SF):
        pytest.skip("needs the generated tables")
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    name, columns = "j13_all_trade_window_quotes", ("symbol", "entry_date", "snapshot_date", "part")
    rows = sorted(tuple(r) for r in entry.queries()[name](spark, SF).select(*columns).collect())
    assert rows == sorted(con.execute(f"select {', '.join(columns)} from ({entry.oracle_sql()[name]})").fetchall())
    assert len({r[1][8:] for r in rows}) > 25  # trades of all days of a month
