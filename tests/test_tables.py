import datetime as dt

from lodestone.operators import upsert
from lodestone.sources import normalize, tables

D = lambda s: dt.date.fromisoformat(s)


def test_features_by_recipe(spark, tmp_path):
    df = spark.createDataFrame([("A", D("2024-01-01"), 1.0), ("A", D("2024-01-03"), 2.0)], "symbol string, date date, x double")
    one, two = {"windows": [5, 10]}, {"windows": [5]}
    tables.write_features(df, str(tmp_path / "f"), one)
    tables.write_features(df.limit(0), str(tmp_path / "f"), two)
    tables.write_features(df.withColumn("x", df.x + 1), str(tmp_path / "f"), two)
    assert [r.x for r in tables.read_features(spark, str(tmp_path / "f"), one, start="2024-01-02").collect()] == [2.0]
    assert sorted(r.x for r in tables.read_features(spark, str(tmp_path / "f"), two).collect()) == [2.0, 3.0]
    assert tables.recipe_id({"b": 1, "a": 2}) == tables.recipe_id({"a": 2, "b": 1}) and len(tables.recipe_id(one)) == 16
    tables.save(df, str(tmp_path / "c"), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 2


def test_prices_are_normalised(spark):
    raw = spark.createDataFrame([("A", "2024-01-01", "1.5", "x", 7.0, 1), ("A", "2024-01-01", "2.5", "inf", 8.0, 2), ("A", "1890-01-01", "1", "1", 1.0, 3), ("A", None, "1", "1", 1.0, 4)], "symbol string, date string, Close string, Vol string, marketCap double, seq int")
    rows = normalize.normalize_prices(raw, "v").collect()
    assert [(r.date, r.close, r.volume, r["v__market_cap"]) for r in rows] == [(D("2024-01-01"), 2.5, None, 8.0)]


def test_gaps(spark):
    days = spark.createDataFrame([("A", D(f"2024-01-{d:02}")) for d in (1, 2, 4, 5, 8, 9)], "symbol string, date date")
    runs = sorted((r.start.day, r.end.day, r.days) for r in upsert.contiguous_ranges(days, ["symbol"]).collect())
    assert runs == [(1, 2, 2), (4, 9, 4)]
    assert sorted(r.days for r in upsert.contiguous_ranges(days, ["symbol"], most=3).collect()) == [1, 2, 3]


def test_fallback_takes_the_first_table_with_rows(spark):
    a, b = spark.createDataFrame([("A", 1)], "symbol string, x int"), spark.createDataFrame([("A", 2), ("B", 3)], "symbol string, x int")
    assert sorted((r.symbol, r.x) for r in tables.fallback(a, b).collect()) == [("A", 1), ("B", 3)]
