"""Some of the registered queries against their SQL on the smallest tables; the rest runs the same way."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from lodestone.operators import indicators
from lodestone.views import prices

SF = "/root/testdata/sf0.001"
NAMES = ["p01_returns", "p04_bands", "p08_channels", "l02_cross_sectional_rank", "l12_global_rank", "j01_asof_nearest", "j05_align_events", "s13_upsert", "s26_contiguous_ranges", "f20_insider_activity", "e11_event_study", "v01_daily_rank_ic", "o09_return_rank", "p12_p13_all_price_features", "p16_p18_p20_p21_window_indicators", "p22_special_indicators", "p23_output_contract", "l04_oracle_gains", "f06_f08_f12_income_section", "f11_repriced_ratios", "f15_growth_section", "f27_f28_gated_panels",
    "e03_e07_analyst_ratings", "e02_e07_e08_insider_congress", "e04_e07_institutional_dividend_split_earnings", "j12_contracts_with_fallback", "j07_j08_j14_j15_profile_joins", "v04_family_table", "v06_pooled_spearman", "v07_variant_winners", "l19_matrix_status", "o11_o12_equity_legs"]


@pytest.fixture(scope="module")
def duck():
    if not os.path.exists(SF):
        pytest.skip("needs the generated tables")
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, duck, name):
    got = entry.queries()[name](spark, SF)
    names = sorted(got.columns)
    show = lambda x: f"{x:.9g}" if isinstance(x, float) else str(x)
    rows = sorted(tuple(show(r[c]) for c in names) for r in got.collect())
    want = duck.execute(f"select {', '.join(chr(34) + c + chr(34) for c in names)} from ({entry.oracle_sql()[name]})").fetchall()
    assert rows == sorted(tuple(map(show, r)) for r in want)


def test_recursive_indicators_give_all_their_columns(spark):
    if not os.path.exists(SF):
        pytest.skip("needs the generated tables")
    got = entry.queries()["p17_p19_recursive_indicators"](spark, SF)
    per_family = [f"ta__{k}" for f in (indicators.momentum_recursive, indicators.overlap_recursive) for k in f(indicators._sample())]
    assert got.columns == ["symbol", "date", *per_family, *(f"ta__ha_{k}" for k in ("open", "high", "low", "close"))]
    rows = got.toPandas()
    assert len(rows) == prices(spark, SF).count() and rows[["ta__rsi_14", "ta__psar", "ta__ha_open"]].notna().any().all()
