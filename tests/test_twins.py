"""Registered queries against their SQL in another engine."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from barloom.operators.catalog import features

SF = "/root/testdata/sf0.01"
SOME = ["rv_logret", "midrange_cross_count", "pac_ret_lag1_5", "mutual_info_ret_volume_q8", "hurst_rs_ret", "approx_entropy_absret_m2_r02", "sample_entropy_absret_m2_r02", "qn_vol_logret", "theil_sen_slope_close_time", "spectral_entropy_close", "spectral_lowfreq_share_close", "jump_count_local_k3_win21", "dc_count_bps_10", "lz_complexity_signret", "share_in_runs_len_ge3", "quote_tw_spread_all", "quote_stale_quote_share_all", "quote_tape_mid_change_z_all", "quote_mid_persistence_median_all", "trade_rth_dollar_volume"]


@pytest.mark.parametrize("name", SOME)
def test_same_rows(spark, name):
    got = entry.queries()[name](spark, SF).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF}/events.parquet')")
    want = con.execute(entry.oracle_sql()[name]).df()
    for x in (got, want):
        x["date"] = pd.to_datetime(x["date"])
    both = got.merge(want, on=["date", "symbol"], how="outer", suffixes=("", "_want"), indicator=True)
    assert (both._merge == "both").all()
    assert ((both.value == both.value_want) | (both.value.isna() & both.value_want.isna())).all()
    assert both.value.notna().any()


def test_catalog_is_whole():
    known = features()
    assert len(known) == 351
    assert sum(f.source == "quotes" for f in known.values()) == 29


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
