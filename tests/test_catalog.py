import re

import pytest

from candlewright.plans import catalog
from candlewright.plans.sql import ORACLES

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
FAST = ["ohlcv_1h", "fold_flags_by_symbol", "gap_ranges", "asof_1h_4h_close", "asof_1h_1d_open", "pivots_3_3", "open_liquidity_ranks", "order_block_events", "special_30m", "special_30m_outcomes", "special_4h_outcomes", "swing_formations", "conservation", "rank_percentiles"]


def show(row):
    return tuple(f"{v:.12g}" if isinstance(v, float) else repr(v) for v in row)


@pytest.mark.parametrize("name", FAST)
def test_query_equals_sql_on_a_table_with_gaps(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{SF}/events.parquet'")
    df = catalog.queries()[name](spark, SF)
    columns = sorted(df.columns)
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(show, df.select(*columns).collect())) == sorted(map(show, want))


def test_names():
    assert set(ORACLES) <= set(catalog.queries()) and all(re.fullmatch(r"\w+", n) for n in catalog.queries())
