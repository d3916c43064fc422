"""A sample of registered queries against their DuckDB oracles on the smallest tables
(the full sweep is tools/oracle_check.py)."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = "events documents embeddings labels conversations benchmark".split()
SAMPLE = ["d1_pretrain_rows", "c1_render_tools", "d7_sft_rows", "b2_pair_counts", "e10_gae",
          "e11_normalised_returns", "f8_rewards", "g4_top_p", "h1_cosine_neighbours", "d13_batches"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(dcols)
    order = sorted(dcols)
    srows = Counter(tuple(_norm(r[c]) for c in order) for r in sdf.collect())
    drows = Counter(tuple(_norm(r[dcols.index(c)]) for c in order) for r in cur.fetchall())
    assert srows == drows
