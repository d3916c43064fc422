"""Every ranked pair, against the DuckDB oracle on the smallest tables."""

from collections import Counter

import duckdb

import __spark_entry__ as E
from weft.operators import stats

SF = "/root/testdata/sf0.001"


def test_all_pair_scores_match_the_oracle(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    got = Counter((*r[:3], round(r[3], 6)) for r in E.queries()["h10_pair_scores"](spark, SF).collect())
    want = Counter((*r[:3], round(r[3], 6)) for r in con.execute(E.oracle_sql()["h10_pair_scores"]).fetchall())
    assert got == want and sum(got.values()) > 20


def test_byte_counts_equal_a_plain_count(spark, monkeypatch):
    rows = [("a", "aab"), ("a", None), ("b", "ä\0"), (None, ""), (None, "ba"), ("b", "x" * 5000 + "y"), ("a", "aab")]
    df = spark.createDataFrame(rows, "g STRING, t STRING").repartition(2)
    want = Counter()
    for g, t in rows:
        raw = (t or "").encode()
        want.update((g, x, None) for x in raw)
        want.update((g, x, y) for x, y in zip(raw, raw[1:]))
    for name, value in (("COUNT_GROUPS", 64), ("COUNT_GROUPS", 1), ("COUNT_BYTES", 3)):
        monkeypatch.setattr(stats, name, value)
        assert {tuple(r)[:3]: r["n"] for r in stats.byte_counts(df, "t", ["g"], pairs=True).collect()} == want
    single = {r["byte"]: r["n"] for r in stats.byte_counts(df, "t").collect()}
    assert single == Counter(x for _, t in rows for x in (t or "").encode())
