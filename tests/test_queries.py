"""Every query of the news operators against its SQL, over the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from newsloom.plans import oracles, queries  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    return v


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_query(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    df = queries.queries()[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted(repr([plain(r[c]) for c in cols]) for r in df.collect())
    found = con.execute(oracles.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    want = sorted(repr([plain(r[names.index(c)]) for c in cols]) for r in found.fetchall())
    assert got == want


def test_hash_embeddings_take_whole_texts(spark, tmp_path):
    rows = [(1, " " * 50 + "late text"), (2, "  "), (3, "x")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert {r["doc_id"] for r in queries.queries()["hash_embeddings"](spark, str(tmp_path)).collect()} == {1, 3}


def test_entry_without_the_training_data_operators():
    import __spark_entry__ as e

    assert set(oracles.oracle_sql()) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
