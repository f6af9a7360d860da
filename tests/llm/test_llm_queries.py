"""Registered queries against their SQL, and the pipeline against its stages done by hand."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
from newsloom.llm import jaccard, oracles, quality, queries  # noqa: E402

TABLES = "documents pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_query(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    df = queries.queries()[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted(repr([r[c] for c in cols]) for r in df.collect())
    found = con.execute(oracles.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    assert got == sorted(repr([r[names.index(c)] for c in cols]) for r in found.fetchall())


def test_ten_operators_and_the_pipeline_are_registered():
    import __spark_entry__ as e

    names = list(e.queries())
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10
    assert "pipeline" in names


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    lines = lambda tag: [" ".join(f"{tag}{i}x{j}" for j in range(12)) + "." for i in range(6)]
    good, other = "\n".join(lines("good")), "\n".join(lines("other"))
    leak = "\n".join([*lines("leak"), "It holds words w0 x0 y0 z0 and is long enough to stay."])
    rows = [(1, good), (2, good), (3, good + " one more"), (4, other + "\nWrite to jo@example.org now please."), (5, leak), (6, "%%% " * 50), (7, None), (8, "short")]
    spark.createDataFrame([(i, t, "en", "s", len(t or ""), "extra") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, token string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, "holds words w0 x0 y0 z0 and is long enough to")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert sorted(got) == [1, 4]
    assert got[1]["text"] == good and "[EMAIL]" in got[4]["text"] and got[4]["n_chars"] == len(got[4]["text"])
    assert got[1]["n_tokens"] == len(got[1]["token_ids"]) and got[1]["token"] == "extra"
    assert [s for s, _ in corpus_pipeline.STAGES] == ["quality rules", "n-gram Jaccard join", "benchmark decontamination", "PII", "BPE encoding and decoding"]


def test_hot_copies(spark):
    """A third of all rows are copies of one text; the classes come out right and none is lost."""
    import random

    from newsloom.llm.common import Scratch

    rng = random.Random(8)
    hot = " ".join(f"h{i}" for i in range(60))
    rows = [(i, hot if i % 3 == 0 else " ".join(f"r{rng.randrange(10**6)}" for _ in range(30))) for i in range(600)]
    got = jaccard.classes(spark.createDataFrame(rows, "doc_id long, text string"), Scratch(spark, "t"))
    assert got.where("component_id = 0").count() == 200 and got.select("component_id").distinct().count() == 401
    assert quality.judge(hot.encode())["kept"]


def test_pipeline_on_empty_tables(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
