import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.operators import buckets, events, graph, linking, providers, select, similar, topics
from newsloom.sources import readers, sinks
from newsloom.sources.scratch import Scratch


def test_path_counts_unknown_time_once_and_skips_blank_media(spark):
    rows = [(1, "2024-01-01 00:00:00", "a", 0), (1, "2024-01-01 01:00:00", " a ", 1), (1, None, "b", 2), (1, None, " ", 3), (2, "2024-01-01 00:00:00", "a", 4), (2, "2024-01-01 00:00:00", "b", 5)]
    df = spark.createDataFrame(rows, "g long, ts string, m string, o long").withColumn("ts", F.col("ts").cast("timestamp"))
    got = {r["g"]: (r["path"], r["items_in_group"]) for r in select.propagation_path(df, "g", "ts", "m", "o").collect()}
    assert got == {1: ("a——>b", 4)}


def test_earliest_keeps_ungrouped(spark):
    df = spark.createDataFrame([(1, "2024-01-02", 0), (1, "2024-01-01", 1), (-1, None, 2), (-1, None, 3)], "g int, ts string, o int")
    assert sorted(r["o"] for r in select.earliest_per_group(df, "g", "ts", "o").collect()) == [1, 2, 3]


def test_npmi_of_sure_pair_is_null(spark):
    ctx = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (2, "b")], "context int, item string")
    row = graph.npmi(ctx).first()
    assert row["cooc"] == 2 and row["npmi"] is None


def test_npmi_in_range(spark):
    ctx = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (2, "c"), (3, "b"), (3, "c"), (3, "a")], "context int, item string")
    for r in graph.npmi(ctx).collect():
        assert r["npmi"] is None or -1 <= r["npmi"] <= 1
    assert math.isclose(next(r["npmi"] for r in graph.npmi(ctx).collect() if (r["a"], r["b"]) == ("b", "c")), math.log(1 * 3 / 4) / -math.log(1 / 3))


def test_communities():
    edges = [("a", "b", 1.0), ("b", "c", 1.0), ("a", "c", 1.0), ("d", "e", 1.0), ("e", "f", 1.0), ("d", "f", 1.0), ("c", "d", 0.1)]
    got = graph.greedy_communities(edges)
    assert got["a"] == got["b"] == got["c"] == 0 and got["d"] == got["e"] == got["f"] == 1
    assert graph.greedy_communities([]) == {}


def test_alias_with_two_codes_links_nothing(spark):
    c = spark.createDataFrame([("1", "甲"), ("2", "甲"), ("3", "乙")], "code string, name string")
    m = spark.createDataFrame([("甲",), ("乙 ",)], "surface string")
    assert [(r["surface"], r["code"]) for r in linking.link_unique(m, "surface", linking.alias_index(c, "code", "name")).collect()] == [("乙 ", "3")]


def test_industries(spark):
    std = spark.createDataFrame([("银行",), ("商业银行",), ("证券",)], "n string")
    s = spark.createDataFrame([("银行板块",), ("大银行",), ("商业",), ("板块",), (None,)], "s string")
    got = {r["surface"]: r["industry"] for r in linking.normalize_industry(s, "s", std, "n").collect()}
    assert got == {"银行板块": "银行", "大银行": "银行", "商业": "商业银行", "板块": None, None: None}


@pytest.mark.parametrize("most_names", [linking.DICTIONARY_ROWS, 0])
def test_dictionary_names_are_worked_out_once(spark, monkeypatch, most_names):
    monkeypatch.setattr(linking, "DICTIONARY_ROWS", most_names)
    made = spark.sparkContext.accumulator(0)

    def seen(x):
        made.add(1)
        return x

    names = spark.createDataFrame([("abc", 3), ("abcde", 1), ("bcd", 2), ("", 4), (None, 5)], "name string, k long").withColumn("name", F.udf(seen, "string").asNondeterministic()("name"))
    texts = spark.createDataFrame([(1, "xabcdex"), (2, "abc"), (3, "ab"), (4, None)], "i long, t string")
    hits = lambda n: {r["i"]: r["hits"] for r in linking.dictionary_hits(texts, "i", "t", n, "name", "k").collect()}
    assert hits(names) == {1: ["abcde", "bcd", "abc"], 2: ["abc"]}
    assert made.value == 5
    more = spark.createDataFrame([("x", 0), ("de", 1)], "name string, k long")
    few = linking.dictionary_hits(texts.union(spark.createDataFrame([(1, "de"), (2, "abcd")], "i long, t string")), "i", "t", names, "name", "k", most=1)
    assert {r["i"]: r["hits"] for r in few.collect()} == {1: ["abcde"], 2: ["bcd"]}
    assert hits(more) == {1: ["x", "de"]} and hits(more.where("k = 0")) == {1: ["x"]} and hits(more.where("k > 5")) == {}


def test_names_cascade(spark):
    c = spark.createDataFrame([("甲乙科技股份有限公司",), ("丙丁银行有限公司",)], "full string")
    m = spark.createDataFrame([("甲乙科技股份有限公司", 0), ("丙丁银行", 1), ("丙", 2)], "s string, o long")
    got = {(r["surface"], r["full_name"], r["score"]) for r in linking.link_names(m, "s", "o", c, "full").collect()}
    assert got == {("甲乙科技股份有限公司",) * 2 + (1.0,), ("丙丁银行", "丙丁银行有限公司", 0.95)}


def test_weighted_ratio():
    assert linking.weighted_ratio("abc", "abc") == 100
    assert linking.weighted_ratio("", "abc") == 0
    assert linking.weighted_ratio("new york mets", "mets new york") == pytest.approx(95)
    assert linking.indel_ratio("abcd", "abed") == pytest.approx(75)


def test_near_names_against_all_pairs_in_few_comparisons(spark):
    def common(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            above = 0
            for j, y in enumerate(b):
                above, row[j + 1] = row[j + 1], above + 1 if x == y else max(row[j + 1], row[j])
        return row[-1]

    rng = np.random.default_rng(2)
    names = [f"Supplier#{i:09d}" for i in range(300)] + ["".join(rng.choice(list("abcd"), n)) for n in (2, 3, 5, 9, 24, 40, 50) for _ in range(6)]
    names += ["ab\x1ccd", "银行甲乙丙丁戊己"]
    near = ["x" + s for s in names] + [s[1:-1] + "y" for s in names if len(s) > 8] + [s[:10] + "z" + s[12:] for s in names if len(s) > 30] + ["cd\x1cab", "甲乙丙丁戊己", "q" * 12 + names[-4] + "r" * 15]
    assert all(linking._common(a, b) == common(a, b) for a, b in zip(near, names, strict=False))
    assert linking.ratios(near[: len(names)], names).tolist() == [linking.weighted_ratio(a, b) for a, b in zip(near, names, strict=False)]
    left, right = (spark.createDataFrame([(s,) for s in x], "norm string") for x in (near, names))
    got = {(r["norm"], r["other"], r["score"]) for r in linking.near_names(left, right, 88.0).collect()}
    shares = lambda a, b: bool(linking._grams(a) & linking._grams(b))
    want = {(a, b, linking.weighted_ratio(a, b) / 100) for a in near for b in names if shares(a, b) and linking.weighted_ratio(a, b) >= 88}
    assert want and got == want
    one, other = ("xSupplier#000012345", "Supplier#000067890")
    assert not set(linking._keys_for(one, 18, False, "", 88.0)) & set(linking._keys_for(other, 19, True, "", 88.0))


def test_near_duplicates_against_brute_force(spark):
    base = "the quick brown fox jumps over the lazy dog near the river bank " * 2
    texts = [base, base + "x", "wholly different words in this other sentence", "abc", "abc", None, "  " + base]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    got = {r["row_no"]: r["group_id"] for r in similar.near_duplicate_groups(df, "i", "t", Scratch(spark, "t")).collect()}
    assert got == {0: 1, 1: 1, 2: -1, 3: -1, 4: -1, 5: -1, 6: 1}


@pytest.mark.parametrize("least", [0.05, 0.3, 0.8])
def test_cosine_links_against_brute_force(spark, least):
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcdef"), 5)) for _ in range(40)]
    texts = [" ".join(rng.choice(words, 12)) for _ in range(40)]
    texts += [x + " tail" for x in texts[:10]]
    reps = spark.createDataFrame([(i, x, 1) for i, x in enumerate(texts)], "kid long, norm string, copies long")
    got = {(min(r["u"], r["v"]), max(r["u"], r["v"])) for r in similar.links(reps, Scratch(spark, "t"), least).collect()}
    tf = [{} for _ in texts]
    for d, x in zip(tf, texts, strict=True):
        for k in similar.SIZES:
            for i in range(len(x) - k + 1):
                d[x[i : i + k]] = d.get(x[i : i + k], 0) + 1
    df = {}
    for d in tf:
        for g in d:
            df[g] = df.get(g, 0) + 1
    rows = [{g: n * (math.log((1 + len(texts)) / (1 + df[g])) + 1) for g, n in d.items() if df[g] <= similar.MAX_DF * len(texts)} for d in tf]
    length = [math.sqrt(sum(x * x for x in r.values())) for r in rows]
    want = {(i, j) for i in range(len(rows)) for j in range(i + 1, len(rows)) if sum(x * rows[j].get(g, 0) for g, x in rows[i].items()) / length[i] / length[j] >= least}
    assert want and got == want


def test_all_equal_and_empty_texts(spark):
    df = spark.createDataFrame([(0, "same text")], "i long, t string")
    assert similar.near_duplicate_groups(df.where("i > 5"), "i", "t", Scratch(spark, "t")).count() == 0


def test_keywords_take_tokens_once(spark):
    made = spark.sparkContext.accumulator(0)

    def seen(x):
        made.add(1)
        return x

    toks = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "b")], "topic int, token string").withColumn("token", F.udf(seen, "string").asNondeterministic()("token"))
    got = [(r["topic"], r["rank"], r["word"], round(r["weight"], 9)) for r in topics.keywords(toks, "topic").orderBy("topic", "rank").collect()]
    assert got == [(1, 1, "a", round(2 / 3 * math.log(2), 9)), (1, 2, "b", round(1 / 3 * math.log(2), 9)), (2, 1, "b", round(math.log(2), 9))]
    assert made.value == 4


def test_keyword_pick_without_keywords_takes_the_longest(spark):
    rows = spark.createDataFrame([(1, 0, "aa"), (1, 1, "bbbb"), (1, 2, "cccc")], "topic int, o int, s string")
    words = spark.createDataFrame([], "topic int, keywords array<struct<word:string,weight:double>>")
    assert topics.keyword_pick(rows, "topic", "s", "o", words).first()["key_event"] == "bbbb"


def test_density_topics(spark):
    rows = spark.createDataFrame([(i, [1.0, 0.01 * i]) for i in range(5)] + [(9, [-1.0, 0.5])], "k long, v array<double>")
    got = {r["k"]: r["topic_id"] for r in topics.density_topics(rows, "k", "v", Scratch(spark, "t"), min_size=4).collect()}
    assert got[9] == -1 and got[1] == got[2] == got[3] == got[4] != -1


@pytest.mark.parametrize("cell", [2000, 30])
def test_density_topics_against_brute_force(spark, monkeypatch, cell):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((12, 8)) * 0.3
    x = np.concatenate([c + 0.12 * rng.standard_normal((12, 8)) for c in centres] + [rng.standard_normal((20, 8)), np.repeat(centres[:1], 9, axis=0)])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    close = unit @ unit.T >= 0.8
    assert (close & ((unit[:, None, :6] > 0) != (unit[None, :, :6] > 0)).any(-1)).any()
    root = np.arange(len(x))
    for i, j in np.argwhere(close):
        root[root == root[i]] = root[j]
    monkeypatch.setattr(topics, "CELL", cell)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [0.0] * 8), (902, [1.0, 2.0])], "k long, v array<double>")
    found = topics.density_topics(rows, "k", "v", Scratch(spark, "t"))
    got = {r["k"]: r["topic_id"] for r in found.collect()}
    assert got[900] == got[901] == got[902] == -1 and len(got) == len(x) + 3
    groups = lambda label: {frozenset(k for k in range(len(x)) if label(k) == c) for c in set(map(label, range(len(x)))) if c != -1}
    assert groups(got.get) == {g for g in groups(lambda k: int(root[k])) if len(g) >= 5}


def test_density_topics_with_few_cells(spark, monkeypatch):
    assert [topics.cells_of(n) for n in (0, 2000, 2001, 100_000, 600_000, 6_000_000)] == [1, 1, 2, 24, 24, 120]
    for name, value in (("CELL", 10), ("CELLS", 3), ("TILE", 7)):
        monkeypatch.setattr(topics, name, value)
    rng = np.random.default_rng(4)
    x = np.concatenate([np.repeat(rng.standard_normal((4, 16)), 30, axis=0) + 0.05 * rng.standard_normal((120, 16)), rng.standard_normal((30, 16))])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    root = np.arange(len(x))
    for i, j in np.argwhere(unit @ unit.T >= 0.8):
        root[root == max(root[i], root[j])] = min(root[i], root[j])
    size = np.bincount(root, minlength=len(x))
    rows = spark.createDataFrame([(i, v.tolist(), i % 50) for i, v in enumerate(x)], "k long, v array<double>, b long")
    got = {r["k"]: r["topic_id"] for r in topics.density_topics(rows, "k", "v", Scratch(spark, "t")).collect()}
    assert got == {i: int(root[i]) if size[root[i]] >= 5 else -1 for i in range(len(x))}
    alone = topics.density_topics(rows, "k", "v", Scratch(spark, "t"), min_size=2, block_col="b").collect()
    assert {r["topic_id"] for r in alone} == {-1}


def test_cluster_ids_are_stable(spark):
    rows = spark.createDataFrame([("a", 0, "e1"), ("a", 1, None), ("b", 2, None)], "c string, o int, e string")
    got = {r["o"]: r["cluster_id"] for r in buckets.with_cluster_id(rows, "c", "o", "e").collect()}
    assert got[0] == got[1] != got[2]


def test_subjects_fall_back_to_all(spark):
    df = spark.createDataFrame([(["x", "y"], ["y"]), (["x"], ["z"])], "s array<string>, k array<string>")
    assert [r[0] for r in df.select(events.valid_subjects(F.col("s"), F.col("k"))).collect()] == [["y"], ["x"]]


def test_namer_asks_once_and_does_not_cache_failures(spark):
    tp = spark.createDataFrame([(1, "k", ["s"]), (2, "", [])], "topic_id int, keywords string, summaries array<string>")
    cache = spark.createDataFrame([], "key string, name string, confidence double, why string")
    named, new = providers.name_topics(tp, providers.StubChat(), cache, Scratch(spark, "t"))
    assert {r["topic_id"]: r["main_event_name"] for r in named.collect()} == {1: "s", 2: ""}
    again, more = providers.name_topics(tp, providers.StubChat(), new, Scratch(spark, "t"))
    assert more.count() == 0 and {r["topic_id"]: r["main_event_name"] for r in again.collect()} == {1: "s", 2: ""}


def test_embedder_is_deterministic_and_refuses_blank(spark):
    e = providers.HashEmbedder(8)
    assert e.embed(["a"]) == e.embed(["a"])
    with pytest.raises(ValueError, match="blank"):
        providers.embed(spark.createDataFrame([(" ",)], "t string"), "t", e)


def test_csv_round_trip_and_encodings(spark, tmp_path):
    df = spark.createDataFrame([("001", "值,\"x\""), ("", "b")], "code string, name string")
    sinks.csv(df, str(tmp_path / "a"), bom=True)
    back = readers.csv_strings(spark, str(tmp_path / "a"), "code", "name")
    assert {tuple(r) for r in back.collect()} == {("001", '值,"x"'), ("", "b")}
    (tmp_path / "g.csv").write_bytes("code,name\n1,银行\n".encode("gbk"))
    assert readers.csv_any_encoding(spark, str(tmp_path / "g.csv"), "code").first()["name"] == "银行"
    with pytest.raises(ValueError, match="missing"):
        readers.csv_strings(spark, str(tmp_path / "g.csv"), "nope")
    assert readers.dictionary(spark, str(tmp_path / "none.csv"), "a").count() == 0
    assert not sinks.csv(df.where("false"), str(tmp_path / "none"), only_if_rows=True)


def test_json_sources(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"data": [{"NewsID": "1", "event_summary": "x"}]}')
    assert readers.json_envelope(spark, str(tmp_path / "a.json"), readers.PAIRS).first()["event_summary"] == "x"
    (tmp_path / "b.json").write_text('[{"NewsID": "1", "event_summary": "x"}, {"NewsID": "2"}]')
    with pytest.raises(ValueError, match="event_summary"):
        readers.json_envelope(spark, str(tmp_path / "b.json"), readers.PAIRS)
    (tmp_path / "d.json").write_text('[{"NewsID": 1, "canonicals": [{"canonical_event_id": "e", "participants": {"companies": ["x", {"stockCode": 600000}], "industries": ["银行"]}}]}, {"NewsID": 2, "canonicals": "no list"}, {"NewsID": 3, "canonicals": [{"canonical_event_id": "f", "participants": "none"}]}]')
    got = {r["NewsID"]: r for r in readers.canonicals(spark, str(tmp_path / "d.json")).collect()}
    assert sorted(got) == ["1", "3"] and [tuple(x) for x in got["1"]["participants"]["companies"]] == [("600000", None, None)] and [tuple(x) for x in got["1"]["participants"]["industries"]] == [(None, None, "银行")]
    (tmp_path / "c.jsonl").write_text('{"NewsID": "7", "canonicals": [{"canonical_event_id": "e"}]}\nbroken\n')
    assert [r["NewsID"] for r in readers.canonicals(spark, str(tmp_path / "c.jsonl")).collect()] == ["7"]
    (tmp_path / "s.txt").write_text("的 \n\n#x\n了\n的\n")
    assert sorted(r["word"] for r in readers.stop_words(spark, str(tmp_path / "s.txt")).collect()) == ["了", "的"]


def test_graph_tables(spark):
    n = spark.createDataFrame([("a", 1), ("b", 2)], "id string, k int")
    e = spark.createDataFrame([("a", 1), ("a", 1), ("z", 1)], "id string, k int")
    assert [tuple(r) for r in graph.relate(e, n, "id", n, "k").collect()] == [("a", 1)]
    assert graph.duplicates(n, "id").isEmpty()


def test_streams(spark, tmp_path):
    from newsloom.streaming import news

    spark.createDataFrame([("1", "2024-01-01 00:00:00"), ("1", "2024-01-01 00:00:00"), ("2", "2025-01-01 00:00:00")], "id string, ts string").withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(str(tmp_path / "in"))
    s = spark.readStream.schema("id string, ts timestamp").parquet(str(tmp_path / "in"))
    out = news.distinct_stream(news.filter_stream(s, "ts", "2024-01-01", "2024-12-31"), ["id"], "ts")
    q = out.writeStream.format("memory").queryName("seen").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.sql("select count(*) from seen").first()[0] == 1
