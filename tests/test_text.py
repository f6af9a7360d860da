import pytest
from pyspark.sql import functions as F

from newsloom.functions import text as t


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("fn", "value", "want"),
    [
        (t.collapse_space, "　a \n b ", "a b"),
        (t.collapse_space, None, ""),
        (t.normalize_surface, "（甲　乙）【x】", "(甲乙)[x]"),
        (t.normalize_company, "甲乙 集团股份有限公司", "甲乙集团"),
        (t.normalize_company, "甲（中国）有限公司", "甲"),
        (t.normalize_company, "公司", "公司"),
        (t.strip_industry_suffix, "板块", None),
        (t.strip_industry_suffix, "银行板块", "银行"),
        (t.match_form, "A　b", "ab"),
        (t.non_empty, "　", None),
        (t.int_id, "118_1501", 1181501),
        (t.int_id, "x", None),
        (t.int_id, "1__2", None),
        (t.zero_pad, "1", "000001"),
        (t.zero_pad, "1234567", "1234567"),
        (t.safe_int, "x", 0),
        (t.is_stock_code, "12345", False),
        (t.parse_set_cell, '["a", "b"]', ["a", "b"]),
        (t.parse_set_cell, "a；b、c|d，e", ["a", "b", "c", "d，e"]),
        (t.parse_set_cell, '{"k": 1}', ['{"k": 1}']),
        (t.parse_set_cell, None, []),
        (t.keyword_list, "b | a|b||c", ["b", "a", "c"]),
        (t.repair_json, 'x ```json\n{"a": 1}\n``` y', '{"a": 1}'),
        (t.repair_json, 'so {"a": 1} ok', '{"a": 1}'),
        (t.repair_json, "nothing", None),
    ],
)
def test_scalars(spark, fn, value, want):
    assert one(spark, fn(F.col("v")), v=value) == want


def test_times(spark):
    for value, want in (("2025/04/02 15:45", "2025-04-02 15:45:00"), (" 2025-04-02 ", "2025-04-02 00:00:00"), ("never", None), (None, None)):
        assert one(spark, t.parse_time("v").cast("string"), v=value) == want
    assert one(spark, t.week_bucket(t.parse_time("v")), v="2025-12-29") == "2026-W01"
    assert one(spark, t.week_bucket(t.parse_time("v")), v="x") == "UNKNOWN"


def test_occurrences_do_not_overlap(spark):
    assert one(spark, t.occurrences("a", F.col("b")), a="aaaa", b="aa") == 2
    assert one(spark, t.occurrences("a", F.col("b")), a="aaaa", b="") == 0


def test_persons(spark):
    got = one(spark, t.persons_by_title("v"), v="王小明总经理说，王小明总经理又说")
    assert [(p["name"], p["title"]) for p in got] == [("王小明", "总经理")]
    assert one(spark, t.persons_by_title("v"), v=None) == []
