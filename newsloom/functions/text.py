"""Text scalars: Columns in, Columns out, all inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Company suffixes, in the order in which they are tried (fixed values).
COMPANY_SUFFIXES = ("股份有限公司", "有限公司", "集团股份有限公司", "集团有限公司", "集团", "股份", "有限责任公司", "公司")
#: Industry suffixes (fixed values).
INDUSTRY_SUFFIX = "(行业|板块|概念)$"
#: Titles that stand after a person's name (fixed values).
TITLES = "董事长|总经理|CEO|CFO|总裁|行长|董事|副总经理|负责人|发言人|总监|首席科学家|院士"
#: Words that summaries should avoid; stated in prompts, and checked on request (fixed values).
FORBIDDEN_WORDS = ("利好", "利空", "影响", "预期", "推动", "改善", "承压", "提振", "走强", "走弱", "大涨", "大跌", "显著", "重磅", "有望", "可能", "或将", "预计", "值得关注", "建议", "投资", "买入", "卖出")
#: Small built-in stop-word list (fixed values).
BUILTIN_STOPWORDS = ("的", "了", "和", "与", "及", "或", "等", "在", "对", "将", "已", "为", "是", "也", "更", "较", "并", "还", "又", "而", "让", "把", "进行", "推进", "推动", "加强", "加快", "进一步", "持续", "不断", "相关", "有关", "方面", "领域", "工作", "表示", "强调", "明确", "出台", "发布", "提出", "指出", "称", "认为", "预计", "可能", "将会", "通过", "提供", "支持", "政策", "措施")
#: Formats that publication times come in.
TIME_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd", "yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd HH:mm", "yyyy/MM/dd", "yyyy-MM-dd'T'HH:mm:ss", "yyyyMMdd")

_SPACE = r"(?U)\s+"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_str(c: Column | str) -> Column:
    """Null is empty; blanks of any kind at both ends go."""
    return F.regexp_replace(F.coalesce(_c(c).cast("string"), F.lit("")), r"(?U)^\s+|\s+$", "")


def non_empty(c: Column | str) -> Column:
    """The stripped string, or null if nothing is left."""
    return F.nullif(safe_str(c), F.lit(""))


def collapse_space(c: Column | str) -> Column:
    """Runs of white space, ideographic blanks included, become one blank; ends are stripped."""
    return F.trim(F.regexp_replace(F.coalesce(_c(c), F.lit("")), _SPACE, " "))


def drop_space(c: Column | str) -> Column:
    return F.regexp_replace(_c(c), _SPACE, "")


def normalize_surface(c: Column | str) -> Column:
    """No white space, and ASCII brackets for full-width ones."""
    return F.translate(drop_space(F.coalesce(_c(c), F.lit(""))), "（）【】", "()[]")


def normalize_company(c: Column | str) -> Column:
    """Without white space, the first fitting suffix, and bracketed text."""
    s = drop_space(_c(c))
    cut = s
    for suffix in reversed(COMPANY_SUFFIXES):
        cut = F.when(s.endswith(suffix) & (F.length(s) > len(suffix)), F.left(s, F.length(s) - len(suffix))).otherwise(cut)
    return F.regexp_replace(cut, r"[（(].*?[）)]", "")


def strip_industry_suffix(c: Column | str) -> Column:
    """Without the suffix; null if nothing else is there, so that a bare suffix matches no industry."""
    return F.nullif(F.regexp_replace(safe_str(c), INDUSTRY_SUFFIX, ""), F.lit(""))


def match_form(c: Column | str) -> Column:
    """Lower case without white space, for containment tests."""
    return F.lower(drop_space(F.coalesce(_c(c), F.lit(""))))


def parse_time(c: Column | str) -> Column:
    """A timestamp in any of the known formats, or null."""
    s = F.trim(_c(c))
    return F.coalesce(*(F.try_to_timestamp(s, F.lit(f)) for f in TIME_FORMATS))


def parse_set_cell(c: Column | str) -> Column:
    """Items of a cell that holds a JSON list or separated text; the full-width comma is no separator."""
    s = safe_str(c)
    as_list = F.from_json(s, "array<string>")
    is_list = s.startswith("[") & F.try_parse_json(s).isNotNull()
    is_other_json = ~s.startswith("[") & F.try_parse_json(s).isNotNull()
    parts = F.when(is_list, as_list).when(is_other_json, F.array(s)).otherwise(F.split(s, r"[,\n\r\t;；、|]+"))
    return F.filter(F.transform(parts, safe_str), lambda x: x != "")


def keyword_list(c: Column | str, most: int = 12) -> Column:
    """Distinct keywords of a ``|`` list in their order, the first so many."""
    parts = F.filter(F.transform(F.split(F.coalesce(_c(c), F.lit("")), r"\|"), lambda x: F.trim(x)), lambda x: x != "")
    return F.slice(F.array_distinct(parts), 1, most)


def occurrences(text: Column | str, part: Column | str) -> Column:
    """Non-overlapping occurrences; none of an empty part."""
    t, p = _c(text), _c(part)
    return F.when(F.length(p) > 0, ((F.length(t) - F.length(F.replace(t, p, F.lit("")))) / F.length(p)).cast("int")).otherwise(0)


def repair_json(c: Column | str, objects_only: bool = False) -> Column:
    """The JSON text in a model's answer: the answer itself, what a fence holds, or from the first { to the last }."""
    s = safe_str(c)
    fence = F.regexp_extract(s, r"(?s)```(?:json)?\s*(.*?)```", 1)
    braces = F.regexp_extract(s, r"(?s)(\{.*\})", 1)
    good = [F.when(F.try_parse_json(x).isNotNull() & (x.startswith("{") if objects_only else F.lit(True)) & (x != ""), x) for x in (s, safe_str(fence), braces)]
    return F.coalesce(*good)


def answer_text(c: Column | str, paths: tuple[str, ...] = ("$.answer", "$.output_text", "$.message", "$.text")) -> Column:
    """The first of these fields of a reply that is there, else the whole reply."""
    return F.coalesce(*(F.get_json_object(_c(c), p) for p in paths), _c(c))


REPORT_ANSWER_PATHS = ("$.answer", "$.data.answer", "$.message.content", "$.data.message.content")


def week_bucket(c: Column | str) -> Column:
    """ISO year and week, as 2025-W01; UNKNOWN if the time is null."""
    return F.when(_c(c).isNull(), "UNKNOWN").otherwise(F.format_string("%d-W%02d", F.extract(F.lit("YEAROFWEEK"), _c(c)), F.weekofyear(_c(c))))


def month_bucket(c: Column | str) -> Column:
    return F.coalesce(F.date_format(_c(c), "yyyy-MM"), F.lit("UNKNOWN"))


def sha1_prefix(c: Column | str, n: int = 12) -> Column:
    return F.substring(F.sha1(_c(c).cast("binary")), 1, n)


def cache_key(version: str, **parts: Column) -> Column:
    """MD5 of a JSON object of the parts, sorted by name, and the prompt's version."""
    named = {**parts, "prompt_version": F.lit(version)}
    return F.md5(F.to_json(F.struct(*(named[k].alias(k) for k in sorted(named)))))


def int_id(c: Column | str) -> Column:
    """Whole-number ids, underscores allowed between digits; null if it is none."""
    s = F.trim(_c(c).cast("string"))
    return F.when(s.rlike(r"^[+-]?\d+(?:_\d+)*$"), F.replace(s, F.lit("_"), F.lit("")).try_cast("bigint"))


def zero_pad(c: Column | str, width: int = 6) -> Column:
    """Leading zeros up to the width; longer values stay whole."""
    s = _c(c).cast("string")
    return F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s)


def is_stock_code(c: Column | str) -> Column:
    return F.coalesce(_c(c).rlike(r"^\d{6}$"), F.lit(False))


def safe_int(c: Column | str) -> Column:
    return F.coalesce(_c(c).cast("string").try_cast("int"), F.lit(0))


def weighted_keywords(c: Column | str) -> Column:
    """array<struct<word,weight>> as ``word(0.1234), ...``."""
    return F.array_join(F.transform(_c(c), lambda x: F.format_string("%s(%.4f)", x["word"], x["weight"])), ", ")


def keyword_label(topic: Column | str, words: Column | str) -> Column:
    """Words joined by bars; OUTLIER for topic -1, empty for none."""
    return F.when(_c(topic) == -1, "OUTLIER").otherwise(F.coalesce(F.array_join(_c(words), " | "), F.lit("")))


def _code(x: Column, kind: str) -> Column:
    """The code of a participant: companies have a stockCode, the others that or a code."""
    return non_empty(x["stockCode"]) if kind == "companies" else F.coalesce(non_empty(x["stockCode"]), non_empty(x["code"]))


def participant_tokens(c: Column | str) -> Column:
    """Distinct tokens of companies, industries and concepts: a code and a name each, where there is one."""
    p = _c(c)

    def tokens(kind: str, code: str, name: str) -> Column:
        made = F.transform(p[kind], lambda x: F.array(F.concat(F.lit(f"{code}:"), _code(x, kind)), F.concat(F.lit(f"{name}:"), non_empty(x["name"]))))
        return F.coalesce(F.flatten(made), F.array().cast("array<string>"))

    every = F.concat(tokens("companies", "C", "CNAME"), tokens("industries", "I", "INAME"), tokens("concepts", "K", "KNAME"))
    return F.array_distinct(F.filter(every, lambda x: x.isNotNull()))


def embed_text(kind: Column, trigger: Column, action: Column, sentiment: Column, tokens: Column, most: int = 30) -> Column:
    """``TYPE=… | TRIG=… | ACT=… | SENT=… | PARTS=…`` without the parts that end in an equals sign."""
    parts = [F.concat(F.lit(f"{n}="), safe_str(c)) for n, c in (("TYPE", kind), ("TRIG", trigger), ("ACT", action), ("SENT", sentiment))]
    parts.append(F.concat(F.lit("PARTS="), F.array_join(F.slice(F.array_sort(tokens), 1, most), ",")))
    return F.array_join(F.filter(F.array(*parts), lambda x: ~x.endswith("=")), " | ")


def anchor(c: Column | str) -> Column:
    """The first company code, else the first concept code, else the first industry code, else __NONE__."""
    p = _c(c)

    def first(kind: str, code: str) -> Column:
        return F.concat(F.lit(f"{code}:"), F.get(F.filter(F.transform(p[kind], lambda x: _code(x, kind)), lambda x: x.isNotNull()), 0))

    return F.coalesce(first("companies", "C"), first("concepts", "K"), first("industries", "I"), F.lit("__NONE__"))


def has_forbidden_word(c: Column | str) -> Column:
    return F.coalesce(_c(c).rlike("|".join(FORBIDDEN_WORDS)), F.lit(False))


def bad_value(c: Column | str, allowed: tuple[str, ...]) -> Column:
    """Whether a value is outside an enumerated domain."""
    return _c(c).isNotNull() & ~_c(c).isin(*allowed)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with the value's name in it, so that the value is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Running totals of an array by doubling steps, n log n in all; combine(x, earlier) must take a null for earlier."""
    steps = lambda v: F.filter(F.array(*(F.lit(1 << b) for b in range(30))), lambda s: s < F.size(v))
    return let(values, lambda v: F.aggregate(steps(v), v, lambda acc, s: F.transform(acc, lambda x, i: combine(x, F.get(acc, i - s)))))


def matches(text: Column, pattern: str, before: int) -> Column:
    """All matches as array<struct<start,end,value,before>>: offsets in code points, and so much of what stands between the last match and this one."""
    pieces = F.transform(F.split(text, pattern, -1), lambda x: F.struct(F.length(x).cast("long").alias("n"), F.right(x, F.lit(before)).alias("before")))
    both = F.arrays_zip(pieces.alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("value"))
    size = lambda x: F.coalesce(F.length(x["value"]), F.lit(0)).cast("long")

    def placed(parts: Column) -> Column:
        ends = running(F.transform(parts, lambda x: x["gap"]["n"] + size(x)), lambda x, y: x + F.coalesce(y, F.lit(0).cast("long")))
        made = let(ends, lambda e: F.transform(parts, lambda x, i: F.struct((F.get(e, i) - size(x)).alias("start"), F.get(e, i).alias("end"), x["value"].alias("value"), x["gap"]["before"].alias("before"))))
        return F.filter(made, lambda x: x["value"].isNotNull())

    return let(both, placed)


def persons_by_title(c: Column | str, most: int = 10) -> Column:
    """Names of two to four Chinese characters right before a title that stands near; distinct, of the first so many hits.

    Near a title is what stands up to 6 characters before and 10 after it; the name is the first there before that title.
    """
    text = F.coalesce(_c(c), F.lit(""))
    near = lambda x: F.substring(text, F.greatest(x["start"] - 6, F.lit(0)).cast("int") + 1, (x["end"] + 10 - F.greatest(x["start"] - 6, F.lit(0))).cast("int"))
    seen = F.transform(matches(text, TITLES, 0), lambda x: F.struct(x["value"].alias("title"), near(x).alias("evidence")))
    named = F.transform(seen, lambda x: F.struct(F.get(F.regexp_extract_all(x["evidence"], F.concat(F.lit("([\u4e00-\u9fff]{2,4})"), x["title"]), F.lit(1)), F.lit(0)).alias("name"), x["title"].alias("title"), x["evidence"].alias("evidence")))
    first = F.slice(F.filter(named, lambda x: x["name"].isNotNull()), 1, most)
    key = lambda x: F.struct(x["name"], x["title"])
    return F.filter(first, lambda x, i: F.array_position(F.transform(first, key), key(x)) == i + 1)


# ---- prompts, in our own words ----


def extraction_prompt(title: Column, body: Column) -> Column:
    return F.format_string("List the companies, concepts and industries that this news names, as JSON with keys companies, concepts, industries, each a list of {surface}.\nTitle: %s\nText: %s", title, body)


def analysis_prompt(body: Column, time: Column, entities: Column) -> Column:
    avoid = "、".join(FORBIDDEN_WORDS)
    return F.format_string("Describe the events of this news for the entities given, as JSON with article_summary and event_analyses. Avoid these words: " + avoid + ".\nTime: %s\nEntities: %s\nText: %s", time, entities, body)


def naming_prompt(keywords: Column, summaries: Column, most: int = 20) -> Column:
    """Shows the first summaries, and says how many were left out."""
    shown = F.array_join(F.slice(summaries, 1, most), "\n- ")
    more = F.when(F.size(summaries) > most, F.format_string("\n... and %d more", F.size(summaries) - most)).otherwise("")
    return F.concat(F.lit("Name the main event of this group of news, as JSON with name, confidence and why.\nKeywords: "), F.coalesce(keywords, F.lit("")), F.lit("\nSummaries:\n- "), shown, more)


def report_prompt(topics_json: Column) -> Column:
    return F.format_string("Write an investment report on these topics; cite the news ids.\n%s", topics_json)


def surface_prompt(body: Column) -> Column:
    return F.format_string("List the persons and organisations named in this text, as JSON with keys companies and persons.\n%s", body)
