"""Dictionary linking of surfaces.

Dictionaries may be broadcast only after their size is checked: ``small()`` adds the hint up to ``DICTIONARY_ROWS`` rows and
otherwise leaves the join to shuffle.  Containment joins are blocked by shared bigrams, so that they stay equi-joins.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as t
from ..sources.scratch import Scratch

#: Rows of a dictionary up to which it is broadcast.
DICTIONARY_ROWS = 200_000


def small(df: DataFrame, rows: int = DICTIONARY_ROWS) -> DataFrame:
    """The frame, marked for broadcast if it has no more rows than this."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def alias_index(companies: DataFrame, code: str, *names: str) -> DataFrame:
    """alias, codes: every distinct code that an alias stands for."""
    rows = companies.select(F.col(code).alias("code"), F.explode(F.array_distinct(F.array(*(t.normalize_surface(n) for n in names)))).alias("alias"))
    return rows.where(F.col("alias") != "").groupBy("alias").agg(F.array_sort(F.collect_set("code")).alias("codes"))


def link_unique(mentions: DataFrame, surface: str, index: DataFrame) -> DataFrame:
    """Mentions with the code of their surface, if the alias has exactly one."""
    only = index.where(F.size("codes") == 1).select("alias", F.col("codes")[0].alias("code"))
    return mentions.withColumn("alias", t.normalize_surface(surface)).join(small(only), "alias").drop("alias")


def name_index(df: DataFrame, name: str, code: str, row_no: str) -> DataFrame:
    """name, code: the last row of a name wins."""
    return df.groupBy(t.normalize_surface(name).alias("alias")).agg(F.max_by(code, row_no).alias("code")).where("alias <> ''")


def link_last(mentions: DataFrame, surface: str, index: DataFrame) -> DataFrame:
    return mentions.withColumn("alias", t.normalize_surface(surface)).join(small(index), "alias").drop("alias")


def bigrams(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit("(?s)(?=(..))"), F.lit(1))


def normalize_industry(surfaces: DataFrame, surface: str, standard: DataFrame, name: str) -> DataFrame:
    """surface, industry: exact, else exact without the suffix, else the best of containment either way.

    Best is the nearest length, then the shorter, then the name.  Standard names of one character take no part in
    containment.  Of containment's two sides the shorter is inside the longer, so it shares its first bigram with it: that
    is the key of an equi-join, which one-character surfaces go round by an exact look at their character.
    """
    s = surfaces.select(F.col(surface).alias("surface")).distinct().withColumn("s", t.non_empty("surface")).withColumn("cut", t.strip_industry_suffix("surface"))
    std = standard.select(F.col(name).alias("std")).where("std is not null and std <> ''").distinct()
    exact = s.join(small(std), s["s"] == std["std"], "left").withColumnRenamed("std", "exact")
    both = exact.join(small(std), exact["cut"] == std["std"], "left").withColumnRenamed("std", "trimmed")
    left = both.where("exact is null and trimmed is null and cut is not null")
    long_std = std.where(F.length("std") >= 2)
    in_text = left.select("surface", "cut", F.explode(F.array_distinct(bigrams(F.col("cut")))).alias("key")).join(small(long_std.withColumn("key", F.left("std", F.lit(2)))), "key").where(F.contains("cut", "std"))
    in_std = left.where(F.length("cut") >= 2).withColumn("key", F.left("cut", F.lit(2))).join(small(long_std.withColumn("key", F.explode(F.array_distinct(bigrams(F.col("std")))))), "key").where(F.contains("std", "cut"))
    one = left.where(F.length("cut") == 1).withColumn("key", F.col("cut")).join(small(long_std.withColumn("key", F.explode(F.array_distinct(F.split("std", ""))))), "key")
    found = in_text.select("surface", "cut", "std").union(in_std.select("surface", "cut", "std")).union(one.select("surface", "cut", "std"))
    best = found.groupBy("surface").agg(F.min_by("std", F.struct(F.abs(F.length("std") - F.length("cut")), F.length("std"), "std")).alias("contained"))
    return both.join(best, "surface", "left").select("surface", F.coalesce("exact", "trimmed", "contained").alias("industry"))


def dictionary_hits(texts: DataFrame, id_col: str, text: str, names: DataFrame, name: str, order: str, most: int = 20) -> DataFrame:
    """id, hits: the first so many names, in dictionary order, that the text contains.

    A text gives what stands at each of its places, as far as the longest name goes; names are joined to it by as many
    first characters as the shortest name (of two or more) has, and what stands there must begin with the name.  No row has
    the whole text; names are written once, and single characters are looked for only if one is a name.  Up to
    ``DICTIONARY_ROWS`` names go to the texts instead, and each text gives no more than the first so many.
    """
    every = Scratch(texts.sparkSession, "names").keep(names.select(F.col(name).alias("name"), F.col(order).alias("ord")).where("name <> ''"), "names")
    length = F.length("name")
    shortest, longest, single, n_names = every.agg(F.min(F.when(length >= 2, length)), F.max(length), F.count_if(length == 1), F.count("*")).first()
    if n_names <= DICTIONARY_ROWS:
        listed = [r["name"] for r in every.distinct().orderBy("ord", "name").collect()]
        kept = texts.select(id_col, text).withColumnRenamed(text, "__text")
        first = kept.mapInArrow(_first_names(listed, most), kept.select(id_col).withColumns({"ord": F.lit(0), "name": F.lit("")}).schema)
        return _ranked(first.distinct(), id_col, most)
    hit = every.limit(0).select(F.lit(None).cast(texts.schema[id_col].dataType).alias(id_col), "name", "ord")
    if shortest:
        n = every.where(length >= 2).withColumn("key", F.left("name", F.lit(shortest)))
        here = F.regexp_extract_all(F.col(text), F.lit(f"(?s)(?=(.{{{shortest},{longest}}}))"), F.lit(1))
        k = texts.select(id_col, F.explode(F.array_distinct(here)).alias("here")).withColumn("key", F.left("here", F.lit(shortest)))
        hit = k.join(small(n), "key").where(F.startswith("here", "name")).select(id_col, "name", "ord").distinct()
    if single:
        one = texts.select(id_col, F.explode(F.array_distinct(F.split(F.col(text), ""))).alias("name")).join(small(every.where(length == 1)), "name").select(id_col, "name", "ord")
        hit = hit.union(one)
    return _ranked(hit, id_col, most)


def _ranked(hit: DataFrame, id_col: str, most: int) -> DataFrame:
    ranked = hit.withColumn("rn", F.row_number().over(Window.partitionBy(id_col).orderBy("ord"))).where(F.col("rn") <= most)
    return ranked.groupBy(id_col).agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "name"))), lambda x: x["name"]).alias("hits"))


def _first_names(listed: list[str], most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]]:
    """id, place, name of the first so many names of a list that each text contains, by its pieces of the names' lengths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        places: dict[str, list[int]] = {}
        for i, name in enumerate(listed):
            places.setdefault(name, []).append(i)
        lengths = sorted({len(name) for name in listed})
        for b in batches:
            row: list[int] = []
            place: list[int] = []
            for r, x in enumerate(b.column(1).to_pylist()):
                if x:
                    found = (places.keys() & {x[i : i + n] for i in range(len(x) - n + 1)} for n in lengths)
                    got = heapq.nsmallest(most, (p for names in found for name in names for p in places[name]))
                    row += [r] * len(got)
                    place += got
            names = pa.array([listed[p] for p in place], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row, pa.int64())), pa.array(place, pa.int32()), names], names=[b.schema.names[0], "ord", "name"])

    return run


def indel_ratio(a: str, b: str) -> float:
    """100 x (1 - insertions and deletions / total length), by the longest common subsequence."""
    if not a and not b:
        return 100.0
    return 200.0 * _common(a, b) / (len(a) + len(b))


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, a row of the table in the bits of one number."""
    places: dict[str, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for y in b:
        hit = row & places.get(y, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def _partial(a: str, b: str) -> float:
    a, b = (a, b) if len(a) <= len(b) else (b, a)
    if a and a in b:
        return 100.0
    return max((indel_ratio(a, b[i : i + len(a)]) for i in range(len(b) - len(a) + 1)), default=0.0) if a else 0.0


def weighted_ratio(a: str, b: str) -> float:
    """The best of whole, token-sorted, token-set and, for unlike lengths, partial ratios, each with its weight."""
    if not a or not b:
        return 0.0
    longer = max(len(a), len(b)) / min(len(a), len(b))
    x, y, whole = a.split(), b.split(), indel_ratio(a, b)
    if x == [a] and y == [b]:
        tokens = 0.95 * whole
    else:
        sort = indel_ratio(" ".join(sorted(x)), " ".join(sorted(y)))
        common, only_a, only_b = sorted({*x} & {*y}), sorted({*x} - {*y}), sorted({*y} - {*x})
        head = " ".join(common)
        forms = [head, " ".join([*common, *only_a]), " ".join([*common, *only_b])]
        sets = 100.0 if common and (not only_a or not only_b) else max(indel_ratio(forms[i], forms[j]) for i, j in ((0, 1), (0, 2), (1, 2)))
        tokens = 0.95 * max(sort, sets)
    if longer < 1.5:
        return max(whole, tokens)
    scale = _scale(longer)
    return max(whole, scale * _partial(a, b), scale * tokens)


def _scale(longer: float) -> float:
    return 0.9 if longer < 8 else 0.6


#: Subsequences of two names up to which these are their keys; names with more are cut into pieces.
VARIANTS = 1000
#: What splits a name into words though normalising leaves it there.
_SEPARATORS = "\x1c\x1d\x1e\x1f"


def _pieces(n: int, many: int) -> list[tuple[int, int]]:
    """Beginnings and ends of so many pieces of nearly equal length."""
    return [(n * i // many, n * (i + 1) // many) for i in range(many)]


def _grams(s: str) -> set[str]:
    return {s[i : i + 2] for i in range(len(s) - 1)}


def _keys_for(s: str, n: int, short: bool, tag: str, least: float) -> Iterable[str]:
    """Keys of a name for those of length n: two names whose ratio reaches the least, and that share a bigram, share a key.

    Ratios of names without words are that of the common subsequence, and that of the shorter name with the windows of the
    longer.  Names that are near enough have a common subsequence of the least length; if there are too many of those, one of
    the shorter's pieces, more by one than insertions and deletions, is whole in the longer, moved by no more than these.
    """
    both = len(s) + n
    small, large = min(len(s), n), max(len(s), n)
    need = max(0, math.ceil(least * both / 200 - 1e-6))
    if need <= small:
        ops = both - 2 * need
        if math.comb(small, need) + math.comb(large, need) <= VARIANTS:
            yield from (f"v{tag}{v}" for v in {"".join(c) for c in itertools.combinations(s, need)})
        elif small // (ops + 1) < 2:
            yield from (f"g{tag}{g}" for g in _grams(s))
        else:
            for i, (p, q) in enumerate(_pieces(small, ops + 1)):
                at = (p,) if short else range(max(0, p - small + need), min(large - q + p, p + large - need) + 1)
                yield from (f"p{tag}{i}:{x}" for x in {s[j : j + q - p] for j in at})
    if large / small >= 1.5:
        need = max(0, math.ceil(least / _scale(large / small) * small / 100 - 1e-6))
        if need <= small:
            ops = 2 * (small - need)
            if small // (ops + 1) < 2:
                yield from (f"g{tag}{g}" for g in _grams(s))
            else:
                for i, (p, q) in enumerate(_pieces(small, ops + 1)):
                    at = (p,) if short else range(large - q + p + 1)
                    yield from (f"w{tag}{i}:{x}" for x in {s[j : j + q - p] for j in at})


def _keys(others: list[int], other_odd: bool, surface: bool, least: float) -> Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]]:
    """key, norm of each name, for the lengths that the other side has; names with separators go by their bigrams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 500):
                keys: list[str] = []
                norms: list[str] = []
                for s in b.column(0)[at : at + 500].to_pylist():
                    odd = any(x in s for x in _SEPARATORS)
                    got = {f"{'AB'[not surface]}{g}" for g in _grams(s)} if odd else set()
                    if other_odd:
                        got |= {f"{'AB'[surface]}{g}" for g in _grams(s)}
                    for n in others:
                        short = len(s) < n or (len(s) == n and not surface)
                        got.update(_keys_for(s, n, short, f"{len(s)}:{n}:" if surface else f"{n}:{len(s)}:", least))
                    keys += got
                    norms += [s] * len(got)
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(norms, pa.string())], names=["key", "norm"])

    return run


def ratios(a: list[str], b: list[str]) -> np.ndarray:
    """Weighted ratios of pairs; those of like lengths without words are worked out together."""
    if not a:
        return np.zeros(0)
    la, lb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    low, high = np.minimum(la, lb), np.maximum(la, lb)
    plain = (low > 0) & (high < 64) & (high < 1.5 * low) & np.array([x.split() == [x] and y.split() == [y] for x, y in zip(a, b, strict=True)])
    out = np.zeros(len(a))
    for at in np.array_split(np.flatnonzero(plain), max(1, int(plain.sum()) // 10_000)):
        if len(at):
            out[at] = 200.0 * _common_of_many([a[i] for i in at], la[at], [b[i] for i in at], lb[at]) / (la[at] + lb[at])
    for i in np.flatnonzero(~plain):
        out[i] = weighted_ratio(a[i], b[i])
    return out


def _common_of_many(a: list[str], la: np.ndarray, b: list[str], lb: np.ndarray) -> np.ndarray:
    """As _common, for pairs of up to 63 characters."""
    x, y = (np.array(s).view(np.uint32).reshape(len(s), -1).T.copy() for s in (a, b))
    full = (np.uint64(1) << la.astype(np.uint64)) - np.uint64(1)
    row = full.copy()
    for j in range(len(y)):
        hit = np.zeros(len(a), np.uint64)
        for i in range(len(x)):
            hit |= (x[i] == y[j]).astype(np.uint64) << np.uint64(i)
        hit = np.where(j < lb, hit & row, np.uint64(0))
        row = (row + hit | row - hit) & full
    return la - np.bitwise_count(row).astype(np.int64)


def near_names(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """norm, other, score: pairs of different rows of left and right (norm) that share a bigram and reach the least ratio."""
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sides = [x.where(F.length("norm") >= 2).select("norm").distinct().repartition(parts, F.xxhash64("norm")) for x in (left, right)]
    seen = [x.agg(F.collect_set(F.length("norm")).alias("n"), F.coalesce(F.bool_or(F.col("norm").rlike(f"[{_SEPARATORS}]")), F.lit(False)).alias("odd")).first() for x in sides]
    keyed = [x.mapInArrow(_keys(sorted(o["n"]), o["odd"], i == 0, least), "key string, norm string").select(F.xxhash64("key").alias("key"), "norm") for i, (x, o) in enumerate(zip(sides, reversed(seen), strict=True))]
    near = keyed[0].join(keyed[1].withColumnRenamed("norm", "other"), "key").select("norm", "other").distinct()

    def run(frames: Iterator[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for f in frames:
            score = ratios(f["norm"].tolist(), f["other"].tolist())
            near = [score[i] >= least * (1 - 1e-9) and bool(_grams(a) & _grams(b)) for i, (a, b) in enumerate(zip(f["norm"], f["other"], strict=True))]
            out = f.assign(score=score / 100)[near]
            yield out[out["score"] * 100 >= least]

    return near.mapInPandas(run, "norm string, other string, score double")


def link_names(mentions: DataFrame, surface: str, order: str, companies: DataFrame, full_name: str, *, least: float = 88.0, most: int = 3) -> DataFrame:
    """surface, full_name, score: exact (1.0), else equal when normalised (0.95, all of them), else fuzzy.

    Surfaces of one character are passed over; a full name is given to the first surface that reaches it, in their order.
    Fuzzy candidates share a bigram with the surface, and a key of ``near_names``; only what the two joins leave over is
    compared in Python, each pair of normalised names once.
    """
    m = mentions.select(F.col(surface).alias("surface"), F.col(order).alias("ord")).where(F.length("surface") >= 2).groupBy("surface").agg(F.min("ord").alias("ord"))
    c = companies.select(F.col(full_name).alias("full_name")).where("full_name is not null").distinct().withColumn("norm", t.normalize_company("full_name"))
    exact = m.join(small(c.select("full_name")), m["surface"] == F.col("full_name")).select("surface", "ord", "full_name", F.lit(1.0).alias("score"))
    rest = m.join(exact.select("surface"), "surface", "left_anti").withColumn("norm", t.normalize_company("surface"))
    equal = rest.join(small(c), "norm").select("surface", "ord", "full_name", F.lit(0.95).alias("score"))
    left = rest.join(equal.select("surface"), "surface", "left_anti")
    scored = near_names(left, c, least)
    fuzzy = left.join(scored, "norm").join(c.withColumnRenamed("norm", "other"), "other").select("surface", "ord", "full_name", "score")
    top = fuzzy.withColumn("rn", F.row_number().over(Window.partitionBy("surface").orderBy(F.desc("score"), "full_name"))).where(F.col("rn") <= most).drop("rn")
    every = exact.union(equal).union(top)
    w = Window.partitionBy("full_name").orderBy("ord", F.desc("score"), "surface")
    return every.withColumn("rn", F.row_number().over(w)).where("rn = 1").select("surface", "full_name", "score")
