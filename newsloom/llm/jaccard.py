"""N-gram Jaccard join by rare-first prefix filtering.

A document's set is its distinct 5-word shingles.  Equal sets are one from the start.  Shingles are ordered rare first, by
counts hashed into ``SLOTS`` slots (any common order is exact; the counts only make prefixes rare), so two sets that
reach the threshold share a shingle in their prefixes.  Sets that share one are candidates if their lengths and the positions of
the first shared shingle allow it; a candidate pair is verified once, with a suffix filter before the
exact intersection.

What is asked for is classes, so a pair within a class already found needs no verification.  The join goes in rounds: in
the first rounds each prefix shingle offers its sets one centre each, which is linear in the prefixes, and shingles whose sets
are in one class go; the last round offers all pairs still in different classes.  Nothing is capped: the last round is exact whatever the others found.

Defined results: null, empty and wordless texts have an empty set and are linked with nothing; a text of fewer than five
words is one shingle; a null id counts as no id: a class is named by its smallest id that isn't null, or null if it
has none; repeated rows give a row each.  Sets are told apart by 64-bit hashes of their 64-bit shingle hashes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.components import contract, salted
from .common import BATCH_ROWS, Scratch, fold_bytes, raw_texts
from .hashes import spread, window_hashes, word_codes

WORDS, PERCENT = 5, 75
#: Slots of the hashed shingle counts, and bits of the filter of sets to verify: bounds of what is broadcast.
SLOTS, FILTER_BITS = 1 << 20, 1 << 23
#: Rounds with one centre a shingle, before the exhaustive one.
CENTRE_ROUNDS = 2
#: Sets that a task remembers to pass over copies; others are told apart after the shuffle.
SEEN = 500_000
_GRAM_ROWS = 50_000


@contextmanager
def batches_of(spark: SparkSession, rows: int):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def grams(raw: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    return np.unique(window_hashes(word_codes(raw), words))


def set_key(g: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(g.tobytes())).view(np.int64))


def least_overlap(n: int, percent: int) -> int:
    """Elements that a set of n must share with any set that reaches the threshold."""
    return -(-percent * n // 100)


def _fresh(raws: list[bytes], seen: set, words: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """Row, set key and shingles, for sets that this task hasn't met."""
    for i, raw in enumerate(raws):
        g = grams(raw, words)
        if len(g) and (k := set_key(g)) not in seen:
            if len(seen) >= SEEN:
                seen.clear()
            seen.add(k)
            yield i, k, g


def _profile(docs: DataFrame, kind: str, words: int) -> DataFrame:
    """Id, set key and size of every document; a last row of each task has its slot counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        slots, schema = np.zeros(SLOTS, np.uint32), None
        for b in batches:
            sets = [grams(raw, words) for raw in raw_texts(b, "text")]
            for g in sets:
                np.add.at(slots, (g & np.uint64(SLOTS - 1)).astype(np.int64), np.uint32(1))
            none = pa.nulls(b.num_rows, pa.binary())
            out = pa.RecordBatch.from_arrays([b.column("id"), pa.array([set_key(g) if len(g) else None for g in sets], pa.int64()), pa.array([len(g) for g in sets], pa.int64()), none], names=["id", "kid", "n", "slots"])
            schema = out.schema
            yield out
        if schema is not None and slots.any():
            yield pa.RecordBatch.from_arrays([pa.nulls(1, schema.field("id").type), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([slots.tobytes()], pa.binary())], schema=schema)

    return docs.mapInArrow(run, f"id {kind}, kid long, n long, slots binary")


def _prefixes(docs: DataFrame, order, words: int, percent: int) -> DataFrame:
    """Prefix shingles of each set: gram, kid, and size and position in one long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        counts, seen = order.value, set()
        for b in batches:
            out: list[tuple] = []
            for _, k, g in _fresh(raw_texts(b, "text"), seen, words):
                n = len(g)
                p = n - least_overlap(n, percent) + 1
                g = g[np.lexsort((g, counts[(g & np.uint64(SLOTS - 1)).astype(np.int64)]))][:p]
                out.append((g.view(np.int64), np.full(p, k, np.int64), np.arange(p, dtype=np.int64) + (n << 32)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names=["gram", "kid", "at"])

    return docs.select("text").mapInArrow(run, "gram long, kid long, at long")


def _columns(batches: Iterator[pa.RecordBatch]) -> list[np.ndarray] | None:
    all_ = [[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches if b.num_rows]
    return [np.concatenate(x) for x in zip(*all_, strict=True)] if all_ else None


_MET = "gram long, kid long, at long, u long, v long"


def _met(gram: np.ndarray, kid: np.ndarray, at: np.ndarray) -> Iterable[pa.RecordBatch]:
    """Rows for later rounds, which have no pair."""
    for i in range(0, len(gram), _GRAM_ROWS):
        part = [pa.array(x[i : i + _GRAM_ROWS]) for x in (gram, kid, at)]
        none = pa.nulls(len(part[0]), pa.int64())
        yield pa.RecordBatch.from_arrays([*part, none, none], names=["gram", "kid", "at", "u", "v"])


def _shared(percent: int):
    """Of a range of grams, those that two sets or more have, once for each set, and the first round's pairs: with the set
    of each gram that came from most tasks, as copied texts do."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        if (got := _columns(batches)) is None:
            return
        gram, kid, at = got
        by = np.argsort(gram)  # most grams are alone, and go before the rest is put in order
        alike = gram[by[1:]] == gram[by[:-1]]
        by = by[np.concatenate((alike, [False])) | np.concatenate(([False], alike))]
        gram, kid, at = gram[by], kid[by], at[by]
        by = np.lexsort((kid, gram))
        gram, kid, at = gram[by], kid[by], at[by]
        new = np.flatnonzero(np.concatenate(([True], (gram[1:] != gram[:-1]) | (kid[1:] != kid[:-1]))))
        times = np.diff(np.concatenate((new, [len(gram)])))
        gram, kid, at = gram[new], kid[new], at[new]
        same = np.concatenate(([False], gram[1:] == gram[:-1], [False]))
        keep = same[1:] | same[:-1]
        gram, kid, at, times = gram[keep], kid[keep], at[keep], times[keep]
        yield from _met(gram, kid, at)
        if len(gram):
            rank = _ranks(times, spread(kid.view(np.uint64) ^ np.uint64(0x9E3779B97F4A7C15)))
            yield from _centred(gram, kid, at, kid, rank, percent)

    return run


def _centred(gram: np.ndarray, kid: np.ndarray, at: np.ndarray, comp: np.ndarray, rank: np.ndarray, percent: int) -> Iterable[pa.RecordBatch]:
    """Pairs of each set of a gram with the one of the least rank."""
    by = np.lexsort((rank, gram))
    gram, kid, at, comp = gram[by], kid[by], at[by], comp[by]
    first = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1])))
    size = np.diff(np.concatenate((first, [len(gram)])))
    yield from _pairs(kid, at, comp, np.arange(len(gram)), np.repeat(first, size), percent)


def _may_link(at_a: np.ndarray, at_b: np.ndarray, percent: int) -> np.ndarray:
    """Length and positional filters for pairs that share the shingles at these positions.

    The first shingle that a pair shares has nothing shared before it, so what the pair can share is what stands from there on
    in either set.  Linked pairs pass at that shingle; that others are offered at a later one doesn't matter.
    """
    na, nb, pa_, pb = at_a >> 32, at_b >> 32, at_a & 0xFFFFFFFF, at_b & 0xFFFFFFFF
    small, large = np.minimum(na, nb), np.maximum(na, nb)
    most = np.minimum(na - pa_, nb - pb)
    return (100 * small >= percent * large) & ((100 + percent) * most >= percent * (na + nb))


def _offers(round_: int | None, percent: int):
    """Candidate pairs of a range of grams, over classes: with one centre a gram, or all of them if round_ is None.

    With a centre, the rows of grams that still have two classes or more come along for the next round.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        if (got := _columns(batches)) is None:
            return
        gram, kid, at, comp = got
        by = np.lexsort((comp, gram))
        gram, kid, at, comp = gram[by], kid[by], at[by], comp[by]
        first = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1])))
        size = np.diff(np.concatenate((first, [len(gram)])))
        if round_ is not None:
            open_ = np.repeat(comp[first] != comp[first + size - 1], size)
            gram, kid, at, comp = gram[open_], kid[open_], at[open_], comp[open_]
            yield from _met(gram, kid, at)
            if len(gram):
                rank = spread(kid.view(np.uint64) ^ np.uint64(0x9E3779B97F4A7C15 * (round_ + 1) & (2**64 - 1)))
                yield from _centred(gram, kid, at, comp, rank, percent)
            return
        # all pairs of different classes: each row with the rows of its gram behind its class
        border = np.concatenate(([True], (gram[1:] != gram[:-1]) | (comp[1:] != comp[:-1]), [True]))
        ends = np.flatnonzero(border)
        behind = ends[np.searchsorted(ends, np.arange(len(gram)), side="right")]
        many = np.repeat(first + size, size) - behind
        rows = np.flatnonzero(many)
        upto = np.cumsum(many[rows])
        at_once = 2_000_000
        i = 0
        while i < len(rows):  # blocks of pairs; a row's own pairs stay together
            j = max(i + 1, int(np.searchsorted(upto, (upto[i - 1] if i else 0) + at_once, side="right")))
            n = many[rows[i:j]]
            left = np.repeat(rows[i:j], n)
            right = np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(behind[rows[i:j]], n)
            yield from _pairs(kid, at, comp, left, right, percent)
            i = j

    return run


def _ranks(times: np.ndarray, tie: np.ndarray) -> np.ndarray:
    by = np.lexsort((tie, -times))
    out = np.empty(len(by), np.int64)
    out[by] = np.arange(len(by))
    return out


def _pairs(kid, at, comp, i, j, percent) -> Iterable[pa.RecordBatch]:
    """The pairs that may link, each once."""
    ok = (comp[i] != comp[j]) & _may_link(at[i], at[j], percent)
    if ok.any():
        x, y = kid[i[ok]], kid[j[ok]]
        pairs = np.unique(np.stack((np.minimum(x, y), np.maximum(x, y)), 1), axis=0)
        none = pa.nulls(len(pairs), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none, pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["gram", "kid", "at", "u", "v"])


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    bits = np.zeros(FILTER_BITS, bool)
    for b in batches:
        for c in b.columns:
            bits[(spread(c.to_numpy(zero_copy_only=False).view(np.uint64)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)] = True
    if bits.any():
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits).tobytes()], pa.binary())], names=["bits"])


def _sets_of(docs: DataFrame, wanted, words: int) -> DataFrame:
    """Shingles of the documents whose id the filter lets through; docs: id_hash, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        bits, seen = np.unpackbits(np.frombuffer(wanted.value, np.uint8)).view(bool), set()
        for b in batches:
            ids = b.column("id_hash").to_numpy(zero_copy_only=False).view(np.uint64)
            keep = bits[(spread(ids) & np.uint64(FILTER_BITS - 1)).astype(np.int64)]
            if keep.any():
                raws = raw_texts(b.filter(pa.array(keep)), "text")
                rows = [(k, g.tobytes()) for _, k, g in _fresh(raws, seen, words)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["kid", "grams"])

    return docs.select("id_hash", "text").mapInArrow(run, "kid long, grams binary").dropDuplicates(["kid"])


def overlap(a: np.ndarray, b: np.ndarray, need: int) -> int:
    """Size of the intersection of sorted sets, or -1 once the suffix filter shows that it is below need."""
    if len(a) > len(b):
        a, b = b, a
    cuts = a[len(a) // 8 :: max(1, len(a) // 8)]
    x, y = np.searchsorted(a, cuts), np.searchsorted(b, cuts)
    x, y = np.diff(np.concatenate(([0], x, [len(a)]))), np.diff(np.concatenate(([0], y, [len(b)])))
    if int(np.minimum(x, y).sum()) < need:
        return -1
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for b in batches:
            linked = []
            for x, y in zip(b.column("gu").to_pylist(), b.column("gv").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                need = -(-percent * (len(x) + len(y)) // (100 + percent))
                linked.append(overlap(x, y, need) >= need)
            yield pa.RecordBatch.from_arrays([b.column("u"), b.column("v"), pa.array(linked, pa.bool_())], names=["u", "v", "linked"])

    return run


def classes(docs: DataFrame, scratch: Scratch, *, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """A row per document: id, n_shingles, component_id."""
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType.simpleString()
    df = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    profile = scratch.keep(_profile(df, kind, words), "profile")
    rows = profile.where("slots is null").select("id", "kid", "n")
    counts = fold_bytes(profile, "slots", "<u4", lambda a, b: a + b)
    sets = scratch.keep(rows.where("kid is not null").groupBy("kid").agg(F.min("id").alias("first")), "sets")
    labels = None
    if counts is not None:
        order = spark.sparkContext.broadcast(counts)
        with batches_of(spark, _GRAM_ROWS):
            texts = df.select(F.xxhash64("id").alias("id_hash"), "text")
            met = scratch.keep(_prefixes(texts, order, words, percent).repartition("gram").mapInArrow(_shared(percent), _MET), "met")
            labels = _link(texts, met, sets, scratch, words, percent)
    if labels is None:
        named = sets.select("kid", F.col("first").alias("component_id"))
    else:  # only linked sets have a class to look up
        of = scratch.keep(sets.join(labels, sets["kid"] == labels["node"]).select("kid", "first", "comp"), "of")
        least = of.groupBy("comp").agg(F.min("first").alias("least"))
        linked = salted(of, least, "comp", "kid").select("kid", "least")
        named = sets.join(linked, "kid", "left").select("kid", F.coalesce("least", "first").alias("component_id"))
    out = rows.join(named, "kid", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("kid").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def _link(texts: DataFrame, met: DataFrame, sets: DataFrame, scratch: Scratch, words: int, percent: int) -> DataFrame | None:
    """Labels (node, comp) of the sets that have links to others."""
    links = tried = labels = None
    for round_ in (*range(CENTRE_ROUNDS), None):
        if round_ != 0:
            shared = met.where("u is null").select("gram", "kid", "at")
            if labels is None:
                state = shared.withColumn("comp", F.col("kid"))
            else:
                state = shared.join(labels, shared["kid"] == labels["node"], "left").select("gram", "kid", "at", F.coalesce("comp", "kid").alias("comp"))
            met = scratch.keep(state.repartition("gram").mapInArrow(_offers(round_, percent), _MET), f"met{round_}")
            scratch.drop("met" if round_ == 1 else f"met{CENTRE_ROUNDS - 1}")
        offered = met.where("u is not null").select("u", "v").distinct()
        if tried is not None:
            offered = offered.join(tried, ["u", "v"], "left_anti")
        pairs = scratch.keep(offered, "pairs")
        if pairs.isEmpty():
            continue
        verified = _verified(texts, pairs, sets, scratch, words, percent)
        scratch.drop("pairs")
        new, seen = verified.where("linked").select("u", "v"), verified.select("u", "v")
        links, tried = (new, seen) if links is None else (links.union(new), tried.union(seen))
        if not new.isEmpty():
            labels = contract(links, scratch)
    return labels


def _verified(texts: DataFrame, pairs: DataFrame, sets: DataFrame, scratch: Scratch, words: int, percent: int) -> DataFrame:
    """The pairs and whether they link.  A set is dealt by its key once, for both of its sides of pairs, and goes with a pair once more."""
    spark = texts.sparkSession
    kids = pairs.select(F.explode(F.array("u", "v")).alias("kid")).distinct()
    firsts = sets.join(kids, "kid", "left_semi").select(F.xxhash64("first").alias("id_hash"))
    wanted = spark.sparkContext.broadcast(fold_bytes(firsts.mapInArrow(_bits, "bits binary"), "bits", "u1", np.bitwise_or, scratch).tobytes())
    with batches_of(spark, BATCH_ROWS):
        found = _sets_of(texts, wanted, words)
        one = found.select(F.col("kid").alias("u"), F.col("grams").alias("gu")).join(pairs, "u")
        both = one.join(found.select(F.col("kid").alias("v"), F.col("grams").alias("gv")), "v")
        return scratch.keep(both.select("u", "v", "gu", "gv").mapInArrow(_verify(percent), "u long, v long, linked boolean"), "linked")


def deduplicate(docs: DataFrame, scratch: Scratch, *, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of each class, that with the smallest id, with all its columns; repeated rows of it are one.

    Rows with a null id can't be named and all stay; so do rows whose text has no words, one for each id.
    """
    found = classes(docs, scratch, id_col=id_col, text_col=text_col, words=words, percent=percent)
    stay = scratch.keep(found.where(F.col(id_col) == F.col("component_id")).select(id_col).distinct(), "stay")
    named = docs.join(stay, id_col, "left_semi").dropDuplicates([id_col]).select(*docs.columns)
    return named.unionByName(docs.where(F.col(id_col).isNull()))
