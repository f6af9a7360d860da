"""Fuzzy repeated passages: shared k-mer seeds, collinear chains, and alignment.

Seeds are winnowed word k-mers: any ``K + WINDOW - 1`` equal words hold one.  Seeds that two documents or more have make up
regions of a document, as long as no gap is longer than a chain may bridge; regions too short for a passage go.  Besides, each
seed opens a long seed of ``LONG`` words: of any ``MIN_WORDS`` equal words of two documents, both have the same long seed.

All places that have a seed are put in order by the length of their regions, longest first, then by id.  Each is matched with
the first one, its hub, so the work is linear in the seeds however often a passage was copied.  Documents that have only a piece
of a passage mostly have shorter regions, so they don't become the hubs of those that have all of it.  What no passage covers so
far is matched once more: by long seeds, which pieces do not share, with the hubs among all places; and by short ones among
each other, with the hub and with the place before, so that a passage is found even where its seeds lead to different hubs.  Seeds of very many documents are dealt out to parts, which are matched in themselves first; then the
parts' hubs are.

Matches of two regions are chained by a Fenwick tree over one's positions, at a cost for gaps; chains that could reach
``MIN_WORDS`` are aligned word by word and extended at both ends, over insertions, deletions and replacements.  A passage counts
if it has ``MIN_WORDS`` words or more and ``IDENTITY`` of them match; it is given for both documents.

Defined results: null, empty and short texts have no passage; rows with a null id can't be named and are passed over; rows
with the same id are one document, of which one row is aligned; passages within one document don't count; words are runs
without ASCII white space, A-Z lower-cased; a seed that a region has several times is matched with its first place in a hub, and where the same words
come over and over a seed counts at the first place only.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, fold_bytes, raw_texts
from .hashes import spread, window_hashes, word_codes

K, WINDOW = 6, 8
MIN_WORDS, IDENTITY = 50, 0.8
#: Words of a long seed: the first seed of equal words starts at one of the first WINDOW of them.
LONG = MIN_WORDS - WINDOW
#: Cost of a word of gap in a chain, the longest gap, and the words that alignment may skip on either side at a time.
GAP_COST, LONGEST_GAP, SKIP = 0.02, 40, 12
#: Words that alignment may still add to a chain, and words kept on both sides of a region for that.
SLACK, MARGIN = 2 * (K + WINDOW), MIN_WORDS + LONGEST_GAP
#: Words in a block: what is covered is told by blocks.
BLOCK = 16
#: Bits of the broadcast filters: of seeds so many for each shared one, within these bounds, of hot seeds, and of regions or their
#: blocks.  A fuller filter lets more rows through, never fewer.
BITS_EACH, LEAST_BITS, MOST_BITS, HOT_BITS, REGION_BITS = 16, 1 << 20, 1 << 29, 1 << 20, 1 << 24
#: Tasks that fill a filter.
FILLERS = 16
#: Documents from which on a seed, or passages from which on a home, is dealt out to so many parts.
HOT, PARTS = 1_000, 64


def seeds(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Winnowed k-mer hashes and their positions: those that are the least of some WINDOW neighbours."""
    h = window_hashes(codes, K) if len(codes) >= K else codes[:0]
    if not len(h):
        return h.view(np.int64), np.zeros(0, np.int64)
    w, size, least = min(WINDOW, len(h)), 1, h
    while size < w:
        step = min(size, w - size)
        least = np.minimum(least[: len(least) - step], least[step:])
        size += step
    # a place is taken if it equals the greatest of the minima of the windows that hold it
    padded = np.concatenate((np.zeros(w - 1, np.uint64), least, np.zeros(w - 1, np.uint64)))
    size = 1
    while size < w:
        step = min(size, w - size)
        padded = np.maximum(padded[: len(padded) - step], padded[step:])
        size += step
    at = np.flatnonzero(h == padded)
    return h[at].view(np.int64), at


def _slot(x: np.ndarray, bits: int) -> np.ndarray:
    return (spread(x.view(np.uint64)) & np.uint64(bits - 1)).astype(np.int64)


def _distinct_seeds(docs: DataFrame) -> DataFrame:
    """The distinct seeds of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for b in batches:
            out = [np.unique(seeds(word_codes(raw))[0]) for raw in raw_texts(b, "text")]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out))], names=["seed"])

    return docs.select("text").mapInArrow(run, "seed long")


def _set(bits: np.ndarray, slot: np.ndarray) -> None:
    np.bitwise_or.at(bits, slot >> 3, np.uint8(1) << (slot & 7).astype(np.uint8))


def _is_set(bits: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & np.uint8(1) > 0


def _filters_of(shared: DataFrame, scratch: Scratch) -> tuple | None:
    """A broadcast of bit filters of the shared seeds, and of those that very many documents have, and the size of the first; None if there are none."""
    n = shared.count()
    size = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_EACH * n).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        bits, some = np.zeros((size + HOT_BITS) // 8, np.uint8), False
        for b in batches:
            seed, hot = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False) >= HOT
            _set(bits, _slot(seed, size))
            _set(bits, size + _slot(seed[hot], HOT_BITS))
            some |= len(seed) > 0
        if some:
            yield pa.RecordBatch.from_arrays([pa.array([bits.tobytes()], pa.binary())], names=["bits"])

    got = fold_bytes(shared.coalesce(FILLERS).mapInArrow(run, "bits binary"), "bits", "u1", np.bitwise_or, scratch)
    return None if got is None else (shared.sparkSession.sparkContext.broadcast(got.tobytes()), size)


def _fresh(key: np.ndarray, at: np.ndarray, near: int) -> np.ndarray:
    """Places whose key wasn't there at less than so many words before: of the same words over and over, the first one."""
    by = np.lexsort((at, key))
    again = (key[by[1:]] == key[by[:-1]]) & (at[by[1:]] - at[by[:-1]] < near)
    return np.sort(by[np.concatenate(([True], ~again))]) if len(by) else by


#: A place of a seed: its region (start and length), its words; or a region with its words.
_PLACE = "key long, id long, reg long, size long, pos long, span long, part long, at long, words binary"


def _places(docs: DataFrame, wanted, seed_bits: int) -> DataFrame:
    """Places of the shared seeds, short and long, in regions that could hold a passage, and these regions' words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        bits = np.frombuffer(wanted.value, np.uint8)
        for b in batches:
            out: list[tuple] = []
            regions: list[tuple] = []
            for id_, raw in zip(b.column("id").to_pylist(), raw_texts(b, "text"), strict=True):
                codes = word_codes(raw)
                if len(codes) < MIN_WORDS:
                    continue
                h, at = seeds(codes)
                known = _is_set(bits, _slot(h, seed_bits))
                if known.sum() < 2 and MIN_WORDS - SLACK > K:
                    continue
                kept, kept_at = h[known], at[known]
                first = np.flatnonzero(np.concatenate(([True], np.diff(kept_at) > LONGEST_GAP)))
                last = np.concatenate((first[1:], [len(kept)])) - 1
                size = kept_at[last] + K - kept_at[first]
                wide = size + SLACK >= MIN_WORDS
                many = np.where(wide, last - first + 1, 0)
                if not many.any():
                    continue
                take = np.repeat(wide, last - first + 1)
                reg, ends, size, many = kept_at[first[wide]], kept_at[last[wide]] + K, size[wide], many[wide]
                kept, kept_at = kept[take], kept_at[take]
                regs, sizes = np.repeat(reg, many), np.repeat(size, many)
                fresh = _fresh(kept, kept_at, K + WINDOW)
                kept, kept_at, regs, sizes = kept[fresh], kept_at[fresh], regs[fresh], sizes[fresh]
                part = np.where(_is_set(bits, seed_bits + _slot(kept, HOT_BITS)), np.int64(int(spread(np.array([id_], np.int64).view(np.uint64))[0] % np.uint64(PARTS))), np.int64(-1))
                out.append((kept, np.full(len(kept), id_, np.int64), regs, sizes, kept_at, np.full(len(kept), K, np.int64), part))
                # long seeds: all seeds whose choice depends on words inside must be shared
                alone = np.concatenate(([0], np.cumsum(~known)))
                inner = np.searchsorted(at, kept_at + WINDOW - 1), np.searchsorted(at, kept_at + LONG - K - WINDOW + 2)
                long_ = np.flatnonzero((kept_at + LONG <= len(codes)) & (alone[inner[1]] == alone[inner[0]]))
                if len(long_):
                    key = window_hashes(codes, LONG)[kept_at[long_]].view(np.int64)
                    fresh = _fresh(key, kept_at[long_], LONG)
                    key, long_ = key[fresh], long_[fresh]
                    out.append((key, np.full(len(key), id_, np.int64), regs[long_], sizes[long_], kept_at[long_], np.full(len(key), LONG, np.int64), part[long_]))
                for r, e in zip(reg.tolist(), ends.tolist(), strict=True):
                    start = max(0, r - MARGIN)
                    regions.append((id_, r, e - r, start, codes[start : e + MARGIN].astype("<u4").tobytes()))
            if out:
                cols = [pa.array(np.concatenate(x)) for x in zip(*out, strict=True)]
                n = len(cols[0])
                yield pa.RecordBatch.from_arrays([*cols, pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())], names=_NAMES)
                ids, regs, lengths, starts, words = zip(*regions, strict=True)
                none = pa.nulls(len(ids), pa.int64())
                yield pa.RecordBatch.from_arrays([none, *(pa.array(x, pa.int64()) for x in (ids, regs, lengths)), none, none, none, pa.array(starts, pa.int64()), pa.array(words, pa.binary())], names=_NAMES)

    return docs.mapInArrow(run, _PLACE)


_NAMES = [x.split()[0] for x in _PLACE.split(", ")]
_KEYED = ("key", "id", "reg", "size", "pos", "span", "open")
#: A match of a place with one of its home; or, from a part of a hot seed, the place of its hub, which has a key and no home.
_MATCH = "key long, id long, reg long, size long, pos long, span long, open long, home long, hreg long, hpos long"


def _matches(neighbours: bool):
    """Of a range of seeds, or of parts of them, matches of each open place with the hub, and of short ones with the place before if asked for; and the hubs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        got = [[b.column(c).to_numpy(zero_copy_only=False) for c in _KEYED] for b in batches if b.num_rows]
        if not got:
            return
        key, id_, reg, size, pos, span, open_ = (np.concatenate(x) for x in zip(*got, strict=True))
        del got
        by = np.argsort(key, kind="stable")
        same = key[by[1:]] == key[by[:-1]]
        by = by[np.lexsort((pos[by], reg[by], id_[by], -size[by], key[by]))] if same.any() else by
        key, id_, reg, size, pos, span, open_ = (x[by] for x in (key, id_, reg, size, pos, span, open_))
        n = len(key)
        new_key = np.concatenate(([True], key[1:] != key[:-1]))
        new_unit = new_key | np.concatenate(([True], (id_[1:] != id_[:-1]) | (reg[1:] != reg[:-1])))
        unit, start = np.cumsum(new_unit) - 1, np.flatnonzero(new_unit)  # a unit is a region that has the seed; its first place stands for it
        key_first = start[new_key[start]]  # first row of each key
        k = np.cumsum(new_key) - 1
        hub = key_first[k]
        other = np.where(id_ != id_[hub], np.arange(n), n)
        second = np.minimum.reduceat(other, key_first)[k]  # the first place of another document than the hub's
        of_hub = id_ == id_[hub]
        home = np.where(of_hub, second, hub)
        before = np.concatenate(([0], start))[unit]  # first place of the unit before
        linked = (home < n) & (open_ > 0)
        apart = (unit > 0) & (key[before] == key) & (id_[before] != id_) & (before != home) & (open_ > 0) & (span == K)
        for rows, to in ((np.flatnonzero(linked), home), (np.flatnonzero(apart) if neighbours else np.zeros(0, np.int64), before)):
            for i in range(0, len(rows), 50_000):
                r = rows[i : i + 50_000]
                t = to[r]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key[r], id_[r], reg[r], size[r], pos[r], span[r], open_[r], id_[t], reg[t], pos[t])], names=_MATCHES)
        for i in range(0, len(key_first), 50_000):
            r = key_first[i : i + 50_000]
            none = pa.nulls(len(r), pa.int64())
            yield pa.RecordBatch.from_arrays([*(pa.array(x[r]) for x in (key, id_, reg, size, pos, span, open_)), none, none, none], names=_MATCHES)

    return run


_MATCHES = [x.split()[0] for x in _MATCH.split(", ")]


class Fenwick:
    """Prefix maxima, with the element that has them."""

    def __init__(self, n: int):
        self.best: list[float] = [float("-inf")] * (n + 1)
        self.arg = [-1] * (n + 1)

    def put(self, i: int, value: float, arg: int) -> None:
        i += 1
        while i < len(self.best):
            if value > self.best[i]:
                self.best[i], self.arg[i] = value, arg
            i += i & -i

    def max_below(self, i: int) -> tuple[float, int]:
        """Over elements 0 .. i-1."""
        best, arg = float("-inf"), -1
        while i > 0:
            if self.best[i] > best:
                best, arg = self.best[i], self.arg[i]
            i -= i & -i
        return best, arg


def chains(pos: list[int], home: list[int]) -> list[list[int]]:
    """Collinear chains of matches sorted by pos: each takes the best predecessor before it on both sides, if that pays."""
    n = len(pos)
    rank = {h: i for i, h in enumerate(sorted(set(home)))}
    tree, score, back = Fenwick(len(rank)), [0.0] * n, [-1] * n
    i = 0
    while i < n:
        j = i
        while j < n and pos[j] == pos[i]:  # matches at one place can't follow each other
            best, arg = tree.max_below(rank[home[j]])
            gain = best - GAP_COST * (pos[j] + home[j])
            score[j] = 1.0
            if gain > 0 and pos[j] - pos[arg] <= LONGEST_GAP and home[j] - home[arg] <= LONGEST_GAP:
                score[j], back[j] = 1.0 + gain, arg
            j += 1
        for m in range(i, j):
            tree.put(rank[home[m]], score[m] + GAP_COST * (pos[m] + home[m]), m)
        i = j
    used, out = [False] * n, []
    for end in sorted(range(n), key=lambda x: -score[x]):
        chain, x = [], end
        while x >= 0 and not used[x]:
            used[x] = True
            chain.append(x)
            x = back[x]
        if chain:
            out.append(chain[::-1])
    return out


_CHAIN = "id long, reg long, home long, hreg long, s long, e long, hs long, he long"


def _chain_rows(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    got = [[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches if b.num_rows]
    if not got:
        return
    id_, reg, home, hreg, pos, span, hpos = (np.concatenate(x) for x in zip(*got, strict=True))
    by = np.lexsort((-span, hpos, pos, hreg, home, reg, id_))
    id_, reg, home, hreg, pos, span, hpos = (x[by] for x in (id_, reg, home, hreg, pos, span, hpos))
    pair = (id_[1:] != id_[:-1]) | (reg[1:] != reg[:-1]) | (home[1:] != home[:-1]) | (hreg[1:] != hreg[:-1])
    new = np.concatenate(([True], pair | (pos[1:] != pos[:-1]) | (hpos[1:] != hpos[:-1])))  # of short and long, the long one
    first = np.flatnonzero(np.concatenate(([True], pair))[new])
    id_, reg, home, hreg, pos, span, hpos = (x[new] for x in (id_, reg, home, hreg, pos, span, hpos))
    last = np.concatenate((first[1:], [len(id_)]))
    reach = np.maximum.reduceat(pos + span, first)
    near = reach - pos[first] + SLACK >= MIN_WORDS
    shift = hpos - pos
    straight = np.minimum.reduceat(shift, first) == np.maximum.reduceat(shift, first)
    gap = np.concatenate(([0], np.diff(pos)))
    gap[first] = 0
    straight &= np.maximum.reduceat(gap, first) <= LONGEST_GAP
    out: list[tuple] = []
    for f, t, e, plain in zip(first[near].tolist(), last[near].tolist(), reach[near].tolist(), straight[near].tolist(), strict=True):
        pairs = int(id_[f]), int(reg[f]), int(home[f]), int(hreg[f])
        if plain:  # matches one after the other at one distance are a chain
            out.append((*pairs, int(pos[f]), e, int(hpos[f]), e + int(shift[f])))
        else:
            p, h, w = pos[f:t].tolist(), hpos[f:t].tolist(), span[f:t].tolist()
            for c in chains(p, h):
                end = max(p[i] + w[i] for i in c)
                if end - p[c[0]] + SLACK >= MIN_WORDS:
                    out.append((*pairs, p[c[0]], end, h[c[0]], max(h[i] + w[i] for i in c)))
        if len(out) >= 10_000:
            yield _longs(out, _CHAIN)
            out = []
    if out:
        yield _longs(out, _CHAIN)


def _longs(rows: list[tuple], schema: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=[x.split()[0] for x in schema.split(", ")])


def extend(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """From the start of both: words taken of a, of b, and matched, until nothing falls into step again.

    After a mismatch the nearest place is sought where three words are equal, at most SKIP words further on either side.
    """
    i = j = matched = end_i = end_j = 0
    while True:
        n = min(len(a) - i, len(b) - j)
        same = a[i : i + n] == b[j : j + n]
        run = n if same.all() else int(same.argmin())
        i, j, matched = i + run, j + run, matched + run
        if run:
            end_i, end_j = i, j
        best = None
        x, y = a[i : i + SKIP + 3], b[j : j + SKIP + 3]
        if len(x) >= 3 and len(y) >= 3:
            eq = x[:, None] == y[None, :]
            hit = eq[:-2, :-2] & eq[1:-1, 1:-1] & eq[2:, 2:]
            if hit.any():
                u, v = np.nonzero(hit)
                k = int(np.lexsort((u, np.maximum(u, v)))[0])
                best = int(u[k]), int(v[k])
        if best is None:
            return end_i, end_j, matched
        i, j = i + best[0], j + best[1]


_PASSAGE = "id long, start long, end long, home long, home_start long, home_end long, matched long"


_ALIGNED = f"{_PASSAGE}, reg long"


def _align(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    """The passages of chains, from both sides, each with the region that it lies in."""
    for b in batches:
        out = []
        for id_, reg, home, hreg, s, hs, at, hat, x, y in zip(*(c.to_pylist() for c in b.columns), strict=True):
            x, y = np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4")
            i, j = s - at, hs - hat
            fa, fb, fm = extend(x[i:], y[j:])
            ba, bb, bm = extend(x[:i][::-1], y[:j][::-1])
            n, hn, m = fa + ba, fb + bb, fm + bm
            if m >= IDENTITY * max(n, hn):
                mine, theirs = (id_, s - ba, s + fa), (home, hs - bb, hs + fb)
                if n >= MIN_WORDS:
                    out.append((*mine, *theirs, m, reg))
                if hn >= MIN_WORDS:
                    out.append((*theirs, *mine, m, hreg))
        if out:
            yield _longs(out, _ALIGNED)


def _outermost(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    """Without passages that lie in another one of the same documents on both sides."""
    got = [[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches if b.num_rows]
    if not got:
        return
    id_, s, e, home, hs, he, m = (np.concatenate(x) for x in zip(*got, strict=True))
    by = np.lexsort((-he, hs, -e, s, home, id_))
    id_, s, e, home, hs, he, m = (x[by] for x in (id_, s, e, home, hs, he, m))
    first = np.flatnonzero(np.concatenate(([True], (id_[1:] != id_[:-1]) | (home[1:] != home[:-1]))))
    keep = np.ones(len(id_), bool)
    for f, t in zip(first.tolist(), [*first[1:].tolist(), len(id_)], strict=True):
        for i in range(f + 1, t):
            keep[i] = not ((e[f:i] >= e[i]) & (hs[f:i] <= hs[i]) & (he[f:i] >= he[i])).any()
    yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (id_, s, e, home, hs, he, m)], names=[x.split()[0] for x in _PASSAGE.split(", ")])


def _region_filter(df: DataFrame, scratch: Scratch):
    """A broadcast bit filter of regions (id, reg), or None if there are none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        flags = np.zeros(REGION_BITS, bool)
        for b in batches:
            flags[_region_slot(b)] = True
        if flags.any():
            yield pa.RecordBatch.from_arrays([pa.array([np.packbits(flags).tobytes()], pa.binary())], names=["bits"])

    got = fold_bytes(df.select("id", "reg").mapInArrow(run, "bits binary"), "bits", "u1", np.bitwise_or, scratch)
    return None if got is None else df.sparkSession.sparkContext.broadcast(got.tobytes())


def _region_slot(b: pa.RecordBatch) -> np.ndarray:
    id_, reg = (b.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("id", "reg"))
    return _slot(spread(id_) ^ reg, REGION_BITS)


def _in_regions(df: DataFrame, wanted) -> DataFrame:
    """The rows of the regions that the filter lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(wanted.value, np.uint8)).view(bool)
        for b in batches:
            yield b.filter(pa.array(bits[_region_slot(b)]))

    return df.mapInArrow(run, df.schema)


def _opened(df: DataFrame, wanted) -> DataFrame:
    """Long seeds of all regions, marked as open where all their words are in blocks that the filter lets through, and short ones of these only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(wanted.value, np.uint8)).view(bool)
        for b in batches:
            id_, pos, span = (b.column(c).to_numpy(zero_copy_only=False) for c in ("id", "pos", "span"))
            mixed, long_ = spread(id_.view(np.uint64)), np.flatnonzero(span > K)
            open_ = bits[_slot(mixed ^ (pos // BLOCK).view(np.uint64), REGION_BITS)]
            for ahead in (BLOCK, 2 * BLOCK, LONG - 1):
                long_ = long_[open_[long_]]
                open_[long_] = bits[_slot(mixed[long_] ^ ((pos[long_] + ahead) // BLOCK).view(np.uint64), REGION_BITS)]
            yield b.append_column("open", pa.array(open_.astype(np.int64))).filter(pa.array(open_ | (span > K)))

    return df.mapInArrow(run, ", ".join(f"{c} long" for c in (*df.columns, "open")))


def _uncovered(regions: DataFrame, found: DataFrame | None) -> DataFrame:
    """Blocks of regions (id, reg: the block's number) that no passage covers but for some words at its ends."""
    blocks = regions.select("id", F.explode(F.sequence(F.floor(F.col("reg") / BLOCK), F.floor((F.col("reg") + F.col("size") - 1) / BLOCK))).alias("reg"))
    if found is None:
        return blocks
    first, last = F.ceil((F.col("start") - (BLOCK - 1)) / BLOCK), F.floor((F.col("end") - 1) / BLOCK)
    return blocks.join(found.select("id", F.explode(F.sequence(first, last)).alias("reg")).distinct(), ["id", "reg"], "left_anti")


def _aligned(keyed: DataFrame, regions: DataFrame, neighbours: bool, scratch: Scratch) -> DataFrame | None:
    """Passages from places of seeds: matched, chained and aligned; None if there is no chain."""
    run = _matches(neighbours)
    plain = keyed.where("part < 0").select(*_KEYED).repartition("key").mapInArrow(run, _MATCH)
    parts = scratch.keep(keyed.where("part >= 0").repartition("key", "part").select(*_KEYED).mapInArrow(run, _MATCH), "parts")
    hubs = parts.where("home is null").select(*_KEYED).repartition("key").mapInArrow(run, _MATCH)
    matches = plain.union(parts).union(hubs).where("home is not null")
    chained = matches.select("id", "reg", "home", "hreg", "pos", "span", "hpos").repartition("id", "reg", "home", "hreg").mapInArrow(_chain_rows, _CHAIN)
    found = scratch.keep(chained, "chains")
    wanted = _region_filter(found.select("id", "reg").union(found.select("home", "hreg")), scratch)
    if wanted is None:
        return None
    own = _in_regions(regions, wanted).dropDuplicates(["id", "reg"])

    def part(at: str, start: str, end: str, words: str):
        begin = F.greatest(F.col(start) - MARGIN, F.col(at))
        return begin, F.substring(F.col(words), (4 * (begin - F.col(at)) + 1).cast("int"), (4 * (F.col(end) + MARGIN - begin)).cast("int"))

    a_at, a = part("at", "s", "e", "words")
    h_at, h = part("hat", "hs", "he", "home_words")
    one = found.join(own, ["id", "reg"]).select("id", "reg", "home", "hreg", "s", "hs", "he", a_at.alias("a_at"), a.alias("a"))
    homes = own.select(F.col("id").alias("home"), F.col("reg").alias("hreg"), F.col("at").alias("hat"), F.col("words").alias("home_words"))
    # homes of very many passages are there for each part that their passages are dealt out to
    hot = found.groupBy("home", "hreg").agg(F.count("*").alias("n")).where(F.col("n") >= HOT).select("home", "hreg", F.lit(True).alias("hot"))
    dealt = lambda f, value: f.join(hot, ["home", "hreg"], "left").withColumn("part", value).drop("hot")
    some = dealt(one, F.when(F.col("hot"), F.pmod(F.xxhash64("id", "s"), F.lit(PARTS)).cast("int")).otherwise(0))
    every = dealt(homes, F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(PARTS - 1))).otherwise(F.array(F.lit(0)))).withColumn("part", F.explode("part"))
    both = some.join(every, ["home", "hreg", "part"]).select("id", "reg", "home", "hreg", "s", "hs", "a_at", h_at.alias("h_at"), "a", h.alias("h"))
    out = scratch.keep(both.mapInArrow(_align, _ALIGNED), "aligned")
    scratch.drop("parts", "chains")
    return out


def find(docs: DataFrame, scratch: Scratch, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per passage and partner: id, start, end (words), home, home_start, home_end, matched."""
    df = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null")
    shared = scratch.keep(_distinct_seeds(df).groupBy("seed").agg(F.count("*").alias("n")).where("n > 1"), "shared")
    empty = docs.sparkSession.createDataFrame([], _PASSAGE)
    wanted = _filters_of(shared, scratch)
    if wanted is None:
        return empty
    places = scratch.keep(_places(df, *wanted), "places")
    scratch.drop("shared")
    keyed = places.where("words is null").select("key", "id", "reg", "size", "pos", "span", "part")
    regions = places.where("words is not null").select("id", "reg", "at", "words")
    found = _aligned(keyed.where(F.col("span") == K).withColumn("open", F.lit(1).cast("long")), regions, False, scratch)
    left = _region_filter(_uncovered(places.where("words is not null").select("id", "reg", "size"), found), scratch)
    more = None if left is None else _aligned(scratch.keep(_opened(keyed, left), "open"), regions, True, scratch)
    every = [f.drop("reg") for f in (found, more) if f is not None]
    if not every:
        return empty
    both = every[0] if len(every) == 1 else every[0].union(every[1])
    return both.repartition("id", "home").mapInArrow(_outermost, _PASSAGE)
