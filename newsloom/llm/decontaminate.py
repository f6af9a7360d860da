"""Benchmark decontamination: a broadcast hash set of benchmark windows, scanned over document words.

A word is a run of ASCII letters or digits and any non-ASCII characters, after A-Z are lower-cased.  A window is ``n``
consecutive words of a benchmark item; an item with fewer words is one window.  A document word inside any occurrence of
a window is hit.

Defined results: a null or empty text has no words and no hits; benchmark rows with null or wordless texts have no
window; rows with a null ``item_id`` still hit words but are no named item; repeated item ids count once; repeated
document rows give a row each; other columns of either table are not looked at.

The set goes out in blocks of about ``BLOCK_CHARS`` bytes of benchmark text.  A block is some arrays of 24 bytes a window and a
dictionary of its words.  If there are several, each is broadcast, scanned and its outcome written before the next one, so that
what workers hold has a bound whatever the size of the benchmark.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, per_batch, raw_texts

WINDOW = 10
#: Benchmark bytes in one broadcast block.
BLOCK_CHARS = 8_000_000

_CLEAN = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words(raw: bytes) -> list[bytes]:
    return raw.translate(_CLEAN).split()


class Windows:
    """Windows by length: sorted 64-bit hashes as a filter, and where each stands among the items' words, to compare them."""

    def __init__(self, items: list[tuple[str | None, bytes]], n: int):
        self.vocab: dict[bytes, int] = {}
        self.names: list[str | None] = []
        texts, sizes = [], []
        for item, raw in items:
            ids = np.array([self.vocab.setdefault(w, len(self.vocab) + 1) for w in words(raw)], np.int32)
            if len(ids):
                self.names.append(item)
                texts.append(ids)
                sizes.append(min(n, len(ids)))
        self.ids = np.concatenate(texts) if texts else np.zeros(0, np.int32)
        self.code = np.random.default_rng(7).integers(0, 2**63, len(self.vocab) + 1, dtype=np.uint64)
        length = np.array([len(t) for t in texts], np.int64)
        first = np.cumsum(length) - length
        #: For each window size: sorted hashes, where the windows start, and their items.
        self.found: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for size in sorted(set(sizes)):
            own = [i for i, x in enumerate(sizes) if x == size]
            at = np.concatenate([np.arange(first[i], first[i] + length[i] - size + 1) for i in own])
            item = np.repeat(np.array(own, np.int64), length[own] - size + 1)
            h = self._hash(self.ids, size, at)
            by = np.argsort(h, kind="stable")
            self.found[size] = h[by], at[by], item[by]

    def _hash(self, ids: np.ndarray, size: int, starts: np.ndarray) -> np.ndarray:
        h = np.zeros(len(starts), np.uint64)
        for j in range(size):
            h = h * _MIX + self.code[ids[starts + j]]
        return h

    def scan(self, doc: list[bytes]) -> tuple[np.ndarray, set]:
        """Hit flags of the words, and the items found."""
        get, n = self.vocab.get, len(doc)
        ids = np.fromiter((get(w, 0) for w in doc), np.int32, n)
        hit, items = np.zeros(n, bool), set()
        unknown = np.concatenate(([0], np.cumsum(ids == 0)))
        for size, (known, at, item) in self.found.items():
            if n < size:
                continue
            starts = np.flatnonzero(unknown[size:] == unknown[:-size])
            if not len(starts):
                continue
            h = self._hash(ids, size, starts)
            left = np.searchsorted(known, h)
            seen: set[int] = set()
            for k in np.flatnonzero(known[np.minimum(left, len(known) - 1)] == h).tolist():
                s, x, i = int(starts[k]), h[k], int(left[k])
                mine = ids[s : s + size]
                again = i in seen  # the items of these windows have been looked up
                while i < len(known) and known[i] == x:
                    if (self.ids[at[i] : at[i] + size] == mine).all():
                        hit[s : s + size] = True
                        seen.add(int(left[k]))
                        if again:
                            break
                        if (name := self.names[item[i]]) is not None:
                            items.add(name)
                    i += 1
        return hit, items


def spans_of(raw: bytes, hit: np.ndarray) -> list[dict]:
    """Code-point spans of the runs of hit words."""
    if not hit.any():
        return []
    at = [m.span() for m in _WORD.finditer(raw.translate(_CLEAN))]
    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    chars = np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)))
    return [{"start": int(chars[at[a][0]]), "end": int(chars[at[b - 1][1]])} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)]


def _blocks(bench: DataFrame, item_col: str, text_col: str, n: int, block_chars: int) -> Iterator[tuple]:
    """Broadcasts of Windows, each over about block_chars bytes, made when they are asked for, with whether it is the last one."""
    sc = bench.sparkSession.sparkContext
    rows = bench.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("binary").alias("raw")).where("raw is not null")
    total = rows.agg(F.sum(F.length("raw"))).first()[0] or 0
    count = max(1, -(-total // block_chars))
    for b in range(count):
        part = rows if count == 1 else rows.where(F.pmod(F.xxhash64("item", "raw"), F.lit(count)) == b)
        yield sc.broadcast(Windows([(r["item"], bytes(r["raw"])) for r in part.toLocalIterator()], n)), b == count - 1


_SCAN = "n_words long, n_hit long, spans array<struct<start:long,end:long>>, items array<string>"


def scan(docs: DataFrame, bench: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", n: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """A row per document: id, n_words, n_hit, the code-point spans of runs of hit words, and the items found, sorted as strings."""
    kind = docs.schema[id_col].dataType.simpleString()
    df = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    scratch = Scratch(docs.sparkSession, "decontamination")
    for k, (block, last) in enumerate(_blocks(bench, item_col, item_text, n, block_chars)):

        def step(b: pa.RecordBatch, block=block, first=k == 0, last=last) -> pa.RecordBatch:
            windows, hits, items, counts, spans = block.value, [], [], [], []
            raws = raw_texts(b, "text")
            before = [None] * len(raws) if first else b.column("hit").to_pylist()
            named = [[]] * len(raws) if first else b.column("items").to_pylist()
            for raw, old, names in zip(raws, before, named, strict=True):
                doc = words(raw)
                hit, found = windows.scan(doc)
                if old is not None:
                    hit |= np.unpackbits(np.frombuffer(old, np.uint8), count=len(doc)).astype(bool)
                items.append(sorted(found | set(names)))
                if last:
                    counts.append((len(doc), int(hit.sum())))
                    spans.append(spans_of(raw, hit))
                else:
                    hits.append(np.packbits(hit).tobytes())
            if not last:
                return pa.RecordBatch.from_arrays([b.column("id"), b.column("text"), pa.array(hits, pa.binary()), pa.array(items, pa.list_(pa.string()))], names=["id", "text", "hit", "items"])
            return pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([c[0] for c in counts], pa.int64()), pa.array([c[1] for c in counts], pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(items, pa.list_(pa.string()))],
                names=["id", "n_words", "n_hit", "spans", "items"],
            )

        df = per_batch(df, step, f"id {kind}, {_SCAN}" if last else f"id {kind}, text string, hit binary, items array<string>")
        if not last:
            df = scratch.keep(df, f"block{k}")
            block.unpersist()
            scratch.drop(f"block{k - 1}")
    return df.withColumnRenamed("id", id_col)


def remove(docs: DataFrame, bench: DataFrame, *, mode: str = "documents", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", n: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents with all their columns: without those that have a hit (``documents``), or with the hit spans cut out (``spans``)."""
    if mode not in ("documents", "spans"):
        raise ValueError(f"mode: {mode}")
    df, scratch = docs, Scratch(docs.sparkSession, "decontamination")
    for k, (block, last) in enumerate(_blocks(bench, item_col, item_text, n, block_chars)):

        def step(b: pa.RecordBatch, block=block) -> pa.RecordBatch:
            windows, keep, texts = block.value, [], []
            for raw in raw_texts(b, text_col):
                hit, _ = windows.scan(words(raw))
                keep.append(not hit.any())
                if mode == "spans":
                    texts.append(_cut(raw, hit))
            if mode == "documents":
                return b.filter(pa.array(keep, pa.bool_()))
            i = b.schema.get_field_index(text_col)
            new = pa.array([o if k else t for o, k, t in zip(b.column(i).to_pylist(), keep, texts, strict=True)], b.schema.field(i).type)
            return pa.RecordBatch.from_arrays([new if j == i else c for j, c in enumerate(b.columns)], schema=b.schema)

        df = per_batch(df, step, docs.schema)
        if not last:
            df = scratch.keep(df, f"block{k}")
            block.unpersist()
            scratch.drop(f"block{k - 1}")
    return df


def _cut(raw: bytes, hit: np.ndarray) -> str:
    text, out, at = raw.decode(errors="replace"), [], 0
    for s in spans_of(raw, hit):
        out.append(text[at : s["start"]])
        at = s["end"]
    return "".join([*out, text[at:]])
