"""Byte-level BPE by speculation: guess by greedy longest match, verify adjacent pairs, merge exactly only where that fails.

A token sequence is the BPE encoding of its bytes if and only if each adjacent pair of tokens is the encoding of the
pair's bytes.  So the greedy guess for a word stands when all its pairs are compatible, which a vectorised walk down the
merge tree decides for all pairs of a batch at once; the other words are merged exactly, with a heap, in
O(n log n) of their length.

Texts are cut as the file's ByteLevel pre-tokenizer cuts them, after the special tokens are taken out.

Defined results: null and empty texts have no ids and decode to the empty text; a special token's string in a text is that
token; repeated rows give a row each.  A file that isn't byte-level BPE with merge ranks in the order of ids is refused
(ValueError).
"""

from __future__ import annotations

import heapq
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import per_batch, raw_texts

#: The cut of byte-level BPE files of this kind (fixed value).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words whose ids a Python worker remembers, and the longest of them in bytes.
CACHE_WORDS, CACHE_BYTES = 500_000, 64
#: Bytes of a word up to which scanning for the next merge beats a heap.
SHORT = 48
_NONE = 1 << 30


def byte_characters() -> dict[str, int]:
    """Printable stand-ins of the 256 bytes: themselves where Latin-1 prints them, else the characters from 256 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    def __init__(self, source: str):
        j = json.loads(source)
        model, pre = j["model"], j.get("pre_tokenizer") or {}
        if model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or j.get("normalizer"):
            raise ValueError("not a plain byte-level BPE file")
        chars = byte_characters()
        self.special = {t["content"]: t["id"] for t in j.get("added_tokens", [])}
        size = max([*model["vocab"].values(), *self.special.values()]) + 1
        self.bytes: list[bytes] = [b""] * size
        for t, i in model["vocab"].items():
            self.bytes[i] = bytes(chars[c] for c in t)
        ids = {self.bytes[i]: i for i in model["vocab"].values()}
        self.byte_id = [ids[bytes([b])] for b in range(256)]
        self.left, self.right = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        self.merge: dict[tuple[int, int], int] = {}
        last = 255
        for m in model["merges"]:
            a, b = (ids[bytes(chars[c] for c in t)] for t in (m.split(" ") if isinstance(m, str) else m))
            new = ids[self.bytes[a] + self.bytes[b]]
            if new != last + 1:
                raise ValueError("ids don't follow merge ranks")
            last = new
            self.merge[a, b] = new
            self.left[new], self.right[new] = a, b
        if max(self.byte_id) > 255:
            raise ValueError("ids don't follow merge ranks")
        keys = np.array([a << 20 | b for a, b in self.merge], np.int64)
        by = np.argsort(keys)
        self.keys, self.made = keys[by], np.array(list(self.merge.values()), np.int64)[by]
        for t, i in self.special.items():
            self.bytes[i] = t.encode()
        made = np.arange(256, last + 1)
        fine = np.ones(size, bool)
        sound = self.compatible(self.left[made], self.right[made], made)
        for i, ok in zip(made.tolist(), sound.tolist(), strict=True):
            fine[i] = ok and fine[self.left[i]] and fine[self.right[i]]
        #: Tokens that encode to themselves: the only ones that a guess may use.
        self.guess = {t: i for t, i in ids.items() if fine[i]}
        self.longest = max(map(len, self.guess))
        self.word = regex.compile(PIECES)
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.pairs: dict[int, bool] = {}
        self.words: dict[str | tuple, bytes] = {}
        self.parts: dict[str | bytes, bytes | None] = {}

    def __getstate__(self):
        return self.__dict__ | {"pairs": {}, "words": {}, "parts": {}, "word": None, "cut": None}

    def __setstate__(self, state):
        self.__dict__ = state
        self.word = regex.compile(PIECES)
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None

    def compatible(self, a: np.ndarray, b: np.ndarray, below: np.ndarray | int = _NONE) -> np.ndarray:
        """Whether no merge across the border of a and b comes before the merges that made them (or before ``below``).

        Undoes the later of the two tokens' last merges, step by step; a border merge that is found possible and earlier
        than what was undone refutes the pair.
        """
        ok, live = np.ones(len(a), bool), np.arange(len(a))
        a, b, limit = a.copy(), b.copy(), np.broadcast_to(np.asarray(below, np.int64), len(a)).copy()
        while len(live):
            key = a << 20 | b
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            refuted = (self.keys[at] == key) & (self.made[at] < limit)
            ok[live[refuted]] = False
            go = ~refuted & (np.maximum(a, b) > 255)
            live, a, b = live[go], a[go], b[go]
            undo = a > b
            limit = np.where(undo, a, b + 1)
            a, b = np.where(undo, self.right[a], a), np.where(undo, b, self.left[b])
        return ok

    def exact(self, word: bytes) -> list[int]:
        """Plain BPE: the lowest-ranked pair first, the leftmost of equals; by scanning if short, else with a heap."""
        ids = [self.byte_id[c] for c in word]
        n = len(ids)
        if n <= SHORT:
            get = self.merge.get
            ranks = [get(p, _NONE) for p in zip(ids, ids[1:], strict=False)]
            while ranks and (m := min(ranks)) < _NONE:
                i = ranks.index(m)
                ids[i : i + 2] = [m]
                del ranks[i]
                if i:
                    ranks[i - 1] = get((ids[i - 1], m), _NONE)
                if i < len(ranks):
                    ranks[i] = get((m, ids[i + 1]), _NONE)
            return ids
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        get = self.merge.get
        heap = [(m, i, ids[i], ids[i + 1]) for i in range(n - 1) if (m := get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            m, i, x, y = heapq.heappop(heap)
            j = after[i]
            if ids[i] != x or j >= n or ids[j] != y:
                continue
            ids[i], ids[j] = m, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (new := get((m, ids[k]))) is not None:
                    heapq.heappush(heap, (new, i, m, ids[k]))
            if (p := before[i]) >= 0 and (new := get((ids[p], m))) is not None:
                heapq.heappush(heap, (new, p, ids[p], m))
        return [x for x in ids if x >= 0]

    def greedy(self, word: bytes) -> list[int]:
        get, out, i, n = self.guess.get, [], 0, len(word)
        while i < n:
            j = min(n, i + self.longest)
            while (t := get(word[i:j])) is None:
                j -= 1
            out.append(t)
            i = j
        return out

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Each word on its own: speculate, verify all pairs together, and merge the failing words exactly."""
        out = [self.greedy(w) for w in words]
        known = self.pairs
        if len(known) > 2_000_000:
            known.clear()
        asked = [a << 20 | b for ids in out for a, b in zip(ids, ids[1:], strict=False)]
        new = np.fromiter(set(asked).difference(known), np.int64)
        if len(new):
            known.update(zip(new.tolist(), self.compatible(new >> 20, new & 0xFFFFF).tolist(), strict=True))
        k = 0
        for i, ids in enumerate(out):
            n = len(ids) - 1
            if n > 0:
                if not all(map(known.__getitem__, asked[k : k + n])):
                    out[i] = self.exact(words[i])
                k += n
        return out

    def pieces(self, text: str) -> list:
        """The words of a text; a special token is a tuple."""
        if self.cut is None or not any(t in text for t in self.special):
            return self.word.findall(text)
        return [w for k, p in enumerate(self.cut.split(text)) for w in ([(p,)] if k % 2 else self.word.findall(p))]

    def _learn(self, texts: list[str]) -> list[bytes]:
        """Ids of each of these texts, through the cache of words."""
        words, cut = self.words, [self.pieces(t) for t in texts]
        if len(words) > CACHE_WORDS:
            words.clear()
        fresh = [w for w in {w for c in cut for w in c}.difference(words) if isinstance(w, str)]
        new = {w: np.array(ids, "<u4").tobytes() for w, ids in zip(fresh, self.encode_words([w.encode() for w in fresh]), strict=True)}
        long = {w: new.pop(w) for w in fresh if len(w) > CACHE_BYTES}
        words.update(new)
        words.update(((t,), np.array([i], "<u4").tobytes()) for t, i in self.special.items())
        return [b"".join([long[w] if w in long else words[w] for w in c] if long else map(words.__getitem__, c)) for c in cut]

    def encode_batch(self, raws: list[bytes]) -> list[bytes]:
        """Ids of each UTF-8 text as little-endian unsigned 32-bit integers.

        A single blank between two characters that aren't white space always starts a word, so a text is first cut there
        and most parts are found in a cache; a text where that doesn't hold is cut whole.
        """
        parts_of = self.parts
        if len(parts_of) > CACHE_WORDS:
            parts_of.clear()
        get, special = parts_of.get, [t.encode() for t in self.special]
        cut: list[list | None] = []
        fresh: set = set()
        for raw in raws:
            if not raw or any(t in raw for t in special):
                cut.append(None)
                continue
            parts = raw.split(b" ")
            parts[0] = parts[0].decode(errors="replace")  # without a blank in front: another key
            cut.append(parts)
            fresh.update(parts)
        new = list(fresh.difference(parts_of))
        texts = [x if isinstance(x, str) else " " + x.decode(errors="replace") for x in new]
        safe = [bool(t.strip()) and not t[-1].isspace() and not t[isinstance(x, bytes)].isspace() for x, t in zip(new, texts, strict=True)]
        for x, ids in zip([x for x, ok in zip(new, safe, strict=True) if ok], self._learn([t for t, ok in zip(texts, safe, strict=True) if ok]), strict=True):
            parts_of[x] = ids
        parts_of.update((x, None) for x, ok in zip(new, safe, strict=True) if not ok)
        out: list = []
        for parts in cut:
            ids = None if parts is None else list(map(get, parts))
            out.append(None if ids is None or None in ids else b"".join(ids))
        whole = [i for i, x in enumerate(out) if x is None]
        for i, ids in zip(whole, self._learn([raws[i].decode(errors="replace") for i in whole]), strict=True):
            out[i] = ids
        for x in new:
            if len(x) > CACHE_BYTES:
                del parts_of[x]
        return out

    def decode(self, ids: list[int]) -> str:
        """As a lossy UTF-8 reader has it; ids out of range raise IndexError."""
        return b"".join(map(self.bytes.__getitem__, ids)).decode(errors="replace")


def read_vocabulary(path: str) -> str:
    """The file as text, read on the driver; executors get it by broadcast."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, bpe: Bpe, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: id, n_tokens, ids (array<int>), decoded."""
    kind = docs.schema[id_col].dataType.simpleString()
    df = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return per_batch(df, _encoder(df, bpe, ["id"], "text"), f"id {kind}, {_ENCODED}").withColumnRenamed("id", id_col)


_ENCODED = "n_tokens long, ids array<int>, decoded string"


def _encoder(df: DataFrame, bpe: Bpe, keep: list[str], text_col: str):
    shared = df.sparkSession.sparkContext.broadcast(bpe)

    def step(b: pa.RecordBatch) -> pa.RecordBatch:
        bpe = shared.value
        flat = [np.frombuffer(x, "<u4").astype(np.int32) for x in bpe.encode_batch(raw_texts(b, text_col))]
        ends = np.concatenate(([0], np.cumsum([len(x) for x in flat]))).astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*flat, np.zeros(0, np.int32)]), pa.int32()))
        decoded = pa.array([bpe.decode(x.tolist()) for x in flat], pa.string())
        return pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(np.diff(ends), pa.int64()), ids, decoded], names=[*keep, "n_tokens", "ids", "decoded"])

    return step


def digests(docs: DataFrame, bpe: Bpe, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """encode() with the SHA-256 of the ids (little-endian unsigned 32-bit) and of the decoded text, made from its ids."""
    import hashlib

    kind = docs.schema[id_col].dataType.simpleString()
    df = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    encoded = _encoder(df, bpe, ["id"], "text")

    def step(b: pa.RecordBatch) -> pa.RecordBatch:
        e = encoded(b)
        at, flat = e.column(2).offsets.to_pylist(), e.column(2).values.to_numpy().astype("<u4")
        sha = [hashlib.sha256(flat[i:j].tobytes()).hexdigest() for i, j in zip(at, at[1:], strict=False)]
        back = [hashlib.sha256(x).hexdigest() for x in e.column(3).cast(pa.binary()).to_pylist()]
        return pa.RecordBatch.from_arrays([e.column(0), e.column(1), pa.array(sha), pa.array(back)], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return per_batch(df, step, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)


def tokenize(docs: DataFrame, bpe: Bpe, *, text_col: str = "text") -> DataFrame:
    """The documents with all their columns, n_tokens and token_ids; the text is decoded from the ids (null stays null).

    Columns of these two names that are there already are replaced.
    """
    kept = [f for f in docs.schema.fields if f.name not in ("n_tokens", "token_ids")]
    names = [f.name for f in kept]
    docs = docs.select(*(F.col(f"`{n}`") for n in names))
    encoded = _encoder(docs, bpe, [], text_col)

    def step(b: pa.RecordBatch) -> pa.RecordBatch:
        n, ids, decoded = encoded(b).columns
        null = b.column(text_col).is_null().to_pylist()
        text = pa.array([None if x else t for x, t in zip(null, decoded.to_pylist(), strict=True)], pa.string())
        return pa.RecordBatch.from_arrays([*(text if c == text_col else b.column(c) for c in names), n, ids], names=[*names, "n_tokens", "token_ids"])

    schema = T.StructType([*kept, T.StructField("n_tokens", T.LongType()), T.StructField("token_ids", T.ArrayType(T.IntegerType()))])
    return per_batch(docs, step, schema)
