"""LM scoring by a causal self-attention model over subword ids, trained in numpy.

A text's tokens are its words (runs without ASCII white space, A-Z lower-cased) and one end.  Each word is cut into subword
ids, the longest matches from the left in a public byte-level BPE vocabulary; the model gives the probability of each id given those before it:

    p(id | context) = softmax over classes (one attention layer and a hidden layer) x share of the id in its class

and a word's probability is the even mixture of its ids' and of its share of the corpus, which is 0 for unknown words.
The corpus gives everything that is counted: the counts of all words of all training documents, from them the counts of
all ids and of which ids stand next to which, the classes (k-means over those neighbourhoods), and the shares.  The
network is trained by data-parallel SGD on all ids of every training document, each document in one of ``ROUNDS`` rounds, each
shard starting from the mean of the last round's shards; so training grows with the corpus.  Shards are dealt out and put in
order by hashes of id and text, and their number follows from the count of words, so the network doesn't depend on how the
table is split.

Scoring runs over overlapping windows of ``CONTEXT`` + ``CONTEXT`` ids: each id is scored once, in the second half of its
window, with at least ``CONTEXT`` ids before it, or padding at the start of the text.

Both scores need the count of every word of every document.  The ``FREQUENT`` most frequent words go out by broadcast; the
others are joined by shuffle, with what the network says of each place of theirs.

Defined results: null and empty texts have the end only; a null id counts as an empty text for the choice of training
documents, so it trains; repeated rows are scored, and trained on, a row each; with no training document at all N and V
are 0, nothing is known, and the model scores with the weights it starts from.
"""

from __future__ import annotations

import math
import zlib
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Bpe
from .common import Scratch, fold_bytes, raw_texts

FOLDS, HELD = 7, 2
#: Words whose counts are broadcast; all others are joined by shuffle.
FREQUENT = 200_000
#: Ids before a scored id that it surely sees; windows in a step of training; rounds of averaging.
CONTEXT, STEP, ROUNDS = 16, 64, 2
#: Width of the embedding and of the hidden layer; classes; rows of the embedding (rarer ids share them); neighbourhood slots.
WIDTH, HIDDEN, CLASSES, ROWS, NEAR = 24, 48, 96, 6144, 24
#: Words whose ids a Python worker remembers at a time, and bytes of words.
CACHE_WORDS, CACHE_BYTES = 400_000, 64 << 20
#: Words of training documents for each shard.
SHARD_WORDS = 4_000_000
#: Ids whose windows are made at a time.
TOGETHER = 1 << 16
RATE, SEED = 0.05, 11


def is_held_out(id_: object) -> bool:
    return zlib.crc32(b"" if id_ is None else str(id_).encode()) % FOLDS == HELD


# ---- counting ----


def _count_words(docs: DataFrame) -> DataFrame:
    """Counts of the words of training documents, added up by task; the end is the empty word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        counts: Counter = Counter()
        for b in batches:
            for id_, raw in zip(b.column("id").to_pylist(), raw_texts(b, "text"), strict=True):
                if not is_held_out(id_):
                    counts.update(raw.lower().split())
                    counts[b""] += 1
            if len(counts) > 400_000:
                yield _counted(counts)
                counts.clear()
        if counts:
            yield _counted(counts)

    return docs.mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _counted(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "c"])


def _id_stats(counts: DataFrame, shared, scratch: Scratch) -> np.ndarray:
    """From the word counts: for each id its count, and counts of slots of the ids before and after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        bpe = shared.value
        size, end = len(bpe.bytes), bpe.special.get("<|endoftext|>", len(bpe.bytes) - 1)
        stats = np.zeros((size, 1 + 2 * NEAR), np.float32)
        for b in batches:
            words, c = b.column(0).to_pylist(), b.column(1).to_numpy()
            ids = [bpe.greedy(b" " + w) if w else [end] for w in words]
            n = np.array([len(x) for x in ids])
            flat, weight = np.fromiter(chain.from_iterable(ids), np.int64), np.repeat(c, n).astype(np.float32)
            first = np.zeros(len(flat), bool)
            first[np.cumsum(n) - n] = True
            last = np.roll(first, -1)
            before, after = np.where(first, 0, 1 + np.roll(flat, 1) % (NEAR - 1)), np.where(last, 0, 1 + np.roll(flat, -1) % (NEAR - 1))
            np.add.at(stats, (flat, 0), weight)
            np.add.at(stats, (flat, 1 + before), weight)
            np.add.at(stats, (flat, 1 + NEAR + after), weight)
        if stats.any():
            yield pa.RecordBatch.from_arrays([pa.array([stats.tobytes()], pa.binary())], names=["stats"])

    got = fold_bytes(counts.coalesce(200).mapInArrow(run, "stats binary"), "stats", "<f4", lambda a, b: a + b, scratch)
    size = len(shared.value.bytes)
    return np.zeros((size, 1 + 2 * NEAR), np.float32) if got is None else got.reshape(size, -1)


def classes_of(stats: np.ndarray) -> np.ndarray:
    """Classes of ids: the most frequent have one each, the others go by k-means over their neighbourhoods."""
    count, alone = stats[:, 0], CLASSES // 2
    by = np.argsort(-count, kind="stable")
    out = np.zeros(len(count), np.int64)
    out[by[:alone]] = np.arange(alone)
    rest = by[alone:]
    near = np.sqrt(stats[rest, 1:] / np.maximum(count[rest], 1)[:, None])
    weight = np.sqrt(count[rest] + 0.01)
    k = CLASSES - alone
    centres = near[np.linspace(0, min(len(rest), 50 * k) - 1, k).astype(int)]
    for _ in range(12):
        own = np.argmin((centres**2).sum(1) - 2 * near @ centres.T, axis=1)
        for j in range(k):
            if (mine := own == j).any():
                centres[j] = np.average(near[mine], axis=0, weights=weight[mine])
    out[rest] = alone + own
    return out


# ---- the network ----


class Net:
    """One causal attention layer over embeddings, a residual, a hidden layer, and a softmax over classes."""

    shapes = {
        "e": (ROWS, WIDTH), "p": (2 * CONTEXT, WIDTH), "q": (WIDTH, WIDTH), "k": (WIDTH, WIDTH), "v": (WIDTH, WIDTH), "o": (WIDTH, WIDTH),
        "a": (WIDTH, HIDDEN), "ab": (HIDDEN,), "c": (HIDDEN, CLASSES), "cb": (CLASSES,),
    }
    size = sum(int(np.prod(s)) for s in shapes.values())

    def __init__(self, flat: np.ndarray | None = None):
        if flat is None:
            rng = np.random.default_rng(SEED)
            flat = np.concatenate([(rng.standard_normal(s) * (0.1 if len(s) == 1 or s[0] in (ROWS, 2 * CONTEXT) else s[0] ** -0.5)).ravel() * (len(s) > 1) for s in self.shapes.values()])
        self.flat = np.asarray(flat, np.float32).copy()
        at = 0
        self.w = {}
        for name, s in self.shapes.items():
            n = int(np.prod(s))
            self.w[name] = self.flat[at : at + n].reshape(s)
            at += n
        self.made: dict[str, np.ndarray] = {}
        self.mask = (np.arange(2 * CONTEXT)[None, :] <= np.arange(CONTEXT)[:, None] + CONTEXT).astype(np.float32)

    def __getstate__(self):
        return self.__dict__ | {"made": {}}

    def __setstate__(self, state):
        self.__init__(state["flat"])

    def _room(self, name: str, *shape: int) -> np.ndarray:
        """Memory for an intermediate array, used again by the next call: what lies in it holds until then."""
        size = math.prod(shape)
        if name not in self.made or self.made[name].size < size:
            self.made[name] = np.empty(size, np.float32)
        return self.made[name][:size].reshape(shape)

    def log_classes(self, x: np.ndarray) -> np.ndarray:
        """Log probabilities of the classes after each of the last CONTEXT inputs of windows x (rows of the embedding)."""
        y = self._forward(x)["y"]
        y = y - y.max(-1, keepdims=True)
        return (y - np.log(np.exp(y).sum(-1, keepdims=True))).reshape(len(x), CONTEXT, -1)

    def log_targets(self, x: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Log probabilities of the target classes only."""
        y = self._forward(x)["y"]
        at = np.arange(len(y)) * CLASSES + target.ravel()
        got = y.ravel()[at]
        total, top = _exp(y)
        return (got - top - np.log(total)).reshape(len(x), CONTEXT)

    def _forward(self, x: np.ndarray) -> dict:
        """The layers, up to the classes' scores before the softmax.

        With one head as wide as the embedding, the products q k' and v o of the weights do the work of all four of them.
        """
        w, b, d = self.w, len(x), WIDTH
        n = b * CONTEXT
        qk, vo = w["q"] @ w["k"].T * np.float32(d**-0.5), w["v"] @ w["o"]
        h = np.take(w["e"], x, axis=0, out=self._room("h", b, 2 * CONTEXT, d), mode="clip")
        h += w["p"]
        hq = self._room("hq", b, CONTEXT, d)
        hq[:] = h[:, CONTEXT:]
        hq = hq.reshape(n, d)
        a, pair = np.matmul(hq, qk, out=self._room("a", n, d)), self._room("pair", b, 2 * CONTEXT, 2 * CONTEXT)  # half of pair is for gradients
        s = pair[:, :CONTEXT]
        np.matmul(a.reshape(b, CONTEXT, d), h.transpose(0, 2, 1), out=s)
        s *= np.reciprocal(_exp(s, self.mask)[0])[..., None]
        m = np.matmul(s, h, out=self._room("m", b, CONTEXT, d)).reshape(n, d)
        r = np.matmul(m, vo, out=self._room("r", n, d))
        r += hq
        z = np.matmul(r, w["a"], out=self._room("z", n, HIDDEN))
        z += w["ab"]
        np.maximum(z, 0, out=z)
        y = np.matmul(z, w["c"], out=self._room("y", n, CLASSES))
        y += w["cb"]
        return {"qk": qk, "vo": vo, "h": h, "hq": hq, "a": a, "pair": pair, "m": m, "r": r, "z": z, "y": y}

    def gradients(self, x: np.ndarray, target: np.ndarray, weight: np.ndarray) -> dict:
        """Gradients of the mean negative log probability of target classes; weight is 0 for padding.  That of e: its rows, each once, and theirs."""
        w, f = self.w, self._forward(x)
        b, d = len(x), WIDTH
        n, small, scale = b * CONTEXT, self._room("small", b * CONTEXT, d), np.float32(d**-0.5)
        h, hq, pair, m, r, z, dy = (f[k] for k in ("h", "hq", "pair", "m", "r", "z", "y"))
        both = self._room("both", b, 2 * CONTEXT, d)
        both[:, CONTEXT:] = f["a"].reshape(b, CONTEXT, d)
        weight = weight.ravel() / np.float32(max(1.0, float(weight.sum())))
        dy *= (weight / _exp(dy)[0])[:, None]
        dy.ravel()[np.arange(n) * CLASSES + target.ravel()] -= weight
        g = {"c": z.T @ dy, "cb": np.ones(n, np.float32) @ dy}
        da = np.matmul(dy, w["c"].T, out=self._room("da", n, HIDDEN))
        da *= z > 0
        g["a"], g["ab"] = r.T @ da, np.ones(n, np.float32) @ da
        dr = np.matmul(da, w["a"].T, out=r)
        gvo = m.T @ dr
        g["v"], g["o"] = gvo @ w["o"].T, w["v"].T @ gvo
        np.matmul(dr, f["vo"].T, out=small)
        dm, s, ds = both[:, :CONTEXT], pair[:, :CONTEXT], pair[:, CONTEXT:]
        dm[:] = small.reshape(b, CONTEXT, d)
        np.matmul(dm, h.transpose(0, 2, 1), out=ds)
        ds -= np.einsum("ij,ij->i", small, m).reshape(b, CONTEXT, 1)  # m is the mean of h by s, so this is that of ds
        ds *= s
        dq = np.matmul(ds, h, out=self._room("dq", b, CONTEXT, d)).reshape(n, d)
        gqk = hq.T @ dq * scale
        g["q"], g["k"] = gqk @ w["k"], gqk.T @ w["q"]
        dh = np.matmul(pair.transpose(0, 2, 1), both, out=self._room("dh", b, 2 * CONTEXT, d))
        dr += np.matmul(dq, f["qk"].T, out=small)
        dh[:, CONTEXT:] += dr.reshape(b, CONTEXT, d)
        g["p"] = (np.ones(b, np.float32) @ dh.reshape(b, -1)).reshape(-1, d)
        # inputs that a window shares with the next one are added up before all are, by row
        shared = np.append((x[:-1, CONTEXT:] == x[1:, :CONTEXT]).all(1), False)
        dh[:-1, CONTEXT:] += dh[1:, :CONTEXT] * shared[:-1, None, None]
        alone = np.flatnonzero(np.append(True, ~shared[:-1]))
        rows = np.concatenate([x[:, CONTEXT:].ravel(), x[alone, :CONTEXT].ravel()]).astype(np.uint16)
        by = np.argsort(rows, kind="stable")
        rows = rows[by]
        first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
        each = np.concatenate([dh[:, CONTEXT:].reshape(-1, d), dh[alone, :CONTEXT].reshape(-1, d)])[by]
        g["e"] = (rows[first].astype(np.int64), np.add.reduceat(each, first, axis=0))
        return g

    def train(self, x: np.ndarray, target: np.ndarray, weight: np.ndarray, state: dict, rate: float) -> None:
        """A step of Adagrad."""
        g = self.gradients(x, target, weight)
        rows, total = g.pop("e")
        if not state:
            state |= {"e": np.full(self.shapes["e"], 1e-6, np.float32), "rest": np.full(self.size - ROWS * WIDTH, 1e-6, np.float32)}
        seen = state["e"][rows] + total**2
        state["e"][rows] = seen
        self.w["e"][rows] -= rate * total / np.sqrt(seen)
        g = np.concatenate([g[name].ravel() for name in self.shapes if name != "e"])
        state["rest"] += g**2
        self.flat[ROWS * WIDTH :] -= rate * g / np.sqrt(state["rest"])  # e comes first


def _exp(a: np.ndarray, mask: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | np.float32]:
    """Turns scores into exponentials in place, 0 where the mask is; gives their sums along the last axis, and what was taken from the scores lest they leave the range."""
    top = np.float32(0)
    if not (a.max(initial=0) < 60 and a.min(initial=0) > -60):
        if mask is not None:
            a += (mask - 1) * np.float32(1e9)
        top = a.max(-1, keepdims=True)
        a -= top
        top = top[..., 0]
    np.exp(a, out=a)
    if mask is not None:
        a *= mask
    return a @ np.ones(a.shape[-1], np.float32), top


class Model:
    """Everything that scoring needs; all sizes are fixed by the vocabulary and the constants above."""

    def __init__(self, stats: np.ndarray, bpe: Bpe):
        self._forget()
        self.bpe, self.end = bpe, bpe.special.get("<|endoftext|>", len(bpe.bytes) - 1)
        count = stats[:, 0].astype(np.float64)
        self.group = classes_of(stats)
        total, many = np.bincount(self.group, count, CLASSES), np.bincount(self.group, minlength=CLASSES)
        self.share = (np.log10(count + 0.5) - np.log10(np.maximum(total + 0.5 * many, 0.5))[self.group]).astype(np.float32)
        by = np.argsort(-count, kind="stable")
        self.row = np.zeros(len(count), np.int64)
        self.row[by] = np.where(np.arange(len(by)) < ROWS - 1025, 1 + np.arange(len(by)), ROWS - 1024 + by % 1024)  # row 0 pads
        self.starts = np.array([t.startswith(b" ") for t in bpe.bytes])  # words have a blank in front and none inside
        self.starts[self.end] = True
        self.net = Net()
        self.net.w["cb"][:] = np.log(total + many + 0.01) - np.log((total + many + 0.01).sum())

    def _forget(self) -> None:
        """The words met go: the number of each, and by that the place and number of its ids, and its count."""
        self.numbers, self.cached = _Numbers(), 0
        self.begin, self.long, self.cut, self.count = array("q"), array("q"), array("q"), array("q")

    def read(self, raws: Iterable[bytes], counts: dict[bytes, int]) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
        """Of each text its words and the end, their subword ids, and their counts."""
        for raw in raws:
            words = raw.lower().split()
            words.append(b"")
            at = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
            for w in self.numbers.new:
                made = self.bpe.greedy(b" " + w) if w else [self.end]
                self.begin.append(len(self.cut))
                self.long.append(len(made))
                self.count.append(counts.get(w, 0))
                self.cut.extend(made)
                self.cached += len(w) + 8 * len(made)
            self.numbers.new.clear()
            n = np.frombuffer(self.long, np.int64)[at]
            place = np.frombuffer(self.begin, np.int64)[at] - (np.cumsum(n) - n)
            yield words, np.frombuffer(self.cut, np.int64)[np.arange(n.sum()) + np.repeat(place, n)], np.frombuffer(self.count, np.int64)[at]
            if len(self.numbers) > CACHE_WORDS or self.cached > CACHE_BYTES:
                self._forget()

    def ids(self, raws: Iterable[bytes]) -> list[np.ndarray]:
        """Subword ids of the words of each text, and the end."""
        return [ids for _, ids, _ in self.read(raws, {})]

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("numbers", "cached", "begin", "long", "cut", "count")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._forget()

    def windows(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Inputs, targets and weights of texts' ids: window i of a text has 2 x CONTEXT inputs and scores its ids i x CONTEXT and on."""
        n = np.array([len(t) for t in texts])
        many, nth = -(-n // CONTEXT), np.arange(len(texts))
        ids, before = np.concatenate(texts), np.cumsum(many) - many
        at = np.arange(len(ids)) + np.repeat(before * CONTEXT - (np.cumsum(n) - n), n)
        y, weight = np.zeros(many.sum() * CONTEXT, np.int64), np.zeros(many.sum() * CONTEXT, np.float32)
        y[at], weight[at] = ids, 1
        at += np.repeat((nth + 1) * CONTEXT + 1, n)  # a text's inputs begin with a block of padding and one place more
        x = np.zeros((many.sum() + len(texts)) * CONTEXT + 1, np.int64)
        x[at] = self.row[ids]
        x[at[np.cumsum(n) - 1]] = 0  # nothing follows the last id
        x = np.lib.stride_tricks.sliding_window_view(x[:-1], 2 * CONTEXT)[::CONTEXT]
        return x[np.arange(many.sum()) + np.repeat(nth, many)], y.reshape(-1, CONTEXT), weight.reshape(-1, CONTEXT)

    def score(self, texts: list[np.ndarray], chances: list[np.ndarray]) -> list[tuple[float, np.ndarray]]:
        """log10 probability of each text, given its ids and each word's probability by the counts (0 if unknown), and of each word by the network.

        A word's probability is the even mixture of that and of its ids' by the network.  Both add up to 1 at most: the network also
        gives some to ids that can't stand there, and to words cut otherwise.
        """
        out = []
        for some in _some(texts):
            x, y, weight = self.windows(some)
            got = np.empty(y.shape, np.float32)
            for i in range(0, len(x), STEP):
                s = slice(i, i + STEP)
                got[s] = self.net.log_targets(x[s], self.group[y[s]])
            ids, there = np.concatenate(some), chances[len(out) : len(out) + len(some)]
            got = got[weight > 0] / np.float32(np.log(10)) + self.share[ids]
            word = np.add.reduceat(got, np.flatnonzero(self.starts[ids]), dtype=np.float64)
            mixed = np.logaddexp(word * np.log(10), np.log(np.maximum(np.concatenate(there), 1e-300))) / np.log(10) - np.log10(2)
            ends = np.cumsum([len(c) for c in there])
            out += zip(np.add.reduceat(mixed, ends - [len(c) for c in there]).tolist(), np.split(word, ends[:-1]), strict=True)
        return out


class _Numbers(dict):
    """Numbers words as they are met, and lists the new ones."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self.new.append(word)
        self[word] = n = len(self)
        return n


def _some(texts: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Texts' ids in lists of some ``TOGETHER`` ids, so that what is made of them stays small."""
    some, many = [], 0
    for t in texts:
        some.append(t)
        many += len(t)
        if many >= TOGETHER:
            yield some
            some, many = [], 0
    if some:
        yield some


def _train_round(docs: DataFrame, model, round_: int, rounds: int, shards: int) -> DataFrame:
    """The shards' networks after all windows of this round's documents, each times the ids it saw, and that number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        m, state, seen, rest = model.value, {}, 0, None
        net = Net(m.net.flat)

        def step(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
            net.train(x, m.group[y], weight, state, RATE / (1 + round_))

        for b in batches:
            for texts in _some(m.ids(raw_texts(b, "text"))):
                part = m.windows(texts)
                seen += sum(map(len, texts))
                if rest is not None:
                    part = [np.concatenate(p) for p in zip(rest, part, strict=True)]
                whole = len(part[0]) // STEP * STEP
                for i in range(0, whole, STEP):
                    step(*(a[i : i + STEP] for a in part))
                rest = [a[whole:] for a in part]
        if rest is not None and len(rest[0]):
            step(*rest)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([np.append(net.flat.astype(np.float64) * seen, float(seen)).tobytes()], pa.binary())], names=["net"])

    fold = lambda text: F.crc32(text.cast("binary"))
    id_ = F.coalesce(F.col("id").cast("string"), F.lit(""))
    mine = docs.where((fold(id_) % FOLDS != HELD) & (fold(F.concat(F.lit("stretch "), id_)) % rounds == round_))
    order = F.xxhash64("id", "text")
    dealt = mine.select("text", order.alias("h")).repartition(shards, "h").sortWithinPartitions("h", "text")
    return dealt.mapInArrow(run, "net binary")


def _frequent(counts: DataFrame, most: int) -> dict[bytes, int]:
    """The words of the greatest counts, at most so many: their least count is found by the counts' sizes, so no more than these reach the driver."""
    size = F.floor(F.log2("c") * 64).cast("int")  # at most 64 x 64 of them
    many, least = 0, None
    for r in sorted(counts.groupBy(size.alias("size")).agg(F.count("*").alias("n")).collect(), key=lambda r: -r["size"]):
        many += r["n"]
        if many > most:
            break
        least = r["size"]
    return {} if least is None else {bytes(r["word"]): r["c"] for r in counts.where(size >= least).toLocalIterator()}


def score(docs: DataFrame, bpe: Bpe, scratch: Scratch, *, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT, rounds: int = ROUNDS) -> DataFrame:
    """A row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType.simpleString()
    sc = spark.sparkContext
    df = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    counts = scratch.keep(_count_words(df), "counts")
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = _frequent(counts, frequent)
    known = sc.broadcast(top)
    shared = sc.broadcast(bpe)
    model = Model(_id_stats(counts, shared, scratch), bpe)
    shards = max(1, -(-total // SHARD_WORDS))
    for r in range(rounds):
        sent = sc.broadcast(model)
        got = fold_bytes(scratch.keep(_train_round(df, sent, r, rounds, shards), "nets"), "net", "<f8", lambda a, b: a + b)
        if got is not None:
            model.net = Net(got[:-1] / got[-1])
        sent.unpersist()
    sent = sc.broadcast(model)
    whole = distinct <= frequent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        m, most = sent.value, known.value
        for b in batches:
            n, hits, base, others, chances, texts = [], [], [], [], [], []
            for words, ids, c in m.read(raw_texts(b, "text"), most):
                found = c > 0
                n.append(len(words))
                hits.append(int(found.sum()))
                chances.append(c / max(1, total))
                base.append(float(np.log10(c[found] + 1).sum()))
                others.append([] if whole else [(i, words[i]) for i in np.flatnonzero(~found).tolist()])
                texts.append(ids)
            scores, rare = [], []
            for (score_, by_word), places in zip(m.score(texts, chances), others, strict=True):
                scores.append(score_)
                at: dict[bytes, list[float]] = {}
                for i, w in places:
                    at.setdefault(w, []).append(float(by_word[i]))
                rare.append([{"word": w, "at": x} for w, x in at.items()])
            held = [is_held_out(x) for x in b.column("id").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(held), pa.array(n, pa.int64()), pa.array(hits, pa.int64()), pa.array(base, pa.float64()), pa.array(scores, pa.float64()), pa.array(rare, pa.list_(pa.struct([("word", pa.binary()), ("at", pa.list_(pa.float64()))])))],
                names=["id", "held_out", "n_tokens", "hits", "base", "score", "rare"],
            )

    scored = df.mapInArrow(run, f"id {kind}, held_out boolean, n_tokens long, hits long, base double, score double, rare array<struct<word:binary,at:array<double>>>")
    kept = scratch.keep(scored.withColumn("uid", F.monotonically_increasing_id()), "scored")  # written, so the numbers stay
    rest = kept.select("uid", F.inline("rare"))
    n, chance = F.size("at").cast("long"), F.log10(F.col("c") / F.lit(float(max(1, total))))
    mixed = lambda x, y: F.greatest(x, y) + F.log1p(F.pow(F.lit(10.0), -F.abs(x - y))) / F.lit(float(np.log(10)))
    share = F.aggregate("at", F.lit(0.0), lambda a, x: a + mixed(x, chance) - mixed(x, F.lit(-300.0)))
    others = rest.join(counts, "word").groupBy("uid").agg(F.sum(n).alias("more"), F.sum(n * F.log10(F.col("c") + 1)).alias("gain"), F.sum(share).alias("shares"))
    out = kept.drop("rare").join(others, "uid", "left")
    floor = float(np.log10(total + distinct + 1))
    return out.select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("hits") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("gain", F.lit(0.0)) - F.col("n_tokens") * F.lit(floor)).alias("base_score"),
        (F.col("score") + F.coalesce("shares", F.lit(0.0))).alias("score"),
    )
