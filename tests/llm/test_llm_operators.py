"""The training-data operators against brute force, on small and awkward tables."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.llm import bpe, decontaminate, jaccard, licenses, lm, passages, pii, quality, token_counts, warc
from newsloom.llm.common import Scratch
from newsloom.llm.queries import byte_bpe

WORDS = "the a of river bank quick brown fox jumps over lazy dog near and then some other word éclair straße 中文 don't x1".split()
SCHEMA = "doc_id long, text string, n_words string, id string, hit string, kid int"


def awkward(rng, n=60):
    """Nulls, empty and long texts, ties, repeated rows, and columns whose names clash with the operators' own."""
    texts = [None, "", "   \n\t ", "one", "word " * 3000, "x" * 5000, " ".join(rng.choice(WORDS) for _ in range(4000))]
    texts += [" ".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 80))) for _ in range(n)]
    texts += texts[-5:]
    rows = [(i, t, "c", "c", "c", i) for i, t in enumerate(texts)]
    return [*rows, rows[10], (None, "a row without an id", None, None, None, None)]


@pytest.fixture(scope="module")
def rows():
    return awkward(random.Random(5))


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_token_counts(spark, docs, rows):
    vocabulary = [b" ", b" the", b"the", b"r", b"ri", b"iver", b"v", b"e", b"i", b"x", b"xx", b"a", b"ab", b"abcd", b"b", b"c"]

    def greedy(word):
        n = at = 0
        while at < len(word):
            size = max((len(t) for t in vocabulary if word.startswith(t, at)), default=0)
            if not size:
                return None
            n, at = n + 1, at + size
        return n

    automaton = token_counts.LongestMatch(vocabulary)
    rng = random.Random(1)
    for _ in range(3000):
        w = bytes(rng.choice(b"abcdrivexq ") for _ in range(rng.randrange(12)))
        want = greedy(w)
        assert automaton.count(w) == (-1 if want is None else want), w
    got = sorted((tuple(r) for r in token_counts.count_tokens(docs, vocabulary).collect()), key=repr)
    want = []
    for r in rows:
        each = [greedy(b" " + w) for w in (r[1] or "").encode().split()]
        want.append((r[0], len(each), sum(1 if x is None else x for x in each), each.count(None)))
    assert got == sorted(want, key=repr)
    with pytest.raises(ValueError, match="empty"):
        token_counts.LongestMatch([])
    assert token_counts.count_tokens(docs.where("false"), vocabulary).count() == 0


def _decontaminated(texts, items, n=10):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = lambda s: word.findall((s or "").translate({c: c + 32 for c in range(65, 91)}))
    windows = {}
    for item, s in items:
        w = low(s)
        size = min(n, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(item)
    out = []
    for s in texts:
        w, hit, found = low(s), set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if (items_ := windows.get(tuple(w[i : i + size]))) is not None:
                    hit.update(range(i, i + size))
                    found |= items_
        out.append((len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return out


@pytest.mark.parametrize("block", [10**6, 60])
def test_decontamination(spark, docs, rows, block):
    rng = random.Random(2)
    items = [(i, " ".join(rng.choice(WORDS) for _ in range(rng.choice((1, 2, 3, 12))))) for i in range(12)] + [(3, "lazy dog near"), (None, "brown fox"), (5, None), (6, "--"), (7, rows[6][1][100:300])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in decontaminate.scan(docs, bench, block_chars=block).collect())
    assert got == Counter((r[0], a, b, tuple(c)) for r, (a, b, c) in zip(rows, _decontaminated([r[1] for r in rows], items), strict=True))
    kept = decontaminate.remove(docs, bench, block_chars=block)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r[0] for r, x in zip(rows, _decontaminated([r[1] for r in rows], items), strict=True) if not x[1])
    cut = {r["doc_id"]: r["text"] for r in decontaminate.remove(docs, spark.createDataFrame([(1, "quick brown")], "item_id long, text string"), mode="spans").collect()}
    assert cut[0] is None and not any(re.search(r"\bquick brown\b", t or "") for t in cut.values())


def test_decontamination_spans(spark):
    d = spark.createDataFrame([(1, "Éa, Quick-brown! fox")], "doc_id long, text string")
    r = decontaminate.scan(d, spark.createDataFrame([(9, "quick brown")], "item_id long, text string")).first()
    assert [("Éa, Quick-brown! fox")[s["start"] : s["end"]] for s in r["spans"]] == ["Quick-brown"]


def test_decontamination_without_benchmark(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.scan(docs, none).where("n_hit > 0").count() == 0


def test_lm(spark, docs, rows, monkeypatch):
    got = lm.score(docs, byte_bpe(), Scratch(spark, "t"), frequent=5).collect()
    low = [(r[1] or "").encode().lower().split() + [b""] for r in rows]
    held = [zlib.crc32(b"" if r[0] is None else str(r[0]).encode()) % 7 == 2 for r in rows]
    c = Counter(w for ws, h in zip(low, held, strict=True) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted((repr(r[0]), h, len(ws), sum(w in c for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6)) for r, h, ws in zip(rows, held, low, strict=True))
    assert sorted((repr(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    assert all(r["score"] < 0 for r in got)
    empty = lm.score(docs.where("false"), byte_bpe(), Scratch(spark, "t"))
    assert empty.count() == 0


def test_lm_trains_on_every_id(spark, docs, rows):
    model = lm.Model(np.ones((len(byte_bpe().bytes), 1 + 2 * lm.NEAR), np.float32), byte_bpe())
    sent = spark.sparkContext.broadcast(model)
    df = docs.select(F.col("doc_id").alias("id"), "text")
    nets = [np.frombuffer(bytes(r["net"]), "<f8") for k in range(lm.ROUNDS) for r in lm._train_round(df, sent, k, lm.ROUNDS, 3).collect()]
    assert sum(int(x[-1]) for x in nets) == sum(map(len, model.ids([(r[1] or "").encode() for r in rows if not lm.is_held_out(r[0])])))


def test_lm_does_not_hang_on_splits_and_beats_counts(spark):
    """The same corpus in 4 and in 16 parts gives the same scores; on held-out texts they are better than the counts alone."""
    rng = random.Random(3)
    after = {w: [rng.choice(WORDS) for _ in range(2)] for w in WORDS}
    texts = []
    for _ in range(300):
        w = [rng.choice(WORDS)]
        while len(w) < 60:
            w.append(rng.choice(after[w[-1]]))
        texts.append(" ".join(w))
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    few, many = ({r["doc_id"]: r for r in lm.score(d.repartition(n), byte_bpe(), Scratch(spark, "t")).collect()} for n in (4, 16))
    assert [few[i]["score"] for i in range(300)] == pytest.approx([many[i]["score"] for i in range(300)], rel=1e-4)
    held = [r for r in few.values() if r["held_out"]]
    assert held and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_lm_frequent_words(spark):
    counts = spark.createDataFrame([(f"w{i}".encode(), i + 1) for i in range(100)], "word binary, c long")
    got = lm._frequent(counts, 10)
    assert 5 <= len(got) <= 10 and min(got.values()) > 90 and lm._frequent(counts, 0) == {} and len(lm._frequent(counts, 1000)) == 100


def test_lm_scores_do_not_hang_on_what_is_broadcast(spark, docs):
    few, all_ = (sorted((repr(r["doc_id"]), r["score"]) for r in lm.score(docs, byte_bpe(), Scratch(spark, "t"), frequent=n, rounds=0).collect()) for n in (3, 10**6))
    assert [x for x, _ in few] == [x for x, _ in all_]
    assert [y for _, y in few] == pytest.approx([y for _, y in all_], rel=1e-9)


def test_lm_gradients():
    rng = np.random.default_rng(0)
    net = lm.Net(np.random.default_rng(1).standard_normal(lm.Net.size) * 0.2)
    net = lm.Net(net.flat)
    x, y = rng.integers(0, 50, (3, 2 * lm.CONTEXT)), rng.integers(0, lm.CLASSES, (3, lm.CONTEXT))
    weight = np.ones((3, lm.CONTEXT), np.float32)

    def loss():
        return -np.take_along_axis(net.log_classes(x), y[..., None], -1).mean(dtype=np.float64)

    g = net.gradients(x, y, weight)
    for name in ("q", "k", "v", "o", "a", "c", "p", "ab", "cb"):
        at = tuple(rng.integers(0, s) for s in net.shapes[name])
        old, step = net.w[name][at], 1e-2
        net.w[name][at] = old + step
        up = loss()
        net.w[name][at] = old - step
        down = loss()
        net.w[name][at] = old
        assert (up - down) / (2 * step) == pytest.approx(g[name][at], rel=0.08, abs=2e-4), name


def test_lm_is_causal():
    net = lm.Net()
    x = np.arange(1, 2 * lm.CONTEXT + 1)[None, :]
    other = x.copy()
    other[0, -1] = 77
    a, b = net.log_classes(x), net.log_classes(other)
    assert np.allclose(a[0, :-1], b[0, :-1]) and not np.allclose(a[0, -1], b[0, -1])
    assert np.allclose(np.exp(a).sum(-1), 1, atol=1e-4)
    target = np.arange(lm.CONTEXT)[None, :] % lm.CLASSES
    assert np.allclose(net.log_targets(x, target), np.take_along_axis(a, target[..., None], -1)[..., 0], atol=1e-4)


def test_lm_scores_out_of_range():
    """Scores beyond what exponentials can hold give the same log probabilities, and none above 0, by both ways."""
    rng = np.random.default_rng(5)
    net = lm.Net(rng.standard_normal(lm.Net.size) * 2)
    x, y = rng.integers(0, 50, (4, 2 * lm.CONTEXT)), rng.integers(0, lm.CLASSES, (4, lm.CONTEXT))
    assert net.log_classes(x).min() < -200
    got = net.log_targets(x, y)
    assert (got <= 1e-3).all()
    assert np.allclose(got, np.take_along_axis(net.log_classes(x), y[..., None], -1)[..., 0], rtol=1e-4, atol=1e-2)
    assert all(np.isfinite(v[1] if k == "e" else v).all() for k, v in net.gradients(x, y, np.ones(y.shape, np.float32)).items())


def test_lm_gradients_of_the_embedding():
    """Rows come once each, and their gradients are right where windows overlap and where they don't."""
    rng = np.random.default_rng(2)
    net = lm.Net(rng.standard_normal(lm.Net.size) * 0.2)
    run = rng.integers(1, 30, 4 * lm.CONTEXT)
    x = np.stack([run[: 2 * lm.CONTEXT], run[lm.CONTEXT : 3 * lm.CONTEXT], rng.integers(1, 30, 2 * lm.CONTEXT)])
    y, weight = rng.integers(0, lm.CLASSES, (3, lm.CONTEXT)), np.ones((3, lm.CONTEXT), np.float32)
    rows, g = net.gradients(x, y, weight)["e"]
    assert rows.tolist() == sorted(set(x.ravel().tolist()))

    def loss():
        return -np.take_along_axis(net.log_classes(x), y[..., None], -1).mean(dtype=np.float64)

    for i in rng.permutation(len(rows))[:8]:
        j, step = int(np.abs(g[i]).argmax()), 1e-2
        old = net.w["e"][rows[i], j]
        net.w["e"][rows[i], j] = old + step
        up = loss()
        net.w["e"][rows[i], j] = old - step
        down = loss()
        net.w["e"][rows[i], j] = old
        assert (up - down) / (2 * step) == pytest.approx(g[i, j], rel=0.08, abs=2e-4)


def test_lm_reads_and_windows(monkeypatch):
    """Words, ids and counts are the same after what was met is forgotten; each id is a target once, after those before it."""
    texts = [b"", b"Fox  fox\njumped over", b"a " * 100, bytes(range(97, 123)) * 3, b"fox " * 15, b"over jumped"]
    model = lm.Model(np.ones((len(byte_bpe().bytes), 1 + 2 * lm.NEAR), np.float32), byte_bpe())
    first = list(model.read(texts, {b"fox": 7, b"": 3}))
    assert [w for w, _, _ in first] == [t.lower().split() + [b""] for t in texts]
    assert first[1][2].tolist() == [7, 7, 0, 0, 3]
    for words, ids, _ in first:
        assert ids.tolist() == [i for w in words for i in (byte_bpe().greedy(b" " + w) if w else [model.end])]
    monkeypatch.setattr(lm, "CACHE_WORDS", 1)
    again = list(model.read(texts, {b"fox": 7, b"": 3}))
    assert all(a[0] == b[0] and (a[1] == b[1]).all() and (a[2] == b[2]).all() for a, b in zip(first, again, strict=True))
    all_ids = [ids for _, ids, _ in first] + [np.arange(n) for n in (lm.CONTEXT - 1, lm.CONTEXT, lm.CONTEXT + 1)]
    x, y, weight = model.windows(all_ids)
    want = []
    for ids in all_ids:
        before = np.concatenate([np.zeros(lm.CONTEXT + 1, np.int64), model.row[ids[:-1]], np.zeros(lm.CONTEXT, np.int64)])
        for i in range(0, len(ids), lm.CONTEXT):
            mine = ids[i : i + lm.CONTEXT].tolist()
            want.append((before[i : i + 2 * lm.CONTEXT].tolist(), mine + [0] * (lm.CONTEXT - len(mine)), [1.0] * len(mine) + [0.0] * (lm.CONTEXT - len(mine))))
    assert [(a.tolist(), b.tolist(), c.tolist()) for a, b, c in zip(x, y, weight, strict=True)] == want


def _pii_base(t):
    kinds = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    out = []
    for kind, p in kinds.items():
        for m in re.finditer(p, t or ""):
            d = re.sub("[^0-9]", "", m[0])
            luhn = sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0
            if {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True, "card": 16 <= len(d) <= 19 and luhn, "phone": 8 <= len(d) <= 15}[kind]:
                out.append((kind, m.start(), m.end()))
    return out


def test_pii(spark):
    rng = random.Random(3)
    pieces = ["a", "b@", "@c", ".", ".com", "_", "-", "1", "12", "255", "256", "1.2.3.4", "+1", " ", "(", ")", "4111 1111 1111 1111", "4111111111111111", "+49 30 123456", " at ", "dot", "é", "\n", "x.y@z.w", "٣", "日"]
    texts = [None, "", "a" * 20000, "1" * 20000, "1." * 3000, "a@b" + ".c" * 3000, "+1" + " " * 9000, "a@" * 3000] + ["".join(rng.choice(pieces) for _ in range(rng.randrange(40))) for _ in range(400)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.detect(d, Scratch(spark, "t")).collect():
        assert [(s["kind"], s["start"], s["end"]) for s in r["spans"] if s["base"]] == _pii_base(texts[r["doc_id"]])


def test_pii_recovers_planted_reliabilities():
    """Votes drawn from known reliabilities, as counts of patterns; EM sees no labels."""
    import itertools

    yes = {"checked": 0.95, "listed": 0.8, "cued": 0.7, "countered": 0.05}
    no = {"checked": 0.3, "listed": 0.15, "cued": 0.1, "countered": 0.4}
    rows = []
    for votes in itertools.product((0, 1), repeat=len(pii.VOTES)):
        r = dict(zip(pii.VOTES, votes, strict=True))
        of = lambda p: np.prod([p[v] if r[v] else 1 - p[v] for v in pii.VOTES])  # noqa: E731, B023
        rows.append(r | {"n": round(1e6 * (0.4 * of(yes) + 0.6 * of(no)))})
    got, soft = pii.estimate(rows, 2000)
    assert abs(got["prior"] - 0.4) < 0.02
    for v in pii.VOTES:
        assert got[v] == pytest.approx((yes[v], no[v]), abs=0.03)
    sure = [p for r, p in zip(rows, soft, strict=True) if r["checked"] and r["listed"] and r["cued"] and not r["countered"]]
    assert sure[0] > 0.95


def test_pii_long_text_with_many_spans(spark):
    """Thousands of spans in one text: offsets stay exact, and masking equals replacing by hand."""
    n = 3000
    text = "é😀 " + " ".join(f"user{i}@example.org +1 555 {i:07d}" for i in range(n)) + " x" * 700
    d = spark.createDataFrame([(1, text, len(text)), (2, "", 0), (3, None, None)], "doc_id long, text string, n_chars long")
    got = {r["doc_id"]: r["spans"] for r in pii.detect(d, Scratch(spark, "t")).collect()}
    assert [(s["kind"], s["start"], s["end"]) for s in got[1] if s["base"]] == _pii_base(text) and got[2] == got[3] == []
    masked = {r["doc_id"]: r for r in pii.mask(d, Scratch(spark, "t")).collect()}
    assert masked[1]["text"] == "é😀 " + " ".join(["[EMAIL] [PHONE]"] * n) + " x" * 700
    assert masked[1]["n_chars"] == len(masked[1]["text"]) and masked[3]["text"] is None


def test_pii_empty_table(spark):
    d = spark.createDataFrame([], "doc_id long, text string, n_chars long")
    assert pii.detect(d, Scratch(spark, "t")).count() == 0 and pii.mask(d, Scratch(spark, "t")).count() == 0


def test_pii_masks(spark):
    text = "mail jo@example.org now, or write to bob [at] example [dot] com; card 4111 1111 1111 1111."
    d = spark.createDataFrame([(1, text, len(text), "x"), (2, "nothing 12 here", 15, "y"), (3, None, None, "z")], "doc_id long, text string, n_chars long, found string")
    got = {r["doc_id"]: r for r in pii.mask(d).collect()}
    assert got[1]["text"] == "mail [EMAIL] now, or write to [EMAIL]; card [CARD]." and got[1]["n_chars"] == len(got[1]["text"])
    assert tuple(got[2]) == (2, "nothing 12 here", 15, "y") and got[3]["text"] is None


def test_pii_candidates_stand_alone(spark):
    """A candidate is found whatever else the text has."""
    texts = ["Call 555.123.4567.", "Call (555) 123-4567", "visa 4 1 1 1 1 1 1 1 1 1 1 1 9 done", "visa 41 11-11 11-11 11 19", "a[at]b[dot]c", "ssn 123-45-6789"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: {s["kind"] for s in r["found"]} for r in pii.candidates(d, "text", "found").collect()}
    want = ["phone", "phone", "card", "card", "email", "ssn"]
    assert [k in got[i] for i, k in enumerate(want)] == [True] * len(want)


def _classes(texts, n=5):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()})
    root = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            i = len(sets[a] & sets[b])
            if i and 100 * i >= 75 * (len(sets[a]) + len(sets[b]) - i):
                x, y = root[a], root[b]
                root = [min(x, y) if r in (x, y) else r for r in root]
    return sets, root


def test_jaccard(spark):
    rng = random.Random(4)
    texts = [None, "", "  ", "one two", "One TWO", "x " * 500]
    for _ in range(12):
        base = [rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(rng.randrange(5, 150))]
        for _ in range(rng.randrange(1, 12)):
            copy = list(base)
            for _ in range(rng.randrange(0, 5)):
                copy[rng.randrange(len(copy))] = rng.choice(WORDS)
            texts.append(" ".join(copy))
    texts += texts[6:9]
    d = spark.createDataFrame([(i, t, 1, "c") for i, t in enumerate(texts)], "doc_id long, text string, kid int, n string")
    sets, root = _classes(texts)
    for r in jaccard.classes(d, Scratch(spark, "t")).collect():
        assert (r["n_shingles"], r["component_id"]) == (len(sets[r["doc_id"]]), root[r["doc_id"]])
    kept = jaccard.deduplicate(d, Scratch(spark, "t"))
    assert kept.columns == d.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(root))


def test_jaccard_without_rows_ids_or_partners(spark):
    d = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (4, "a b c d e f"), (5, "g h i j k l"), (5, "g h i j k l")], "doc_id long, text string")
    assert sorted((repr(r["doc_id"]), r["component_id"]) for r in jaccard.classes(d, Scratch(spark, "t")).collect()) == [("4", 4), ("5", 5), ("5", 5), ("None", 4), ("None", 4)]
    assert jaccard.classes(d.where("false"), Scratch(spark, "t")).count() == 0
    assert sorted(repr(r["doc_id"]) for r in jaccard.deduplicate(d, Scratch(spark, "t")).collect()) == ["4", "5", "None", "None"]


def test_quality(spark, docs, rows):
    for r in quality.assess(docs).where("doc_id is not null").collect():
        t = next(x[1] for x in rows if x[0] == r["doc_id"]) or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        again = {i + j for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for j in range(8)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (len(w) < 20 or 100 * len(again) > 30 * len(w)) and not (r["base_failed"] and r["kept"])
    cleaned = quality.clean(docs)
    assert cleaned.columns == docs.columns and cleaned.where("text is null").count() == 0


def test_quality_verdicts(spark):
    rng = random.Random(9)
    clean = "\n".join(" ".join(rng.choice(WORDS) + str(rng.randrange(99)) for _ in range(12)) + "." for _ in range(6))
    menu = "\n".join(f"Home{i} | About{i} | News{i} | x{i}" for i in range(8))
    symbols = " ".join(f"w{i}%%%" for i in range(60))
    dup = "\n".join(["a line of seven words goes here again."] * 3 + [clean])
    got = [quality.judge(t.encode())["kept"] for t in (clean, menu, symbols, dup)]
    assert got == [True, False, False, True]
    assert quality.judge(dup.encode())["clean"].decode().count("seven words") == 1
    assert quality.repeated_words([b"a", b"b"] * 6, 3) == quality._repeated_plain([b"a", b"b"] * 6, 3) == 12


def test_bpe(spark, docs, rows):
    from tokenizers import Tokenizer

    from newsloom.llm.queries import vocabulary_path

    lib = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    coder = byte_bpe()
    rng = random.Random(1)
    bits = ["a", "b", " ", "  ", "\n", "\t", "'s", "é", "日本", "١٢", "1", "　", "\xa0", "😀", "<|endoftext|>", "\x00", "\x85", "\x1c", "the", "ing", "!!", "_", "ſ"]
    odd = ["".join(rng.choice(bits) for _ in range(rng.randrange(50))) for _ in range(1500)] + ["a" * 3000, " " * 2000, "=-" * 1500, ""]
    want = [e.ids for e in lib.encode_batch(odd, add_special_tokens=False)]
    got = [np.frombuffer(x, "<u4").tolist() for x in coder.encode_batch([t.encode() for t in odd])]
    assert got == want
    assert [coder.decode(i) for i in got] == [lib.decode(i, skip_special_tokens=False) for i in got]
    for word in (b"onerblethwh", b" thanstnd", b"z" * 100):
        assert coder.exact(word) == [i for i in lib.encode(word.decode(), add_special_tokens=False).ids]
    for r in bpe.encode(docs, coder).where("doc_id is not null").collect():
        t = next(x[1] for x in rows if x[0] == r["doc_id"]) or ""
        assert r["ids"] == lib.encode(t, add_special_tokens=False).ids and r["decoded"] == t and r["n_tokens"] == len(r["ids"])
    assert bpe.tokenize(docs.withColumn("n_tokens", F.lit("x")), coder).where("text is null and n_tokens = 0").count() == 1
    with pytest.raises(ValueError, match="byte-level"):
        bpe.Bpe('{"model": {"type": "WordPiece"}}')


def test_warc(spark, tmp_path):
    html = ["<p>x</p>", "", None, "<p>x</p>", "é\r\n\r\nWARC/1.0\r\n", "long " * 9000, "", "only"]
    rows = [(i if i != 6 else None, f"http://WWW.b{i % 2}.example.com:80/p?q={i}#f" if i != 4 else None, h, "extra") for i, h in enumerate(html)] + [(0, "http://a.example.com/\n", "<p>x</p>", "extra")]
    path = str(tmp_path / "w")
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string, size string"), path)
    index = warc.index(warc.read(spark, path), Scratch(spark, "warc"), range_rows=3)
    found = index.withColumn("part", F.spark_partition_id()).collect()
    assert len({r["part"] for r in found}) > 1
    got = Counter((r["id"], r["size"], r["digest"], r["type"], r["refers_to"]) for r in found)
    want = Counter()
    for i, _, h, _ in rows:
        data = (h or "").encode()
        same = [x[0] for x in rows if (x[2] or "") == (h or "") and x[0] is not None]
        first = min(same) if len([x for x in rows if (x[2] or "") == (h or "")]) > 1 else None
        revisit = first is not None and i != first
        want[i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", first if revisit else None] += 1
    assert got == want
    order = [(r["url_key"], r["captured"], r["id"] is None, r["id"] or 0) for r in sorted(found, key=lambda r: r["part"])]
    by_part = sorted(order)
    assert order == by_part
    payload = {(r["run"], r["offset"]): r["digest"] for r in found if r["type"] == "response"}
    fetched = warc.fetch(spark, path, index.where("type = 'response'").select("run", "offset", "length")).collect()
    assert {(r["run"], r["offset"]): base64.b32encode(hashlib.sha1(r["payload"]).digest()).decode() for r in fetched} == payload and len(fetched) == len(payload)
    assert warc.url_key("http://www.Example.com:80/A?b#c") == "com,example)/A?b" and warc.url_key(None) == ""


def test_warc_archives_have_a_bound_in_bytes(spark, tmp_path):
    import glob

    d = spark.createDataFrame([(i, f"http://a/{i}", f"{i} " * 400) for i in range(12)], "page_id long, url string, html string").coalesce(1)
    warc.write(d, str(tmp_path / "w"), archive_bytes=2600)
    assert len(glob.glob(str(tmp_path / "w" / "*.gz"))) == 6
    scratch = Scratch(spark, "warc")
    assert [r["id"] for r in warc.index(warc.read(spark, str(tmp_path / "w")), scratch).collect()] == [0, 1, 10, 11, *range(2, 10)]
    warc.write(d.where("false"), str(tmp_path / "e"))
    assert warc.index(warc.read(spark, str(tmp_path / "e")), scratch).count() == 0


def test_warc_index_of_repeated_rows_keeps_ranges_small_and_places_true(spark, tmp_path):
    import glob

    d = spark.createDataFrame([(7, "http://a/", "same")] * 400 + [(i, f"http://b/{i % 3}", f"{i}" * 20000) for i in range(9)], "page_id long, url string, html string").repartition(3)
    warc.write(d, str(tmp_path / "w"), compression="none")
    found = warc.index(warc.read(spark, str(tmp_path / "w")), Scratch(spark, "warc"), range_rows=50).withColumn("part", F.spark_partition_id()).collect()
    assert len(found) == 409 and max(Counter(r["part"] for r in found).values()) <= 200
    keys = [(r["url_key"], r["captured"], r["id"], r["run"], r["offset"]) for r in sorted(found, key=lambda r: r["part"])]
    assert keys == sorted(keys)
    files = {name.rpartition("/")[2]: open(name, "rb").read() for name in glob.glob(str(tmp_path / "w" / "*.txt"))}
    for r in found:
        record = files[r["run"]][r["offset"] : r["offset"] + r["length"]]
        assert record.startswith(b"WARC/1.0\r\n") and f"<urn:page:{r['id']}>".encode() in record and record.endswith(b"\r\n\r\n")


def test_warc_min_bytes_and_broken_archives(spark, tmp_path):
    d = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab")], "page_id long, url string, html string")
    warc.write(d, str(tmp_path / "w"), min_bytes=3)
    assert {r["type"] for r in warc.read(spark, str(tmp_path / "w")).collect()} == {"response"}
    with pytest.raises(ValueError):
        list(warc.records(b"WARC/1.0\r\nContent-Length: 3\r\n\r\nabcdefgh"))
    assert list(warc.records(b"")) == []


@pytest.mark.parametrize("k", [0, 1, 2, 3, 7])
def test_loser_tree(k):
    rng = random.Random(k)
    runs = [sorted(rng.randrange(50) for _ in range(rng.randrange(20))) for _ in range(k)]
    assert list(warc.LoserTree(runs, lambda x: x)) == sorted(x for r in runs for x in r)


def test_passages(spark):
    rng = random.Random(6)
    noise = lambda n: [f"n{rng.randrange(10**6)}" for _ in range(n)]
    shared = [f"s{i}" for i in range(70)]
    fuzzy = [w if i % 12 else "changed" for i, w in enumerate(shared)]
    texts = [noise(30) + shared + noise(20), noise(200) + shared, shared + noise(5), noise(40) + fuzzy + noise(10), noise(300), noise(20) + shared[:30] + noise(20), [], ["w"] * 300]
    d = spark.createDataFrame([(i, " ".join(t), 0) for i, t in enumerate(texts)] + [(None, " ".join(shared), 0), (9, None, 0)], "doc_id long, text string, pos int")
    found = passages.find(d, Scratch(spark, "t")).collect()
    assert {r["id"] for r in found} == {0, 1, 2, 3}
    exact = [r for r in found if r["id"] in (1, 2) and r["home"] == 0]
    assert exact and all(r["end"] - r["start"] == 70 == r["matched"] and texts[r["id"]][r["start"] : r["end"]] == shared for r in exact)
    assert passages.find(d.where("false"), Scratch(spark, "t")).count() == 0


def test_passages_whose_seeds_lead_elsewhere(spark):
    """5 and 6 share 90 words; 1, 2, 8 and 9 have most of them, but no passage; 10 has an early phrase of its home twice."""
    rng = random.Random(7)
    noise = lambda n: [f"n{rng.randrange(10**6)}" for _ in range(n)]
    both = [f"s{i}" for i in range(90)]
    texts = {i: noise(30) + part + noise(30) for i, part in {1: both[:48], 8: both[:48], 2: both[42:], 9: both[42:], 5: both, 6: both}.items()}
    least = [f"t{i}" for i in range(50)]
    texts |= {3: noise(9) + least[20:45] + noise(60) + least + noise(9), 10: noise(17) + least + noise(3)}
    texts |= {0: noise(9) + least[:49], 11: least[1:] + noise(9)}
    d = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    found = {(r["id"], r["home"]): r for r in passages.find(d, Scratch(spark, "t")).collect()}
    assert {(5, 6), (6, 5), (3, 10), (10, 3)} <= set(found) and {i for i, _ in found} == {3, 5, 6, 10}
    r = found[5, 6]
    assert texts[5][r["start"] : r["end"]] == both == texts[6][r["home_start"] : r["home_end"]] and r["matched"] == 90


@pytest.mark.parametrize(("rate", "least"), [(0, 1.0), (0.05, 1.0), (0.1, 0.9)])
def test_passages_among_pieces(spark, rate, least):
    """Pairs that share a passage of 60 to 119 words, some of them replaced, and for each eight documents with pieces of it."""
    rng = random.Random(5)
    noise = lambda n: [f"n{rng.randrange(10**6)}" for _ in range(n)]
    ids = iter(rng.sample(range(1000), 400))
    texts, pairs = {}, []
    for p in range(40):
        whole = [f"p{p}w{i}" for i in range(rng.randrange(60, 120))]
        other = list(whole)
        for i in rng.sample(range(len(whole)), round(rate * len(whole))):
            other[i] = f"c{rng.randrange(10**6)}"
        a, b = next(ids), next(ids)
        texts |= {a: noise(rng.randrange(40)) + whole + noise(30), b: noise(rng.randrange(60)) + other + noise(10)}
        pairs.append((a, b))
        for _ in range(8):
            n = rng.randrange(14, 27)
            at = rng.randrange(len(whole) - n)
            texts[next(ids)] = noise(40) + whole[at : at + n] + noise(40)
    d = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    found = {(r["id"], r["home"]) for r in passages.find(d, Scratch(spark, "t")).collect()}
    assert sum((a, b) in found and (b, a) in found for a, b in pairs) >= least * len(pairs)
    assert found <= {x for a, b in pairs for x in ((a, b), (b, a))}


def test_passages_of_a_hot_seed(spark, monkeypatch):
    """Many documents have one passage, dealt out to parts; some words come over and over."""
    rng = random.Random(9)
    noise = lambda n: [f"n{rng.randrange(10**6)}" for _ in range(n)]
    shared = [f"s{i}" for i in range(60)]
    texts = [noise(rng.randrange(30)) + shared + noise(rng.randrange(30)) for _ in range(60)] + [["ra"] * 400 + noise(20), noise(9) + ["ra"] * 90, noise(80)]
    d = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    monkeypatch.setattr(passages, "HOT", 10)
    got = passages.find(d, Scratch(spark, "t")).collect()
    assert {r["id"] for r in got} == set(range(62))
    links = {frozenset((r["id"], r["home"])) for r in got}
    reach = {0}
    while more := {x for p in links if p & reach for x in p} - reach:
        reach |= more
    assert reach == set(range(60)) and frozenset((60, 61)) in links and len(links) < 4 * 60


def test_passages_within_passages_go():
    rows = [(1, 0, 200, 2, 0, 200, 190), (1, 10, 70, 2, 10, 70, 60), (1, 10, 70, 2, 150, 210, 60), (1, 10, 70, 3, 10, 70, 60), (1, 0, 200, 2, 0, 200, 190)]
    (got,) = passages._outermost(iter([passages._longs(rows, passages._PASSAGE)]))
    assert sorted(tuple(r.values()) for r in got.to_pylist()) == [rows[0], rows[2], rows[3]]


def test_fenwick_chains():
    tree = passages.Fenwick(5)
    for i, v in ((3, 2.0), (1, 5.0), (4, 9.0)):
        tree.put(i, v, i)
    assert tree.max_below(1) == (float("-inf"), -1) and tree.max_below(4) == (5.0, 1) and tree.max_below(5) == (9.0, 4)
    assert passages.chains([0, 5, 10, 11], [100, 105, 110, 3])[0] == [0, 1, 2]


def test_licenses(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND."
    texts = {0: (None, []), 1: ("", []), 2: ("plain text.", []), 3: ("Licensed under the Apache License, Version 2.0.", ["Apache-2.0"]), 4: ("x\n" + mit, ["MIT"]), 5: ("Released under the MIT License. Licensed under CC BY-NC 4.0.", ["MIT", "CC-BY-NC"]), 6: ("This work is licensed under the GNU General Public License, version 3.\nAll rights reserved.", ["GPL-3.0", "All-Rights-Reserved"]), 7: ("word " * 20000 + "\nReleased under the MIT License.", ["MIT"])}
    d = spark.createDataFrame([(i, t, "c") for i, (t, _) in texts.items()], "doc_id long, text string, all_ids string")
    assert {r["doc_id"]: r["licenses"] for r in licenses.scan(d).collect()} == {i: x for i, (_, x) in texts.items()}
    assert licenses.scan(spark.createDataFrame([(1, "Some licence of ours applies.")], "doc_id long, text string")).first()["n_unknown"] == 1


MIT = '''MIT License

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
'''
APACHE = '''# Copyright 2020 Some One
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.
import os
'''
GPL2 = '''/* This program is free software; you can redistribute it and/or
 * modify it under the terms of the GNU General Public License
 * as published by the Free Software Foundation; either version 2
 * of the License, or (at your option) any later version.
 *
 * This program is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
 */
'''
GPL3 = '''// This program is free software: you can redistribute it and/or modify
// it under the terms of the GNU General Public License as published by
// the Free Software Foundation, either version 3 of the License, or
// (at your option) any later version.
'''
LGPL = '''This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.
'''
MPL = '''/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */
'''
BSD3 = '''Copyright (c) 2019, Some One
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL DAMAGES.
'''


def test_licenses_as_published(spark):
    """Wrapped, commented and tagged; a licence text among other lines, and a wrapped phrase that is none."""
    texts = [
        (MIT, ["MIT"]),
        (APACHE, ["Apache-2.0"]),
        (GPL2, ["GPL-2.0-or-later"]),
        (GPL3, ["GPL-3.0-or-later"]),
        (LGPL, ["LGPL"]),
        (MPL, ["MPL-2.0"]),
        (BSD3, ["BSD-3-Clause", "All-Rights-Reserved"]),
        ("SPDX-License-Identifier: MIT", ["MIT"]),
        ("# SPDX-License-Identifier: GPL-2.0-only\nimport os", ["GPL-2.0-only"]),
        ("// SPDX-License-Identifier: (MIT OR Apache-2.0)\npackage x", ["MIT", "Apache-2.0"]),
        ("// SPDX-License-Identifier: Something-1.0\n", ["SPDX"]),
        ("int main() {}\n" + GPL2 + "\nint x;\n" + MPL, ["GPL-2.0-or-later", "MPL-2.0"]),
        ("This code is distributed under\nthe MIT license\nSee LICENSE for more", []),
        ("the license to drive\nwas permitted", []),
    ]
    d = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["licenses"] for r in licenses.scan(d.unionByName(d)).collect()}
    for i, (t, want) in enumerate(texts):
        assert set(got[i]) == set(want), (t, got[i])
    assert licenses.scan(d).count() == len(texts) and licenses.scan(d.where("false")).count() == 0


def test_license_scan_sql_agrees_on_published_texts(spark):
    import duckdb

    from newsloom.llm import oracles, queries

    rows = [(i, t) for i, t in enumerate([MIT, APACHE, GPL2, GPL3, LGPL, MPL, BSD3, "x " + MIT.replace("\n", "\r\n"), "# SPDX-License-Identifier: MIT OR (Apache-2.0 AND 0BSD)\n# more", None, ""])]
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, \"text\" varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    want = sorted(con.execute(oracles.oracle_sql()["op10_license_scan"]).fetchall(), key=lambda r: r[0])
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted((r["doc_id"], len(r["sentence_ids"]), r["n_unknown"], ",".join(r["sentence_ids"]), ",".join(r["licenses"])) for r in found.collect())
    assert got == want and queries.op10_license_scan


def test_empty_tables_of_quality_and_bpe(spark, docs):
    none = docs.where("false")
    assert quality.assess(none).count() == 0 and quality.clean(none).columns == none.columns and quality.clean(none).count() == 0
    assert bpe.encode(none, byte_bpe()).count() == 0 and bpe.digests(none, byte_bpe()).count() == 0 and bpe.tokenize(none, byte_bpe()).count() == 0


def test_awkward_tables_keep_every_row(spark, docs, rows):
    want = sorted((r[0] is None, r[0] or 0) for r in rows)
    licences = licenses.scan(docs).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in licences) == want and all(not r["licenses"] for r in licences)
    spans = pii.detect(docs, Scratch(spark, "t")).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in spans) == want
    masked = pii.mask(docs, Scratch(spark, "t"))
    assert sorted(masked.columns) == sorted(docs.columns) and masked.count() == len(rows)


def test_passages_on_awkward_tables(spark, docs):
    """Ties, repeated ids, null ids and texts of one word over and over beside two documents that share 60 words."""
    shared = " ".join(f"s{i}" for i in range(60))
    more = [(900 + i, f"a{i} b{i} " * 10 + shared + f" c{i}" * 10, "c", "c", "c", i) for i in (0, 1, 1)] + [(None, shared, "c", "c", "c", 0)]
    got = passages.find(docs.where("doc_id < 60 or doc_id is null").unionByName(spark.createDataFrame(more, SCHEMA)), Scratch(spark, "t")).collect()
    pairs = {(r["id"], r["home"]) for r in got}
    assert {(900, 901), (901, 900)} <= pairs and not any(a is None or b is None or a == b for a, b in pairs)
    assert all(r["end"] - r["start"] >= passages.MIN_WORDS for r in got)
