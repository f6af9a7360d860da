"""Token counts by a linear longest-match automaton.

The vocabulary is a byte trie.  Every node has a failure link and the number of tokens that following the link pops, both
worked out when the trie is built, so that a word is walked once, byte by byte, without building its pieces and without
going back: the time is linear in the word's length.  Greedy longest-match counts come out exactly.

A word is a run without ASCII white space; it is matched with one space in front, as the vocabulary's word-initial
tokens have it.  A word that the vocabulary can't cover counts as one unknown token.

Defined results: null and empty texts have no words and no tokens; repeated rows give a row each; the vocabulary must
not be empty (ValueError).
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_batch, raw_texts

#: Words whose counts a Python worker remembers at a time.
CACHE_WORDS = 500_000


class LongestMatch:
    def __init__(self, tokens: list[bytes]):
        if not any(tokens):
            raise ValueError("empty vocabulary")
        goes: dict[int, int] = {}  # node << 8 | byte -> node
        ends, parent, byte, order = [False], [0], [0], [0]
        for t in filter(None, tokens):
            node = 0
            for c in t:
                if (nxt := goes.get(node << 8 | c)) is None:
                    nxt = goes[node << 8 | c] = len(ends)
                    ends.append(False)
                    parent.append(node)
                    byte.append(c)
                    order.append(order[node] + 1)
                node = nxt
            ends[node] = True
        fail, pops = [-1] * len(ends), [0] * len(ends)
        for v in sorted(range(1, len(ends)), key=order.__getitem__):
            if ends[v]:
                fail[v], pops[v] = 0, 1
                continue
            z, n = fail[parent[v]], pops[parent[v]]
            while z >= 0 and (z << 8 | byte[v]) not in goes:
                z, n = fail[z], n + pops[z]
            if z >= 0:
                fail[v], pops[v] = goes[z << 8 | byte[v]], n
        self.goes, self.fail, self.pops = goes, fail, pops

    def count(self, word: bytes) -> int:
        """Tokens of the greedy longest match, or -1 if it gets stuck."""
        goes, fail, pops, node, n = self.goes.get, self.fail, self.pops, 0, 0
        for c in word:
            while (nxt := goes(node << 8 | c)) is None:
                n += pops[node]
                node = fail[node]
                if node < 0:
                    return -1
            node = nxt
        while node:
            n += pops[node]
            node = fail[node]
        return n if node == 0 else -1


_cache: dict = {"of": None, "counts": {}}


def count_tokens(docs: DataFrame, tokens: list[bytes], *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: id, n_words, n_tokens, n_unknown (words counted as one unknown token)."""
    kind = docs.schema[id_col].dataType.simpleString()
    automaton = docs.sparkSession.sparkContext.broadcast(LongestMatch(tokens))

    def step(b: pa.RecordBatch) -> pa.RecordBatch:
        if _cache["of"] is not automaton.value:
            _cache.update(of=automaton.value, counts={})
        counts, count = _cache["counts"], automaton.value.count
        n_words, n_tokens, n_unknown = [], [], []
        for raw in raw_texts(b, "text"):
            doc = raw.split()
            for w in set(doc).difference(counts):
                counts[w] = count(b" " + w)
            got = list(map(counts.__getitem__, doc))
            unknown = got.count(-1)
            n_words.append(len(doc))
            n_tokens.append(sum(got) + 2 * unknown)
            n_unknown.append(unknown)
            if len(counts) > CACHE_WORDS:
                counts.clear()
        return pa.RecordBatch.from_arrays([b.column("id"), *(pa.array(x, pa.int64()) for x in (n_words, n_tokens, n_unknown))], names=["id", "n_words", "n_tokens", "n_unknown"])

    df = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return per_batch(df, step, f"id {kind}, n_words long, n_tokens long, n_unknown long").withColumnRenamed("id", id_col)
