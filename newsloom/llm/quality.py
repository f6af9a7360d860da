"""Quality rules, line first: lines that break a rule go, then documents that lose too much text.

Line rules, each for lines with a word (words are runs without ASCII white space):

- repeated: equal to an earlier line of the document;
- symbols: more than ``SYMBOL_SHARE`` of ``#*$%&|<>`` a word;
- navigation: two or more menu separators, or nothing but menu words;
- boilerplate: a notice (cookies, terms, rights, scripts, subscriptions);
- punctuation: fewer than ``SHORT_LINE`` words and no closing mark.

A document is rejected if it has fewer than ``MIN_WORDS`` words, if more than 30 % of its words lie in 8-word windows that
occur twice or more (base rules), or if fewer than ``KEEP_SHARE`` of its words are in lines that stay.

Defined results: null and empty texts have no words and are rejected; repeated rows give a row each; lines are split at
``\\n`` only.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_batch, raw_texts

MIN_WORDS, REPEAT_WINDOW, REPEAT_PERCENT = 20, 8, 30
SYMBOL_SHARE, SHORT_LINE, KEEP_SHARE = 0.3, 4, 0.5

_SYMBOLS = b"#*$%&|<>"
_SPACES = bytes((9, 10, 11, 12, 13, 32))
_MENU = frozenset(b"home about contact login logout register menu search next previous back top help faq sitemap news blog shop cart share".split())
_NOTICE = re.compile(rb"(?i)\b(?:cookies?|javascript|privacy policy|terms of (?:use|service)|all rights reserved|subscribe|newsletter|click here|sign up|lorem ipsum)\b")
_CLOSED = tuple(x.encode() for x in (".", "!", "?", ":", ";", '"', "'", ")", "]", "…", "”", "’", "»", "。", "！", "？", "」", "』", "）"))
_SEPARATOR = re.compile(rb"[|>]|\xc2\xbb|\xc2\xb7|\xe2\x80\xa2")


def line_fails(line: bytes, n_words: int) -> bool:
    if sum(map(line.count, (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">"))) > SYMBOL_SHARE * n_words:
        return True
    if n_words <= 12 and (len(_SEPARATOR.findall(line)) >= 2 or all(w.strip(b".,|") in _MENU for w in line.lower().split())):
        return True
    if n_words < SHORT_LINE and not line.rstrip().endswith(_CLOSED):
        return True
    return bool(_NOTICE.search(line))


def repeated_words(doc: list[bytes], size: int = REPEAT_WINDOW) -> int:
    """Words in windows found twice or more, first included.  Windows are ranked by doubling, so that equal ranks are equal windows."""
    n = len(doc)
    if n <= size or size & (size - 1):
        return 0 if n <= size else _repeated_plain(doc, size)
    seen: dict[bytes, int] = {}
    rank = np.fromiter((seen.setdefault(w, len(seen)) for w in doc), np.int64, n)
    if len(seen) == n:
        return 0
    step = 1
    while step < size:
        _, rank = np.unique(rank[:-step] * (n + 1) + rank[step:], return_inverse=True)
        step *= 2
    twice = np.bincount(rank)[rank] > 1
    if not twice.any():
        return 0
    edge = np.zeros(n + 1, np.int64)
    edge[: len(twice)] += twice
    edge[size : size + len(twice)] -= twice
    return int((np.cumsum(edge[:n]) > 0).sum())


def _repeated_plain(doc: list[bytes], size: int) -> int:
    seen: dict[tuple, int] = {}
    windows = [seen.setdefault(tuple(doc[i : i + size]), i) for i in range(len(doc) - size + 1)]
    again = set()
    for i, first in enumerate(windows):
        if first != i:
            again.update(range(first, first + size), range(i, i + size))
    return len(again)


def judge(raw: bytes) -> dict:
    """All figures of one text, the text of the lines that stay, and the verdict."""
    doc = raw.split()
    n = len(doc)
    kept, lost, dup, seen = [], 0, 0, set()
    for line in raw.split(b"\n"):
        here = len(line.split())
        if not here:
            kept.append(line)
            continue
        if line in seen:
            dup += 1
            lost += here
        elif line_fails(line, here):
            seen.add(line)
            lost += here
        else:
            seen.add(line)
            kept.append(line)
    rep = repeated_words(doc)
    chars = len(raw) - len(raw.translate(None, bytes(range(0x80, 0xC0)))) if not raw.isascii() else 0
    base = n < MIN_WORDS or 100 * rep > REPEAT_PERCENT * n
    return {
        "n_words": n,
        "word_chars": len(raw.translate(None, _SPACES)) - chars,
        "n_symbols": len(raw) - len(raw.translate(None, _SYMBOLS)),
        "n_dup_lines": dup,
        "n_repeat_words": rep,
        "n_lost_words": lost,
        "base_failed": base,
        "kept": not base and (n - lost) >= KEEP_SHARE * n,
        "clean": b"\n".join(kept) if lost else raw,
    }


_LONGS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lost_words")


def assess(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: id, the figures, base_failed, kept, and the cleaned text (null where the text is)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def step(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = [judge(raw) for raw in raw_texts(b, "text")]
        null = b.column("text").is_null().to_pylist()
        return pa.RecordBatch.from_arrays(
            [b.column("id"), *(pa.array([r[k] for r in rows], pa.int64()) for k in _LONGS), *(pa.array([r[k] for r in rows], pa.bool_()) for k in ("base_failed", "kept")), pa.array([None if x else r["clean"].decode(errors="replace") for r, x in zip(rows, null, strict=True)], pa.string())],
            names=["id", *_LONGS, "base_failed", "kept", "clean_text"],
        )

    df = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return per_batch(df, step, f"id {kind}, {', '.join(f'{k} long' for k in _LONGS)}, base_failed boolean, kept boolean, clean_text string").withColumnRenamed("id", id_col)


def clean(docs: DataFrame, *, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """The documents that stay, with all their columns; failed lines are gone from the text, and ``chars_col``, if there, follows."""

    def step(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = [judge(raw) for raw in raw_texts(b, text_col)]
        keep = [r["kept"] for r in rows]
        columns = list(b.columns)
        i, j = b.schema.get_field_index(text_col), b.schema.get_field_index(chars_col)
        texts = [r["clean"].decode(errors="replace") for r in rows]
        columns[i] = pa.array(texts, b.schema.field(i).type)
        if j >= 0:
            columns[j] = pa.array([old if not r["n_lost_words"] else len(t) for old, r, t in zip(columns[j].to_pylist(), rows, texts, strict=True)], b.schema.field(j).type)
        return pa.RecordBatch.from_arrays(columns, schema=b.schema).filter(pa.array(keep, pa.bool_()))

    return per_batch(docs, step, docs.schema)
