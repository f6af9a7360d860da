"""External models behind one interface, offline by default.

A provider is a picklable object; calls happen in ``mapInPandas``, after everything that can filter rows has done so, and
their results should be written once (a lost executor then repeats only its own calls).
"""

from __future__ import annotations

import hashlib
import json
import time
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from ..sources import readers
from .select import numbered

#: Texts in one embedding request, tries, and base of the waits between them (fixed values).
EMBED_BATCH, EMBED_TRIES, EMBED_WAIT = 10, 5, 2.0
#: Tries and wait of naming calls; rows in a batch of them, and the pause after it (fixed values).
CHAT_TRIES, CHAT_WAIT, CHAT_BATCH, CHAT_PAUSE = 3, 1.2, 10, 5.0
#: Relevance of entities by where they come from (fixed values).
RELEVANCE = {"exact": 0.9, "mapped": 0.8, "person": 0.5, "model_person": 0.4}


class Embedder(Protocol):
    name: str
    dim: int

    def embed(self, texts: list[str]) -> list[list[float]]: ...


class Chat(Protocol):
    def ask(self, prompt: str) -> str: ...


class HashEmbedder:
    """Offline embeddings: signed hashes of character trigrams, of unit length; equal texts get equal vectors anywhere."""

    def __init__(self, dim: int = 64):
        self.name, self.dim = f"hash-{dim}", dim

    def embed(self, texts: list[str]) -> list[list[float]]:
        out = []
        for s in texts:
            v = np.zeros(self.dim)
            padded = f"  {s}  "
            for gram, n in Counter(padded[i : i + 3] for i in range(len(padded) - 2)).items():
                h = int.from_bytes(hashlib.blake2b(gram.encode(), digest_size=8).digest(), "little")
                v[h % self.dim] += n if h >> 63 else -n
            out.append((v / (np.linalg.norm(v) + 1e-12)).tolist())
        return out


class StubChat:
    """Offline answers: the first words of the prompt's last line as a name."""

    def ask(self, prompt: str) -> str:
        return json.dumps({"name": prompt.strip().rsplit("\n", 1)[-1].lstrip("- ")[:20], "confidence": 0.5, "why": "offline"}, ensure_ascii=False)


class ScriptedChat:
    """Offline answers from a script: that of the first part found in the prompt, or the default; the first calls may fail."""

    def __init__(self, script: dict[str, str], default: str = "{}", failures: int = 0):
        self.script, self.default, self.failures, self.calls = script, default, failures, Counter()

    def ask(self, prompt: str) -> str:
        self.calls[prompt] += 1
        if self.calls[prompt] <= self.failures:
            raise OSError("no answer")
        return next((answer for part, answer in self.script.items() if part in prompt), self.default)


def from_settings(told: dict[str, str | None]) -> Chat:
    """The chat endpoint of the settings, or the offline one."""
    return HttpChat(told["chat_url"], told.get("chat_key") or "") if told.get("chat_url") else StubChat()


class HttpChat:
    """A chat endpoint: errors come back as {"error": ...} unless they are to be raised."""

    def __init__(self, url: str, key: str, timeout: float = 60, raises: bool = False):
        self.url, self.key, self.timeout, self.raises = url, key, timeout, raises

    def ask(self, prompt: str) -> str:
        import urllib.request

        request = urllib.request.Request(self.url, json.dumps({"query": prompt}).encode(), {"Authorization": f"Bearer {self.key}", "Content-Type": "application/json"})
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as r:
                return r.read().decode()
        except OSError as e:
            if self.raises:
                raise
            return json.dumps({"error": str(e)})


def retried(call: Callable, tries: int, waits: Callable[[int], float], sleep: Callable[[float], None] = time.sleep):
    """The call's result, after up to so many tries; the last error is raised."""
    for i in range(tries):
        try:
            return call()
        except Exception:
            if i == tries - 1:
                raise
            sleep(waits(i))
    return None


def embed(df: DataFrame, text: str, provider: Embedder, batch: int = EMBED_BATCH) -> DataFrame:
    """Adds embedding_model, embedding_dim and embedding; rows with blank text go, and all blank raises ValueError."""
    rows = df.withColumn(text, t.non_empty(text)).where(F.col(text).isNotNull())
    if rows.isEmpty() and not df.isEmpty():
        raise ValueError("all texts are blank")
    names, dim = df.columns, provider.dim

    def run(frames: Iterator[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for f in frames:
            vectors: list = []
            texts = f[text].tolist()
            for i in range(0, len(texts), batch):
                part = texts[i : i + batch]
                vectors += retried(lambda part=part: provider.embed(part), EMBED_TRIES, lambda k: EMBED_WAIT * (k + 1))
            yield f.assign(embedding_model=provider.name, embedding_dim=dim, embedding=vectors)[[*names, "embedding_model", "embedding_dim", "embedding"]]

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInPandas(run, f"{fields}, embedding_model string, embedding_dim int, embedding array<float>")


def ask(df: DataFrame, prompt: str, chat: Chat, out: str = "answer", tries: int = CHAT_TRIES) -> DataFrame:
    """Adds the answer to each row's prompt; null where the prompt is null or all tries failed."""
    names = df.columns

    def run(frames: Iterator[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for f in frames:
            answers = []
            for p in f[prompt]:
                try:
                    answers.append(None if p is None else retried(lambda p=p: chat.ask(p), tries, lambda k: CHAT_WAIT * 2**k))
                except Exception:  # noqa: BLE001  a failed call is a null answer, and isn't cached
                    answers.append(None)
            yield f.assign(**{out: answers})[[*names, out]]

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInPandas(run, f"{fields}, `{out}` string")


_NAME = "name string, confidence double, why string"


def _keyed(topics: DataFrame, version: str) -> DataFrame:
    return topics.withColumn("key", t.cache_key(version, keywords=F.coalesce("keywords", F.lit("")), summaries=F.col("summaries")))


def _pending(keyed: DataFrame, cache: DataFrame) -> DataFrame:
    """key, prompt of what the cache doesn't know, once each."""
    blank = (F.coalesce("keywords", F.lit("")) == "") & (F.size("summaries") <= 0)
    misses = keyed.where(~blank).join(cache.select("key"), "key", "left_anti").dropDuplicates(["key"])
    return misses.select("key", t.naming_prompt(F.col("keywords"), F.col("summaries")).alias("prompt"))


def _answered(pending: DataFrame, chat: Chat) -> DataFrame:
    """New rows of the cache; answers that can't be read give none."""
    parsed = ask(pending, "prompt", chat).select("key", F.from_json(t.repair_json(t.answer_text("answer"), objects_only=True), _NAME).alias("a"))
    return parsed.where("a.name is not null").select("key", "a.*")


def _named(keyed: DataFrame, names: list[str], known: DataFrame) -> DataFrame:
    return keyed.join(known.select("key", "name", "confidence", "why"), "key", "left").select(*names, F.coalesce("name", F.lit("")).alias("main_event_name"), F.col("confidence").alias("main_event_confidence"), F.coalesce("why", F.lit("")).alias("main_event_why"))


def name_topics(topics: DataFrame, chat: Chat, cache: DataFrame, scratch, version: str = "1") -> tuple[DataFrame, DataFrame]:
    """Topics with main_event_name, confidence and why, and the new rows of the cache, which are written, so asked for once.

    topics: topic_id, keywords (text), summaries (array); cache: key, name, confidence, why.  What the cache knows isn't asked
    again; answers that can't be read aren't put into it.  Rows without keywords and summaries keep empty names.
    """
    keyed = _keyed(topics, version)
    new = scratch.keep(_answered(_pending(keyed, cache), chat), "answers")
    return _named(keyed, topics.columns, cache.select("key", "name", "confidence", "why").unionByName(new)), new


def name_in_batches(topics: DataFrame, chat: Chat, cache_path: str, scratch, *, version: str = "1", tasks: int = 1, pause: float = CHAT_PAUSE, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """As name_topics, in rounds of CHAT_BATCH rows a task, with a pause between them; each round's answers are added to the
    cache at cache_path before the next one starts, so that a run that was stopped goes on where it was."""
    spark = topics.sparkSession
    schema = f"key string, {_NAME}"
    known = lambda: spark.read.schema(schema).parquet(cache_path) if readers.exists(spark, cache_path) else spark.createDataFrame([], schema)
    keyed = _keyed(topics, version)
    pending = scratch.keep(numbered(_pending(keyed, known()), ["key"], "n", scratch), "pending")
    total, size = pending.count(), CHAT_BATCH * tasks
    for start in range(0, total, size):
        part = pending.where((F.col("n") > start) & (F.col("n") <= start + size)).drop("n").repartition(tasks)
        _answered(part, chat).write.mode("append").parquet(cache_path)
        if start + size < total:
            sleep(pause)
    return _named(keyed, topics.columns, known())


def extract(news: DataFrame, chat: Chat, link: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Two-stage extraction: surfaces first; only news with linked entities are asked about their events.

    news: NewsID, title, content, news_time; link: takes NewsID and the first answer, gives NewsID and entities (an array).
    """
    first = ask(news.withColumn("prompt", t.extraction_prompt(F.col("title"), F.col("content"))), "prompt", chat, "surfaces").drop("prompt")
    linked = link(first.select("NewsID", "surfaces")).where(F.size("entities") > 0)
    second = news.join(linked, "NewsID").withColumn("prompt", t.analysis_prompt(F.col("content"), F.col("news_time"), F.to_json("entities")))
    return ask(second, "prompt", chat, "analysis").drop("prompt")


def surface_entities(texts: DataFrame, body: str, chat: Chat) -> DataFrame:
    """Adds companies and persons named by the model; empty lists where the answer can't be read."""
    a = ask(texts.withColumn("__p", t.surface_prompt(F.col(body))), "__p", chat, "__a").drop("__p")
    j = F.from_json(t.repair_json("__a"), "companies array<string>, persons array<string>")
    empty = F.array().cast("array<string>")
    return a.withColumn("companies", F.coalesce(j["companies"], empty)).withColumn("persons", F.coalesce(j["persons"], empty)).drop("__a")


def entity_record(text, exact, mapped, persons, model_persons):
    """Companies and persons as one struct, with relevance and mentions; names once, the first source wins.

    exact: array of full names; mapped: array<struct<surface,full_name,score>>; persons: array<struct<name,title,evidence>>;
    model_persons: array of names, of which ten are looked at and those of two characters or more count.
    """
    one = F.transform(exact, lambda n: F.struct(n.alias("name"), F.lit(RELEVANCE["exact"]).alias("relevance"), t.occurrences(text, n).alias("mentions"), n.alias("evidence")))
    two = F.transform(F.filter(mapped, lambda m: ~F.array_contains(exact, m["full_name"])), lambda m: F.struct(m["full_name"].alias("name"), m["score"].cast("double").alias("relevance"), t.occurrences(text, m["surface"]).alias("mentions"), m["surface"].alias("evidence")))
    p1 = F.transform(persons, lambda p: F.struct(p["name"].alias("name"), p["title"].alias("title"), F.lit(RELEVANCE["person"]).alias("relevance")))
    p2 = F.transform(F.filter(F.slice(model_persons, 1, 10), lambda n: F.length(n) >= 2), lambda n: F.struct(n.alias("name"), F.lit(None).cast("string").alias("title"), F.lit(RELEVANCE["model_person"]).alias("relevance")))
    return F.struct(F.concat(one, two).alias("companies"), F.array_distinct(F.concat(p1, p2)).alias("persons"))
