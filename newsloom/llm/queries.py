"""The registered queries of the training-data operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, jaccard, licenses, lm, passages, pii, quality, token_counts, warc
from .common import Scratch, table, tune

#: Where the public vocabulary files are unless the installed package tells.
TOKENIZERS = "/opt/tokenizers"


def vocabulary_path(name: str) -> str:
    try:
        import public_tokenizers
    except ImportError:
        return f"{TOKENIZERS}/{name}"
    return public_tokenizers.path(name)


_bpe: dict[str, bpe.Bpe] = {}


def byte_bpe() -> bpe.Bpe:
    path = vocabulary_path("byte_bpe_50k.json")
    if path not in _bpe:
        _bpe[path] = bpe.Bpe(bpe.read_vocabulary(path))
    return _bpe[path]


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), byte_bpe().bytes)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return lm.score(table(spark, sf_dir, "documents"), byte_bpe(), Scratch(spark, "op3"))


def _of_kind(kind: str):
    return lambda s: s["kind"] == kind


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(table(spark, sf_dir, "documents"), Scratch(spark, "op4"))
    base = F.filter("spans", lambda s: s["base"])
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id",
        *(F.size(F.filter(base, _of_kind(k))).cast("long").alias(f"n_{k}") for k in ("email", "ip", "card", "phone")),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return jaccard.classes(table(spark, sf_dir, "documents"), Scratch(spark, "op5"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    found = quality.assess(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return bpe.digests(table(spark, sf_dir, "documents"), byte_bpe())


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    scratch = Scratch(spark, "op8")
    path = scratch.path("archives")
    warc.write(table(spark, sf_dir, "pages"), path)
    found = warc.index(warc.read(spark, path), scratch)
    return found.select(F.col("id").alias("page_id"), F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to")


def op9_fuzzy_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    found = passages.find(table(spark, sf_dir, "documents"), Scratch(spark, "op9"))
    return found.select(F.col("id").alias("doc_id"), F.col("start").alias("start_word"), F.col("end").alias("end_word"), F.col("home").alias("other_doc_id"), F.col("home_start").alias("other_start_word"), F.col("home_end").alias("other_end_word"), F.col("matched").alias("n_matched"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.size("sentence_ids").cast("long").alias("n_sentences"), "n_unknown", F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licenses", ",").alias("licenses"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_counts": op1_token_counts,
        "op2_decontamination": op2_decontamination,
        "op3_lm_scoring": op3_lm_scoring,
        "op4_pii": op4_pii,
        "op5_jaccard_join": op5_jaccard_join,
        "op6_quality_rules": op6_quality_rules,
        "op7_bpe": op7_bpe,
        "op8_warc": op8_warc,
        "op9_fuzzy_passages": op9_fuzzy_passages,
        "op10_license_scan": op10_license_scan,
    }
