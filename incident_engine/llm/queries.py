"""Named queries over the given tables for the operators of this package, and SQL twins where SQL can state them."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from incident_engine import scratch
from incident_engine.llm import (
    ann,
    bpe,
    filter_audit,
    html_main,
    mixing,
    near_dup,
    periodic_runs,
    pii,
    quality,
    substring_dedup,
    suffix_dedup,
    toxicity,
    warc,
)

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def prepared(spark: SparkSession, df: DataFrame) -> DataFrame:
    """`df` in a session whose Python workers find this package, and which has a checkpoint folder.

    The folder is the one that the cluster names; only a session without one, as in tests, gets its own.
    """
    context = spark.sparkContext
    root = str(Path(__file__).resolve().parents[2])
    paths = context.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        context.environment["PYTHONPATH"] = os.pathsep.join(p for p in [root, *paths] if p)
    folder = scratch.shared_dir(spark)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark, spark.read.parquet(f"{sf_dir}/{name}.parquet"))


#: Key of the surrogates; a deployment passes its own secret.
PII_KEY = "surrogates-1"

#: Levels of the mixing tree in SQL that both engines read: sources in three domains, then language, then source.
MIX_DOMAIN = "CASE WHEN source IN ('src0', 'src1', 'src2', 'src3') THEN 'web' WHEN source IN ('src4', 'src5', 'src6', 'src7', 'src8', 'src9') THEN 'books' ELSE 'forums' END"
MIX_LEVELS = (("domain", MIX_DOMAIN), ("lang", "lang"), ("source", "source"))
MIX_WEIGHTS = ({"web": 5, "books": 3, "forums": 2}, {"en": 4, "de": 2, "fr": 2, "es": 2}, {"src0": 3})
MIX_BUDGET = (3, 4)
MIX_EPOCHS = 2
MIX_SEED = "mix-1"


def op1_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op6_counterfactual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text by a model of the labels outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5
    model = toxicity.fit(toxicity.sample(docs, table(spark, sf_dir, "labels"), fold != 0))
    scored = toxicity.score(docs, model, name="score")
    return scored.select("doc_id", (fold == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced by keyed surrogates."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace(docs, PII_KEY)


def op7_hierarchical_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and epochs of a mix of three quarters of all words, at most two epochs of any source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    levels = [(n, F.expr(e)) for n, e in MIX_LEVELS]
    mixed = mixing.mix(docs, levels, MIX_WEIGHTS, MIX_BUDGET, MIX_EPOCHS, MIX_SEED)
    return mixed.select("doc_id", "lang", "source", "epoch")


def op5_suffix_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes removed from every document, and the digest of the rest."""
    found = suffix_dedup.deduplicate(table(spark, sf_dir, "documents"))
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["length"])
    return found.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op9_de_bruijn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words removed from every document, and the digest of the rest."""
    found = substring_dedup.deduplicate(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of the shingle set and component of every document."""
    found = near_dup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)
    kept = F.coalesce(F.col("id") == F.col("component"), F.lit(True))
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), kept.alias("kept"))


def op10_tag_path_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_main.main_texts(table(spark, sf_dir, "pages"))


def op3_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules by zstandard ratio bands over every whole text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.quality_rules(docs).select("doc_id", "quality.*")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every whole text and of the bytes decoded from them."""
    docs = table(spark, sf_dir, "documents")
    return bpe.digests(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


def op11_decision_diagrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps of five filters in all their orders, per language."""
    part = F.coalesce("lang", F.lit(""))
    masks = filter_audit.failure_masks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), part)
    return filter_audit.audit(masks, outcomes=("good", "toxic"))


def op12_monolithic_gzip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of the normalised archives of all pages."""
    found = warc.archive(table(spark, sf_dir, "pages"), scratch.scratch_path(spark, "warc"))
    records = warc.read_archives(spark, found.normalised)

    def page(column: str) -> Column:
        return F.regexp_extract(column, f"^<{warc.ID_PREFIX}(-?[0-9]+)>$", 1).try_cast("long")

    return records.select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), page("refers_to").alias("refers_to")
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, where every tenth text by hash of its id repeats one stretch of its words to its end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n = F.size(words)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    repeated = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), times)), F.lit(1), n - a)
    planted = F.array_join(F.concat(F.slice(words, F.lit(1), a), repeated), " ")
    return docs.select("doc_id", F.when((h % 10 == 0) & (n > 0), planted).otherwise(F.col("text")).alias("text"))


def op13_scale_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, the strongest of them, and the digest of what is left."""
    found = periodic_runs.collapse_runs(with_planted_runs(table(spark, sf_dir, "documents")), as_digest=True)

    def stronger(x: Column, y: Column) -> Column:
        ahead, behind = x["length"] * y["period"], y["length"] * x["period"]
        order = F.when(ahead > behind, -1).when(ahead < behind, 1)
        for key in ("start", "period"):
            order = order.when(x[key] < y[key], -1).when(x[key] > y[key], 1)
        return order.otherwise(0)

    best = F.get(F.array_sort("runs", stronger), F.lit(0))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.col("collapsed").alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_nn_descent": op1_nn_descent,
    "op6_counterfactual": op6_counterfactual,
    "op2_surrogates": op2_surrogates,
    "op7_hierarchical_mix": op7_hierarchical_mix,
    "op5_suffix_blocks": op5_suffix_blocks,
    "op9_de_bruijn": op9_de_bruijn,
    "op8_setsketch": op8_setsketch,
    "op10_tag_path_ratios": op10_tag_path_ratios,
    "op3_compression_bands": op3_compression_bands,
    "op4_byte_bpe": op4_byte_bpe,
    "op11_decision_diagrams": op11_decision_diagrams,
    "op12_monolithic_gzip": op12_monolithic_gzip,
    "op13_scale_tiles": op13_scale_tiles,
}


def statements() -> dict[str, str]:
    levels = [e for _, e in MIX_LEVELS]
    mix = mixing.statement(levels, MIX_WEIGHTS, MIX_BUDGET, MIX_EPOCHS, MIX_SEED, "doc_id, lang, source")
    return {
        "op7_hierarchical_mix": mix,
        "op11_decision_diagrams": filter_audit.statement(),
        "op12_monolithic_gzip": warc.statement(),
    }
