"""Registered queries of the corpus operators, with SQL where DuckDB can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimwell.llm import (
    byte_bpe,
    ego_join,
    jaccard_trie,
    language_id,
    licences,
    lz_fingerprint,
    packing,
    periodic_runs,
    pii_spans,
    sharding,
    suffix_dedup,
    token_alignment,
    weak_quality,
)
from claimwell.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def registered(query: Query) -> Query:
    REGISTERED[query.__name__] = query
    return query


@registered
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 8 shards of nearly equal bytes.

    The tree splits by language and length. The source is no dimension here: copies of a
    text come from several sources, and a cut between sources would part them.
    """
    placed = sharding.kd_shards(documents(spark, sf_dir), ["lang", "n_chars"], shards=8)
    return placed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


@registered
def op2_jaccard_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents that share most of their 5-word shingles."""
    return jaccard_trie.jaccard_components(documents(spark, sf_dir))


@registered
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 ids."""
    pieces = packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "padded_to"
    )


def held_out(docs: DataFrame) -> F.Column:
    return F.pmod(F.crc32(docs["doc_id"].cast("string")), F.lit(4)) == 2


@registered
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from the three folds that are not held out."""
    docs = documents(spark, sf_dir)
    model = language_id.fit(docs.where(~F.coalesce(held_out(docs), F.lit(False))))
    return language_id.predict(docs, model).select(
        "doc_id",
        F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
        "rejected",
    )


@registered
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document, and what they decode to, as digests."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = byte_bpe.bpe_encode(documents(spark, sf_dir), vocabulary, public_tokenizers.PATTERN, decoded=True)
    return encoded.select(
        "doc_id",
        F.size("ids").cast(T.LongType()).alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@registered
def op4_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Votes, posterior and score of every document, and whether it is kept."""
    docs = documents(spark, sf_dir)
    return weak_quality.classify(docs, weak_quality.fit(docs))


@registered
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 50-byte strings of smaller documents."""
    found = suffix_dedup.remove_repeats(documents(spark, sf_dir))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast(T.LongType()).alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@registered
def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every paragraph of every document that holds a licence notice, and its family."""
    docs = documents(spark, sf_dir)
    return licences.scan(docs, licences.fit(docs))


@registered
def op7_ego_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings with equal labels and a cosine of 0.98 or more."""
    return ego_join.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@registered
def op8_lz_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    found = lz_fingerprint.fingerprints(documents(spark, sf_dir))
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


@registered
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, in texts of which a tenth are given loops."""
    docs = documents(spark, sf_dir)
    found = periodic_runs.periodic_runs(docs, loop_seed=F.crc32(F.col("doc_id").cast("string")))
    longer = "r.length * m.period > m.length * r.period"  # the first of equals stays
    best = f"reduce(runs, cast(null as {dict(found.dtypes)['runs'][6:-1]}), (m, r) -> if(m is null or {longer}, r, m))"
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.withColumn("best", F.expr(best)).select(
        "doc_id",
        F.size("runs").cast(T.LongType()).alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@registered
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens by two tokenizers in groups that cover the same bytes."""
    return token_alignment.align(
        documents(spark, sf_dir),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
        groups=lambda g: F.when(g == "", g).otherwise(F.sha2(g, 256)),
    ).withColumnRenamed("groups", "groups_sha256")


@registered
def op13_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document: how many the patterns of each kind find, and all."""

    def written(spans):
        one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["end"]))
        return F.array_join(one, ",")

    found = pii_spans.personal_data(documents(spark, sf_dir)).withColumn("base", F.filter("spans", lambda s: s["base"]))
    counts = [F.expr(f"bigint(size(filter(base, s -> s.kind = '{k}')))").alias(f"n_{k}") for k in pii_spans.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(written("base"), 256).alias("base_sha256"), written("spans").alias("spans")
    )
