"""The registered queries of this subpackage: thin views of the operators' results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from revlens.llm import (
    byte_pairs, contamination, filter_audit, jaccard, licenses, mixing, pii, quality, quality_rules,
    ranking, repeats, secrets, toxicity,
)
from revlens.llm.text import documents, table

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTERED[function.__name__] = function
    return function


@query
def op1_mixing(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies", "rate")


@query
def op2_secret_ledger(spark: SparkSession, sf: str) -> DataFrame:
    history = documents(spark, sf).select("doc_id", "text")
    # Two rule versions one after the other: the second scan does only what the ledger lacks.
    _, ledger = secrets.scan(history, rules=secrets.BASE)
    found, _ = secrets.scan(history, ledger, rules=secrets.RULES)
    base = F.filter("findings", lambda s: s["kind"].isin([r.kind for r in secrets.BASE]))

    def count(kind: str):
        return F.size(F.filter("findings", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[count(r.kind).alias(f"n_{r.kind}") for r in secrets.BASE],
        F.sha2(secrets.spans_text(base).cast("binary"), 256).alias("base_sha256"),
        secrets.spans_text(F.col("findings")).alias("spans"),
    )


@query
def op4_license_templates(spark: SparkSession, sf: str) -> DataFrame:
    found = licenses.scan(documents(spark, sf))
    return found.withColumns(
        {c: F.concat_ws(",", c) for c in ("base_labels", "labels")}
    )


@query
def op5_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = contamination.scan(documents(spark, sf), table(spark, sf, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op3_pii_boosting(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    found = pii.find(docs, pii.fit(docs))
    base = F.filter("spans", lambda s: s["kind"].isin(list(pii.BASE_KINDS)))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in pii.BASE_KINDS],
        F.sha2(secrets.spans_text(base).cast("binary"), 256).alias("base_sha256"),
        secrets.spans_text(F.col("spans")).alias("spans"),
    )


@query
def op6_quality_additive(spark: SparkSession, sf: str) -> DataFrame:
    return quality.score(documents(spark, sf), table(spark, sf, "labels"))


@query
def op8_toxicity_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    found = toxicity.score(documents(spark, sf), table(spark, sf, "labels"))
    said = F.transform(
        "evidence", lambda e: F.concat_ws(":", e["example"], F.round(e["similarity"], 4), e["label"])
    )
    return found.withColumn("evidence", F.concat_ws(",", said))


@query
def op9_decision_list(spark: SparkSession, sf: str) -> DataFrame:
    judged = quality_rules.judge(documents(spark, sf), table(spark, sf, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


@query
def op7_jaccard_orders(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.join(documents(spark, sf)).select("doc_id", "n_shingles", "component_id")


@query
def op10_sparse_suffixes(spark: SparkSession, sf: str) -> DataFrame:
    found = repeats.find(documents(spark, sf))
    said = F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["stop"]))
    return found.select("doc_id", "n_words", "n_repeated", F.concat_ws(",", said).alias("spans"))


@query
def op11_ranked_search(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.search(documents(spark, sf), table(spark, sf, "benchmark"))


@query
def op12_byte_pairs(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    codec = byte_pairs.Codec(spark, vocabulary, public_tokenizers.PATTERN)
    tokens = byte_pairs.encoded(documents(spark, sf), codec, decoded=True)
    said = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return tokens.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(said.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op13_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    failed = filter_audit.failures(documents(spark, sf), carried=("lang",))
    return filter_audit.audit(filter_audit.marked(failed, table(spark, sf, "labels")), "lang")
