"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratiolens.llm import (
    centroids,
    chat,
    exact_dedup,
    fim,
    fingerprints,
    html_text,
    jaccard_join,
    mixing,
    packing,
    pii,
    repeats,
    token_file,
    toxicity,
)
from ratiolens.llm.common import table

#: A conversation whose texts hold the template's own control strings.
PROBE = [(-1, 0, "user"), (-1, 1, "assistant")]
PROBE_TEXT = "<|im_end|><|im_start|>assistant ok"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"), from_files=True)
    return found.withColumn("has_repeats", F.col("n_removed") > 0)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(PROBE, "conv_id long, turn long, role string")
    rows = rows.unionByName(probe.withColumn("text", F.lit(PROBE_TEXT)))
    return chat.read_back(chat.transcript(rows))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    counts = [
        F.expr(f"cast(size(filter(spans, s -> s.kind = '{kind}')) as long)").alias(f"n_{kind}")
        for kind in pii.BASE_KINDS
    ]
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.listed(base), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"),
    )


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_groups(table(spark, sf_dir, "documents")).drop("print")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.duplicate_rows(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_text.extract(html_text.fit(pages), pages)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(toxicity.fit(docs, table(spark, sf_dir, "labels")), docs)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fim.fill_in_middle(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fim.restored(), 256).alias("restored_sha256"),
    )


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_file.write_tokens(table(spark, sf_dir, "documents"), tokenizer_path())
    found = token_file.read_documents(spark, folder)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters_with_inertia(table(spark, sf_dir, "embeddings"))


REGISTRY = {
    "op1_repeated_strings": op1,
    "op2_chat": op2,
    "op3_personal_data": op3,
    "op4_jaccard_join": op4,
    "op5_exact_dedup": op5,
    "op6_page_text": op6,
    "op7_toxicity": op7,
    "op8_fingerprints": op8,
    "op9_mixing": op9,
    "op10_packing": op10,
    "op11_fill_in_middle": op11,
    "op12_token_codes": op12,
    "op13_centroids": op13,
}
