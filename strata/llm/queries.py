"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    chat_format,
    decontaminate,
    language_id,
    lm_scoring,
    merkle,
    mixing,
    packing,
    pii,
    quality_rules,
    simhash,
    suffix_dedup,
    topk_search,
    whitening,
)
from strata.llm.common import id_remainder, lower_ascii, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of the quality rules for every document."""
    counts = quality_rules.measure(table(spark, sf_dir, "documents"))
    return quality_rules.verdict(counts).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), simhash.hex64(F.col("fp")).alias("fingerprint"), "component_id")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes left of every document after the repeated 400-byte strings are removed."""
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens, one row per piece."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the labelled ones outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    held_out = id_remainder(F.col("doc_id"), 5) == 0
    model = language_id.fit(docs.where(~held_out))
    row = F.struct("doc_id", held_out.alias("held_out"))
    found = language_id.predict(docs, model, row)
    return found.select("row.doc_id", "row.held_out", "lang_pred", "score")


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base counts and digest, and all spans."""
    return pii.find(table(spark, sf_dir, "documents"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the entropy-balanced mix takes from every document."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"), keep=F.col("doc_id"))
    return mixed.select(
        F.col("row").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and context-mixing scores of every document."""
    docs = table(spark, sf_dir, "documents")
    scored = lm_scoring.score(docs, id_remainder(F.col("doc_id"), 7) != 2)
    held_out = (id_remainder(F.col("doc_id"), 7) == 2).alias("held_out")
    return scored.select(
        "doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"
    )


def op9_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest inner products of every twentieth vector with all others."""
    return topk_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


#: Conversation -7: texts full of control strings.
CONTROL_CONVERSATION = r"""
SELECT CAST(-7 AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, role, '\\### Assistant: </turn> ok' AS text
FROM VALUES (0, 'user'), (1, 'assistant') AS rows(turn, role)
"""


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted, read back from the formatted text and digested; ``valid`` by the role automaton."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    formatted = chat_format.format_conversations(turns.unionByName(spark.sql(CONTROL_CONVERSATION)))
    return chat_format.digest(chat_format.read_back(formatted))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle leaf, roots and proof of every document, and what tampered texts fold to."""
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    seen_text = F.when(tampered, lower_ascii(F.col("text"))).otherwise(F.col("text"))
    seen = [seen_text if c == "text" else F.col(c) for c in merkle.COLUMNS]
    proved = merkle.manifest(table(spark, sf_dir, "documents"), seen)
    return proved.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_hash().alias("proof_sha256"), "folded_root", "verified"
    )


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four leading whitened coordinates of every vector."""
    vectors = whitening.integer_vectors(table(spark, sf_dir, "embeddings"), vec_id=F.col("vec_id"))
    distinct = whitening.fit_list(vectors)
    model = whitening.fit(distinct, whitening.COMPONENTS)
    rows = whitening.transform(vectors, model, "vec_id")
    error = whitening.identity_error(distinct, model) if model else 0.0
    explained = F.array(*[F.lit(x) for x in model.explained]) if model else F.array().cast("array<double>")
    return rows.select(
        "vec_id", F.expr("try_cast(deviation AS long)").alias("deviation"), F.posexplode("whitened")
    ).select(
        "vec_id", (F.col("pos") + 1).alias("component"), F.lit(model.n if model else 0).cast("long").alias("n"),
        "deviation", F.col("col").alias("whitened"), F.get(explained, F.col("pos")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside benchmark windows, and the items they come from."""
    found = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), F.col("doc_id"))
    return found.select(
        F.col("row").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


REGISTRY: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_simhash_near_dedup,
        op3_suffix_dedup,
        op4_packing,
        op5_language_id,
        op6_personal_data,
        op7_source_mixing,
        op8_lm_scoring,
        op9_topk_search,
        op10_chat_format,
        op11_merkle_manifest,
        op12_embedding_whitening,
        op13_decontamination,
    )
}
