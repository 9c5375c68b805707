"""The named queries of the training-data operators, with the columns their contracts ask for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborlight.llm import (
    bytepairs,
    chat,
    decontaminate,
    infill,
    interpolation,
    jaccard,
    licenses,
    packing,
    personal,
    quality,
    search,
    suffixes,
    urls,
)
from harborlight.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]

WINDOW = 2048
URL_RULES = (
    # fixed values: the contract's rules
    urls.UrlRule("allow", "com", "/"),
    urls.UrlRule("block", "example.com", "/en/"),
    urls.UrlRule("allow", "www.example.com", "/en/"),
    urls.UrlRule("block", "net", "/es/"),
    urls.UrlRule("block", "net", "/fr/"),
)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    pieces = packing.token_pieces(docs, tokenizer_path(), WINDOW, with_ids=False)
    return packing.pack(pieces.drop("ids"), packing.most_pieces(docs, WINDOW), WINDOW)


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolation.score_texts(read_table(spark, sf_dir, "documents"))[0]


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal.personal_data(read_table(spark, sf_dir, "documents"))
    counts = [f"n_{kind}" for kind in personal.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans", "n_found"
    )


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(read_table(spark, sf_dir, "documents"), 200).drop("kept")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.near_duplicates(read_table(spark, sf_dir, "documents"), length=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id", "class_id")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(read_table(spark, sf_dir, "documents"))
    base = F.arrays_overlap("broken", F.array(*(F.lit(r.name) for r in quality.BASE_RULES)))
    return judged.select(
        "doc_id",
        *(
            f"metrics.{name}"
            for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        ),
        base.alias("base_failed"),
        (F.size("broken") == 0).alias("kept"),
    )


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = "</s>[INST] ok [/INST]"
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(
        [(-7, 0, "user", planted), (-7, 1, "assistant", planted)],
        "conv_id long, turn long, role string, text string",
    )
    return chat.conversation_digests(chat.format_turns(turns.union(extra)))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontaminate.contamination(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )
    digest = F.sha2(F.array_join("items", ","), 256)
    return judged.select(
        "doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated", "n_near"
    )


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read_table(spark, sf_dir, "pages"), URL_RULES)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked_search(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), top=10
    )


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = infill.infill(read_table(spark, sf_dir, "documents"), infill.Infill(seed=7))
    restored = infill.restored(F.col("output"), F.col("form"))
    return made.select(
        *("doc_id", "n", "form", "prefix_chars", "middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored, 256).alias("restored_sha256"),
    )


def op13_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = byte_tokenizer_path()
    coded = bytepairs.decode(bytepairs.encode(read_table(spark, sf_dir, "documents"), path), path)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES = (
    op1_packing,
    op2_lm_score,
    op3_pii,
    op4_suffix_dedup,
    op5_jaccard_join,
    op6_quality_rules,
    op7_license_scan,
    op8_chat_format,
    op9_decontamination,
    op10_url_filter,
    op11_ranked_search,
    op12_infill,
    op13_byte_pairs,
)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in QUERIES}
