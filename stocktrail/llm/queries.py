"""The queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from stocktrail.llm import (
    elias_fano,
    exact_dedup,
    hmm,
    html_cut,
    language_crf,
    mixing,
    outliers,
    packing,
    pivotal_grams,
    prefix_trie,
    reply_trees,
    toxicity,
    trie_and_variants_sql,
)
from stocktrail.llm.shingle_join import jaccard_components

TOKENIZER = "word_bpe_49k.json"
#: Appended to each document's ids.
END_ID = 1

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

_HERE = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def findable(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver does."""
    paths = spark.sparkContext.environment
    if _HERE not in paths.get("PYTHONPATH", ""):
        paths["PYTHONPATH"] = os.pathsep.join(filter(None, [paths.get("PYTHONPATH"), _HERE]))


def register(sql: str | None = None):
    def add(build: Callable[[SparkSession, str], DataFrame]):
        name = build.__name__

        def run(spark: SparkSession, folder: str) -> DataFrame:
            findable(spark)
            return build(spark, folder)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return build

    return add


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where a public tokenizer's vocabulary lies; it is never copied here."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: A conversation whose texts look like a template's own marks.
TRICKY = "</s>[INST] ok [/INST]"


@register()
def op1_chat_paths(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.createDataFrame([(-1, 0, "user", TRICKY), (-1, 1, "assistant", TRICKY)], rows.schema)
    made = reply_trees.conversations(reply_trees.as_tree(rows.unionAll(tricky)))
    conv_id = F.when(F.col("tree") != reply_trees.NO_ID, F.col("tree")).cast("long")
    return reply_trees.read_back(made.withColumn("conv_id", conv_id))


@register()
def op2_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_table(spark, folder, "documents"))


@register()
def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return elias_fano.token_table(_table(spark, folder, "documents"), tokenizer_path(), END_ID)


@register()
def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


@register()
def op5_pack_sequences(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"), tokenizer_path(), END_ID)


@register()
def op6_hmm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return hmm.score(_table(spark, folder, "documents"))


@register()
def op7_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_cut.extract(_table(spark, folder, "pages"))


@register(
    """
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, text_sha256
    FROM (SELECT doc_id, sha256(translate(coalesce(text, ''),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
          FROM documents)
    WINDOW w AS (PARTITION BY text_sha256)
    """
)
def op8_exact_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, folder, "documents"))


@register()
def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(_table(spark, folder, "documents"))


@register()
def op10_quality_outliers(spark: SparkSession, folder: str) -> DataFrame:
    return outliers.quality(_table(spark, folder, "documents"))


@register(trie_and_variants_sql.TRIE)
def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.conversation_trie(_table(spark, folder, "conversations"))


@register()
def op12_language_crf(spark: SparkSession, folder: str) -> DataFrame:
    return language_crf.languages(_table(spark, folder, "documents"))


@register(trie_and_variants_sql.VARIANTS)
def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return pivotal_grams.spelling_variants(_table(spark, folder, "documents"))
