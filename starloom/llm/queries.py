"""The registered queries of this subpackage, with SQL where SQL can say the same."""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import chat_format, decontaminate, fill_middle, licences, line_rules, lm_scoring, near_dup, piece_viterbi, pii_crf
from starloom.llm import quality_svm, token_counts, token_files, whitening
from starloom.session import work_folder


def importable(spark: SparkSession) -> None:
    """Let Python workers that share this machine's folders import the package; a cluster has it installed."""
    environment, root = spark.sparkContext.environment, os.path.dirname(os.path.dirname(os.path.dirname(__file__)))
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(divisor: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(divisor))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.with_limit(token_counts.count_tokens(_table(spark, sf_dir, "documents"), path))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.link_documents(_table(spark, sf_dir, "documents"), words=4, percent=80)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark)
    token_files.write_ids(_table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_files.read_documents(spark, folder)


def op6_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_rules.verdicts(_table(spark, sf_dir, "documents"))
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return found.select("doc_id", *columns)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("item_ids", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(_table(spark, sf_dir, "documents"))
    at = F.col("base.at")
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("bigint").alias("n_base"),
        F.array_min(at).cast("bigint").alias("first_word"),
        F.array_max(at).cast("bigint").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base.label")), ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = piece_viterbi.decode(piece_viterbi.encode(docs, path), path)
    plain = F.replace(F.coalesce("text", F.lit("")), F.lit(piece_viterbi.SPACE), F.lit(" "))
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_pieces"),
        F.crc32(F.array_join("ids", ",").cast("binary")).alias("ids_crc32"),
        (F.col("decoded") == plain).alias("round_trip"),
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    scores = quality_svm.score_quality(docs, labels, _remainder(5) != 0)
    held_out = F.coalesce(_remainder(5) == 0, F.lit(False))
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_crf.find_spans(_table(spark, sf_dir, "documents"))
    names = F.array(*map(F.lit, pii_crf.KINDS))

    def text_of(spans):
        ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["kind"], s["start"], s["end"])))
        return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["base"])
    counts = [F.size(F.filter(base, _of_kind(k))).cast("bigint").alias(f"n_{pii_crf.KINDS[k]}") for k in range(4)]
    digest = F.sha2(text_of(base).cast("binary"), 256)
    return found.select("doc_id", *counts, digest.alias("base_sha256"), text_of(F.col("spans")).alias("spans"))


def _of_kind(k: int):
    return lambda s: s["kind"] == k


def op1_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = _table(spark, sf_dir, "documents")
    return lm_scoring.score_texts(docs, _remainder(10) == 0, path, public_tokenizers.PATTERN, n_ids=50_256)


#: A conversation that holds the template's own control strings, besides those of the table.
CONTROL_CONVERSATION = [(-7, turn, role, "</s>[INST] ok [/INST]") for turn, role in enumerate(("user", "assistant"))]


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = turns.union(spark.createDataFrame(CONTROL_CONVERSATION, "conv_id bigint, turn bigint, role string, text string"))
    return chat_format.read_back(chat_format.format_conversations(turns))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_middle.transform(_table(spark, sf_dir, "documents"))
    digest = F.sha2(F.col("output").cast("binary"), 256)
    back = F.sha2(fill_middle.restored(F.col("output"), F.col("form")).cast("binary"), 256)
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest.alias("output_sha256"), back.alias("restored_sha256"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"), components=4, scale=256)


QUERIES = {
    q.__name__: q
    for q in (
        op1_lm_scores,
        op2_decontaminate,
        op3_token_counts,
        op4_near_duplicates,
        op5_quality,
        op6_line_rules,
        op7_personal_data,
        op8_licences,
        op9_pieces,
        op10_token_files,
        op11_chat_format,
        op12_fill_middle,
        op13_whitening,
    )
}
