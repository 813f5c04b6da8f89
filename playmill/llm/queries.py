"""The registered queries of this subpackage: thin digests of its operators' results over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, hard_negatives, line_dedup, lm_scoring, mixing, quality_classifier, quality_rules, simhash, sp_codec, suffix_dedup, token_alignment, topk_search, toxicity
from .common import read_table
from .training import remainder

#: Name files of the installed tokenizer package; see the README.
PIECES = "piece_bpe_32k.model"
BYTE_LEVEL = "byte_bpe_50k.json"


def tokenizer_path(name: str = PIECES) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _hex(column):
    return F.sha2(column, 256)


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = sp_codec.encode(read_table(spark, sf_dir, "documents"), tokenizer_path(), decoded=True)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        _hex(F.concat_ws(",", F.col("ids").cast("array<string>"))).alias("ids_sha256"),
        _hex("decoded").alias("decoded_sha256"),
        F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0)).cast("long").alias("n_source_bytes"),
    )


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = mixing.plan(read_table(spark, sf_dir, "documents"))
    sources = p.sources.select("rank", "source_size", "target")
    return mixing.taken_words(p).join(sources, "rank").select("doc_id", "size", "source_size", "target", "taken")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.dedup(read_table(spark, sf_dir, "documents"))
    n_removed = F.col("n_bytes") - F.octet_length("kept")
    return cut.select("doc_id", "n_bytes", n_removed.cast("long").alias("n_removed"), F.size("begins").cast("long").alias("n_spans"), _hex("kept").alias("kept_sha256"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.measured(read_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_lines", "n_removed", _hex(F.coalesce("text", F.lit(""))).alias("kept_sha256"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(quality_rules.measure(read_table(spark, sf_dir, "documents")))


def _scored(scores: DataFrame, held_out, least: float) -> DataFrame:
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    held_out = remainder("doc_id", 4) == 2
    model = quality_classifier.train(docs, labels, "quality", ~held_out)
    return _scored(quality_classifier.score(docs, model), held_out, 0.7)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op8_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk_search.quantised(read_table(spark, sf_dir, "embeddings"))
    return topk_search.top_k(vectors, F.col("vec_id") % 50 == 0)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    held_out = remainder("doc_id", 5) == 0
    model = toxicity.train(docs, labels, "toxic", ~held_out)
    return _scored(toxicity.score(docs, model), held_out, 0.5)


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder("doc_id", 7) == 2
    scored = lm_scoring.score(read_table(spark, sf_dir, "documents"), ~held_out, tokenizer_path())
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.aligned(read_table(spark, sf_dir, "documents"), tokenizer_path(BYTE_LEVEL), tokenizer_path())


#: The label that op12 goes by, as Spark and DuckDB say it.
SHIFTED_LABEL = "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hard_negatives.usable(read_table(spark, sf_dir, "embeddings"), F.expr(SHIFTED_LABEL))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", _hex("items").alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_line_dedup": op4_line_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_simhash": op7_simhash,
    "op8_topk_search": op8_topk_search,
    "op9_toxicity": op9_toxicity,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_token_alignment": op11_token_alignment,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_decontamination": op13_decontamination,
}
ORACLES: dict[str, str] = {"op4_line_dedup": line_dedup.oracle(), "op8_topk_search": topk_search.oracle(), "op12_hard_negatives": hard_negatives.oracle(SHIFTED_LABEL), "op13_decontamination": decontamination.oracle()}
