"""The queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyprep.llm import lexical, mixing, run_finder, vafile, vantage, warc
from surveyprep.llm.common import table
from surveyprep.llm.dartminhash import near_duplicates
from surveyprep.llm.decision_list import judge
from surveyprep.llm.fuzzy_lines import dedup_lines
from surveyprep.llm.license_scan import licences
from surveyprep.llm.lpf import remove_repeats
from surveyprep.llm.packing import harmonic_pack
from surveyprep.llm.url_tree import judge_urls

#: Allowed and blocked hosts and paths of op8: (verdict, host, path).
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def bpe_50k() -> dict:
    """Where the public 50k byte-level vocabulary lies, as a parameter of the packing operator."""
    import public_tokenizers as P

    return {"json_path": str(P.path("byte_bpe_50k.json")), "rank_path": str(P.path("byte_bpe_50k.tiktoken")),
            "pattern": P.PATTERN, "specials": {"<|endoftext|>": 50256}}


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harmonic_pack(table(spark, sf_dir, "documents"), bpe_50k())


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a tree: source / language / id."""
    d = table(spark, sf_dir, "documents").withColumn("path", F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")), F.col("doc_id").cast("string")))
    return licences(d, "doc_id", "path", "text")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "fired")


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.top_k(table(spark, sf_dir, "embeddings"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = warc.archive_and_read(table(spark, sf_dir, "pages"))
    return r.select("page_id", "payload_bytes", "payload_digest", "record_type", F.regexp_extract("refers_to", r"page:(-?\d+)", 1).try_cast("long").alias("refers_to"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_finder.run_digests(run_finder.find_runs(run_finder.periodic_tails(table(spark, sf_dir, "documents"))))


def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vantage.nearest(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # at the repository's top; it imports this subpackage

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_packing, op2_repeats, op5_licences, op4_near_duplicates, op6_mixing, op7_quality_rules, op3_top_k, op8_url_filter,
                                 op9_warc, op10_line_dedup, op11_lexical, op12_runs, op13_neighbours)}
QUERIES["pipeline"] = pipeline
ORACLE = {"op3_top_k": vafile.OP3_SQL, "op6_mixing": mixing.OP6_SQL, "op9_warc": warc.OP9_SQL, "op11_lexical": lexical.OP11_SQL}
