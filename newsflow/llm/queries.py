"""One registered query per operator, over its whole table, with the result columns that its users rely on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.llm.conversation_trie import numbered_turns, prefix_trie, regrown
from newsflow.llm.decontaminate import contaminated, contamination
from newsflow.llm.fill_middle import cut, digests
from newsflow.llm.html_text import LABELLED_PAGES, extract_text
from newsflow.llm.language_mix import fit, held_out, identify
from newsflow.llm.line_dedup import dedup_lines
from newsflow.llm.mixing import mix_to_targets
from newsflow.llm.near_dedup import near_duplicates
from newsflow.llm.quality_lm import classify
from newsflow.llm.substring_dedup import remove_repeated_passages
from newsflow.llm.tables import materialize, read
from newsflow.llm.token_counts import count_tokens, token_folder, write_token_files
from newsflow.llm.topk import scaled, top_k
from newsflow.llm.url_filter import filter_urls, host_and_path

URL_RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)


def shown_document() -> Column:
    """A page shows the document whose number is in its path."""
    _, path = host_and_path(F.col("url"))
    return F.regexp_extract(path, r"/(\d{1,18})[^/]*/?$", 1).try_cast("long")


# Shares of the domains that the labels tell apart, in tokens of the mixture.
TARGETS = {"good": 0.90, "low": 0.08, "toxic": 0.02}


def page_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, good): a page shares the labels of the document it shows."""
    pages = read(spark, sf_dir, "pages").select("page_id", shown_document().alias("doc_id"))
    labels = read(spark, sf_dir, "labels").groupBy("doc_id").agg(F.min(((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int")).alias("good"))
    return pages.join(labels, "doc_id").select("page_id", "good")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, page_outcomes(spark, sf_dir), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeated_passages(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_folder(spark)
    write_token_files(read(spark, sf_dir, "documents").select("doc_id", "text"), folder)
    return count_tokens(spark, folder).select("doc_id", "n_tokens")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def good_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "labels").select("doc_id", ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = classify(read(spark, sf_dir, "documents").select("doc_id", "lang", "text"), good_labels(spark, sf_dir))
    return judged.select("doc_id", "lang", "perplexity", "tail_perplexity", "kept")


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = contamination(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    return judged.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated(F.col("n_words"), F.col("n_hit")).alias("contaminated"),
    )


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))
    # Rows that repeat the doc_id of a component are its first document by number, whatever their text.
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")
    return judged.select("doc_id", "n_shingles", "component_id", kept)


def domain_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "low")
    return read(spark, sf_dir, "labels").select("doc_id", domain.alias("domain"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mix_to_targets(docs, domain_labels(spark, sf_dir), TARGETS)
    return mixed.select("doc_id", "source", "n_tokens", "rate", "copies", "gap")


def op9_pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialize(scaled(read(spark, sf_dir, "embeddings").select("vec_id", "embedding")), "vectors")
    return top_k(rows, F.col("vec_id") % 100 == 0)


def labelled_pages(spark: SparkSession, sf_dir: str, limit: int = LABELLED_PAGES) -> DataFrame:
    """(html, text) of at most ``limit`` pages, the first by a hash, with the document each shows."""
    pages, docs = read(spark, sf_dir, "pages").filter("page_id IS NOT NULL"), read(spark, sf_dir, "documents")
    numbered = pages.select("page_id", shown_document().alias("doc_id")).filter("doc_id IS NOT NULL")
    # Rows of two ids, at most ``limit``: both tables meet them before any text moves.
    chosen = F.broadcast(materialize(numbered.orderBy(F.xxhash64("page_id"), "page_id").limit(limit), "labelled-pages"))
    texts = docs.select("doc_id", "text").join(chosen, "doc_id").select("page_id", "text")
    return pages.select("page_id", "html").join(chosen.select("page_id"), "page_id").join(texts, "page_id").select("html", "text")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(read(spark, sf_dir, "pages"), labelled_pages(spark, sf_dir))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(*regrown(numbered_turns(read(spark, sf_dir, "conversations"))))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    model = fit(docs.filter(~held_out(F.col("doc_id"))).select("lang", "text"))
    judged = identify(docs.select("doc_id", "text"), model)
    return judged.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", F.array_join("languages", ",").alias("languages"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(cut(read(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filters": op1_url_filters,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_line_dedup": op4_line_dedup,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_mixing": op8_mixing,
    "op9_pivot_top_k": op9_pivot_top_k,
    "op10_html_extraction": op10_html_extraction,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_language_id": op12_language_id,
    "op13_fill_in_middle": op13_fill_in_middle,
}
