"""The registered queries of the operators and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perennial.llm import (
    decontaminate,
    extraction,
    interactions,
    lexical,
    licenses,
    lines,
    matrices,
    minhash,
    packing,
    preferences,
    quality,
    repeats,
    sharding,
)

from perennial.session import delete_on_exit, fresh_path

Query = Callable[[SparkSession, str], DataFrame]

POLICY = "v2"

_queries: dict[str, Query] = {}


def query(function: Query) -> Query:
    _queries[function.__name__] = function
    return function


def queries() -> dict[str, Query]:
    return dict(_queries)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_license_scan(spark, sf_dir):
    """Documents as a file tree by source, language and id; every tenth is a licence file, every hundredth one a level up."""
    thousand, hundred = (F.expr(f"cast(doc_id div {n} as string)") for n in (1000, 100))
    name = F.when(F.col("doc_id") % 10 == 0, F.concat(F.lit("LICENSE-"), F.col("doc_id"))).otherwise(
        F.concat(F.lit("file-"), F.col("doc_id"), F.lit(".txt"))
    )
    below = F.when(F.col("doc_id") % 100 == 0, F.lit(None)).otherwise(hundred)
    files = table(spark, sf_dir, "documents").select(
        F.concat_ws("/", "source", "lang", thousand, below, name).alias("path"), "text"
    )
    return licenses.scan(files)


@query
def op2_suffix_dedup(spark, sf_dir):
    cleaned = repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op3_decontamination(spark, sf_dir):
    found = decontaminate.find(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), drop=("text",)
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@query
def op4_line_dedup(spark, sf_dir):
    """Pages by their host; what stands between two tags is a line."""
    pages = table(spark, sf_dir, "pages").select(
        "page_id", lines.site_of(F.col("url")).alias("host"), lines.between_tags(F.col("html")).alias("text")
    )
    cleaned = lines.drop_boilerplate(pages, site="host")
    return cleaned.select("page_id", "host", "n_lines", "n_dropped", F.md5(F.col("text")).alias("text_md5"))


@query
def op5_quality_rules(spark, sf_dir):
    judged = quality.apply_policy(quality.ledger(table(spark, sf_dir, "documents").select("doc_id", "text")), POLICY)
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "fail_bits",
    )


@query
def op6_preference_formatting(spark, sf_dir):
    made = preferences.format_pairs(preferences.swapped_answers(table(spark, sf_dir, "conversations")))
    mask = lambda name: F.array_join(F.transform(name, lambda n: n.cast("string")), ",")
    return made.withColumns({n: mask(n) for n in ("chosen_mask", "rejected_mask")})


@query
def op7_minhash_dedup(spark, sf_dir):
    found = minhash.link(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


@query
def op8_html_extraction(spark, sf_dir):
    return extraction.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"), drop=("html",))


@query
def op9_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op10_token_matrices(spark, sf_dir):
    """Matrices as they are read after they were written."""
    path = fresh_path(spark, "token-matrices")
    delete_on_exit(spark, path)
    matrices.write(matrices.pack_matrices(table(spark, sf_dir, "documents")), path)
    return matrices.read(spark, path).select(
        "matrix_id",
        "n_rows",
        F.element_at("cu_seqlens", -1).alias("n_tokens"),
        "doc_ids",
        "doc_starts",
        "cu_seqlens",
        "row_segments",
        F.crc32("ids").alias("ids_crc32"),
        F.crc32("positions").alias("positions_crc32"),
    )


@query
def op11_filter_interactions(spark, sf_dir):
    return interactions.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op12_lexical_search(spark, sf_dir):
    found = lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


@query
def op13_sharding(spark, sf_dir):
    body = F.coalesce("text", F.lit(""))
    sized = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(body) + 8).cast("long").alias("size"), F.crc32(body).alias("text_crc32")
    )
    placed = sharding.shuffle(sized, ["doc_id", "text_crc32", "size"])
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
