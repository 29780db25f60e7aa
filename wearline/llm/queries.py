"""The registered corpus queries: name -> (query, SQL twin or None)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from wearline.session import ship

from wearline.llm import (
    bpe, decontaminate, extract, katz, language, phrases, pii, quality, search, simhash, substrings, twins, urls, warc,
)


#: Documents may be long, so an Arrow batch is bounded by bytes as well as by rows.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
         "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


def ready(spark: SparkSession) -> SparkSession:
    for name, value in BATCH.items():
        spark.conf.set(name, value)
    return ship(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(column, n: int):
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.pmod(F.crc32(F.col(column).cast("string")), F.lit(n))


def simhash_groups(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).drop("group_print")


def decontamination(spark, sf_dir):
    found = decontaminate.with_hits(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                    table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "_hits.n_words", "_hits.n_hit", F.size("_hits.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "_hits.items"), 256).alias("items_sha256"),
        (F.col("_hits.n_hit") > 0).alias("contaminated"))


def quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    known = quality.references(docs)
    return docs.withColumn("q", quality.verdict_column(spark, known, F.col("text"))).select("doc_id", "q.*")


def warc_archives(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    archives = warc.write_archives(pages, warc.archive_folder(spark))
    records = warc.read_archives(archives).where(F.col("record_type") != "warcinfo")
    return records.select(
        warc.page_number("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"),
        "payload_digest", "record_type", warc.page_number("refers_to").alias("refers_to"))


def substring_dedup(spark, sf_dir):
    return substrings.remove_repeats(table(spark, sf_dir, "documents"), with_text=False).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


def html_extraction(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return pages.select("page_id", "url", extract.text_column(F.col("html")).alias("text")).withColumn(
        "n_chars", F.char_length("text").cast("long"))


def personal_data(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.with_spans(docs, pii.fit(docs))
    count = lambda k: F.size(F.filter("_base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{pii.KINDS[k]}")
    return found.select("doc_id", *[count(k) for k in range(4)],
                        F.sha2(pii.span_text(F.col("_base")), 256).alias("base_sha256"),
                        pii.span_text(F.col("_spans")).alias("spans"))


def language_model(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = katz.score_documents(docs, train=remainder("doc_id", 7) != 2)
    return out.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    model = language.fit(docs.where(remainder("doc_id", 3) != 1))
    return (docs.withColumn("held_out", held_out)
            .withColumn("p", language.predict_column(spark, model, F.col("text")))
            .select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score", "p.rejected"))


def bpe_tokens(spark, sf_dir, ranks_path: str = public_tokenizers.path("byte_bpe_50k.tiktoken")):
    return bpe.encode_documents(table(spark, sf_dir, "documents"), bpe.read_ranks(ranks_path), public_tokenizers.PATTERN,
                                with_ids=False).drop("token_ids")


RULES = [urls.Rule("allow", "org", "/"), urls.Rule("block", "example.org", "/es/"), urls.Rule("block", "example.org", "/en/1"),
         urls.Rule("allow", "com", "/fr/"), urls.Rule("block", "com", "/de/")]


def url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = urls.listed_hosts(pages.select(urls.host_of(F.col("url"))))
    return urls.judge(pages, RULES, listed).drop("url")


def ranked_search(spark, sf_dir):
    return search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def phrase_collocations(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"))


def prepared(build):
    """Ships the package to the workers and bounds what one Arrow batch holds."""
    def run(spark, sf_dir):
        return build(ready(spark), sf_dir)

    return run


PLAIN = {
    "op1_simhash_dedup": (simhash_groups, None),
    "op2_decontamination": (decontamination, twins.DECONTAMINATION),
    "op3_quality_rules": (quality_rules, None),
    "op4_warc_archives": (warc_archives, """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
        q AS (SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS payload_digest FROM p),
        m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM q)
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
          CASE WHEN payload_bytes >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
          CASE WHEN payload_bytes >= 1000 AND page_id < last THEN last END AS refers_to FROM m"""),
    "op5_substring_dedup": (substring_dedup, twins.SUBSTRING_DEDUP),
    "op6_html_extraction": (html_extraction, None),
    "op7_personal_data": (personal_data, None),
    "op8_language_model": (language_model, None),
    "op9_language_id": (language_id, None),
    "op10_bpe_tokens": (bpe_tokens, None),
    "op11_url_filter": (url_filter, twins.url_filter(urls.LISTED_PATTERN)),
    "op12_ranked_search": (ranked_search, twins.RANKED_SEARCH),
    "op13_phrase_collocations": (phrase_collocations, twins.PHRASE_COLLOCATIONS),
}

QUERIES = {name: (prepared(build), statement) for name, (build, statement) in PLAIN.items()}
