"""One query per operator over the test tables, with production parameters and whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custarc.llm import chat, decontaminate, html_text, jaccard, line_dedup, neighbours, packing, pii, quality, repair, sharding, spelling, warc
from custarc.llm.common import stored, table
from custarc.llm.oracle import ORACLE  # noqa: F401

c = F.col


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    frequent = line_dedup.collect_lines(docs, min_docs=10).frequent()
    return line_dedup.mark_lines(docs, frequent).select(
        c("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents").select("doc_id", "text"))


def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.fit(docs, quality.grades_of_labels(table(spark, folder, "labels")))
    scored = quality.score(docs, model)
    return scored.select(c("row.doc_id").alias("doc_id"), "expected_grade", "p_top", F.coalesce(c("p_top") >= 0.5, F.lit(True)).alias("selected"))


def op4_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = jaccard.near_duplicates(docs, percent=80, size=5)
    return found.select("doc_id", "n_shingles", "component_id", c("class_doc_id").alias("class_id"), "n_links")


def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    places = sharding.assign_shards(table(spark, folder, "documents"), shards=24, overhead=8)
    return places.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    judged = decontaminate.judge(docs, table(spark, folder, "benchmark"))
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op7_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = html_text.extract(table(spark, folder, "pages").select("page_id", "url", "html"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))


def op8_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"), c("vec_id") % 20 == 0, k=20)


def op9_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    said = f"{chat.END}{chat.START}assistant ok"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        c("id").alias("turn"),
        F.when(c("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    logged = table(spark, folder, "conversations").select("conv_id", c("turn").cast("long").alias("turn"), "role", "text")
    stretches = chat.read_back(chat.render_stretches(chat.rebuild(chat.as_events(logged.unionByName(extra)))))
    turn_text = F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    # Counted by stretch; texts are only joined for the two digests.
    told = stretches.select(
        "conv_id",
        "stretch",
        F.size("turns").alias("n"),
        F.array_join(turn_text, "").alias("said"),
        F.array_join("learned", "").alias("learned"),
        F.length("formatted").alias("chars"),
    )
    parts = told.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"),
        F.sum(F.length("learned")).alias("loss_chars"),
        F.sum("chars").alias("formatted_chars"),
        F.sort_array(F.collect_list(F.struct("stretch", "said", "learned"))).alias("p"),
    )
    return parts.select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join(F.transform("p", lambda x: x.said), ""), 256).alias("turns_sha256"),
        "loss_chars",
        F.sha2(F.array_join(F.transform("p", lambda x: x.learned), ""), 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_spans(table(spark, folder, "documents").select("doc_id", "text"))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    def of(*kinds):
        return F.filter("spans", lambda s: s.kind.isin(*kinds))

    return found.select(
        c("row.doc_id").alias("doc_id"),
        *[F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in pii.BASE],
        F.sha2(listed(of(*pii.BASE)), 256).alias("base_sha256"),
        listed(c("spans")).alias("spans"),
    )


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    told = table(spark, folder, "conversations").select(c("conv_id").alias("conv"), "turn", "role", "text")
    found, edits = repair.repair(repair.damage(told))
    report = found.join(repair.faults(edits), "cid").join(repair.audits(edits), "cid")
    every = told.select(c("conv").alias("conv_id")).distinct()
    counts = [F.coalesce(x, F.lit(0)).cast("long").alias(x) for x in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(report, c("conv_id").eqNullSafe(c("conv")), "left").select(
        "conv_id",
        *counts,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.sha2(F.coalesce("repaired", F.lit("")), 256).alias("repaired_sha256"),
    )


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    words = spelling.counted_words(table(spark, folder, "documents"), shortest=7, least=2, every=31)
    return spelling.variants(stored(words, "words"), times=10)


def op13_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    # The pages have no time of capture: a page's number counts as seconds.
    at = F.timestamp_seconds(c("page_id") % 1_000_000_000)
    found = warc.round_trip(pages, key="page_id", url="url", payload="html", at=at, least=1000)
    return found.select(c("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES = {
    f.__name__: f
    for f in (op1_line_dedup, op2_packing, op3_quality_classifier, op4_ngram_jaccard, op5_sharding, op6_decontamination, op7_html_extraction, op8_nearest_neighbours, op9_chat_formatting, op10_pii, op11_conversation_repair, op12_spelling_variants, op13_warc)
}
