"""Registered queries of the training-data operators, with their oracle SQL where
SQL can express the result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import ann_ads, conv_glr, decontam_fm, dedup_pfp, embed_rabitq, langid_zstd, minhash_bbit, mix_waterfill, quality_kn, runs_ipm, token_count, token_orc, url_rules
from quarry.llm.common import Query, read_table, scratch

BYTE_VOCABULARY = "byte_bpe_50k.json"
WORD_VOCABULARY = "word_bpe_49k.json"
TOKEN_LIMIT = 2048

URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op1_ann_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_ads.search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_langid_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = langid_zstd.train(docs.where(~langid_zstd.held_out()))
    judged = langid_zstd.identify(docs, model)
    return judged.select("doc_id", langid_zstd.held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op3_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "token-orc")
    token_orc.write_token_orc(
        read_table(spark, sf_dir, "documents"), path, public_tokenizers.path(BYTE_VOCABULARY)
    )
    return token_orc.token_digest(spark, path)


def op4_decontam_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam_fm.decontaminate(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )
    n_hit = F.aggregate("spans", F.lit(0), lambda n, s: n + s["stop"] - s["start"]).cast("long")
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def op5_mix_waterfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_waterfill.mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("row.doc_id", "size", "source_size", "target", "taken")


def op6_dedup_pfp(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = dedup_pfp.repeated_spans(read_table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op7_minhash_bbit(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = minhash_bbit.near_duplicates(read_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_shingles", "component_id", "kept")


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return url_rules.judge_urls(read_table(spark, sf_dir, "pages"), rules)


def op9_quality_kn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_kn.judge_quality(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    )


def op10_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_count.count_tokens(
        read_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_VOCABULARY)
    )
    return counts.withColumn("over_limit", counts.n_tokens > TOKEN_LIMIT)


def op11_embed_rabitq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_rabitq.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def planted_runs(docs: DataFrame) -> DataFrame:
    """The contract's planted periods: with h = crc32(doc_id) and g = h div 10, a text of
    n words whose h ends in 0 repeats, from word a = g % n on, its next
    1 + floor((n - a) / (3 + g % 8)) words."""
    blanks = conv_glr.BLANKS
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.split(F.btrim("text", F.lit(blanks)), f"[{blanks}]+")
    chosen = (h % 10 == 0) & (F.btrim("text", F.lit(blanks)) != "")
    split = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(chosen, words).alias("words"))
    split = split.withColumn("n", F.size("words")).withColumn("a", (F.col("g") % F.col("n")).cast("int"))
    phrase = (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    split = split.withColumn("p", phrase)
    head = F.slice("words", 1, F.col("a"))
    repeats = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    tail = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), repeats))
    planted = F.array_join(F.slice(F.concat(head, tail), 1, F.col("n")), " ")
    return split.select("doc_id", F.when(F.col("words").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def op12_runs_ipm(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs_ipm.find_runs(planted_runs(read_table(spark, sf_dir, "documents")))
    # Fractions compare by cross products: the greatest length / period, then the
    # smallest start, then the smallest period.
    greater = lambda x, y: (
        (x["length"] * y["period"] > y["length"] * x["period"])
        | ((x["length"] * y["period"] == y["length"] * x["period"])
           & ((x["start"] < y["start"]) | ((x["start"] == y["start"]) & (x["period"] < y["period"]))))
    )
    top = F.aggregate("runs", F.get("runs", F.lit(0)), lambda best, r: F.when(greater(r, best), r).otherwise(best))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    listed = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("top", top).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "top.start",
        "top.length",
        "top.period",
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def damaged_turns(rows: DataFrame) -> DataFrame:
    """The contract's damage, by crc32 of ``conv_id:turn`` modulo 20; nulls are one space."""
    spoken = rows.select(
        "conv_id", "turn", *(F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")),
        F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))).alias("key"),
    ).withColumn("harm", F.crc32("key") % 20)
    harm, text = F.col("harm"), F.col("text")
    return spoken.where(harm != 0).select(
        "conv_id",
        "turn",
        F.when(harm == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(harm == 1, "").when(harm == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(harm == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def op13_conv_glr(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations")
    return conv_glr.repair(damaged_turns(rows), ids=rows)


QUERIES: dict[str, Query] = {
    "op1_ann_ads": op1_ann_ads,
    "op2_langid_zstd": op2_langid_zstd,
    "op3_token_orc": op3_token_orc,
    "op4_decontam_fm": op4_decontam_fm,
    "op5_mix_waterfill": op5_mix_waterfill,
    "op6_dedup_pfp": op6_dedup_pfp,
    "op7_minhash_bbit": op7_minhash_bbit,
    "op8_url_rules": op8_url_rules,
    "op9_quality_kn": op9_quality_kn,
    "op10_token_count": op10_token_count,
    "op11_embed_rabitq": op11_embed_rabitq,
    "op12_runs_ipm": op12_runs_ipm,
    "op13_conv_glr": op13_conv_glr,
}
