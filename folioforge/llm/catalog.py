"""The queries op1_ to op12_ over the standard tables, and the SQL that checks those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, dialogues, html, langid, licenses, multiset, oracles, packing, quality, simhash, toxicity, urls, winnow
from .shared import held_out, table


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=3)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.size("sentence_ids").cast("long").alias("n_sentences"), F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licenses", ",").alias("licenses"))


def op3_multiset(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = multiset.neighbours(table(spark, sf_dir, "documents").select("doc_id", "text"))
    rows = rows.withColumn("edited", multiset.edited(F.col("text"), F.col("next_text")))
    rows = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "vector", "next_vector", multiset.vector(F.col("edited")).alias("edited_vector"))
    rows = rows.withColumns({f"{x}bias": multiset.biases(F.col(f"{x}vector")) for x in ("", "next_", "edited_")})
    v, b = F.col("vector"), F.col("bias")
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", multiset.hexed(v).alias("fingerprint"), multiset.hexed(F.col("edited_vector")).alias("edited_fingerprint"),
        multiset.likeness(v, F.col("edited_vector"), b, F.col("edited_bias")).alias("near_edited"), multiset.likeness(v, F.col("next_vector"), b, F.col("next_bias")).alias("near_next"),
    )


SITE_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [urls.site_rule(*x) for x in SITE_RULES] + urls.spam_rules()
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs.select("doc_id", "text"), langid.learn(docs), ["doc_id"])
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "bits_per_byte")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary("byte_bpe_50k.json"), ["doc_id"])
    return digests(found)


def digests(encoded: DataFrame) -> DataFrame:
    """Of encoded rows what tells whether they are right."""
    return encoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html.main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"), ["page_id", "url"])
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")), ["doc_id"])
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"))


def op10_winnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnow.contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    items = F.col("items")
    return found.select("doc_id", "n_words", "n_hit", F.size(items).cast("long").alias("n_items"), F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"), winnow.is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with the faults that op11 mends, put in by a hash of id and turn."""
    some = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.select("conv_id", "turn", some("role").alias("role"), some("text").alias("text"), (F.crc32(F.concat_ws(":", some("conv_id"), some("turn")).cast("binary")) % 20).alias("d"))
    text = F.when(F.col("d") == 1, "").when(F.col("d") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("d") == 4, "user").otherwise(F.col("role"))
    return rows.where("d != 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), F.when(F.col("d") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def op11_dialogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = dialogues.repair(damaged(rows))
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    all_ids = rows.select(F.col("conv_id").alias("conv")).distinct()
    made = dialogues.same(dialogues.same(all_ids, found.audits, ["conv"], "left"), dialogues.digests(found.turns()), ["conv"], "left")
    return made.select(F.col("conv").alias("conv_id"), *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in numbers], F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality.score(docs, quality.learn(docs, table(spark, sf_dir, "labels")), ["doc_id"])
    return found.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


QUERIES = {f.__name__: f for f in (op1_simhash, op2_licenses, op3_multiset, op4_urls, op5_langid, op6_bpe, op7_html, op8_toxicity, op9_packing, op10_winnow, op11_dialogues, op12_quality)}
ORACLES = {"op2_licenses": oracles.licensed(), "op4_urls": oracles.site_verdicts(SITE_RULES), "op10_winnow": oracles.contaminated(), "op11_dialogues": oracles.repaired()}
