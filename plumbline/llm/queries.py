"""One query per operator of this package over the supplied tables, and the SQL each is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import decontaminate, htmltext, jaccard, langid, negatives, sanitise, sentencepieces, substrings, tokenids, toolcalls, toxicity, turnrepair, vafile


#: Rows that Spark hands a Python worker at a time; texts are long, so fewer than usual.
BATCH_ROWS = "2000"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = substrings.remove_repeats(table(spark, folder, "documents"), width=13)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    texts = htmltext.extract(pages, htmltext.train(pages))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def held_out(doc_id: str = "doc_id"):
    """Documents whose labels are kept for judging the scores."""
    return F.crc32(F.col(doc_id).cast("string")) % 3 == 1


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = toxicity.train(documents, table(spark, folder, "labels"), ~held_out())
    scores = toxicity.toxicity_scores(documents, model)
    return scores.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"), "restored")


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op5_pii(spark: SparkSession, folder: str) -> DataFrame:
    spans = sanitise.personal_spans(table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "term")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return spans.select("doc_id", *map(count, sanitise.PATTERNS), F.sha2(sanitise.listed(base), 256).alias("base_sha256"), sanitise.listed(F.col("spans")).alias("spans"))


def op6_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Per document the number of ids, a hash of them, and whether decoding gives the text back."""
    path = tokenizer_path("piece_bpe_32k.model")
    encoded = sentencepieces.encode(table(spark, folder, "documents").select("doc_id", "text"), path)
    decoded = sentencepieces.decode(encoded, path)
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_ids"), F.xxhash64("ids").alias("ids_hash"), same.alias("round_trip"))


def op7_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.link_components(table(spark, folder, "documents"), width=5, percent=80)


def op8_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    found = vafile.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op9_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    return tokenids.round_trip(table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=0)


#: What the tools of the derived conversations take.
TOOLS = {
    "search": {"properties": {"text": {"type": "string"}, "length": {"type": "integer"}, "after": {"type": "string"}}, "required": ["text", "length"]},
    "lookup": {"properties": {"text": {"type": "string"}, "length": {"type": "number"}, "after": {"type": "string"}}, "required": ["text", "after"]},
}


def tool_messages(conversations: DataFrame) -> DataFrame:
    """Conversations as chats with tools: a user's turn becomes a call, an assistant's turn the result of the call one turn
    before. By the turn's number a call refers to the call two turns before or, so that it has to wait, two turns later; in
    some conversations neighbouring calls refer to each other. Some call an unknown tool, leave out an argument, add one
    or give one of the wrong type."""
    turn, conv = F.col("turn"), F.col("conv_id")
    name = F.when((turn + conv) % 11 == 10, "missing").when(turn % 4 < 2, "search").otherwise("lookup")
    target = F.when((conv % 3 == 0) | (conv % 5 == 0) & (turn % 4 < 2), turn + 2).when((turn >= 2) | (conv % 5 == 0), turn - 2)
    after = F.when(target.isNotNull(), F.struct(F.concat(F.lit("c"), target).alias("$ref")))
    length = F.when((turn + conv) % 7 == 6, F.lit('"many"')).otherwise(F.length("text").cast("string"))
    fields = [
        F.concat(F.lit('"after":'), F.to_json(after)),
        F.when((turn + conv) % 13 == 12, F.lit('"extra":true')),
        F.concat(F.lit('"length":'), length),
        F.when((turn + conv) % 9 != 8, F.concat(F.lit('"text":'), F.regexp_extract(F.to_json(F.struct(F.col("text").alias("x"))), r'(?s)^\{"x":(.*)\}$', 1))),
    ]
    arguments = F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))
    call = F.concat(F.lit('{"tool_calls":[{"id":"c'), turn, F.lit('","name":"'), name, F.lit('","arguments":'), arguments, F.lit("}]}"))
    content = F.struct((turn % 2 == 0).alias("even"), F.col("text").alias("body"), F.length("text").alias("count"))
    result = F.to_json(F.struct(F.concat(F.lit("c"), turn - 1).alias("tool_call_id"), content.alias("content")))
    role = F.when(F.col("role") == "user", "assistant").when(F.col("role") == "assistant", "tool").otherwise(F.col("role"))
    text = F.when(F.col("role") == "user", call).when(F.col("role") == "assistant", result).otherwise(F.col("text"))
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))


def op10_tool_calls(spark: SparkSession, folder: str) -> DataFrame:
    linked = toolcalls.link(tool_messages(table(spark, folder, "conversations")), TOOLS)
    return linked.select("conv_id", "call_id", "name", "level", "turn", "result_turn", "status", F.sha2("line", 256).alias("line_sha256"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.col("label").cast("long")
    relabelled = table(spark, folder, "embeddings").withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return negatives.hard_negatives(relabelled, F.col("vec_id") % 50 == 0, positives=5, negatives=3, low=50, high=95, scale=256)


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults by a checksum of conversation and turn: rows dropped, emptied, without their sentence ends,
    repeated or of the user's role."""
    text, role = (F.coalesce(c, F.lit(" ")) for c in ("text", "role"))
    conversation, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    key = F.concat(conversation, F.lit(":"), turn)
    code = F.crc32(key) % 20
    text = F.when(code == 1, "").when(code == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    copies = F.explode(F.array_repeat(F.lit(0), F.when(code == 3, 2).otherwise(1)))
    return conversations.where(code != 0).select("conv_id", "turn", F.when(code == 4, "user").otherwise(role).alias("role"), text.alias("text"), copies.alias("copy"))


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations")
    found = turnrepair.summaries(damaged(conversations)).withColumnRenamed("conv_id", "found_id")
    counts = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("distinct_turns"), F.lit(0)).cast("long")
    texts = F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    return conversations.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left").select("conv_id", gaps.alias("gaps"), *counts, *texts)


def op13_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    kept_back = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    found = langid.predict(documents.select("doc_id", "text"), langid.train(documents, ~kept_back))
    return found.select("doc_id", kept_back.alias("held_out"), "lang_pred", "score")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    from plumbline.llm import oracles

    return oracles.oracle_sql()
