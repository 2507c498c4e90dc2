"""Cleaning of texts by an outside model: what its reply is worth, what of it is taken, and what stands in for it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The columns of a reply: answered is false where the call was given up; parts are read if there is no text.
REPLY = "struct<answered: boolean, block_reason: string, candidates: int, finish_reason: string, text: string, parts: array<string>>"

# The tag and quality of each outcome. What fails keeps the text as it was and is flagged as an error.
OUTCOMES = {"gave_up": ("quota_fallback", 0.75), "blocked": ("safety_blocked", 0.72), "MAX_TOKENS": ("max_tokens_truncated", 0.72), "SAFETY": ("finish_safety", 0.72), "RECITATION": ("finish_recitation", 0.72), "empty": ("empty_candidate", 0.7), "unreadable": ("client_error", 0.7), "mismatch": ("fallback_passthrough", 0.0)}
OK_QUALITY, OK_EMPTY_QUALITY = 0.9, 0.6


def reply_text(reply: Column) -> Column:
    """The text of a reply, else its parts put together; null if that is nothing."""
    parts = F.array_join(F.filter(reply["parts"], lambda x: x.isNotNull()), "")
    return F.coalesce(F.nullif(reply["text"], F.lit("")), F.nullif(parts, F.lit("")))


def triage(reply: Column) -> Column:
    """The outcome of a reply: the first that holds of mismatch (there is none), gave_up, blocked, empty, a finish reason that
    ends a text early, empty again (no text), else text."""
    finish = F.upper(reply["finish_reason"])
    return (
        F.when(reply.isNull(), "mismatch")
        .when(~F.coalesce(reply["answered"], F.lit(False)), "gave_up")
        .when(F.length(reply["block_reason"]) > 0, "blocked")
        .when(F.coalesce(reply["candidates"], F.lit(0)) == 0, "empty")
        .when(finish.isin("MAX_TOKENS", "SAFETY", "RECITATION"), finish)
        .when(reply_text(reply).isNull(), "empty")
        .otherwise("text")
    )


def sanitised(answer: Column, raw: Column) -> Column:
    """(clean_text, ops, flags) of an answer in JSON; null if it can't be read as an object.

    A missing text is the raw one; what isn't a string, or a list, becomes one; null tags go; flags that are no object are one
    error; other flags than continues and error go, and values that aren't truth values are read as one.
    """
    v = F.try_parse_json(answer)
    kind = lambda path: F.schema_of_variant(F.variant_get(v, path, "variant"))
    text = lambda path: F.try_variant_get(v, path, "string")
    listed = F.filter(F.transform(F.try_variant_get(v, "$.ops", "array<variant>"), lambda x: F.when(F.schema_of_variant(x) != "VOID", F.try_variant_get(x, "$", "string"))), lambda x: x.isNotNull())
    none = F.array().cast("array<string>")
    ops = F.when(kind("$.ops").startswith("ARRAY"), listed).when(kind("$.ops").isNull() | (kind("$.ops") == "VOID"), none).otherwise(F.array(text("$.ops")))
    flag = lambda name: F.when(kind(f"$.flags.{name}").isNull(), F.lit(None).cast("boolean")).otherwise(F.coalesce(F.try_variant_get(v, f"$.flags.{name}", "boolean"), F.lit(False)))
    named = F.map_filter(F.create_map(F.lit("continues"), flag("continues"), F.lit("error"), flag("error")), lambda _, x: x.isNotNull())
    flags = F.when(kind("$.flags").isNull(), F.create_map().cast("map<string,boolean>")).when(kind("$.flags").startswith("OBJECT"), named).otherwise(F.create_map(F.lit("error"), F.lit(True)))
    whole = F.struct(F.coalesce(text("$.clean_text"), raw).alias("clean_text"), ops.alias("ops"), flags.alias("flags"))
    return F.when(F.schema_of_variant(v).startswith("OBJECT"), whole)


def outcome(reply: Column, raw: Column) -> Column:
    """(clean_text, ops, flags, quality) of a reply to a text."""
    kind = triage(reply)
    answer = sanitised(reply_text(reply), raw)
    failed = F.when((kind == "text") & answer.isNull(), "unreadable").when(kind != "text", kind)
    tags = F.create_map(*(F.lit(x) for k, (tag, _) in OUTCOMES.items() for x in (k, tag)))
    worth = F.create_map(*(F.lit(x) for k, (_, quality) in OUTCOMES.items() for x in (k, quality)))
    errors = F.when(failed == "mismatch", F.create_map(F.lit("error"), F.lit(True), F.lit("llm_mismatch"), F.lit(True))).otherwise(F.create_map(F.lit("error"), F.lit(True)))
    quality = F.when(F.length(answer["clean_text"]) > 0, OK_QUALITY).otherwise(OK_EMPTY_QUALITY)
    return F.struct(
        F.when(failed.isNull(), answer["clean_text"]).otherwise(F.coalesce(raw, F.lit(""))).alias("clean_text"), F.when(failed.isNull(), answer["ops"]).otherwise(F.array(tags[failed])).alias("ops"),
        F.when(failed.isNull(), answer["flags"]).otherwise(errors).alias("flags"), F.when(failed.isNull(), quality).otherwise(worth[failed]).alias("quality"),
    )


def clean_texts(rows: DataFrame, clean, key: str = "id") -> DataFrame:
    """rows (key, text, ops, ...) with text cleaned, ops appended, clean_flags and text_clean_quality.

    clean: DataFrame of distinct (key, text) -> (key, reply), reply as REPLY; a row without one counts as a mismatch. Equal texts are
    asked about once.
    """
    keyed = rows.withColumn("_k", F.sha1(F.coalesce("text", F.lit(""))))
    asked = keyed.groupBy(F.col("_k").alias("key")).agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    replies = clean(asked).select(F.col("key").alias("_r"), F.col("reply").cast(REPLY).alias("_reply"))
    done = keyed.join(replies, keyed["_k"] == replies["_r"], "left").withColumn("_out", outcome(F.col("_reply"), F.col("text")))
    return done.withColumn("text", F.col("_out.clean_text")).withColumn("ops", F.concat(F.coalesce("ops", F.array().cast("array<string>")), F.col("_out.ops"))).withColumn("clean_flags", F.col("_out.flags")).withColumn("text_clean_quality", F.col("_out.quality")).drop("_k", "_r", "_reply", "_out")
