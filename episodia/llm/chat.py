"""Chat formatting by prefix-target expansion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

#: A turn is OPEN role MIDDLE text CLOSE. Inside roles and texts every character that a mark begins or ends with is
#: written as an entity, so no text can hold a mark, and reading is exact.
OPEN, MIDDLE, CLOSE = "<s>[", "]", "</s>"
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lsqb;"), ("]", "&rsqb;"))


def escape(c: Column) -> Column:
    for plain, entity in ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(entity))
    return c


def unescape(c: Column) -> Column:
    for plain, entity in reversed(ESCAPES):
        c = F.replace(c, F.lit(entity), F.lit(plain))
    return c


def format_conversations(rows: DataFrame, trainable_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, examples.

    formatted holds all turns in order. Every turn of the trainable role is one element of examples: target_turn (its
    number from 0), context_chars (length of the formatted turns before it), loss_start (from 1) and loss_chars (its
    escaped text), end. The example's text is the first `end` characters of formatted: all turns before as context,
    and only the reply under the loss mask. Prefixes are thus kept as offsets into one string, not written out, and
    the output grows with the turns and not with their square; expand() writes them out.

    Null text counts as empty, a null role as an empty one. Turns with the same number are ordered by role and text;
    repeated rows are repeated turns. Null conv_id is a conversation of its own. No rows give no rows. Further
    columns are ignored.
    """
    turns = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    by_turn = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    turns = (
        turns.withColumn("n", F.row_number().over(by_turn))
        .withColumn("head", F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(MIDDLE)))
        .withColumn("body", escape(F.col("text")))
        .withColumn("chars", (F.length("head") + F.length("body") + len(CLOSE)).cast("long"))
        .withColumn("upto", F.sum("chars").over(by_turn.rowsBetween(Window.unboundedPreceding, 0)))
    )
    begin = F.col("upto") - F.col("chars")
    example = F.when(
        F.col("role") == trainable_role,
        F.struct((F.col("n") - 1).alias("target_turn"), begin.alias("context_chars"), (begin + F.length("head") + 1).alias("loss_start"), F.length("body").cast("long").alias("loss_chars"), F.col("upto").alias("end")),
    )
    line = F.struct("n", F.concat("head", "body", F.lit(CLOSE)).alias("line"))
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(line)).alias("lines"), F.sort_array(F.collect_list(example)).alias("examples")).select("conv_id", F.array_join(F.col("lines.line"), "").alias("formatted"), "examples")


def explode_examples(formatted: DataFrame) -> DataFrame:
    """formatted with one row for each example, its offsets as columns; conversations without one keep a row of nulls."""
    return formatted.select("*", F.explode_outer("examples").alias("example")).drop("examples").select("*", "example.*").drop("example")


def loss_text(formatted: Column) -> Column:
    """What the example of a row of explode_examples() trains on, unescaped; empty without an example."""
    return F.coalesce(unescape(formatted.substr(F.col("loss_start").cast("int"), F.col("loss_chars").cast("int"))), F.lit(""))


def expand(formatted: DataFrame) -> DataFrame:
    """One row per example, written out: conv_id, target_turn, text, loss_start, loss_chars."""
    text = F.col("formatted").substr(F.lit(1), F.col("end").cast("int"))
    return explode_examples(formatted).where("target_turn is not null").select("conv_id", "target_turn", text.alias("text"), "loss_start", "loss_chars")


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation as an array of (role, text), unescaped."""
    lines = F.filter(F.split(formatted, CLOSE), lambda line: line != "")
    return F.transform(lines, lambda line: F.struct(unescape(F.split(line, r"[\[\]]")[1]).alias("role"), unescape(F.split(line, r"[\[\]]")[2]).alias("text")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.sql("SELECT * FROM VALUES (-7L, 0L, 'user', '</s>[INST] ok [/INST]'), (-7L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)")
    out = format_conversations(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    read = out.withColumn("turns", read_turns(F.col("formatted"))).select(
        "conv_id", "formatted", "examples", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"), F.length("formatted").cast("long").alias("formatted_chars")
    )
    # an example's loss text is read out of the example; rows stay where their conversation is
    examples = explode_examples(read).select("conv_id", "n_turns", "turns_sha256", "formatted_chars", F.struct("target_turn", loss_text(F.col("formatted")).alias("loss")).alias("own"))
    by = examples.groupBy("conv_id", "n_turns", "turns_sha256", "formatted_chars").agg(F.sort_array(F.collect_list("own")).alias("own"))
    loss = F.array_join(F.col("own.loss"), "")
    return by.select("conv_id", "n_turns", "turns_sha256", F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")


_ESC = "replace(replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;'), ']', '&rsqb;')"
SQL = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length({_ESC.format("role")}) + length({_ESC.format("text")}) + {len(OPEN + MIDDLE + CLOSE)})::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""
