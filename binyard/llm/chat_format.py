"""Operator 3 (native): chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: the conversation's
rendering from its start to the end of that turn, with only that reply under
the loss mask.  Turns after the last assistant turn (or a conversation
without one) come as one further example with nothing trainable, so the
examples hold every turn.

Template of a turn: ``<|im_start|>`` role ``\\n`` text ``<|im_end|>\\n``.  Roles
are URL-encoded; a control string inside a text gets a backslash after its
first character, before any backslashes already there, and reading takes that
one away, so every text comes back exactly.

Only DataFrame functions are used.  Examples of one conversation are prefixes
of one rendering, so they are cut from it where they are made; only what is
asked of them is shuffled.

Edge cases: a null role or text is the empty string; a null conv_id is a
conversation of its own (all null ids together); turns are ordered by turn
(nulls first), ties by role, then text; repeated rows are repeated turns; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
#: Control strings of this and of other common templates, each
#: split after its first character.
CONTROL = r"(\|im_start\||\|im_end\||\|endoftext\||/?s>|/?INST\]|</?SYS>>)"
_ESCAPE = r"([<\[])(\\*)" + CONTROL
_UNESCAPE = r"([<\[])\\(\\*)" + CONTROL


def escape(col):
    return F.regexp_replace(col, _ESCAPE, r"$1\\$2$3")


def unescape(col):
    return F.regexp_replace(col, _UNESCAPE, r"$1$2$3")


def _role(col):
    return F.url_encode(col)


def conversations_of(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): one row per conversation, rendered turns in order,
    each with the place of its text in the rendering (1-based)."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = turns.select(F.col("conv_id"), F.struct(F.col("turn").alias("turn"), role.alias("role"), text.alias("text")).alias("t"))
    per = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    rendered = F.transform("ts", lambda t: F.struct(
        t.turn.alias("turn"), (t.role == "assistant").alias("learn"),
        F.concat(F.lit(START), _role(t.role), F.lit("\n")).alias("head"), escape(t.text).alias("body")))
    per = per.select("conv_id", rendered.alias("ts"))
    return per.select("conv_id", "ts", F.array_join(F.transform("ts", lambda t: F.concat(t.head, t.body, F.lit(END))), "").alias("rendering"))


def examples(turns: DataFrame) -> DataFrame:
    """(conv_id, target_turn, text, loss_start, loss_chars): ``text`` is the
    formatted example, the mask covers ``loss_chars`` code points from the
    1-based ``loss_start``; both are null where nothing is trainable."""
    per = conversations_of(turns)
    sizes = F.transform("ts", lambda t: F.struct(
        t.turn.alias("turn"), t.learn.alias("learn"), F.length(t.head).alias("head"), F.length(t.body).alias("body")))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<turn:bigint,learn:boolean,at:int,size:int>>").alias("spans"))
    spans = F.aggregate(
        sizes, zero,
        lambda a, s: F.struct(
            (a.at + s.head + s.body + F.lit(len(END))).alias("at"),
            F.concat(a.spans, F.array(F.struct(
                s.turn.cast("bigint").alias("turn"), s.learn.alias("learn"),
                (a.at + s.head + F.lit(1)).alias("at"), s.body.alias("size")))).alias("spans")),
        lambda a: a.spans)
    per = per.select("conv_id", "rendering", spans.alias("spans"))
    learnt = F.filter("spans", lambda s: s.learn)
    tail = F.when(F.element_at("spans", -1).learn, F.array().cast("array<struct<turn:bigint,learn:boolean,at:int,size:int>>")) \
        .otherwise(F.array(F.struct(F.lit(None).cast("bigint").alias("turn"), F.lit(False).alias("learn"),
                                    F.lit(None).cast("int").alias("at"), F.lit(None).cast("int").alias("size"))))
    per = per.select("conv_id", "rendering", F.explode(F.concat(learnt, tail)).alias("s"))
    text = F.when(F.col("s.learn"), F.expr(f"substring(rendering, 1, s.at - 1 + s.size + {len(END)})")).otherwise(F.col("rendering"))
    return per.select("conv_id", F.col("s.turn").alias("target_turn"), text.alias("text"),
                      F.col("s.at").alias("loss_start"), F.col("s.size").alias("loss_chars"))


def parse(text):
    """The turns of a formatted text: array of (role, text), unescaped."""
    # a raw end marker cannot occur inside an escaped text
    parts = F.filter(F.split(text, r"<\|im_end\|>\n"), lambda p: p != "")
    body = F.transform(parts, lambda p: F.substr(p, F.lit(len(START) + 1)))
    return F.transform(body, lambda p: F.struct(
        F.url_decode(F.substring_index(p, "\n", 1)).alias("role"),
        unescape(F.substr(p, F.locate("\n", p) + 1)).alias("text")))


def digest(found: DataFrame) -> DataFrame:
    """Per conversation, read back from its examples."""
    loss = unescape(F.expr("substring(text, loss_start, loss_chars)"))
    # the longest example, the last one, holds all turns
    cut = found.select("conv_id", F.length("text").alias("chars"), "loss_start", loss.alias("loss"), "text")
    per = cut.groupBy("conv_id").agg(
        F.max(F.struct("chars", "text")).alias("last"),
        F.sort_array(F.collect_list(F.when(F.col("loss_start").isNotNull(), F.struct("loss_start", "loss")))).alias("losses"),
        F.sum(F.col("chars").cast("long")).alias("formatted_chars"))
    all_loss = F.array_join(F.transform("losses", lambda s: s.loss), "")
    turns = parse(F.col("last.text"))
    per = per.select("conv_id", turns.alias("turns"), all_loss.alias("loss"), "formatted_chars")
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return per.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(flat.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars")


_CHECK_TEXT = "</s>[INST] ok [/INST]"


def op3(spark, sf_dir: str) -> DataFrame:
    """All conversations and the check conversation -7."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    rows = ", ".join(f"(-7L, {i}L, '{r}', '{_CHECK_TEXT}')" for i, r in enumerate(("user", "assistant")))
    check = spark.sql(f"SELECT * FROM VALUES {rows} AS t(conv_id, turn, role, text)")
    return digest(examples(turns.unionByName(check)))


ORACLE = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
k AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
    24 + length(url_encode(role)) + length(regexp_replace(text,
      '([<\[])(\\*)(\|im_start\||\|im_end\||\|endoftext\||/?s>|/?INST\]|</?SYS>>)', '\1\\\2\3', 'g')) AS size FROM t),
e AS (SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY k) AS upto, k = count(*) OVER (PARTITION BY conv_id) AS is_last FROM k)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(upto) FILTER (role = 'assistant' OR is_last)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
