"""Operator 3: chat formatting of typed content parts, in DataFrame functions only.

A message is a list of parts: text, image, audio or document.  A visitor over
the parts writes text as it is (control strings escaped, also those that begin
in one text part and end in the next) and every other part as a placeholder with its ordinal, and records the part's reference and the
number of tokens it expands to.  The template marks turns::

    <|turn|>role\n ... <|end|>\n

Escaping is reversible: a backslash is doubled, and a backslash is put after
the first character of every control string, so no control string, of this
template or of the common others, survives in a text.

Scale: one shuffle by conversation.  Offsets are a running sum over the sorted
rows of a conversation, a window that holds one row at a time, and the rows are
then joined within the same partitions; a conversation is one output string, so
its rows meet in one row by the nature of the result, but only its own.  No
Python runs on the executors.

Defined results: NULL text is empty, a NULL role is empty, parts of a NULL or
unknown type are skipped; rows of one conversation are ordered by turn (NULL
first), then role and text, so ties and repeated rows have one order; rows
with a NULL conversation id form one conversation; an empty table gives no
rows; extra columns are ignored.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table, text_or_empty

TURN, END = "<|turn|>", "<|end|>"
#: Control strings that texts must not carry (fixed values): the template's "<|", and common others.
CONTROL = r"<(?=\||/?s>|</?SYS>>|/?(?:image|audio|document)\b)|\[(?=/?INST\])"
#: Sizes of the encoders' units (fixed values): pixels to a patch edge, audio tokens a second, tokens a page.
PATCH, AUDIO_RATE, PAGE_TOKENS = 14, 25, 256

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), CONTROL, r"$0\\")


def escape_role(role: Column) -> Column:
    """A role stands before the first bare line break, so its own line breaks are escaped too."""
    return F.regexp_replace(escape(role), "\n", "\\\\\n")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def text_part(text: Column) -> Column:
    """A text as a list of one typed part."""
    null = lambda t: F.lit(None).cast(t)
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), null("string").alias("ref"),
                            null("int").alias("width"), null("int").alias("height"), null("double").alias("seconds"),
                            null("int").alias("pages")))


def part_tokens(p: Column) -> Column:
    """Tokens that an attachment's placeholder expands to."""
    size = lambda c: F.greatest(F.coalesce(c, F.lit(0)), F.lit(0))
    patches = F.ceil(size(p["width"]) / PATCH) * F.ceil(size(p["height"]) / PATCH)
    return (F.when(p["type"] == "image", patches)
            .when(p["type"] == "audio", F.ceil(F.greatest(F.coalesce(p["seconds"], F.lit(0.0)), F.lit(0.0)) * AUDIO_RATE))
            .when(p["type"] == "document", size(p["pages"]) * PAGE_TOKENS).cast("long"))


def visit(parts: Column) -> Column:
    """Parts flattened in order: struct(content, attachments).

    ``attachments`` holds (ordinal, type, ref, n_tokens) of the parts that are no text, in the
    order of their placeholders ``<|image:0|>``.
    """
    known = F.filter(F.coalesce(parts, F.array().cast(f"array<{PART}>")),
                     lambda p: F.coalesce(p["type"].isin("text", "image", "audio", "document"), F.lit(False)))
    start = F.struct(F.lit("").alias("content"), F.lit("").alias("open"),
                     F.array().cast("array<struct<ordinal:int,type:string,ref:string,n_tokens:bigint>>").alias("attachments"))

    def step(acc, p):
        n = F.size(acc["attachments"])
        mark = F.concat(F.lit("<|"), p["type"], F.lit(":"), n.cast("string"), F.lit("|>"))
        is_text = p["type"] == "text"
        own = F.struct(n.alias("ordinal"), p["type"].alias("type"), p["ref"].alias("ref"), part_tokens(p).alias("n_tokens"))
        # texts that stand next to each other are escaped as one: a control string may lie over their border
        return F.struct(
            F.when(is_text, acc["content"]).otherwise(F.concat(acc["content"], escape(acc["open"]), mark)).alias("content"),
            F.when(is_text, F.concat(acc["open"], F.coalesce(p["text"], F.lit("")))).otherwise("").alias("open"),
            F.when(is_text, acc["attachments"]).otherwise(F.concat(acc["attachments"], F.array(own))).alias("attachments"))

    return F.aggregate(known, start, step, lambda acc: F.struct(
        F.concat(acc["content"], escape(acc["open"])).alias("content"), acc["attachments"].alias("attachments")))


def format_conversations(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         parts: Column | None = None, text_col: str = "text", loss_role: str = "assistant") -> DataFrame:
    """One row a conversation: id, formatted, loss_spans (start, end in code points), attachments, n_media_tokens.

    ``parts``: a column of typed parts; without it each row's text is its only part.
    """
    parts = text_part(text_or_empty(text_col)) if parts is None else parts
    raw = F.coalesce(F.col(text_col), F.lit("")) if text_col in rows.columns else F.lit("")
    # equal turns go by role and text, so that rows come in one order in every run
    turns = rows.select(F.col(id_col).alias("id"), F.col(turn_col).alias("turn"), text_or_empty(role_col).alias("role"),
                        raw.alias("raw"), parts.alias("parts"))
    head = F.concat(F.lit(TURN), escape_role(F.col("role")), F.lit("\n"))
    turns = turns.withColumn("v", visit(F.col("parts"))).withColumn("head", head)
    turns = turns.withColumn("whole", F.concat("head", "v.content", F.lit(END + "\n")))
    order = Window.partitionBy("id").orderBy("turn", "role", "raw", "parts").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turns = turns.withColumn("end", F.sum(F.length("whole").cast("long")).over(order))
    start = F.col("end") - F.length("whole") + F.length("head")
    span = F.struct(start.cast("int").alias("start"), (start + F.length("v.content")).cast("int").alias("end"))
    own = F.struct("end", "whole", F.when(F.col("role") == loss_role, span).alias("span"), F.col("v.attachments").alias("attachments"))
    # every turn adds to "end", so its order is the order of the turns
    convs = turns.groupBy("id").agg(F.sort_array(F.collect_list(own)).alias("turns"))
    media = F.flatten(F.col("turns.attachments"))
    return convs.select(F.col("id").alias(id_col), F.array_join("turns.whole", "").alias("formatted"),
                        F.array_compact("turns.span").alias("loss_spans"), media.alias("attachments"),
                        F.aggregate(media, F.lit(0).cast("long"), lambda s, m: s + F.coalesce(m["n_tokens"], F.lit(0).cast("long"))
                                    ).alias("n_media_tokens"))


def read_back(formatted: Column) -> Column:
    """Turns (role, text) of a formatted conversation of text parts."""
    blocks = F.slice(F.split(formatted, r"<\|turn\|>"), 2, F.lit(1 << 30))
    return F.transform(blocks, lambda b: F.struct(
        unescape(F.regexp_extract(b, r"^((?:[^\\\n]|\\[\s\S])*+)\n", 1)).alias("role"),
        unescape(F.regexp_extract(b, r"(?s)^(?:[^\\\n]|\\.)*+\n(.*)<\|end\|>\n$", 1)).alias("text")))


def op3_chat_formatting(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(F.lit(-7).cast(rows.schema["conv_id"].dataType).alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(probe).alias("text"))
    out = format_conversations(rows.unionByName(own))
    turns = read_back(F.col("formatted"))
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(
        F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"]))), "")
    out = out.select("conv_id", "formatted", turns.alias("turns"), loss.alias("loss"))
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(joined, 256).alias("turns_sha256"),
                      F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss"), 256).alias("loss_sha256"),
                      F.length("formatted").cast("long").alias("formatted_chars"))


#: Texts and roles as they are; only the template's own lengths and escapes enter formatted_chars.
OP3_SQL = r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, len(regexp_extract_all(role, '[\\\n]')) + len(regexp_extract_all(role, '<(\||/?s>|</?SYS>>|/?(image|audio|document)\b)|\[/?INST\]'))
          + len(regexp_extract_all(text, '\\')) + len(regexp_extract_all(text, '<(\||/?s>|</?SYS>>|/?(image|audio|document)\b)|\[/?INST\]')) AS escapes
  FROM r)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(8 + length(role) + 1 + length(text) + escapes + 8) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
