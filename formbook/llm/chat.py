"""Chat formatting by event-sourced reconstruction.

A conversation log is a table of events: (conv_id, seq, message, op, role, text).

* ``message`` gives a message's whole text, ``delta`` adds to it (streaming);
* ``edit`` replaces the text so far;
* ``regenerate`` empties the message, and drops the messages that began after
  it and before the regenerate; deltas that follow stream the new text.

``fold`` partitions the log by conversation, sorts it by sequence and folds it
into final messages; ``render`` writes them in a template and keeps the loss
mask; ``read_back`` parses what was written.

Template: ``<|im_start|>{role}\\n{text}<|im_end|>\\n``. Inside roles and texts, "<", any number of backslashes
and "|" get one backslash more, so no control string can be forged and the
escape can be undone; new lines and backslashes of roles are escaped as well.

Scale: one shuffle, by conversation; windows and groups reuse it. A message's deltas are
combined before, and a conversation's messages meet in one row because the
result is one string for each conversation.

Edge cases: null texts and roles are empty; a null sequence comes first; events that tie on the sequence go
by role, then text; repeated rows are kept; a null conversation id is a
conversation; an empty log gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: The template's control strings.
START, END = "<|im_start|>", "<|im_end|>"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<$1\\|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<\\(\\*)\|", "<$1|")


def escape_role(c: Column) -> Column:
    return escape(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(c: Column) -> Column:
    lines = F.transform(F.split(unescape(c), r"\\\\", -1), lambda x: F.replace(x, F.lit("\\n"), F.lit("\n")))
    return F.array_join(lines, "\\")


def as_events(turns: DataFrame, *, conv: str = "conv_id", seq: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A table of finished turns as a log: every row is a message of its own."""
    own = F.struct(F.col(seq).cast("long"), F.coalesce(F.col(role), F.lit("")), F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    return turns.select(
        F.col(conv).alias("conv_id"), F.col(seq).cast("long").alias("seq"), F.to_json(own).alias("message"), F.lit("message").alias("op"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    )


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, messages): messages is an array of struct(seq, role, text), in order."""
    in_message = W.partitionBy("conv_id", "message")
    events = events.withColumn("seq", F.coalesce("seq", F.lit(-(2**62)))).repartition("conv_id")
    resets = F.max(F.when(F.col("op").isin("edit", "regenerate"), F.col("seq"))).over(in_message)
    live = events.withColumn("reset", resets).withColumn("began", F.min("seq").over(in_message))
    live = live.withColumn("again", F.when(F.col("op") == "regenerate", F.col("seq")))
    piece = F.when((F.col("seq") >= F.coalesce("reset", "seq")) & ~F.col("op").eqNullSafe("regenerate"), F.struct("seq", "role", "text"))
    # Whole messages that repeat (same turn, role and text) stay as many as they are.
    messages = live.groupBy("conv_id", "message", "began").agg(
        F.sort_array(F.collect_list(piece)).alias("pieces"), F.max("role").alias("role"), F.max("again").alias("again"),
        F.count_if(F.col("op") == "message").alias("whole"), F.count_if(F.col("op") != "message").alias("others"),
    )
    joined = F.array_join(F.transform("pieces", lambda p: p["text"]), "")
    texts = F.when((F.col("whole") > 1) & (F.col("others") == 0), F.transform("pieces", lambda p: p["text"])).otherwise(F.array(joined))
    # A message is dropped if an earlier message was regenerated after this one began.
    earlier = W.partitionBy("conv_id").orderBy("began").rangeBetween(W.unboundedPreceding, -1)
    replayed = F.coalesce(F.max("again").over(earlier) > F.col("began"), F.lit(False))
    kept = messages.withColumn("replayed", replayed).where(~F.col("replayed")).withColumn("text", F.explode(texts))
    return kept.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(F.col("began").alias("seq"), "role", "text"))).alias("messages"))


def render(folded: DataFrame, learn: str = "assistant") -> DataFrame:
    """(conv_id, formatted, loss_mask): the mask lists block, offset and length (code points) of each text to learn from."""
    blocks = F.transform("messages", lambda m: F.struct(F.concat(F.lit(START), escape_role(m["role"]), F.lit("\n")).alias("head"), escape(m["text"]).alias("body"), (m["role"] == learn).alias("learn")))
    out = folded.select("conv_id", blocks.alias("blocks"))
    mask = F.transform("blocks", lambda b, i: F.struct(i.alias("block"), F.char_length(b["head"]).alias("offset"), F.char_length(b["body"]).alias("length"), b["learn"].alias("learn")))
    mask = F.transform(F.filter(mask, lambda m: m["learn"]), lambda m: F.struct(m["block"].alias("block"), m["offset"].alias("offset"), m["length"].alias("length")))
    formatted = F.array_join(F.transform("blocks", lambda b: F.concat(b["head"], b["body"], F.lit(END + "\n"))), "")
    return out.select("conv_id", formatted.alias("formatted"), mask.alias("loss_mask"))


def read_back(rendered: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns, loss_text) from the formatted string and its mask alone."""
    blocks = F.split("formatted", F.lit(r"<\|im_end\|>\n"), -1)
    parsed = rendered.withColumn("b", F.slice(blocks, 1, F.size(blocks) - 1))

    def turn(b: Column) -> Column:
        head = F.substring_index(b, "\n", 1)
        role = F.substring(head, F.lit(len(START) + 1), F.char_length(head))
        return F.struct(unescape_role(role).alias("role"), unescape(F.substring(b, F.char_length(head) + 2, F.char_length(b))).alias("text"))

    learned = F.transform("loss_mask", lambda m: unescape(F.substring(F.element_at("b", m["block"] + 1), m["offset"] + 1, m["length"])))
    return parsed.select("conv_id", "formatted", F.transform("b", turn).alias("turns"), F.array_join(learned, "").alias("loss_text"))


def chat_report(turns: DataFrame) -> DataFrame:
    """Digests of every conversation as read back from its formatted string."""
    back = read_back(render(fold(as_events(turns))))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"), F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"), F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
