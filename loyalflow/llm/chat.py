"""Chat formatting with perspective rotation, in DataFrame operations only.

Every participant of a dialogue is the assistant once: their messages become
assistant turns, all others become users named after their speaker, and the mask
covers what the assistant says. A long dialogue is rendered in parts of a bounded
number of messages; the parts of a perspective, joined, are its whole dialogue.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loyalflow.operators.ranking import positions

#: Fixed role that is nobody's perspective, and the marks of the format.
INSTRUCTIONS = "system"
START, END = "<|im_start|>", "<|im_end|>\n"
NOBODY = "unknown"
_ASSISTANT, _SYSTEM, _USER = f"{START}assistant\n", f"{START}system\n", f"{START}user name="


def escaped(text: Column) -> Column:
    """``text`` without any mark of the format: one more backslash stands between ``<`` and ``|``, so that it can be undone."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def escaped_name(name: Column) -> Column:
    """The same for a name, which also stays on its line."""
    for char, code in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        name = F.replace(name, F.lit(char), F.lit(code))
    return escaped(name)


def placed(turns: DataFrame, conv_col: str, turn_col: str, speaker_col: str, text_col: str) -> DataFrame:
    """(conv_id, speaker, content, at): every message with its place in the dialogue, from 0.

    Messages stand by turn, then speaker (null first), then the MD5 of their text.
    Places come from distributed positions over digests, so a dialogue that holds
    a third of all rows is split among tasks; texts meet them in one join on keys
    of which none repeats (equal rows are counted first, and dealt out after).
    """
    content = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    speaker = F.col(speaker_col).cast("string")
    rows = turns.where(F.col(conv_col).isNotNull() & F.col(turn_col).isNotNull()).select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), speaker.isNotNull().alias("named"),
        F.coalesce(speaker, F.lit("")).alias("speaker"), F.md5(content).alias("digest"), content.alias("content"))
    keys = ["conv_id", "turn", "named", "speaker", "digest"]
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    where = positions(counted, ["conv_id"], ["turn", "named", "speaker", "digest"], "copies").select(*keys, "copies", "_start")
    texts = rows.groupBy(*keys).agg(F.first("content").alias("content"))
    return texts.join(where, keys).select(
        "conv_id", F.when(F.col("named"), F.col("speaker")).alias("speaker"), "content",
        F.explode(F.sequence(F.col("_start"), F.col("_start") + F.col("copies") - 1)).alias("at"))


def rotate(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role",
           text_col: str = "text", messages_per_part: int = 512) -> DataFrame:
    """One row per dialogue, participant of the dialogue and part of it.

    Columns: conv_id, part, perspective, n_messages, n_assistant, start, text and
    mask. Participants are those of the whole dialogue, and each has every part,
    also those in which they are silent. ``start`` is the part's place in the
    perspective's whole text, in code points; mask are the spans ``start:end`` (end
    exclusive, comma-joined) of the assistant's contents in that whole text. A part
    holds ``messages_per_part`` messages, by their place.

    Messages stand by turn, then speaker, then the MD5 of the text; equal rows are
    rendered each. A null text is empty. A null speaker is a user named
    ``unknown`` and no participant; ``system`` messages stay system and are no
    participant. Marks of the format in texts and names are escaped, and line ends
    in names. A row whose dialogue or turn is null has no known neighbours and is
    a dialogue of its own (part null). A dialogue without participants has no
    perspective and gives no row.
    """
    known = placed(turns, conv_col, turn_col, speaker_col, text_col).select(
        "conv_id", F.floor(F.col("at") / messages_per_part).cast("long").alias("part"), F.lit(None).cast("long").alias("alone"),
        F.col("at"), "speaker", "content")
    alone = turns.where(F.col(conv_col).isNull() | F.col(turn_col).isNull()).select(
        F.col(conv_col).alias("conv_id"), F.lit(None).cast("long").alias("part"), F.monotonically_increasing_id().alias("alone"),
        F.lit(0).cast("long").alias("at"), F.col(speaker_col).cast("string").alias("speaker"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("content"))

    def widths(m: DataFrame) -> DataFrame:
        """Names, contents and headers as shown, for all who are not the speaker."""
        shown = F.when(F.col("speaker") == INSTRUCTIONS, F.lit(_SYSTEM)).otherwise(
            F.concat(F.lit(_USER), escaped_name(F.coalesce("speaker", F.lit(NOBODY))), F.lit("\n")))
        return m.withColumn("content", escaped(F.col("content"))).withColumn("head", shown)

    is_part = F.col("speaker").isNotNull() & (F.col("speaker") != INSTRUCTIONS)
    message = F.struct("at", "speaker", "head", "content")

    # whole dialogues: where each part begins in each perspective
    known = widths(known)
    size = F.length("head") + F.length("content") + len(END)
    parts = known.groupBy("conv_id", "part").agg(F.sum(size).alias("size"))
    spoken = known.where(is_part).groupBy("conv_id", "part", F.col("speaker").alias("perspective")).agg(
        F.sum(F.lit(len(_ASSISTANT)) - F.length("head")).alias("shift"))
    people = spoken.select("conv_id", "perspective").distinct()
    before = Window.partitionBy("conv_id", "perspective").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    views = (parts.join(people, "conv_id").join(spoken, ["conv_id", "part", "perspective"], "left")
             .withColumn("start", F.coalesce(F.sum(F.col("size") + F.coalesce("shift", F.lit(0))).over(before), F.lit(0)))
             .select("conv_id", "part", "perspective", "start"))
    held = known.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(message)).alias("ms"))
    whole = held.join(views, ["conv_id", "part"]).select("conv_id", "part", "perspective", "start", "ms")
    single = widths(alone).where(is_part).select(
        "conv_id", "part", F.col("speaker").alias("perspective"), F.lit(0).cast("long").alias("start"), F.array(message).alias("ms"))
    return _rendered(whole.unionByName(single))


def _rendered(views: DataFrame) -> DataFrame:
    """Text and mask of each view of a part."""
    mine = lambda m: F.coalesce(m["speaker"] == F.col("perspective"), F.lit(False))
    shown = F.transform("ms", lambda m: F.struct(
        F.when(mine(m), F.lit(_ASSISTANT)).otherwise(m["head"]).alias("head"), m["content"].alias("content"), mine(m).alias("mine")))
    walked = F.aggregate(
        "_shown", F.struct(F.col("start").cast("long").alias("at"), F.array().cast("array<string>").alias("spans")),
        lambda s, x: F.struct(
            (s["at"] + F.length(x["head"]) + F.length(x["content"]) + len(END)).alias("at"),
            F.when(x["mine"], F.concat(s["spans"], F.array(F.concat_ws(
                ":", (s["at"] + F.length(x["head"])).cast("string"),
                (s["at"] + F.length(x["head"]) + F.length(x["content"])).cast("string")))))
            .otherwise(s["spans"]).alias("spans")))
    return (views.withColumn("_shown", shown).withColumn("_walked", walked)
            .select("conv_id", "part", "perspective", F.size("ms").cast("long").alias("n_messages"),
                    F.size("_walked.spans").cast("long").alias("n_assistant"), F.col("start").cast("long").alias("start"),
                    F.array_join(F.transform("_shown", lambda x: F.concat(x["head"], x["content"], F.lit(END))), "").alias("text"),
                    F.array_join("_walked.spans", ",").alias("mask")))
