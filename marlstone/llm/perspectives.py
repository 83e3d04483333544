"""Multi-party dialogues from the side of every participant.

For each speaker of a conversation the whole dialogue is rendered with that speaker
as the assistant and the others as named users, with a mask of what is to be learned:
the speaker's own words and end marks.

A rendering is cut into parts of about ``PART`` characters, one row each, so a very
long conversation is no single row and no single task: offsets are running sums over
ordered runs, and a part is put together from the turns that begin in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import before, in_runs, join_safe

PART = 16384
UNNAMED = "unknown"
ASSISTANT, USER, END = "<|assistant|>\n", ("<|user name=", "|>\n"), "<|end|>\n"


def rotate(turns: DataFrame, part: int = PART) -> DataFrame:
    """``conv_id, assistant, part, start, text, spans``; ``spans``: ``begin, content, end, speaker, learned``.

    ``turns`` needs ``conv_id, turn, role, text``; other columns are ignored. ``start`` is the
    part's offset in the rendering; spans are offsets within the part, one per turn
    that begins in it: the header runs from ``begin`` to ``content``, and ``content`` to ``end``
    is learned or not. Turns follow their number, nulls first, then speaker and text;
    a null role is the speaker ``unknown``, a null text is empty, null ids are one
    conversation; repeated turns are rendered as often as they occur; an empty
    table gives no rows.
    """
    said = turns.select("conv_id", "turn", F.coalesce("role", F.lit(UNNAMED)).alias("speaker"),
                        F.coalesce("text", F.lit("")).alias("text"))
    people = said.select("conv_id", F.col("speaker").alias("assistant")).distinct()
    rows = join_safe(said, people, ["conv_id"]).withColumn("own", F.col("speaker") == F.col("assistant"))
    header = F.when(F.col("own"), F.lit(ASSISTANT)).otherwise(F.concat(F.lit(USER[0]), F.col("speaker"), F.lit(USER[1])))
    rows = rows.withColumns({"header": header, "_h": F.xxhash64("text")})
    rows = rows.withColumn("piece", F.concat("header", "text", F.lit(END)))
    order = ["turn", "speaker", "_h"]
    runs = in_runs(rows, ["conv_id", "assistant"], order)
    placed = before(runs, ["conv_id", "assistant"], order, {"at": F.length("piece").cast("long")})
    placed = placed.withColumn("part", F.floor(F.col("at") / part))
    item = F.struct("at", "piece", F.length("header").alias("head"), "speaker", "own")
    grouped = placed.groupBy("conv_id", "assistant", "part").agg(F.sort_array(F.collect_list(item)).alias("items"))
    start = F.col("items")[0]["at"]
    spans = F.transform("items", lambda x: F.struct(
        (x["at"] - start).alias("begin"), (x["at"] - start + x["head"]).alias("content"),
        (x["at"] - start + F.length(x["piece"])).alias("end"), x["speaker"].alias("speaker"), x["own"].alias("learned")))
    return grouped.select("conv_id", "assistant", "part", start.alias("start"),
                          F.array_join(F.transform("items", lambda x: x["piece"]), "").alias("text"), spans.alias("spans"))
