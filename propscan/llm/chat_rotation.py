"""Chat formatting: every participant's perspective of a dialogue.

For each participant of a conversation the dialogue is rendered with that speaker as assistant and
the others as named users. The result is one row a perspective and turn, with the rendered segment,
its place in the rendered dialogue and the span that counts for the loss, so a conversation of any
length is never one value in one task; a loader joins segments by ``position``. Column expressions
only.

Places are two-level running sums (blocks of turns, then within a block), as one conversation may hold
a large share of all turns. Blocks and their sums are made of columns without texts. Texts are shuffled
once, by (conversation, block): the perspectives of a block come to them with the block's sums by the same
key, and the window within a block is over that key too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Turns of a conversation that are ordered together.
BLOCK_TURNS = 64
END = "<|end|>\n"


def plain(text: Column) -> Column:
    """``text`` without the marks of a turn: ``<|`` becomes ``< |`` and ``|>`` becomes ``| >``."""
    return F.replace(F.replace(text, F.lit("<|"), F.lit("< |")), F.lit("|>"), F.lit("| >"))


def rotate(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", fixed_roles: tuple[str, ...] = ("system",), block: int = BLOCK_TURNS) -> DataFrame:
    """Return ``conv_id, perspective, position, turn, rendered_role, segment, start, mask_start, mask_end``.

    * ``perspective``: each distinct speaker of the conversation, but those in ``fixed_roles``, who are
      rendered as themselves in every perspective. A null speaker is ``unknown``.
    * ``segment``: ``<|role name=speaker|>`` (``<|assistant|>`` for the perspective's own turns), line
      break, text, ``<|end|>``, line break. A null text is empty. Names and texts can't forge a turn:
      see ``plain``.
    * ``start``: code points before the segment in this perspective's dialogue (long);
      ``mask_start, mask_end``: the span of text and end mark, of own turns only, in the same count;
      null for others.
    * Turns are ordered by turn (nulls first), then speaker and text; ``position`` counts from 0.
      Repeated rows stay, in this order. Rows without a conversation id form one conversation. An
      empty table, or only fixed speakers, gives no rows. Other columns are ignored.

    Rows of one turn number share a block; rows without a number are dealt by speaker and the beginning
    of the text.
    """
    rows = turns.select(
        F.struct(F.col(conv_col).isNotNull().alias("known"), F.col(conv_col).alias("id")).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        plain(F.coalesce(F.col(role_col).cast("string"), F.lit("unknown"))).alias("speaker"), plain(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("body"),
    )
    loose = F.col("turn").isNull()
    rows = rows.withColumn("block", F.struct(F.coalesce(F.floor(F.col("turn") / block), F.lit(-(1 << 62))).alias("at"), F.when(loose, F.col("speaker")).alias("who"), F.when(loose, F.substring("body", 1, 3)).alias("head")))

    # Sums of blocks a perspective; no text is moved.
    own, fixed = F.col("speaker") == F.col("perspective"), F.col("speaker").isin(*fixed_roles)
    head = F.when(own, F.lit("<|assistant|>\n")).when(fixed, F.concat(F.lit("<|"), "speaker", F.lit("|>\n"))).otherwise(F.concat(F.lit("<|user name="), "speaker", F.lit("|>\n")))
    totals = rows.groupBy("conv", "block", "speaker").agg(F.count("*").alias("n"), F.sum(F.length("body")).alias("chars"))
    speakers = rows.select("conv", F.col("speaker").alias("perspective")).where(~F.col("perspective").isin(*fixed_roles)).distinct()
    t = totals.join(speakers, "conv").withColumn("size", F.col("chars") + F.col("n") * (F.length(head) + F.lit(len(END))))
    t = t.groupBy("conv", "perspective", "block").agg(F.sum("size").alias("size"), F.sum("n").alias("n"))
    before = Window.partitionBy("conv", "perspective").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = t.select("conv", "block", "perspective", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base_n"))

    # Texts meet their block's perspectives; the window within a block needs no further exchange.
    seen = rows.join(bases, ["conv", "block"]).withColumn("head", head)
    seen = seen.withColumn("size", (F.length("head") + F.length("body") + F.lit(len(END))).cast("long"))
    upto = Window.partitionBy("conv", "block", "perspective").orderBy("turn", "speaker", "body").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = seen.withColumn("start", F.col("base") + F.sum("size").over(upto) - F.col("size")).withColumn("position", F.col("base_n") + F.count("*").over(upto) - 1)
    return seen.select(
        F.col("conv.id").alias("conv_id"), "perspective", "position", "turn",
        F.when(own, F.lit("assistant")).when(fixed, F.col("speaker")).otherwise(F.lit("user")).alias("rendered_role"),
        F.concat("head", "body", F.lit(END)).alias("segment"), "start",
        F.when(own, F.col("start") + F.length("head")).alias("mask_start"), F.when(own, F.col("start") + F.col("size") - 1).alias("mask_end"),
    )


ORACLE_SQL = r"""
with a as (select conv_id, turn, replace(replace(coalesce(role, 'unknown'), '<|', '< |'), '|>', '| >') as speaker, replace(replace(coalesce(text, ''), '<|', '< |'), '|>', '| >') as body from conversations),
p as (select distinct conv_id, speaker as perspective from a where speaker <> 'system'),
s as (select a.*, perspective, case when speaker = perspective then '<|assistant|>' || chr(10) when speaker = 'system' then '<|system|>' || chr(10)
        else '<|user name=' || speaker || '|>' || chr(10) end as head from a join p on a.conv_id is not distinct from p.conv_id),
w as (select *, length(head) + length(body) + 8 as size,
        sum(length(head) + length(body) + 8) over (partition by conv_id, perspective order by turn nulls first, speaker, body rows unbounded preceding) as upto,
        row_number() over (partition by conv_id, perspective order by turn nulls first, speaker, body) - 1 as position from s)
select conv_id, perspective, position, turn, case when speaker = perspective then 'assistant' when speaker = 'system' then speaker else 'user' end as rendered_role,
  head || body || '<|end|>' || chr(10) as segment, cast(upto - size as bigint) as start,
  cast(case when speaker = perspective then upto - size + length(head) end as bigint) as mask_start,
  cast(case when speaker = perspective then upto - 1 end as bigint) as mask_end from w
"""
