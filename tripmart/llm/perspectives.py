"""Multi-party perspective rotation of conversations.

Every participant is the assistant once: its turns become assistant turns that
are trained on, the other participants become named users, and the masks say
which characters count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTEXT = ("system",)
NAMELESS = "unknown"


def perspectives(
    turns: DataFrame,
    *,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    context: tuple[str, ...] = CONTEXT,
    part_turns: int = 1024,
) -> DataFrame:
    """``conv_id, part, speaker, messages, text, mask, n_turns, n_trained``.

    One row for every participant of a conversation; with more than
    ``part_turns`` turns, one row for every run of that many turn numbers, so no
    row holds an unbounded dialogue. Roles in ``context`` are no participants and
    are rendered as they are. ``messages`` are structs of ``role, name, content,
    trained``; ``text`` renders them, an opening ``<|`` within names and contents
    written ``< |``, a closing ``|>`` in names ``| >`` and line breaks there blanks, so that
    only the template has markers (names that this makes equal are one participant); ``mask`` has one struct
    ``start, end`` for each message that counts: the characters of its content
    and end marker, from 0, end excluded.

    Turns are ordered by turn, null first, then name and text; repeated rows are
    repeated turns. A null role is the participant ``unknown``, a null text is
    empty, a null turn number belongs to part 0. A participant who is silent in
    a part gets it with an empty mask. Turns without a conversation id belong to
    no dialogue; they give no row, nor does a conversation without participants.
    An empty table gives no rows.
    """
    marker = F.lit("<|")
    picked = turns.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).alias("conv_id"),
        F.coalesce(F.floor(F.col(turn) / part_turns), F.lit(0)).cast("long").alias("part"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(_name(F.replace(F.col(role), marker, F.lit("< |"))), F.lit(NAMELESS)).alias("who"),
            F.coalesce(F.replace(F.col(text), marker, F.lit("< |")), F.lit("")).alias("content"),
        ).alias("said"),
    )
    dialogues = picked.groupBy("conv_id", "part").agg(
        F.array_sort(F.collect_list("said")).alias("said")
    )
    speakers = (
        picked.select("conv_id", F.col("said.who").alias("speaker"))
        .where(~F.col("speaker").isin(*context))
        .distinct()
    )
    return dialogues.join(speakers, "conv_id").select("conv_id", "part", "speaker", *_rendered(context))


def _name(role: Column) -> Column:
    """A name that does not close its header: no ``|>`` and no line break."""
    return F.translate(F.replace(role, F.lit("|>"), F.lit("| >")), "\n\r", "  ")


def _rendered(context: tuple[str, ...]) -> list[Column]:
    def message(said: Column) -> Column:
        who, speaker = said["who"], F.col("speaker")
        trained = who == speaker
        kind = (
            F.when(trained, F.lit("assistant"))
            .when(who.isin(*context), who)
            .otherwise(F.lit("user"))
        )
        name = F.when(~trained & ~who.isin(*context), who)
        return F.struct(
            kind.alias("role"), name.alias("name"), said["content"].alias("content"),
            trained.alias("trained"),
        )

    def head(m: Column) -> Column:
        return F.concat(
            F.lit("<|"), m["role"], F.coalesce(F.concat(F.lit(" name="), m["name"]), F.lit("")),
            F.lit("|>\n"),
        )

    tail = F.lit("<|end|>\n")
    messages = F.transform("said", message)
    text = F.array_join(F.transform(messages, lambda m: F.concat(head(m), m["content"], tail)), "")

    # one walk along the messages keeps the place reached and the spans so far
    def step(acc: Column, m: Column) -> Column:
        start = acc["at"] + F.length(head(m))
        end = start + F.length(m["content"]) + F.length(F.lit("<|end|>"))
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(
            (end + 1).alias("at"),
            F.when(m["trained"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"),
        )

    empty = F.struct(
        F.lit(0).alias("at"),
        F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("spans"),
    )
    mask = F.aggregate(messages, empty, step, lambda acc: acc["spans"])
    return [
        messages.alias("messages"),
        text.alias("text"),
        mask.alias("mask"),
        F.size("said").cast("long").alias("n_turns"),
        F.size(F.filter("said", lambda s: s["who"] == F.col("speaker"))).cast("long").alias("n_trained"),
    ]


def op4_perspectives(spark, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    spans = F.transform("mask", lambda m: F.concat_ws("-", m["start"], m["end"]))
    return perspectives(turns).select(
        "conv_id", "part", "speaker", "n_turns", "n_trained", "text",
        F.array_join(spans, ",").alias("mask"),
    )


OP4_SQL = r"""
WITH t AS (
  SELECT conv_id, coalesce(floor(turn / 1024.0), 0)::BIGINT AS part, turn,
    coalesce(translate(replace(replace(role, '<|', '< |'), '|>', '| >'), chr(10) || chr(13), '  '), 'unknown') AS who,
    coalesce(replace(text, '<|', '< |'), '') AS content
  FROM conversations WHERE conv_id IS NOT NULL
), n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, part
    ORDER BY turn NULLS FIRST, who, content) AS k FROM t
), s AS (
  SELECT DISTINCT conv_id, who AS speaker FROM t WHERE who <> 'system'
), m AS (
  SELECT n.conv_id, part, k, speaker, content, who = speaker AS trained,
    '<|' || CASE WHEN who = speaker THEN 'assistant' WHEN who = 'system' THEN who
      ELSE 'user name=' || who END || '|>' || chr(10) AS head
  FROM n JOIN s ON n.conv_id = s.conv_id
), p AS (
  SELECT *, coalesce(sum(length(head) + length(content) + 8) OVER (PARTITION BY conv_id, part, speaker
    ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT + length(head) AS start
  FROM m
)
SELECT conv_id, part, speaker, count(*) AS n_turns,
  count(*) FILTER (WHERE trained) AS n_trained,
  string_agg(head || content || '<|end|>' || chr(10), '' ORDER BY k) AS text,
  coalesce(string_agg(start || '-' || (start + length(content) + 7), ',' ORDER BY k)
    FILTER (WHERE trained), '') AS mask
FROM p GROUP BY conv_id, part, speaker
"""
