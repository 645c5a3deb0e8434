"""Multi-party chats seen by each participant in turn.

For every participant a dialogue is written out with that speaker as the assistant and all
others as named users; masks mark what the assistant says. Columns only: the turns of a
conversation are gathered in parts of a fixed range of turn numbers, so that a conversation
of any length never meets in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
PART_TURNS = 1024


def _clean(text: Column) -> Column:
    """Text that cannot be taken for a template mark."""
    return F.replace(F.replace(text, F.lit("<|"), F.lit("<\u200b|")), F.lit("|>"), F.lit("|\u200b>"))


def _name(role: Column) -> Column:
    """A name on one line without marks."""
    return F.regexp_replace(_clean(role), r"[\s]+", "_")


def perspectives(
    turns: DataFrame, instructions: tuple[str, ...] = ("system",), part_turns: int = PART_TURNS
) -> DataFrame:
    """conv_id, part, speaker, n_turns, n_own, text, masks of ``turns`` (conv_id, turn, role, text).

    One row for each participant and part; participants are all roles of the conversation
    with a turn, other than ``instructions``. Part p holds the turns from p * part_turns on;
    mask spans are ``start:end`` in code points of the part's text, joined by commas, and
    cover the assistant's words with the closing mark. Turns without a conversation or a
    role are left out (nobody speaks), a null text is empty, turns without a number come
    last in a part of their own (null). Turns with one number are ordered by role and text;
    repeated rows are repeated turns. A conversation of instructions only, and an empty
    table, give no rows. Other columns are not used.
    """
    said = turns.select(
        "conv_id", "turn", F.col("role").alias("speaker"), F.coalesce("text", F.lit("")).alias("said")
    ).where(F.col("conv_id").isNotNull() & F.col("speaker").isNotNull())
    part = F.floor(F.col("turn") / part_turns).cast("long")
    instructing = F.col("speaker").isin(*instructions) if instructions else F.lit(False)
    speakers = (
        said.where(~instructing).select("conv_id", F.col("speaker").alias("seen_by")).distinct()
    )
    turn = F.struct("turn", "speaker", "said")
    parts = said.groupBy("conv_id", part.alias("part")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    rotated = parts.join(speakers, "conv_id")

    def render(t: Column) -> Column:
        own = t.speaker == F.col("seen_by")
        head = (
            F.when(own, "assistant")
            .when(t.speaker.isin(*instructions), _name(t.speaker))
            .otherwise(F.concat(F.lit("user name="), _name(t.speaker)))
        )
        body = F.concat(_clean(t.said), F.lit(CLOSE))
        head = F.concat(F.lit(OPEN), head, F.lit("\n"))
        return F.struct(own.alias("own"), F.length(head).alias("head"), F.length(body).alias("body"),
                        F.concat(head, body, F.lit("\n")).alias("line"))

    written = rotated.select("conv_id", "part", "seen_by", F.transform("turns", render).alias("lines"))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("spans"))

    def step(acc: Column, line: Column) -> Column:
        low = acc.at + line.head
        span = F.concat(low.cast("string"), F.lit(":"), (low + line.body).cast("string"))
        return F.struct(
            (low + line.body + 1).alias("at"),
            F.when(~line.own, acc.spans)
            .when(acc.spans == "", span)
            .otherwise(F.concat(acc.spans, F.lit(","), span))
            .alias("spans"),
        )

    return written.select(
        "conv_id",
        "part",
        F.col("seen_by").alias("speaker"),
        F.size("lines").cast("long").alias("n_turns"),
        F.size(F.filter("lines", lambda x: x.own)).cast("long").alias("n_own"),
        F.array_join(F.transform("lines", lambda x: x.line), "").alias("text"),
        F.aggregate("lines", start, step, lambda a: a.spans).alias("masks"),
    )


SQL = r"""
WITH said AS (
  SELECT conv_id, turn, role AS speaker, coalesce(text, '') AS said,
         CAST(floor(turn / 1024.0) AS BIGINT) AS part
  FROM conversations WHERE conv_id IS NOT NULL AND role IS NOT NULL),
speakers AS (SELECT DISTINCT conv_id, speaker AS seen_by FROM said WHERE speaker <> 'system'),
lines AS (
  SELECT s.conv_id, s.part, s.turn, s.speaker, s.said, p.seen_by, s.speaker = p.seen_by AS own,
         '<|im_start|>' || CASE WHEN s.speaker = p.seen_by THEN 'assistant'
           WHEN s.speaker = 'system' THEN 'system' ELSE 'user name=' || s.name END || chr(10) AS head,
         s.body || '<|im_end|>' AS body
  FROM (SELECT *,
          regexp_replace(replace(replace(speaker, '<|', '<' || chr(8203) || '|'),
            '|>', '|' || chr(8203) || '>'), '\s+', '_', 'g') AS name,
          replace(replace(said, '<|', '<' || chr(8203) || '|'), '|>', '|' || chr(8203) || '>') AS body
        FROM said) s
  JOIN speakers p USING (conv_id)),
placed AS (
  SELECT *, row_number() OVER w AS pos,
    coalesce(sum(length(head) + length(body) + 1) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING
      AND 1 PRECEDING), 0) AS low
  FROM lines WINDOW w AS (PARTITION BY conv_id, part, seen_by ORDER BY turn, speaker, said))
SELECT conv_id, part, seen_by AS speaker, count(*) AS n_turns,
  count(*) FILTER (WHERE own) AS n_own,
  string_agg(head || body || chr(10), '' ORDER BY pos) AS text,
  coalesce(string_agg(CAST(low + length(head) AS BIGINT) || ':' ||
    CAST(low + length(head) + length(body) AS BIGINT), ',' ORDER BY pos) FILTER (WHERE own), '') AS masks
FROM placed GROUP BY conv_id, part, seen_by
"""
