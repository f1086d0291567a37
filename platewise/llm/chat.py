"""Chat formatting with multi-party perspective rotation.

Every participant of a dialogue (every speaker but the system) gets the whole
dialogue rendered from its own side: its turns are the assistant's, those of all
others are users' with their names, system turns stay.  The loss mask covers
the assistant's words and the end marker behind each.  A dialogue longer than
``part_chars`` goes on in further parts, cut between turns by the place where a
turn starts, so a row is bounded and nothing is cut off; places come from running
totals that never gather a dialogue in one task.  DataFrame functions only.

Defined cases: turns go by number (NULL first), then speaker, then text; a NULL
text is empty, a NULL speaker is "unknown", a NULL dialogue id is an id of its
own; a dialogue with system turns only has no participant and gives no row;
equal rows are turns of their own; ``<|`` inside a text or a speaker becomes
``< |``, and a line break in a name a blank, so no text can forge a marker; an empty
table gives no rows; only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.llm.common import running_total

# The markers of the rendering.
START, END, SYSTEM = "<|im_start|>", "<|im_end|>", "system"


def perspectives(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role", text_col: str = "text",
                 part_chars: int = 1 << 15) -> DataFrame:
    """(id, perspective, part, n_turns, n_own, text, mask): mask holds the [start, end)
    code points of ``text`` that are trained on."""
    plain = lambda c: F.replace(F.col(c), F.lit("<|"), F.lit("< |"))
    speaker = F.translate(F.coalesce(plain(speaker_col), F.lit("unknown")), "\n", " ")
    turns = df.select(F.col(id_col).alias("id"), F.col(turn_col).alias("turn"), speaker.alias("speaker"),
                      F.coalesce(plain(text_col), F.lit("")).alias("body"))
    people = turns.where(F.col("speaker") != SYSTEM).select(F.col("id").alias("_id"), F.col("speaker").alias("perspective")).distinct()
    seen = turns.join(people, F.col("id").eqNullSafe(F.col("_id"))).drop("_id")
    own = F.col("speaker") == F.col("perspective")
    role = (F.when(F.col("speaker") == SYSTEM, SYSTEM).when(own, "assistant")
            .otherwise(F.concat(F.lit("user name="), F.col("speaker"))))
    head = F.concat(F.lit(START), role, F.lit("\n"))
    size = F.length(head) + F.length("body") + len(END + "\n")
    seen = running_total(seen, ["id", "perspective"], ["turn", "speaker", "body"], size, "at")
    said = F.concat(head, F.col("body"), F.lit(END + "\n"))  # made only now, so that what is sorted holds each text once
    seen = seen.select("id", "perspective", "at", own.alias("own"), F.length(head).alias("head"), said.alias("said"))
    part = seen.withColumn("part", F.floor(F.col("at") / part_chars)).groupBy("id", "perspective", "part").agg(
        F.sort_array(F.collect_list(F.struct("at", "own", "head", "said"))).alias("s"))
    begin = F.col("s")[0]["at"]
    mask = F.transform(F.filter("s", lambda x: x["own"]), lambda x: F.struct(
        (x["at"] - begin + x["head"]).alias("start"), (x["at"] - begin + F.length(x["said"]) - 1).alias("end")))
    return part.select(F.col("id").alias(id_col), "perspective", F.col("part").cast("long").alias("part"), F.size("s").cast("long").alias("n_turns"),
                       F.size(F.filter("s", lambda x: x["own"])).cast("long").alias("n_own"),
                       F.array_join(F.transform("s", lambda x: x["said"]), "").alias("text"), mask.alias("mask"))


def oracle(part_chars: int = 1 << 15) -> str:
    """The same rows in DuckDB SQL over ``conversations``, the mask as start:end, comma-joined."""
    return f"""
WITH turns AS (
  SELECT conv_id, turn, translate(coalesce(replace(role, '<|', '< |'), 'unknown'), chr(10), ' ') AS speaker,
         coalesce(replace(text, '<|', '< |'), '') AS body
  FROM conversations),
people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM turns WHERE speaker <> '{SYSTEM}'),
seen AS (
  SELECT t.*, perspective, speaker = perspective AS own,
         '{START}' || CASE WHEN speaker = '{SYSTEM}' THEN '{SYSTEM}' WHEN speaker = perspective THEN 'assistant'
                           ELSE 'user name=' || speaker END || chr(10) AS head
  FROM turns t JOIN people p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
said AS (SELECT *, head || body || '{END}' || chr(10) AS said FROM seen),
placed AS (
  SELECT *, coalesce(sum(length(said)) OVER (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, body
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS place
  FROM said),
parts AS (SELECT *, place // {part_chars} AS part, min(place) OVER (PARTITION BY conv_id, perspective, place // {part_chars}) AS begin FROM placed)
SELECT conv_id, perspective, part::BIGINT AS part, count(*) AS n_turns, count(*) FILTER (own) AS n_own,
       string_agg(said, '' ORDER BY place) AS text,
       coalesce(string_agg((place - begin + length(head)) || ':' || (place - begin + length(said) - 1), ',' ORDER BY place) FILTER (own), '') AS mask
FROM parts GROUP BY conv_id, perspective, part"""
