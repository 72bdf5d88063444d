"""Preference formatting: the longest common turn prefix of two conversations as one prompt, and two masked completions.

Turns are put in order by number (then role and text), compared by role and
text, and rendered as ``<|im_start|>role\ntext<|im_end|>\n``.  The common prefix
is rendered once.  A completion is the rest of its conversation; its mask lists
the character spans to be trained on: the texts of assistant turns with their
end marks.  Markers inside a text are broken up (``<|im_`` becomes ``<| im_``).

Only DataFrame functions are used.  The two conversations of a pair meet in one
shuffle; a row holds one pair, whatever number of pairs share their turns.

Defined results: a null text counts as empty, a null role as ``unknown``; null
turn numbers come first and ties are ordered by role and text; a side without
turns has an empty completion; ``status`` tells equal pairs, pairs of which one
side is the other's prefix, and pairs without an assistant turn to train on
from proper ones; rows with a null conversation or pair id are left out of
pairs; an empty table gives no rows; other columns are not read, whatever their
names.

``replaced_replies`` makes preference pairs of a plain table of conversations:
each conversation is chosen over its own turns up to the last assistant turn
with the last reply of its neighbour in that turn's place.  A conversation whose
neighbour has no reply is paired with those turns alone, one without an
assistant turn with itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, table

START, END = "<|im_start|>", "<|im_end|>"


def _head(turn: Column) -> Column:
    return F.concat(F.lit(START), turn["role"], F.lit("\n"))


def _body(turn: Column) -> Column:
    return F.concat(turn["text"], F.lit(END))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t), F.lit("\n"))), "")


def _spans(turns: Column) -> Column:
    """Character spans [s, e) of the trained parts of rendered turns."""
    empty = F.array().cast("array<struct<s:int,e:int>>")
    start = F.struct(F.lit(0).alias("at"), empty.alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        s = acc["at"] + F.length(_head(t))
        e = s + F.length(_body(t))
        span = F.when(t["role"] == "assistant", F.array(F.struct(s.alias("s"), e.alias("e")))).otherwise(empty)
        return F.struct((e + F.lit(1)).alias("at"), F.concat(acc["spans"], span).alias("spans"))

    return F.aggregate(turns, start, step, lambda acc: acc["spans"])


def _turn(turn: str, role: str, text: str) -> Column:
    return F.struct(
        F.col(f"`{turn}`").cast("bigint").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("unknown")).alias("role"),
        F.replace(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), F.lit("<|im_"), F.lit("<| im_")).alias("text"),
    )


def _sides(rows: DataFrame) -> DataFrame:
    """id, ids and sorted turns of both sides, of rows (id, side, conv, t)."""

    def side(i: int, what: str) -> Column:
        return F.when(F.col("side") == i, F.col(what))

    return rows.groupBy("id").agg(
        F.max(side(0, "conv")).alias("a_id"),
        F.max(side(1, "conv")).alias("b_id"),
        F.sort_array(F.collect_list(side(0, "t"))).alias("a"),
        F.sort_array(F.collect_list(side(1, "t"))).alias("b"),
    )


def preference_pairs(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """pair_id, chosen_id, rejected_id, n_common_turns, prompt, chosen, chosen_mask, rejected, rejected_mask, status.

    ``turns`` also has pair_id and side (0 chosen, 1 rejected); see ``with_pairs``.
    """
    rows = turns.where(F.col("pair_id").isNotNull() & F.col(f"`{conv}`").isNotNull()).select(F.col("pair_id").alias("id"), "side", F.col(f"`{conv}`").alias("conv"), _turn(turn, role, text).alias("t"))
    return format_pairs(_sides(rows).select(F.col("id").alias("pair_id"), F.col("a_id").alias("chosen_id"), F.col("b_id").alias("rejected_id"), "a", "b"))


def replaced_replies(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """pair_id and chosen_id (the conversation), rejected_id (whose reply it gets), a and b (the turns of both sides); neighbours are 2 k and 2 k + 1."""
    c = F.col(f"`{conv}`").cast("bigint")
    rows = turns.where(c.isNotNull()).select(F.floor(c / 2).cast("bigint").alias("id"), F.pmod(c, F.lit(2)).cast("int").alias("side"), c.alias("conv"), _turn(turn, role, text).alias("t"))

    def one(own: str, other: str) -> Column:
        return F.struct(F.col(f"{own}_id").alias("pair_id"), F.col(f"{other}_id").alias("other_id"), F.col(own).alias("a"), F.col(other).alias("o"))

    def last_reply(turns: Column) -> Column:
        """The place of the last assistant turn, counted from 1; 0: none."""
        back = F.array_position(F.reverse(F.transform(turns, lambda t: t["role"] == "assistant")), True)
        return F.when(back > 0, F.size(turns) - back + 1).otherwise(0).cast("int")

    both = _sides(rows).select(F.inline(F.array(one("a", "b"), one("b", "a")))).where("pair_id is not null")
    both = both.withColumn("at", last_reply(F.col("a"))).withColumn("theirs", last_reply(F.col("o")))
    reply = F.struct(F.get("a", F.col("at") - 1)["turn"].alias("turn"), F.lit("assistant").alias("role"), F.get("o", F.col("theirs") - 1)["text"].alias("text"))
    before = F.slice("a", 1, F.greatest(F.col("at") - 1, F.lit(0)))
    given = (F.col("at") > 0) & (F.col("theirs") > 0)
    b = F.when(F.col("at") == 0, F.col("a")).when(given, F.concat(before, F.array(reply))).otherwise(before)
    return both.select("pair_id", F.col("pair_id").alias("chosen_id"), F.when(given, F.col("other_id")).alias("rejected_id"), "a", b.alias("b"))


def format_pairs(pairs: DataFrame) -> DataFrame:
    """The columns of ``preference_pairs`` from pair_id, chosen_id, rejected_id and the turns of both sides, a and b, in order."""
    same = F.zip_with("a", "b", lambda x, y: x.isNotNull() & y.isNotNull() & (x["role"] == y["role"]) & (x["text"] == y["text"]))
    differ = F.array_position(F.transform(same, lambda x: F.coalesce(x, F.lit(False))), False)
    common = F.when(differ > 0, differ - 1).otherwise(F.size(same)).cast("int")
    pairs = pairs.withColumn("n", common)
    rest_a, rest_b = (F.slice(c, F.col("n") + 1, F.greatest(F.size(c) - F.col("n"), F.lit(0))) for c in ("a", "b"))
    cut = pairs.select("pair_id", "chosen_id", "rejected_id", "n", F.slice("a", 1, F.col("n")).alias("p"), rest_a.alias("x"), rest_b.alias("y"))

    def trains(c: str) -> Column:
        return F.exists(c, lambda t: t["role"] == "assistant")

    status = F.when((F.size("x") == 0) & (F.size("y") == 0), "equal").when((F.size("x") == 0) | (F.size("y") == 0), "prefix").when(trains("x") & trains("y"), "pair").otherwise("untrained")
    return cut.select(
        "pair_id",
        "chosen_id",
        "rejected_id",
        F.col("n").cast("bigint").alias("n_common_turns"),
        _render(F.col("p")).alias("prompt"),
        _render(F.col("x")).alias("chosen"),
        _spans(F.col("x")).alias("chosen_mask"),
        _render(F.col("y")).alias("rejected"),
        _spans(F.col("y")).alias("rejected_mask"),
        status.alias("status"),
    )


def with_pairs(turns: DataFrame, pairs: DataFrame, conv: str = "conv_id") -> DataFrame:
    """``turns`` with pair_id and side, from a table (pair_id, chosen_id, rejected_id) of wanted pairs."""
    turns = turns.drop("pair_id", "side")
    (c,) = fresh(turns, "c")
    sides = pairs.select("pair_id", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("chosen_id").alias("c")), F.struct(F.lit(1).alias("side"), F.col("rejected_id").alias("c")))).alias("s")).select("pair_id", "s.side", F.col("s.c").alias(c))
    return turns.join(sides, F.col(f"`{conv}`") == F.col(c)).drop(c)


def op1_preference_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query: every conversation is chosen over its own turns with the neighbour's last reply."""

    def spans(c: str) -> Column:
        return F.array_join(F.transform(c, lambda s: F.concat(s["s"].cast("string"), F.lit(":"), s["e"].cast("string"))), ",").alias(c)

    pairs = format_pairs(replaced_replies(table(spark, sf_dir, "conversations")))
    return pairs.select("pair_id", "chosen_id", "rejected_id", "n_common_turns", "prompt", "chosen", spans("chosen_mask"), "rejected", spans("rejected_mask"), "status")


OP1_SQL = r"""
WITH v AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, replace(coalesce(text, ''), '<|im_', '<| im_') AS text,
         conv_id + 1 - 2 * (((conv_id % 2) + 2) % 2) AS other
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM v),
l AS (SELECT conv_id, max(other) AS other, coalesce(max(pos) FILTER (WHERE role = 'assistant'), 0) AS at FROM o GROUP BY conv_id),
y AS (SELECT o.conv_id, o.text FROM o JOIN l ON o.conv_id = l.conv_id AND o.pos = l.at),
a AS (SELECT conv_id AS pair_id, 0 AS side, conv_id, role, text, pos FROM o),
b AS (SELECT l.conv_id AS pair_id, 1 AS side, CAST(NULL AS BIGINT) AS conv_id, o.role, o.text, o.pos
      FROM l JOIN o ON o.conv_id = l.conv_id AND (l.at = 0 OR o.pos < l.at)
      UNION ALL SELECT l.conv_id, 1, l.other, 'assistant', y.text, l.at FROM l JOIN y ON y.conv_id = l.other WHERE l.at > 0),
t AS (SELECT * FROM a UNION ALL SELECT * FROM b),
m AS (SELECT coalesce(a.pair_id, b.pair_id) AS pair_id, coalesce(a.pos, b.pos) AS pos,
             coalesce(a.role = b.role AND a.text = b.text, false) AS same
      FROM a FULL JOIN b ON a.pair_id = b.pair_id AND a.pos = b.pos),
n AS (SELECT pair_id, coalesce(min(pos) FILTER (WHERE NOT same) - 1, count(*)) AS n FROM m GROUP BY pair_id),
r AS (SELECT t.*, n.n, '<|im_start|>' || role || chr(10) AS head, text || '<|im_end|>' AS body FROM t JOIN n USING (pair_id)),
c AS (SELECT *, sum(CASE WHEN pos > n THEN length(head) + length(body) + 1 ELSE 0 END) OVER (PARTITION BY pair_id, side ORDER BY pos) - length(body) - 1 AS s FROM r),
g AS (SELECT pair_id, side, max(conv_id) AS id, max(n) AS n,
             coalesce(string_agg(head || body || chr(10), '' ORDER BY pos) FILTER (WHERE pos <= n), '') AS prompt,
             coalesce(string_agg(head || body || chr(10), '' ORDER BY pos) FILTER (WHERE pos > n), '') AS rest,
             coalesce(string_agg(CAST(CAST(s AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(s + length(body) AS BIGINT) AS VARCHAR), ',' ORDER BY pos) FILTER (WHERE pos > n AND role = 'assistant'), '') AS mask,
             count(*) FILTER (WHERE pos > n) AS left_turns, count(*) FILTER (WHERE pos > n AND role = 'assistant') AS trained
      FROM c GROUP BY pair_id, side)
SELECT n.pair_id, x.id AS chosen_id, y.id AS rejected_id, CAST(n.n AS BIGINT) AS n_common_turns,
       coalesce(x.prompt, '') AS prompt, coalesce(x.rest, '') AS chosen, coalesce(x.mask, '') AS chosen_mask,
       coalesce(y.rest, '') AS rejected, coalesce(y.mask, '') AS rejected_mask,
       CASE WHEN coalesce(x.left_turns, 0) = 0 AND coalesce(y.left_turns, 0) = 0 THEN 'equal'
            WHEN coalesce(x.left_turns, 0) = 0 OR coalesce(y.left_turns, 0) = 0 THEN 'prefix'
            WHEN x.trained > 0 AND y.trained > 0 THEN 'pair' ELSE 'untrained' END AS status
FROM n LEFT JOIN (SELECT * FROM g WHERE side = 0) x ON n.pair_id = x.pair_id
       LEFT JOIN (SELECT * FROM g WHERE side = 1) y ON n.pair_id = y.pair_id
"""
