"""Preference pairs in chat format.

The longest common prefix of turns of the chosen and the rejected conversation is
rendered once, as the prompt.  What differs is rendered twice, as the two
completions.  A completion is a list of segments; only what an assistant says
and its end mark are marked for training, everything else is masked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"
#: A turn in text.  A mark inside a turn's own text is broken by a space.
OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"


def plain(text: Column) -> Column:
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), plain(turn["role"]), F.lit(CLOSE))


def body(turn: Column) -> Column:
    return F.concat(plain(turn["text"]), F.lit(END))


def common_turns(chosen: Column, rejected: Column) -> Column:
    """Number of turns that both begin with; null roles and texts equal each other."""
    same = F.zip_with(chosen, rejected, lambda a, b: a.isNotNull() & b.isNotNull() & a.eqNullSafe(b))
    differs = F.array_position(same, F.lit(False)).cast("int")
    return F.when(differs == 0, F.size(same)).otherwise(differs - 1)


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(head(t), body(t))), "")


def segments(turns: Column) -> Column:
    """Text and training mark of the parts of a completion."""

    def of_turn(turn: Column) -> Column:
        own = F.coalesce(turn["role"], F.lit("")) == ASSISTANT
        return F.array(
            F.struct(head(turn).alias("text"), F.lit(False).alias("train")),
            F.struct(body(turn).alias("text"), own.alias("train")),
        )

    return F.flatten(F.transform(turns, of_turn))


def format_pairs(
    pairs: DataFrame, key: str, chosen: str, rejected: str, carried: tuple[str, ...] = ()
) -> DataFrame:
    """``key``, the ``carried`` columns, ``common`` (turns in the prompt), ``prompt``, and
    the segments of ``chosen`` and ``rejected``.

    Conversations are arrays of structs of role and text; a null one is empty.
    Equal conversations are all prompt and have empty completions, as has one
    that the other goes on from.  A null role or text is rendered as nothing.
    Repeated rows each give a row; other columns are ignored.
    """
    turns = "array<struct<role:string,text:string>>"
    both = pairs.select(
        F.col(key).alias("key"),
        *carried,
        F.coalesce(F.col(chosen).cast(turns), F.array().cast(turns)).alias("chosen"),
        F.coalesce(F.col(rejected).cast(turns), F.array().cast(turns)).alias("rejected"),
    ).withColumn("common", common_turns(F.col("chosen"), F.col("rejected")))

    def rest(turns: Column) -> Column:
        after = F.greatest(F.size(turns) - F.col("common"), F.lit(0))
        return F.slice(turns, F.col("common") + 1, after)

    return both.select(
        "key",
        *carried,
        "common",
        render(F.slice("chosen", F.lit(1), F.col("common"))).alias("prompt"),
        segments(rest(F.col("chosen"))).alias("chosen"),
        segments(rest(F.col("rejected"))).alias("rejected"),
    )


def reply_pairs(
    turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Pairs of ``chosen``, a whole conversation, and ``rejected``, the same with one
    reply changed; ``changed`` is the place of that turn, from 1.

    A conversation gives a pair whose last assistant turn says what the assistant said
    before, or nothing if it had not spoken; and, with two replies or more, a pair whose
    first assistant turn says what the second one does.  Later turns follow in both, so
    the second pair differs early and goes on.  Replies of equal text leave the two
    conversations equal.  A conversation without a reply gives one pair of equals, with
    ``changed`` null.

    Turns follow ``order``, ties role and text; a null order comes first.
    Repeated rows are turns of their own.  A row without a key is a conversation
    of its own.  A conversation is one row here, as it is in its rendered form, so
    a task must hold its longest one.
    """
    turn = F.struct(F.col(order).alias("at"), F.col(role).alias("role"), F.col(text).alias("text"))
    grouped = (
        turns.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("key"))
        .agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    )
    alone = turns.filter(F.col(key).isNull()).select(
        F.col(key).alias("key"), F.array(turn).alias("turns")
    )
    said = F.filter(
        F.transform(
            "turns", lambda t, i: F.when(F.coalesce(t["role"], F.lit("")) == ASSISTANT, i + 1)
        ),
        lambda i: i.isNotNull(),
    )
    pure = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    placed = grouped.unionByName(alone).select("key", pure.alias("turns"), said.alias("said"))
    n = F.size("said")

    def change(place: Column, taken: Column) -> Column:
        return F.struct(place.alias("changed"), taken.alias("taken"))

    nothing = F.lit(None).cast("int")
    last = F.when(n > 0, change(F.get("said", n - 1), F.get("said", n - 2)))
    first = F.when(n > 1, change(F.get("said", F.lit(0)), F.get("said", F.lit(1))))
    none = F.when(n == 0, change(nothing, nothing))
    changes = F.array_compact(F.array(last, first, none))
    pairs = placed.select("key", "turns", F.explode(changes).alias("change")).select(
        "key", "turns", "change.*"
    )
    other = F.coalesce(F.get("turns", F.col("taken") - 1)["text"], F.lit(""))
    rejected = F.transform(
        "turns",
        lambda t, i: F.when(
            i + 1 == F.col("changed"), F.struct(t["role"].alias("role"), other.alias("text"))
        ).otherwise(t),
    )
    return pairs.select("key", "changed", F.col("turns").alias("chosen"), rejected.alias("rejected"))
