"""Preference pairs of conversations: one prompt, two completions with loss masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN = "array<struct<role: string, text: string>>"


def render(turn: Column) -> Column:
    """A turn as text: role mark, text, end mark."""
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"), turn["text"], F.lit("<|end|>\n"))


def as_arrays(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """One row per conversation: ``key`` and ``turns`` in order of turn (then role and text).

    A null role is ``unknown``, a null text empty; a null turn comes first. A row
    holds one conversation, as the pair that is made of it does.
    """
    one = F.struct(
        F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("unknown")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    sorted_ = F.array_sort(F.collect_list(one))
    return turns.groupBy(turns[key].alias(key)).agg(
        F.transform(sorted_, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns")
    )


def common_turns(chosen: Column, rejected: Column) -> Column:
    """How many turns from the first on are the same in role and text."""
    shorter = F.least(F.size(chosen), F.size(rejected))
    same = F.transform(
        F.slice(chosen, 1, shorter), lambda t, i: (t["role"] == rejected[i]["role"]) & (t["text"] == rejected[i]["text"])
    )
    return F.when(F.array_position(same, False) > 0, F.array_position(same, False) - 1).otherwise(shorter).cast("int")


def _text(turns: Column) -> Column:
    return F.array_join(F.transform(turns, render), "")


def _mask(turns: Column) -> Column:
    """(start, length) of what counts for the loss: the text and end mark of every assistant turn."""
    start = F.struct(
        F.lit(0).alias("at"), F.array().cast("array<struct<start: int, length: int>>").alias("spans")
    )

    def add(state: Column, turn: Column) -> Column:
        head = F.length(turn["role"]) + 5
        body = F.length(turn["text"]) + 8
        span = F.struct((state["at"] + head).cast("int").alias("start"), (body - 1).cast("int").alias("length"))
        spans = F.when(turn["role"] == "assistant", F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((state["at"] + head + body).cast("int").alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, add, lambda s: s["spans"])


def format_pairs(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """``pairs`` with its other columns and ``prompt``, ``n_prompt_turns``, and for both sides text and mask.

    ``chosen`` and ``rejected`` are arrays of (role, text). The longest common prefix
    of turns is rendered once as ``prompt``; ``chosen_text`` and ``rejected_text``
    are what follows on each side, ``chosen_mask`` and ``rejected_mask`` the
    (start, length) spans in them that count for the loss: texts and end marks of
    assistant turns. Equal sides, and a side that ends with the prompt, have an empty
    completion and mask. A null side counts as without turns. Columns with the names
    of the new ones are replaced.
    """
    new = ["prompt", "n_prompt_turns", "chosen_text", "rejected_text", "chosen_mask", "rejected_mask"]
    others = [c for c in pairs.columns if c not in {chosen, rejected, *new}]
    side = lambda name: F.coalesce(pairs[name], F.array().cast(TURN))
    rows = pairs.select(*[pairs[c] for c in others], side(chosen).alias("__chosen"), side(rejected).alias("__rejected"))
    rows = rows.withColumn("__shared", common_turns(F.col("__chosen"), F.col("__rejected")))
    rest = {s: F.slice(F.col(s), F.col("__shared") + 1, F.size(s)) for s in ("__chosen", "__rejected")}
    return rows.select(
        *[F.col(f"`{c}`") for c in others],
        _text(F.slice("__chosen", 1, F.col("__shared"))).alias("prompt"),
        F.col("__shared").alias("n_prompt_turns"),
        _text(rest["__chosen"]).alias("chosen_text"),
        _text(rest["__rejected"]).alias("rejected_text"),
        _mask(rest["__chosen"]).alias("chosen_mask"),
        _mask(rest["__rejected"]).alias("rejected_mask"),
    )


def last_answers(conversations: DataFrame, key: str = "conv_id") -> DataFrame:
    """``key`` and ``answer``, the text of the last assistant turn (null if there is none)."""
    answers = F.filter("turns", lambda t: t["role"] == "assistant")
    return conversations.select(key, F.try_element_at(answers, F.lit(-1))["text"].alias("answer"))


def against_neighbour(conversations: DataFrame, key: str = "conv_id") -> DataFrame:
    """Pairs from conversations without preferences: each one is chosen over itself with a neighbour's last answer.

    The neighbour of conversation k is k xor 1. ``rejected`` has the turns before the
    last assistant turn (all, if there is none), then the neighbour's last answer, if
    it has one, as an assistant turn.
    """
    other = last_answers(conversations, key).select(F.col(key).bitwiseXOR(F.lit(1)).alias("__of"), "answer")
    # Of conversations without a key at most one row is there, and it has no neighbour.
    joined = conversations.join(other, conversations[key] == other["__of"], "left")
    at = F.transform("turns", lambda t, i: F.when(t["role"] == "assistant", i + 1).otherwise(0))
    last = F.array_max(at)
    before = F.when(last > 0, F.slice("turns", 1, last - 1)).otherwise(F.col("turns"))
    answer = F.array(F.struct(F.lit("assistant").alias("role"), F.col("answer").alias("text"))).cast(TURN)
    rejected = F.when(F.col("answer").isNull(), before).otherwise(F.concat(before, answer))
    return joined.select(conversations[key], F.col("turns").alias("chosen"), rejected.alias("rejected"))
