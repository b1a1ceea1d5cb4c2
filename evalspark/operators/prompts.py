"""Prompt tables: message lists, structured prompts, judge prompts, histories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from evalspark.functions import fixed
from evalspark.functions.text import fill

MESSAGE_TYPE = "array<struct<role:string,content:string>>"


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def literal_messages(examples: Sequence[tuple[str, str]]) -> Column:
    """Few-shot turns known when the job is built; folded into the plan as a literal."""
    if not examples:
        return F.array().cast(MESSAGE_TYPE)
    return F.array(*[message(role, F.lit(text)) for role, text in examples])


def few_shot_array(examples: DataFrame, set_column: str = "example_set") -> DataFrame:
    """Example rows (set, pos, role, content) -> one ordered message array per set.

    A set is one prompt, thus one row; its array is begun before the shuffle.
    """
    ordered = F.array_sort(
        F.collect_list(F.struct(F.col("pos").cast("bigint").alias("pos"), "role", "content"))
    )
    return examples.groupBy(set_column).agg(
        F.transform(
            ordered, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))
        ).alias("examples")
    )


def build_messages(
    items: DataFrame,
    system: str,
    examples: Sequence[tuple[str, str]] | DataFrame = (),
    set_column: str = "example_set",
) -> DataFrame:
    """System turn + few-shot turns + the question -> (id, messages).

    ``examples`` is a list of (role, content), or a table made by
    :func:`few_shot_array`, joined on its set column by equality.
    """
    if isinstance(examples, DataFrame):
        # Spark sends the sets to all tasks if they are small. Else the hash of the set
        # makes both sides exchange for this join alone, so a set that many items use
        # can be split.
        key = F.xxhash64(set_column).alias("set_hash")
        keyed = examples.select("*", key)
        items = items.select("*", key).join(keyed, ["set_hash", set_column], "left")
        shots = F.coalesce(F.col("examples"), F.array().cast(MESSAGE_TYPE))
    else:
        shots = literal_messages(examples)
    messages = F.concat(
        F.array(message("system", F.lit(system))),
        shots,
        F.array(message("user", F.col("question"))),
    )
    return items.select("id", messages.alias("messages"))


def structured_prompt(items: DataFrame) -> DataFrame:
    """Question and task in the JSON-answer template, with its system turn."""
    prompt = fill(
        fixed.STRUCTURED_TEMPLATE, question=F.col("question"), task=F.col("task")
    )
    return items.select(
        "id",
        prompt.alias("prompt"),
        F.array(
            message("system", F.lit(fixed.STRUCTURED_SYSTEM)), message("user", prompt)
        ).alias("messages"),
    )


def append_turns(history: DataFrame, new_turns: DataFrame) -> DataFrame:
    """Put new turns behind the history of their conversation, one row per turn.

    Both tables hold (conv_id, turn, role, text); ``turn`` of the new rows counts from
    0. Only the last turn number of each conversation is shuffled for the history, so
    a conversation of any length is never gathered in one place.
    """
    last = history.groupBy("conv_id").agg((F.max("turn") + 1).alias("start"))
    shifted = new_turns.join(last, "conv_id", "left").select(
        "conv_id",
        (F.coalesce(F.col("start"), F.lit(0)) + F.col("turn")).alias("turn"),
        "role",
        "text",
    )
    return history.select("conv_id", "turn", "role", "text").unionByName(shifted)


# --- message lists ------------------------------------------------------------------------

#: Turns of a conversation that are gathered before the conversation is.
BLOCK_TURNS = 1024


def _call_id(turn: Column, place: Column) -> Column:
    return F.format_string("call_%d_%d", turn, place)


def message_lists(turns: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """Turns -> (conv_id, messages): one nested list per conversation, in order of turns.

    Turns are (conv_id, turn, role, text, calls, reply_to): ``calls`` is an array of
    (name, arguments) or null, ``reply_to`` the (turn, place) of the call a tool turn
    answers. In a message, calls have ids and a reply names the id of its call. Lists are
    made of blocks of turns first, so rows of a long conversation are sorted block by
    block; the list itself is one value, as a chat request is. Turns of one number keep
    the order of role and text.
    """
    calls = F.transform(
        "calls",
        lambda c, i: F.struct(
            _call_id(F.col("turn"), i).alias("id"), c["name"].alias("name"), c["arguments"].alias("arguments")
        ),
    )
    reply = F.when(F.col("reply_to").isNotNull(), _call_id(F.col("reply_to.turn"), F.col("reply_to.place")))
    message_row = F.struct(
        F.col("turn"),
        F.col("role"),
        F.col("text").alias("content"),
        calls.alias("tool_calls"),
        reply.alias("tool_call_id"),
    )
    block = F.floor(F.col("turn") / block_turns)
    blocks = turns.groupBy("conv_id", block.alias("block")).agg(
        F.sort_array(F.collect_list(message_row)).alias("part")
    )
    whole = blocks.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("block", "part"))).alias("parts"))
    return whole.select("conv_id", F.flatten("parts.part").alias("messages"))


def message_rows(lists: DataFrame) -> DataFrame:
    """The way back: one row per message, as :func:`message_lists` takes them."""
    place = r"^call_(-?\d+)_(\d+)$"
    answered = F.col("m.tool_call_id")
    back = F.struct(
        F.regexp_extract(answered, place, 1).cast("long").alias("turn"),
        F.regexp_extract(answered, place, 2).cast("int").alias("place"),
    )
    calls = F.transform("m.tool_calls", lambda c: F.struct(c["name"].alias("name"), c["arguments"].alias("arguments")))
    return lists.select("conv_id", F.explode("messages").alias("m")).select(
        "conv_id",
        "m.turn",
        "m.role",
        F.col("m.content").alias("text"),
        calls.alias("calls"),
        F.when(answered.isNotNull(), back).alias("reply_to"),
    )


def loose_replies(lists: DataFrame) -> DataFrame:
    """(conv_id, tool_call_id) of replies to calls that stand nowhere before them."""
    asked = F.flatten(
        F.transform(
            F.filter("messages", lambda m: m["tool_calls"].isNotNull()),
            lambda m: F.transform(m["tool_calls"], lambda c: F.struct(c["id"].alias("id"), m["turn"].alias("turn"))),
        )
    )
    replies = lists.select("conv_id", F.explode("messages").alias("m")).where("m.tool_call_id IS NOT NULL")
    known = lists.select("conv_id", F.explode(asked).alias("c")).select("conv_id", "c.id", "c.turn")
    same = (
        F.col("r.conv_id").eqNullSafe(F.col("k.conv_id"))
        & (F.col("r.m.tool_call_id") == F.col("k.id"))
        & (F.col("k.turn") < F.col("r.m.turn"))
    )
    left = replies.alias("r").join(known.alias("k"), same, "left_anti")
    return left.select("conv_id", F.col("m.tool_call_id").alias("tool_call_id"))


def tool_result_turns(calls: DataFrame) -> DataFrame:
    """Text turn that hands the result of each call back to the model."""
    content = fill(
        fixed.TOOL_RESULT_TEMPLATE,
        name=F.col("name"),
        parameters=F.to_json("parameters"),
        result=F.col("result"),
    )
    return calls.select("id", "pos", F.lit("user").alias("role"), content.alias("text"))


def judge_prompt(items: DataFrame, answers: DataFrame, rubric: str) -> DataFrame:
    """Rubric prompt per answer: question, candidate, gold and rubric.

    An answer without an item is judged too, with nothing for its question and gold.
    """
    prompt = fill(
        fixed.JUDGE_TEMPLATE,
        question=F.col("question"),
        candidate=F.col("candidate"),
        gold=F.col("gold"),
        rubric=F.lit(rubric),
    )
    gold = items.select("id", "question", F.col("answer").alias("gold"))
    return answers.join(gold, "id", "left").select(
        "id",
        prompt.alias("prompt"),
        F.array(
            message("system", F.lit(fixed.JUDGE_SYSTEM)), message("user", prompt)
        ).alias("messages"),
    )


def pairwise_prompt(
    answers: DataFrame, model_a, model_b, criteria: str, items: DataFrame
) -> DataFrame:
    """Two models' answers to the same item side by side.

    The two models are named, so each side of the join holds at most one answer per
    item and the result is no larger than the smaller side. Answers and items may be
    many rows made from each row of a small file; by the file's size Spark would send
    them whole to every task, so both joins are told to sort and merge.
    """

    def of(model, name: str) -> DataFrame:
        return answers.where(F.col("model") == model).select(
            "id", F.col("answer").alias(name)
        )

    prompt = fill(
        fixed.PAIRWISE_TEMPLATE,
        question=F.col("question"),
        answer_a=F.col("answer_a"),
        answer_b=F.col("answer_b"),
        criteria=F.lit(criteria),
    )
    return (
        of(model_a, "answer_a")
        .join(of(model_b, "answer_b").hint("merge"), "id")
        .join(items.select("id", "question").hint("merge"), "id")
        .select(
            "id",
            F.lit(model_a).alias("model_a"),
            F.lit(model_b).alias("model_b"),
            prompt.alias("prompt"),
        )
    )
