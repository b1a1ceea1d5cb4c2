"""Tool calls in model texts and tool-loop transcripts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from evalspark.functions import fixed, parsing
from evalspark.operators.columns import with_computed


@dataclass(frozen=True)
class Tool:
    """A registered tool: its argument names and which of them are required."""

    required: Sequence[str] = field(default_factory=tuple)
    optional: Sequence[str] = field(default_factory=tuple)

    @property
    def allowed(self) -> tuple[str, ...]:
        return tuple(self.required) + tuple(self.optional)


Registry = Mapping[str, Tool]


def _names(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def _by_tool(registry: Registry, pick) -> Column:
    chain = F
    for name, tool in registry.items():
        chain = chain.when(F.col("name") == name, _names(pick(tool)))
    return chain.otherwise(_names(()))


def _is_known(registry: Registry) -> Column:
    return F.coalesce(F.col("name").isin(*registry), F.lit(False))


def extract_tool_calls(df: DataFrame, column: str = "answer") -> DataFrame:
    """Call lists -> one row per call (id, pos, name, parameters, parameters_ok)."""
    text = df.select("id", parsing.strip_fence(F.col(column)).alias("_text"))
    calls = parsing.tool_call_list(F.col("_text"))
    return text.select("id", F.posexplode(calls).alias("pos", "call")).select(
        "id", "pos", "call.name", "call.parameters", "call.parameters_ok"
    )


def direct_answers(df: DataFrame, column: str = "answer") -> DataFrame:
    """Texts that are no valid call list and so are final answers."""
    calls = parsing.tool_call_list(parsing.strip_fence(F.col(column)))
    return df.where(calls.isNull()).select("id", F.col(column).alias("answer"))


def unknown_tools(calls: DataFrame, registry: Registry) -> DataFrame:
    """Calls that name no registered tool. The registry is code, not data: a literal."""
    return calls.where(~_is_known(registry))


def with_argument_errors(calls: DataFrame, registry: Registry) -> DataFrame:
    """Adds ``missing`` and ``extra`` argument names and the ``error`` of each call."""
    given = F.coalesce(F.map_keys("parameters"), _names(()))
    missing = F.array_except(_by_tool(registry, lambda t: t.required), given)
    extra = F.array_except(given, _by_tool(registry, lambda t: t.allowed))
    known = _is_known(registry)
    checked = with_computed(
        calls,
        missing=F.when(known, missing).otherwise(_names(())),
        extra=F.when(known, extra).otherwise(_names(())),
    )
    error = (
        F.when(~F.col("parameters_ok"), "invalid arguments")
        .when(~known, "unknown tool")
        .when(F.array_size("missing") > 0, "missing arguments")
        .when(F.array_size("extra") > 0, "extra arguments")
    )
    return checked.withColumn("error", error)


def bad_arguments(calls: DataFrame, registry: Registry) -> DataFrame:
    """Calls of known tools whose arguments do not parse or do not fit."""
    checked = with_argument_errors(calls, registry)
    return checked.where(
        F.col("error").isNotNull() & (F.col("error") != "unknown tool")
    )


def final_answer(turns: DataFrame, max_turns: int | None = None) -> DataFrame:
    """Last non-empty assistant text of each conversation, under a cap of turns if given."""
    usable = (
        (F.lit(True) if max_turns is None else F.col("turn") < max_turns)
        & (F.col("role") == "assistant")
        & (F.coalesce(F.col("text"), F.lit("")) != "")
    )
    last = F.max_by("text", F.when(usable, F.col("turn")))
    return turns.groupBy("conv_id").agg(
        F.coalesce(last, F.lit(fixed.NOT_ANSWERED)).alias("answer"),
        F.max(F.coalesce(usable, F.lit(False))).alias("answered"),
    )


def tool_usage(calls: DataFrame, registry: Registry) -> DataFrame:
    """Calls per tool and the share of them that is an error."""
    is_error = F.col("error").isNotNull().cast("int")
    return (
        with_argument_errors(calls, registry)
        .groupBy("name")
        .agg(
            F.count(F.lit(1)).alias("calls"),
            F.sum(is_error).alias("errors"),
            F.avg(is_error).alias("error_share"),
        )
    )


def analyse_tool_calls(
    df: DataFrame, registry: Registry, column: str = "answer"
) -> DataFrame:
    """Calls of all texts with their argument check, one pass and no shuffle."""
    return with_argument_errors(extract_tool_calls(df, column), registry)
