"""Column builders that read model output: reasoning, fences, tool calls, schemas."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from evalspark.functions import fixed
from evalspark.functions.text import let, strip


# --- reasoning and fence ----------------------------------------------------------


def thoughts(raw: Column) -> Column:
    """Text inside the reasoning tags, '' when there are none."""
    return strip(F.regexp_extract(raw, fixed.REASONING_PATTERN, 1))


def answer_after_thoughts(raw: Column) -> Column:
    """Text after the first closing tag; the whole text when there is none."""
    end = F.locate(fixed.REASONING_END, raw)
    tail = F.substring(
        raw, end + len(fixed.REASONING_END), F.char_length(raw)
    )
    return strip(F.when(end > 0, tail).otherwise(raw))


def strip_fence(raw: Column) -> Column:
    """Content of a json code fence; a text that is not fenced stays as it is."""
    fenced = raw.startswith(fixed.FENCE_START) & raw.endswith(fixed.FENCE_END)
    inner = F.substring(
        raw,
        F.lit(len(fixed.FENCE_START) + 1),
        F.char_length(raw) - len(fixed.FENCE_START) - len(fixed.FENCE_END),
    )
    return F.when(fenced, strip(inner)).otherwise(raw)


# --- tool calls ------------------------------------------------------------------------

def tool_call_list(text: Column) -> Column:
    """Valid, non-empty call list -> array of calls; null = the text is an answer.

    A list counts only if it is a JSON *array* and each element is an object with
    both ``name`` and ``parameters``.
    """

    def has_both(call: Column) -> Column:
        return (
            F.try_variant_get(call, "$.name", "variant").isNotNull()
            & F.try_variant_get(call, "$.parameters", "variant").isNotNull()
        )

    def shaped(call: Column) -> Column:
        parameters = F.try_variant_get(call, "$.parameters", "map<string,string>")
        return F.struct(
            F.try_variant_get(call, "$.name", "string").alias("name"),
            parameters.alias("parameters"),
            parameters.isNotNull().alias("parameters_ok"),
        )

    def valid_calls(calls: Column) -> Column:
        valid = (F.array_size(calls) > 0) & F.forall(calls, has_both)
        return F.when(valid, F.transform(calls, shaped))

    # Only texts that can be a list are parsed.
    parsed = F.try_variant_get(F.try_parse_json(text), "$", "array<variant>")
    return F.when(text.rlike(r"^\s*\["), let(parsed, valid_calls))


# --- schema rules ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """What one field of a JSON answer has to look like."""

    field: str
    kind: str = "string"  # string, number, boolean, array or object
    required: bool = True
    enum: Sequence[str] | None = None
    pattern: str | None = None
    min_length: int | None = None


ANSWER_RULES = (
    Rule("task"),
    Rule("question"),
    Rule("answer"),
    Rule("explanation", required=False),
)

_TYPE_NAMES = {
    "string": ("STRING",),
    "number": ("BIGINT", "DOUBLE", "FLOAT", "DECIMAL"),
    "boolean": ("BOOLEAN",),
    "array": ("ARRAY",),
    "object": ("OBJECT",),
}


def rule_violation(value: Column, rule: Rule) -> Column:
    """Text ``field: problem`` for the first broken part of a rule, else null."""

    def problem(what: str) -> Column:
        return F.lit(f"{rule.field}: {what}")

    def check(found: Column) -> Column:
        raw, type_name, text = found["raw"], found["type"], found["text"]
        right_type = F.lit(False)
        for name in _TYPE_NAMES[rule.kind]:
            right_type = right_type | type_name.startswith(name)
        chain = F.when(raw.isNull(), problem("missing") if rule.required else F.lit(None))
        # VOID is the type of a JSON null.
        chain = chain.when(
            type_name == "VOID", problem("type") if rule.required else F.lit(None)
        )
        chain = chain.when(~right_type, problem("type"))
        if rule.enum is not None:
            chain = chain.when(~text.isin(*rule.enum), problem("enum"))
        if rule.pattern is not None:
            chain = chain.when(~text.rlike(rule.pattern), problem("pattern"))
        if rule.min_length is not None:
            chain = chain.when(
                F.char_length(text) < rule.min_length, problem("length")
            )
        return chain

    raw = F.try_variant_get(value, f"$.{rule.field}", "variant")
    text = F.try_variant_get(value, f"$.{rule.field}", "string")
    found = F.struct(
        raw.alias("raw"), F.schema_of_variant(raw).alias("type"), text.alias("text")
    )
    return let(found, check)


def rule_violations(value: Column, rules: Sequence[Rule]) -> Column:
    """All problems of one parsed JSON value; an unparsable one is ``json: invalid``."""
    found = F.array_compact(F.array(*[rule_violation(value, r) for r in rules]))
    is_object = F.schema_of_variant(value).startswith("OBJECT")
    return F.when(
        value.isNull() | ~F.coalesce(is_object, F.lit(False)),
        F.array(F.lit("json: invalid")),
    ).otherwise(found)
