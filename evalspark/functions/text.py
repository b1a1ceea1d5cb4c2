"""Column builders for answer and question texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from evalspark.functions import fixed


def let(value: Column, rule: Callable[[Column], Column]) -> Column:
    """``rule(value)`` with the value computed once, however often the rule reads it.

    A CASE repeats what its branches share; a lambda's argument is bound to its value.
    """
    return F.get(F.transform(F.array(value), rule), F.lit(0))


def strip(text: Column) -> Column:
    """Remove every kind of whitespace at both ends, not blanks alone.

    Most texts have none. A look at the two end characters spares those the general
    trim, which walks the text character by character.
    """
    space = F.lit(fixed.WHITESPACE)
    ends = F.substring(text, 1, 1), F.substring(text, -1, 1)
    needed = (F.instr(space, ends[0]) > 0) | (F.instr(space, ends[1]) > 0)
    return F.when(needed, F.btrim(text, space)).otherwise(text)


def last_token(text: Column) -> Column:
    """Last whitespace-separated word; null when the text has none."""
    blanks = F.translate(strip(text), fixed.WHITESPACE, " " * len(fixed.WHITESPACE))
    return F.nullif(F.substring_index(blanks, " ", -1), F.lit(""))


def first_group(text: Column, pattern: str) -> Column:
    """First match of group 1; null (not '') when the pattern does not match."""
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def drop_answer_prefix(text: Column) -> Column:
    return F.replace(strip(text), F.lit(fixed.ANSWER_PREFIX), F.lit(""))


def question_key(question: Column) -> Column:
    """Question without the decomposition suffix, for text joins."""
    return strip(F.replace(question, F.lit(fixed.DECOMPOSE_SUFFIX), F.lit("")))


def join_list(values: Column, separator: str = " ") -> Column:
    return F.array_join(values, separator)


def parse_list_literal(text: Column) -> Column:
    """``['a', 'b']`` -> array; any other text -> array of that one text.

    The text is parsed as JSON with single quotes allowed and is never evaluated.
    """
    looks_like_list = text.startswith("[") & text.endswith("]")
    parsed = F.from_json(text, "array<string>", {"allowSingleQuotes": "true"})
    return F.when(looks_like_list, F.coalesce(parsed, F.array(text))).when(
        text.isNotNull(), F.array(text)
    )


def list_literal(values: Column) -> Column:
    """Array -> text ``['a', 'b']``, the inverse of :func:`parse_list_literal`."""

    def quoted(value: Column) -> Column:
        escaped = F.replace(value, F.lit("\\"), F.lit("\\\\"))
        single = F.concat(
            F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'")
        )
        double = F.concat(F.lit('"'), escaped, F.lit('"'))
        return F.when(
            value.contains("'") & ~value.contains('"'), double
        ).otherwise(single)

    return F.concat(
        F.lit("["), F.array_join(F.transform(values, quoted), ", "), F.lit("]")
    )


def fill(template: str, **columns: Column) -> Column:
    """Fill ``{name}`` places of a template; a missing value becomes empty text."""
    pieces: list[Column] = []
    rest = template.replace("{{", "\0").replace("}}", "\1")

    def literal(text: str) -> Column:
        return F.lit(text.replace("\0", "{").replace("\1", "}"))

    while "{" in rest:
        before, _, tail = rest.partition("{")
        name, _, rest = tail.partition("}")
        pieces.append(literal(before))
        pieces.append(F.coalesce(columns[name].cast("string"), F.lit("")))
    pieces.append(literal(rest))
    return F.concat(*pieces)


def variant_to_list(value: Column) -> Column:
    """Scalar-or-list VARIANT -> array of strings (a scalar becomes one element)."""
    is_list = F.schema_of_variant(value).startswith("ARRAY")
    return F.when(
        is_list, F.try_variant_get(value, "$", "array<string>")
    ).when(
        value.isNotNull() & ~F.is_variant_null(value),
        F.array(F.try_variant_get(value, "$", "string")),
    )
