"""Collect answers from a supplied function; parse and check structured answers."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from evalspark.functions import parsing
from evalspark.functions.parsing import ANSWER_RULES, Rule
from evalspark.operators.columns import with_computed


# --- calling a function per row ----------------------------------------------------


def batch_answer(
    items: DataFrame,
    answer: Callable[[dict], str],
    max_attempts: int = 1,
    partitions: int | None = None,
    retry_on: tuple[type[BaseException], ...] = (Exception,),
    delay: Callable[[int], float] | None = None,
) -> DataFrame:
    """Call ``answer(row)`` for each row; a failing row is marked, never raised.

    Adds ``raw_prediction``, ``success``, ``attempts`` and ``error``; the input's own
    columns pass through untouched. The number of partitions is the number of calls in
    flight; set ``partitions`` to respect the limit of a service. Failures of the kinds
    ``retry_on`` are tried again, after ``delay(attempt)`` seconds if given (see
    :func:`doubling_delay`); others end the row at once.
    """
    if partitions is not None:
        items = items.repartition(partitions)
    schema = T.StructType(
        items.schema.fields
        + [
            T.StructField("raw_prediction", T.StringType()),
            T.StructField("success", T.BooleanType(), False),
            T.StructField("attempts", T.IntegerType(), False),
            T.StructField("error", T.StringType()),
        ]
    )

    def ask(row: dict) -> tuple[str | None, bool, int, str | None]:
        for attempt in range(1, max_attempts + 1):
            try:
                return answer(row), True, attempt, None
            except Exception as failure:  # one row's failure is a result, not a crash
                error = f"{type(failure).__name__}: {failure}"
                if attempt == max_attempts or not isinstance(failure, retry_on):
                    break
                if delay is not None:
                    time.sleep(delay(attempt))
        return None, False, attempt, error

    kinds = [pa.string(), pa.bool_(), pa.int32(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            replies = [ask(row) for row in batch.to_pylist(maps_as_pydicts="lossy")]
            added = [pa.array([r[i] for r in replies], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *added], names=[field.name for field in schema]
            )

    return items.mapInArrow(run, schema)


def doubling_delay(first: float = 1.0, noise: float = 0.5) -> Callable[[int], float]:
    """Seconds to wait after the n-th failure: ``first`` * 2^(n-1) and a random part."""

    def delay(attempt: int) -> float:
        return first * 2 ** (attempt - 1) + random.uniform(0, noise)

    return delay


def distinct_calls(
    items: DataFrame,
    keys: Sequence[str],
    answer: Callable[[dict], str],
    max_attempts: int = 1,
    partitions: int | None = None,
    **policy,
) -> DataFrame:
    """As :func:`batch_answer`, but one call per different input, joined back.

    Both sides of the join back are exchanged right before it, so adaptive execution
    can split an input that holds a large share of the rows.
    """
    inputs = items.select(*keys).dropDuplicates(list(keys))
    replies = batch_answer(inputs, answer, max_attempts, partitions, **policy)
    # A join on the hash beside the keys keeps equal inputs together and makes the
    # reply side exchange on its own instead of reusing the distinct's layout.
    hashed = F.xxhash64(*keys).alias("input_hash")
    left = items.select("*", hashed).alias("i")
    right = replies.select("*", hashed).alias("r")
    same = F.col("i.input_hash") == F.col("r.input_hash")
    for key in keys:
        same = same & F.col(f"i.{key}").eqNullSafe(F.col(f"r.{key}"))
    return left.join(right, same, "left").select(
        *[F.col(f"i.{c}") for c in items.columns],
        *[F.col(f"r.{c}") for c in ("raw_prediction", "success", "attempts", "error")],
    )


# --- structured answers ------------------------------------------------------------------


def parse_structured(
    df: DataFrame, raw: str = "raw", rules: Sequence[Rule] = ANSWER_RULES
) -> DataFrame:
    """JSON answer -> fields + ``success`` + ``violations``, one row per input row.

    A rejected answer keeps its row, with the input's own values of the fields, such as
    task and question of the item; fields that the input lacks are empty texts.
    """
    parsed = with_computed(df, _value=F.try_parse_json(F.col(raw)))
    checked = with_computed(
        parsed, violations=parsing.rule_violations(F.col("_value"), rules)
    )
    ok = F.array_size("violations") == 0
    fields = [
        F.when(ok, F.try_variant_get(F.col("_value"), f"$.{r.field}", "string"))
        .when(~ok, F.col(r.field).cast("string") if r.field in df.columns else F.lit(""))
        .alias(r.field)
        for r in rules
    ]
    kept = [c for c in df.columns if c not in {r.field for r in rules}]
    return checked.select(*kept, *fields, ok.alias("success"), "violations")


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where("success").drop("violations")


def rejected(parsed: DataFrame, raw: str = "raw") -> DataFrame:
    return parsed.where("NOT success").select("id", raw, "violations")


def check_schema(
    df: DataFrame, rules: Sequence[Rule], raw: str = "raw"
) -> DataFrame:
    """Rows whose JSON breaks a rule, one row per violation (id, violation)."""
    parsed = with_computed(df, _value=F.try_parse_json(F.col(raw)))
    found = parsing.rule_violations(F.col("_value"), rules)
    return parsed.select("id", F.explode(found).alias("violation"))


def first_valid_attempt(attempts: DataFrame, max_attempts: int) -> DataFrame:
    """Of several tries per id, the first valid one; failed when none is in the limit.

    Input (id, attempt from 1, answer, valid).
    """
    usable = F.col("valid") & (F.col("attempt") <= max_attempts)
    order = F.when(usable, F.col("attempt"))
    return (
        attempts.groupBy("id")
        .agg(
            F.min_by("answer", order).alias("answer"),
            F.min(order).alias("attempt"),
            F.max("attempt").alias("tries"),
        )
        .select(
            "id",
            "answer",
            F.col("attempt").isNotNull().alias("success"),
            F.coalesce("attempt", F.least("tries", F.lit(max_attempts))).alias("attempts"),
        )
    )


def split_reasoning(df: DataFrame, raw: str = "raw") -> DataFrame:
    return df.withColumns(
        {
            "thoughts": parsing.thoughts(F.col(raw)),
            "answer": parsing.answer_after_thoughts(F.col(raw)),
        }
    )


def strip_fence(df: DataFrame, column: str = "answer") -> DataFrame:
    return df.withColumn(column, parsing.strip_fence(F.col(column)))


def parse_answers(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Raw model text -> reasoning split off, fence removed, JSON answer checked."""
    cleaned = strip_fence(split_reasoning(df, raw)).withColumnRenamed("answer", "_text")
    return parse_structured(cleaned, "_text").drop("_text")
