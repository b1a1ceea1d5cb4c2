"""Column builders that normalise answers and score them.

A normalised answer is always ``ARRAY<STRING>``: one element for a plain text,
several for a list answer. ``mode`` is ``"as_documented"`` (default) or
``"as_coded"``; the two differ only where the coded behaviour contradicts its
own description.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from evalspark.functions import fixed
from evalspark.functions.text import drop_answer_prefix, last_token, let, strip

MODES = ("as_documented", "as_coded")
Metric = Callable[[Column, Column], Column]


def check_mode(mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    return mode


# --- normalisation ---------------------------------------------------------------

LIST_TASKS = (fixed.TASK_GENE_DISEASE, fixed.TASK_DISEASE_LOCATION)
LOCATION_TASKS = (fixed.TASK_SNP_LOCATION, fixed.TASK_GENE_LOCATION)


def location_answer(token: Column) -> Column:
    """Location word, with "chr" put in front unless it is in there already."""
    return F.when(token.contains("chr"), token).otherwise(
        F.concat(F.lit("chr"), token)
    )


def listed_answer(text: Column) -> Column:
    return F.split(drop_answer_prefix(text), fixed.LIST_SEPARATOR)


def coding_answer(plain: Column) -> Column:
    return (
        F.when(plain == "Yes", F.lit(fixed.TRUE_TEXT))
        .when(plain == "No", F.lit(fixed.NOT_AVAILABLE))
        .otherwise(plain)
    )


def common_name(name: Column) -> Column:
    """Scientific name -> common name; an unknown name stays as it is."""
    known = F.create_map(
        *[F.lit(x) for pair in fixed.ORGANISMS.items() for x in pair]
    )
    return F.coalesce(F.try_element_at(known, name), name)


def with_normalised(
    df: DataFrame, answers: dict[str, Column]
) -> DataFrame:
    """Adds normalised answers: new column -> answer text, by the row's ``task``.

    Steps that the next one uses more than once are columns of their own. Catalyst
    keeps such projections apart, so each is computed once per row.
    """
    task = F.col("task")
    plain = {f"_plain_{n}": drop_answer_prefix(a) for n, a in answers.items()}
    token = {
        f"_token_{n}": F.when(task.isin(*LOCATION_TASKS), last_token(a))
        for n, a in answers.items()
    }

    def single(name: str) -> Column:
        text = F.col(f"_plain_{name}")
        return (
            F.when(task == fixed.TASK_CODING, coding_answer(text))
            .when(task == fixed.TASK_SPECIES, common_name(text))
            .when(task.isin(*LOCATION_TASKS), location_answer(F.col(f"_token_{name}")))
            .when(~task.isin(*LIST_TASKS), text)
        )

    def whole(name: str) -> Column:
        one = F.col(f"_single_{name}")
        listed = F.split(F.col(f"_plain_{name}"), fixed.LIST_SEPARATOR)
        return F.when(one.isNotNull(), F.array(one)).when(
            task.isin(*LIST_TASKS), listed
        )

    return (
        df.withColumns({**plain, **token})
        .withColumns({f"_single_{n}": single(n) for n in answers})
        .withColumns({n: whole(n) for n in answers})
        .drop(*plain, *token, *[f"_single_{n}" for n in answers])
    )


# --- metrics over two texts ----------------------------------------------------------


def folded(text: Column) -> Column:
    return F.lower(strip(text))


def exact_match(pred: Column, gold: Column) -> Column:
    return (folded(pred) == folded(gold)).cast("double")


def region_match(pred: Column, gold: Column) -> Column:
    """1 for the same region, 0.5 for the same part before ":", else 0."""
    p, g = folded(pred), folded(gold)
    colon = F.lit(":")
    return (
        F.when(p == g, 1.0)
        .when(F.split_part(p, colon, F.lit(1)) == F.split_part(g, colon, F.lit(1)), 0.5)
        .when(p.isNotNull() & g.isNotNull(), 0.0)
    )


def edit_distance(pred: Column, gold: Column) -> Column:
    return F.levenshtein(pred, gold)


def fuzzy_ratio(pred: Column, gold: Column, distance: Column | None = None) -> Column:
    """1 - edit distance / longer length; two empty texts are alike.

    ``distance`` is their edit distance where it is known already.
    """
    longer = F.greatest(F.char_length(pred), F.char_length(gold))
    if distance is None:
        distance = F.levenshtein(pred, gold)
    return F.when(longer == 0, 1.0).otherwise(1.0 - distance / longer)


# --- metrics over two lists -------------------------------------------------------------


def label_set(values: Column) -> Column:
    return F.array_distinct(F.transform(values, folded))


def set_recall(pred: Column, gold: Column) -> Column:
    """Share of gold labels that were predicted; nothing expected, nothing said = 1."""

    def recall(sets: Column) -> Column:
        p, g = sets["p"], sets["g"]
        share = F.array_size(F.array_intersect(p, g)) / F.array_size(g)
        nothing = (F.array_size(p) == 0).cast("double")
        return F.when(F.array_size(g) > 0, share).when(g.isNotNull(), nothing)

    # The sets are built once and handed to the rule as one value.
    sets = F.struct(label_set(pred).alias("p"), label_set(gold).alias("g"))
    return let(sets, recall)


def character_recall(pred: Column, gold: Column) -> Column:
    """Set recall over the characters of two texts."""
    return set_recall(F.split(pred, ""), F.split(gold, ""))


# --- metric by task ---------------------------------------------------------------------------


def _on_text(metric: Metric) -> Metric:
    return lambda pred, gold: metric(F.get(pred, 0), F.get(gold, 0))


def metric_registry(mode: str = "as_documented") -> dict[str, Metric]:
    """Task -> metric over two normalised arrays; tasks not listed use exact match."""
    coded = check_mode(mode) == "as_coded"
    registry: dict[str, Metric] = {
        fixed.TASK_GENE_DISEASE: set_recall,
        fixed.TASK_ALIGNMENT: _on_text(region_match),
    }
    if coded:
        # A location is one text, whose "set" is its characters.
        registry[fixed.TASK_GENE_LOCATION] = _on_text(character_recall)
    else:
        # One location against one location: set recall and exact match agree there,
        # so only the list task needs the set metric.
        registry[fixed.TASK_DISEASE_LOCATION] = set_recall
    return registry


def task_score(
    task: Column, pred: Column, gold: Column, registry: dict[str, Metric]
) -> Column:
    """One CASE over the registry, so every task is scored in the same projection."""
    default = _on_text(exact_match)(pred, gold)
    branches = F
    for name, metric in registry.items():
        branches = branches.when(task == name, metric(pred, gold))
    return default if branches is F else branches.otherwise(default)
