"""Question text -> question kind and lookup argument."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from evalspark.functions import fixed
from evalspark.functions.metrics import check_mode
from evalspark.functions.text import question_key, strip

UNKNOWN = "unknown"
ALL_KINDS = tuple(fixed.QUESTION_PATTERNS)


def _documented(items: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """Kind by marker text, longer phrases first; argument = group 1 of the pattern.

    A marked question that does not fit its pattern keeps its kind and has no argument.
    """
    clean = F.col("_question")
    kind, argument = F, F
    for name, (marker, pattern) in fixed.QUESTION_PATTERNS.items():
        if name in kinds:
            kind = kind.when(clean.contains(marker), F.lit(name))
            found = F.regexp_extract(clean, pattern, 1)
            if name in fixed.SEQUENCE_KINDS:
                found = F.regexp_replace(found, r"\s+|[.?]\s*$", "")
            argument = argument.when(F.col("kind") == name, found)
    return (
        items.withColumn("_question", question_key(F.col("question")))
        .withColumn("kind", kind.otherwise(UNKNOWN))
        .withColumn("arg", argument.otherwise(F.lit(None).cast("string")))
        # In a step of its own: within the choice each argument would be cut out twice.
        .withColumn("arg", F.nullif("arg", F.lit("")))
        .drop("_question")
    )


def _piece(text: Column, separator: str, position: int) -> Column:
    return F.try_element_at(F.split(text, separator), F.lit(position))


def _coded(items: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """The literal text rules: cuts at any occurrence of short words, fixed order."""
    question = F.col("question")
    ends = F.lit("? ")
    snp = F.nullif(F.regexp_extract(question, fixed.SNP_PATTERN, 0), F.lit(""))
    after_colon = strip(_piece(question, ":", -1))
    has = question.contains
    rules = {
        "alias": (
            has("official gene symbol of"),
            F.btrim(_piece(question, "of", -1), ends),
        ),
        "disease_genes": (
            has("genes related to"),
            F.btrim(_piece(question, "to", -1), ends),
        ),
        "gene_chr": (
            has("chromosome is") & has("located"),
            strip(_piece(_piece(question, "is", 2), "gene", 1)),
        ),
        "align": (has("Align the DNA sequence to the human genome"), after_colon),
        "organism": (has("organism does the DNA sequence come from"), after_colon),
        "ensembl": (
            has("Convert") & has("to official gene symbol"),
            strip(_piece(_piece(question, "Convert", -1), "to", 1)),
        ),
        "coding": (
            has("Is") & has("a protein-coding gene?"),
            strip(_piece(_piece(question, "Is", -1), "a", 1)),
        ),
        "snp_gene": (has("gene is SNP"), snp),
        "snp_chr": (has("chromosome does SNP"), snp),
        "seq_alias": (
            has("aliases of the gene that contains this sequ"),
            F.btrim(after_colon, F.lit(".")),
        ),
        "snp_fn": (has("function of the gene associated with SNP"), snp),
    }
    kind, argument = F, F
    for name, (test, value) in rules.items():
        if name in kinds:
            kind = kind.when(test, F.lit(name))
            argument = argument.when(F.col("kind") == name, value)
    return items.withColumn("kind", kind.otherwise(UNKNOWN)).withColumn(
        "arg", argument.otherwise(F.lit(None).cast("string"))
    )


def route_questions(
    items: DataFrame,
    mode: str = "as_documented",
    kinds: Sequence[str] = ALL_KINDS,
) -> DataFrame:
    """Adds ``kind`` and ``arg``. ``kinds`` narrows the rules (nine for single hop)."""
    route = _documented if check_mode(mode) == "as_documented" else _coded
    return route(items, kinds)
