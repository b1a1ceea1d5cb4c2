"""Column builders that read alignment report texts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from evalspark.functions import fixed
from evalspark.functions.metrics import check_mode, common_name
from evalspark.functions.text import first_group


def request_id(text: Column) -> Column:
    return first_group(text, fixed.REPORT_ID_PATTERN)


def status(text: Column) -> Column:
    """waiting / failed / no_hits / ready, tested in this order; null without a text."""
    return (
        F.when(text.contains(fixed.REPORT_WAITING), "waiting")
        .when(text.contains(fixed.REPORT_FAILED_MARK), "failed")
        .when(text.contains(fixed.REPORT_NO_HITS), "no_hits")
        .when(text.isNotNull(), "ready")
    )


def region(text: Column, mode: str = "as_documented") -> Column:
    """``chrN:start-end`` of the first hit, or NA.

    The end is the last number of the last subject line (as documented) or its
    first number (as coded); without a last number the first one is used.
    """
    chromosome = first_group(text, fixed.REPORT_CHROMOSOME_PATTERN)
    starts = F.regexp_extract_all(text, F.lit(fixed.REPORT_SUBJECT_START), F.lit(1))
    start = F.get(starts, F.lit(0))
    end = F.try_element_at(starts, F.lit(-1))
    if check_mode(mode) == "as_documented":
        last_line = F.substring_index(text, "Sbjct", -1)
        own_end = first_group(
            F.concat(F.lit("Sbjct"), last_line), fixed.REPORT_SUBJECT_END
        )
        end = F.coalesce(own_end, end)
    found = F.concat(F.lit("chr"), chromosome, F.lit(":"), start, F.lit("-"), end)
    return F.coalesce(found, F.lit(fixed.NOT_AVAILABLE))


def first_hit(text: Column) -> Column:
    """First non-blank line after the header line, else NA."""
    pattern = fixed.REPORT_HEADER + r"[^\r\n]*\r?\n\s*?([^\r\n]*\S[^\r\n]*)"
    return F.coalesce(first_group(text, pattern), F.lit(fixed.NOT_AVAILABLE))


def organism(hit: Column) -> Column:
    """Common name of the first organism of the map that a hit line holds, else NA."""
    chain = F
    for scientific, common in fixed.ORGANISMS.items():
        chain = chain.when(hit.contains(scientific) | hit.contains(common), common)
    return chain.otherwise(fixed.NOT_AVAILABLE)


def organism_by_pattern(hit: Column) -> Column:
    """Second form: the first *Genus species* of a hit line; unknown names stay."""
    name = first_group(hit, fixed.SPECIES_PATTERN)
    return F.coalesce(common_name(name), F.lit(fixed.NOT_AVAILABLE))


def gene(text: Column) -> Column:
    """Gene symbol in the title of the first hit; null if there is none."""
    return first_group(text, fixed.REPORT_GENE_PATTERN)


def failure_text(text: Column) -> Column:
    """Error answer of a report that failed or never became ready; else null."""
    state = status(text)
    return F.when(
        state == "failed", F.lit(fixed.ERROR_PREFIX + fixed.REPORT_FAILED)
    ).when(state == "waiting", F.lit(fixed.ERROR_PREFIX + fixed.REPORT_TIMED_OUT))
