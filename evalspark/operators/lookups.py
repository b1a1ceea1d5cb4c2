"""Answer questions from knowledge tables, one or two hops.

Each kind of question has an *answer book*: a table (kind, arg, predicted, status)
with one row per key of its knowledge tables. Questions meet the books in one left
equi-join. Everything before that join runs over knowledge only, so its cost does not
depend on how often a question is asked.

Knowledge tables:

=============  ==========================================================
gene           uid, symbol, ensembl, chromosome, gene_type, summary
gene_alias     alias, uid, rnk
gene_disease   disease, uid, rnk
snp            rsid, chr (one row per rsid)
snp_gene       rsid, uid, rnk
reports        sequence, report (one row per sequence)
=============  ==========================================================

``rnk`` is any column that orders the hits of a key.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from evalspark.functions import fixed, reports
from evalspark.functions.metrics import check_mode
from evalspark.operators.columns import with_computed
from evalspark.operators.ranking import first_present, ordered_values, top_candidates
from evalspark.operators.routing import ALL_KINDS, UNKNOWN, route_questions

Tables = Mapping[str, DataFrame]

NA = fixed.NOT_AVAILABLE


#: Answers that are lists; all others are lists of one.
LISTED = "array<string>"


def _book(kind: str, df: DataFrame, key: str, value: Column, status=None, listed=None) -> DataFrame:
    """Shape a knowledge result as book rows; a null value is the answer NA.

    ``listed`` holds the answer as a list, for kinds whose answer is one.
    """
    found = F.when(value.isNull() | (value == NA), "missing").otherwise("ok")
    return df.select(
        F.lit(kind).alias("kind"),
        F.col(key).alias("arg"),
        F.coalesce(value, F.lit(NA)).alias("predicted"),
        (found if status is None else status).alias("status"),
        (F.lit(None) if listed is None else listed).cast(LISTED).alias("listed"),
    )


def _chromosome(value: Column) -> Column:
    return F.when(value != NA, F.concat(F.lit("chr"), value))


def _first_gene(gene: DataFrame, key: str, value: str) -> DataFrame:
    """Value of the first record (lowest uid) of each key; the record may lack it."""
    keyed = gene.where(F.col(key).isNotNull())
    return keyed.groupBy(key).agg(F.min_by(value, "uid").alias(value))


def _alias_symbols(tables: Tables) -> DataFrame:
    """alias -> name of the first of its top hits that has a record."""
    hits = top_candidates(tables["gene_alias"], fixed.ALIAS_HITS, ["alias"], "rnk", ["uid"])
    records = tables["gene"].select("uid", F.coalesce("symbol", F.lit(NA)).alias("name"))
    found = hits.join(records, "uid", "left")
    return first_present(found, "name", ["alias"], "rnk")


def _disease_hits(tables: Tables, column: str) -> DataFrame:
    hits = top_candidates(
        tables["gene_disease"], fixed.DISEASE_HITS, ["disease"], "rnk", ["uid"]
    )
    return hits.join(tables["gene"].select("uid", column), "uid", "left")


# --- the books ------------------------------------------------------------------------


def alias_book(tables: Tables) -> DataFrame:
    return _book("alias", _alias_symbols(tables), "alias", F.col("name"))


def disease_genes_book(tables: Tables) -> DataFrame:
    names = _disease_hits(tables, "symbol").groupBy("disease").agg(
        ordered_values(F.col("rnk"), F.col("symbol")).alias("names")
    )
    joined = F.nullif(F.array_join("names", fixed.LIST_SEPARATOR), F.lit(""))
    return _book("disease_genes", names, "disease", joined)


def gene_chromosome_book(tables: Tables) -> DataFrame:
    first = _first_gene(tables["gene"], "symbol", "chromosome")
    return _book("gene_chr", first, "symbol", _chromosome(F.col("chromosome")))


def identifier_book(tables: Tables) -> DataFrame:
    first = _first_gene(tables["gene"], "ensembl", "symbol")
    return _book("ensembl", first, "ensembl", F.col("symbol"))


def coding_book(tables: Tables) -> DataFrame:
    first = _first_gene(tables["gene"], "symbol", "gene_type")
    kind = F.nullif(F.btrim("gene_type"), F.lit(""))
    coding = F.when(~kind.contains("non-protein"), F.lit(fixed.TRUE_TEXT))
    return _book("coding", first, "symbol", coding)


def snp_gene_rows(tables: Tables) -> DataFrame:
    """Gene names of every SNP, one row each (rsid, rnk, name); any number per SNP."""
    return (
        tables["snp_gene"]
        .join(tables["gene"].select("uid", "symbol"), "uid", "left")
        .select("rsid", "rnk", F.coalesce("symbol", F.lit(NA)).alias("name"))
    )


def snp_genes_book(tables: Tables) -> DataFrame:
    """rsid -> all its gene names as one text; lists are begun before the shuffle."""
    names = (
        snp_gene_rows(tables)
        .groupBy("rsid")
        .agg(ordered_values(F.col("rnk"), F.col("name")).alias("names"))
    )
    return _book("snp_gene", names, "rsid", F.array_join("names", fixed.LIST_SEPARATOR), F.lit("ok"))


def snp_chromosome_book(tables: Tables) -> DataFrame:
    return _book("snp_chr", tables["snp"], "rsid", _chromosome(F.col("chr")))


def _report_book(kind: str, df: DataFrame, value: Column) -> DataFrame:
    """Book over reports; a failed or unfinished report answers with its error text."""
    read = df.select(
        "sequence",
        reports.failure_text(F.col("report")).alias("error"),
        value.alias("value"),
    )
    status = (
        F.when(F.col("error").isNotNull(), "error")
        .when(F.col("value") == NA, "missing")
        .otherwise("ok")
    )
    return _book(kind, read, "sequence", F.coalesce("error", "value"), status)


def region_book(tables: Tables, mode: str = "as_documented") -> DataFrame:
    region = reports.region(F.col("report"), mode)
    return _report_book("align", tables["reports"], region)


def organism_book(tables: Tables) -> DataFrame:
    hits = tables["reports"].withColumn("hit", reports.first_hit(F.col("report")))
    return _report_book("organism", hits, reports.organism(F.col("hit")))


def sequence_alias_book(tables: Tables) -> DataFrame:
    """sequence -> gene in its report -> symbol of that alias; failures give NA.

    Reports without a gene are answered aside; in the join they would all have one key.
    A gene that many reports name is split, as both sides are exchanged for the join.
    """
    ready = reports.failure_text(F.col("report")).isNull()
    genes = with_computed(
        tables["reports"].select("sequence", "report"),
        alias=F.when(ready, reports.gene(F.col("report"))),
    ).select("sequence", "alias")
    key = F.xxhash64("alias").alias("alias_hash")
    named = genes.where(F.col("alias").isNotNull()).select("*", key)
    symbols = _alias_symbols(tables).select("*", key)
    found = named.join(symbols, ["alias_hash", "alias"], "left").select("sequence", "name")
    none = genes.where(F.col("alias").isNull()).select(
        "sequence", F.lit(None).cast("string").alias("name")
    )
    return _book("seq_alias", found.unionByName(none), "sequence", F.col("name"))


def disease_locations_book(tables: Tables) -> DataFrame:
    """disease -> chromosomes of its genes in rank order, those without one left out."""
    places = (
        _disease_hits(tables, "chromosome")
        .groupBy("disease")
        .agg(
            ordered_values(
                F.col("rnk"), F.nullif(F.col("chromosome"), F.lit(""))
            ).alias("places")
        )
    )
    joined = F.nullif(F.array_join("places", fixed.LIST_SEPARATOR), F.lit(""))
    return _book("disease_loc", places, "disease", joined, listed=F.col("places"))


def snp_function_book(tables: Tables) -> DataFrame:
    linked = tables["snp_gene"].join(
        tables["gene"].select("uid", "summary"), "uid", "left"
    )
    first = first_present(linked, "summary", ["rsid"], "rnk")
    return _book("snp_fn", first, "rsid", F.col("summary"))


BOOKS: dict[str, Callable[[Tables], DataFrame]] = {
    "alias": alias_book,
    "disease_genes": disease_genes_book,
    "gene_chr": gene_chromosome_book,
    "align": region_book,
    "organism": organism_book,
    "ensembl": identifier_book,
    "coding": coding_book,
    "snp_gene": snp_genes_book,
    "snp_chr": snp_chromosome_book,
    "seq_alias": sequence_alias_book,
    "disease_loc": disease_locations_book,
    "snp_fn": snp_function_book,
}


# --- two books from one pass over their tables ---------------------------------------------


def _book_rows(df: DataFrame, key: str, *books: tuple[str, Column, Column | None], **listed: Column) -> DataFrame:
    """As :func:`_book` for several (kind, value, status), from each row of ``df``.

    ``listed`` names the kinds whose answers are lists.
    """
    named = {f"_{kind}": value for kind, value, _ in books}
    rows = []
    computed = with_computed(df, **named)
    for kind, _, status in books:
        value = F.col(f"_{kind}")
        found = F.when(value.isNull() | (value == NA), "missing").otherwise("ok")
        rows.append(
            F.struct(
                F.lit(kind).alias("kind"),
                F.col(key).alias("arg"),
                F.coalesce(value, F.lit(NA)).alias("predicted"),
                (found if status is None else status).alias("status"),
                listed.get(kind, F.lit(None)).cast(LISTED).alias("listed"),
            )
        )
    return computed.select(F.inline(F.array(*rows)))


def _symbol_books(tables: Tables, mode: str) -> DataFrame:
    keyed = tables["gene"].where(F.col("symbol").isNotNull())
    first = keyed.groupBy("symbol").agg(
        F.min_by("chromosome", "uid").alias("chromosome"),
        F.min_by("gene_type", "uid").alias("gene_type"),
    )
    kind = F.nullif(F.btrim("gene_type"), F.lit(""))
    coding = F.when(~kind.contains("non-protein"), F.lit(fixed.TRUE_TEXT))
    return _book_rows(
        first,
        "symbol",
        ("gene_chr", _chromosome(F.col("chromosome")), None),
        ("coding", coding, None),
    )


def _disease_books(tables: Tables, mode: str) -> DataFrame:
    hits = top_candidates(tables["gene_disease"], fixed.DISEASE_HITS, ["disease"], "rnk", ["uid"])
    found = hits.join(tables["gene"].select("uid", "symbol", "chromosome"), "uid", "left")

    lists = found.groupBy("disease").agg(
        F.array_join(ordered_values(F.col("rnk"), F.col("symbol")), fixed.LIST_SEPARATOR).alias("names"),
        ordered_values(F.col("rnk"), F.nullif(F.col("chromosome"), F.lit(""))).alias("places"),
    )
    empty = F.lit("")
    joined = F.array_join("places", fixed.LIST_SEPARATOR)
    return _book_rows(
        lists,
        "disease",
        ("disease_genes", F.nullif(F.col("names"), empty), None),
        ("disease_loc", F.nullif(joined, empty), None),
        disease_loc=F.col("places"),
    )


def _snp_books(tables: Tables, mode: str) -> DataFrame:
    linked = tables["snp_gene"].join(
        tables["gene"].select("uid", "symbol", "summary"), "uid", "left"
    )
    name = F.coalesce("symbol", F.lit(NA))
    present = F.col("summary").isNotNull() & (F.col("summary") != "")
    lists = linked.groupBy("rsid").agg(
        F.array_join(ordered_values(F.col("rnk"), name), fixed.LIST_SEPARATOR).alias("names"),
        F.min_by("summary", F.when(present, F.col("rnk"))).alias("summary"),
    )
    return _book_rows(
        lists,
        "rsid",
        ("snp_gene", F.col("names"), F.lit("ok")),
        ("snp_fn", F.col("summary"), None),
    )


def _report_books(tables: Tables, mode: str) -> DataFrame:
    read = with_computed(
        tables["reports"],
        error=reports.failure_text(F.col("report")),
        hit=reports.first_hit(F.col("report")),
        region=reports.region(F.col("report"), mode),
    ).withColumn("species", reports.organism(F.col("hit")))

    def status(value: str) -> Column:
        return (
            F.when(F.col("error").isNotNull(), "error")
            .when(F.col(value) == NA, "missing")
            .otherwise("ok")
        )

    return _book_rows(
        read,
        "sequence",
        ("align", F.coalesce("error", "region"), status("region")),
        ("organism", F.coalesce("error", "species"), status("species")),
    )


SHARED: dict[tuple[str, str], Callable[[Tables, str], DataFrame]] = {
    ("gene_chr", "coding"): _symbol_books,
    ("disease_genes", "disease_loc"): _disease_books,
    ("snp_gene", "snp_fn"): _snp_books,
    ("align", "organism"): _report_books,
}


def answer_book(
    tables: Tables,
    kinds: Sequence[str] = ALL_KINDS,
    mode: str = "as_documented",
) -> DataFrame:
    """Books of several kinds as one; kinds that read the same tables share the pass."""
    check_mode(mode)
    builders = dict(BOOKS, align=lambda t: region_book(t, mode))
    left, parts = list(kinds), []
    for pair, build in SHARED.items():
        if set(pair) <= set(left):
            parts.append(build(tables, mode))
            left = [k for k in left if k not in pair]
    parts += [builders[k](tables) for k in left]
    return reduce(DataFrame.unionByName, parts)


# --- the join -----------------------------------------------------------------------------


def look_up(questions: DataFrame, book: DataFrame, typed: bool = False) -> DataFrame:
    """Left join of routed questions (…, kind, arg) with a book.

    With ``typed``, ``answers`` holds each answer as an array: all values of a listed
    answer, else the one text.

    The join also runs on a hash of (kind, arg). No input is laid out by that hash, so
    both sides are exchanged right under the join; that is what lets adaptive execution
    split an argument that a large share of the questions ask about. The hash also
    spares long arguments, such as sequences, most text comparisons.
    """
    key = F.xxhash64("kind", "arg").alias("arg_hash")
    left = questions.select("*", key)
    right = book.select("*", key)
    joined = left.join(right, ["arg_hash", "kind", "arg"], "left")
    unknown = F.col("kind") == UNKNOWN
    predicted = F.when(unknown, F.lit(fixed.UNKNOWN_QUESTION)).otherwise(
        F.coalesce("predicted", F.lit(NA))
    )
    status = F.when(unknown, "unknown").otherwise(
        F.coalesce("status", F.lit("missing"))
    )
    kept = [c for c in questions.columns if c not in ("predicted", "status", "answers")]
    answered = [*kept, predicted.alias("predicted"), status.alias("status")]
    if not typed:
        return joined.select(*answered)
    got = joined.select(*answered, "listed")
    several = F.when(F.col("status") == "ok", F.col("listed"))
    return got.select(*kept, "predicted", "status", F.coalesce(several, F.array("predicted")).alias("answers"))


def _one_kind(kind: str):
    def job(questions: DataFrame, tables: Tables) -> DataFrame:
        asked = questions.withColumn("kind", F.lit(kind))
        return look_up(asked, BOOKS[kind](tables)).drop("kind")

    job.__doc__ = f"Questions (…, arg) -> predicted, status by the {kind!r} book."
    return job


alias_to_symbol = _one_kind("alias")
disease_to_genes = _one_kind("disease_genes")
gene_to_chromosome = _one_kind("gene_chr")
identifier_to_symbol = _one_kind("ensembl")
snp_to_genes = _one_kind("snp_gene")
snp_to_chromosome = _one_kind("snp_chr")
is_protein_coding = _one_kind("coding")
sequence_to_region = _one_kind("align")
sequence_to_organism = _one_kind("organism")
sequence_to_alias = _one_kind("seq_alias")
disease_to_locations = _one_kind("disease_loc")
snp_to_function = _one_kind("snp_fn")


def answer_by_lookup(
    items: DataFrame,
    tables: Tables,
    mode: str = "as_documented",
    kinds: Sequence[str] = ALL_KINDS,
    typed: bool = False,
) -> DataFrame:
    """Route every question and answer it -> (id, task, question, predicted, true, status).

    The questions are read once and shuffled once, whatever the number of kinds. With
    ``typed``, ``answers`` (array) follows, for :func:`write_paired` and list metrics.
    """
    routed = route_questions(items, mode, kinds)
    answered = look_up(routed, answer_book(tables, kinds, mode), typed)
    more = ["answers"] if typed else []
    return answered.select(
        "id",
        "task",
        "question",
        "kind",
        "predicted",
        F.col("answer").alias("true"),
        "status",
        *more,
    )


answer_all = answer_by_lookup
