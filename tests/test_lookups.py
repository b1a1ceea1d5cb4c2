"""Routing and lookups: edge rows, modes, skew."""

import pytest
from pyspark.sql import functions as F

from evalspark.functions import fixed
from evalspark.operators import lookups, ranking, routing
from evalspark.plans.tables import Tables
from tests.conftest import rows

SUFFIX = fixed.DECOMPOSE_SUFFIX


def routed(spark, question, mode="as_documented", **options):
    df = spark.createDataFrame([(question,)], "question STRING")
    got = routing.route_questions(df, mode, **options).first()
    return got["kind"], got["arg"]


@pytest.mark.parametrize(
    "question, kind, arg",
    [
        ("What is the official gene symbol of LMP10?", "alias", "LMP10"),
        ("What are genes related to Pseudo of X to Y?", "disease_genes", "Pseudo of X to Y"),
        ("Which chromosome is FAM1 gene located on human genome?", "gene_chr", "FAM1"),
        ("Align the DNA sequence to the human genome:ATTC", "align", "ATTC"),
        ("Which organism does the DNA sequence come from:AGGG", "organism", "AGGG"),
        ("Convert ENSG00000215251 to official gene symbol.", "ensembl", "ENSG00000215251"),
        ("Is Cabin1 a protein-coding gene?", "coding", "Cabin1"),
        ("Which gene is SNP rs12 associated with?", "snp_gene", "rs12"),
        ("Which chromosome does SNP rs14 locate on human genome?", "snp_chr", "rs14"),
        (f"What are the aliases of the gene that contains this sequnece:ACT.{SUFFIX}", "seq_alias", "ACT"),
        (
            "List chromosome locations of the genes related to Anemia due to "
            f"phosphofructokinase deficiency. {SUFFIX}",
            "disease_loc",
            "Anemia due to phosphofructokinase deficiency",
        ),
        (f"What is the function of the gene associated with SNP rs7? {SUFFIX}", "snp_fn", "rs7"),
        ("Why?", "unknown", None),
    ],
)
def test_documented_routing(spark, question, kind, arg):
    assert routed(spark, question) == (kind, arg)


@pytest.mark.parametrize(
    "question, kind, arg",
    [
        ("List chromosome locations of the genes related to Anemia due to "
         "phosphofructokinase deficiency?", "disease_genes", "kinase deficiency"),
        ("Is Cabin1 a protein-coding gene?", "coding", "C"),
        ("What is the official gene symbol of profoof1?", "alias", "1"),
    ],
)
def test_coded_routing_cuts_inside_words(spark, question, kind, arg):
    assert routed(spark, question, "as_coded") == (kind, arg)


def test_nine_rule_form_knows_no_multi_hop(spark):
    question = f"What is the function of the gene associated with SNP rs7? {SUFFIX}"
    assert routed(spark, question, kinds=fixed.SINGLE_HOP_KINDS) == ("unknown", None)


@pytest.fixture(scope="module")
def tables(spark):
    report = (
        "RID = AB12\nSequences producing significant alignments:\n\n  Mus musculus x\n"
        ">T1 Mus musculus chromosome 4, q GNAS. \nSbjct  100  ACGT  159\nSbjct  160  ACGT  219"
    )
    return {
        "gene": spark.createDataFrame(
            [
                (1, "GNAS", "E1", "20", "protein coding", None),
                (2, "SRC", "E2", None, "non-protein coding", "second"),
                (3, None, "E3", "7", None, ""),
                (4, "SRC", "E4", "5", "protein coding", "fourth"),
            ],
            "uid LONG, symbol STRING, ensembl STRING, chromosome STRING, gene_type STRING, summary STRING",
        ),
        "gene_alias": spark.createDataFrame(
            [("a", 99, 1), ("a", 4, 2), ("a", 1, 3), ("b", 91, 1), ("b", 92, 2), ("b", 93, 3),
             ("b", 1, 4), ("c", 3, 1), ("c", 1, 2), ("GNAS", 1, 1)],
            "alias STRING, uid LONG, rnk INT",
        ),
        "gene_disease": spark.createDataFrame(
            [("d", 4, 1), ("d", 2, 2), ("d", 99, 3), ("d", 1, 4), ("e", 2, 1)]
            + [("many", 1, i) for i in range(1, 15)],
            "disease STRING, uid LONG, rnk INT",
        ),
        "snp": spark.createDataFrame([("rs1", "3"), ("rs2", None)], "rsid STRING, chr STRING"),
        "snp_gene": spark.createDataFrame(
            [("rs1", 4, 2), ("rs1", 1, 1), ("rs2", 3, 1), ("rs3", 2, 1)],
            "rsid STRING, uid LONG, rnk INT",
        ),
        "reports": spark.createDataFrame(
            [("AA", report), ("CC", "Status=FAILED"), ("GG", "RID = 1\nStatus=WAITING"),
             ("TT", "No hits found")],
            "sequence STRING, report STRING",
        ),
    }


def answers(spark, job, tables, *args):
    asked = spark.createDataFrame(list(enumerate(args)), "id LONG, arg STRING")
    return [tuple(r)[2:] for r in job(asked, tables).orderBy("id").collect()]


CASES = [
    ("alias", ["a", "b", "c", "zzz"], [("SRC", "ok"), ("NA", "missing"), ("NA", "missing"), ("NA", "missing")]),
    ("disease_genes", ["d", "e", "none"], [("SRC, SRC, GNAS", "ok"), ("SRC", "ok"), ("NA", "missing")]),
    ("gene_chr", ["GNAS", "SRC", "X"], [("chr20", "ok"), ("NA", "missing"), ("NA", "missing")]),
    ("ensembl", ["E4", "E3", "E9"], [("SRC", "ok"), ("NA", "missing"), ("NA", "missing")]),
    ("snp_gene", ["rs1", "rs2", "rs9"], [("GNAS, SRC", "ok"), ("NA", "ok"), ("NA", "missing")]),
    ("snp_chr", ["rs1", "rs2", "rs9"], [("chr3", "ok"), ("NA", "missing"), ("NA", "missing")]),
    ("coding", ["GNAS", "SRC", "X"], [("TRUE", "ok"), ("NA", "missing"), ("NA", "missing")]),
    ("align", ["AA", "CC", "TT"], [("chr4:100-219", "ok"), ("Error: BLAST job failed.", "error"), ("NA", "missing")]),
    ("organism", ["AA", "GG", "TT"],
     [("mouse", "ok"), ("Error: Timed out waiting for BLAST result.", "error"), ("NA", "missing")]),
    ("seq_alias", ["AA", "CC", "TT"], [("GNAS", "ok"), ("NA", "missing"), ("NA", "missing")]),
    ("disease_loc", ["d", "e", "none"], [("5, 20", "ok"), ("NA", "missing"), ("NA", "missing")]),
    ("snp_fn", ["rs1", "rs2", "rs3"], [("fourth", "ok"), ("NA", "missing"), ("second", "ok")]),
]
JOBS = {
    "alias": lookups.alias_to_symbol,
    "disease_genes": lookups.disease_to_genes,
    "gene_chr": lookups.gene_to_chromosome,
    "ensembl": lookups.identifier_to_symbol,
    "snp_gene": lookups.snp_to_genes,
    "snp_chr": lookups.snp_to_chromosome,
    "coding": lookups.is_protein_coding,
    "align": lookups.sequence_to_region,
    "organism": lookups.sequence_to_organism,
    "seq_alias": lookups.sequence_to_alias,
    "disease_loc": lookups.disease_to_locations,
    "snp_fn": lookups.snp_to_function,
}


@pytest.mark.parametrize("kind, args, expected", CASES, ids=[c[0] for c in CASES])
def test_one_kind(spark, tables, kind, args, expected):
    assert answers(spark, JOBS[kind], tables, *args) == expected


def test_disease_lists_stop_at_ten(spark, tables):
    got = answers(spark, lookups.disease_to_genes, tables, "many")
    assert got == [(", ".join(["GNAS"] * 10), "ok")]


def test_region_modes(spark, tables):
    book = lookups.region_book(tables, "as_coded").where("arg = 'AA'").first()
    assert book["predicted"] == "chr4:100-160"


def test_all_kinds_in_one_join(spark, tables):
    items = spark.createDataFrame(
        [
            (1, "t", "Is GNAS a protein-coding gene?", "TRUE"),
            (2, "t", "Which chromosome does SNP rs1 locate on human genome?", "chr3"),
            (3, "t", "Tell me more.", "x"),
            (4, "t", "Align the DNA sequence to the human genome:CC", "chr1"),
            (5, "t", None, "x"),
        ],
        "id LONG, task STRING, question STRING, answer STRING",
    )
    got = lookups.answer_by_lookup(items, tables)
    assert rows(got.select("id", "kind", "predicted", "true", "status"), "id") == [
        (1, "coding", "TRUE", "TRUE", "ok"),
        (2, "snp_chr", "chr3", "chr3", "ok"),
        (3, "unknown", "Unknown question type.", "x", "unknown"),
        (4, "align", "Error: BLAST job failed.", "chr1", "error"),
        (5, "unknown", "Unknown question type.", "x", "unknown"),
    ]


def test_long_gene_lists_are_whole(spark, tables):
    links = spark.range(5000).select(
        F.lit("rs5").alias("rsid"), F.lit(1).cast("long").alias("uid"), F.col("id").alias("rnk")
    )
    own = {**tables, "snp_gene": links}
    asked = spark.createDataFrame([(1, "snp_gene", "rs5")], "id LONG, kind STRING, arg STRING")
    got = lookups.look_up(asked, lookups.snp_genes_book(own)).first()
    assert (got["predicted"], got["status"]) == (", ".join(["GNAS"] * 5000), "ok")
    assert lookups.snp_gene_rows(own).count() == 5000


def test_hot_argument_is_split(spark, tables, settings):
    """A third of the questions ask about one gene; the join splits that partition."""
    settings(
        autoBroadcastJoinThreshold=-1,
        adaptive__autoBroadcastJoinThreshold=-1,
        adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        adaptive__skewJoin__skewedPartitionFactor=2,
        adaptive__advisoryPartitionSizeInBytes="20KB",
        shuffle__partitions=16,
    )
    asked = spark.range(0, 120000, 1, 16).select(
        "id",
        F.when(F.col("id") % 3 == 0, "GNAS")
        .otherwise(F.concat(F.lit("X"), (F.col("id") % 5000).cast("string")))
        .alias("arg"),
    )
    answered = lookups.gene_to_chromosome(asked, tables)
    got = answered.collect()
    assert len(got) == 120000
    assert sum(r["predicted"] == "chr20" for r in got) == 40000
    assert "skew=true" in answered._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("k", [3, 1500])
def test_top_candidates(spark, k):
    hits = spark.range(4000).select(
        F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("query"), F.col("id").alias("rank")
    )
    top = ranking.top_candidates(hits, k)
    got = rows(top)
    expected = [("a", i) for i in range(0, 4000, 4)][:k] + [
        ("b", i) for i in range(4000) if i % 4
    ][:k]
    assert got == sorted(expected, key=repr)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert ("WindowGroupLimit" in plan) == (k <= 1000)


def test_first_present(spark):
    df = spark.createDataFrame(
        [("a", 1, None), ("a", 2, ""), ("a", 3, "x"), ("a", 4, "y"), ("b", 1, None)],
        "query STRING, rank INT, v STRING",
    )
    assert rows(ranking.first_present(df, "v")) == [("a", "x"), ("b", None)]


def test_gold_answers_made_from_few_rows_are_not_broadcast(spark, tmp_path):
    made = {
        "part": ([(1, "n", "b", "PROMO", 3, 1.0)], "p_partkey LONG, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE"),
        "orders": ([(5, 7)], "o_orderkey LONG, o_custkey LONG"),
        "lineitem": ([(5, 1)], "l_orderkey LONG, l_partkey LONG"),
    }
    for name, (data, schema) in made.items():
        spark.createDataFrame(data, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    gold = Tables(spark, str(tmp_path)).gold_questions
    assert gold.select("id").distinct().count() == gold.count() == 12
    gold.collect()
    plan = gold._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    (join, *_) = [line for line in plan.split("\n") if "Join" in line]
    assert "SortMergeJoin [id" in join
