"""Normalisation and metrics, one case per rule."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from evalspark.functions import fixed, metrics, text
from evalspark.operators import scoring
from evalspark.plans.tables import Tables
from tests.conftest import rows

SCHEMA = "id LONG, task STRING, answer STRING, raw_prediction STRING, success BOOLEAN"


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def lit_list(*values):
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


@pytest.mark.parametrize(
    "pred, gold, score", [("chr1", "chr1", 1.0), ("chr1", "chr2", 0.0), (" CHR1\n", "chr1", 1.0)]
)
def test_exact_match(spark, pred, gold, score):
    assert value(spark, metrics.exact_match(F.lit(pred), F.lit(gold))) == score


@pytest.mark.parametrize(
    "pred, gold, score",
    [
        (["BRCA1", "TP53"], ["TP53"], 1.0),
        (["chr1:100-200", "chr2:300-400"], ["chr1:100-200"], 1.0),
        (["a"], ["a", "b"], 0.5),
        (["a", "a"], ["A ", "a", "b"], 0.5),
        ([], [], 1.0),
        (["a"], [], 0.0),
        ([], ["a"], 0.0),
    ],
)
def test_set_recall(spark, pred, gold, score):
    got = value(spark, metrics.set_recall(lit_list(*pred), lit_list(*gold)))
    assert got == pytest.approx(score)


@pytest.mark.parametrize(
    "pred, gold, score",
    [
        ("chr1:100-200", "chr1:100-200", 1.0),
        ("chr1:123-456", "chr1:789-999", 0.5),
        ("chr2:123-456", "chr1:789-999", 0.0),
        (" CHR1", "chr1:5", 0.5),
    ],
)
def test_region_match(spark, pred, gold, score):
    assert value(spark, metrics.region_match(F.lit(pred), F.lit(gold))) == score


@pytest.mark.parametrize(
    "a, b, distance",
    [("POC1B-GALNT4", "GALNT4", 6), ("GALNT5", "GALNT4", 1), ("é", "e", 1), ("", "", 0)],
)
def test_edit_distance(spark, a, b, distance):
    assert value(spark, metrics.edit_distance(F.lit(a), F.lit(b))) == distance
    longest = max(len(a), len(b))
    ratio = 1.0 if longest == 0 else 1 - distance / longest
    assert value(spark, metrics.fuzzy_ratio(F.lit(a), F.lit(b))) == pytest.approx(ratio)


def test_strip_takes_every_whitespace(spark):
    assert value(spark, text.strip(F.lit(" \t a b \n\xa0\x1c"))) == "a b"
    assert value(spark, text.last_token(F.lit(" a b\n"))) == "b"
    assert value(spark, text.last_token(F.lit(" \n"))) is None


@pytest.mark.parametrize(
    "task, raw, normalised",
    [
        (fixed.TASK_SNP_LOCATION, "SNP rs123 is located on 1", ["chr1"]),
        (fixed.TASK_SNP_LOCATION, "on chr7\n", ["chr7"]),
        (fixed.TASK_GENE_LOCATION, "  ", None),
        (fixed.TASK_CODING, "Answer: Yes", ["TRUE"]),
        (fixed.TASK_CODING, "Answer: No", ["NA"]),
        (fixed.TASK_CODING, "perhaps", ["perhaps"]),
        (fixed.TASK_SPECIES, "Answer: Danio rerio", ["zebrafish"]),
        (fixed.TASK_SPECIES, "Canis lupus", ["Canis lupus"]),
        (fixed.TASK_GENE_DISEASE, "Answer: A, B", ["A", "B"]),
        (fixed.TASK_DISEASE_LOCATION, "", [""]),
        (fixed.TASK_GENE_DISEASE, "A, , B", ["A", "", "B"]),
        ("anything else", " Answer: GNAS \t", ["GNAS"]),
        ("anything else", None, None),
    ],
)
def test_normalised_answers(spark, task, raw, normalised):
    df = spark.createDataFrame([(task, raw)], "task STRING, raw_prediction STRING")
    assert scoring.normalise_answers(df).first()["normalised"] == normalised


def test_list_answers_are_joined_first(spark):
    df = spark.createDataFrame(
        [(fixed.TASK_GENE_LOCATION, ["on", "5"])], "task STRING, raw_prediction ARRAY<STRING>"
    )
    assert scoring.normalise_answers(df).first()["normalised"] == ["chr5"]


def scored(spark, data, **options):
    df = spark.createDataFrame(data, SCHEMA)
    return scoring.score_answers(df, **options)


def test_failures_score_zero_and_lose_their_texts(spark):
    data = [
        (1, "t", "a", "a", True),
        (2, "t", "a", "a", False),
        (3, "t", "a", None, True),
        (4, fixed.TASK_GENE_LOCATION, "chr1", " ", True),
        (5, fixed.TASK_GENE_LOCATION, "", "chr1", True),
        (6, "t", "a", "b", None),
    ]
    got = {
        r["id"]: (r["raw_prediction"], r["processed_prediction"], r["score"], r["success"], r["status"])
        for r in scored(spark, data).collect()
    }
    assert got[1] == ("a", "a", 1.0, True, "ok")
    assert got[2] == (None, None, 0.0, False, "no_answer")
    assert got[3] == (None, None, 0.0, False, "no_answer")
    assert got[4] == (None, None, 0.0, False, "not_normalised")
    assert got[5] == (None, None, 0.0, False, "not_normalised")
    assert got[6] == (None, None, 0.0, False, "no_answer")


def test_gene_location_differs_by_mode(spark):
    data = [(1, fixed.TASK_GENE_LOCATION, "chr18", "chr8", True)]
    assert scored(spark, data).first()["score"] == 0.0
    coded = scored(spark, data, mode="as_coded").first()
    assert coded["score"] == pytest.approx(0.8)


def test_disease_location_differs_by_mode(spark):
    data = [(1, fixed.TASK_DISEASE_LOCATION, "chr1, chr2", "chr2, chr3", True)]
    documented = scored(spark, data).first()
    assert (documented["score"], documented["success"]) == (0.5, True)
    assert documented["processed_prediction"] == "['chr2', 'chr3']"
    coded = scored(spark, data, mode="as_coded").first()
    assert (coded["score"], coded["success"], coded["status"]) == (0.0, False, "not_scored")


def test_registry_can_be_extended(spark):
    data = [(1, "length", "abc", "abd", True)]
    registry = {"length": lambda p, g: (F.char_length(F.get(p, 0)) == F.char_length(F.get(g, 0))).cast("double")}
    assert scored(spark, data, registry=registry).first()["score"] == 1.0
    with pytest.raises(ValueError):
        scored(spark, data, mode="other")


def test_registry_takes_a_pandas_function(spark):
    @F.pandas_udf("double")
    def same_start(a: pd.Series, b: pd.Series) -> pd.Series:
        return (a.str[:1] == b.str[:1]).astype("float64")

    registry = {"start": lambda p, g: same_start(F.get(p, F.lit(0)), F.get(g, F.lit(0)))}
    data = [(1, "start", "abc", "axx", True), (2, "start", "abc", "x", True)]
    got = scored(spark, data, registry=registry).orderBy("id").collect()
    assert [r["score"] for r in got] == [1.0, 0.0]


def test_scores_with_context(spark):
    df = spark.createDataFrame(
        [(1, fixed.TASK_GENE_DISEASE, "A, B", "Answer: A, C", True, [1.0, 0.0], [1.0, 1.0])],
        SCHEMA + ", pred_vector ARRAY<FLOAT>, gold_vector ARRAY<FLOAT>",
    )
    got = scoring.score_with_context(df).first()
    assert got["score"] == 0.5
    assert got["edit_distance"] == 1
    assert got["fuzzy_ratio"] == pytest.approx(0.75)
    assert got["cosine_similarity"] == pytest.approx(2**-0.5)


def test_list_literals(spark):
    df = spark.createDataFrame(
        [("['a', 'b']",), ("plain",), ("[not a list",), ("[broken]x]",), (None,), ("[]",)],
        "answer STRING",
    )
    got = [r["v"] for r in df.select(text.parse_list_literal(F.col("answer")).alias("v")).collect()]
    assert got == [["a", "b"], ["plain"], ["[not a list"], ["[broken]x]"], None, []]
    back = value(spark, text.list_literal(lit_list("a", "it's", 'say "x"')))
    assert back == """['a', "it's", 'say "x"']"""
    assert eval(back) == ["a", "it's", 'say "x"']


def test_scoring_does_not_shuffle(spark):
    df = spark.createDataFrame([(1, "t", "a", "a", True)], SCHEMA)
    plan = scoring.score_with_context(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert rows(df)


def test_answers_of_one_row_group_are_scored_by_many_tasks(spark):
    tables = Tables(spark, "/root/testdata/sf0.001")
    assert tables.read("part").rdd.getNumPartitions() == 1
    assert scoring.score_answers(tables.mixed_answers).rdd.getNumPartitions() > 1
