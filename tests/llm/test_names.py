"""Foreign columns with the names that jobs use inside come back as they were."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from evalspark.llm import dedup, language, mixing, pii, sharding

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
TEXT = "the cat sat on the mat and looked at the dog by the door "
NAMES = (
    "_ _rest copy copies chance low left _last _u _class _key _range _part _row _base _place _local _ends _digest "
    "_first _head _again _weight _all score lang_pred kinds n_values digest bands part `dotted.name`"
).split()
JOBS = {
    "mixed": mixing.mixed,
    "mix_rows": mixing.mix_rows,
    "sharded": sharding.sharded,
    "distinct": dedup.distinct_documents,
    "known": language.known_language,
    "private": pii.private,
}


@pytest.mark.parametrize("name", JOBS)
def test_names_do_not_clash(spark, name):
    rows = [(i, TEXT * (1 + i % 3) + f"call {i} a.b{i}@x.org", "en", f"s{i % 2}", 9) for i in range(12)]
    docs = spark.createDataFrame([*rows, (5, None, None, None, None)], DOCS).coalesce(1)
    # Names that are one but for the case of letters would be one to Spark.
    more = docs.select("*", *[F.lit(n).alias(n.strip("`")) for n in NAMES])
    plain, got = JOBS[name](docs), JOBS[name](more)
    assert Counter(map(tuple, got.select(*plain.columns).collect())) == Counter(map(tuple, plain.collect()))
    kept = got.select(*[F.col(n if "`" in n else f"`{n}`") for n in NAMES]).distinct().collect()
    assert [tuple(r) for r in kept] == [tuple(NAMES)]
