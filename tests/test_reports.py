from evalspark.operators.reports import parse_reports

HEADER = "Sequences producing significant alignments:   Score\r\n \r\n"


def parsed(spark, text, mode="as_documented"):
    df = spark.createDataFrame([(1, text)], "query_id LONG, report STRING")
    return parse_reports(df, mode=mode).first()


def test_full_report(spark):
    text = (
        f"RID = XYZ9\n{HEADER}  Gallus gallus clone   \nother\n"
        ">AB Gallus gallus chromosome 12, whole GATA1. x\n"
        "Query 1 ACG 3\nSbjct  500  ACGT  559\n\nSbjct  560  AC  561\n"
    )
    got = parsed(spark, text)
    assert got["request_id"] == "XYZ9"
    assert got["status"] == "ready"
    assert got["region"] == "chr12:500-561"
    assert got["first_hit"] == "  Gallus gallus clone   "
    assert got["organism"] == "chicken"
    assert got["organism_name"] == "chicken"
    assert got["gene"] == "GATA1"
    assert parsed(spark, text, "as_coded")["region"] == "chr12:500-560"


def test_end_falls_back_to_the_first_number(spark):
    got = parsed(spark, ">A chromosome X\nSbjct  5  ACGT  9\nSbjct  10  ACGT")
    assert got["region"] == "chrX:5-10"


def test_missing_parts(spark):
    got = parsed(spark, "nothing here")
    assert got["request_id"] is None
    assert (got["region"], got["first_hit"], got["organism"]) == ("NA", "NA", "NA")
    assert got["gene"] is None
    assert parsed(spark, None)["status"] is None
    assert parsed(spark, ">A chromosome 1\nno subject lines")["region"] == "NA"


def test_status_order(spark):
    for text, status in {
        "Status=WAITING No hits found": "waiting",
        "Status=FAILED": "failed",
        "No hits found": "no_hits",
    }.items():
        assert parsed(spark, text)["status"] == status


def test_organism_forms_differ_on_unknown_names(spark):
    got = parsed(spark, f"{HEADER}Canis lupus x")
    assert (got["organism"], got["organism_name"]) == ("NA", "Canis lupus")
    got = parsed(spark, f"{HEADER}a mouse clone")
    assert (got["organism"], got["organism_name"]) == ("mouse", "NA")
