"""Documents as text columns -> rows. The readers put files in front of these."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from evalspark.functions.text import variant_to_list
from evalspark.session import written

# Every schema is given; inferring one would turn each question into a column.
NESTED = "map<string,map<string,variant>>"
PAIRED = "map<string,map<string,struct<predicted:variant,true:variant>>>"
QUESTION_LIST = "map<string,array<struct<type:string,body:string,ideal_answer:array<string>>>>"
SEARCH = "struct<esearchresult:struct<idlist:array<string>>>"
SUMMARY = "struct<result:map<string,variant>>"
LINKS = "struct<linksets:array<struct<linksetdbs:array<struct<dbto:string,links:array<string>>>>>>"


def with_serial_ids(files: DataFrame) -> DataFrame:
    """(path, number, n, rows array), stored -> (id, columns of the rows).

    ``id`` counts from 0 over all documents in the order of their paths; a row's place in
    its document comes from the array. A document starts after those before it in its
    range of paths and after all ranges before, so no task orders all of the counts; only
    one sum per range is ordered as a whole.
    """
    ranges = files.select("path", "number", "n").repartitionByRange("path", "number")
    ranges = written(ranges.withColumn("part", F.spark_partition_id()), "serial-counts")

    def before(*order: str, within: tuple[str, ...] = ()) -> Column:
        window = Window.partitionBy(*within).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(window), F.lit(0))

    parts = ranges.groupBy("part").agg(F.sum("n").alias("n")).select("part", before("part").alias("base"))
    own = ranges.select("number", "part", before("path", "number", within=("part",)).alias("start"))
    starts = own.join(parts, "part").select("number", (F.col("base") + F.col("start")).alias("start"))
    return (
        files.where("n > 0")
        .join(starts, "number")
        .select("start", F.posexplode("rows").alias("place", "row"))
        .select((F.col("start") + F.col("place")).cast("long").alias("id"), "row.*")
    )


def _by_key(schema: str, inner: str, opening: str) -> Column:
    """The JSON object ``value`` as a map; where a key has another shape, the others are kept.

    Only a document that cannot be read as a whole is read key by key, as texts first.
    """
    texts = F.from_json("value", "map<string,string>")
    single = F.transform_values(
        texts, lambda _, text: F.when(F.ltrim(text).startswith(opening), F.from_json(text, inner))
    )
    return F.coalesce(F.from_json("value", schema), single)


def _stored_documents(docs: DataFrame, name: str, shape: str, entries: Column, broken: Column) -> DataFrame:
    """Documents parsed once: (path, number, rows, n, reason, parts, value of rejects).

    ``reason`` says why a whole document gives no rows, ``parts`` names the keys whose
    values have another shape; the rows of its other keys are kept.
    """
    reason = F.when(F.col("value").isNull(), "no text").when(F.col("doc").isNull(), f"no {shape}")
    parts = F.when(F.col("doc").isNotNull(), broken)
    marked = docs.select(
        "path",
        F.monotonically_increasing_id().alias("number"),
        F.coalesce(entries, F.array()).alias("rows"),
        reason.alias("reason"),
        parts.alias("parts"),
        F.when(F.col("doc").isNull(), F.col("value")).alias("value"),
    )
    return written(marked.withColumn("n", F.array_size("rows").cast("long")), name)


def _rejects(parsed: DataFrame) -> DataFrame:
    """(path, part, reason, value): whole documents, and keys of documents that have rows."""
    whole = parsed.where("reason IS NOT NULL").select(
        "path", F.lit(None).cast("string").alias("part"), "reason", F.col("value").alias("_corrupt_record")
    )
    single = parsed.where("reason IS NULL AND array_size(parts) > 0").select(
        "path",
        F.explode("parts").alias("part"),
        F.lit("another shape").alias("reason"),
        F.lit(None).cast("string").alias("_corrupt_record"),
    )
    return whole.unionByName(single)


def last_wins(json_map: Column) -> Column:
    """Entries of a parsed JSON object; of a repeated key the last value counts.

    The key keeps the place where it first stood. Only an object that does repeat a
    key pays for the order of its keys, in which the places of a key are neighbours.
    """
    entries, keys = F.map_entries(json_map), F.map_keys(json_map)
    distinct = F.array_distinct(keys)
    order = F.array_sort(F.transform(keys, lambda k, i: F.struct(k.alias("key"), i.alias("at"))))

    def merged(order: Column) -> Column:
        def ends(step: int) -> Column:
            """First (-1) or last (1) places of the keys."""
            return F.filter(
                order, lambda x, i: ~F.coalesce(F.get(order, i + step)["key"] == x["key"], F.lit(False))
            )

        both = F.zip_with(
            ends(-1), ends(1), lambda a, b: F.struct(a["at"].alias("first"), b["at"].alias("last"))
        )
        return F.transform(F.array_sort(both), lambda x: F.struct(
            F.get(keys, x["first"]).alias("key"), F.get(F.map_values(json_map), x["last"]).alias("value")
        ))

    # The one-element arrays bind what the rules above read many times.
    return F.when(F.array_size(distinct) == F.array_size(keys), entries).otherwise(
        F.get(F.transform(F.array(order), merged), F.lit(0))
    )


def _nested_rows(docs: DataFrame, schema: str) -> DataFrame:
    """(path, value) -> (path, rows), rows being (task, question, item) in file order."""

    def of_task(task: Column) -> Column:
        return F.transform(
            last_wins(task["value"]),
            lambda q: F.struct(
                task["key"].alias("task"),
                q["key"].alias("question"),
                q["value"].alias("item"),
            ),
        )

    doc = docs.select("path", F.from_json("value", schema).alias("doc"))
    tasks = F.transform(last_wins(F.col("doc")), of_task)
    return doc.select("path", F.flatten(F.array_compact(tasks)).alias("rows"))


def nested_qa(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """task -> question -> answer(s) documents -> (id, task, question, answers) and rejects.

    A document gives rows or is a reject, so both together account for each of them; one
    without questions gives neither. A task that holds no object is a reject of its own.
    """

    def of_task(task: Column) -> Column:
        return F.transform(
            last_wins(task["value"]),
            lambda q: F.struct(
                task["key"].alias("task"),
                q["key"].alias("question"),
                variant_to_list(q["value"]).alias("answers"),
            ),
        )

    doc = docs.select("path", "value", _by_key(NESTED, "map<string,variant>", "{").alias("doc"))
    entries = F.flatten(F.array_compact(F.transform(last_wins(F.col("doc")), of_task)))
    parsed = _stored_documents(doc, "nested-qa", "object of tasks", entries, _empty_keys(F.col("doc")))
    return with_serial_ids(parsed), _rejects(parsed)


def _empty_keys(json_map: Column) -> Column:
    """Keys whose values could not be read."""
    return F.map_keys(F.map_filter(json_map, lambda _, value: value.isNull()))


def parse_nested_qa(docs: DataFrame) -> DataFrame:
    """task -> question -> answer(s) documents -> (id, task, question, answers)."""
    return nested_qa(docs)[0]


def question_list(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed question lists -> (id, task, question, answer, answers) and rejects, as above."""
    inner = QUESTION_LIST.removeprefix("map<string,").removesuffix(">")
    doc = docs.select("path", "value", _by_key(QUESTION_LIST, inner, "[").alias("doc"))
    lists = F.transform(last_wins(F.col("doc")), lambda entry: entry["value"])
    entries = F.flatten(F.array_compact(lists))
    parsed = _stored_documents(doc, "question-list", "object of lists", entries, _empty_keys(F.col("doc")))
    rows = with_serial_ids(parsed).select(
        "id",
        F.col("type").alias("task"),
        F.col("body").alias("question"),
        F.try_element_at("ideal_answer", F.lit(1)).alias("answer"),
        F.col("ideal_answer").alias("answers"),
    )
    return rows, _rejects(parsed)


def parse_question_list(docs: DataFrame) -> DataFrame:
    """Typed question lists -> (id, task, question, answer, answers)."""
    return question_list(docs)[0]


def parse_paired(docs: DataFrame) -> DataFrame:
    """task -> question -> {predicted, true} -> (task, question, predicted, true)."""
    rows = _nested_rows(docs, PAIRED).select(F.inline("rows"))
    return rows.select(
        "task",
        "question",
        variant_to_list(F.col("item.predicted")).alias("predicted"),
        variant_to_list(F.col("item.true")).alias("true"),
    )


# --- stored service replies ------------------------------------------------------------


def parse_search_docs(docs: DataFrame, k: int | None = None) -> DataFrame:
    """Search replies (term, value) -> (term, rank, uid) in reply order, cut at ``k``."""
    ids = F.from_json("value", SEARCH)["esearchresult"]["idlist"]
    if k is not None:
        ids = F.slice(ids, 1, k)
    return docs.select("term", F.posexplode(ids)).select(
        "term", (F.col("pos") + 1).alias("rank"), F.col("col").alias("uid")
    )


def _summary_rows(docs: DataFrame) -> DataFrame:
    """Reply -> (uid, item) without the reply's own list of uids."""
    return (
        docs.select(F.from_json("value", SUMMARY)["result"].alias("result"))
        .select(F.inline(last_wins(F.col("result"))).alias("uid", "item"))
        .where(F.col("uid") != "uids")
    )


def _field(path: str, kind: str = "string") -> Column:
    return F.try_variant_get(F.col("item"), path, kind)


def parse_summary_docs(docs: DataFrame) -> DataFrame:
    """Gene summary replies -> one row per uid."""
    return _summary_rows(docs).select(
        "uid",
        _field("$.name").alias("name"),
        _field("$.chromosome").alias("chromosome"),
        _field("$.nomenclaturesymbol").alias("official_symbol"),
        _field("$.nomenclaturename").alias("official_full_name"),
        _field("$.description").alias("description"),
        _field("$.organism.scientificname").alias("organism"),
        _field("$.summary").alias("summary"),
    )


def parse_snp_docs(docs: DataFrame) -> DataFrame:
    """SNP summary replies -> (rsid, chr, genes); genes may be one object or a list.

    A gene without a name counts as NA; a SNP without the field has no genes.
    """
    one = _field("$.genes.name")
    genes = _field("$.genes", "variant")
    many = F.transform(
        F.try_variant_get(genes, "$", "array<variant>"),
        lambda g: F.coalesce(F.try_variant_get(g, "$.name", "string"), F.lit("NA")),
    )
    shape = F.schema_of_variant(genes)
    return _summary_rows(docs).select(
        F.col("uid").alias("rsid"),
        _field("$.chr").alias("chr"),
        F.when(shape.startswith("ARRAY"), many)
        .when(shape.startswith("OBJECT"), F.array(F.coalesce(one, F.lit("NA"))))
        .otherwise(F.array(F.lit("NA")))
        .alias("genes"),
    )


def parse_link_docs(docs: DataFrame) -> DataFrame:
    """Link replies (rsid, value) -> (rsid, pos, gene_uid); other shapes give no rows."""
    sets = F.get(F.from_json("value", LINKS)["linksets"], F.lit(0))["linksetdbs"]
    gene_sets = F.filter(sets, lambda s: s["dbto"] == "gene")
    links = F.flatten(F.transform(gene_sets, lambda s: s["links"]))
    return docs.select("rsid", F.posexplode(links)).select(
        "rsid", "pos", F.col("col").alias("gene_uid")
    )


def parse_gene_xml(docs: DataFrame) -> DataFrame:
    """Fetched gene records (uid, value) -> (uid, gene_type) of the first gene entry."""
    described = F.xpath_string("value", F.lit("(//Gene-ref)[1]/Gene-ref_desc"))
    return docs.select(
        "uid", F.nullif(F.btrim(described), F.lit("")).alias("gene_type")
    )


# --- replies that cannot be read --------------------------------------------------------


def reply_reason(kind: str) -> Column:
    """Why the text ``value`` is no reply of this kind; null where it is one.

    Kinds: search, summary, snp, link, gene_xml. A reply without hits is a reply.
    """
    value = F.col("value")
    json = F.try_parse_json(value)

    def holding(path: str, shape: str, what: str) -> Column:
        found = F.schema_of_variant(F.try_variant_get(json, path, "variant"))
        return F.when(json.isNull(), "no JSON").when(~F.coalesce(found.startswith(shape), F.lit(False)), what)

    if kind == "gene_xml":
        # The record parser keeps a text that it cannot read.
        read = F.from_xml(value, "x STRING, _corrupt_record STRING")
        wrong = F.when(~value.rlike(r"^\s*<") | read["_corrupt_record"].isNotNull(), "no XML")
    else:
        wrong = {
            "search": holding("$.esearchresult.idlist", "ARRAY", "no list of ids"),
            "summary": holding("$.result", "OBJECT", "no records"),
            "snp": holding("$.result", "OBJECT", "no records"),
            "link": holding("$.linksets[0].linksetdbs", "ARRAY", "no sets of links"),
        }[kind]
    return F.when(value.isNull(), "no text").otherwise(wrong)


REPLY_PARSERS = {
    "search": parse_search_docs,
    "summary": parse_summary_docs,
    "snp": parse_snp_docs,
    "link": parse_link_docs,
    "gene_xml": parse_gene_xml,
}


def checked_replies(docs: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """Rows of the replies that can be read, and (path, key, reason, text) of the others.

    ``docs`` has ``path``, ``value``, the key column of the kind if it has one, and may have
    ``_corrupt_record``, the text of a line that was no reply at all. The check runs once:
    what it says is stored next to the texts.
    """
    key = {"search": "term", "link": "rsid", "gene_xml": "uid"}.get(kind)
    line = F.col("_corrupt_record") if "_corrupt_record" in docs.columns else F.lit(None).cast("string")
    reason = F.when(line.isNotNull(), "no JSON line").otherwise(reply_reason(kind))
    marked = docs.select("path", *([key] if key else []), "value", line.alias("line"), reason.alias("reason"))
    marked = written(marked, f"replies-{kind}")
    rejects = marked.where("reason IS NOT NULL").select(
        "path",
        (F.col(key) if key else F.lit(None).cast("string")).alias("key"),
        "reason",
        F.coalesce("line", "value").alias("_corrupt_record"),
    )
    return REPLY_PARSERS[kind](marked.where("reason IS NULL")), rejects
