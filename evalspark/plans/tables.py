"""Tables derived from the given Parquet tables by plain arithmetic on their keys."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from evalspark.functions import fixed
from evalspark.operators.ranking import ordered_values, top_candidates

# Question texts by kind; {x} is the argument.
QUESTION_TEXTS = {
    "alias": "What is the official gene symbol of {x}?",
    "disease_genes": "What are genes related to {x}?",
    "gene_chr": "Which chromosome is {x} gene located on human genome?",
    "align": "Align the DNA sequence to the human genome:{x}",
    "organism": "Which organism does the DNA sequence come from:{x}",
    "ensembl": "Convert {x} to official gene symbol.",
    "coding": "Is {x} a protein-coding gene?",
    "snp_gene": "Which gene is SNP {x} associated with?",
    "snp_chr": "Which chromosome does SNP {x} locate on human genome?",
    "seq_alias": "What are the aliases of the gene that contains this sequnece:{x}.",
    "disease_loc": "List chromosome locations of the genes related to {x}.",
    "snp_fn": "What is the function of the gene associated with SNP {x}?",
}
#: Task that a kind of question is scored as.
KIND_TASKS = {
    "alias": fixed.TASK_GENE_ALIAS,
    "disease_genes": fixed.TASK_GENE_DISEASE,
    "gene_chr": fixed.TASK_GENE_LOCATION,
    "align": fixed.TASK_ALIGNMENT,
    "organism": fixed.TASK_SPECIES,
    "ensembl": "Gene name conversion",
    "coding": fixed.TASK_CODING,
    "snp_gene": "Gene SNP association",
    "snp_chr": fixed.TASK_SNP_LOCATION,
    "seq_alias": "Sequence gene alias",
    "disease_loc": fixed.TASK_DISEASE_LOCATION,
    "snp_fn": "SNP gene function",
}
MULTI_HOP = ("seq_alias", "disease_loc", "snp_fn")
SEQUENCE_LETTERS = ("AA", "AC", "AG", "AT", "CA", "CC", "CG", "CT", "GA", "GC")


def question_text(kind: str, argument: Column) -> Column:
    before, after = QUESTION_TEXTS[kind].split("{x}")
    if kind in MULTI_HOP:
        after = f"{after} {fixed.DECOMPOSE_SUFFIX}"
    return F.concat(F.lit(before), argument, F.lit(after))


def sequence_of(number: Column) -> Column:
    """Number -> letters: each digit becomes its pair of letters."""
    digits = number.cast("string")
    for digit, pair in enumerate(SEQUENCE_LETTERS):
        digits = F.replace(digits, F.lit(str(digit)), F.lit(pair))
    return digits


def _text(column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


class Tables:
    """The given tables of one folder and what is derived from them, all lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # --- knowledge --------------------------------------------------------------------

    @cached_property
    def gene(self) -> DataFrame:
        key = _text("p_partkey")
        return self.read("part").select(
            F.col("p_partkey").alias("uid"),
            F.concat(F.lit("GENE"), key).alias("symbol"),
            F.concat(F.lit("ENSG"), F.lpad(key, 11, "0")).alias("ensembl"),
            F.when(F.col("p_size") % 7 != 0, _text(F.col("p_size") % 22 + 1)).alias(
                "chromosome"
            ),
            F.when(F.col("p_type") == "PROMO", "non-protein coding")
            .otherwise("protein coding")
            .alias("gene_type"),
            F.when(
                F.col("p_partkey") % 3 != 0,
                F.concat("p_name", F.lit(" of "), "p_brand"),
            ).alias("summary"),
        )

    @cached_property
    def gene_alias(self) -> DataFrame:
        """Names (few, shared by many genes) and each gene's own symbol."""
        part = self.read("part")
        uid = F.col("p_partkey").alias("uid")
        rank = F.col("p_partkey").alias("rnk")
        own = F.concat(F.lit("GENE"), _text("p_partkey")).alias("alias")
        names = part.select(F.col("p_name").alias("alias"), uid, rank)
        return names.unionByName(part.select(own, uid, rank))

    @cached_property
    def gene_disease(self) -> DataFrame:
        return self.read("part").select(
            F.concat("p_brand", F.lit(" "), "p_type").alias("disease"),
            F.col("p_partkey").alias("uid"),
            F.col("p_partkey").alias("rnk"),
        )

    @cached_property
    def snp(self) -> DataFrame:
        return self.read("orders").select(
            F.concat(F.lit("rs"), _text("o_orderkey")).alias("rsid"),
            F.when(
                F.col("o_orderkey") % 11 != 0, _text(F.col("o_custkey") % 22 + 1)
            ).alias("chr"),
        )

    @cached_property
    def snp_gene(self) -> DataFrame:
        links = self.read("lineitem").select("l_orderkey", "l_partkey").distinct()
        return links.select(
            F.concat(F.lit("rs"), _text("l_orderkey")).alias("rsid"),
            F.col("l_partkey").alias("uid"),
            F.col("l_partkey").alias("rnk"),
        )

    @cached_property
    def reports(self) -> DataFrame:
        """Alignment-like texts; some failed, some unfinished, some without hits."""
        key, chromosome = _text("p_partkey"), _text(F.col("p_size") % 22 + 1)
        names = list(fixed.ORGANISMS)
        name = F.element_at(
            F.array(*[F.lit(n) for n in [*names, "Canis lupus"]]),
            (F.col("p_partkey") % (len(names) + 1) + 1).cast("int"),
        )
        start = F.col("p_partkey") * 100
        ready = F.concat(
            F.lit("RID = Q"), key,
            F.lit("\nSequences producing significant alignments:\n\n  "), name,
            F.lit(" chromosome "), chromosome,
            F.lit("\n>NC_1 "), name, F.lit(" chromosome "), chromosome,
            F.lit(", part GENE"), key, F.lit(". \nSbjct  "), _text(start),
            F.lit("  ACGT  "), _text(start + 59),
            F.lit("\nSbjct  "), _text(start + 60), F.lit("  ACGT"),
            F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("  "), _text(start + 127)))
            .otherwise(F.lit("")),
        )
        state = F.col("p_partkey") % 13
        return self.read("part").select(
            F.col("p_partkey").alias("query_id"),
            sequence_of(F.col("p_partkey")).alias("sequence"),
            F.when(state == 5, F.concat(F.lit("RID = Q"), key, F.lit("\nStatus=WAITING")))
            .when(state == 7, F.lit("Status=FAILED"))
            .when(state == 9, F.concat(F.lit("RID = Q"), key, F.lit("\nNo hits found")))
            .otherwise(ready)
            .alias("report"),
        )

    @cached_property
    def knowledge(self) -> dict[str, DataFrame]:
        return {
            "gene": self.gene,
            "gene_alias": self.gene_alias,
            "gene_disease": self.gene_disease,
            "snp": self.snp,
            "snp_gene": self.snp_gene,
            "reports": self.reports,
        }

    # --- questions and answers ---------------------------------------------------------

    @cached_property
    def items(self) -> DataFrame:
        """Three questions with gold answers per gene, from one read."""
        gene = self.gene

        def item(place: int, task: str, question: Column, answer: Column) -> Column:
            return F.struct(
                (F.col("uid") * 10 + place).alias("id"),
                F.lit(task).alias("task"),
                question.alias("question"),
                answer.alias("answer"),
            )

        coding = F.when(F.col("gene_type").contains("non-protein"), "NA").otherwise("TRUE")
        place = F.coalesce(F.concat(F.lit("chr"), F.col("chromosome")), F.lit("NA"))
        return gene.select(
            F.inline(
                F.array(
                    item(1, "Gene location", question_text("gene_chr", F.col("symbol")), place),
                    item(
                        2,
                        "Gene name conversion",
                        question_text("ensembl", F.col("ensembl")),
                        F.col("symbol"),
                    ),
                    item(3, "Protein-coding genes", question_text("coding", F.col("symbol")), coding),
                )
            )
        )

    @cached_property
    def preds(self) -> DataFrame:
        """Answers to the items with controlled faults, by question key modulo 5."""
        fault = (F.col("id") - F.col("id") % 10) % 50
        answer = F.col("answer")
        raw = (
            F.when(fault == 0, F.concat(F.lit("Answer: "), answer))
            .when(fault == 10, F.concat(F.lit("  "), F.lower(answer), F.lit(" ")))
            .when(fault == 20, F.concat(answer, F.lit("9")))
            .when(fault == 30, answer)
        )
        return self.items.select(
            "id", "task", "question", "answer",
            raw.alias("raw_prediction"),
            (fault != 40).alias("success"),
        )

    @cached_property
    def mixed_answers(self) -> DataFrame:
        """One answer to each kind of task per part, right and wrong ones."""
        size, key = F.col("p_size"), F.col("p_partkey")
        names = list(fixed.ORGANISMS)
        name = F.element_at(
            F.array(*[F.lit(n) for n in [*names, "Canis lupus"]]),
            (key % (len(names) + 1) + 1).cast("int"),
        )
        common = F.element_at(
            F.array(*[F.lit(n) for n in [*fixed.ORGANISMS.values(), "dog"]]),
            (key % (len(names) + 1) + 1).cast("int"),
        )

        def row(place: int, task: str, raw: Column, gold: Column) -> Column:
            return F.struct(
                (key * 10 + place).alias("id"),
                F.lit(task).alias("task"),
                raw.alias("raw_prediction"),
                gold.alias("answer"),
            )

        def gene(shift: int) -> Column:
            return F.concat(F.lit("GENE"), _text(key + shift))

        def chromosome(shift: int) -> Column:
            return F.concat(F.lit("chr"), _text((size + shift) % 22 + 1))

        blank = F.when(key % 17 == 0, F.lit(" \n"))
        # A part becomes many answers, and a row group of parts would be a single task.
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return self.read("part").repartition(tasks).select(
            F.inline(
                F.array(
                    row(
                        1, fixed.TASK_SNP_LOCATION,
                        F.coalesce(
                            blank,
                            F.concat(F.lit("It is located on "), _text(size % 22 + 1), F.lit("\n")),
                        ),
                        chromosome(0),
                    ),
                    row(
                        2, fixed.TASK_GENE_LOCATION,
                        F.coalesce(blank, F.concat(F.lit("chr"), _text(size % 11 + 1))),
                        chromosome(0),
                    ),
                    row(
                        3, fixed.TASK_GENE_DISEASE,
                        F.concat(F.lit("Answer: "), gene(0), F.lit(", "), gene(1), F.lit(", "), gene(0)),
                        F.concat(gene(0), F.lit(", "), F.lower(gene(1)), F.lit(", "), gene(2)),
                    ),
                    row(
                        4, fixed.TASK_DISEASE_LOCATION,
                        F.concat(chromosome(0), F.lit(", "), chromosome(3)),
                        F.concat(chromosome(0), F.lit(", "), chromosome(5)),
                    ),
                    row(
                        5, fixed.TASK_CODING,
                        F.when(key % 2 == 0, "Answer: Yes").otherwise("No"),
                        F.when(key % 3 == 0, "NA").otherwise("TRUE"),
                    ),
                    row(6, fixed.TASK_SPECIES, F.concat(F.lit("Answer: "), name), common),
                    row(
                        7, fixed.TASK_ALIGNMENT,
                        F.concat(chromosome(0), F.lit(":"), _text(key * 100)),
                        F.concat(
                            F.when(key % 4 == 0, chromosome(1)).otherwise(chromosome(0)),
                            F.lit(":"), _text(key * 100 + key % 2),
                        ),
                    ),
                    row(
                        8, fixed.TASK_GENE_ALIAS,
                        F.concat(F.lit(" Answer: "), F.lower(gene(0)), F.lit("\t")),
                        F.when(key % 5 == 0, gene(1)).otherwise(gene(0)),
                    ),
                )
            )
        )

    @cached_property
    def regions(self) -> DataFrame:
        """Region answers: right, same chromosome, other chromosome."""
        key, customer = F.col("o_orderkey"), F.col("o_custkey")

        def region(chromosome: Column, start: Column) -> Column:
            return F.concat(
                F.lit("chr"), _text(chromosome % 22 + 1), F.lit(":"),
                _text(start), F.lit("-"), _text(start + 127),
            )

        return self.read("orders").select(
            key.alias("id"),
            F.lit(fixed.TASK_ALIGNMENT).alias("task"),
            region(customer, key * 100).alias("answer"),
            region(
                F.when(key % 3 == 2, customer + 1).otherwise(customer),
                F.when(key % 3 == 0, key * 100).otherwise(key * 100 + 1),
            ).alias("raw_prediction"),
        )

    @cached_property
    def questions(self) -> DataFrame:
        """All twelve question kinds (id, task, question, answer, arg_true)."""
        numbered = {kind: n for n, kind in enumerate(QUESTION_TEXTS)}

        def ask(df: DataFrame, kinds: dict[str, str], key: str) -> DataFrame:
            asked = [
                F.struct(
                    (F.col(key) * 100 + numbered[kind]).alias("id"),
                    F.lit(kind).alias("task"),
                    question_text(kind, F.col(argument)).alias("question"),
                    F.lit("").alias("answer"),
                    F.col(argument).alias("arg_true"),
                )
                for kind, argument in kinds.items()
            ]
            return df.select(F.inline(F.array(*asked)))

        part = self.read("part").select(
            "p_partkey",
            F.col("p_name").alias("alias"),
            F.concat("p_brand", F.lit(" "), "p_type").alias("disease"),
            F.concat(F.lit("GENE"), _text("p_partkey")).alias("symbol"),
            F.concat(F.lit("ENSG"), F.lpad(_text("p_partkey"), 11, "0")).alias("ensembl"),
            sequence_of(F.col("p_partkey")).alias("sequence"),
        )
        by_part = ask(
            part,
            {
                "alias": "alias", "disease_genes": "disease", "gene_chr": "symbol",
                "align": "sequence", "organism": "sequence", "ensembl": "ensembl",
                "coding": "symbol", "seq_alias": "sequence", "disease_loc": "disease",
            },
            "p_partkey",
        )
        orders = self.read("orders").select(
            "o_orderkey", F.concat(F.lit("rs"), _text("o_orderkey")).alias("rsid")
        )
        by_order = ask(
            orders, {k: "rsid" for k in ("snp_gene", "snp_chr", "snp_fn")}, "o_orderkey"
        )
        return by_part.unionByName(by_order)

    @cached_property
    def gold_questions(self) -> DataFrame:
        """The questions with gold answers of all twelve kinds, as (id, task, question, answer).

        Gold comes from the given tables by rules of its own, one gene or SNP at a time; so
        lookups, which see all that share a name, are not always right.
        """
        key = _text("p_partkey")
        symbol = F.concat(F.lit("GENE"), key)
        place = F.concat(F.lit("chr"), _text(F.col("p_size") % 22 + 1))
        chromosome = F.when(F.col("p_size") % 7 != 0, place).otherwise("NA")
        start = F.col("p_partkey") * 100
        species = [*fixed.ORGANISMS, "Canis lupus"]
        gold = {
            "alias": symbol,
            "disease_genes": symbol,
            "gene_chr": chromosome,
            "align": F.concat(place, F.lit(":"), _text(start), F.lit("-"), _text(start + 127)),
            "organism": F.element_at(
                F.array(*[F.lit(n) for n in species]), (F.col("p_partkey") % len(species) + 1).cast("int")
            ),
            "ensembl": symbol,
            "coding": F.when(F.col("p_type") == "PROMO", "NA").otherwise("TRUE"),
            "seq_alias": symbol,
            "disease_loc": chromosome,
        }
        part = self.read("part").select(
            F.inline(F.array(*[F.struct((F.col("p_partkey") * 100 + n).alias("id"), gold[kind].alias("answer"))
                               for n, kind in enumerate(QUESTION_TEXTS) if kind in gold]))
        )
        first = self.read("lineitem").groupBy("l_orderkey").agg(F.min("l_partkey").alias("uid"))
        linked = first.join(self.gene.select("uid", "summary"), "uid", "left")
        snp = self.read("orders").join(linked, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        chromosome = F.when(
            F.col("o_orderkey") % 11 != 0, F.concat(F.lit("chr"), _text(F.col("o_custkey") % 22 + 1))
        ).otherwise("NA")
        gold = {
            "snp_gene": F.coalesce(F.concat(F.lit("GENE"), _text("uid")), F.lit("NA")),
            "snp_chr": chromosome,
            "snp_fn": F.coalesce("summary", F.lit("NA")),
        }
        orders = snp.select(
            F.inline(F.array(*[F.struct((F.col("o_orderkey") * 100 + n).alias("id"), gold[kind].alias("answer"))
                               for n, kind in enumerate(QUESTION_TEXTS) if kind in gold]))
        )
        asked = self.questions.select("id", "question", F.col("task").alias("kind"))
        tasks = F.create_map(*[F.lit(x) for pair in KIND_TASKS.items() for x in pair])
        # Twelve rows come of a part and an order: by the size of their files Spark would send
        # the gold answers whole to every task, and read each row group in a single one.
        return asked.join(part.unionByName(orders).hint("merge"), "id").select(
            "id", tasks[F.col("kind")].alias("task"), "question", "answer"
        )

    @cached_property
    def disease_gold(self) -> DataFrame:
        """disease -> its first ten symbols (array)."""
        hits = top_candidates(self.gene_disease, fixed.DISEASE_HITS, ["disease"], "rnk")
        named = hits.select("disease", "rnk", F.concat(F.lit("GENE"), _text("uid")).alias("symbol"))
        return named.groupBy("disease").agg(
            ordered_values(F.col("rnk"), F.col("symbol")).alias("answers")
        )

    @cached_property
    def part_gold(self) -> DataFrame:
        """Disease of a part -> the symbols of all parts that have it (array)."""
        symbol = F.concat(F.lit("GENE"), _text("p_partkey"))
        keyed = self.read("part").select(part_disease().alias("disease"), "p_partkey", symbol.alias("symbol"))
        return keyed.groupBy("disease").agg(
            ordered_values(F.col("p_partkey"), F.col("symbol")).alias("answers")
        )

    # --- model texts ----------------------------------------------------------------------

    @cached_property
    def tool_text(self) -> DataFrame:
        call = F.concat(
            F.lit('[{"name": "'), "event_type", F.lit('", "parameters": '), "props", F.lit("}]")
        )
        kind = F.col("event_id") % 8
        return self.read("events").select(
            F.col("event_id").alias("id"),
            F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("done "), _text("event_id")))
            .when(kind == 1, F.concat(F.lit("```json\n"), call, F.lit("\n```")))
            .when(kind == 2, F.concat(F.lit('{"name": "'), "event_type", F.lit('", "parameters": {}}')))
            .when(kind == 3, F.lit('[{"name": "click"}]'))
            .when(
                kind == 5,
                F.concat(
                    F.lit('[{"name": "'), "event_type",
                    F.lit('", "parameters": {"page": "p"}}, {"name": "view", "parameters": 7}]'),
                ),
            )
            .otherwise(call)
            .alias("answer"),
        )

    @cached_property
    def structured_raw(self) -> DataFrame:
        kind = F.col("event_id") % 6
        head = F.concat(F.lit('{"task":"'), "event_type", F.lit('","question":"q"'))
        return self.read("events").select(
            F.col("event_id").alias("id"),
            F.when(kind == 0, F.lit("not json"))
            .when(kind == 1, F.concat(head, F.lit("}")))
            .when(kind == 2, F.concat(head, F.lit(',"answer":'), _text("user_id"), F.lit("}")))
            .when(
                kind == 3,
                F.concat(head, F.lit(',"answer":"'), _text("user_id"), F.lit('","explanation":null}')),
            )
            .otherwise(F.concat(head, F.lit(',"answer":"'), _text("user_id"), F.lit('"}')))
            .alias("raw"),
        )

    @cached_property
    def run_results(self) -> DataFrame:
        is_error = F.col("event_type") == "error"
        return self.read("events").select(
            F.col("event_id").alias("id"),
            "ts",
            (F.col("user_id") % 5).alias("model"),
            F.col("event_type").alias("task"),
            (~is_error).alias("success"),
            F.when(is_error, 0.0)
            .otherwise(F.least(F.col("value") / 100, F.lit(1.0)))
            .alias("score"),
        )

    @cached_property
    def verdicts(self) -> DataFrame:
        size = F.col("n_chars")
        return (
            self.read("labels")
            .join(self.read("documents").select("doc_id", "n_chars"), "doc_id")
            .select(
                "doc_id",
                "quality",
                F.when(size % 9 == 0, "no score")
                .when(size % 9 == 1, "Score: 7\nExplanation: y")
                .otherwise(
                    F.concat(F.lit("Score: "), _text(size % 5 + 1), F.lit("\nExplanation: x"))
                )
                .alias("verdict"),
            )
        )

    # --- vectors -------------------------------------------------------------------------------

    @cached_property
    def vectors(self) -> DataFrame:
        return self.read("embeddings").select(
            F.col("vec_id").alias("id"),
            F.col("embedding").cast("array<double>").alias("vector"),
            "label",
        )

    @cached_property
    def tokens(self) -> DataFrame:
        """Each vector cut into 8 tokens of 8; the first (id mod 8) + 1 count."""
        tokens = F.array(*[F.slice("vector", 8 * i + 1, 8) for i in range(8)])
        used = F.col("id") % 8
        mask = F.array(*[F.when(used >= i, 1).otherwise(0) for i in range(8)])
        return self.vectors.select("id", tokens.alias("tokens"), mask.alias("mask"))

    @cached_property
    def next_vectors(self) -> DataFrame:
        """Each vector under the id of the one before it, as its gold partner."""
        return self.vectors.select((F.col("id") - 1).alias("id"), "vector")


def part_disease() -> Column:
    """Disease of a part: brand, type and the thousand of its number.

    The parts of one disease stay few however many parts there are.
    """
    thousand = F.floor(F.col("p_partkey") / 1000).cast("string")
    return F.concat("p_brand", F.lit(" "), "p_type", F.lit(" "), thousand)
