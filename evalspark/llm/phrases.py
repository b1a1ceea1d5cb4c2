"""Collocations: phrases of two to five words that occur more often than their parts suggest.

Texts become chunks of word numbers, kept as files in the shared scratch folder. For each
length, every chunk counts its n-grams in a quotient filter, filters are cut at ranges of
quotients, and each range is merged over all chunks. Chunks get back one bit for each of
their n-grams, whether it is frequent: only those can begin a frequent phrase of one word
more. Words are counted and numbered in the same way first. So no n-gram is ever a row, and
chunks do not move: only filters and bits do. Ids belong to (language, word), so languages
never meet in a filter, and no language is a key of any shuffle of words or n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evalspark.llm.common import filesystem, in_chunks, stored, texts
from evalspark.llm.quotient_filter import QuotientFilter, counted, lane_bits, restored, unpacked, unused_bits
from evalspark.session import qualified, scratch_path

LEAST = 100
LONGEST = 5
TOP = 2000
#: Words of a chunk, about; n-grams of a range of quotients, at most about.
CHUNK_WORDS = 1 << 21
RANGE_GRAMS = 1 << 20
#: Bytes of text for each part that words are counted in.
PART_BYTES = 32 << 20
#: Parts of a language whose best phrases are found before those of the language.
SALTS = 64
#: Ends of pieces become a byte that no text has; it is the word with id 0. The same byte
#: stands between a language and a word.
END = b"\xff"
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + END * 10)
SLICE = "chunk long, part long, data binary"
WORDS = "chunk long, part long, n long, places binary, lang string, word binary, rank long"
MERGED = "chunk long, part long, n long, bits binary, ids array<bigint>"


class _Words(dict):
    """Numbers from 1 for the words of one language, in the order they are met."""

    def __init__(self, lang: str, known: list[bytes]):
        super().__init__()
        self.before, self.known = lang.encode() + END, known
        self[END] = 0

    def __missing__(self, word: bytes) -> int:
        self.known.append(self.before + word)
        number = self[word] = len(self.known)
        return number


def split(text: bytes) -> list[bytes]:
    """Words in lower case, and ends of pieces."""
    return text.translate(_TABLE).replace(END, b" " + END + b" ").split()


def packed_bytes(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(data)


def plain_bytes(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data)


class ChunkFiles:
    """What a chunk keeps between the passes: arrays by name, written whole or not at all."""

    def __init__(self, folder: str, chunk: int):
        self.stem = f"{folder}/{chunk:x}"

    def write(self, name: str, values: np.ndarray) -> None:
        files, place = filesystem(f"{self.stem}.{name}")
        files.create_dir(place.rpartition("/")[0], recursive=True)
        own = f"{place}.{TaskContext.get().taskAttemptId()}"
        with files.open_output_stream(own) as out:
            out.write(packed_bytes(np.ascontiguousarray(values).tobytes()))
        files.move(own, place)

    def read(self, name: str, dtype: str) -> np.ndarray:
        files, place = filesystem(f"{self.stem}.{name}")
        with files.open_input_stream(place) as source:
            return np.frombuffer(plain_bytes(source.read()), dtype)


def word_slices(docs: DataFrame, folder: str, parts: int, chunk_words: int) -> DataFrame:
    """Words of chunks with their counts, cut in ``parts`` by hash; the chunks go to files.

    A chunk numbers its words part after part, so a slice is a range of numbers.
    """
    import xxhash

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, size, pieces = 0, 0, []
        known: list[bytes] = []
        words: dict[str, _Words] = {}

        def chunk() -> Iterator[pa.RecordBatch]:
            ids = np.concatenate(pieces)
            # Of ends in a row one is enough.
            ids = ids[(ids > 0) | np.r_[True, ids[:-1] > 0]]
            part = np.fromiter((xxhash.xxh64_intdigest(w) % parts for w in known), np.int64, len(known))
            table = pa.table([pa.array(part), pa.array(known, pa.binary())], names=["part", "word"])
            order = pc.sort_indices(table, [("part", "ascending"), ("word", "ascending")]).to_numpy().astype(np.int64)
            number = np.empty(len(known) + 1, np.uint32)
            number[0], number[order + 1] = 0, np.arange(1, len(known) + 1)
            counts = np.bincount(ids, minlength=len(known) + 1)[1:][order]
            name = TaskContext.get().partitionId() << 32 | turn
            ChunkFiles(folder, name).write("words", number[ids])
            sorted_words = table.column("word").combine_chunks().take(pa.array(order))
            bounds = np.searchsorted(part[order], np.arange(parts + 1))
            for p in np.unique(part).tolist():
                low, high = int(bounds[p]), int(bounds[p + 1])
                own = pa.record_batch(
                    [sorted_words.slice(low, high - low), pa.array(counts[low:high], pa.int64())], names=["word", "n"]
                )
                yield _slice(name, p, _as_bytes(own))

        for batch in in_chunks(batches, "text", 2 << 20):
            by: dict[str, list[bytes]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), texts(batch, "text")):
                by.setdefault(lang, []).append(text)
            for lang, own in by.items():
                own_words = words.get(lang)
                if own_words is None:
                    own_words = words[lang] = _Words(lang, known)
                tokens = split(END.join(own) + END)
                pieces.append(np.fromiter(map(own_words.__getitem__, tokens), np.uint32, len(tokens)))
                size += len(tokens)
            if size >= chunk_words:
                if known:
                    yield from chunk()
                turn, size, pieces, known, words = turn + 1, 0, [], [], {}
        if known:
            yield from chunk()

    return docs.mapInArrow(task, SLICE)


def _slice(chunk: int, part: int, data: bytes) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array([chunk], pa.int64()), pa.array([part], pa.int64()), pa.array([packed_bytes(data)], pa.binary())],
        names=["chunk", "part", "data"],
    )


def _as_bytes(batch: pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema) as stream:
        stream.write_batch(batch)
    return out.getvalue().to_pybytes()


def merge_words(slices: DataFrame, least: int) -> DataFrame:
    """Per part: places of each slice's words among the frequent ones (from 1, 0 for others),
    the frequent words with their rank, and the sum of all words of each language."""

    def task(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        found = [pa.ipc.open_stream(plain_bytes(data.as_py())).read_all() for data in table.column("data")]
        both = pa.concat_tables(found)
        coded = pc.dictionary_encode(both.column("word").combine_chunks())
        index = coded.indices.to_numpy()
        sums = np.zeros(len(coded.dictionary), np.int64)
        np.add.at(sums, index, both.column("n").to_numpy())
        frequent = sums >= least
        place = np.where(frequent, np.cumsum(frequent), 0).astype("<u4")
        of_slices = np.split(place[index], np.cumsum([len(t) for t in found])[:-1])
        totals: dict[bytes, int] = {}
        often = []
        for word, n, rank in zip(coded.dictionary.to_pylist(), sums.tolist(), place.tolist()):
            lang, _, word = word.partition(END)
            totals[lang] = totals.get(lang, 0) + n
            if rank:
                often.append((lang.decode(), word, n, rank))
        langs = [(lang.decode(), None, n, None) for lang, n in totals.items()]
        rest = often + langs
        part = table.column("part")[0].as_py()
        none = [None] * len(rest)
        own = [None] * len(found)
        return pa.table(
            [
                pa.array(table.column("chunk").to_pylist() + none, pa.int64()),
                pa.array([part] * (len(found) + len(rest)), pa.int64()),
                pa.array(own + [n for *_, n, _ in rest], pa.int64()),
                pa.array([packed_bytes(p.tobytes()) for p in of_slices] + none, pa.binary()),
                pa.array(own + [lang for lang, *_ in rest], pa.string()),
                pa.array(own + [word for _, word, *_ in rest], pa.binary()),
                pa.array(own + [rank for *_, rank in rest], pa.int64()),
            ],
            names=[c.split()[0] for c in WORDS.split(", ")],
        )

    return slices.groupBy("part").applyInArrow(task, WORDS)


def _gram_slices(ids: np.ndarray, alive: np.ndarray, length: int, bits: int, skip: int, chunk: int):
    """The filter of one chunk in slices; ``alive`` tells where a phrase of one word less begins."""
    at = _valid(alive)
    if len(at):
        filter_, _ = counted([ids[at + i] for i in range(length)], bits)
        for part in filter_.parts(skip + unused_bits(length, bits)):
            yield _slice(chunk, part.part, part.to_bytes())


def _valid(alive: np.ndarray) -> np.ndarray:
    """Where an n-gram begins both of whose parts of one word less are frequent."""
    return np.flatnonzero(alive[:-1] & alive[1:])


def first_grams(back: DataFrame, folder: str, bits: int, skip: int) -> DataFrame:
    """Slices of the pairs of words; the ids of each chunk's words go to its files."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, parts in zip(batch.column("chunk").to_pylist(), batch.column("back")):
                files = ChunkFiles(folder, chunk)
                ids = [np.zeros(1, np.uint64)]
                for part in sorted(parts.as_py(), key=lambda b: b["part"]):
                    places = np.frombuffer(plain_bytes(part["places"]), "<u4").astype(np.uint64)
                    ids.append(np.where(places > 0, places + np.uint64(part["base"]), 0).astype(np.uint64))
                of_word = np.concatenate(ids)
                files.write("ids", of_word)
                own = of_word[files.read("words", "<u4")]
                yield from _gram_slices(own, own > 0, 2, bits, skip, chunk)
                del own

    return back.mapInArrow(task, SLICE)


def next_grams(back: DataFrame, folder: str, length: int, bits: int, skip: int) -> DataFrame:
    """Slices of n-grams of one word more than those that ``back`` has bits for.

    The chunk counts the shorter n-grams again, which gives the order of the bits, and
    writes where frequent ones begin.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, parts in zip(batch.column("chunk").to_pylist(), batch.column("back")):
                files = ChunkFiles(folder, chunk)
                ids = files.read("ids", "<u8")[files.read("words", "<u4")]
                shorter = length - 1
                alive = ids > 0
                if shorter > 2:
                    alive = np.unpackbits(files.read(f"alive{shorter - 1}", "u1"), count=len(ids)).astype(bool)
                at = _valid(alive)
                _, places = counted([ids[at + i] for i in range(shorter)], bits)
                frequent = np.concatenate(
                    [
                        np.unpackbits(np.frombuffer(plain_bytes(part["bits"]), np.uint8), count=part["n"])
                        for part in sorted(parts.as_py(), key=lambda b: b["part"])
                    ]
                ).astype(bool)
                alive = np.zeros(len(ids), bool)
                alive[at] = frequent[places]
                files.write(f"alive{shorter}", np.packbits(alive))
                yield from _gram_slices(ids, alive, length, bits, skip, chunk)

    return back.mapInArrow(task, SLICE)


def merge_grams(slices: DataFrame, length: int, bits: int, least: int) -> DataFrame:
    """Frequent n-grams of each range of quotients, and a bit for each row of each slice."""

    def task(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        filters = [QuotientFilter.from_bytes(plain_bytes(f.as_py())) for f in table.column("data")]
        merged, places = QuotientFilter.merged(filters)
        frequent = merged.counts >= least
        lanes = restored(unpacked(merged.rows[frequent], bits, length), bits)
        grams = np.stack(lanes, axis=1).astype(np.int64).tolist()
        n, none = len(filters), [None] * len(grams)
        part = table.column("part")[0].as_py()
        return pa.table(
            [
                pa.array(table.column("chunk").to_pylist() + none, pa.int64()),
                pa.array([part] * (n + len(grams)), pa.int64()),
                pa.array([len(p) for p in places] + merged.counts[frequent].astype(np.int64).tolist(), pa.int64()),
                pa.array([packed_bytes(np.packbits(frequent[p]).tobytes()) for p in places] + none, pa.binary()),
                pa.array([None] * n + grams, pa.list_(pa.int64())),
            ],
            names=[c.split()[0] for c in MERGED.split(", ")],
        )

    return slices.groupBy("part").applyInArrow(task, MERGED)


def _skip(grams: int, range_grams: int, bits: int) -> int:
    """Bits of the ranges' names, so that a range holds few enough n-grams; half of all at most."""
    return min(bits // 2, (max(1, -(-grams // range_grams)) - 1).bit_length())


def counted_words(
    docs: DataFrame, folder: str, least: int, chunk_words: int, part_bytes: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Frequent words with ids from 1 (``id, lang, word, n``), words of each language, and
    for each chunk the ids of its words."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 + size // part_bytes
    merged = stored(merge_words(word_slices(docs, folder, parts, chunk_words), least), "phrase-words")
    totals = merged.where("chunk is null and word is null").groupBy("lang").agg(F.sum("n").alias("n"))
    often = merged.where("word is not null")
    # One row per part; its first id follows those of the parts before it.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = merged.groupBy("part").agg(F.count("word").alias("size"))
    bases = stored(
        bases.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base")), "phrase-bases"
    )
    words = often.join(bases, "part").select((F.col("base") + F.col("rank")).alias("id"), "lang", "word", "n")
    back = merged.where("chunk is not null").join(bases, "part").groupBy("chunk").agg(
        F.collect_list(F.struct("part", "base", "places")).alias("back")
    )
    return stored(words, "phrase-dictionary"), stored(totals, "phrase-totals"), back


def frequent_phrases(
    words: DataFrame, back: DataFrame, folder: str, least: int, longest: int, range_grams: int
) -> DataFrame:
    """``ids, f`` of the phrases of two words and more, from the files of the chunks."""
    spark = words.sparkSession
    top, total = words.agg(F.max("id"), F.sum("n")).first()
    found = spark.createDataFrame([], "ids array<bigint>, f long")
    if not top:
        return found
    bits = lane_bits(top)
    slices = first_grams(back, folder, bits, _skip(total, range_grams, 2 * bits))
    for length in range(2, longest + 1):
        merged = stored(merge_grams(slices, length, bits, least), "phrase-merged")
        grams = merged.where("chunk is null").select("ids", F.col("n").alias("f"))
        # As many n-grams of one word more begin where these do, at most.
        total = grams.agg(F.sum("f")).first()[0]
        if not total:
            return found
        found = found.unionByName(grams)
        if length < longest:
            back = merged.where("chunk is not null").groupBy("chunk").agg(
                F.collect_list(F.struct("part", "n", "bits")).alias("back")
            )
            skip = _skip(total, range_grams, (length + 1) * bits)
            slices = next_grams(back, folder, length + 1, bits, skip)
    return found


def score(a: str, n: str, l: str, r: str) -> Column:
    """``floor(1000 * a * n / (l * r))`` with exact products, for corpora of up to 10^16 words."""
    wide = "cast({} as decimal(14,0))".format
    return F.expr(
        f"cast(1000 as decimal(4,0)) * {wide(a)} * cast({n} as decimal(16,0)) div ({wide(l)} * {wide(r)})"
    )


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    longest: int = LONGEST,
    top: int = TOP,
    chunk_words: int = CHUNK_WORDS,
    range_grams: int = RANGE_GRAMS,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's best phrases.

    ``docs`` needs ``text`` and ``lang``; other columns are not read. A null language is
    ``und``; null and empty texts have no words; repeated rows count each. Without a phrase
    that occurs ``least`` times there is no result. A phrase's score is that of its worst
    cut in two parts (the first of equal ones). A phrase inside a longer one that occurs as
    often is left out: by the counts' order it is enough to look at one word more.

    Joins from here on are on phrases that occur ``least`` times, one row each.
    """
    source = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    spark = docs.sparkSession
    folder = qualified(spark, scratch_path(spark, "phrase-chunks"))
    words, totals, back = counted_words(source, folder, least, chunk_words, part_bytes)
    found = frequent_phrases(words, back, folder, least, longest, range_grams)
    found = stored(found, "phrase-found")
    single = words.select(F.array("id").alias("ids"), F.col("n").alias("f"))
    counts = single.unionByName(found)

    longer = found.where(F.size("ids") > 2).select(
        F.explode(F.array(F.expr("slice(ids, 1, size(ids) - 1)"), F.expr("slice(ids, 2, size(ids) - 1)"))).alias("ids"),
        F.col("f").alias("longer"),
    )
    longer = longer.groupBy("ids").agg(F.max("longer").alias("longer"))
    left_over = found.join(longer, "ids", "left").where(F.coalesce(F.col("longer") < F.col("f"), F.lit(True)))
    home = words.select(F.col("id").alias("first"), "lang").join(totals, "lang")
    own = left_over.select("ids", F.col("f").alias("a"), F.col("ids")[0].alias("first")).join(home, "first")
    cuts = own.select(
        "ids", "a", "lang", "n", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("cut")
    ).withColumns(
        {"of_l": F.expr("slice(ids, 1, cut)"), "of_r": F.expr("slice(ids, cut + 1, size(ids) - cut)")}
    )
    for side in "lr":
        part = counts.select(F.col("ids").alias(f"of_{side}"), F.col("f").alias(side))
        cuts = cuts.join(part, f"of_{side}")
    scored = cuts.withColumn("score", score("a", "n", "l", "r"))
    worst = scored.groupBy("ids", "a", "lang", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("worst"))
    worst = stored(worst.select("ids", "lang", "a", "worst.l", "worst.r", "n", "worst.score"), "phrase-scored")

    # Phrases that may be among the best: by score and count, with all ties.
    by_count = [F.col("score").desc(), F.col("a").desc()]
    salted = worst.withColumn("salt", F.pmod(F.xxhash64("ids"), F.lit(SALTS)))
    near = salted.withColumn("place", F.rank().over(Window.partitionBy("lang", "salt").orderBy(*by_count)))
    near = near.where(F.col("place") <= top).drop("place")
    spelled = near.select("ids", F.posexplode("ids").alias("place", "id")).join(words.select("id", "word"), "id")
    spelled = spelled.groupBy("ids").agg(
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("place", "word"))), lambda w: w["word"].cast("string")), " "
        ).alias("phrase")
    )
    near = near.join(spelled, "ids")
    order = [*by_count, F.col("phrase")]
    first = F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))
    near = near.withColumn("place", first).where(F.col("place") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    best = near.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top)
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
