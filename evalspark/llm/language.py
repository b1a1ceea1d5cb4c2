"""Language of texts: sparse multinomial logistic regression on character n-grams.

Features are hashed n-grams of one to three characters, weighted by TF-IDF. Document
frequencies come from all training documents, in one pass over them. The weights are
learned by follow-the-regularised-leader with elastic-net penalties on a bounded sample
of labelled documents (``sample_rows``, in equal parts by language), and a temperature
fitted on a part of the sample held back calibrates the scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalspark.llm.common import in_chunks, stored, texts, unwrapped, wrapped

#: Features: n-grams of 1 to 3 characters, hashed to so many bits.
BITS = 15
ORDERS = 3
UNKNOWN = "und"
#: One sampled document in so many sets the temperature instead of the weights.
HELD_BACK = 5
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def grams(text: str) -> np.ndarray:
    """Hashed n-grams of a whole text: lower case, one space for white space."""
    codes = np.frombuffer((" " + " ".join(text.lower().split()) + " ").encode("utf-32-le"), "<u4")
    mixed = (codes + np.uint32(1)) * _FACTORS[0]
    out, state = [], np.zeros(len(codes), np.uint32)
    for order in range(ORDERS):
        if len(codes) <= order:
            break
        state = (state[: len(codes) - order] ^ mixed[order:]) * _FACTORS[1]
        state = state ^ (state >> np.uint32(15))
        out.append(((state + np.uint32(order)) * _FACTORS[2]) >> np.uint32(32 - BITS))
    return np.concatenate(out)


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features that occur and how often."""
    counts = np.bincount(grams(text), minlength=1 << BITS)
    found = np.flatnonzero(counts)
    return found, counts[found]


def weighed(found: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf[found]
    return x / max(float(np.sqrt(x @ x)), 1e-12)


def shares(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max())
    return e / e.sum()


class Leader:
    """Follow-the-regularised-leader for a softmax over few classes, one example a step.

    ``z`` holds the gradient sums with the proximal shift, ``n`` the squared gradients;
    weights follow from both, and are zero where ``z`` stays inside the L1 penalty.
    """

    def __init__(self, classes: int, l1: float, l2: float, rate: float, calm: float):
        self.z = np.zeros((1 << BITS, classes))
        self.n = np.zeros((1 << BITS, classes))
        self.l1, self.l2, self.rate, self.calm = l1, l2, rate, calm

    def weights(self, found) -> np.ndarray:
        z, n = self.z[found], self.n[found]
        held = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -held / ((self.calm + np.sqrt(n)) / self.rate + self.l2)

    def learn(self, found: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(found)
        error = shares(x @ w)
        error[label] -= 1
        g = x[:, None] * error
        n = self.n[found]
        self.z[found] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.rate * w
        self.n[found] = n + g * g


def temperature(logits: list[np.ndarray], labels: list[int]) -> float:
    """The divisor of the logits that makes the held-back labels likeliest.

    Labels are smoothed by one part in their number plus two, so that a sample without
    errors does not claim certainty.
    """
    if not logits:
        return 1.0
    soft = 1 / (len(labels) + 2)

    def loss(log_t: float) -> float:
        total = 0.0
        for v, y in zip(logits, labels):
            p = np.log(shares(v / np.exp(log_t)) + 1e-300)
            total -= (1 - soft) * p[y] + soft * p.mean()
        return total

    low, high = -4.0, 3.0
    ratio = (5**0.5 - 1) / 2
    a, b = high - ratio * (high - low), low + ratio * (high - low)
    at_a, at_b = loss(a), loss(b)
    for _ in range(30):
        if at_a <= at_b:
            high, b, at_b = b, a, at_a
            a = high - ratio * (high - low)
            at_a = loss(a)
        else:
            low, a, at_a = a, b, at_b
            b = low + ratio * (high - low)
            at_b = loss(b)
    return float(np.exp((low + high) / 2))


class Model:
    """Classes, weights, document weights and temperature; the same for every document."""

    def __init__(self, classes: list[str], weights: np.ndarray, idf: np.ndarray, warmth: float):
        self.classes, self.weights, self.idf, self.warmth = classes, weights, idf, warmth

    def predict(self, text: str) -> tuple[str, float]:
        if not self.classes or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        found, counts = counted(text)
        p = shares(weighed(found, counts, self.idf) @ self.weights[found] / self.warmth)
        best = int(p.argmax())
        return self.classes[best], float(p[best])


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """For each feature the documents that have it, and all documents; counted in tasks."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, docs = np.zeros(1 << BITS, np.int64), 0
        for batch in in_chunks(batches, "text"):
            for text in texts(batch, "text"):
                seen[counted(text.decode())[0]] += 1
                docs += 1
        keys = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(keys, -1)), pa.array(np.append(seen[keys], docs))], names=["feature", "n"]
        )

    sums = docs.select("text").mapInArrow(task, "feature long, n long").groupBy("feature").sum("n")
    frequencies, total = np.zeros(1 << BITS), 0
    for feature, n in sums.collect():  # no more rows than features
        if feature < 0:
            total = n
        else:
            frequencies[feature] = n
    return frequencies, total


def train(
    docs: DataFrame,
    sample_rows: int = 6000,
    passes: int = 2,
    l1: float = 0.02,
    l2: float = 0.5,
    rate: float = 2.0,
    calm: float = 1.0,
) -> Model:
    """Learn from the text and ``lang`` of documents outside the held-out third.

    ``sample_rows`` bounds (in expectation) the documents that weights are fitted on; by
    language, rows are chosen by a hash of their id and text. Fitting reads them in one
    task, in the order of that hash, so that reruns agree.
    """
    learned = docs.where(~held_out(F.col("doc_id")) & F.col("text").isNotNull() & F.col("lang").isNotNull())
    learned = learned.select("doc_id", "text", "lang")
    frequencies, total = document_frequencies(learned)
    idf = np.log((1 + total) / (1 + frequencies)) + 1
    # Stored, so that Spark knows that it is small and does not shuffle texts to join it.
    per_lang = stored(learned.groupBy("lang").agg(F.count("*").alias("n")), "language-counts")
    n_langs = max(1, per_lang.count())
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(11), "doc_id", "text"), 11) / F.lit(float(1 << 53))
    sample = learned.join(per_lang, "lang").withColumn("draw", draw)
    sample = sample.where(F.col("draw") * F.col("n") < sample_rows / n_langs)
    sample = sample.select("lang", "text", "draw").repartition(1).sortWithinPartitions("draw", "lang")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in in_chunks(batches, "text"):
            for text, lang in zip(texts(batch, "text"), batch.column("lang").to_pylist()):
                text = text.decode()
                if any(map(str.isalpha, text)):
                    rows.append((lang, *counted(text)))
        # Sampled rows follow each other by n * draw, not by language.
        classes = sorted({lang for lang, *_ in rows})
        leader = Leader(len(classes), l1, l2, rate, calm)
        order = np.random.default_rng(5).permutation(len(rows))
        kept = [rows[i] for i in order if i % HELD_BACK]
        back = [rows[i] for i in order if i % HELD_BACK == 0] if len(rows) >= 10 * HELD_BACK else []
        for _ in range(passes):
            for lang, found, counts in kept if back else [rows[i] for i in order]:
                leader.learn(found, weighed(found, counts, idf), classes.index(lang))
        weights = leader.weights(slice(None))
        logits = [weighed(f, c, idf) @ weights[f] for _, f, c in back]
        warmth = temperature(logits, [classes.index(lang) for lang, *_ in back])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([classes], pa.list_(pa.string())),
                pa.array([weights.astype("<f4").tobytes()], pa.binary()),
                pa.array([warmth], pa.float64()),
            ],
            names=["classes", "weights", "warmth"],
        )

    got = sample.mapInArrow(fit, "classes array<string>, weights binary, warmth double").first()
    classes = list(got["classes"]) if got else []
    weights = np.frombuffer(got["weights"] if got else b"", "<f4").reshape(1 << BITS, -1) if classes else None
    return Model(classes, weights, idf.astype(np.float32), got["warmth"] if got else 1.0)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, from the text alone.

    A null text or one without a letter is ``und`` with score 0, and so is every text if
    nothing could be learned. Input columns with these names are replaced. The model's
    size is fixed by the number of features and languages, so it goes to all tasks.
    """
    docs = docs.drop("lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_chunks(batches, "text"):
            found = [shared.value.predict(t.decode()) for t in texts(batch, "text")]
            names = [*batch.schema.names, "lang_pred", "score"]
            columns = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=names)

    fields = [*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return docs.mapInArrow(task, T.StructType(fields))


def identify(docs: DataFrame, **options) -> DataFrame:
    """Predictions for all of ``docs`` by a model learned from them.

    ``docs`` needs ``doc_id, text, lang``; the result has ``doc_id, held_out, lang_pred,
    score``. Null languages are not learned from, null ids count as empty text in the
    held-out rule, repeated rows are predicted each; without rows there is no result.
    """
    model = train(docs, **options)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return predict(rows, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def known_language(docs: DataFrame, least_score: float = 0.5) -> DataFrame:
    """``docs`` without documents whose language is unknown or too uncertain."""
    found = predict(wrapped(docs, "text"), train(docs))
    known = found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score))
    return known.select(*unwrapped(docs, "text"))
