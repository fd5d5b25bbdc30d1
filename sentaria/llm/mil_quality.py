"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded, a gated attention layer learns
from document labels alone how much each passage counts, and the score is read from the
weighted mean of the encodings.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentaria.llm.common import quoted, table

#: Words of a passage.
PASSAGE_WORDS = 96
#: Labelled documents that a fit reads at most, each of them whole.
FIT_DOCUMENTS = 6000
HASHED = 24
WIDTH = 24
GATE = 12
EPOCHS = 60
SEED = 7

_NOT_WORD = re.compile(r"[^\W\d_]+")
_MARK = re.compile(r"[^\w\s]")
_DIGIT = re.compile(r"\d")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
#: Values of ``shape`` plus hashed words.
FEATURES = 14 + HASHED


def passages(text: str | None) -> Iterator[list[str]]:
    """The words of each passage; a text without a word is one empty passage.

    Passages are equal in length to a word, so that no short rest stands alone.
    """
    words = (text or "").split()
    n = max(1, round(len(words) / PASSAGE_WORDS))
    for i in range(n):
        yield words[len(words) * i // n : len(words) * (i + 1) // n]


def encode(words: list[str]) -> list[float]:
    """Features of a passage: the shape of its characters, its repetition, its hashed words."""
    n = len(words)
    if not n:
        return [1.0] + [0.0] * (FEATURES - 1)
    line = " ".join(words)
    chars = len(line)
    folded = [w.lower() for w in words]
    counts = Counter(folded)
    letters = sum(map(len, _NOT_WORD.findall(line)))
    marks = Counter(_MARK.findall(line))
    n_marks = sum(marks.values())
    plain = marks["."] + marks[","]
    top = counts.most_common(1)[0][1]
    hashed = [0.0] * HASHED
    for word, count in counts.items():
        h = zlib.crc32(word.strip(".,").encode("utf-8", "replace"))
        hashed[h % HASHED] += (1 if h & 0x10000 else -1) * count
    scale = n**-0.5
    return [
        0.0,
        letters / chars,
        len(_UPPER.findall(line)) / chars,
        len(_DIGIT.findall(line)) / chars,
        n_marks / n,
        (n_marks - plain) / n,
        marks["."] / n,
        marks["|"] / n,
        len(counts) / n,
        top / n,
        sum(map(str.__eq__, folded, folded[1:])) / n,
        min(chars / n, 40.0) / 10,
        sum(1 for w in counts if len(w) > 12) / n,
        min(n / PASSAGE_WORDS, 1.5),
        *(h * scale for h in hashed),
    ]


@dataclass(frozen=True)
class Model:
    """Encoder, gated attention and read-out; small enough to travel with every task."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def score(self, bag: np.ndarray) -> float:
        """Score of one document from the features of all its passages."""
        return float(_forward(self.weights, (bag - self.mean) / self.scale, np.zeros(len(bag), int), 1)[0][0])

    def attention(self, bag: np.ndarray) -> np.ndarray:
        """Weight of each passage; they sum to one."""
        x = (bag - self.mean) / self.scale
        return _forward(self.weights, x, np.zeros(len(bag), int), 1)[1]["a"]


def _forward(w, x, owner, n_bags):
    h = np.tanh(x @ w["enc"] + w["enc_b"])
    t = np.tanh(h @ w["tanh"])
    g = 1 / (1 + np.exp(-(h @ w["gate"])))
    s = (t * g) @ w["att"]
    top = np.full(n_bags, -np.inf)
    np.maximum.at(top, owner, s)
    e = np.exp(s - top[owner])
    a = e / np.bincount(owner, e, n_bags)[owner]
    z = np.stack([np.bincount(owner, a * h[:, j], n_bags) for j in range(h.shape[1])], 1)
    logit = np.clip(z @ w["out"] + w["out_b"][0], -30, 30)
    return 1 / (1 + np.exp(-logit)), {"h": h, "t": t, "g": g, "a": a, "z": z}


def _gradients(w, x, owner, y, weight):
    p, c = _forward(w, x, owner, len(y))
    d_logit = (p - y) * weight / weight.sum()
    d_z = d_logit[:, None] * w["out"][None, :]
    h, t, g, a, z = c["h"], c["t"], c["g"], c["a"], c["z"]
    d_a = (d_z[owner] * h).sum(1)
    mean = np.bincount(owner, a * d_a, len(y))
    d_s = a * (d_a - mean[owner])
    d_tg = d_s[:, None] * w["att"][None, :]
    d_t, d_g = d_tg * g * (1 - t * t), d_tg * t * g * (1 - g)
    d_h = a[:, None] * d_z[owner] + d_t @ w["tanh"].T + d_g @ w["gate"].T
    d_x = d_h * (1 - h * h)
    return {
        "enc": x.T @ d_x, "enc_b": d_x.sum(0), "tanh": h.T @ d_t, "gate": h.T @ d_g,
        "att": (t * g).T @ d_s, "out": z.T @ d_logit, "out_b": np.array([d_logit.sum()]),
    }


def fit(bags: list[np.ndarray], labels: list[int], epochs: int = EPOCHS, seed: int = SEED) -> Model:
    """Train on bags of features and 0/1 labels; classes weigh equally. Deterministic.

    Without bags of both classes there is nothing to learn: the scores are then the only
    label seen, or 0.5 without any.
    """
    rng = np.random.default_rng(seed)
    flat = np.concatenate(bags) if bags else np.zeros((1, FEATURES))
    mean, scale = flat.mean(0), flat.std(0) + 1e-3
    draw = lambda *shape: rng.normal(0, shape[0] ** -0.5, shape)
    w = {
        "enc": draw(FEATURES, WIDTH), "enc_b": np.zeros(WIDTH), "tanh": draw(WIDTH, GATE),
        "gate": draw(WIDTH, GATE), "att": draw(GATE), "out": draw(WIDTH), "out_b": np.zeros(1),
    }
    y = np.array(labels, float)
    if len(set(labels)) < 2:
        w["out"] = np.zeros(WIDTH)
        w["out_b"] = np.array([0.0 if not labels else 30.0 * (2 * labels[0] - 1)])
        return Model(mean, scale, w)
    share = y.mean()
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
    scaled = [(b - mean) / scale for b in bags]
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items()}
    step, rate, batch = 0, 0.01, 256
    for _ in range(epochs):
        order = rng.permutation(len(scaled))
        for at in range(0, len(order), batch):
            some = order[at : at + batch]
            x = np.concatenate([scaled[i] for i in some])
            owner = np.repeat(np.arange(len(some)), [len(scaled[i]) for i in some])
            step += 1
            for k, d in _gradients(w, x, owner, y[some], weight[some]).items():
                d = d + 1e-4 * w[k]
                m, v = moment[k]
                m[:], v[:] = 0.9 * m + 0.1 * d, 0.99 * v + 0.01 * d * d
                w[k] = w[k] - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Model(mean, scale, w)


def fold(doc_id: Column | str) -> Column:
    """Three folds by the checksum of the id's decimal text; fold 1 is held out."""
    return F.crc32(F.col(doc_id).cast("string")) % 3 if isinstance(doc_id, str) else F.crc32(doc_id.cast("string")) % 3


def _bag(text: str | None) -> np.ndarray:
    return np.array([encode(words) for words in passages(text)], float)


def sample_bags(docs: DataFrame, labels: DataFrame, most: int = FIT_DOCUMENTS) -> tuple[list, list]:
    """Features and labels of at most ``most`` labelled documents outside fold 1.

    The sample is those with the least hash of the id, so it does not depend on order or
    partitions. Labels that are null or contradict each other are left out; a document
    with repeated rows gives one bag for each.
    """
    known = (
        labels.filter(F.col("quality").isin(0, 1) & (fold("doc_id") != 1))
        .groupBy("doc_id").agg(F.min("quality").alias("_label"), F.max("quality").alias("_other"))
        .filter("_label = _other")
    )
    chosen = known.select("doc_id", "_label").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    # bounded by ``most`` rows of two numbers
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "_label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = [_bag(t.as_py()).astype("<f4").tobytes() for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(bags, pa.binary())], names=["doc_id", "label", "bag"]
            )

    got = rows.mapInArrow(run, "doc_id bigint, label int, bag binary").orderBy(F.xxhash64("doc_id"), "doc_id", "bag")
    collected = got.limit(2 * most).collect()
    bags = [np.frombuffer(r["bag"], "<f4").reshape(-1, FEATURES).astype(float) for r in collected]
    return bags, [r["label"] for r in collected]


def train(docs: DataFrame, labels: DataFrame, most: int = FIT_DOCUMENTS) -> Model:
    return fit(*sample_bags(docs, labels, most))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score``: every passage of every text, null texts as empty ones.

    Only the text enters the score. Null and repeated ids are scored like any other row. A
    column that is named ``score`` already makes room for the new one; all others stay.
    """
    docs = docs.select(*[quoted(c) for c in docs.columns if c.lower() != "score"])
    at = docs.columns.index("text")
    plain = _by_place(docs)
    schema = plain.withColumn("score", F.lit(0.0)).schema
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.value
        for batch in batches:
            scores = [own.score(_bag(t.as_py())) for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, "score"]
            )

    return plain.mapInArrow(run, schema).toDF(*docs.columns, "score")


def _by_place(docs: DataFrame) -> DataFrame:
    """``docs`` with columns named by their places: Spark hands columns of any name to Python only so."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more, with their columns, whatever their names.

    Empty and null texts are judged like any other; without labels every score is a half.
    """
    model = train(docs, labels)
    at = docs.columns.index("text")
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.value
        for batch in batches:
            yield batch.filter(pa.array([own.score(_bag(t.as_py())) >= least for t in batch.column(at)], pa.bool_()))

    plain = _by_place(docs)
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


def op10_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels)
    scored = score_documents(docs.select("doc_id", "text"), model).drop("text")
    return scored.select(
        "doc_id", (F.coalesce(fold("doc_id"), F.lit(0)) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
