"""Document quality by attention over passages (multiple-instance learning).

A document is a bag of passages of at most ``PASSAGE`` words, its label says
nothing about any one of them.  Every passage is encoded: shares of kinds of
bytes, word and line shape, repetition, and hashed word features.  Gated
attention ``softmax(w . (tanh(V h) * sigmoid(U h)))`` weighs the passages, and
the weighted mean of their representations is scored.  Encoder, attention
and scorer are learned together from document labels.

Training reads a bounded sample of labelled rows (``docs_per_label`` of either
label, each of at most ``max_bytes`` bytes, chosen by a hash of the id), encoded by
Spark tasks; scoring reads every whole text and only text.  A null or empty
text is a bag with one empty passage.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peerlens.llm.language_crf import held_out
from peerlens.llm.store import small_batches
from peerlens.llm.words import U64, Texts, mix, texts_of

PASSAGE = 64
HASHED = 32
SHAPES = 16
WIDTH = SHAPES + HASHED
HIDDEN, GATE = 16, 8
ROUNDS = 300
SEED = 5

_b = np.arange(256)
KINDS = np.stack(
    [
        (_b >= 97) & (_b <= 122),
        (_b >= 65) & (_b <= 90),
        (_b >= 48) & (_b <= 57),
        _b >= 128,
        np.isin(_b, [46, 44, 59, 58, 39, 34, 40, 41, 45]),
        np.isin(_b, [33, 63]),
        np.isin(_b, [ord(c) for c in "*#$%&^~_=+@<>{}[]\\/`"]),
        _b == 124,
        _b == 10,
    ]
).astype(np.float32)


def encode(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """``(passages, WIDTH)`` features and the first passage of each text."""
    counts = texts.counts()
    passages = np.maximum(1, -(-counts // PASSAGE))
    first = np.concatenate([[0], np.cumsum(passages)])
    n = int(first[-1])
    text = np.repeat(np.arange(texts.rows), passages)
    number = np.arange(n) - first[text]
    word_at = np.minimum(texts.first[text] + number * PASSAGE, texts.first[text + 1])
    word_to = np.minimum(word_at + PASSAGE, texts.first[text + 1])
    words = word_to - word_at
    passage_of = np.repeat(np.arange(n), words)
    out = np.zeros((n, WIDTH), np.float32)
    # Bytes from the first word of a passage to the next passage's, spaces included.
    starts = np.append(texts.starts, len(texts.raw))
    byte_at = np.where(words > 0, starts[word_at], texts.bounds[text])
    byte_to = np.where(words > 0, np.minimum(np.where(word_to < texts.first[text + 1], starts[np.minimum(word_to, len(texts))], texts.bounds[text + 1]), texts.bounds[text + 1]), byte_at)
    length = np.maximum(1, byte_to - byte_at)
    for k, kind in enumerate(KINDS):
        total = np.zeros(len(texts.raw) + 1, np.int64)
        np.cumsum(kind[texts.raw].astype(np.int64), out=total[1:])
        out[:, k] = (total[byte_to] - total[byte_at]) / length
    if len(texts):
        sizes = (texts.ends - texts.starts).astype(np.float64)
        many = np.maximum(1, words)
        mean = np.bincount(passage_of, sizes, minlength=n) / many
        out[:, 9] = mean / 10
        out[:, 10] = np.sqrt(np.maximum(0, np.bincount(passage_of, sizes**2, minlength=n) / many - mean**2)) / 10
        hashes = texts.word_hash()
        same = np.zeros(len(hashes))
        same[1:] = (hashes[1:] == hashes[:-1]) & (passage_of[1:] == passage_of[:-1])
        out[:, 11] = np.bincount(passage_of, same, minlength=n) / many
        order = np.lexsort((hashes, passage_of))
        again = np.zeros(len(hashes))
        again[1:] = (hashes[order][1:] == hashes[order][:-1]) & (passage_of[order][1:] == passage_of[order][:-1])
        out[:, 12] = np.bincount(passage_of[order], again, minlength=n) / many
        slot = (hashes % U64(HASHED)).astype(np.int64)
        sign = np.where((mix(hashes) >> U64(63)).astype(bool), 1.0, -1.0)
        bag = np.bincount(passage_of * HASHED + slot, sign, minlength=n * HASHED).reshape(n, HASHED)
        out[:, SHAPES:] = bag / np.sqrt(many)[:, None]
    out[:, 13] = np.log1p(words) / 5
    out[:, 14] = words == 0
    out[:, 15] = np.log1p(counts[text]) / 10
    return out, first


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    encoder: np.ndarray
    shift: np.ndarray
    v: np.ndarray
    u: np.ndarray
    w: np.ndarray
    scorer: np.ndarray
    bias: np.ndarray


LEARNED = ("encoder", "shift", "v", "u", "w", "scorer", "bias")


def _forward(m: Model, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
    bag = np.repeat(np.arange(len(first) - 1), np.diff(first))
    x = np.clip((x - m.mean) / m.scale, -5, 5)
    h = np.tanh(x @ m.encoder + m.shift)
    t, g = np.tanh(h @ m.v), 1 / (1 + np.exp(-(h @ m.u)))
    e = (t * g) @ m.w
    top = np.maximum.reduceat(e, first[:-1])
    a = np.exp(e - top[bag])
    a /= np.add.reduceat(a, first[:-1])[bag]
    z = np.add.reduceat(a[:, None] * h, first[:-1], axis=0)
    p = 1 / (1 + np.exp(-(z @ m.scorer + m.bias[0])))
    return {"bag": bag, "x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "p": p}


def score(m: Model, x: np.ndarray, first: np.ndarray) -> np.ndarray:
    return _forward(m, x, first)["p"]


def train(x: np.ndarray, first: np.ndarray, labels: np.ndarray, rounds: int = ROUNDS, decay: float = 1e-4) -> Model:
    """Full-batch Adam on the cross entropy of document labels, both labels weighing the same."""
    rng = np.random.default_rng(SEED)
    d = x.shape[1]
    m = Model(
        x.mean(axis=0),
        x.std(axis=0) + 1e-3,
        rng.normal(0, d**-0.5, (d, HIDDEN)),
        np.zeros(HIDDEN),
        rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)),
        rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)),
        rng.normal(0, GATE**-0.5, GATE),
        rng.normal(0, HIDDEN**-0.5, HIDDEN),
        np.zeros(1),
    )
    y = labels.astype(float)
    ones = max(1, y.sum())
    weight = np.where(y > 0, 0.5 / ones, 0.5 / max(1, len(y) - y.sum()))
    moments = {name: (np.zeros_like(getattr(m, name)), np.zeros_like(getattr(m, name))) for name in LEARNED}
    for step in range(1, rounds + 1):
        f = _forward(m, x, first)
        bag, h, a = f["bag"], f["h"], f["a"]
        dp = weight * (f["p"] - y)
        dz = dp[:, None] * m.scorer
        dh = a[:, None] * dz[bag]
        da = (h * dz[bag]).sum(axis=1)
        de = a * (da - np.add.reduceat(a * da, first[:-1])[bag])
        dt = de[:, None] * m.w * f["g"] * (1 - f["t"] ** 2)
        dg = de[:, None] * m.w * f["t"] * f["g"] * (1 - f["g"])
        dh = (dh + dt @ m.v.T + dg @ m.u.T) * (1 - h**2)
        grads = {
            "encoder": f["x"].T @ dh,
            "shift": dh.sum(axis=0),
            "v": h.T @ dt,
            "u": h.T @ dg,
            "w": (f["t"] * f["g"]).T @ de,
            "scorer": f["z"].T @ dp,
            "bias": np.array([dp.sum()]),
        }
        for name, grad in grads.items():
            value = getattr(m, name)
            grad = grad + decay * value
            one, two = moments[name]
            one += 0.1 * (grad - one)
            two += 0.01 * (grad * grad - two)
            value -= 0.03 * (one / (1 - 0.9**step)) / (np.sqrt(two / (1 - 0.99**step)) + 1e-9)
    return m


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map function: ``(label, rank, passages)`` with the encoded passages of each text."""
    for batch in batches:
        for texts in texts_of(batch.column("text"), lower=False):
            x, first = encode(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("label").slice(texts.row, texts.rows),
                    batch.column("rank").slice(texts.row, texts.rows),
                    pa.array([x[a:b].tobytes() for a, b in zip(first[:-1], first[1:])], pa.binary()),
                ],
                names=["label", "rank", "passages"],
            )


def fit(labelled: DataFrame, docs_per_label: int = 1500, max_bytes: int = 65_536) -> Model | None:
    """Train on ``labelled(doc_id, text, label)``: at most ``docs_per_label`` documents of label 0 and of 1.

    None if either label is missing.
    """
    rank = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"))
    sample = (
        labelled.where("label IN (0, 1) AND doc_id IS NOT NULL AND coalesce(octet_length(text), 0) <= " + str(max_bytes))
        .withColumn("rank", F.row_number().over(rank))
        .where(F.col("rank") <= docs_per_label)
        .select(F.col("label").cast("int"), "rank", F.col("text").cast("string"))
        .mapInArrow(_encoded, "label int, rank int, passages binary")
    )
    rows = sorted((r.label, r.rank, bytes(r.passages)) for r in sample.collect())
    labels = np.array([r[0] for r in rows])
    if len(set(labels.tolist())) < 2:
        return None
    x = np.frombuffer(b"".join(r[2] for r in rows), np.float32).reshape(-1, WIDTH)
    first = np.concatenate([[0], np.cumsum([len(r[2]) // (4 * WIDTH) for r in rows])])
    return train(x.astype(np.float64), first, labels)


def score_texts(model: Model):
    """Map function: ``(doc_id, held_out, score, predicted)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in texts_of(batch.column("text"), lower=False):
                p = score(model, *encode(texts))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(texts.row, texts.rows),
                        batch.column("held_out").slice(texts.row, texts.rows),
                        pa.array(p),
                        pa.array((p >= 0.5).astype(np.int32)),
                    ],
                    names=["doc_id", "held_out", "score", "predicted"],
                )

    return run


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of each row of ``docs(doc_id, text)``.

    ``labels`` has ``doc_id`` and ``quality``; labels other than 0 and 1 and labels of
    held out documents teach nothing.  If either label is missing, every score is 0.5.
    """
    small_batches(docs.sparkSession)
    known = labels.where(~held_out(1, 3)).select("doc_id", F.col("quality").alias("label")).where("doc_id IS NOT NULL")
    texts = docs.where(~held_out(1, 3)).select("doc_id", F.col("text").cast("string").alias("text"))
    rank = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id")
    drawn = known.where("label IN (0, 1)").distinct().withColumn("row", F.row_number().over(rank)).where("row <= 1500")
    model = fit(texts.join(F.broadcast(drawn.select("doc_id", "label")), "doc_id"))
    rows = docs.select(
        F.col("doc_id").cast("long"), held_out(1, 3).alias("held_out"), F.col("text").cast("string").alias("text")
    )
    if model is None:
        return rows.select("doc_id", "held_out", F.lit(0.5).alias("score"), F.lit(1).alias("predicted"))
    return rows.mapInArrow(score_texts(model), "doc_id long, held_out boolean, score double, predicted int")
