"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

Words are separated by blanks.  A word counts as it is spelled, in lower case, alone and
with its successor; and by its shape, in runs of up to ``SHAPES`` words: case, kind of
first and last character, doubled sign at its end, length, end of line, repetition of the word
before.  Shapes carry over to words never seen.  Each kind of n-gram gives a document shares
that add up to ``SCALE``, so that length does not matter; a score is the sparse dot product of the
shares with the weights, through a sigmoid.

It is trained on the driver from at most ``PER_LABEL`` different texts for each
label, each with its ``FEATURES`` most frequent n-grams.  Everything else covers
all documents and whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelog.llm.base import small_batches, stage
from tidelog.llm.langid import held_out
from tidelog.llm.words import BLANK_SEPARATED, Words, mix, split_words, text_blocks

BITS = 18
SHAPES = 3
SCALE = 6.0
PER_LABEL = 2000
FEATURES = 4096
EPOCHS = 4
# Parameters of the learner: rate, smoothing, weights that stay zero, shrinking.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.05
THRESHOLD = 0.3  # fixed value
#: Features of their own: the bias, and a text without words.
BIAS, NO_WORDS = 0, 1

_UPPER, _LETTER, _STOP = (np.zeros(256, bool) for _ in range(3))
_UPPER[0x41:0x5B] = True
_LETTER[np.r_[0x30:0x3A, 0x41:0x5B, 0x61:0x7B, 0x80:0x100]] = True
_STOP[np.frombuffer(b".,;:!?", np.uint8)] = True


@dataclass
class Model:
    weights: np.ndarray


def shapes(raw: np.ndarray, offsets: np.ndarray, words: Words) -> np.ndarray:
    """A small number for the shape of every word of a block."""
    start, end = words.start, words.end
    upper = np.cumsum(np.concatenate([[0], _UPPER[raw]]))
    capitals = np.minimum(upper[end] - upper[start], 2)
    last, first = raw[end - 1], raw[start]
    ending = np.where(_LETTER[last], 0, np.where(_STOP[last], 1, 2))
    doubled = (ending > 0) & (end - start > 1) & (raw[np.maximum(end - 2, 0)] == last)
    size = np.minimum(np.log2(end - start).astype(np.int64), 4)
    # The blanks up to the next word, or to the end of the text.
    owner_end = offsets[np.searchsorted(offsets, start, side="right")]
    following = np.minimum(np.append(start[1:], len(raw)), owner_end)
    lines = np.cumsum(np.concatenate([[0], raw == 0x0A]))
    broken = lines[following] > lines[end]
    again = np.zeros(len(start), bool)
    again[1:] = words.hash[1:] == words.hash[:-1]
    again[words.first[:-1][np.diff(words.first) > 0]] = False
    code = capitals
    for part, n in ((ending, 3), (doubled, 2), (size, 5), (broken, 2), (_LETTER[first], 2), (again, 2)):
        code = code * n + part
    return code.astype(np.uint64)


def _grams(codes: np.ndarray, first: np.ndarray, n: int, family: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature and text of every run of ``n`` codes that lies in one text."""
    total = np.full(max(len(codes) - n + 1, 0), np.uint64(family + 1), np.uint64)
    for j in range(n):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + codes[j: len(codes) - n + 1 + j])
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    whole = owner[: len(total)] == owner[n - 1:]
    return 2 + (total[whole] % np.uint64((1 << BITS) - 2)).astype(np.int64), owner[: len(total)][whole]


def features(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(features, texts)`` of a block, one pair of arrays for each kind of n-gram."""
    words = split_words(raw, offsets, BLANK_SEPARATED)
    spelled = words.hash
    shaped = shapes(raw, offsets, words) if len(spelled) else spelled
    kinds = [(spelled, 1), (spelled, 2)] + [(shaped, n) for n in range(1, SHAPES + 1)]
    for family, (codes, n) in enumerate(kinds):
        yield _grams(codes, words.first, n, family)


def scores(model: Model, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Probability of label 1 for every text of a block."""
    n, w = len(offsets) - 1, model.weights
    total, empty = np.full(n, w[BIAS], np.float64), np.ones(n, bool)
    for feature, owner in features(raw, offsets):
        count = np.bincount(owner, minlength=n)
        total += SCALE * np.bincount(owner, w[feature], n) / np.maximum(count, 1)
        empty &= count == 0
    total[empty] += w[NO_WORDS]
    return _sigmoid(total)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def vector(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One text as a sparse vector, for training: its most frequent features."""
    found, shares = [np.array([BIAS])], [np.ones(1)]
    for feature, _ in features(raw, np.array([0, len(raw)])):
        if len(feature):
            own, count = np.unique(feature, return_counts=True)
            found.append(own)
            shares.append(SCALE * count / len(feature))
    if len(found) == 1:
        return np.array([BIAS, NO_WORDS]), np.ones(2)
    found, shares = np.concatenate(found), np.concatenate(shares)
    own, at = np.unique(found, return_inverse=True)
    shares = np.bincount(at, shares)
    if len(own) > FEATURES:
        keep = np.sort(np.argsort(-shares, kind="stable")[:FEATURES])
        own, shares = own[keep], shares[keep]
    return own, shares


def train(examples: list[tuple[np.ndarray, np.ndarray, int, float]], epochs: int = EPOCHS, seed: int = 1) -> Model:
    """Fit to ``(features, shares, label, weight)``; the result depends on nothing else."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)

    def weights(at):
        w = -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(z[at]) <= L1, 0.0, w)

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(examples)):
            at, share, label, weight = examples[i]
            w = weights(at)
            g = weight * (_sigmoid(w @ share) - label) * share
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    return Model(weights(slice(None)).astype(np.float32))


def sample(docs: DataFrame, labels: DataFrame, learn: Column, key: str = "doc_id", label: str = "quality",
           per_label: int = PER_LABEL) -> list[tuple[np.ndarray, np.ndarray, int, float]]:
    """At most ``per_label`` different texts of each label as vectors, drawn by hash.

    Copies of a text take one place.  A text weighs as many as its label has texts
    for each one drawn, so that scores keep the labels' shares.
    """
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.filter(learn).select(F.col(key).alias("_id"), text.alias("text"), F.xxhash64(text).alias("_draw"))
    marked = labels.filter(F.col(label).isin(0, 1)).select(F.col(key).alias("_id"), F.col(label).cast("int").alias("_label")).distinct()
    # Ids and hashes meet, not texts.
    texts = stage(rows.select("_id", "_draw").join(marked, "_id").groupBy("_label", "_draw").agg(F.min("_id").alias("_id")), "labelled")
    counts = dict(texts.groupBy("_label").count().collect())
    if len(counts) < 2:
        return []
    share = F.coalesce(*[F.when(F.col("_label") == k, F.lit(min(1.0, 3 * per_label / n))) for k, n in sorted(counts.items())])
    order = F.xxhash64("_draw", F.lit(7))
    rank = F.row_number().over(Window.partitionBy("_label").orderBy(order, "_draw"))
    drawn = texts.filter(F.pmod(order, F.lit(1_000_003)) < share * 1_000_003).withColumn("_rank", rank)
    drawn = stage(drawn.filter(F.col("_rank") <= per_label).drop("_rank"), "drawn")
    # At most 2 * per_label rows.
    own = rows.join(F.broadcast(drawn), ["_id", "_draw"]).select("_label", "_draw", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, raw, offsets in text_blocks(batch.column(2)):
                for i in range(len(offsets) - 1):
                    at, shares = vector(raw[offsets[i]: offsets[i + 1]])
                    out.append((batch.column(0)[row + i].as_py(), batch.column(1)[row + i].as_py(),
                                at.astype(np.int32).tobytes(), shares.astype(np.float32).tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    zip(*out, strict=True), (pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)],
                    ["label", "draw", "at", "shares"])

    got = own.mapInArrow(run, "label int, draw long, at binary, shares binary").dropDuplicates(["label", "draw"]).collect()
    got.sort(key=lambda r: (r.draw, r.label))
    sizes = {k: sum(r.label == k for r in got) for k in counts}
    mean = sum(counts.values()) / max(sum(sizes.values()), 1)
    return [(np.frombuffer(r["at"], np.int32).astype(np.int64), np.frombuffer(r.shares, np.float32).astype(np.float64), r.label,
             counts[r.label] / sizes[r.label] / mean) for r in got]


def predict(docs: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """``(key, score, predicted)`` of every whole text; null counts as empty.

    Other columns than ``key`` and ``text`` are ignored, whatever their names.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, raw, offsets in text_blocks(batch.column(1)):
                p = scores(model, raw, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, len(p)), pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32))],
                    [key, "score", "predicted"])

    return rows.mapInArrow(run, f"`{key}` {kind}, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Learn from labelled documents that are not held out, then score all.

    ``docs`` needs ``key`` and ``text``, ``labels`` ``key`` and ``quality``.  A document
    without id is not learned from and not held out; labels other than 0 and 1 and those
    of no document are ignored; a text with both labels is learned with both.  Without
    two labels to learn, every score is one half.  An empty table gives an empty result.
    """
    learn = F.col(key).isNotNull() & ~held_out(key)
    model = train(sample(docs, labels, learn, key))
    return predict(docs, model, key).withColumn("held_out", held_out(key))
