"""Language identification: a bidirectional gated recurrent network over bytes.

The network reads UTF-8 bytes in windows of ``WINDOW`` bytes, forwards and
backwards, each from a zero state, and gives every byte a probability for each
language.  A document's probabilities are the means over all its bytes.  It is
trained in numpy by backpropagation through time on the driver, from a bounded
sample: ``SNIPPETS`` windows of each of at most ``PER_LANGUAGE`` labelled
documents per language.  Everything else covers all documents and all bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelog.llm.base import small_batches
from tidelog.llm.words import text_blocks

WINDOW = 128
HIDDEN = 8
PER_LANGUAGE = 400
SNIPPETS = 4
STEPS = 240
TRAIN_BYTES = 48
BATCH = 128
RATE = 0.02
UNKNOWN = "und"


@dataclass
class Model:
    """For each direction (f, b): ``E``, what a byte adds to gate and candidate,
    and ``U``, what the state adds; then output matrix ``V`` and bias ``c``.
    Columns of a state are texts, so that every operation runs along them."""

    labels: list[str]
    weights: dict[str, np.ndarray]


def initial(labels: list[str], hidden: int = HIDDEN, seed: int = 1) -> Model:
    rng = np.random.default_rng(seed)
    w = {}
    for side in "fb":
        w[f"E{side}"] = rng.normal(0, 0.3, (2 * hidden, 256))
        w[f"E{side}"][:hidden] += 0.5  # the gate starts half open
        w[f"U{side}"] = rng.normal(0, 0.3, (2 * hidden, hidden))
        w[f"V{side}"] = rng.normal(0, 0.3, (len(labels), hidden))
    w["c"] = np.zeros((len(labels), 1))
    return Model(labels, {k: v.astype(np.float32) for k, v in w.items()})


def _states(model: Model, side: str, codes: np.ndarray, active: np.ndarray, tape: list | None = None) -> np.ndarray:
    """States (time, hidden, text) in one direction.

    A gated unit: gate ``z`` (a sigmoid of straight lines) and candidate ``n`` (a
    soft sign), both from byte and state; the state moves to the candidate as far as the
    gate says.  Texts come longest first, so at each time the first ``active``
    of them go on.
    """
    e, u = model.weights["E" + side], model.weights["U" + side]
    hidden, (steps, rows) = u.shape[1], codes.shape
    out = np.zeros((steps, hidden, rows), e.dtype)
    h = np.zeros((hidden, rows), e.dtype)
    for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
        k = active[t]
        before = h[:, :k]
        a = np.take(e, codes[t, :k], axis=1, mode="clip")
        a += u @ before
        z = np.clip(a[:hidden], 0, 1, out=a[:hidden])
        n = a[hidden:]
        n /= np.abs(n) + 1
        move = np.subtract(n, before, out=out[t][:, :k])
        move *= z
        if tape is not None:
            tape.append((t, before.copy(), z, n))
        move += before
        h = out[t]
    return out


def _logits(model: Model, forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
    w = model.weights
    return np.matmul(w["Vf"], forward) + np.matmul(w["Vb"], backward) + w["c"]


def probabilities(model: Model, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Language probabilities of every byte, as (time, label, text).

    ``codes`` is (time, text) with the longest text first; padding has zeros.
    """
    active = np.searchsorted(-lengths, -np.arange(codes.shape[0]), side="left")
    p = _logits(model, _states(model, "f", codes, active), _states(model, "b", codes, active))
    p -= p.max(axis=1, keepdims=True)
    np.exp(p, out=p)
    p /= p.sum(axis=1, keepdims=True)
    if lengths[-1] < codes.shape[0]:
        p *= (np.arange(codes.shape[0])[:, None] < lengths)[:, None, :]
    return p


def gradients(model: Model, codes: np.ndarray, lengths: np.ndarray, truth: np.ndarray) -> tuple[float, dict]:
    """Mean cross entropy over all bytes and its gradient, by backpropagation through time."""
    w, (steps, rows), hidden = model.weights, codes.shape, model.weights["Uf"].shape[1]
    active = np.searchsorted(-lengths, -np.arange(steps), side="left")
    p = probabilities(model, codes, lengths)
    real = np.arange(steps)[:, None] < lengths
    total = real.sum()
    chosen = p[:, truth, np.arange(rows)]
    loss = float(-np.log(np.maximum(chosen[real], 1e-9)).sum() / total)
    d = p.copy()
    d[:, truth, np.arange(rows)] -= 1
    d *= real[:, None, :] / d.dtype.type(total)
    grad = {"c": d.sum(axis=(0, 2))[:, None]}
    spots = np.zeros((steps * rows, 256), d.dtype)
    spots[np.arange(steps * rows), codes.ravel()] = 1
    for side in "fb":
        tape: list = []
        states = _states(model, side, codes, active, tape)
        grad["V" + side] = np.einsum("tlr,thr->lh", d, states)
        above = np.matmul(w["V" + side].T, d)
        da = np.zeros((steps, 2 * hidden, rows), d.dtype)
        grad["U" + side] = np.zeros_like(w["U" + side])
        dh = np.zeros((hidden, rows), d.dtype)
        for t, before, z, n in reversed(tape):
            k = before.shape[1]
            g = dh[:, :k] + above[t][:, :k]
            da[t, :hidden, :k] = g * (n - before) * ((z > 0) & (z < 1))
            da[t, hidden:, :k] = g * z * (1 - np.abs(n)) ** 2
            grad["U" + side] += da[t, :, :k] @ before.T
            dh[:, :k] = g * (1 - z) + w["U" + side].T @ da[t, :, :k]
        grad["E" + side] = da.transpose(1, 0, 2).reshape(2 * hidden, -1) @ spots
    return loss, grad


def train(snippets: list[tuple[bytes, str]], steps: int = STEPS, seed: int = 1) -> Model:
    """Fit the network to labelled byte strings; the result depends on nothing else."""
    labels = sorted({lang for _, lang in snippets})
    model = initial(labels, seed=seed)
    if len(labels) < 2:
        return model
    number = {lang: i for i, lang in enumerate(labels)}
    rows = sorted(s for s in snippets if s[0])
    by_label = [[b for b, lang in rows if number[lang] == k] for k in range(len(labels))]
    rng = np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in model.weights.items()}
    second = {k: np.zeros_like(v) for k, v in model.weights.items()}
    for step in range(1, steps + 1):
        # Languages in equal shares, whatever their shares in the corpus; pieces
        # from anywhere in a snippet, some of them short as short texts are.
        batch = []
        for k, own in enumerate(by_label):
            for b in (own[i] for i in rng.integers(0, len(own), max(1, BATCH // len(labels)))):
                n = min(len(b), int(rng.integers(4, TRAIN_BYTES + 1)) if rng.random() < 0.5 else TRAIN_BYTES)
                at = int(rng.integers(0, len(b) - n + 1))
                batch.append((n, k, b[at: at + n]))
        batch.sort(key=lambda x: -x[0])
        codes = np.zeros((batch[0][0], len(batch)), np.intp)
        for i, (n, _, b) in enumerate(batch):
            codes[:n, i] = np.frombuffer(b, np.uint8)
        _, grad = gradients(model, codes, np.array([n for n, _, _ in batch]), np.array([k for _, k, _ in batch]))
        rate = RATE * min(1, 2 * (1 - step / (steps + 1)))
        for k, g in grad.items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            model.weights[k] -= (rate * (first[k] / (1 - 0.9 ** step))
                                 / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return model


def sample(docs: DataFrame, learn: Column, per_language: int = PER_LANGUAGE) -> list[tuple[bytes, str]]:
    """Snippets of at most ``per_language`` different texts per language, picked by hash.

    The counts per language and the snippets reach the driver: at most
    ``per_language * SNIPPETS * WINDOW`` characters for each language.
    """
    rows = docs.filter(learn & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    drawn = F.xxhash64("text")
    # A text counts once, as it is drawn once: copies take no places in the sample.
    counts = dict(rows.select("lang", drawn.alias("draw")).distinct().groupBy("lang").count().collect())
    if not counts:
        return []
    # Three times the wanted share, then exactly the wanted number by hash.
    share = F.coalesce(*[F.when(F.col("lang") == F.lit(k), F.lit(min(1.0, 3 * per_language / n)))
                         for k, n in sorted(counts.items())])
    rows = rows.withColumn("draw", drawn).filter(F.pmod("draw", F.lit(1_000_003)) < share * 1_000_003)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    # Short enough to travel: only the snippets of a text enter the sort.
    starts = [F.pmod(F.xxhash64("draw", F.lit(k)), F.greatest(F.char_length("text") - WINDOW, F.lit(0)) + 1).cast("int") + 1
              for k in range(SNIPPETS)]
    cuts = F.array_distinct(F.array(*[F.substring("text", s, F.lit(WINDOW)) for s in starts]))
    rows = rows.select("lang", "draw", cuts.alias("cuts")).distinct().withColumn("rank", rank)
    return [(cut.encode(), lang) for lang, cuts in
            rows.filter(F.col("rank") <= per_language).select("lang", "cuts").collect() for cut in cuts]


def _windows(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and text of each window of a block."""
    sizes = np.diff(offsets)
    n = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(sizes)), n)
    inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    start = offsets[owner] + inside * WINDOW
    return start, np.minimum(WINDOW, offsets[owner + 1] - start), owner


def label_block(model: Model, raw: np.ndarray, offsets: np.ndarray, positions: bool = False,
                rows: int = 2048) -> tuple[np.ndarray | None, np.ndarray]:
    """For every text of a block its mean probabilities and, if asked, for every byte its language number."""
    start, length, owner = _windows(offsets)
    sums = np.zeros((len(start), len(model.labels)))
    spots = np.zeros(len(raw), np.uint8) if positions else None
    order = np.argsort(-length, kind="stable")
    for at in range(0, len(order), rows):
        own = order[at: at + rows]
        n = length[own]
        place = start[own] + np.arange(n[0])[:, None]
        p = probabilities(model, raw[np.minimum(place, len(raw) - 1)].astype(np.intp), n)
        sums[own] = p.sum(axis=0).T
        if positions:
            real = np.arange(n[0])[:, None] < n
            spots[place[real]] = p.argmax(axis=1)[real]
    pooled = np.stack([np.bincount(owner, s, len(offsets) - 1) for s in sums.T], axis=1)
    return spots, pooled / np.maximum(np.diff(offsets), 1)[:, None]


def predict(docs: DataFrame, model: Model, key: str = "doc_id", positions: bool = False) -> DataFrame:
    """Language and score of every whole text.

    ``docs`` needs ``key`` and ``text``; other columns are ignored.  A null text or one
    without a letter is ``und`` with score 0, as is every text if nothing was
    learned.  Of equal probabilities the first language by name wins.  Result,
    one row per input row: ``key``, ``lang_pred``, ``score`` and, with
    ``positions``, ``runs``: first byte and language of each stretch of bytes
    with the same label.
    """
    small_batches(docs.sparkSession)
    text = F.col("text").cast("string")
    rows = docs.select(F.col(key), F.coalesce(text, F.lit("")).alias("text"),
                       F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, raw, offsets in text_blocks(batch.column(1)):
                n = len(offsets) - 1
                known = np.array(batch.column(2).slice(row, n).to_pylist(), bool) & bool(model.labels)
                spots, pooled = label_block(model, raw, offsets, positions) if known.any() else (None, np.zeros((n, 1)))
                best = pooled.argmax(axis=1)
                columns = [batch.column(0).slice(row, n),
                           pa.array([model.labels[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], pa.string()),
                           pa.array(np.where(known, np.minimum(pooled.max(axis=1), 1.0), 0.0))]
                names = [key, "lang_pred", "score"]
                if positions:
                    columns.append(pa.array([_runs(spots[offsets[i]: offsets[i + 1]], model.labels) if known[i] else []
                                             for i in range(n)],
                                            pa.list_(pa.struct([("start", pa.int32()), ("lang", pa.string())]))))
                    names.append("runs")
                yield pa.RecordBatch.from_arrays(columns, names)

    more = ", runs array<struct<start:int,lang:string>>" if positions else ""
    return rows.mapInArrow(run, f"`{key}` {kind}, lang_pred string, score double{more}")


def _runs(spots: np.ndarray, labels: list[str]) -> list[dict]:
    first = np.flatnonzero(np.diff(spots.astype(np.int16), prepend=-1))
    return [{"start": int(a), "lang": labels[spots[a]]} for a in first]


def held_out(key: str = "doc_id") -> Column:
    """Documents that training never sees: one in five, by a checksum of the id."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def identify(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Learn from the labelled documents that are not held out, then predict all.

    ``docs`` needs ``key``, ``text`` and ``lang``.  A document without id is not
    learned from and not held out.
    """
    learn = F.col(key).isNotNull() & ~held_out(key)
    model = train(sample(docs, learn))
    return predict(docs, model, key).withColumn("held_out", held_out(key))
