"""Quality classifier: attention-based multiple-instance learning over passages.

A text is cut into passages of ``PASSAGE`` bytes. Each is encoded from the kinds of its
characters and of their neighbours, and from how many words seem to repeat the word
before (square roots of shares, standardised) by a dense layer; gated attention gives each passage a weight, learned from document labels
alone; the weighted sum of the encodings is scored. A text's score so depends on all
of it, and a passage of junk can decide it.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm import labelled, shingles, text_bytes
from sparkmart.llm.optimiser import Adam, sigmoid

PASSAGE = 400
#: Bounds of the sample that is learned from: documents per label, and bytes of one.
PER_LABEL = 1500
LONGEST = 1 << 16
PARTS, HELD_OUT = 3, 1
HIDDEN, GATE = 24, 12
EPOCHS, BATCH, RATE, DECAY = 16, 64, 4e-3, 1e-3
#: A small sample is gone through more often, for as many steps at least.
STEPS = 700

_KINDS = [
    "abcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "0123456789",
    " ",
    "\n\r\t\v\f",
    ".",
    ",;:",
    "!?",
    "'\"`",
    "-_/\\",
    "()[]{}<>",
    "|",
    "$%&*#@+=~^",
]
#: Then: other ASCII, bytes that begin a character beyond it, bytes that go on with one.
_N = len(_KINDS) + 3
_KIND = np.full(256, len(_KINDS), np.int64)
for _k, _of in enumerate(_KINDS):
    _KIND[list(_of.encode())] = _k
_KIND[0x80:0xC0], _KIND[0xC0:] = _N - 1, _N - 2
FEATURES = _N + _N * _N + 1


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    #: Added to the log odds: the sample has other shares of labels than the table.
    prior: float


def _repeats(
    data: np.ndarray, offsets: np.ndarray, passage: np.ndarray, n: int
) -> np.ndarray:
    """For each passage, the share of words as long as the last and beginning like it.

    A word is a run of other than white space within one text, whatever stands before it.
    """
    starts, stops = shingles.word_bounds(data, offsets)
    if not len(starts):
        return np.zeros(n)
    size = stops - starts
    same = (size[1:] == size[:-1]) & (passage[starts[1:]] == passage[starts[:-1]])
    for k in range(3):
        last = np.minimum(k, size - 1)
        same &= data[starts[1:] + last[1:]] == data[starts[:-1] + last[:-1]]
    words = np.bincount(passage[starts], minlength=n)
    return np.bincount(passage[starts[1:][same]], minlength=n) / np.maximum(1, words)


def passage_features(
    data: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and the number of each text's (an empty one has one)."""
    sizes = np.diff(offsets)
    counts = np.maximum(1, -(-sizes // PASSAGE))
    first = np.concatenate([[0], np.cumsum(counts)])
    at = np.arange(len(data)) - np.repeat(offsets[:-1], sizes)
    passage = np.repeat(first[:-1], sizes) + at // PASSAGE
    kind = _KIND[data]
    single = np.bincount(passage * _N + kind, minlength=first[-1] * _N)
    pair = passage[:-1] == passage[1:]
    double = np.bincount(
        (passage[:-1] * _N * _N + kind[:-1] * _N + kind[1:])[pair],
        minlength=first[-1] * _N * _N,
    )
    shares = np.concatenate(
        [single.reshape(-1, _N), double.reshape(-1, _N * _N)], axis=1
    ).astype(np.float32)
    held = np.maximum(1, shares[:, :_N].sum(axis=1, keepdims=True))
    repeats = _repeats(data, offsets, passage, int(first[-1])).astype(np.float32)
    return np.sqrt(np.column_stack([shares / held, repeats])), counts


def _forward(x: np.ndarray, counts: np.ndarray, w: dict[str, np.ndarray]) -> tuple:
    begin = np.concatenate([[0], np.cumsum(counts)[:-1]])
    doc = np.repeat(np.arange(len(counts)), counts)
    h = np.tanh(x @ w["encode"] + w["encode_bias"])
    tanh, gate = np.tanh(h @ w["attend"]), sigmoid(h @ w["gate"])
    raw = (tanh * gate) @ w["weigh"]
    raw = np.exp(raw - np.maximum.reduceat(raw, begin)[doc])
    a = raw / np.add.reduceat(raw, begin)[doc]
    z = np.add.reduceat(h * a[:, None], begin, axis=0)
    logit = z @ w["score"] + w["score_bias"][0]
    return begin, doc, h, tanh, gate, a, z, logit


def log_odds(x: np.ndarray, counts: np.ndarray, model: Model) -> np.ndarray:
    x = (x - model.mean) * model.scale
    return _forward(x, counts, model.weights)[-1] + model.prior


def train(x: np.ndarray, counts: np.ndarray, y: np.ndarray) -> tuple:
    """Fit on documents given as passages; ``y`` is 0 or 1 for each document.

    Gives the features' means and scales and the weights.
    """
    rng = np.random.default_rng(7)
    mean, scale = x.mean(axis=0), 1 / (x.std(axis=0) + 0.02)
    x = ((x - mean) * scale).astype(np.float32)

    def normal(*shape):
        return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

    w = {
        "encode": normal(FEATURES, HIDDEN),
        "encode_bias": np.zeros(HIDDEN, np.float32),
        "attend": normal(HIDDEN, GATE),
        "gate": normal(HIDDEN, GATE),
        "weigh": normal(GATE),
        "score": normal(HIDDEN),
        "score_bias": np.zeros(1, np.float32),
    }
    adam = Adam(w, RATE, DECAY)
    begin = np.concatenate([[0], np.cumsum(counts)])
    epochs = max(EPOCHS, -(-STEPS * BATCH // max(1, len(y))))
    for _ in range(epochs if len(y) else 0):
        order = rng.permutation(len(y))
        for low in range(0, len(order), BATCH):
            docs = order[low : low + BATCH]
            rows = np.concatenate([np.arange(begin[d], begin[d + 1]) for d in docs])
            part = x[rows]
            at, doc, h, tanh, gate, a, z, logit = _forward(part, counts[docs], w)
            d_logit = (sigmoid(logit) - y[docs]) / len(docs)
            d_z = d_logit[:, None] * w["score"]
            d_a = (h * d_z[doc]).sum(axis=1)
            d_raw = a * (d_a - np.add.reduceat(a * d_a, at)[doc])
            d_mix = d_raw[:, None] * w["weigh"]
            d_tanh, d_gate = d_mix * gate * (1 - tanh**2), d_mix * tanh * gate * (1 - gate)
            d_h = a[:, None] * d_z[doc] + d_tanh @ w["attend"].T + d_gate @ w["gate"].T
            d_in = d_h * (1 - h**2)
            adam.step(
                {
                    "encode": part.T @ d_in,
                    "encode_bias": d_in.sum(axis=0),
                    "attend": h.T @ d_tanh,
                    "gate": h.T @ d_gate,
                    "weigh": (tanh * gate).T @ d_raw,
                    "score": z.T @ d_logit,
                    "score_bias": d_logit.sum(keepdims=True),
                }
            )
    return mean, scale, w


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in text_bytes.blocks(batch.column("text")):
            x, counts = passage_features(block.data, block.offsets)
            ends = np.cumsum(counts)
            x = x.astype(np.float16)
            yield pa.record_batch(
                [
                    batch.column("label").slice(block.first, block.rows),
                    pa.array(
                        [x[e - c : e].tobytes() for e, c in zip(ends, counts, strict=True)],
                        pa.binary(),
                    ),
                ],
                names=["label", "passages"],
            )


def _train(sample: pa.Table) -> tuple:
    rows = sorted(zip(sample["label"].to_pylist(), sample["passages"].to_pylist(), strict=True))
    y = np.array([label for label, _ in rows], np.float32)
    x = [np.frombuffer(p, np.float16).reshape(-1, FEATURES) for _, p in rows]
    taken = int((y == 0).sum()), int((y == 1).sum())
    if not all(taken):
        x, y = [], y[:0]
    whole = np.concatenate([np.zeros((int(not x), FEATURES)), *x]).astype(np.float32)
    return train(whole, np.array([len(p) for p in x], int), y), taken


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from at most ``PER_LABEL`` documents per label that are not held out.

    Documents longer than ``LONGEST`` bytes are not learned from (all are scored).
    Without labelled documents of both labels every score is near the labels' share.
    """
    short = docs.where(F.coalesce(F.octet_length("text"), F.lit(0)) <= LONGEST)
    sample = labelled.sample(short, labels, "quality", PARTS, HELD_OUT, PER_LABEL)
    fitted, taken = labelled.train_in_task(
        sample.mapInArrow(_encode, "label int, passages binary"), _train
    )
    bad, good = labelled.shares(labels, "quality", PARTS, HELD_OUT)
    odds = (good + 1) / (bad + 1)
    if all(taken):
        odds *= taken[0] / taken[1]
    return Model(*fitted, float(np.log(odds)))


def _scorer(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in text_bytes.blocks(batch.column("text")):
                odds = log_odds(*passage_features(block.data, block.offsets), model)
                yield pa.record_batch(
                    [
                        batch.column("doc_id").slice(block.first, block.rows),
                        pa.array(sigmoid(odds.astype(np.float64))),
                    ],
                    names=["doc_id", "score"],
                )

    return run


def score(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``.

    The score (0 to 1) is the chance of label 1. Only texts are read. A null or empty
    text is one empty passage and scored like any other; repeated rows and null ids come
    back as often as they are there; an empty table gives an empty result.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(
        _scorer(model), f"doc_id {id_type}, score double"
    )
    return scored.select(
        "doc_id",
        labelled.held_out("doc_id", PARTS, HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def _filter(model: Model, position: int, threshold: float):
    least = np.log(threshold / (1 - threshold))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in text_bytes.blocks(batch.column(position)):
                odds = log_odds(*passage_features(block.data, block.offsets), model)
                part = batch.slice(block.first, block.rows)
                yield part.filter(pa.array(odds >= least))

    return run


def accepted(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``threshold``, with all columns."""
    run = _filter(model, docs.columns.index("text"), threshold)
    return docs.mapInArrow(run, docs.schema)
