"""Language identification: first the family, then linear SVMs inside it.

A text's features are hashed runs of one to three bytes of its lower-case form. Linear
support vector machines, one per family, tell the families apart; within the family
found, one machine per pair of its languages votes. All are trained here, with a squared
hinge loss.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm import labelled, text_bytes
from sparkmart.llm.optimiser import Adam, sigmoid
from sparkmart.llm.tables import bounded

# Families of languages by their ISO 639-1 codes. A language that is not
# listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en fy is lb nl no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr tk uz",
    "indic": "bn gu hi mr ne pa si ur",
    "iranian": "fa ku ps tg",
    "semitic": "am ar he mt",
    "dravidian": "kn ml ta te",
    "malayic": "id ms",
}
_FAMILY = {code: name for name, codes in FAMILIES.items() for code in codes.split()}

UNDETERMINED = "und"
PARTS, HELD_OUT = 4, 2
#: Bounds of the sample that is learned from, as expected: documents per language and in
#: all (but one for each language, of which none is left out), and bytes of one.
PER_LANGUAGE, SAMPLE = 500, 20_000
LONGEST = 1 << 16
EPOCHS, BATCH, RATE, DECAY = 12, 32, 2e-2, 1e-4
#: Texts whose features a task holds.
_ROWS = 512

_WIDTHS = (256, 1024, 2048)
FEATURES = sum(_WIDTHS)
_LOWER = np.arange(256, dtype=np.int64)
_LOWER[ord("A") : ord("Z") + 1] += 32
_SPREAD = (1, 0x9E3779B1, 0x85EBCA77)


#: Weights and bias of a linear machine.
Machine = tuple[np.ndarray, float]


def _margin(machine: Machine, x: np.ndarray) -> np.ndarray:
    return x @ machine[0] + machine[1]


class Model(NamedTuple):
    #: Languages of each family, sorted.
    families: dict[str, list[str]]
    by_family: dict[str, Machine]
    by_pair: dict[tuple[str, str], Machine]


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row per text: square roots of the shares of hashed byte runs, of length 1."""
    rows = len(offsets) - 1
    doc = np.repeat(np.arange(rows), np.diff(offsets))
    code = _LOWER[data]
    out, mixed = [], np.zeros(len(data), np.int64)
    for n, width in enumerate(_WIDTHS):
        size = max(0, len(data) - n)
        mixed = mixed[:size] + code[n:] * _SPREAD[n]
        whole = doc[:size] == doc[n:]
        slot = (mixed ^ mixed >> 15) % width
        out.append(
            np.bincount(doc[:size][whole] * width + slot[whole], minlength=rows * width)
            .astype(np.float32)
            .reshape(rows, width)
        )
    x = np.concatenate([np.sqrt(c / np.maximum(1, c.sum(1, keepdims=True))) for c in out], 1)
    return x / np.sqrt(len(_WIDTHS))


def train_machine(x: np.ndarray, positive: np.ndarray) -> Machine:
    """A linear machine with squared hinge loss; both sides weigh the same."""
    rng = np.random.default_rng(11)
    w = {"weights": np.zeros(x.shape[1], np.float32), "bias": np.zeros(1, np.float32)}
    adam = Adam(w, RATE, DECAY)
    sign = np.where(positive, 1, -1).astype(np.float32)
    weigh = np.where(positive, 0.5 / positive.mean(), 0.5 / (1 - positive.mean()))
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for low in range(0, len(x), BATCH):
            at = order[low : low + BATCH]
            slack = np.maximum(0, 1 - sign[at] * (x[at] @ w["weights"] + w["bias"]))
            d = (-2 * slack * sign[at] * weigh[at] / len(at)).astype(np.float32)
            adam.step({"weights": d @ x[at], "bias": d.sum(keepdims=True)})
    return w["weights"], float(w["bias"][0])


def train(x: np.ndarray, langs: np.ndarray) -> tuple:
    """Languages by family, machines by family, machines by pair."""
    families: dict[str, list[str]] = {}
    for lang in sorted(set(langs.tolist())):
        families.setdefault(_FAMILY.get(lang, lang), []).append(lang)
    family = np.array([_FAMILY.get(lang, lang) for lang in langs])
    by_family = (
        {f: train_machine(x, family == f) for f in families} if len(families) > 1 else {}
    )
    by_pair = {}
    for members in families.values():
        for a, b in combinations(members, 2):
            both = (langs == a) | (langs == b)
            by_pair[a, b] = train_machine(x[both], langs[both] == a)
    return families, by_family, by_pair


def predict(x: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Languages and scores: the chance of the family times that against its others."""
    names = list(model.families)
    found = np.full(len(x), UNDETERMINED, object)
    score = np.zeros(len(x))
    if not names:
        return found, score
    if model.by_family:
        margins = np.stack([_margin(model.by_family[f], x) for f in names], axis=1)
        family = margins.argmax(axis=1)
        sure = sigmoid(4 * margins.max(axis=1).astype(np.float64))
    else:
        family, sure = np.zeros(len(x), int), np.ones(len(x))
    for k, name in enumerate(names):
        at = np.flatnonzero(family == k)
        members = model.families[name]
        votes = np.zeros((len(at), len(members)))
        chance = np.zeros_like(votes)
        for i, j in combinations(range(len(members)), 2):
            margin = _margin(model.by_pair[members[i], members[j]], x[at])
            p = sigmoid(4 * margin.astype(np.float64))
            votes[:, i] += margin > 0
            votes[:, j] += margin <= 0
            chance[:, i] += p
            chance[:, j] += 1 - p
        best = (votes + chance / (len(members) + 1)).argmax(axis=1)
        found[at] = np.array(members, object)[best]
        own = chance[np.arange(len(at)), best] / max(1, len(members) - 1)
        score[at] = sure[at] * (own if len(members) > 1 else 1)
    return found, score


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in text_bytes.blocks(batch.column("text"), block_rows=_ROWS):
            x = features(block.data, block.offsets).astype(np.float16)
            yield pa.record_batch(
                [
                    batch.column("lang").slice(block.first, block.rows),
                    pa.array([row.tobytes() for row in x], pa.binary()),
                ],
                names=["lang", "features"],
            )


def _train(sample: pa.Table) -> tuple:
    rows = sorted(zip(sample["lang"].to_pylist(), sample["features"].to_pylist(), strict=True))
    x = np.array([np.frombuffer(f, np.float16) for _, f in rows], np.float32)
    return train(x, np.array([lang for lang, _ in rows], object))


def fit(docs: DataFrame) -> Model:
    """Learn from a sample of the documents that have a language and are not held out.

    Up to ``PER_LANGUAGE`` documents of each language are expected, fewer of each where
    there are so many languages that ``SAMPLE`` would be passed, but one at least. They are
    taken by a hash of their ids; documents longer than ``LONGEST`` bytes are not learned
    from, and of rows that repeat an id and language, that with the least text is.
    """
    usable = docs.select("doc_id", "lang", "text").where(
        F.col("lang").isNotNull()
        & F.col("doc_id").isNotNull()
        & (F.octet_length("text") <= LONGEST)
        & ~labelled.held_out("doc_id", PARTS, HELD_OUT)
    )
    place = F.xxhash64("doc_id")
    counts = usable.groupBy("lang").agg(F.count("*").alias("n"), F.min(place).alias("first"))
    languages = counts.count()
    wanted = min(PER_LANGUAGE, max(1, SAMPLE // max(1, languages)))
    part = F.pmod(place, F.lit(1 << 30)) / float(1 << 30)
    sample = (
        usable.join(bounded(counts), "lang")
        .where((part < wanted / F.col("n")) | (place == F.col("first")))
        .groupBy("doc_id", "lang")
        .agg(F.min("text").alias("text"))
        .select("lang", "text")
        .mapInArrow(_encode, "lang string, features binary")
    )
    return Model(*labelled.train_in_task(sample, _train))


def _identifier(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in text_bytes.blocks(batch.column("text"), block_rows=_ROWS):
                lang, score = predict(features(block.data, block.offsets), model)
                letters = (
                    batch.column("letters")
                    .slice(block.first, block.rows)
                    .to_numpy(zero_copy_only=False)
                    .astype(bool)
                )
                lang[~letters] = UNDETERMINED
                score[~letters] = 0
                yield pa.record_batch(
                    [
                        batch.column("doc_id").slice(block.first, block.rows),
                        pa.array(lang, pa.string()),
                        pa.array(score),
                    ],
                    names=["doc_id", "lang_pred", "score"],
                )

    return run


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for each row of ``docs``.

    Only whole texts are read. ``und`` with score 0 stands for a null text and for one
    without a letter (of any script), and for all if nothing could be learned. Repeated
    rows and null ids come back as often as they are there; an empty table gives an
    empty result.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    found = docs.select("doc_id", "text", letters.alias("letters")).mapInArrow(
        _identifier(model), f"doc_id {id_type}, lang_pred string, score double"
    )
    return found.select(
        "doc_id",
        labelled.held_out("doc_id", PARTS, HELD_OUT).alias("held_out"),
        "lang_pred",
        "score",
    )
