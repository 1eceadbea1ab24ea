"""Toxicity: a convolutional classifier over hashed words, with max pooling.

A word (a run of letters, digits and bytes beyond ASCII, in lower case by the rules of
Unicode) has two
embeddings, by hashes of the whole word and of its first ``STEM`` bytes. Filters over
one, two and three words in a row are max-pooled over the whole text and weighed. A
bucket answers only to the word (or stem) it was learned for, told by a second hash:
else a rare word of a long text would sooner or later land in a learned bucket.

The score's place of decision is calibrated by language, as told from the text alone:
log odds are shifted so that ``THRESHOLD`` is where that language's documents, of a part
that the filters do not learn from, are parted best.

All labelled documents that are not held out are learned from. Words are counted by an
aggregate. Filters are learned in rounds: documents are dealt out anew to shards, each
shard goes on from the same weights, and the mean of what they come to begins the next
round. Languages are told by the mean features of their documents, which are sums, and
places of decision come from counts by language and log odds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm import labelled, language_id, shingles, text_bytes
from sparkmart.llm.optimiser import Adam, sigmoid
from sparkmart.llm.tables import stored

THRESHOLD = 0.3
PARTS, HELD_OUT = 4, 2
STEM = 5
BUCKETS = 1 << 16
#: A word or stem gets a bucket if so many training documents hold it, and labels
#: depend on it by a likelihood-ratio statistic of so much (chance gives 2 in 10,000).
LEAST_DOCS, LEAST_RATIO = 3, 14.0
#: What a document that holds it adds to that statistic, at least: of many documents, also
#: words that merely go along with long texts pass the test.
LEAST_GAIN = 0.02
CALIBRATE = 5
SIZE, FILTERS, WIDTHS = 8, 8, (1, 2, 3)
EPOCHS, BATCH, RATE, DECAY = 12, 32, 1e-2, 1e-4
#: Few documents are gone through more often, for as many steps at least.
STEPS = 1200
ROUNDS = 6
#: Documents of a shard, which is larger if it would have too few of the rarer label.
SHARD, LEAST_RARE = 8192, 64
#: Steps of a log odd, and of weights and features where they are summed: whole numbers
#: add up to the same in any order.
PLACES, UNIT = 1000, 1 << 24
#: Documents of a language that its own place of decision is worth.
PRIOR_DOCS = 20
_ROWS = 512
_U = np.uint64


class Model(NamedTuple):
    #: For words and for stems: by bucket, the hash that it answers to (0: none).
    owners: tuple[np.ndarray, np.ndarray]
    weights: dict[str, np.ndarray]
    language: language_id.Model
    #: What is added to the log odds, by language; "" for any other.
    shift: dict[str, float]


def word_keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and of their stems (two columns), and words of each text."""
    whole, counts = shingles.word_hashes(data, offsets, shingles.NO_LETTER)
    start, stop = shingles.word_bounds(data, offsets, shingles.NO_LETTER)
    stem = np.minimum(stop - start, STEM).astype(np.uint64)
    low = np.append(data, np.zeros(STEM, np.uint8))
    for k in range(STEM):
        byte = low[start + k].astype(np.uint64)
        byte += np.where((byte >= 65) & (byte <= 90), _U(32), _U(0))
        stem = stem << _U(8) | np.where(k < stop - start, byte, _U(0))
    return np.stack([whole, shingles.mix(stem)], axis=1), counts


def _buckets(keys: np.ndarray, owners: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Bucket of each word and stem; 0 for those that were not learned."""
    out = np.zeros(keys.shape, np.int64)
    for k in range(2):
        at = (keys[:, k] % _U(BUCKETS)).astype(np.int64)
        out[:, k] = np.where(owners[k][at] == keys[:, k], at, 0)
    return out


def squeezed(ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of texts with no more unknown words in a row than any filter can tell.

    Behind ``max(WIDTHS)`` of them further ones bring no window that is not there already.
    """
    known = ids.any(axis=1)
    at = np.arange(len(ids))
    begin = np.concatenate([[0], np.cumsum(counts)])
    # Unknown words in a row up to here, counted from a known word or the text's begin.
    last = np.maximum.accumulate(np.where(known, at, -1)) if len(ids) else at
    run = at - np.maximum(last, np.repeat(begin[:-1], counts) - 1)
    kept = known | (run <= max(WIDTHS))
    total = np.concatenate([[0], np.cumsum(kept)])
    return ids[kept], np.diff(total[begin])


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of each label hold a word (kind 0) or stem (1), block by block."""
    for batch in batches:
        for block in text_bytes.blocks(batch.column("text"), block_rows=_ROWS):
            label = batch.column("label").slice(block.first, block.rows).to_numpy()
            keys, counts = word_keys(block.data, block.offsets)
            doc = np.repeat(np.arange(block.rows), counts)
            for kind in range(2):
                order = np.lexsort((doc, keys[:, kind]))
                key, of = keys[order, kind], doc[order]
                new = np.ones(len(key), bool)
                new[1:] = (key[1:] != key[:-1]) | (of[1:] != of[:-1])
                values, which = np.unique(key[new], return_inverse=True)
                toxic = np.bincount(which, label[of[new]] == 1, len(values)).astype(np.int64)
                docs = np.bincount(which, minlength=len(values))
                yield pa.record_batch(
                    [
                        pa.array(np.full(len(values), kind, np.int32)),
                        pa.array(values.view(np.int64)),
                        pa.array(docs - toxic),
                        pa.array(toxic),
                    ],
                    names=["kind", "key", "clean", "toxic"],
                )


def _owners(cases: DataFrame, clean: int, toxic: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the words that labels depend on, the one held most often owns a bucket."""
    held = (
        cases.mapInArrow(_held, "kind int, key long, clean long, toxic long")
        .groupBy("kind", "key")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .withColumn("n", F.col("clean") + F.col("toxic"))
        .where(F.col("n") >= LEAST_DOCS)
    )
    ratio = F.lit(0.0)
    for name, docs in (("clean", clean), ("toxic", toxic)):
        for both, of in (
            (F.col(name), F.col("n")),
            (F.lit(docs) - F.col(name), F.lit(clean + toxic) - F.col("n")),
        ):
            expected = of * F.lit(docs / (clean + toxic))
            ratio += F.when(both > 0, 2 * both * F.ln(both / expected)).otherwise(0.0)
    found = (
        held.where(ratio >= F.greatest(F.lit(LEAST_RATIO), LEAST_GAIN * F.col("n")))
        .groupBy("kind", F.col("key").bitwiseAND(BUCKETS - 1).alias("bucket"))
        .agg(F.max(F.struct("n", "key")).alias("most"))
        .where(F.col("bucket") > 0)
        .select("kind", "bucket", "most.key")
        .toArrow()
    )
    kind, bucket, key = (found[c].to_numpy() for c in found.column_names)
    owners = np.zeros(BUCKETS, np.uint64), np.zeros(BUCKETS, np.uint64)
    for k, owner in enumerate(owners):
        owner[bucket[kind == k]] = key[kind == k].view(np.uint64)
    return owners


def _convolve(e: np.ndarray, place: np.ndarray, w: dict[str, np.ndarray]) -> np.ndarray:
    """All filters at all words; a filter reaches over the zeros behind a text's end.

    At those zeros themselves the filters are 0, whatever text comes next.
    """
    banks = [bank for width in WIDTHS for bank in w[f"filters{width}"]]
    taps = np.zeros((len(e) + max(WIDTHS) - 1, len(banks) * FILTERS), np.float32)
    taps[: len(e)] = e @ np.concatenate(banks, axis=1)
    filtered = np.zeros((len(e), len(WIDTHS) * FILTERS), np.float32)
    at = 0
    for i, width in enumerate(WIDTHS):
        part = filtered[:, i * FILTERS : (i + 1) * FILTERS]
        for k in range(width):
            part += taps[k : len(e) + k, at : at + FILTERS]
            at += FILTERS
    held = np.zeros(len(e), bool)
    held[place] = True
    filtered[~held] = 0
    return filtered


def _pooled(ids: np.ndarray, counts: np.ndarray, w: dict[str, np.ndarray]) -> np.ndarray:
    """The largest value of each filter in each text.

    What a filter makes of a word is looked up in tables over all words and stems, so it is
    the same wherever the word stands, unlike in a product of all words of a block.
    """
    place, begin = _spaced(counts)
    reach = max(WIDTHS) - 1
    out = []
    for width in WIDTHS:
        values = np.zeros((begin[-1], FILTERS), np.float32)
        for k, bank in enumerate(w[f"filters{width}"]):
            tap = np.zeros((begin[-1] + reach, FILTERS), np.float32)
            tap[place] = (w["words"] @ bank[:SIZE])[ids[:, 0]]
            tap[place] += (w["stems"] @ bank[SIZE:])[ids[:, 1]]
            values += tap[k : k + len(values)]
        filtered = np.zeros_like(values)
        filtered[place] = values[place]
        out.append(np.maximum.reduceat(filtered, begin[:-1], axis=0))
    return np.concatenate(out, axis=1)


def _spaced(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words, and where texts begin, with zeros behind each text."""
    gap = max(WIDTHS) - 1
    begin = np.concatenate([[0], np.cumsum(counts + gap)])
    place = np.arange(counts.sum()) + np.repeat(np.arange(len(counts)) * gap, counts)
    return place, begin


def _embed(ids: np.ndarray, counts: np.ndarray, w: dict) -> tuple[np.ndarray, ...]:
    place, begin = _spaced(counts)
    e = np.zeros((begin[-1], 2 * SIZE), np.float32)
    e[place, :SIZE] = w["words"][ids[:, 0]]
    e[place, SIZE:] = w["stems"][ids[:, 1]]
    return e, place, begin


def log_odds(ids: np.ndarray, counts: np.ndarray, w: dict[str, np.ndarray]) -> np.ndarray:
    top = _pooled(ids, counts, w)
    return (np.tanh(top + w["bias"]) * w["score"]).sum(axis=1) + w["score_bias"][0]


def first_weights() -> dict[str, np.ndarray]:
    rng = np.random.default_rng(5)

    def normal(scale, *shape):
        return (scale * rng.standard_normal(shape)).astype(np.float32)

    n = FILTERS * len(WIDTHS)
    w = {
        "words": normal(0.02, BUCKETS, SIZE),
        "stems": normal(0.02, BUCKETS, SIZE),
        **{f"filters{k}": normal(0.4, k, 2 * SIZE, FILTERS) for k in WIDTHS},
        "bias": np.zeros(n, np.float32),
        "score": normal(0.3, n),
        "score_bias": np.zeros(1, np.float32),
    }
    w["words"][0] = w["stems"][0] = 0
    return w


def train_weights(
    w: dict[str, np.ndarray], docs: list[np.ndarray], y: np.ndarray, epochs: int, seed: int
) -> None:
    """Go on from ``w``, in place, with documents of both labels given as buckets.

    Each epoch takes every document of the more frequent label once and those of the other
    as often as it takes to have as many.
    """
    rng = np.random.default_rng(seed)
    n = FILTERS * len(WIDTHS)
    adam = Adam(w, RATE, DECAY)
    rare, often = sorted((np.flatnonzero(y == v) for v in (0, 1)), key=len)
    for _ in range(epochs):
        again = [rng.permutation(rare) for _ in range(-(-len(often) // len(rare)))]
        pairs = rng.permutation(often), np.concatenate(again)[: len(often)]
        order = np.stack(pairs, axis=1).ravel()
        for low in range(0, len(order), BATCH):
            chosen = order[low : low + BATCH]
            ids = np.concatenate([docs[d] for d in chosen])
            counts = np.array([len(docs[d]) for d in chosen])
            e, place, begin = _embed(ids, counts, w)
            conv = _convolve(e, place, w)
            held = np.zeros(len(e), bool)
            held[place] = True
            best = np.stack(
                [
                    a + conv[a:b].argmax(axis=0)
                    for a, b in zip(begin[:-1], begin[1:], strict=True)
                ]
            )
            top = np.tanh(conv[best, np.arange(n)] + w["bias"])
            d_logit = (sigmoid(top @ w["score"] + w["score_bias"][0]) - y[chosen]) / len(chosen)
            d_top = d_logit[:, None] * w["score"] * (1 - top**2)
            d_filter = d_top * held[best]
            slot = np.zeros((len(e), 2), np.int64)
            slot[place] = ids
            d_e = np.zeros_like(e)
            grads = {
                "bias": d_top.sum(axis=0),
                "score": top.T @ d_logit,
                "score_bias": d_logit.sum(keepdims=True),
            }
            for i, width in enumerate(WIDTHS):
                part = slice(i * FILTERS, (i + 1) * FILTERS)
                bank = np.zeros_like(w[f"filters{width}"])
                for k in range(width):
                    at = np.minimum(best[:, part] + k, len(e) - 1)
                    bank[k] = np.einsum("dfs,df->sf", e[at], d_filter[:, part])
                    np.add.at(
                        d_e, at, d_filter[:, part, None] * w[f"filters{width}"][k].T[None]
                    )
                grads[f"filters{width}"] = bank
            touched = np.unique(np.flatnonzero(d_e.any(axis=1)))
            rows = {}
            for k, name in enumerate(("words", "stems")):
                used, inverse = np.unique(slot[touched, k], return_inverse=True)
                g = np.zeros((len(used), SIZE), np.float32)
                np.add.at(g, inverse, d_e[touched, k * SIZE : (k + 1) * SIZE])
                g[used == 0] = 0
                rows[name], grads[name] = used, g
            adam.step(grads, rows)


def _best_place(odds: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> float:
    """The middle of the widest gap of those that leave the least errors; from counts."""
    if not len(odds):
        return 0.0
    values, which = np.unique(odds, return_inverse=True)
    toxic = np.bincount(which, toxic, len(values))
    clean = np.bincount(which, clean, len(values))
    # Errors if the place is below values[0], between two values, or above the last.
    wrong = np.append(0, np.cumsum(toxic)) + clean.sum() - np.append(0, np.cumsum(clean))
    ends = np.concatenate([[values[0] - 1], values, [values[-1] + 1]])
    gap = np.where(wrong == wrong.min(), np.diff(ends), -1).argmax()
    return float((ends[gap] + ends[gap + 1]) / 2)


def _encoder(owners: tuple[np.ndarray, np.ndarray]):
    """Each document as the buckets of its words, squeezed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in text_bytes.blocks(batch.column("text"), block_rows=_ROWS):
                keys, counts = word_keys(block.data, block.offsets)
                ids, counts = squeezed(_buckets(keys, owners), counts)
                ids, ends = ids.astype(np.uint16), np.cumsum(counts)
                words = [ids[e - c : e].tobytes() for e, c in zip(ends, counts, strict=True)]
                yield pa.record_batch(
                    [
                        batch.column("place").slice(block.first, block.rows),
                        batch.column("label").slice(block.first, block.rows),
                        pa.array(words, pa.binary()),
                    ],
                    names=["place", "label", "words"],
                )

    return run


def _sums(
    read: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[str, np.ndarray]]],
):
    """The sum of the arrays of each name that ``read`` makes of a task's batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for name, part in read(batches):
            total[name] = total[name] + part if name in total else part
        if total:
            yield pa.record_batch(
                [
                    pa.array(list(total), pa.string()),
                    pa.array([a.tobytes() for a in total.values()], pa.binary()),
                ],
                names=["name", "total"],
            )

    return run


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray]]:
    for batch in batches:
        for name, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            yield name, np.frombuffer(part, np.int64)


def _added(rows: DataFrame, read, tasks: int) -> dict[str, np.ndarray]:
    """All sums over ``rows``; ``tasks`` of them add up what the others have made."""
    schema = "name string, total binary"
    # Also what is one name is dealt out.
    sums = rows.mapInArrow(_sums(read), schema).repartition(tasks)
    total: dict[str, np.ndarray] = {}
    for name, part in _parts(sums.mapInArrow(_sums(_parts), schema).toArrow().to_batches()):
        total[name] = total[name] + part if name in total else part
    return total


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray]]:
    """By language the number of texts, and behind it the sums of their features."""
    for batch in batches:
        for block in text_bytes.blocks(batch.column("text"), block_rows=_ROWS):
            x = np.rint(language_id.features(block.data, block.offsets) * UNIT).astype(np.int64)
            x = np.concatenate([np.ones((block.rows, 1), np.int64), x], axis=1)
            langs = batch.column("lang").slice(block.first, block.rows)
            langs = langs.to_numpy(zero_copy_only=False)
            for lang in set(langs.tolist()):
                yield lang, x[langs == lang].sum(axis=0)


def _languages(cases: DataFrame) -> language_id.Model:
    """The language whose mean features are nearest, as one linear machine for each."""
    usable = cases.where(F.col("lang").isNotNull() & (F.octet_length("text") > 0))
    machines = {}
    for lang, total in sorted(_added(usable.select("lang", "text"), _features, 8).items()):
        mean = (total[1:] / total[0] / UNIT).astype(np.float32)
        machines[lang] = mean, -float(mean @ mean) / 2
    families = {lang: [lang] for lang in machines}
    return language_id.Model(families, machines if len(machines) > 1 else {}, {})


def _flat(w: dict[str, np.ndarray], used: dict[str, np.ndarray]) -> np.ndarray:
    """All weights in a row; of embeddings, those of buckets that have an owner."""
    return np.concatenate([(a[used[k]] if k in used else a).ravel() for k, a in w.items()])


def _unflat(flat: np.ndarray, used: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    w, at = first_weights(), 0
    for k, a in w.items():
        shape = (len(used[k]), SIZE) if k in used else a.shape
        part = flat[at : at + int(np.prod(shape))].reshape(shape).astype(np.float32)
        a[used[k] if k in used else slice(None)] = part
        at += part.size
    return w


def _round(flat: np.ndarray, used: dict[str, np.ndarray], docs_in_all: int, seed: int):
    """The weights that a shard comes to, times its documents, and the documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray]]:
        rows = sorted(
            row
            for batch in batches
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True)
        )
        y = np.array([label for _, label, _ in rows], np.float32)
        if len(set(y.tolist())) < 2:
            return  # other rounds deal these documents to other shards
        docs = [np.frombuffer(words, np.uint16).reshape(-1, 2) for *_, words in rows]
        w = _unflat(flat, used)
        # As many steps as if one shard went through all of few documents.
        epochs = max(EPOCHS, -(-STEPS * BATCH // min(docs_in_all, 2 * len(docs))))
        train_weights(w, docs, y, -(-epochs // ROUNDS), seed)
        whole = np.rint(_flat(w, used).astype(np.float64) * UNIT).astype(np.int64)
        yield "weights", np.append(whole * len(docs), len(docs))

    return run


def _weights(
    cases: DataFrame, owners: tuple[np.ndarray, np.ndarray], docs: tuple[int, int]
) -> dict[str, np.ndarray]:
    encoded = cases.mapInArrow(_encoder(owners), "place long, label int, words binary")
    encoded = stored(encoded, "toxicity_words")
    used = dict(zip(("words", "stems"), map(np.flatnonzero, owners), strict=True))
    flat = _flat(first_weights(), used).astype(np.float64)
    shards = max(1, min(-(-sum(docs) // SHARD), min(docs) // LEAST_RARE))
    for k in range(ROUNDS):
        dealt = encoded.repartition(shards, F.xxhash64("place", F.lit(k)))
        made = _added(dealt, _round(flat, used, sum(docs), k), min(shards, 8))
        if made:
            flat = made["weights"][:-1] / (made["weights"][-1] * float(UNIT))
    return _unflat(flat, used)


def _odds(block: text_bytes.Block, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Log odds without shift, and languages."""
    keys, counts = word_keys(block.data, block.offsets)
    odds = log_odds(*squeezed(_buckets(keys, model.owners), counts), model.weights)
    x = language_id.features(block.data, block.offsets)
    return odds.astype(np.float64), language_id.predict(x, model.language)[0]


def _placer(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in text_bytes.blocks(batch.column("text"), block_rows=_ROWS):
                odds, lang = _odds(block, model)
                yield pa.record_batch(
                    [
                        batch.column("label").slice(block.first, block.rows),
                        pa.array(lang, pa.string()),
                        pa.array(np.rint(odds * PLACES).astype(np.int64)),
                    ],
                    names=["label", "lang", "odds"],
                )

    return run


def _shifts(cases: DataFrame, model: Model) -> dict[str, float]:
    """What parts each language's documents best, from their counts by log odds."""
    counts = (
        cases.mapInArrow(_placer(model), "label int, lang string, odds long")
        .groupBy("lang", "odds")
        .agg(
            F.count(F.when(F.col("label") == 1, 1)).alias("toxic"),
            F.count(F.when(F.col("label") == 0, 1)).alias("clean"),
        )
        .toArrow()
    )
    lang = np.array(counts["lang"].to_pylist(), object)
    odds = counts["odds"].to_numpy() / PLACES
    toxic, clean = (counts[c].to_numpy() for c in ("toxic", "clean"))
    at = float(np.log(THRESHOLD / (1 - THRESHOLD)))
    common = _best_place(odds, toxic, clean)
    shift = {"": at - common}
    for name in sorted(set(lang.tolist())):
        own = lang == name
        place = _best_place(odds[own], toxic[own], clean[own])
        docs = (toxic[own] + clean[own]).sum()
        share = docs / (docs + PRIOR_DOCS)
        shift[name] = at - float(share * place + (1 - share) * common)
    return shift


def _lowered(docs: DataFrame) -> DataFrame:
    return docs.withColumn("text", F.lower("text"))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from all labelled documents that are not held out, whatever their length.

    One in ``CALIBRATE`` of them, by a hash of its id, is not learned from but calibrates.
    Without documents of both labels every score is the labels' share.
    """
    rows = labelled.rows(_lowered(docs), labels, "toxic", PARTS, HELD_OUT)
    cases = stored(rows, "toxicity_cases")
    aside = F.pmod(F.xxhash64("place"), F.lit(CALIBRATE)) == 0
    learned, calibrating = cases.where(~aside), cases.where(aside)
    of = {r.label: r["count"] for r in learned.groupBy("label").count().collect()}
    clean, toxic = of.get(0, 0), of.get(1, 0)
    shares = labelled.shares(labels, "toxic", PARTS, HELD_OUT)
    prior = np.float32(np.log((shares[1] + 1) / (shares[0] + 1)))
    nothing = np.zeros(BUCKETS, np.uint64)
    model = Model((nothing, nothing), first_weights(), language_id.Model({}, {}, {}), {"": 0.0})
    if not (clean and toxic):
        model.weights["score"][:] = 0
        model.weights["score_bias"] += prior
        return model
    owners = _owners(learned, clean, toxic)
    weights = _weights(learned, owners, (clean, toxic))
    weights["score_bias"] += prior
    model = model._replace(owners=owners, weights=weights, language=_languages(cases))
    return model._replace(shift=_shifts(calibrating, model))


def _scores(block: text_bytes.Block, model: Model) -> np.ndarray:
    odds, lang = _odds(block, model)
    shift = [model.shift.get(x, model.shift[""]) for x in lang.tolist()]
    return sigmoid(odds + shift)


def _scorer(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in text_bytes.blocks(batch.column("text"), block_rows=_ROWS):
                yield pa.record_batch(
                    [
                        batch.column("doc_id").slice(block.first, block.rows),
                        pa.array(_scores(block, model)),
                    ],
                    names=["doc_id", "score"],
                )

    return run


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``.

    The score (0 to 1) rises with the chance of label 1. Only texts are read. A null or
    empty text is one without words and scored as such; repeated rows and null ids come
    back as often as they are there; an empty table gives an empty result.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    scored = _lowered(docs).select("doc_id", "text").mapInArrow(
        _scorer(model), f"doc_id {id_type}, score double"
    )
    return scored.select(
        "doc_id",
        labelled.held_out("doc_id", PARTS, HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
