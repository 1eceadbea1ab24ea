"""Language, quality and toxicity: held-out accuracy, and odd inputs."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkmart.llm import labelled, language_id, quality_mil, toxicity_cnn
from sparkmart.llm.tables import table

from . import frames

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF_DIR, "documents")


@pytest.fixture(scope="module")
def labels(spark):
    return table(spark, SF_DIR, "labels")


def accuracy(scored, truth, found, wanted):
    both = scored.where("held_out").join(truth, "doc_id").where(F.col(wanted).isNotNull())
    right = F.avg((F.col(found) == F.col(wanted)).cast("double"))
    return both.agg(right).first()[0]


def scores_hold(df, rows):
    got = df.collect()
    assert len(got) == rows
    assert all(0 <= r.score <= 1 for r in got)
    return got


def test_language(spark, docs):
    model = language_id.fit(docs)
    found = language_id.identify(docs, model)
    assert accuracy(found, docs.select("doc_id", "lang"), "lang_pred", "lang") > 0.97
    got = scores_hold(language_id.identify(frames.clashing(frames.odd_documents(spark)), model), 12)
    und = {r.doc_id for r in got if r.lang_pred == "und"}
    assert {1, 2, 3} <= und and 4 not in und and 8 not in und
    assert sum(r.lang_pred == "und" for r in got if r.doc_id == 7) == 1
    assert language_id.identify(docs.limit(0), model).count() == 0
    nothing = language_id.fit(docs.limit(0))
    assert {r.lang_pred for r in language_id.identify(docs.limit(5), nothing).collect()} == {"und"}


def test_families_and_pairs():
    rng = np.random.default_rng(1)
    langs = np.array(["en", "de", "fr", "es", "xx"] * 40, object)
    x = rng.normal(size=(200, 20)).astype(np.float32) * 0.1
    for k, lang in enumerate(("en", "de", "fr", "es", "xx")):
        x[langs == lang, k] += 1
    model = language_id.Model(*language_id.train(x, langs))
    assert model.families == {"germanic": ["de", "en"], "romance": ["es", "fr"], "xx": ["xx"]}
    found, score = language_id.predict(x, model)
    assert (found == langs).all() and (score > 0.5).all()


def test_quality(spark, docs, labels):
    model = quality_mil.fit(docs, labels)
    found = quality_mil.score(docs, model)
    assert accuracy(found, labels, "predicted", "quality") > 0.95
    odd = frames.clashing(frames.odd_documents(spark))
    got = scores_hold(quality_mil.score(odd, model), 12)
    kept = quality_mil.accepted(odd, model)
    assert kept.columns == odd.columns
    assert kept.count() == sum(r.predicted for r in got)
    assert quality_mil.score(docs.limit(0), model).count() == 0
    assert quality_mil.accepted(docs.limit(0), model).count() == 0


def test_quality_without_labels(spark, docs, labels):
    model = quality_mil.fit(docs.limit(20), labels.limit(0))
    scores_hold(quality_mil.score(docs.limit(20), model), 20)


def test_attention_finds_the_passage_that_decides():
    rng = np.random.default_rng(2)
    counts = rng.integers(1, 12, 400)
    x = (rng.normal(size=(counts.sum(), quality_mil.FEATURES)) * 0.1).astype(np.float32)
    y = rng.integers(0, 2, 400).astype(np.float32)
    begin = np.concatenate([[0], np.cumsum(counts)])
    for d in np.flatnonzero(y == 0):
        x[rng.integers(begin[d], begin[d + 1]), :5] += 1.5
    model = quality_mil.Model(*quality_mil.train(x[: begin[300]], counts[:300], y[:300]), 0.0)
    found = quality_mil.log_odds(x[begin[300] :], counts[300:], model) > 0
    assert (found == (y[300:] == 1)).mean() > 0.9


def test_toxicity(spark, docs, labels):
    model = toxicity_cnn.fit(docs, labels)
    found = toxicity_cnn.score(docs, model)
    assert accuracy(found, labels, "predicted", "toxic") > 0.9
    odd = frames.clashing(frames.odd_documents(spark))
    got = scores_hold(toxicity_cnn.score(odd, model), 12)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1
    assert toxicity_cnn.score(docs.limit(0), model).count() == 0


def test_toxicity_of_capitals(spark, docs, labels):
    """Accented capitals are the same letters."""
    model = toxicity_cnn.fit(docs, labels)
    french = docs.where("lang = 'fr'")
    got = [
        {r.doc_id: r.score for r in toxicity_cnn.score(french.withColumn("text", f), model).collect()}
        for f in (F.upper("text"), F.lower(F.upper("text")))
    ]
    assert got[0] == got[1] and len(got[0]) > 100


def test_toxicity_without_labels(spark, docs, labels):
    model = toxicity_cnn.fit(docs.limit(20), labels.limit(0))
    scores_hold(toxicity_cnn.score(docs.limit(20), model), 20)


def test_held_out_goes_by_crc32(spark):
    import zlib

    ids = spark.range(200).select("id", labelled.held_out("id", 4, 2).alias("out"))
    assert all(r.out == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in ids.collect())
    none = spark.sql("select cast(null as bigint) as id")
    assert none.select(labelled.held_out("id", 4, 2)).first()[0] is False


def blocks_of(texts):
    data = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64)
    return np.frombuffer(b"".join(data), np.uint8), offsets


TEXTS = [
    "gamma gamma delta",
    "x",
    "",
    " ",
    "ab ab ab a a",
    "one two two",
    "é é à ab\nab",
    "no end",
    "word " * 300,
    "a" * 1000 + " " + "a" * 999,
]


def test_a_text_scores_alike_alone_and_behind_any_other():
    whole, counts = quality_mil.passage_features(*blocks_of(TEXTS))
    bounds = np.concatenate([[0], np.cumsum(counts)])
    for k, text in enumerate(TEXTS):
        alone, _ = quality_mil.passage_features(*blocks_of([text]))
        assert (alone == whole[bounds[k] : bounds[k + 1]]).all(), text
        for before in TEXTS:
            both, n = quality_mil.passage_features(*blocks_of([before, text]))
            assert (both[n[0] :] == alone).all(), (before, text)
    for make in (language_id.features, lambda d, o: toxicity_cnn.word_keys(d, o)[0]):
        parts = [make(*blocks_of([t])) for t in TEXTS]
        assert (np.concatenate(parts) == make(*blocks_of(TEXTS))).all()


def test_repeated_words_are_counted_one_by_one():
    got, _ = quality_mil.passage_features(*blocks_of(TEXTS[:8]))
    for features, text in zip(got, TEXTS, strict=False):
        words = [w.encode() for w in text.split()]
        same = sum(
            len(a) == len(b) and a[:3] == b[:3] for a, b in zip(words, words[1:], strict=False)
        )
        assert features[-1] == pytest.approx((same / max(1, len(words))) ** 0.5)


def test_attention_equals_a_loop_over_passages(spark, docs, labels):
    model = quality_mil.fit(docs, labels)
    texts = [r.text or "" for r in docs.select("text").limit(30).collect()] + TEXTS
    x, counts = quality_mil.passage_features(*blocks_of(texts))
    got = quality_mil.log_odds(x, counts, model)
    w = {k: v.astype(float) for k, v in model.weights.items()}
    at = 0
    for k, n in enumerate(counts):
        states, energies = [], []
        for row in x[at : at + n].astype(float):
            h = np.tanh((row - model.mean) * model.scale @ w["encode"] + w["encode_bias"])
            gate = 1 / (1 + np.exp(-(h @ w["gate"])))
            states.append(h)
            energies.append(np.exp((np.tanh(h @ w["attend"]) * gate) @ w["weigh"]))
        z = sum(e * h for e, h in zip(energies, states, strict=True)) / sum(energies)
        assert got[k] == pytest.approx(z @ w["score"] + w["score_bias"][0] + model.prior, abs=1e-2)
        at += n


def test_votes_equal_a_loop_over_pairs(spark, docs):
    model = language_id.fit(docs)
    texts = [r.text or "" for r in docs.select("text").limit(60).collect()]
    x = language_id.features(*blocks_of(texts))
    found, _ = language_id.predict(x, model)
    for row, lang in zip(x, found, strict=True):
        family = max(model.by_family, key=lambda f: row @ model.by_family[f][0] + model.by_family[f][1])
        votes = dict.fromkeys(model.families[family], 0.0)
        for (a, b), (weights, bias) in model.by_pair.items():
            if a in votes:
                votes[a if row @ weights + bias > 0 else b] += 1
        assert votes[lang] == max(votes.values())


def test_convolution_equals_a_loop_over_windows(spark, docs, labels):
    rng = np.random.default_rng(2)
    counts = np.array([1, 7, 3, 40])
    w = {
        "words": rng.standard_normal((toxicity_cnn.BUCKETS, toxicity_cnn.SIZE)),
        "stems": rng.standard_normal((toxicity_cnn.BUCKETS, toxicity_cnn.SIZE)),
        "bias": rng.standard_normal(toxicity_cnn.FILTERS * len(toxicity_cnn.WIDTHS)),
        "score": rng.standard_normal(toxicity_cnn.FILTERS * len(toxicity_cnn.WIDTHS)),
        "score_bias": np.array([0.3]),
    }
    for k in toxicity_cnn.WIDTHS:
        w[f"filters{k}"] = rng.standard_normal((k, 2 * toxicity_cnn.SIZE, toxicity_cnn.FILTERS))
    ids = rng.integers(0, toxicity_cnn.BUCKETS, (counts.sum(), 2))
    got = toxicity_cnn.log_odds(ids, counts, w)
    at = 0
    for k, n in enumerate(counts):
        words = [np.concatenate([w["words"][a], w["stems"][b]]) for a, b in ids[at : at + n]]
        words += [np.zeros(2 * toxicity_cnn.SIZE)] * (max(toxicity_cnn.WIDTHS) - 1)
        top = []
        for width in toxicity_cnn.WIDTHS:
            bank = w[f"filters{width}"]
            values = [
                sum(words[i + j] @ bank[j] for j in range(width)) for i in range(n)
            ]
            # Behind the last word a filter is 0.
            top.append(np.max([*values, 0 * values[0]], axis=0))
        top = np.tanh(np.concatenate(top) + w["bias"])
        assert got[k] == pytest.approx(top @ w["score"] + 0.3, abs=1e-3)
        at += n


def test_every_language_is_learned(spark, monkeypatch):
    """250 languages, each with a word of its own, the rarest with one document."""
    monkeypatch.setattr(language_id, "SAMPLE", 600)
    rows = []
    for k in range(250):
        word = f"{chr(97 + k % 26)}{chr(97 + k // 26)}q"
        rows += [(len(rows) + j, f"{word} " * 30, f"l{k}", "s") for j in range(8 if k else 300)]
    docs = frames.documents(spark, rows)
    model = language_id.fit(docs)
    kept = docs.where(~labelled.held_out("doc_id", 4, 2))
    assert len(model.families) == kept.select("lang").distinct().count() == 250
    found = language_id.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
    assert found.where("lang_pred = lang").count() > 0.97 * len(rows)


def test_a_repeated_id_is_one_row_of_the_sample(spark):
    rows = [(1, "t", "en", "a")] * 500 + [(k, f"t{k}", "en", "a") for k in range(2, 60)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)] * 3, "doc_id long, toxic int")
    taken = labelled.sample(frames.documents(spark, rows), labels, "toxic", 4, 2, 1000)
    texts = [r.text for r in taken.collect()]
    assert len(texts) == len(set(texts))


def toxicity_docs(spark, texts):
    docs = frames.documents(spark, [(k, text, "en", "s") for k, (text, _) in enumerate(texts)])
    labels = [(k, label) for k, (_, label) in enumerate(texts)]
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_is_learned_from_every_document(spark):
    """200 words, each in 40 of 8,000 toxic documents: a share of those would not tell."""
    texts = [(f"some w{k // 40}q text", 1) for k in range(8000)]
    texts += [(f"some v{k // 40}q text", 0) for k in range(8000)]
    docs, labels = toxicity_docs(spark, texts)
    model = toxicity_cnn.fit(docs, labels)
    keys, counts = toxicity_cnn.word_keys(*blocks_of([f"w{k}q" for k in range(200)]))
    assert (counts == 1).all()
    assert np.isin(keys[:, 0], model.owners[0]).sum() >= 198  # two may share a bucket
    found = toxicity_cnn.score(docs, model).where("held_out").join(labels, "doc_id")
    assert found.where("predicted != toxic").count() <= 0.01 * found.count()
    again = toxicity_cnn.fit(docs.repartition(5), labels)
    assert again.shift == model.shift
    assert all((again.weights[k] == w).all() for k, w in model.weights.items())


def test_toxicity_is_learned_from_long_documents(spark):
    long = "quite harmless text goes on " * 2500
    texts = [(f"{long} zorgon {k}", 1) for k in range(60)]
    texts += [(f"quite harmless text goes on {k}", 0) for k in range(90)]
    docs, labels = toxicity_docs(spark, texts)
    model = toxicity_cnn.fit(docs, labels)
    probe = frames.documents(spark, [(1, "zorgon", "en", "s"), (2, "harmless text", "en", "s")])
    assert {r.doc_id: r.predicted for r in toxicity_cnn.score(probe, model).collect()} == {1: 1, 2: 0}


def test_squeezed_texts_score_alike_alone_and_among_others():
    rng = np.random.default_rng(4)
    w = {k: rng.standard_normal(a.shape).astype(np.float32) for k, a in toxicity_cnn.first_weights().items()}
    w["words"][0] = w["stems"][0] = 0
    counts = np.array([0, 1, 2, 3, 4, 9, 0, 200, 40, 1])
    ids = rng.integers(1, toxicity_cnn.BUCKETS, (counts.sum(), 2)) * (rng.random((counts.sum(), 1)) < 0.2)
    got = toxicity_cnn.log_odds(ids, counts, w)
    few, n = toxicity_cnn.squeezed(ids, counts)
    assert len(few) < len(ids) and (toxicity_cnn.log_odds(few, n, w) == got).all()
    ends = np.cumsum(counts)
    alone = [toxicity_cnn.log_odds(ids[e - c : e], np.array([c]), w)[0] for c, e in zip(counts, ends)]
    assert (np.array(alone) == got).all()
