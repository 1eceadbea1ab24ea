"""Mixing, and the stages of the pipeline against brute force."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sparkmart.llm import mixing, quality_mil
from sparkmart.llm.tables import table

from . import frames
from .test_duplicates import brute_components, brute_contamination
from .test_text_operators import base_spans

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("local", [100_000, 0])
def test_raking_meets_the_marginals(spark, monkeypatch, local):
    monkeypatch.setattr(mixing, "LOCAL_CELLS", local)
    rows = [
        (s, g, t, (i * 7919 + j * 104729 + k * 1299709) % 1000 + 1)
        for i, s in enumerate("abc")
        for j, g in enumerate(("en", "fr"))
        for k, t in enumerate(("x", "y", "z"))
    ]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")
    targets = {"source": {"a": 1, "b": 2, "c": 1}, "lang": 0.0, "topic": 0.5}
    got = mixing.rake(cells, targets, rounds=12).collect()
    sums = defaultdict(float)
    tokens = defaultdict(int)
    for r in got:
        for by in targets:
            sums[r[by]] += r.weight
            tokens[r[by]] += r.tokens
    assert sum(r.weight for r in got) == pytest.approx(1)
    assert [sums[s] for s in "abc"] == pytest.approx([0.25, 0.5, 0.25], abs=1e-4)
    assert sums["en"] == pytest.approx(0.5, abs=1e-4)
    roots = {t: tokens[t] ** 0.5 for t in "xyz"}
    for t in "xyz":
        assert sums[t] == pytest.approx(roots[t] / sum(roots.values()), abs=1e-4)


def test_raking_goes_on_until_the_marginals_are_met(spark):
    """Nearly monolingual sources: eight rounds leave a share 29 % off."""
    rows = []
    for k in range(12):
        size, home = 110_000 if k == 0 else 20_000, ("fr", "de")[k - 10] if k > 9 else "en"
        rows += [
            (f"s{k}", g, "prose", size if g == home else size // 2000) for g in ("en", "fr", "de")
        ]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")
    got = mixing.rake(cells, mixing.TARGETS).collect()
    for by, power in mixing.TARGETS.items():
        sums, tokens = defaultdict(float), defaultdict(int)
        for r in got:
            sums[r[by]] += r.weight
            tokens[r[by]] += r.tokens
        whole = sum(n**power for n in tokens.values())
        for value, n in tokens.items():
            assert sums[value] == pytest.approx(n**power / whole, rel=1e-5)


def test_targets_that_contradict_each_other_are_reported(spark):
    rows = [("a", "en", "x", 10), ("b", "fr", "x", 10)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")
    with pytest.warns(UserWarning, match="can't all be met"):
        got = mixing.rake(cells, {"source": {"a": 1, "b": 3}, "lang": {"en": 1, "fr": 1}})
    assert all(r.miss > 0.3 for r in got.collect())


def test_budget_is_met(spark):
    docs = table(spark, SF_DIR, "documents")
    mixed = mixing.calibrated(docs, budget=0.6)
    total, expected = mixed.agg(
        F.sum("_mix_tokens"), F.sum(F.col("_mix_tokens") * F.col("_mix_probability"))
    ).first()
    assert expected / total == pytest.approx(0.6, abs=0.01)
    assert mixed.agg(F.max("_mix_probability")).first()[0] <= 1


def test_kept_shares_meet_the_targets(spark):
    """Many cells are full at this budget; Spanish has too few tokens for its share."""
    docs = table(spark, SF_DIR, "documents")
    mixed = mixing.calibrated(docs).select(
        *(f"_mix_{by}" for by in mixing.TARGETS), "_mix_tokens", "_mix_probability"
    ).collect()
    total = sum(r._mix_tokens for r in mixed)
    budget = mixing.BUDGET * total
    assert max(r._mix_probability for r in mixed) == pytest.approx(1)
    for by, power in mixing.TARGETS.items():
        seen, kept = defaultdict(int), defaultdict(float)
        for r in mixed:
            seen[r[f"_mix_{by}"]] += r._mix_tokens
            kept[r[f"_mix_{by}"]] += r._mix_tokens * r._mix_probability
        part = {v: n**power for v, n in seen.items() if n}
        short, before = set(), None
        while short != before:
            before = set(short)
            rest = budget - sum(seen[v] for v in short)
            whole = sum(x for v, x in part.items() if v not in short)
            short |= {v for v, x in part.items() if rest * x / whole > seen[v]}
        assert ("es" in short) == (by == "lang") and (by == "lang" or not short)
        for value, x in part.items():
            want = seen[value] if value in short else rest * x / whole
            assert kept[value] == pytest.approx(want, rel=1e-5)


def test_mixing_odd_documents(spark):
    docs = frames.clashing(frames.odd_documents(spark))
    got = mixing.calibrated(docs)
    assert got.count() == 12
    assert got.where("_mix_tokens = 0 and _mix_kept").count() == 0
    kept = mixing.sample(docs, budget=1.0)
    assert set(kept.columns) == set(docs.columns)
    assert kept.count() == 9
    assert mixing.sample(docs, {"source": {"a": 1.0}}).where("source = 'b'").count() == 0
    assert mixing.sample(docs.limit(0)).count() == 0


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_stages(spark):
    """Each stage on all that the one before it kept, over whole tables."""
    docs = table(spark, SF_DIR, "documents")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_duplicates", "decontaminate", "secrets", "mix"]

    def step(name, before):
        after = corpus_pipeline.stored(stages[name](spark, before, SF_DIR), f"test-{name}")
        assert after.columns[: len(columns)] == columns
        return after

    good = step("quality", docs)
    model = quality_mil.fit(docs, table(spark, SF_DIR, "labels"))
    want = {r.doc_id for r in quality_mil.score(docs, model).collect() if r.score >= 0.5}
    assert set(texts(good)) == want and good.columns == columns

    single = step("near_duplicates", good)
    label, _ = brute_components(texts(good))
    assert set(texts(single)) == set(label.values()) and single.columns == columns

    clean = step("decontaminate", single)
    items = [(r.item_id, r.text) for r in table(spark, SF_DIR, "benchmark").collect()]
    hit = {i for i, *_, bad in brute_contamination(sorted(texts(single).items()), items) if bad}
    assert hit and set(texts(clean)) == set(texts(single)) - hit and clean.columns == columns

    safe = step("secrets", clean)
    before, after = texts(clean), texts(safe)
    assert set(before) == set(after) and safe.columns == columns
    masked = 0
    for doc_id, text in before.items():
        spans, out, at = base_spans(text), [], 0
        for start, _, end in spans:
            if start >= at:
                out += [text[at:start], "[SECRET]"]
            at = max(at, end)
        assert after[doc_id] == "".join([*out, text[at:]])
        masked += bool(spans)
    assert masked

    mixed = step("mix", safe)
    assert mixed.columns == [*columns, "probability"]
    chance = {
        r.doc_id: r._mix_probability for r in mixing.calibrated(safe).collect()
    }
    drawn = {
        i
        for i, p in chance.items()
        if int(hashlib.md5(f"mix:{i}".encode()).hexdigest()[:8], 16) / 2**32 < p
    }
    assert set(texts(mixed)) == drawn

    whole = corpus_pipeline.run(spark, SF_DIR)
    assert frames.rows(whole) == frames.rows(mixed)


def test_stages_take_odd_documents(spark, tmp_path):
    folder = str(tmp_path)
    docs = frames.odd_documents(spark)
    labels = spark.createDataFrame(
        [(i, i % 2, 0) for i in range(1, 9)] + [(None, 1, 0), (5, None, None)],
        "doc_id long, quality int, toxic int",
    )
    labels.write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(
        [(1, "one two three four five six"), (2, None)], "item_id long, text string"
    ).write.parquet(f"{folder}/benchmark.parquet")
    for given in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, given, folder)
            assert out.count() <= given.count(), name
