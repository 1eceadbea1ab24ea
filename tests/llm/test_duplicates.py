"""Near duplicates, embeddings, components and decontamination against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkmart.llm import components, decontamination, embedding_dedup, minhash_dedup

from . import frames


def joined(vertices, links):
    label = {v: v for v in vertices}

    def find(v):
        while label[v] != v:
            v = label[v]
        return v

    for a, b in links:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return {v: find(v) for v in vertices}


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(i, i + 1) for i in range(60)] + [
        (rng.randint(100, 300), rng.randint(100, 300)) for _ in range(120)
    ]
    got = components.components(spark.createDataFrame(links, "u long, v long"))
    want = joined({v for link in links for v in link}, links)
    loops = {a for a, b in links if a == b}
    found = {r.vertex: r.component for r in got.collect()}
    assert {v: c for v, c in want.items() if v in found} == found
    assert set(want) - set(found) <= loops


def test_no_edges(spark):
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def shingle_set(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def edited(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def near_copies(seed=4):
    rng = random.Random(seed)
    texts = []
    for _ in range(12):
        base = [f"b{rng.randrange(3000)}" for _ in range(rng.randint(30, 150))]
        texts += [edited(rng, base, rng.randint(0, 6)) for _ in range(12)]
    texts += [" ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randint(1, 60))) for _ in range(60)]
    texts += ["a b c d e f g h i j k l", "A b c d e f g h i j k l", "a b c", "a  b\tc", "a b"]
    return texts


def brute_components(texts):
    sets = {i: shingle_set(t) for i, t in texts.items()}
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b
        and sets[a]
        and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    return joined(sets, links), sets


@pytest.mark.parametrize("block", [1 << 19, 400])
def test_near_duplicates(spark, monkeypatch, block):
    monkeypatch.setattr(minhash_dedup, "BLOCK_ELEMENTS", block)
    texts = dict(enumerate(near_copies()))
    docs = frames.documents(spark, [(i, t, "en", "a") for i, t in texts.items()])
    want, sets = brute_components(texts)
    got = minhash_dedup.near_duplicates(frames.clashing(docs)).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.n_shingles == len(sets[r.doc_id]) for r in got)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert len(set(want.values())) < len(texts) - 40


def test_near_duplicates_of_odd_documents(spark):
    docs = frames.odd_documents(spark)
    got = frames.rows(minhash_dedup.near_duplicates(docs))
    assert len(got) == 12
    by_id = {}
    for doc_id, n, component, kept in got:
        by_id.setdefault(doc_id, []).append((n, component, kept))
    assert by_id[1] == [(0, 1, True)] and by_id[3] == [(0, 3, True)]
    assert by_id[5] == [(2, 5, True)] * 2 and by_id[6] == [(2, 5, False)]
    assert all(c is None and kept for _, c, kept in by_id[None])
    assert {c for _, c, _ in by_id[7]} == {7}
    once = minhash_dedup.first_documents(frames.clashing(docs))
    assert sorted(r.doc_id or -1 for r in once.collect()) == [-1, -1, 1, 2, 3, 4, 5, 7, 8]
    assert minhash_dedup.near_duplicates(docs.limit(0)).count() == 0


def test_union_sketches_estimate_the_similarity():
    """The known part of a union is that of its smallest values, and holds a sketch at least."""
    rng = np.random.default_rng(6)
    base = rng.integers(0, 2**63, 400, dtype=np.uint64) * np.uint64(2)
    sets = [np.unique(rng.choice(base, n, replace=False)) for n in (3, 20, 32, 33, 200, 390, 390)]
    k = minhash_dedup.SKETCH
    sketches = [s[:k] for s in sets]
    overlap = np.array([[len(np.intersect1d(a, b)) for b in sketches] for a in sketches])
    union = minhash_dedup._union_estimate(sketches, np.array([len(s) <= k for s in sets]), overlap)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            both = np.union1d(a, b)
            n = int(union[i, j])
            assert n >= min(k, len(both))
            smallest = both[:n]
            known = np.isin(smallest, a) & np.isin(smallest, b)
            assert known.sum() == overlap[i, j]
    assert overlap[5, 6] / union[5, 6] == pytest.approx(0.95, abs=0.05)


def vectors(seed=3):
    rng = np.random.default_rng(seed)
    out = [rng.normal(size=32) for _ in range(150)]
    for k in range(20):
        out += [out[k] + rng.normal(size=32) * 0.08 * (j % 5) for j in range(8)]
    out += [out[0] * 2, out[0].copy(), out[0].copy()]
    return [v.astype(np.float32).astype(float) for v in out]


@pytest.mark.parametrize("block", [2048, 5])
def test_embeddings(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    x = np.stack(vectors())
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    want = joined(range(len(x)), [(int(a), int(b)) for a, b in zip(*np.nonzero(linked))])
    got = embedding_dedup.near_duplicates(frames.clashing(df)).collect()
    counts = {r.vec_id: r.n_links for r in got}
    assert counts == {i: linked[i].sum() for i in range(len(x))}
    assert {r.vec_id: r.component_id for r in got} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_no_pair_at_the_threshold_is_missed(spark):
    rng = np.random.default_rng(8)
    one, other = (rng.normal(size=(4000, 64)) for _ in range(2))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    other -= (other * one).sum(axis=1, keepdims=True) * one
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    near = 0.9002 * one + (1 - 0.9002**2) ** 0.5 * other
    rows = list(enumerate(np.stack([one, near], axis=1).reshape(-1, 64).tolist()))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = embedding_dedup.near_duplicates(df).collect()
    assert len(got) == 8000
    assert all(r.n_links == 1 and r.component_id == r.vec_id // 2 * 2 for r in got)


def test_colliding_keys_of_other_sizes(spark, monkeypatch):
    """Vectors of two sizes in one bucket are compared by size; no link is lost."""
    hashed = embedding_dedup.Hashes.keys
    monkeypatch.setattr(
        embedding_dedup.Hashes, "keys", lambda self, x, tables=None: hashed(self, x, tables) * 0
    )
    x = [[1.0, 0.0], [1.0, 0.1], [0.0, 1.0], [1.0, 0.0, 0.0], [1.0, 0.1, 0.0], [0.0, 0.0, 1.0]]
    df = spark.createDataFrame(list(enumerate(x)), "vec_id long, embedding array<double>")
    got = embedding_dedup.near_duplicates(df).collect()
    assert {r.vec_id: r.component_id for r in got} == {0: 0, 1: 0, 2: 2, 3: 3, 4: 3, 5: 5}


def test_directions_of_a_table_do_not_depend_on_what_is_asked():
    own = embedding_dedup.Plan(5, 40)
    x = np.random.default_rng(0).standard_normal((30, 16))
    whole = embedding_dedup.Hashes(own).keys(x)
    for tables in (1, 7, 39):
        assert (embedding_dedup.Hashes(own).keys(x, tables) == whole[:, :tables]).all()


def test_odd_embeddings(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None),
        (2, []),
        (3, [0.0, 0.0]),
        (4, [1.0, None]),
        (5, [nan, 1.0]),
        (6, [inf, 1.0]),
        (7, [1.0, 0.0]),
        (8, [1.0, 0.0]),
        (9, [2.0, 0.1]),
        (10, [1.0, 0.0, 0.0]),
        (None, [1.0, 0.0]),
        (11, [1e300, 0.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(df).collect()}
    assert all(got[i] == (0, i, True) for i in (1, 2, 3, 4, 5, 6, 10))
    assert [got[i] for i in (7, 8, 9, 11)] == [(3, 7, i == 7) for i in (7, 8, 9, 11)]
    assert got[None] == (0, None, True)
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_tables_follow_from_the_threshold():
    made = embedding_dedup.plan(10**6)
    near = embedding_dedup.collision((2 - 2 * 0.9) ** 0.5)
    assert (1 - near**made.projections) ** made.tables <= embedding_dedup.MISS
    assert embedding_dedup.plan(10**9).projections > made.projections


def brute_contamination(docs, items):
    import re

    def words(text):
        lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)

    out = []
    for doc_id, text in docs:
        w = words(text)
        hit, found = set(), set()
        for item_id, passage in items:
            p = words(passage)
            n = min(10, len(p))
            for window in {tuple(p[i : i + n]) for i in range(len(p) - n + 1)} if p else ():
                for i in range(len(w) - n + 1):
                    if tuple(w[i : i + n]) == window:
                        hit.update(range(i, i + n))
                        found.add(item_id)
        out.append((doc_id, len(w), len(hit), len({i for i in found if i is not None}), bool(hit)))
    return sorted(out, key=repr)


def passages():
    rng = random.Random(9)
    some = [f"k{i}" for i in range(12)]
    text = lambda n: " ".join(rng.choice(some) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 3, 4, 9, 10, 11, 25]))) for i in range(12)]
    items += [(20, None), (21, ""), (22, "..."), (None, text(14)), (3, text(12)), (4, items[5][1])]
    docs = [(i, text(rng.randint(0, 60))) for i in range(60)]
    docs += [(100 + i, f"{text(5)} {p.upper()}! {text(5)}") for i, (_, p) in enumerate(items[:8])]
    docs += [(1, None), (1, items[7][1]), (None, items[6][1] + " x"), (2, "")]
    return docs, items


def contaminated(spark, docs, items):
    got = decontamination.contamination(
        frames.clashing(spark.createDataFrame(docs, "doc_id long, text string")),
        frames.clashing(spark.createDataFrame(items, "item_id long, text string")),
    )
    return frames.rows(got.select("doc_id", "n_words", "n_hit", "n_items", "contaminated"))


def test_contamination(spark):
    docs, items = passages()
    assert contaminated(spark, docs, items) == brute_contamination(docs, items)


def test_contamination_shuffled(spark, monkeypatch):
    """More prefixes than may be broadcast."""
    docs, items = passages()
    monkeypatch.setattr(decontamination, "bounded", lambda df: df)
    assert contaminated(spark, docs, items) == brute_contamination(docs, items)


def test_words_decide_contamination(spark, monkeypatch):
    """Hashes that often collide change nothing."""
    docs, items = passages()
    exact = decontamination._shingle
    monkeypatch.setattr(
        decontamination, "_shingle", lambda words, at, n: F.pmod(exact(words, at, n), F.lit(3))
    )
    assert contaminated(spark, docs, items) == brute_contamination(docs, items)


def test_only_the_rarest_shingle_is_joined(spark):
    docs = spark.createDataFrame(
        [(1, "a b c d a b c d b c d x y z"), (2, "b c d e f")], "doc_id long, text string"
    )
    items = spark.createDataFrame([(1, "a b c d b"), (2, "b c d e f g")], "item_id long, text string")
    windows = decontamination.benchmark_windows(items, 10, 3).drop("item_id")
    runs = decontamination._runs(docs, [3])
    got = decontamination._prefixes(windows, runs)
    # "b c d" is in both items, "c d b" occurs once, and no document has "e f g".
    assert [tuple(r) for r in got.drop("element").collect()] == [(2, 5, "a b c d b")]
    joined = decontamination._occurrences(runs, got, 9).where("start is not null")
    assert [tuple(r) for r in joined.select("doc_id", "start").collect()] == [(1, 4)]


def test_contamination_without_rows(spark):
    docs = frames.odd_documents(spark)
    items = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    none = decontamination.contamination(docs, items.limit(0))
    assert none.count() == 12 and none.where("contaminated").count() == 0
    assert decontamination.contamination(docs.limit(0), items).count() == 0
    clean = decontamination.clean_documents(frames.clashing(docs), items)
    assert clean.where(F.col("text").contains("one two")).count() == 0
    assert clean.count() == 8
