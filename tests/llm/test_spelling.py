"""Spelling variants against counting and comparing words one by one."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from sparkmart.llm import fm_index, queries, spelling

from . import frames

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def is_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def counted(docs):
    counts = Counter()
    for doc, text in docs:
        for run in RUN.findall(text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % 199 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def grouped(counts):
    near = {w: set() for w in counts}
    # All words that a deletion makes of two words, so that not every pair is compared.
    meet = {}
    for w in counts:
        for short in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            meet.setdefault(short, []).append(w)
    for group in meet.values():
        for a in group:
            near[a] |= {b for b in group if b not in near[a] and is_near(a, b)}
    forms = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best and counts[best] >= 5 * counts[w] else None

    def root(w):
        while forms[w]:
            w = forms[w]
        return w

    return sorted(
        (w, forms[w] or "", root(w), n, len(near[w]), counts.get(forms[w], 0))
        for w, n in counts.items()
    )


def got(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((r[0], r[1] or "", r[2], r[3], r[4], r[5] or 0) for r in df.collect())


@pytest.mark.parametrize("seed", range(12))
def test_index_equals_comparing_all(seed):
    rng = random.Random(seed)
    words = sorted(
        {
            "".join(rng.choice("abé") for _ in range(rng.randrange(1, 9)))
            for _ in range(rng.randrange(1, 160))
        }
    )
    rng.shuffle(words)
    asked = [*words, "zzzzzz", "abz"]
    index = fm_index.Bidirectional(words)
    for first in (True, False):
        found = [tuple(p) for p in index.one_error(asked, first).T.tolist()]

        def kept(q, w, first=first):
            h = len(q) // 2
            return w.startswith(q[:h]) if first else w.endswith(q[h:])

        assert sorted(found) == [
            (i, j)
            for i, q in enumerate(asked)
            for j, w in enumerate(words)
            if is_near(q, w) and kept(q, w)
        ]


def vocabulary(seed, n, letters="abcé"):
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randrange(6, 10))) for _ in range(n)}
    return {w: rng.choice([5, 5, 6, 25, 30, 125, 700, 4000]) for w in sorted(words)}


@pytest.mark.parametrize(("share", "most"), [(1 << 17, 1 << 20), (64, 50), (1000, 300)])
def test_groups_equal_comparing_all(spark, monkeypatch, share, most):
    """In one share, in many, and with keys that are cut into blocks."""
    monkeypatch.setattr(spelling, "SHARE", share)
    monkeypatch.setattr(spelling, "MOST", most)
    counts = vocabulary(4, 500)
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert got(spelling.variants(frame)) == grouped(counts)


def test_long_chains(spark):
    """Roots over many steps."""
    counts, word = {}, "aaaaaa"
    for k in range(12):
        counts[word] = 5 ** (k + 1)
        word += "b"
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    rows = got(spelling.variants(frame))
    assert rows == grouped(counts) and {r[2] for r in rows} == {"aaaaaa" + "b" * 11}


def test_windows_change_nothing(monkeypatch):
    text = "Abcdef ghijklmn, öäü×÷ opqrstuvwxyz. " * 20 + "a" * 50
    whole = RUN.findall(text)
    for size in (1, 2, 7, 31):
        monkeypatch.setattr(spelling, "WINDOW", size)
        windows = list(spelling._windows(text))
        assert "".join(windows) == text
        assert [w for window in windows for w in RUN.findall(window)] == whole


def test_odd_documents(spark):
    docs = frames.odd_documents(spark)
    more = frames.documents(
        spark,
        [(n, "Ünlängst ÜNLÄNGST abcdefg ABCDEFG abcdeſg " * 3, "de", "a") for n in range(400)],
    )
    both = frames.clashing(docs.union(more))
    rows = [(r.doc_id, r.text) for r in docs.union(more).collect()]
    found = spelling.variants(spelling.word_counts(both, spelling.SPOILT))
    assert got(found) == grouped(counted(rows))
    assert got(spelling.variants(spelling.word_counts(docs.limit(0)))) == []


def test_registered_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = got(queries.queries()["op11_spelling"](spark, sf_dir))
    assert found == grouped(counted([tuple(r) for r in docs]))
    assert sum(r[1] != "" for r in found) > 10
