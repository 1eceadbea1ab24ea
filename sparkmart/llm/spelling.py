"""Groups of spelling variants: words one error apart, found in FM-indexes.

Of two words that differ by one letter put in, left out or replaced, the first half of one
is the beginning of the other, or its second half the other's end. So words are dealt out
twice, by their first three letters and by their last three (words have six or more), and
each share of the vocabulary gets a bidirectional FM-index: the one search matches first
halves exactly and extends to the right with one error, the other second halves to the left. A
pair that both can find is left to the first.

A share's index has a bounded number of letters: keys are gathered in shares of ``SHARE``
letters by a hash, and a key with more than ``MOST`` letters is cut into blocks of words; those
of each block are looked up in the index of each.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm import grouping
from sparkmart.llm.fm_index import Bidirectional
from sparkmart.llm.tables import bounded, stored

# The rules of the contract.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LEAST_LETTERS, LEAST_TIMES, TIMES_OF_FORM, SPOILT = 6, 5, 5, 199

#: Letters by which words are dealt out; at most half of the shortest word.
KEY = LEAST_LETTERS // 2
#: Letters in a share of the vocabulary, and in one block of a hot key.
SHARE, MOST = 1 << 17, 1 << 20
#: Characters of a text that are split at a time, and words a task counts before it passes them on.
WINDOW, HELD = 1 << 20, 400_000


def _windows(text: str) -> Iterator[str]:
    """The text in pieces that cut no run of letters."""
    at = 0
    while at < len(text):
        end = min(at + WINDOW, len(text))
        while end < len(text) and (run := RUN.match(text, end)):
            end = run.end()
        yield text[at:end]
        at = end


def _counter(spoilt: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def taken() -> pa.RecordBatch:
            out = pa.record_batch(
                [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())],
                names=["word", "n"],
            )
            counts.clear()
            return out

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                doc, text = doc.as_py(), text.as_py() or ""
                lead = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for window in _windows(text):
                    # Bytes know only the capitals A to Z.
                    lowered = window.encode().lower().decode()
                    for word, n in Counter(RUN.findall(lowered)).items():
                        if spoilt and (h := zlib.crc32(word.encode(), lead)) % spoilt == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                        if len(word) >= LEAST_LETTERS:
                            counts[word] += n
                    if len(counts) >= HELD:
                        yield taken()
        yield taken()

    return run


def word_counts(docs: DataFrame, spoilt: int | None = None) -> DataFrame:
    """(word, n): the words of six or more letters and how often they occur, five times at least.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, with A-Z in lower case. With
    ``spoilt``, a word loses a letter wherever that number divides the checksum of document
    and word, as the contract plants errors. Null and empty texts have no words; a null
    doc_id is written as nothing in a checksum; repeated rows count each time; an empty
    table gives no words. Texts are split in windows, so a long one takes little memory.
    """
    return (
        docs.select("doc_id", "text")
        .mapInArrow(_counter(spoilt), "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= LEAST_TIMES)
    )


def _searcher(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each share: what each of its queries is near to among its texts."""
    for table in grouping.by_key(batches, "share", least=1):
        words, counts = table["word"].to_pylist(), table["n"].to_numpy()
        first, text = (table[c].to_numpy() for c in ("first", "is_text"))
        for side in (True, False):
            texts = np.flatnonzero(text & (first == side))
            queries = np.flatnonzero(~text & (first == side))
            if not len(texts) or not len(queries):
                continue
            index = Bidirectional([words[i] for i in texts])
            query, near = index.one_error([words[i] for i in queries], side)
            query, near = queries[query], texts[near]
            if not side:
                by_first = [
                    words[v].startswith(words[q][: len(words[q]) // 2])
                    for q, v in zip(query, near, strict=True)
                ]
                query, near = query[~np.array(by_first, bool)], near[~np.array(by_first, bool)]
            # Of each query: how many, and the most frequent (ties: the least word).
            places = {i: k for k, i in enumerate(sorted(set(near.tolist()), key=words.__getitem__))}
            alphabetic = np.fromiter((places[i] for i in near.tolist()), np.int64, len(near))
            order = np.lexsort((alphabetic, -counts[near], query))
            query, near = query[order], near[order]
            own, at, n_near = np.unique(query, return_index=True, return_counts=True)
            best = near[at]
            yield pa.record_batch(
                [
                    pa.array([words[i] for i in own], pa.string()),
                    pa.array(n_near, pa.int64()),
                    pa.array([words[i] for i in best], pa.string()),
                    pa.array(counts[best], pa.int64()),
                ],
                names=["word", "n_near", "best", "best_n"],
            )


def _shares(words: DataFrame) -> tuple[DataFrame, int]:
    """(share, first, is_text, word, n): each word as a text and as a query, by both keys.

    Also how many tasks they are for; a few megabytes may be much work.
    """
    size = F.char_length("word") + 1
    sides = words.select(
        "word",
        "n",
        size.alias("size"),
        F.explode(
            F.array(
                F.struct(F.lit(True).alias("first"), F.substring("word", 1, KEY).alias("key")),
                F.struct(F.lit(False).alias("first"), F.substring("word", -KEY, KEY).alias("key")),
            )
        ).alias("side"),
    ).select("word", "n", "size", "side.first", "side.key")
    letters = words.agg(F.sum(size)).first()[0] or 0
    hot = (
        sides.groupBy("first", "key")
        .agg(F.sum("size").alias("letters"))
        .where(F.col("letters") > MOST)
        .select("first", "key", F.ceil(F.col("letters") / MOST).alias("blocks"))
    )
    dealt = sides.join(bounded(hot), ["first", "key"], "left")
    # A key's place; each pair of blocks of a hot one is a share of its own.
    shares = 2 * letters // SHARE + 1
    place = F.pmod(F.xxhash64("first", "key"), F.lit(shares))
    blocks = F.coalesce("blocks", F.lit(1))
    share = F.when(blocks == 1, place).otherwise(
        F.xxhash64("first", "key", "text_block", "query_block")
    )
    own = F.pmod(F.xxhash64("word"), blocks)
    every = F.explode(F.sequence(F.lit(0), blocks - 1))
    kept = ["first", "key", "word", "n", "blocks"]
    texts = dealt.select(
        *kept, own.alias("text_block"), every.alias("query_block"), F.lit(True).alias("is_text")
    )
    queries = dealt.select(
        *kept, every.alias("text_block"), own.alias("query_block"), F.lit(False).alias("is_text")
    )
    dealt = texts.union(queries.select(*texts.columns)).select(
        share.alias("share"), "first", "is_text", "word", "n"
    )
    return dealt, shares


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): each round doubles the steps that are followed."""
    roots = forms.select("word", F.col("form").alias("root"))
    while True:
        further = roots.select(F.col("word").alias("via"), F.col("root").alias("next"))
        roots = stored(
            roots.join(further, F.col("root") == F.col("via"), "left").select(
                "word",
                F.coalesce("next", "root").alias("root"),
                F.col("next").isNotNull().alias("moved"),
            ),
            "roots",
        )
        if roots.where("moved").isEmpty():
            return roots.drop("moved")
        roots = roots.drop("moved")


def variants(words: DataFrame, ratio: int = TIMES_OF_FORM) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for distinct words (word, n) of six letters or more.

    ``n_near`` counts the words that differ by exactly one letter put in, left out or
    replaced; ``form`` is the most frequent of them (ties: the least by code points) if it
    occurs at least ``ratio`` times as often, else null; ``root`` is where the forms lead
    in the end, the word itself if it has none. An empty table gives no rows. Each
    form is more frequent than its word, so forms have no circles.
    """
    words = stored(words.select("word", "n"), "words")
    shares, tasks = _shares(words)
    near = (
        shares.repartition(tasks, "share")
        .sortWithinPartitions("share")
        .mapInArrow(_searcher, "word string, n_near long, best string, best_n long")
        .groupBy("word")
        .agg(
            F.sum("n_near").alias("n_near"),
            F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("best"),
        )
    )
    enough = -F.col("best.less") >= F.col("n") * ratio
    found = stored(
        words.join(near, "word", "left").select(
            "word",
            F.when(enough, F.col("best.best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(enough, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(found.where("form is not null"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
