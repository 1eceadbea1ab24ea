"""Benchmark decontamination by a prefix-filtered set join, in DataFrame operations.

A benchmark item is cut into windows of ``WINDOW`` words (a shorter item is one window).
Shingles are runs of ``SHINGLE`` words (of all words, in a shorter window).

1. One pass over the documents counts how often each shingle of the windows occurs, which
   orders the shingles by rarity.
2. A window that lies wholly in a document has all its shingles there, so its rarest one
   is a sufficient prefix. A second pass joins the documents with these prefixes alone;
   windows with a shingle that no document has are left out.
3. A place of a prefix gives the place of its window, which has to lie between the
   document's first and last word (length and position bounds).
4. There the document's words are compared with the window's, one by one.

Hashes of shingles only find candidates; words decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.tables import bounded, packed, stored

WINDOW, SHINGLE = 10, 3

# What parts words, and the letters that get lower case.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """The words of a text in order; none if it is null."""
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(lower, _BETWEEN), "")


def _shingle(words: Column, at: Column, n: int) -> Column:
    """A hash of the n words from ``at`` on; at the end of a text, of those that are left."""
    return F.xxhash64(F.lit(n), *(F.get(words, at + k) for k in range(n)))


def benchmark_windows(items: DataFrame, window: int, shingle: int) -> DataFrame:
    """(item_id, window, length, elements): the windows of all items.

    ``window`` are its words, joined by spaces; ``elements`` are its shingles in order.
    """
    words = items.select("item_id", words_of(F.col("text")).alias("words"))
    n = F.size("words")
    cut = F.transform(
        F.sequence(F.lit(0), F.greatest(n - window, F.lit(0))),
        lambda i: F.slice("words", i + 1, F.lit(window)),
    )
    length = F.size("cut")

    def runs(k: int) -> Column:
        firsts = F.sequence(F.lit(0), length - k)
        return F.transform(firsts, lambda i: _shingle(F.col("cut"), i, k))

    elements = F.when(length >= shingle, runs(shingle))
    for k in range(1, shingle):
        elements = elements.when(length == k, runs(k))
    return (
        words.where(n > 0)
        .select("item_id", F.explode(cut).alias("cut"))
        .select(
            "item_id",
            F.array_join("cut", " ").alias("window"),
            length.alias("length"),
            elements.alias("elements"),
        )
    )


def _runs(docs: DataFrame, sizes: list[int]) -> DataFrame:
    """(row, doc_id, text_hash, words, n_words, at, element): shingles in their places.

    Each row of ``docs`` also has a line with ``at`` and ``element`` null. ``row`` tells
    rows apart, also those that share an id; it holds within one run of a plan.
    """
    at = F.col("line") - 1
    elements = [_shingle(F.col("words"), at, n) for n in sizes]
    line = F.col("line") > 0
    # No lambdas here, so all this is compiled as one, up to the join that follows.
    lines = (
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.xxhash64("text").alias("text_hash"),
            words_of(F.col("text")).alias("words"),
        )
        .withColumn("n_words", F.size("words"))
        # Never empty; "outer" keeps Spark from filtering by its size, which would
        # split a text twice.
        .withColumn("all", F.concat(F.array(F.lit("")), "words"))
        .select(
            *("row", "doc_id", "text_hash", "words", "n_words"),
            F.posexplode_outer("all").alias("line", "word"),
        )
    )
    names = ["row", "doc_id", "text_hash", "words", "n_words", F.when(line, at).alias("at")]
    if len(elements) < 2:
        only = elements[0] if elements else F.lit(None).cast("bigint")
        return lines.select(*names, F.when(line, only).alias("element"))
    none = F.array(F.lit(None).cast("bigint"))
    each = F.when(line, F.array(*elements)).otherwise(none)
    return lines.select(*names, F.explode_outer(each).alias("element"))


def _prefixes(windows: DataFrame, runs: DataFrame) -> DataFrame:
    """(element, offset, length, window): each window's rarest shingle, and where it stands."""
    known = windows.select(F.explode("elements").alias("element")).distinct()
    often = (
        runs.where("at is not null")
        .select("element")
        .join(bounded(known), "element")
        .groupBy("element")
        .agg(F.count("*").alias("often"))
    )
    return (
        windows.select(
            "window", "length", F.size("elements").alias("n"), F.posexplode("elements")
        )
        .withColumnsRenamed({"pos": "offset", "col": "element"})
        .join(often, "element")
        .groupBy("window", "length", "n")
        .agg(
            F.count("*").alias("found"),
            F.min(F.struct("often", "element", "offset")).alias("least"),
        )
        .where("found = n")
        .select("least.element", "least.offset", "length", "window")
    )


def _occurrences(runs: DataFrame, prefixes: DataFrame, reach: int) -> DataFrame:
    """(row, doc_id, text_hash, n_words, start, length, window) of windows in the documents.

    A line with ``start`` null stands for each row of the documents.
    """
    names = ["row", "doc_id", "text_hash", "n_words"]
    first = F.greatest(F.col("at") - reach, F.lit(0))
    near = F.slice("words", first + 1, F.lit(2 * reach + 1))
    found = F.col("window").isNotNull()
    marked = bounded(prefixes)
    if marked is prefixes:
        # Shuffled: a line takes along only the words that a window could cover.
        runs = runs.select(*names, "at", "element", near.alias("words"))
        inside = F.col("start") - first
    else:
        inside = F.col("start")
    fits = F.col("at").isNull() | (
        (F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.col("n_words"))
    )
    same = F.array_join(F.slice("words", inside + 1, F.col("length")), " ") == F.col("window")
    return (
        runs.join(marked, "element", "left")
        .where(F.col("at").isNull() | found)
        .withColumn("start", F.col("at") - F.col("offset"))
        .where(fits)
        .where(F.col("at").isNull() | same)
        .select(
            *("row", "doc_id", "text_hash"),
            F.col("n_words").cast("bigint").alias("n_words"),
            *("start", "length", "window"),
        )
    )


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE
) -> DataFrame:
    """Each document's hits, one row for each.

    (doc_id, n_words, n_hit, n_items, items_sha256, contaminated, text_hash)

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are not
    read. A word is hit if it lies in any occurrence of a window; ``n_items`` counts the
    items with such windows.

    * null and empty texts have no words and are not hit; nor do such items hit;
    * rows that share a doc_id are told apart, each with its own text's result;
    * an item with a null item_id hits words but is not counted or named; one item_id
      with several texts is one item;
    * without documents the result is empty, without items nothing is hit.
    """
    cut = stored(benchmark_windows(items, window, shingle), "windows")
    windows = cut.select("window", "length", "elements").dropDuplicates(["window"])
    sizes = sorted(
        r[0]
        for r in windows.select(
            F.least(F.col("length"), F.lit(shingle)).alias("n")
        ).distinct().collect()
    )
    runs = _runs(docs, sizes)
    prefixes = stored(_prefixes(windows, runs), "prefixes")
    table = stored(_occurrences(runs, prefixes, window - 1), "occurrences")
    found = table.where("start is not null")

    # Words of overlapping occurrences count once.
    ends = F.max("end").over(
        Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    )
    hit = (
        found.groupBy("row", "start")
        .agg((F.col("start") + F.max("length")).alias("end"))
        .withColumn("before", F.coalesce(ends, F.lit(0)))
        .groupBy("row")
        .agg(
            F.sum(
                F.greatest(F.lit(0), F.col("end") - F.greatest("start", "before"))
            ).alias("n_hit")
        )
    )
    named = (
        found.select("row", "window")
        .join(
            bounded(cut.where("item_id is not null").select("window", "item_id").distinct()),
            "window",
        )
        .groupBy("row")
        .agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    )
    none = F.array().cast("array<string>")
    return (
        table.where("start is null")
        .join(hit, "row", "left")
        .join(named, "row", "left")
        .withColumn("items", F.coalesce("items", none))
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
            F.size("items").cast("bigint").alias("n_items"),
            F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
            "text_hash",
        )
    )


def clean_documents(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that no benchmark window hits, with all their columns.

    Columns may have any names. Rows with null, empty or blank texts stay, and all rows do
    without items; a repeated row goes or stays each time; an empty table gives none.
    """
    found = contamination(docs, items, **options).where("contaminated")
    hit = stored(
        found.select(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash")),
        "contaminated",
    )
    rows = docs.select(packed(docs), "doc_id", F.xxhash64("text").alias("hash"))
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("hash") == F.col("hit_hash"))
    return rows.join(bounded(hit), same, "left_anti").select("row.*")
