"""Near duplicates by bottom-k sketches: documents whose word-shingle sets overlap.

One hash function gives each distinct shingle a 64-bit value; a document's sketch
is its ``SKETCH`` smallest values.

1. Documents with equal sets (equal size and 128-bit digest) become one.
2. Inverted lists of retained values give the overlaps. A document stays a
   candidate only if enough of its sketch is retained by others too.
3. A pair with similarity s shares none of its ``INDEXED`` smallest values with
   probability (1 - s)^INDEXED at most, below 4e-7 for s = 0.75. So the lists of
   those values alone make the groups that are compared. Lists with the same
   members are compared once.
4. Within a group, the sketch of a pair's union filters: up to the lower of the two
   sketches' largest values, all values of both sets are known, at least as many as a
   sketch holds, and the share of them that both sets have estimates the similarity.
   Full sets confirm. A list too large for a task is dealt out in blocks, each pair of
   blocks to a task. Only edges that span what is connected leave a task, never all
   pairs of a group.

``MARGIN`` standard deviations below the expected overlap is where filters on
sketches cut (a chance of some 1e-7 for a pair at the threshold).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm import grouping, shingles, text_bytes
from sparkmart.llm.components import components
from sparkmart.llm.tables import bounded, packed, stored

WORDS = 5
SIMILARITY = (75, 100)
SKETCH = 32
INDEXED = 11
MARGIN = 5.0
#: Set elements (8 bytes each) and documents of one side of a comparison.
BLOCK_ELEMENTS, BLOCK_DOCS = 1 << 19, 1 << 10
_COLUMNS = 1024


def _enough(sizes, sketch: int, similarity: float):
    """Sketch values that a pair at the threshold shares, less the margin."""
    m = np.minimum(sizes, sketch)
    spread = MARGIN * np.sqrt(m * similarity * (1 - similarity))
    return np.maximum(1, np.floor(m * similarity - spread)).astype(np.int64)


def _sketches(words: int, sketch: int):
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_shingles", pa.int64()),
            ("digest_a", pa.int64()),
            ("digest_b", pa.int64()),
            ("sketch", pa.list_(pa.int64())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in text_bytes.blocks(batch.column("text")):
                keys, sizes = shingles.shingle_sets(block.data, block.offsets, words)
                ends = np.cumsum(sizes)
                sums = [np.zeros(len(keys) + 1, np.uint64) for _ in range(2)]
                np.cumsum(keys, out=sums[0][1:])
                np.cumsum(shingles.mix(keys ^ np.uint64(words)), out=sums[1][1:])
                row = np.repeat(np.arange(len(sizes)), sizes)
                rank = np.arange(len(keys)) - np.repeat(ends - sizes, sizes)
                kept = keys[rank < sketch].view(np.int64)
                held = np.bincount(row[rank < sketch], minlength=len(sizes))
                yield pa.record_batch(
                    [
                        batch.column("doc_id").slice(block.first, block.rows),
                        pa.array(sizes.astype(np.int64)),
                        *(
                            pa.array((s[ends] - s[ends - sizes]).view(np.int64))
                            for s in sums
                        ),
                        pa.ListArray.from_arrays(
                            pa.array(
                                np.concatenate([[0], np.cumsum(held)]).astype(np.int32)
                            ),
                            pa.array(kept),
                        ),
                    ],
                    schema=schema,
                )

    return run


def _full_sets(words: int):
    schema = pa.schema([("doc_id", pa.int64()), ("items", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in text_bytes.blocks(batch.column("text")):
                keys, sizes = shingles.shingle_sets(block.data, block.offsets, words)
                yield pa.record_batch(
                    [
                        batch.column("doc_id").slice(block.first, block.rows),
                        pa.ListArray.from_arrays(
                            pa.array(
                                np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                            ),
                            pa.array(keys.view(np.int64)),
                        ),
                    ],
                    schema=schema,
                )

    return run


def _intersections(items: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
    """Sizes of the intersections of all sets given as (item, owner) entries."""
    _, item, times = np.unique(items, return_inverse=True, return_counts=True)
    shared = times > 1
    column = (np.cumsum(shared) - 1)[item]
    entry = shared[item]
    column, owner = column[entry], owner[entry]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    total = np.zeros((rows, rows), np.float32)
    for low in range(0, int(shared.sum()), _COLUMNS):
        a, b = np.searchsorted(column, [low, low + _COLUMNS])
        width = min(_COLUMNS, int(shared.sum()) - low)
        present = np.zeros((rows, width), np.float32)
        present[owner[a:b], column[a:b] - low] = 1
        total += present @ present.T
    return total


def _union_estimate(
    sketches: list[np.ndarray], whole: np.ndarray, overlap: np.ndarray
) -> np.ndarray:
    """How many values of each pair's union are known: those up to where both sketches reach.

    ``whole``: which sketches hold all of their set, and so reach to the end.
    """
    reach = np.array([s[-1] if len(s) else 0 for s in sketches], np.uint64)
    reach[whole] = ~np.uint64(0)
    known = np.empty((len(sketches), len(sketches)), np.float32)
    for row, values in enumerate(sketches):
        known[row] = np.searchsorted(values, reach, "right")
    return known + known.T - overlap


def _group_links(
    items: np.ndarray, bounds: np.ndarray, sketch: int, similarity: tuple[int, int]
) -> tuple[np.ndarray, np.ndarray]:
    """Edges (row, lower row) that span the linked sets of one group."""
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    rank = np.arange(len(items)) - bounds[:-1][owner]
    low = rank < sketch
    overlap = _intersections(items[low], owner[low], len(sizes))
    values = items.view(np.uint64)
    sketches = [values[a : min(b, a + sketch)] for a, b in zip(bounds, bounds[1:], strict=False)]
    union = _union_estimate(sketches, sizes <= sketch, overlap)
    near = similarity[0] / similarity[1]
    spread = MARGIN * np.sqrt(union * near * (1 - near))
    maybe = (overlap > 0) & (overlap >= np.floor(union * near - spread))
    del overlap, union, spread
    np.fill_diagonal(maybe, False)
    rows = np.flatnonzero(maybe.any(axis=1))
    if not len(rows):
        return rows, rows
    place = np.full(len(sizes), -1)
    place[rows] = np.arange(len(rows))
    entry = place[owner] >= 0
    both = _intersections(items[entry], place[owner[entry]], len(rows))
    linked, own = maybe[np.ix_(rows, rows)], sizes[rows]
    for low in range(0, len(rows), 256):
        part = slice(low, low + 256)
        shared = both[part].astype(np.int64)
        union = own[part, None] + own[None, :] - shared
        linked[part] &= similarity[1] * shared >= similarity[0] * union
    first = grouping.local_components(linked)
    moved = first != np.arange(len(rows))
    return rows[moved], rows[first[moved]]


def _links(sketch: int, similarity: tuple[int, int]):
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouping.by_key(batches, "group"):
            ids = group.column("doc_id").to_numpy()
            items, bounds = grouping.lists(group.column("items"))
            # Stored sorted as unsigned numbers, so a set's first values are its sketch.
            u, v = _group_links(items.view(np.uint64), bounds, sketch, similarity)
            if len(u):
                yield pa.record_batch([pa.array(ids[u]), pa.array(ids[v])], schema=schema)

    return run


def _comparison_groups(
    reps: DataFrame, sketch: int, indexed: int, similarity: float
) -> DataFrame:
    """(group, doc_id): the documents that are compared with each other."""
    retained = reps.select(
        "doc_id", "n_shingles", F.posexplode("sketch").alias("rank", "value")
    )
    shared = retained.groupBy("value").agg(F.count("*").alias("holders"))
    overlaps = retained.join(shared.where("holders > 1"), "value")
    # A partner may be smaller by the similarity, and then has a smaller sketch.
    partner = F.least(F.floor(F.col("n_shingles") * similarity), F.lit(sketch))
    spread = F.sqrt(partner * (similarity * (1 - similarity))) * MARGIN
    enough = F.greatest(F.lit(1), F.floor(partner * similarity - spread))
    able = (
        overlaps.groupBy("doc_id", "n_shingles")
        .agg(
            F.count("*").alias("n_shared"),
            F.collect_list(F.when(F.col("rank") < indexed, F.col("value"))).alias("values"),
        )
        .where(F.col("n_shared") >= enough)
    )
    member = able.select("doc_id", "n_shingles", F.explode("values").alias("value"))
    sized = (
        member.groupBy("value")
        .agg(
            F.count("*").alias("members"),
            F.sum("n_shingles").alias("elements"),
            F.sum(F.xxhash64("doc_id").cast("decimal(20,0)")).alias("who"),
            F.expr("bit_xor(xxhash64(doc_id, 1))").alias("who_too"),
        )
        .where("members > 1")
        .groupBy("members", "elements", "who", "who_too")
        .agg(F.min("value").alias("value"))
        .select(
            "value",
            F.greatest(
                F.ceil(F.col("elements") / BLOCK_ELEMENTS),
                F.ceil(F.col("members") / BLOCK_DOCS),
            )
            .cast("int")
            .alias("blocks"),
        )
    )
    own = F.expr("cast(pmod(xxhash64(doc_id, value), blocks) as int)")
    other = F.explode(
        F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(
            F.filter(
                F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: b != F.col("own")
            )
        )
    )
    return (
        member.join(sized, "value")
        .withColumn("own", own)
        .withColumn("other", other)
        .select(
            F.xxhash64(
                "value", F.least("own", "other"), F.greatest("own", "other")
            ).alias("group"),
            "doc_id",
        )
    )


def near_duplicates(
    docs: DataFrame,
    words: int = WORDS,
    similarity: tuple[int, int] = SIMILARITY,
    sketch: int = SKETCH,
    indexed: int = INDEXED,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs``.

    ``docs`` has doc_id BIGINT and text; other columns are not read. Two documents
    are linked if their sets' similarity is at least ``similarity`` (a fraction);
    a component is named by its smallest doc_id, whose row is kept.

    * null or empty text, or only white space: no shingles, linked with nothing;
    * rows that repeat a doc_id count as one document with all their texts' links,
      and each of them is returned;
    * null doc_id: linked with nothing, component_id null, kept;
    * an empty table gives an empty result.
    """
    share = similarity[0] / similarity[1]
    every = stored(
        docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
            _sketches(words, sketch),
            "doc_id long, n_shingles long, digest_a long, digest_b long, "
            "sketch array<long>",
        ),
        "sketches",
    )
    digest = ["n_shingles", "digest_a", "digest_b"]
    named = every.where("doc_id is not null and n_shingles > 0")
    reps = stored(
        named.groupBy(*digest).agg(
            F.min("doc_id").alias("doc_id"), F.first("sketch").alias("sketch")
        ),
        "sets",
    )
    groups = stored(_comparison_groups(reps, sketch, indexed, share), "groups")
    sets = (
        docs.select(F.col("doc_id").cast("bigint"), "text")
        .join(groups.select("doc_id").distinct().hint("merge"), "doc_id", "left_semi")
        .mapInArrow(_full_sets(words), "doc_id long, items array<long>")
    )
    compared = groups.join(sets, "doc_id").select("group", "doc_id", "items")
    edges = (
        compared.repartition("group")
        .sortWithinPartitions("group")
        .mapInArrow(_links(sketch, similarity), "u long, v long")
    )
    # An id whose rows differ stands for several sets, which it links.
    twice = named.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    same_id = (
        named.join(twice, "doc_id")
        .join(reps.select(*digest, F.col("doc_id").alias("rep")), digest)
        .select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
    )
    label = components(edges.union(same_id))
    classes = (
        reps.select(*digest, "doc_id")
        .join(label, F.col("doc_id") == F.col("vertex"), "left")
        .select(*digest, F.coalesce("component", "doc_id").alias("class"))
    )
    component = F.when(
        F.col("doc_id").isNotNull(), F.coalesce(F.col("class"), F.col("doc_id"))
    )
    return (
        every.drop("sketch")
        .join(classes, digest, "left")
        .select(
            "doc_id",
            "n_shingles",
            component.alias("component_id"),
            F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        )
    )


def first_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each group of near duplicates, and all its columns.

    Of rows that share the kept id one stays; rows without an id all stay, and so do all
    rows of null, empty or blank texts that have an id of their own. Columns may have any
    names; an empty table gives an empty result.
    """
    found = stored(near_duplicates(docs, **options).select("doc_id", "kept"), "kept")
    rest = found.where(~F.col("kept")).select("doc_id").distinct()
    twice = stored(
        found.where("kept and doc_id is not null")
        .groupBy("doc_id")
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .select("doc_id"),
        "repeated",
    )
    rows = docs.select(packed(docs), "doc_id")
    stay = rows.join(bounded(rest), "doc_id", "left_anti")
    once = stay.join(bounded(twice), "doc_id", "left_anti")
    repeated = stay.join(bounded(twice), "doc_id", "left_semi")
    return once.unionByName(repeated.dropDuplicates(["doc_id"])).select("row.*")
