"""Near duplicates of embeddings: Euclidean p-stable hashing, then exact cosines.

Equal vectors become one, with a number of copies. A normalised vector is projected on
random normal directions, each projection shifted by a random offset and quantised to
steps of ``STEP``; some projections together are a bucket, in several tables.
Vectors that share a bucket are compared by their exact cosine.

The number of projections is that of least cost: more of them make smaller buckets, but
call for more tables, and each table sends every vector once more. It grows with the
logarithm of the vectors, so a bucket holds a bounded number of unrelated ones. The number of
tables follows from it, so that a pair at the threshold is missed with a chance of
``MISS`` at most, a closer one with a smaller chance.

Buckets with the same members are compared once. A bucket too large for a task is dealt
out in blocks, each pair of blocks to a task. A pair is counted in the first table where
it shares a bucket. Tasks return link counts and edges that span what is connected, not
pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm import grouping, shingles
from sparkmart.llm.components import components
from sparkmart.llm.tables import stored

COSINE = 0.9
STEP = 2.0
MISS = 1e-6
#: Comparisons that take as long as sending a vector to one more bucket.
SENDING = 1024
#: Vectors of one side of a comparison, and projections made of them at a time.
BLOCK, PROJECTIONS = 2048, 1024


class Plan(NamedTuple):
    projections: int
    tables: int

    def directions(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Random directions and offsets for vectors of one size, always the same."""
        rng = np.random.default_rng([29, size])
        n = self.projections * self.tables
        return rng.standard_normal((n, size)).T, rng.uniform(0, STEP, n)


class Hashes:
    """Bucket keys of vectors; a task draws the directions once for each size in a row."""

    def __init__(self, own: Plan):
        self.own, self.size = own, None

    def keys(self, x: np.ndarray, tables: int | None = None) -> np.ndarray:
        """A 64-bit key for each vector (row) and each of the first ``tables`` (column)."""
        if x.shape[1] != self.size:
            self.size = x.shape[1]
            self.directions, self.offsets = self.own.directions(self.size)
        tables, k = self.own.tables if tables is None else tables, self.own.projections
        key = np.full((len(x), tables), self.size, np.uint64)
        some = max(1, PROJECTIONS // k)
        for low in range(0, tables, some):
            to = min(low + some, tables)
            at = slice(low * k, to * k)
            steps = np.floor((x @ self.directions[:, at] + self.offsets[at]) / STEP)
            steps = steps.astype(np.int64).view(np.uint64).reshape(len(x), to - low, k)
            for j in range(k):
                key[:, low:to] = shingles.mix(key[:, low:to] + steps[:, :, j])
        return key


def collision(distance: float) -> float:
    """Chance that two points so far apart fall into one step of a projection."""
    t = STEP / distance
    tail = math.erfc(t / math.sqrt(2))
    return 1 - tail - 2 / (math.sqrt(2 * math.pi) * t) * (1 - math.exp(-t * t / 2))


def plan(vectors: int, cosine: float = COSINE) -> Plan:
    near = collision(math.sqrt(2 - 2 * cosine))
    apart = collision(math.sqrt(2))

    def tables(k: int) -> int:
        return math.ceil(math.log(MISS) / math.log1p(-(near**k)))

    k = min(range(1, 64), key=lambda k: tables(k) * (SENDING + vectors * apart**k))
    return Plan(k, tables(k))


def _unit(values: np.ndarray, size: int) -> np.ndarray:
    x = values.reshape(-1, size).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _hasher(own: Plan):
    schema = pa.schema([("rep", pa.int64()), ("buckets", pa.list_(pa.int64()))])
    hashes = Hashes(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(first, BLOCK)
                values, bounds = grouping.lists(batch.column("embedding"))
                reps, sizes = batch.column("rep").to_numpy(), np.diff(bounds)
                for size in np.unique(sizes).tolist():
                    rows = np.flatnonzero(sizes == size)
                    x = np.stack([values[bounds[r] : bounds[r + 1]] for r in rows])
                    keys = hashes.keys(_unit(x, size)).view(np.int64)
                    lists = pa.ListArray.from_arrays(
                        pa.array(np.arange(len(rows) + 1) * own.tables, pa.int32()),
                        pa.array(keys.ravel()),
                    )
                    yield pa.record_batch([pa.array(reps[rows]), lists], schema=schema)

    return run


def _comparer(own: Plan, cosine: float):
    schema = pa.schema([("rep", pa.int64()), ("links", pa.int64()), ("near", pa.int64())])

    hashes = Hashes(own)

    def compared(reps, x, side, copies, table: int) -> pa.RecordBatch | None:
        linked = x @ x.T >= cosine
        if side.any():
            linked &= side[:, None] != side[None, :]
        i, j = np.nonzero(np.triu(linked, 1))
        if table and len(i):
            # Of the tables before, only the vectors with a link have to be looked up.
            some, place = np.unique(np.concatenate([i, j]), return_inverse=True)
            key = hashes.keys(x[some], table)
            left, right = place[: len(i)], place[len(i) :]
            fresh = np.ones(len(i), bool)
            for low in range(0, len(i), 1 << 18):
                at = slice(low, low + (1 << 18))
                fresh[at] = ~(key[left[at]] == key[right[at]]).any(axis=1)
            i, j = i[fresh], j[fresh]
        if not len(i):
            return None
        links = np.bincount(i, copies[j], len(x)) + np.bincount(j, copies[i], len(x))
        new = np.zeros_like(linked)
        new[i, j] = new[j, i] = True
        rows = np.flatnonzero(links)
        near = reps[grouping.local_components(new)]
        return pa.record_batch(
            [
                pa.array(reps[rows]),
                pa.array(links[rows].astype(np.int64)),
                pa.array(near[rows]),
            ],
            schema=schema,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouping.by_key(batches, "group"):
            values, bounds = grouping.lists(group.column("embedding"))
            reps, side, copies = (
                group.column(c).to_numpy() for c in ("rep", "side", "copies")
            )
            table = int(group.column("tab")[0].as_py())
            sizes = np.diff(bounds)
            # More than one size only by a chance collision of keys, which hold the size.
            for size in np.unique(sizes).tolist():
                own_size = np.flatnonzero(sizes == size)
                if len(own_size) == len(sizes):
                    x = values
                else:
                    x = np.concatenate([values[bounds[r] : bounds[r + 1]] for r in own_size])
                x = _unit(x, size)
                found = compared(reps[own_size], x, side[own_size], copies[own_size], table)
                if found is not None:
                    yield found

    return run


def _comparisons(reps: DataFrame, own: Plan) -> DataFrame:
    """(group, tab, side, rep): the vectors that are compared with each other."""
    member = (
        reps.select("rep", "embedding")
        .mapInArrow(_hasher(own), "rep long, buckets array<long>")
        .select("rep", F.posexplode("buckets").alias("tab", "bucket"))
    )
    member = stored(member, "buckets")
    blocks = (
        member.groupBy("tab", "bucket")
        .agg(
            F.count("*").alias("members"),
            F.sum(F.xxhash64("rep").cast("decimal(20,0)")).alias("who"),
            F.expr("bit_xor(xxhash64(rep, 1))").alias("who_too"),
        )
        .where("members > 1")
        .groupBy("members", "who", "who_too")
        .agg(F.min(F.struct("tab", "bucket")).alias("first"))
        .select("first.*", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
    )
    return (
        member.join(blocks, ["tab", "bucket"])
        .withColumn("own", F.expr("cast(pmod(xxhash64(rep, bucket), blocks) as int)"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            F.xxhash64(
                "tab", "bucket", F.least("own", "other"), F.greatest("own", "other")
            ).alias("group"),
            "tab",
            # Two sides also where one has no vectors; 0: a block with itself.
            F.when(F.col("own") < F.col("other"), 1)
            .when(F.col("own") > F.col("other"), 2)
            .otherwise(0)
            .alias("side"),
            "rep",
        )
    )


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of ``vectors``.

    ``vectors`` has vec_id BIGINT and embedding, an array of FLOAT or DOUBLE; other
    columns are not read. Rows are linked if the cosine of their vectors, in double
    precision, is at least ``cosine``; ``n_links`` counts the other rows so linked.

    * a vector that is null, empty or zero, or holds a null, NaN or infinite component,
      is linked with nothing; nor are vectors of different sizes linked;
    * rows that repeat a vec_id are one vertex with all their links, and each of them is
      returned; its own row counts are those of its vector;
    * null vec_id: linked with nothing, component_id null, kept;
    * an empty table gives an empty result.
    """
    bad = F.exists(
        "embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    )
    good = F.coalesce(
        ~bad & F.exists("embedding", lambda x: x != 0) & F.col("vec_id").isNotNull(),
        F.lit(False),
    )
    every = vectors.select(F.col("vec_id").cast("bigint"), "embedding").select(
        "vec_id", F.when(good, F.col("embedding")).alias("embedding")
    )
    # Two hashes of a vector stand for it.
    hashes = [
        F.when(F.col("embedding").isNotNull(), F.xxhash64(*seed, "embedding")).alias(name)
        for name, seed in (("hash_a", []), ("hash_b", [F.lit(1)]))
    ]
    every = every.select("vec_id", "embedding", *hashes)
    named = every.where("embedding is not null")
    reps = stored(
        named.groupBy("hash_a", "hash_b").agg(
            F.min("vec_id").alias("rep"),
            F.count("*").alias("copies"),
            F.first("embedding").alias("embedding"),
        ),
        "vectors",
    )
    own = plan(reps.count(), cosine)
    links = stored(
        _comparisons(reps, own)
        .join(reps.select("rep", "copies", "embedding"), "rep")
        .repartition("group")
        .sortWithinPartitions("group")
        .mapInArrow(_comparer(own, cosine), "rep long, links long, near long"),
        "links",
    )
    twice = named.groupBy("vec_id").agg(F.count("*").alias("n")).where("n > 1")
    same_id = (
        named.select("vec_id", "hash_a", "hash_b")
        .join(twice, "vec_id")
        .join(reps.select("hash_a", "hash_b", "rep"), ["hash_a", "hash_b"])
        .select(F.col("vec_id").alias("u"), F.col("rep").alias("v"))
    )
    label = components(
        links.select(F.col("rep").alias("u"), F.col("near").alias("v")).union(same_id)
    )
    classes = (
        reps.drop("embedding")
        .join(links.groupBy("rep").agg(F.sum("links").alias("links")), "rep", "left")
        .join(label, F.col("rep") == F.col("vertex"), "left")
        .select(
            "hash_a",
            "hash_b",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("class"),
        )
    )
    component = F.when(
        F.col("vec_id").isNotNull(), F.coalesce(F.col("class"), F.col("vec_id"))
    )
    return (
        every.select("vec_id", "hash_a", "hash_b")
        .join(classes, ["hash_a", "hash_b"], "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
            component.alias("component_id"),
            F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
        )
    )
