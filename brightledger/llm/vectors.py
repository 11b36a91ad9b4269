"""Near-duplicate vectors through a pivot-permutation index.

Every vector is described by its nearest reference points (pivots) in order. An inverted list
per pivot holds the vectors that have it in their description; vectors that share enough
pivots are candidates, and every candidate pair is verified by its exact cosine.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from brightledger.llm.common import stored
from brightledger.llm.components import components

PIVOTS = 64
DESCRIBED_BY = 8
SHARED = 3
# The pivots are fitted on this many distinct vectors at most (those of smallest hash); every
# vector is indexed.
SAMPLE = 4096
# Vectors of a list that one task holds at a time; it meets one other block of its list.
BLOCK = 4096
# Rows of a block compared at a time.
STRIP = 256
SEED = 10


def fit_pivots(sample: np.ndarray, pivots: int) -> np.ndarray:
    """Reference points far from each other: each next one is the sampled unit vector whose
    nearest chosen point is farthest (the first of equal ones)."""
    chosen = [0]
    nearest = sample @ sample[0]
    while len(chosen) < min(pivots, len(sample)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, sample @ sample[chosen[-1]])
    found = sample[chosen]
    if len(found) < pivots:
        found = np.concatenate([found, random_pivots(pivots - len(found), sample.shape[1])])
    return found


def random_pivots(pivots: int, dimension: int) -> np.ndarray:
    drawn = np.random.default_rng([SEED, dimension]).normal(size=(pivots, dimension))
    return drawn / np.linalg.norm(drawn, axis=1, keepdims=True)


def unit(column: pa.Array) -> np.ndarray:
    """Vectors of one dimension as rows of length 1, in double precision; scaled by their
    largest component first, so that no square overflows or vanishes."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(column), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def near_duplicates(
    vectors: DataFrame,
    threshold: float,
    pivots: int = PIVOTS,
    described_by: int = DESCRIBED_BY,
    shared: int = SHARED,
    block: int = BLOCK,
) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): vec_id, ``n_links`` (rows
    linked to it directly), ``component_id`` (smallest vec_id reachable) and ``kept``.

    Two rows link if their labels are equal and not null, their dimensions are equal and the
    cosine is at least ``threshold``. Null, empty and zero vectors, and vectors with a null or
    non-finite component, link with nothing and are components of their own. Equal vectors of
    one label are one class with a count, compared once. The links of rows that repeat a
    vec_id are added up and they share a component; a null vec_id has no links and no component. Other
    columns are ignored and an empty table gives no rows.

    Candidates share at least ``shared`` of the ``described_by`` nearest pivots. Such a pair
    meets in the list of its smallest shared pivot, which is among the first
    ``described_by - shared + 1`` pivots of either by number, so a class enters that many
    lists, and the pair is counted there only. A list longer than ``block`` is cut into blocks
    by hash, and each pair of blocks is a group of its own. A group returns for each member its
    number of links and its smallest linked relative, never pairs.
    """
    spark = vectors.sparkSession
    given = vectors.select("vec_id", "embedding", "label")
    fits = (
        F.col("label").isNotNull()
        & (F.size("embedding") > 0)
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("embedding", lambda x: x != 0)
    )
    classes = (
        given.where(fits & F.col("vec_id").isNotNull())
        .groupBy("label", "embedding")
        .agg(F.min("vec_id").alias("class_id"), F.count("*").alias("n"))
    )
    classes = stored(classes.withColumn("dim", F.size("embedding")), "vector-classes")

    order = F.xxhash64(F.lit(SEED), "label", "embedding")
    sample = classes.orderBy(order, "class_id").limit(SAMPLE).select("embedding", "dim").toArrow()
    dims = sample.column("dim").to_numpy()
    by_dim = {
        int(d): fit_pivots(unit(sample.column("embedding").combine_chunks().filter(pa.array(dims == d))), pivots)
        for d in np.unique(dims)
    }
    reference = spark.sparkContext.broadcast(by_dim)  # of at most SAMPLE vectors

    def describe(batches):
        for batch in batches:
            described = []
            for d, column in zip(batch.column("dim").to_pylist(), batch.column("embedding")):
                points = reference.value.get(d)
                points = random_pivots(pivots, d) if points is None else points
                described.append(np.argsort(-(points @ unit(pa.array([column.as_py()]))[0]), kind="stable")[:described_by])
            yield batch.append_column("near", pa.array([np.sort(p).astype("int32") for p in described], pa.list_(pa.int32())))

    fields = ", ".join(f"{n} {t}" for n, t in classes.dtypes)
    listed = (
        classes.mapInArrow(describe, f"{fields}, near array<int>")
        .withColumn("pivot", F.explode(F.slice("near", 1, max(1, described_by - shared + 1))))
    )
    sizes = listed.groupBy("label", "dim", "pivot").agg(F.ceil(F.count("*") / block).alias("blocks"))
    part = F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int")
    # Block i meets block j in group (min, max); a list of one block is the group (0, 0).
    dealt = (
        listed.join(sizes, ["label", "dim", "pivot"])
        .withColumn("own", part)
        .withColumn("other", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))))
        .select(
            "label", "dim", "pivot", "class_id", "embedding", "near", "n", "own",
            F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        )
    )

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        pivot, low, high = (key[i].as_py() for i in (2, 3, 4))
        table = table.combine_chunks()
        ids, counts, own = (table[n].to_numpy() for n in ("class_id", "n", "own"))
        rows = unit(table["embedding"].combine_chunks())
        has = np.zeros((len(ids), pivots), np.float32)
        near = table["near"].combine_chunks()
        has[np.repeat(np.arange(len(ids)), near.value_lengths().to_numpy()), near.flatten().to_numpy()] = 1
        first, second = np.flatnonzero(own == low), np.flatnonzero(own == high)
        links, left, right = np.zeros(len(ids), np.int64), [], []
        for at in range(0, len(first), STRIP):
            strip = first[at : at + STRIP]
            together = has[strip] @ has[second].T >= shared
            if pivot:
                together &= has[strip, :pivot] @ has[second, :pivot].T == 0
            if low == high:
                together &= strip[:, None] < second[None, :]
            a, b = np.nonzero(together)
            a, b = strip[a], second[b]
            close = np.einsum("ij,ij->i", rows[a], rows[b]) >= threshold
            a, b = a[close], b[close]
            np.add.at(links, a, counts[b])
            np.add.at(links, b, counts[a])
            left.append(a)
            right.append(b)
        found = np.flatnonzero(links)
        lowest = _lowest(ids, np.concatenate([np.zeros(0, int), *left]), np.concatenate([np.zeros(0, int), *right]))
        return pa.table({"class_id": ids[found], "links": links[found], "lowest": lowest[found]})

    partial = dealt.groupBy("label", "dim", "pivot", "low", "high").applyInArrow(compare, "class_id long, links long, lowest long")
    partial = stored(partial, "vector-links")
    # Equal vec_ids in several classes are linked through the id itself.
    joined = components(partial.select(F.col("class_id").alias("a"), F.col("lowest").alias("b")))
    linked = partial.groupBy("class_id").agg(F.sum("links").alias("links"))
    about = (
        classes.select("label", "embedding", "class_id", "n")
        .join(linked, "class_id", "left")
        .join(joined.withColumnRenamed("id", "class_id"), "class_id", "left")
        .select("label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "class_id").alias("component"))
    )
    key = F.xxhash64("label", "embedding")
    about = about.withColumn("key", key)
    rows = given.withColumn("key", key).alias("g")
    same = (F.col("g.key") == F.col("c.key")) & (F.col("g.label") == F.col("c.label")) & (F.col("g.embedding") == F.col("c.embedding"))
    return rows.join(about.alias("c"), same, "left").select(
        F.col("g.vec_id").alias("vec_id"),
        F.when(F.col("g.vec_id").isNotNull(), F.coalesce("c.n_links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("g.vec_id").isNotNull(), F.coalesce("c.component", "g.vec_id")).alias("component_id"),
        F.coalesce(F.when(F.col("g.vec_id").isNotNull(), F.coalesce("c.component", "g.vec_id")) == F.col("g.vec_id"), F.lit(True)).alias("kept"),
    )


def _lowest(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest id that each place reaches over the links (a, b) between places."""
    lowest = ids.copy()
    while True:
        before = lowest.copy()
        np.minimum.at(lowest, a, lowest[b])
        np.minimum.at(lowest, b, lowest[a])
        if (before == lowest).all():
            return lowest
