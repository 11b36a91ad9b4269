"""Near-duplicate texts by DartMinHash and banded joining.

Darts fall on the plane of weight and rank as a Poisson process of density one, separately
for each element and the same in every set: each has a weight, a rank and one of
``COORDINATES`` coordinates, all from hashes. A set is hit by an element's darts below its
weight there. The signature is the dart of lowest rank at each coordinate; two sets have the
same dart at a coordinate with the probability of their weighted Jaccard similarity. Only
ranks up to a limit are thrown, chosen so that each coordinate is likely to be hit; sets with
a coordinate left empty are thrown again with twice the limit.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from brightledger.llm.common import stored
from brightledger.llm.components import components
from brightledger.llm.shingles import mixed, shingles

SIMILARITY = 0.8
BANDS, BAND_ROWS = 24, 5
COORDINATES = BANDS * BAND_ROWS
# Texts signed together, by their bytes.
BATCH_BYTES = 1 << 20
# Text bytes, and texts, that one side of a comparison holds.
BLOCK_BYTES, BLOCK_TEXTS = 8 << 20, 2048
# Text bytes of the small groups that are compared in one call, on average.
CALL_BYTES = 1 << 20
# Pairs whose signatures agree this many standard deviations below the similarity, or more,
# are compared exactly.
DEVIATIONS = 4.5


def signatures(elements: list[np.ndarray], weights: list[np.ndarray], size: int = COORDINATES) -> np.ndarray:
    """The dart (a 64-bit hash) of lowest rank at each coordinate of each non-empty set."""
    found = np.zeros((len(elements), size), np.uint64)
    limit = np.array([size * (np.log(size) + 2) / w.sum() for w in weights])
    left = np.arange(len(elements))
    while len(left):
        owner = np.repeat(np.arange(len(left)), [len(elements[i]) for i in left])
        hashes = np.concatenate([elements[i] for i in left])
        weight = np.concatenate([weights[i] for i in left]).astype(np.float64)
        place, rank, dart = _thrown(hashes, weight, limit[left][owner], owner, size)
        # The lowest rank is written last.
        order = np.lexsort((dart, rank))[::-1]
        flat = np.zeros(len(left) * size, np.uint64)
        hit = np.zeros(len(left) * size, bool)
        flat[place[order]], hit[place] = dart[order], True
        full = hit.reshape(len(left), size).all(axis=1)
        found[left[full]] = flat.reshape(len(left), size)[full]
        left = left[~full]
        limit[left] *= 2
    return found


def _thrown(hashes, weight, limit, owner, size):
    """Place (set and coordinate), rank and hash of all darts that hit below the limits.

    Weights are cut into regions [2**v - 1, 2**(v + 1) - 1), each 2**v wide; in each the darts
    of an element come in order of rank, 2**v of them per unit on average.
    """
    places, ranks, darts = [], [], []
    region = 0
    at = np.flatnonzero(weight > 0)
    while len(at):
        low, width = 2.0**region - 1, 2.0**region
        now, rank, step = at, np.zeros(len(at)), 0
        while len(now):
            drawn = mixed(mixed(hashes[now], 16 + region), 64 + step)
            rank = rank - np.log(((drawn >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / width
            inside = rank < limit[now]
            now, rank, drawn = now[inside], rank[inside], drawn[inside]
            more = mixed(drawn, 3)
            hits = low + width * ((more >> np.uint64(11)).astype(np.float64) * 2.0**-53) < weight[now]
            places.append(owner[now[hits]] * size + (mixed(drawn[hits], 4) % np.uint64(size)).astype(np.int64))
            ranks.append(rank[hits])
            darts.append(mixed(drawn[hits], 5))
            step += 1
        region += 1
        at = at[weight[at] > 2.0**region - 1]
    return np.concatenate(places), np.concatenate(ranks), np.concatenate(darts)


def weighted_set(text: str | None, counted: bool) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles in order of their hash, and their weights: how often each occurs,
    or one each."""
    distinct, counts = np.unique(shingles(text), return_counts=True)
    return distinct, counts if counted else np.ones(len(distinct), np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity: the sum of the lower weights over that of the higher."""
    _, left, right = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][left], b[1][right]).sum()
    return both / (a[1].sum() + b[1].sum() - both)


def _signed(counted: bool):
    def flush(rows):
        sets = [weighted_set(text, counted) for _, _, text in rows]
        some = [i for i, s in enumerate(sets) if len(s[0])]
        signed = signatures([sets[i][0] for i in some], [sets[i][1] for i in some])
        buckets = [None] * len(rows)
        agreed = [None] * len(rows)
        for i, darts in zip(some, signed):
            band = mixed(np.arange(BANDS, dtype=np.uint64), 9)
            for n in range(BAND_ROWS):
                band = mixed(band + darts[n * BANDS : (n + 1) * BANDS], 10 + n)
            buckets[i] = band.view(np.int64)
            agreed[i] = (darts >> np.uint64(56)).astype(np.uint8).tobytes()
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": pa.array([r[0] for r in rows], pa.int64()),
                "digest": pa.array([r[1] for r in rows], pa.string()),
                "bytes": pa.array([len(r[2]) for r in rows], pa.int64()),
                "buckets": pa.array(buckets, pa.list_(pa.int64())),
                "signature": pa.array(agreed, pa.binary()),
            }
        )

    def sign(batches):
        rows, held = [], 0
        for batch in batches:
            for row in zip(batch.column("doc_id"), batch.column("digest"), batch.column("text")):
                rows.append([value.as_py() for value in row])
                held += len(rows[-1][2])
                if held >= BATCH_BYTES:
                    yield flush(rows)
                    rows, held = [], 0
        if rows:
            yield flush(rows)

    return sign


def near_duplicates(documents: DataFrame, threshold: float = SIMILARITY, counted: bool = False) -> DataFrame:
    """One row per row of ``documents`` (doc_id, text): doc_id, ``class_id`` (the smallest
    doc_id of its class) and ``kept`` (whether that is its own).

    Texts belong to one class if they are equal or linked by a chain of pairs whose shingle
    sets (five words, lower case) have a similarity of at least ``threshold``; with ``counted``
    a shingle weighs as often as it occurs, otherwise one. A text of one to four words is a
    single shingle; words are what white space parts, so a text in a script without blanks is
    one, too. Empty texts and texts without words are only equal to themselves. A null text is
    in no class but its own. The class of a row is that of its text: rows that repeat a doc_id
    with other texts have a class each, and a row without doc_id has the class of its text,
    whose id is null, and which it keeps, if no row of it has one. Other columns are ignored
    and an empty table gives no rows; texts are read whole.

    Equal texts are one node from the start. Nodes that share a band of the signature are put
    into candidate groups (the components of that relation), which need only hashes. Each
    group's texts are then compared where they meet: pairs are taken by falling agreement of
    their signatures, verified exactly, and skipped once both are in one class, so what a group
    returns are at most as many links as it has texts. Groups over ``BLOCK_BYTES`` or
    ``BLOCK_TEXTS`` are cut into blocks, and each pair of blocks is compared on its own.
    """
    classes = _classes(documents, threshold, counted)
    rows = documents.select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"), F.col("text").isNull().alias("alone"))
    found = rows.join(classes.select("digest", "class_id"), "digest", "left")
    found = found.select("doc_id", F.when(F.col("alone"), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"))
    return found.select("doc_id", "class_id", F.col("class_id").eqNullSafe(F.col("doc_id")).alias("kept"))


def keep_one(documents: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """The rows of ``documents``, all columns, that stay: one of each class of texts, and every
    row without text.

    Of a class it is the row with the smallest doc_id (null last), then the smallest digest of
    its text, then the smallest hash of its columns; of rows equal in all that, any one. Texts
    alone make the classes, so another text under a repeated doc_id is never dropped with it,
    and copies without doc_id are dropped like others.
    """
    classes = _classes(documents, threshold, False).select("digest", "component")
    hashed = [F.col(f"`{f.name}`") for f in documents.schema.fields if "map<" not in f.dataType.simpleString()]
    keys = [F.col("doc_id"), F.md5(F.col("text").cast("binary")).alias("digest"), F.xxhash64(*hashed).alias("hash")]
    texts = documents.where("text IS NOT NULL")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest", "hash")).alias("first")
    best = texts.select(*keys).join(classes, "digest").groupBy("component").agg(first).select("first.*")
    best = best.select(F.coalesce("doc_id", F.lit(0)).alias("key"), "last", "digest", "hash")
    record = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("record")
    rows = texts.select(*keys, record).select(F.coalesce("doc_id", F.lit(0)).alias("key"), F.col("doc_id").isNull().alias("last"), "digest", "hash", "record")
    same = ["key", "last", "digest", "hash"]
    one = rows.join(best, same).dropDuplicates(same)
    return one.select("record.*").union(documents.where("text IS NULL"))


def _classes(documents: DataFrame, threshold: float, counted: bool) -> DataFrame:
    """Per distinct text its ``digest``, the ``component`` of its class and the ``class_id``."""
    rows = documents.select("doc_id", "text", F.md5(F.col("text").cast("binary")).alias("digest")).where("text IS NOT NULL")
    signed = rows.mapInArrow(_signed(counted), "doc_id long, digest string, bytes long, buckets array<long>, signature binary")
    signed = stored(signed, "signatures")
    nodes = signed.groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"),
        F.first("bytes").alias("bytes"),
        F.first("buckets").alias("buckets"),
        F.first("signature").alias("signature"),
    )
    # Numbers of distinct texts, which hold from here on because they are stored.
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    banded = nodes.select("node", F.explode("buckets").alias("bucket"))
    hubs = banded.groupBy("bucket").agg(F.min("node").alias("hub"), F.max("node").alias("top")).where("top <> hub").drop("top")
    groups = components(banded.join(hubs, "bucket").select(F.col("node").alias("a"), F.col("hub").alias("b")))
    links = stored(_verified(documents, nodes, groups, threshold, counted), "near-links")
    joined = nodes.select("digest", "doc_id", "node").join(components(links).withColumnRenamed("id", "node"), "node", "left")
    joined = joined.select("digest", "doc_id", F.coalesce("component", "node").alias("component"))
    smallest = joined.groupBy("component").agg(F.min("doc_id").alias("class_id"))
    return joined.select("digest", "component").join(smallest, "component")


def _verified(documents: DataFrame, nodes: DataFrame, groups: DataFrame, threshold: float, counted: bool) -> DataFrame:
    """Links (a, b) that join the texts of each candidate group into their classes."""
    grouped = groups.union(groups.select(F.col("component").alias("id"), "component").distinct())
    members = nodes.join(grouped.withColumnRenamed("id", "node"), "node").select(
        "node", "doc_id", "digest", "bytes", "signature", F.col("component").alias("group")
    )
    blocks = F.greatest(F.ceil(F.sum("bytes") / BLOCK_BYTES), F.ceil(F.count("*") / BLOCK_TEXTS))
    sizes = members.groupBy("group").agg(blocks.cast("int").alias("blocks"))
    total = members.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    dealt = members.join(sizes, "group").withColumn("own", F.pmod(F.xxhash64("node"), F.greatest("blocks", F.lit(1))).cast("int"))
    # The smallest doc_id of a text has that text; rows that repeat both give one.
    texts = documents.select(
        F.coalesce("doc_id", F.lit(0)).alias("key"), F.col("doc_id").isNull().alias("last"), "text", F.md5(F.col("text").cast("binary")).alias("digest")
    )
    keyed = dealt.withColumns({"key": F.coalesce("doc_id", F.lit(0)), "last": F.col("doc_id").isNull()}).drop("doc_id")
    held = keyed.join(texts, ["key", "last", "digest"]).dropDuplicates(["node"])
    held = held.withColumn("other", F.explode(F.sequence(F.lit(0), F.greatest("blocks", F.lit(1)) - 1)))
    # Small groups share a call, by hash; a block pair of a large one is a call of its own.
    low, high = F.least("own", "other"), F.greatest("own", "other")
    call = F.when(F.col("blocks") <= 1, F.pmod(F.xxhash64("group"), F.lit(max(1, -(-total // CALL_BYTES))))).otherwise(F.xxhash64("group"))
    calls = held.select(call.alias("call"), low.alias("low"), high.alias("high"), "group", "node", "own", "signature", "text")
    spread = np.sqrt(threshold * (1 - threshold) / COORDINATES)
    least = threshold - DEVIATIONS * spread

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        low, high = key[1].as_py(), key[2].as_py()
        table = table.combine_chunks().sort_by([("group", "ascending"), ("node", "ascending")])
        group, node, own = (table[n].to_numpy() for n in ("group", "node", "own"))
        signature = np.frombuffer(b"".join(table["signature"].to_pylist()), np.uint8).reshape(-1, COORDINATES)
        cuts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]]))
        left, right = [], []
        for begin, end in zip(cuts[:-1], cuts[1:]):
            at = np.arange(begin, end)
            sets = [weighted_set(table["text"][int(i)].as_py(), counted) for i in at]
            for a, b in _links(sets, signature[at], own[at] == low, own[at] == high, threshold, least):
                left.append(node[at[a]])
                right.append(node[at[b]])
        return pa.table({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})

    return calls.groupBy("call", "low", "high").applyInArrow(compare, "a long, b long")


def _links(sets, signature, in_first, in_second, threshold: float, least: float) -> list[tuple[int, int]]:
    """Verified pairs that join the sets into the classes of all pairs of one side with the
    other. Pairs whose signatures agree most come first; those already joined are skipped."""
    n = len(sets)
    total = np.array([s[1].sum() for s in sets])
    first, second = np.flatnonzero(in_first), np.flatnonzero(in_second)
    pairs, agreement = [], []
    for i in first:
        others = second[second > i] if in_second[i] else second
        others = others[np.minimum(total[others], total[i]) >= threshold * np.maximum(total[others], total[i])]
        share = (signature[others] == signature[i]).mean(axis=1)
        close = share >= least
        pairs.append(np.stack([np.full(close.sum(), i), others[close]], axis=1))
        agreement.append(share[close].astype(np.float32))
    pairs = np.concatenate(pairs) if pairs else np.zeros((0, 2), int)
    if not len(pairs):
        return []
    pairs = pairs[np.argsort(-np.concatenate(agreement), kind="stable")]
    root, found = np.arange(n), []
    step = 256
    for at in range(0, len(pairs), step):
        part = pairs[at : at + step]
        for a, b in part[root[part[:, 0]] != root[part[:, 1]]]:
            if root[a] != root[b] and similarity(sets[a], sets[b]) >= threshold:
                found.append((int(a), int(b)))
                root[root == root[b]] = root[a]
    return found
