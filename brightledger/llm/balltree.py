"""Exact ranked search over ball trees of sparse term vectors.

A document is the vector of its terms' weighted impacts, an item the vector with a one at each
of its terms, and a score their inner product. Documents are cut into blocks, and each block is
a tree of balls: a node has a centroid and the radius of the ball around it that holds all of
its documents, so no document in it scores more than ``q . centroid + |q| * radius``. Trees are
searched best-first; a node whose bound, rounded upwards, lies below the k-th best score so far
is left out with all below it, and documents of the leaves that remain are scored exactly in
whole numbers.
"""

from __future__ import annotations

import heapq
import io
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window, functions as F, types as T

from brightledger.llm.common import fresh_folder, stored
from brightledger.llm.files import NewFile, opened

BEST = 10
ITEM_BYTES = 4 << 20  # of the texts of items that are looked for together
BLOCK_DOCUMENTS, BLOCK_TERMS = 2048, 1 << 20  # of a tree
LEAF = 32  # documents
TREES = 4  # that a task searches
TASKS = 100_000
# Relative error of sums over up to a million terms in doubles, with room to spare.
SLACK = 1e-9

# A term is a longest run of ASCII letters, digits and all signs beyond ASCII; A-Z are lowered.
_SIGNS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_SIGNS).split()


# ---------------------------------------------------------------- trees


@dataclass
class BallTree:
    """Documents in the order of the leaves, as rows (``first``, ``column``, ``impact``) over the
    terms ``known``; nodes by number, the root first, with the documents from ``begin`` to
    ``end``, the number of the ``second`` child (the first comes next; 0 for a leaf) and a
    ``radius``; centroids by term (``node_first``, ``node``, ``centre``)."""

    doc_id: np.ndarray
    no_id: np.ndarray
    known: np.ndarray
    first: np.ndarray
    column: np.ndarray
    impact: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    second: np.ndarray
    radius: np.ndarray
    node_first: np.ndarray
    node: np.ndarray
    centre: np.ndarray

    @classmethod
    def over(cls, doc_id, no_id, sizes, term, impact, weights) -> "BallTree":
        """A tree over documents with ``sizes`` terms each (at least one)."""
        known, column = np.unique(term, return_inverse=True)
        weight = weights[known].astype(np.float64)
        first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        value = impact * weight[column]
        order = np.arange(len(sizes))
        begin, end, second, radius, nodes, centred, centres = [], [], [], [], [], [], []

        def rows(picked):
            at = np.repeat(first[picked] - np.cumsum(sizes[picked]) + sizes[picked], sizes[picked]) + np.arange(sizes[picked].sum())
            return column[at], value[at], np.concatenate([[0], np.cumsum(sizes[picked])[:-1]])

        def dense(columns, values):
            made = np.zeros(len(known))
            made[columns] = values
            return made

        def add(low: int, high: int) -> None:
            picked = order[low:high]
            columns, values, starts = rows(picked)
            square = np.add.reduceat(values * values, starts)
            centre = (np.bincount(columns, values, len(known)) / len(picked)).astype(np.float32).astype(np.float64)
            apart = square - 2 * np.add.reduceat(values * centre[columns], starts) + centre @ centre
            # Rounded upwards: the error of the three sums is relative to their size.
            far = np.sqrt(np.maximum(apart, 0) + SLACK * (square + centre @ centre)) * (1 + SLACK)
            number = len(begin)
            begin.append(low)
            end.append(high)
            second.append(0)
            radius.append(far.max())
            seen = np.flatnonzero(np.bincount(columns, minlength=len(known)))
            nodes.append(np.full(len(seen), number))
            centred.append(seen)
            centres.append(centre[seen])
            if high - low <= LEAF:
                return
            # Two documents far apart give the direction in which the node is halved.
            one = int(far.argmax())
            span = slice(starts[one], starts[one] + sizes[picked[one]])
            from_one = dense(columns[span], values[span])
            two = int((square - 2 * np.add.reduceat(values * from_one[columns], starts)).argmax())
            span = slice(starts[two], starts[two] + sizes[picked[two]])
            along = np.add.reduceat(values * (from_one - dense(columns[span], values[span]))[columns], starts)
            order[low:high] = picked[np.argsort(along, kind="stable")]
            half = (low + high) // 2
            add(low, half)
            second[number] = len(begin)
            add(half, high)

        add(0, len(sizes))
        at_term = np.concatenate(centred)
        by_term = np.argsort(at_term, kind="stable")
        at = np.repeat(first[order] - np.cumsum(sizes[order]) + sizes[order], sizes[order]) + np.arange(len(column))
        return cls(
            doc_id[order],
            no_id[order],
            known.astype(np.int32),
            np.concatenate([[0], np.cumsum(sizes[order])]).astype(np.int64),
            column[at].astype(np.int32),
            impact[at].astype(np.int32),
            np.array(begin, np.int32),
            np.array(end, np.int32),
            np.array(second, np.int32),
            np.array(radius),
            np.concatenate([[0], np.cumsum(np.bincount(at_term, minlength=len(known)))]).astype(np.int64),
            np.concatenate(nodes)[by_term].astype(np.int32),
            np.concatenate(centres)[by_term].astype(np.float32),
        )

    def packed(self) -> bytes:
        data = io.BytesIO()
        np.savez(data, **vars(self))
        return data.getvalue()

    @classmethod
    def unpacked(cls, data: bytes) -> "BallTree":
        return cls(**np.load(io.BytesIO(data)))

    def bounds(self, columns: np.ndarray) -> np.ndarray:
        """Above every score in each node, for a query with ones at these of the tree's terms.

        Only terms that a node's documents hold count for it, so ``|q|`` is the root of their
        number.
        """
        low, high = self.node_first[columns], self.node_first[columns + 1]
        at = np.repeat(high - np.cumsum(high - low), high - low) + np.arange((high - low).sum())
        nodes = self.node[at]
        inner = np.bincount(nodes, self.centre[at], len(self.begin))
        shared = np.bincount(nodes, minlength=len(self.begin))
        return (inner + np.sqrt(shared) * self.radius) * (1 + SLACK)

    def search(self, query: np.ndarray, weights: np.ndarray, best: "Best", one_leaf: bool = False) -> int:
        """Offers ``best`` all documents that can be among them, or those of the first leaf
        reached; returns how many documents were scored."""
        at = np.searchsorted(self.known, query)
        at[at == len(self.known)] = 0
        columns = at[self.known[at] == query]
        if not len(columns):
            return 0
        bound = self.bounds(columns)
        weight = np.zeros(len(self.known), np.int64)
        weight[columns] = weights[self.known[columns]]
        waiting, scored = [(-bound[0], 0)], 0
        while waiting:
            above, node = heapq.heappop(waiting)
            if -above < best.least:
                break
            if not self.second[node]:
                low, high = self.begin[node], self.end[node]
                part = slice(self.first[low], self.first[high])
                scores = np.add.reduceat(weight[self.column[part]] * self.impact[part], self.first[low:high] - self.first[low])
                best.offer(scores, self.doc_id[low:high], self.no_id[low:high])
                scored += high - low
                if one_leaf:
                    break
                continue
            for child in (node + 1, int(self.second[node])):
                if bound[child] >= best.least:
                    heapq.heappush(waiting, (max(above, -bound[child]), child))
        return scored


class Best:
    """The best ``k`` documents offered: highest scores above zero, equal ones by ascending id,
    no id last. ``least`` is the score that another must reach."""

    def __init__(self, k: int, least: int = 1):
        self.k, self.least = k, max(1, least)
        self.found: list[tuple[int, bool, int]] = []  # (-score, no id, id)

    def offer(self, scores, doc_id, no_id) -> None:
        for at in np.flatnonzero(scores >= self.least).tolist():
            self.found.append((-int(scores[at]), bool(no_id[at]), int(doc_id[at])))
        if len(self.found) >= self.k:
            self.found = sorted(self.found)[: self.k]
            self.least = max(self.least, -self.found[-1][0])


# ---------------------------------------------------------------- jobs


@dataclass(frozen=True)
class Items:
    """Items that are looked for together: their ids, and each one's terms by number."""

    ids: list
    numbers: dict[bytes, int]
    queries: list[np.ndarray]

    @classmethod
    def of(cls, rows: list[tuple]) -> "Items":
        numbers: dict[bytes, int] = {}
        queries = [{numbers.setdefault(t, len(numbers)) for t in terms((text or "").encode())} for _, text in rows]
        return cls([i for i, _ in rows], numbers, [np.array(sorted(q), np.int32) for q in queries])


def blocks(rows: Iterable[Row], most: int) -> Iterator[list[tuple]]:
    """Items in blocks of about ``most`` bytes of text."""
    held, size = [], 0
    for item_id, text in rows:
        held.append((item_id, text))
        size += len(text or "") + 16
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def top_documents(
    documents: DataFrame, items: DataFrame, best: int = BEST, item_bytes: int = ITEM_BYTES, block_documents: int = BLOCK_DOCUMENTS
) -> DataFrame:
    """The ``best`` documents (doc_id, text) of highest score above 0 for every row of ``items``
    (item_id, text): item_id, ``rank`` from 1, doc_id and ``score``, equal scores by ascending
    doc_id with null last.

    With N the documents that have a term, L all their terms, df the documents with a term, tf
    its occurrences in one and n that one's terms, a term weighs floor(1000 ln((2N + 2) / (2df +
    1))), m is 10 + 90 n N div L, and a score sums weight * (10**9 tf div (1000 tf + 8 m)) over
    the distinct terms of the item.

    Null, empty and termless texts on either side match nothing; a repeated row of documents
    ranks as often as it is there, a repeated row of items is answered each time, and rows with
    one item_id have ranks of their own; other columns are ignored; empty tables give no rows.
    Whole texts are read.

    Items come to the driver in blocks of ``item_bytes`` of text, one block at a time, and only
    their terms, with the weights, are sent to the tasks. For each block: documents become
    vectors over the block's terms; their counts give the weights; tasks build trees over
    bounded blocks of documents and search one leaf of each, whose scores give every item a
    score that its k-th best reaches at least; then all trees are searched with that to begin
    with. A task hands on its ``best`` of each item, whatever it has read.
    """
    item_type = items.schema["item_id"].dataType
    fields = [T.StructField("item_id", item_type), T.StructField("rank", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())]
    spark = documents.sparkSession
    found = [
        _searched(documents.select(F.col("doc_id").cast("long"), "text"), Items.of(block), item_type, best, block_documents)
        for block in blocks(items.select("item_id", "text").toLocalIterator(), item_bytes)
    ]
    if not found:
        return spark.createDataFrame([], T.StructType(fields))
    if len(found) > 1:
        found = [stored(df, "ranked") for df in found]
    whole = found[0]
    for df in found[1:]:
        whole = whole.union(df)
    return whole


def _searched(documents: DataFrame, items: Items, item_type: T.DataType, k: int, block_documents: int) -> DataFrame:
    spark = documents.sparkSession
    context = spark.sparkContext
    shared = context.broadcast(items)
    vectors = stored(documents.mapInArrow(_vectors(shared), "doc_id long, n long, terms binary, counts binary"), "term-vectors")
    n, length = vectors.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(items.numbers), np.int64)
    counted = vectors.select("terms").mapInArrow(_frequencies, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    table = counted.toArrow()  # a row per term of the block at most
    df[table["term"].to_numpy()] = table["df"].to_numpy()
    weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    shared_weights = context.broadcast(weights)

    folder = fresh_folder(spark, "ball-trees")
    kind = "path string, offset long, length long, item int, score long"
    index = stored(vectors.where("length(terms) > 0").mapInArrow(_index(folder, shared, shared_weights, n, length, k, block_documents), kind), "ball-index")
    per_item = Window.partitionBy("item").orderBy(F.desc("score"))
    kth = index.where("item IS NOT NULL").select("item", "score", F.row_number().over(per_item).alias("place")).where(F.col("place") <= k)
    least = np.ones(len(items.queries), np.int64)
    for item, score in kth.where(F.col("place") == k).select("item", "score").toLocalIterator():
        least[item] = score
    trees = index.where("path IS NOT NULL").select("path", "offset", "length")
    tasks = max(1, min(-(-trees.count() // TREES), TASKS))
    shared_least = context.broadcast(least)
    offers = trees.repartition(tasks).mapInArrow(_search(shared, shared_weights, shared_least, k), "item int, doc_id long, score long")
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    ranked = offers.select("item", rank.alias("rank"), "doc_id", "score").where(F.col("rank") <= k)
    names = spark.createDataFrame(list(enumerate(items.ids)), T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", item_type)]))
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def _vectors(shared):
    """Per document its number of terms, and the numbers and counts of those that items have."""

    def made(batches):
        numbers = shared.value.numbers
        for batch in batches:
            sizes, found, counts = [], [], []
            for text in batch.column("text"):
                words = terms(text.as_buffer().to_pybytes()) if text.is_valid else []
                held = np.fromiter(map(numbers.get, words, repeat(-1)), np.int32, len(words))
                distinct, count = np.unique(held[held >= 0], return_counts=True)
                sizes.append(len(words))
                found.append(distinct.astype("<i4").tobytes())
                counts.append(count.astype("<i4").tobytes())
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "n": pa.array(sizes, pa.int64()), "terms": pa.array(found, pa.binary()), "counts": pa.array(counts, pa.binary())}
            )

    return made


def _joined(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4")


def _frequencies(batches):
    """Documents of a task by term."""
    found = np.zeros(0, np.int64)
    for batch in batches:
        more = np.bincount(_joined(batch.column("terms")), minlength=len(found))
        more[: len(found)] += found
        found = more
    seen = np.flatnonzero(found)
    yield pa.RecordBatch.from_pydict({"term": pa.array(seen, pa.int32()), "df": pa.array(found[seen], pa.int64())})


def _index(folder: str, shared, shared_weights, n: int, length: int, k: int, block_documents: int):
    """Trees over blocks of documents in one file per task, as rows of its places, and the scores
    of the best documents of one leaf per tree and item."""

    def tree_of(parts: list[pa.RecordBatch]) -> BallTree:
        table = pa.Table.from_batches(parts).combine_chunks()
        term, count = _joined(table["terms"]), _joined(table["counts"]).astype(np.int64)
        sizes = np.array([len(t) // 4 for t in table["terms"].to_pylist()], np.int64)
        m = 10 + 90 * table["n"].to_numpy() * n // length
        impact = 10**9 * count // (1000 * count + 8 * np.repeat(m, sizes))
        ids = table["doc_id"].combine_chunks()
        return BallTree.over(ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False), sizes, term, impact, shared_weights.value)

    def cut(batches):
        """Record batches of a tree each, by documents and terms."""
        parts, documents, held = [], 0, 0
        for batch in batches:
            sizes = np.array([len(t) // 4 for t in batch.column("terms").to_pylist()], np.int64)
            at = 0
            while at < batch.num_rows:
                room = np.searchsorted(np.cumsum(sizes[at:]), BLOCK_TERMS - held, "right") + 1
                take = int(min(batch.num_rows - at, block_documents - documents, room))
                parts.append(batch.slice(at, take))
                documents, held, at = documents + take, held + sizes[at : at + take].sum(), at + take
                if documents >= block_documents or held >= BLOCK_TERMS:
                    yield parts
                    parts, documents, held = [], 0, 0
        if parts:
            yield parts

    def rows(path, offset, size, item, score):
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
        columns = [pa.array(c, t) for c, t in zip((path, offset, size, item, score), kinds)]
        return pa.RecordBatch.from_arrays(columns, ["path", "offset", "length", "item", "score"])

    def write(batches):
        queries = shared.value.queries
        bests = [Best(k) for _ in queries]
        name, file, offset = f"{uuid4().hex}.trees", None, 0
        for parts in cut(batches):
            tree = tree_of(parts)
            for query, best in zip(queries, bests):
                tree.search(query, shared_weights.value, best, one_leaf=True)
            file = file or NewFile(folder, name)
            data = tree.packed()
            file.out.write(data)
            yield rows([f"{folder}/{name}"], [offset], [len(data)], [None], [None])
            offset += len(data)
        if file is not None:
            file.close()
        for item, best in enumerate(bests):
            some = len(best.found)
            if some:
                yield rows([None] * some, [None] * some, [None] * some, [item] * some, [-f[0] for f in best.found])

    return write


def _search(shared, shared_weights, shared_least, k: int):
    def searched(batches):
        bests = [Best(k, int(least)) for least in shared_least.value]
        for batch in batches:
            for path, offset, size in zip(*[batch.column(n).to_pylist() for n in ("path", "offset", "length")]):
                files, place = opened(path)
                with files.open_input_file(place) as file:
                    file.seek(offset)
                    tree = BallTree.unpacked(file.read(size))
                for query, best in zip(shared.value.queries, bests):
                    tree.search(query, shared_weights.value, best)
        for item, best in enumerate(bests):
            if best.found:
                scores, no_id, ids = zip(*best.found)
                yield pa.RecordBatch.from_pydict(
                    {
                        "item": pa.array([item] * len(ids), pa.int32()),
                        "doc_id": pa.array([None if none else i for none, i in zip(no_id, ids)], pa.int64()),
                        "score": pa.array([-s for s in scores], pa.int64()),
                    }
                )

    return searched
