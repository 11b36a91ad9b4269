"""Ball trees and ranked search against scoring every document."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from brightledger.llm import balltree
from brightledger.llm.queries import QUERIES

from .cases import documents, none, prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_top(docs, items, k=10):
    counts = [(d, Counter(plain_terms(t))) for d, t in docs]
    held = [sum(c.values()) for _, c in counts if c]
    n_all, l_all = len(held), sum(held)
    df = Counter(t for _, c in counts for t in c)
    found = []
    for item, text in items:
        scored = []
        for doc, count in counts:
            m = 10 + 90 * sum(count.values()) * n_all // l_all if count else 0
            score = sum(
                math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * (10**9 * count[t] // (1000 * count[t] + 8 * m))
                for t in set(plain_terms(text)) if count[t]
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        found += [(item, at + 1, None if none else doc, -score) for at, (score, none, doc) in enumerate(sorted(scored)[:k])]
    return sorted(found, key=repr)


def pairs(df, key):
    return [tuple(r) for r in df.select(key, "text").collect()]


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def random_tree(seed, documents, terms, alike):
    draw = np.random.default_rng(seed)
    held = [np.sort(draw.choice(terms, draw.integers(1, min(terms, 30)), replace=False)) for _ in range(documents)]
    held = [held[draw.integers(0, n + 1)] if draw.random() < alike else h for n, h in enumerate(held)]
    sizes = np.array([len(h) for h in held])
    weights = draw.integers(0, 12_000, terms)
    impact = draw.integers(1, 10**6, sizes.sum())
    tree = balltree.BallTree.over(np.arange(documents), np.zeros(documents, bool), sizes, np.concatenate(held), impact, weights)
    return tree, np.split(impact, np.cumsum(sizes)[:-1]), held, weights


@pytest.mark.parametrize("seed, documents, terms, alike", [(1, 300, 50, 0.0), (2, 700, 400, 0.6), (3, 40, 5, 0.9), (4, 1, 3, 0.0)])
def test_bounds_hold_and_search_is_exact(seed, documents, terms, alike):
    tree, impacts, held, weights = random_tree(seed, documents, terms, alike)
    tree = balltree.BallTree.unpacked(tree.packed())
    assert sorted(tree.doc_id.tolist()) == list(range(documents)) and tree.end[0] == documents
    draw = np.random.default_rng(seed)
    for _ in range(20):
        query = np.sort(draw.choice(terms, draw.integers(1, terms + 1), replace=False)).astype(np.int32)
        scores = np.array([(weights[h] * i)[np.isin(h, query)].sum() for h, i in zip(held, impacts)])
        columns = np.flatnonzero(np.isin(tree.known, query))
        if len(columns):
            bounds = tree.bounds(columns)
            assert all(bounds[v] >= scores[tree.doc_id[tree.begin[v] : tree.end[v]]].max() for v in range(len(bounds)))
        best = balltree.Best(10)
        scored = tree.search(query, weights, best)
        wanted = sorted((-s, False, d) for d, s in enumerate(scores.tolist()) if s > 0)[:10]
        assert sorted(best.found)[:10] == wanted and scored <= documents
        # Knowing the k-th score beforehand loses nothing that ties with it.
        if len(wanted) == 10:
            known = balltree.Best(10, -wanted[-1][0])
            assert tree.search(query, weights, known) <= scored and sorted(known.found)[:10] == wanted


def test_subtrees_of_other_terms_are_left_out():
    # Two halves of the vocabulary: documents of one hold no term of a query from the other.
    draw = np.random.default_rng(0)
    held = [np.sort(draw.choice(50, 8, replace=False)) + 50 * (n % 2) for n in range(1000)]
    tree = balltree.BallTree.over(np.arange(1000), np.zeros(1000, bool), np.full(1000, 8), np.concatenate(held), np.full(8000, 1000), np.full(100, 5000))
    best = balltree.Best(10)
    assert tree.search(np.arange(50, 60, dtype=np.int32), np.full(100, 5000), best) <= 600 and len(best.found) == 10


ITEMS = [(1, prose(3, 33)), (2, "ON, On on!"), (3, None), (4, "?! --"), (2, prose(99, 60)), (None, "thst one"), (5, "one two three É é"), (6, prose(7, 400))]


@pytest.mark.parametrize("item_bytes, size", [(1 << 20, 2048), (200, 4)])
def test_awkward_tables(spark, item_bytes, size):
    extra = [(40 + n, rows_text, "aa", "s", 1) for n, rows_text in enumerate(["On " * 50, "on on", "on on", "É\x00é_ONE", "一二 on", prose(3, 33) + " on"])]
    docs = documents(spark, extra).withColumn("score", F.lit("clash")).withColumn("Rank", F.lit("clash"))
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    found = balltree.top_documents(docs, items, item_bytes=item_bytes, block_documents=size)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows(found) == plain_top(pairs(docs, "doc_id"), ITEMS)
    copies = spark.createDataFrame([(n % 7, "on and on") for n in range(40)] + [(None, "on and on")], "doc_id long, text string")
    assert rows(balltree.top_documents(copies, items)) == plain_top(pairs(copies, "doc_id"), ITEMS)


def test_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert balltree.top_documents(none(spark), items).collect() == []
    assert balltree.top_documents(documents(spark), items.where("item_id > 9")).collect() == []
    assert balltree.top_documents(documents(spark).where("doc_id IN (21, 22, 23)"), items).collect() == []


def test_query_against_plain_rows(spark, sf_dir):
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    assert rows(QUERIES["op12_ball_tree"](spark, sf_dir)) == plain_top(pairs(docs, "doc_id"), pairs(items, "item_id"))
