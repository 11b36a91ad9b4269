"""Near-duplicate texts and vectors, and the components of links."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from brightledger.llm import minhash, vectors
from brightledger.llm.components import components
from brightledger.llm.queries import QUERIES
from brightledger.llm.shingles import shingles, word_hashes

from .cases import documents, none, prose, word


def united(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_components_of_random_links(spark):
    draw = np.random.default_rng(4)
    links = [tuple(map(int, draw.integers(0, 400, 2))) for _ in range(260)] + [(n, n + 1) for n in range(500, 560)] + [(600, n) for n in range(601, 700)]
    df = spark.createDataFrame([*links, (5, 5), (None, 3), (7, None), links[0]], "a long, b long")
    wanted = united(range(700), links)
    found = {r["id"]: r["component"] for r in components(df).collect()}
    assert found == {n: c for n, c in wanted.items() if n != c}
    assert components(df.limit(0)).count() == 0


def test_same_dart_as_often_as_sets_are_similar():
    draw = np.random.default_rng(5)
    for counted in (False, True):
        off = []
        for _ in range(25):
            words = [word(draw) + str(draw.integers(40)) for _ in range(300)]
            other = list(words)
            for at in draw.integers(0, 300, draw.integers(1, 20)):
                other[at] = "other" + str(draw.integers(1000))
            a = minhash.weighted_set(" ".join(words + words[:60] * 3), counted)
            b = minhash.weighted_set(" ".join(other + other[:60]), counted)
            signed = minhash.signatures([a[0], b[0]], [a[1], b[1]])
            off.append((signed[0] == signed[1]).mean() - minhash.similarity(a, b))
        assert abs(np.mean(off)) < 0.03 and np.std(off) < 0.06


def test_signature_does_not_depend_on_its_batch():
    sets = [minhash.weighted_set(prose(n, size), True) for n, size in enumerate((5, 6, 40, 3000, 2))]
    together = minhash.signatures([s[0] for s in sets], [s[1] for s in sets])
    for n, (elements, weights) in enumerate(sets):
        assert (minhash.signatures([elements], [weights])[0] == together[n]).all()


def test_shingles():
    assert len(word_hashes(b"a b aa ab ba b")) == 6 and len(set(word_hashes(b"a b aa ab ba b").tolist())) == 5
    assert (shingles("One  two\nTHREE four five") == shingles("one two three four five")).all()
    assert [len(shingles(t)) for t in (None, "", " \n", "a", "a b c d", "a b c d e f")] == [0, 0, 0, 1, 1, 2]
    assert shingles("a b c d")[0] != shingles("a b c d e")[0]


def true_classes(rows, threshold=0.8):
    def grams(text):
        words = text.lower().split()
        return {tuple(words[n : n + 5]) for n in range(max(1, len(words) - 4))} if words else set()

    held = {}
    for doc, text in rows:
        if doc is not None:
            held.setdefault(doc, []).append((text, grams(text) if text is not None else set()))
    links = []
    for a in held:
        for b in held:
            if a < b and any(
                (t is not None and t == u) or (x and y and len(x & y) >= threshold * len(x | y))
                for t, x in held[a]
                for u, y in held[b]
            ):
                links.append((a, b))
    return united(held, links)


def changed(text, share, seed):
    draw, words = np.random.default_rng(seed), text.split()
    for at in draw.choice(len(words), int(share * len(words)), replace=False):
        words[at] = "changed" + str(draw.integers(10**6))
    return " ".join(words)


def test_classes_of_awkward_and_planted_texts(spark):
    base = prose(7, 250)
    extra = [(100 + n, changed(base, 0.016, n), None, "s", 1) for n in range(25)]
    extra += [(200 + n, base, None, "s", 1) for n in range(20)] + [(300, base.upper(), None, "s", 1)]
    extra += [(400, "one TWO three", None, "s", 1), (401, "", None, "s", 1), (402, None, None, "s", 1), (403, " \n\t ", None, "s", 1)]
    extra += [(500 + n, " ".join(base.split()[:60]) + " " + prose(800 + n, 200), None, "s", 1) for n in range(15)]
    df = documents(spark, extra).withColumn("class_id", F.lit("clash")).withColumn("Group", F.lit(1))
    rows = df.select("doc_id", "text").collect()
    wanted = true_classes([tuple(r) for r in rows])
    found = minhash.near_duplicates(df).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r["class_id"] == (wanted[r["doc_id"]] if r["doc_id"] is not None else None), r
        assert r["kept"] == (r["doc_id"] is None or r["class_id"] == r["doc_id"])
    kept = minhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in kept.collect()) == sorted({*wanted.values(), -1})


def test_no_text_is_lost_under_repeated_or_missing_ids(spark):
    a, b, c, d = (prose(900 + n, 60) for n in range(4))
    given = [(1, a, "x"), (5, a, "x"), (5, b, "x"), (7, b, "x"), (None, c, "x"), (None, c, "x"), (None, c, "y"), (None, d, "x"), (9, d, "x"), (9, d, "x"), (None, None, "x"), (3, None, "x"), (3, None, "x")]
    df = spark.createDataFrame(given, "doc_id long, text string, other string").repartition(3)
    found = sorted(tuple(r) for r in minhash.near_duplicates(df).where("doc_id IS NOT NULL").collect())
    assert found == [(1, 1, True), (3, 3, True), (3, 3, True), (5, 1, False), (5, 5, True), (7, 5, False), (9, 9, True), (9, 9, True)]
    none_ids = sorted(((r["class_id"], r["kept"]) for r in minhash.near_duplicates(df).where("doc_id IS NULL").collect()), key=repr)
    assert none_ids == [(9, False), *[(None, True)] * 4]
    kept = [tuple(r)[:2] for r in minhash.keep_one(df).collect()]
    assert sorted(kept, key=repr) == sorted([(1, a), (5, b), (None, c), (9, d), (None, None), (3, None), (3, None)], key=repr)
    assert {tuple(r) for r in minhash.keep_one(df.repartition(7)).collect()} == {tuple(r) for r in minhash.keep_one(df).collect()}


@pytest.mark.parametrize("name, size", [("BLOCK_BYTES", 20_000), ("BLOCK_TEXTS", 9)])
def test_groups_over_one_block_give_the_same_classes(spark, monkeypatch, name, size):
    base = prose(8, 200)
    rows = [(n, changed(base, 0.015, n)) for n in range(60)] + [(100 + n, prose(100 + n, 50)) for n in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(minhash, name, size)
    found = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(df).collect()}
    assert found == true_classes(rows)


def test_no_documents(spark):
    assert minhash.near_duplicates(none(spark)).count() == 0 and minhash.keep_one(none(spark)).count() == 0


def test_op4_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = {r["doc_id"]: r["class_id"] for r in QUERIES["op4_dart_minhash"](spark, sf_dir).collect()}
    assert found == true_classes(rows)


def cosine_links(rows, threshold):
    links, counts = [], {r[0]: 0 for r in rows}
    usable = [
        (i, label, np.array(v, float))
        for i, v, label in rows
        if v and label is not None and None not in v and np.isfinite(v).all() and any(v)
    ]
    for i, label, v in usable:
        for j, other, w in usable:
            if i < j and label == other and len(v) == len(w):
                if v @ w / np.sqrt((v @ v) * (w @ w)) >= threshold:
                    links.append((i, j))
                    counts[i] += 1
                    counts[j] += 1
    return links, counts


def test_vectors_against_brute_force(spark):
    draw = np.random.default_rng(6)
    rows, base = [], draw.normal(size=(12, 16))
    for n in range(220):
        v = base[n % 12] * draw.uniform(0.1, 9) + draw.normal(size=16) * draw.choice([0.0, 0.05, 0.12, 0.3, 1])
        rows.append((n, [float(np.float32(x)) for x in v], int(n % 3)))
    rows += [(300 + n, rows[4][1], 1) for n in range(6)] + [(400, rows[4][1], 2), (401, rows[4][1], None)]
    rows += [(500, None, 1), (501, [], 1), (502, [0.0] * 16, 1), (503, [1.0, None] + [0.0] * 14, 1), (504, [float("nan")] + [1.0] * 15, 1)]
    rows += [(505, [float("inf")] * 16, 1), (506, [1.0, 2.0, 3.0], 1), (507, [2.0, 4.0, 6.0], 1), (508, [1e-38] * 16, 0), (509, [3e38] * 16, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("pivot", F.lit("clash")).withColumn("n", F.lit(1))
    links, counts = cosine_links([(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()], 0.98)
    wanted = united(counts, links)
    for block in (4096, 16):
        found = vectors.near_duplicates(df, 0.98, block=block).collect()
        assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found} == {
            n: (counts[n], wanted[n], wanted[n] == n) for n in counts
        }
    assert len(links) > 100


def test_repeated_and_missing_vector_ids(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (2, [1.0, 0.01], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = sorted((tuple(r) for r in vectors.near_duplicates(df, 0.98).collect()), key=repr)
    assert found == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (None, 0, None, True)]
    assert vectors.near_duplicates(df.limit(0), 0.98).count() == 0


def test_op10_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    links, counts = cosine_links(rows, 0.98)
    wanted = united(counts, links)
    found = QUERIES["op10_pivot_index"](spark, sf_dir).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found} == {n: (counts[n], wanted[n]) for n in counts}
