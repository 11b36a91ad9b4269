import re
from collections import Counter, defaultdict
from math import exp, lgamma, log, log10, pi

import numpy as np
import pytest
from pyspark.sql import functions as F

from brightledger.llm import contexttree as ct
from brightledger.llm.queries import QUERIES

from .cases import documents, none


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


class Tree:
    """The same model, one decision at a time."""

    def __init__(self, texts):
        self.counts, self.longer, self.done = defaultdict(lambda: [0, 0]), defaultdict(set), {}
        for text in texts:
            for node, bit, context in self.decisions(text):
                for depth in range(ct.DEPTH + 1):
                    own = context[ct.DEPTH - depth :]
                    self.counts[node, own][bit] += 1
                    if depth < ct.DEPTH:
                        self.longer[node, own].add(context[ct.DEPTH - depth - 1 :])

    @staticmethod
    def decisions(text):
        raw = b"\xff" * ct.DEPTH + lower(text).encode() + b"\xff"
        for at in range(ct.DEPTH, len(raw)):
            for bit in range(8):
                yield (1 << bit) | (raw[at] >> (8 - bit)), raw[at] >> (7 - bit) & 1, raw[at - ct.DEPTH : at]

    def own(self, node, context):
        a, b = self.counts[node, context]
        return lgamma(a + 0.5) + lgamma(b + 0.5) - lgamma(a + b + 1) - log(pi)

    def total(self, node, context):
        if (node, context) not in self.done:
            own = self.own(node, context)
            if len(context) < ct.DEPTH:
                own = np.logaddexp(own, sum(self.total(node, c) for c in self.longer[node, context])) - log(2)
            self.done[node, context] = own
        return self.done[node, context]

    def one(self, node, context, depth=0):
        own = context[ct.DEPTH - depth :]
        if (node, own) not in self.counts:
            return 0.5
        a, b = self.counts[node, own]
        estimate = (b + 0.5) / (a + b + 1)
        if depth == ct.DEPTH or (node, context[ct.DEPTH - depth - 1 :]) not in self.counts:
            return estimate
        weight = exp(self.own(node, own) - log(2) - self.total(node, own))
        return weight * estimate + (1 - weight) * self.one(node, context, depth + 1)

    def score(self, text):
        return sum(log10(p if bit else 1 - p) for node, bit, context in self.decisions(text) for p in [self.one(node, context)])


def check(rows, given):
    """Every figure against the plain model, for rows of (doc_id, train, text)."""
    tokens = {n: re.findall(r"[^\x20\x09-\x0D]+", lower(t)) + [None] for n, (_, _, t) in enumerate(given)}
    known = Counter(w for n, (_, train, _) in enumerate(given) if train for w in tokens[n])
    total, distinct = sum(known.values()), len(known)
    tree = Tree([t for _, train, t in given if train])
    wanted = []
    for n, (doc, train, text) in enumerate(given):
        base = sum(log10((known[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in tokens[n])
        wanted.append((doc, bool(train), len(tokens[n]), sum(known[w] > 0 for w in tokens[n]), total, base, tree.score(text)))
    found = [tuple(r)[:7] for r in rows]
    key = lambda r: (repr(r[:5]), r[5], r[6])
    for a, b in zip(sorted(found, key=key), sorted(wanted, key=key), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9) and a[6] == pytest.approx(b[6], rel=1e-6)


def some(spark):
    rows = [(n, bool(n % 4), t) for n, t in enumerate(["The cat sat.", "the Cat ran  away\n", "a dog", "", "É 漢字 déjà", "the cat sat.", "zq\x1c\x85 x"])]
    rows += [(20, True, None), (21, None, "the dog sat"), (None, True, "no id"), (22, False, "unseen ☃ words"), (22, False, "unseen ☃ words")]
    return spark.createDataFrame(rows, "doc_id long, train boolean, text string")


def test_against_the_plain_model(spark):
    df = some(spark).withColumn("block", F.lit("clash")).withColumn("Score", F.lit(1)).repartition(3)
    check(ct.score(df).collect(), [(r["doc_id"], r["train"], r["text"]) for r in df.collect()])


def test_small_parts_chunks_and_batches_change_nothing(spark, monkeypatch):
    for name, size in (("PART_BYTES", 40), ("CHUNK_BYTES", 7), ("BATCH_GRAMS", 5)):
        monkeypatch.setattr(ct, name, size)
    df = some(spark).repartition(2)
    check(ct.score(df).collect(), [(r["doc_id"], r["train"], r["text"]) for r in df.collect()])


def test_long_and_empty_texts_nothing_to_learn_and_no_rows(spark):
    df = documents(spark).withColumn("train", F.lit(False))
    rows = ct.score(df).collect()
    assert len(rows) == df.count() and {(r["n_known"], r["train_tokens"]) for r in rows} == {(0, 0)}
    assert all(r["bits_per_byte"] == pytest.approx(8) for r in rows)
    assert ct.score(none(spark).withColumn("train", F.lit(True))).count() == 0


def test_estimates_agree_with_log_gamma():
    for a, b in ((0, 0), (1, 0), (3, 9), (4095, 1), (5000, 70_000), (10**9, 3)):
        exact = lgamma(a + 0.5) + lgamma(b + 0.5) - lgamma(a + b + 1) - log(pi)
        assert ct.log_kt(np.array([a]), np.array([b]))[0] == pytest.approx(exact, rel=1e-9, abs=1e-9)


def test_packing_of_keys():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**63, 1000).astype(np.uint64) * 2)
    assert (ct.unpacked(ct.packed(keys), len(keys)) == keys).all()


def test_op3_query_beats_the_word_model_on_held_out_text(spark):
    rows = QUERIES["op3_context_tree"](spark, "/root/testdata/sf0.1").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == 10_000 and 1000 < len(held) < 4000
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert all(r["score"] < 0 and 0 < r["bits_per_byte"] < 8 for r in rows)
