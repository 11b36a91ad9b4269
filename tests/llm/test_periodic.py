"""Periodic runs against a scan of every period."""

import hashlib
import re
from fractions import Fraction
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from brightledger.llm import periodic
from brightledger.llm.queries import QUERIES

from .cases import documents, none

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words):
    """Every period on its own; a stretch counts under the least period that gives it."""
    found, ids = {}, np.unique(words, return_inverse=True)[1] if len(words) else np.zeros(0, int)
    for period in range(1, len(words) // 3 + 1):
        same = np.concatenate([[0], (ids[period:] == ids[:-period]).astype(np.int8), [0]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if end - start + period >= max(24, 3 * period):
                found.setdefault((start, end - start + period), period)
    return sorted((start, length, period) for (start, length), period in found.items())


def plain_row(doc_id, text):
    words = WORD.findall(text or "")
    h, n = crc32(str(doc_id).encode()), len(words)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    left = [w for i, w in enumerate(words) if not any(s + p <= i < s + length for s, length, p in runs)]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *four, sha("".join(f"{s},{length},{p}\n" for s, length, p in runs)), sha(" ".join(left)))


def test_runs_of_random_words_against_a_scan():
    draw = np.random.default_rng(5)
    for _ in range(400):
        words = draw.integers(0, draw.integers(1, 4), draw.integers(0, 160))
        for _ in range(draw.integers(0, 3)):
            if len(words) > 30:
                start, period = draw.integers(0, len(words) - 25), draw.integers(1, 12)
                end = draw.integers(start + 20, len(words) + 1)
                words[start:end] = words[start + np.arange(end - start) % period]
        assert periodic.runs(words.astype(np.int64)) == plain_runs(words.tolist())


@pytest.mark.parametrize("period", [1, 7, 999])
def test_long_runs_and_many_left_words(period):
    assert periodic.runs(np.arange(3000) % period) == [(0, 3000, period)]
    # The same short run after another word each time: one run a block, at every depth.
    blocks = [[0, 1] * 13 + [word] for word in range(2, 200)]
    assert periodic.runs(np.array(sum(blocks, []))) == [(27 * n, 26, 2) for n in range(198)]


def test_query_against_plain_rows(spark, sf_dir, tmp_path):
    spark.read.parquet(f"{sf_dir}/documents.parquet").createOrReplaceTempView("sf_documents")
    line = "a line that comes again and again\n"
    extra = [(30, line * 9 + "x" + line * 4, "aa", "s", 1), (31, "a " * 50, None, None, 1), (32, "é\x0bü\x0c" * 30, "aa", "s", 1), (33, "a\xa0b " * 23, "aa", "s", 1)]
    documents(spark, extra).write.parquet(str(tmp_path / "documents.parquet"))
    for folder in (sf_dir, str(tmp_path)):
        given = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
        found = [tuple(r) for r in QUERIES["op13_periodic_runs"](spark, folder).collect()]
        assert sorted(found, key=repr) == sorted((plain_row(*r) for r in given), key=repr)


def test_awkward_tables(spark):
    df = documents(spark, [(30, "on and " * 20, "aa", "s", 1)])
    for clash in ("RUNS", "collapsed", "start"):
        df = df.withColumn(clash, F.lit("clash"))
    made = periodic.periodic_runs(df)
    assert made.columns == [*documents(spark).columns, "start", "runs", "strongest_run", "collapsed"]
    rows = {r["doc_id"]: r for r in made.collect()}
    assert rows[30]["collapsed"] == "on and" and tuple(rows[30]["strongest_run"]) == (0, 40, 2)
    assert rows[21]["collapsed"] == rows[22]["collapsed"] == rows[23]["collapsed"] == "" and rows[21]["runs"] == []
    assert rows[21]["strongest_run"] is None and made.count() == df.count()
    assert periodic.periodic_runs(none(spark)).collect() == []
