"""Language-model scores by context-tree weighting over bytes.

A byte is eight binary decisions; a decision is named by the bits before it in the byte. For
each decision there is a tree of contexts, the last 0 to ``DEPTH`` bytes. A context has a
Krichevsky-Trofimov estimate from its own counts, and its weighted probability is half that
estimate and half the product of those of the contexts one byte longer. The model is learned
once, from all training texts; the probability of a bit then follows a path from the root: at
each context the estimate gets its posterior weight, the rest goes to the longer context. A
longer context that never occurred says nothing, so the path ends at the last one that did.

Nothing of the model is gathered or broadcast whole: counts, contexts and probabilities are
rows keyed by hash or by the last three bytes, and a block of texts gets back the
probabilities of exactly those grams that occur in it.
"""

from __future__ import annotations

from functools import lru_cache
from math import lgamma

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from brightledger.llm.common import fresh_folder, stored
from brightledger.llm.files import load_arrays, save_arrays
from brightledger.llm.shingles import mixed, word_hashes

DEPTH = 5
TRAIN_FOLDS, HELD_OUT_FOLD = 5, 1
# The byte before a text's start and after its end; it occurs in no UTF-8 text.
EDGE = 255
# Last bytes of a context whose subtree one task handles: at most 256**3 grams for DEPTH 5.
STEM = 3
# Text bytes counted at a time, and per part of the hash space.
CHUNK_BYTES = 4 << 20
PART_BYTES = 32 << 20
# Grams whose subtrees are built together, cut between stems.
BATCH_GRAMS = 200_000
# The word hash that stands for a text's end.
END_WORD = np.uint64(0)

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def lowered(text: str | None) -> bytes:
    """The text's UTF-8 bytes with A-Z in lower case; null is empty."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER)


def gram_chunks(raw: bytes):
    """``grams`` of a text, ``CHUNK_BYTES`` at a time."""
    for at in range(0, len(raw) + 1, CHUNK_BYTES):
        # A chunk is read with the bytes before it, whose own grams are left out.
        begin, end = max(0, at - DEPTH), at + CHUNK_BYTES
        found = grams(raw[begin:end])[at - begin :]
        yield found if end > len(raw) else found[:-1]


def grams(raw: bytes) -> np.ndarray:
    """For each byte of a text and its end: the ``DEPTH`` bytes before and the byte itself as
    one number."""
    padded = np.frombuffer(bytes([EDGE]) * DEPTH + raw + bytes([EDGE]), np.uint8)
    size = len(raw) + 1
    found = np.zeros(size, np.uint64)
    for n in range(DEPTH + 1):
        found = (found << np.uint64(8)) | padded[n : n + size]
    return found


def words(raw: bytes) -> np.ndarray:
    """Hashes of the words of a text and of its end."""
    return np.concatenate([word_hashes(raw), [END_WORD]])


def counted(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their weights (1 each if none are given)."""
    if weights is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    if weights is None:
        return keys[first], np.diff(np.concatenate([first, [len(keys)]]))
    return keys[first], np.add.reduceat(weights, first) if len(first) else weights


class Counts:
    """Distinct keys of texts and how often each occurs in training texts (0 for others)."""

    def __init__(self):
        self.keys, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.fresh: list[tuple[np.ndarray, bool]] = []
        self.waiting = 0

    def add(self, keys: np.ndarray, train: bool) -> None:
        self.fresh.append((keys, train))
        self.waiting += len(keys)
        if self.waiting >= CHUNK_BYTES:
            self.settle()

    def settle(self) -> None:
        parts = [(self.keys, self.n)]
        for train in (True, False):
            some = [keys for keys, t in self.fresh if t == train]
            if some:
                keys, n = counted(np.concatenate(some))
                parts.append((keys, n if train else np.zeros(len(n), np.int64)))
        self.fresh, self.waiting = [], 0
        self.keys, self.n = counted(np.concatenate([k for k, _ in parts]), np.concatenate([n for _, n in parts]))


def packed(values: np.ndarray) -> bytes:
    """Ascending keys as differences, compressed."""
    steps = np.diff(values, prepend=np.zeros(1, values.dtype))
    return _squeezed(steps)


def unpacked(data: bytes, size: int) -> np.ndarray:
    return np.cumsum(_stretched(data, size, "<u8"), dtype=np.uint64)


def _squeezed(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values).tobytes(), codec="zstd", asbytes=True)


def _stretched(data: bytes, size: int, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.frombuffer(pa.decompress(data, decompressed_size=size * width, codec="zstd"), kind)


_LOG_GAMMA = np.array([lgamma(n + 0.5) for n in range(4096)])
_LOG_FACTORIAL = np.array([lgamma(n + 1.0) for n in range(4096)])


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series; for x of 100 and more the error is below 1e-13 of the value."""
    return (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3)


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of any order of a zeros and b ones."""

    def half(n):
        return np.where(n < 4096, _LOG_GAMMA[np.minimum(n, 4095)], _log_gamma(np.maximum(n, 4095) + 0.5))

    n = a + b
    whole = np.where(n < 4096, _LOG_FACTORIAL[np.minimum(n, 4095)], _log_gamma(np.maximum(n, 4095) + 1.0))
    return half(a) + half(b) - whole - np.log(np.pi)


def weighted(a, b, longer, deepest: bool):
    """(log of the weighted probability, posterior weight of a context's own estimate);
    ``longer`` is the sum of the logs of the longer contexts."""
    own = log_kt(a, b)
    if deepest:
        return own, np.ones(len(own))
    total = np.logaddexp(own, longer) - np.log(2)
    return total, np.exp(own - np.log(2) - total)


def bit_counts(keys: np.ndarray, n: np.ndarray, depth: int):
    """Decisions of depth ``depth``, (context << 8 | bits before, a leading 1 first), ascending,
    with their counts of zeros and ones."""
    byte, context = (keys & np.uint64(255)).astype(np.int64), (keys >> np.uint64(8)).astype(np.int64)
    context &= (1 << 8 * depth) - 1
    codes, zeros, ones = [], [], []
    for bit in range(8):
        codes.append(context << 8 | (1 << bit) | (byte >> (8 - bit)))
        set_ = (byte >> (7 - bit)) & 1
        zeros.append(np.where(set_ == 0, n, 0))
        ones.append(np.where(set_ == 1, n, 0))
    return grouped(np.concatenate(codes), np.concatenate(zeros), np.concatenate(ones))


def grouped(codes: np.ndarray, *columns: np.ndarray):
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[first], *[np.add.reduceat(c[order], first) for c in columns]


def shortened(codes: np.ndarray, depth: int) -> np.ndarray:
    """Decisions of a longer context as those of depth ``depth``."""
    return (codes >> 8 & ((1 << 8 * depth) - 1)) << 8 | codes & 255


def subtree(keys: np.ndarray, n: np.ndarray) -> dict[int, dict[str, np.ndarray]]:
    """The contexts of ``STEM`` to ``DEPTH`` bytes of all grams of some stems."""
    levels = {}
    code, zeros, ones = bit_counts(keys, n, DEPTH)
    longer = np.zeros(len(code))
    for depth in range(DEPTH, STEM - 1, -1):
        total, weight = weighted(zeros, ones, longer, depth == DEPTH)
        levels[depth] = {"code": code, "zeros": zeros, "ones": ones, "total": total, "weight": weight}
        if depth > STEM:
            code, zeros, ones, longer = grouped(shortened(code, depth - 1), zeros, ones, total)
    return levels


def step_down(known, rest, estimate, weight, seen):
    """The affine form ``known + rest * p`` of a path's probability of a one, where p is that
    of the next longer context, from the form at a context, its estimate and weight, and
    whether the longer context occurred."""
    return (
        np.where(seen, known + rest * weight * estimate, known + rest * estimate),
        np.where(seen, rest * (1 - weight), 0.0),
    )


def log_probabilities(keys: np.ndarray, n: np.ndarray, code: np.ndarray, known: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """log10 of the probability of each gram's byte, for all grams of some stems, from the
    affine forms at the decisions of depth ``STEM``."""
    levels = subtree(keys, n)
    at = np.searchsorted(code, levels[STEM]["code"])
    known, rest = known[at], rest[at]
    for depth in range(STEM, DEPTH):
        level, below = levels[depth], levels[depth + 1]
        up = np.searchsorted(level["code"], shortened(below["code"], depth))
        count = level["zeros"] + level["ones"]
        estimate = (level["ones"] + 0.5) / (count + 1)
        seen = below["zeros"] + below["ones"] > 0
        known, rest = step_down(known[up], rest[up], estimate[up], level["weight"][up], seen)
    last = levels[DEPTH]
    one = known + rest * (last["ones"] + 0.5) / (last["zeros"] + last["ones"] + 1)
    byte, context = (keys & np.uint64(255)).astype(np.int64), (keys >> np.uint64(8)).astype(np.int64)
    total = np.zeros(len(keys))
    for bit in range(8):
        p = one[np.searchsorted(last["code"], context << 8 | (1 << bit) | (byte >> (8 - bit)))]
        total += np.log10(np.where((byte >> (7 - bit)) & 1 == 1, p, 1 - p))
    return total


def _stems(batches, columns):
    """Cuts rows sorted by stem into pieces of whole stems, ``BATCH_GRAMS`` rows or more."""
    held, size = [], 0
    for batch in batches:
        held.append([batch.column(c).to_numpy(zero_copy_only=False) for c in columns])
        size += batch.num_rows
        if size >= BATCH_GRAMS:
            rows = [np.concatenate(c) for c in zip(*held)]
            cut = int(np.searchsorted(rows[0], rows[0][-1]))
            if cut:
                yield [r[:cut] for r in rows]
            held, size = [[r[cut:] for r in rows]], len(rows[0]) - cut
    if size:
        yield [np.concatenate(c) for c in zip(*held)]


def _counted_blocks(parts: int):
    """Rows (block, kind, part, size, keys, n) of the distinct words and grams of each block."""

    def flush(block, found):
        for kind, counts in found.items():
            counts.settle()
            part = (mixed(counts.keys, 7) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            cuts = np.flatnonzero(np.diff(part[order], prepend=-1, append=parts))
            for begin, end in zip(cuts[:-1], cuts[1:]):
                p, here = part[order[begin]], order[begin:end]
                keys, n = counts.keys[here], counts.n[here]
                yield {"block": block, "kind": kind, "part": int(p), "size": len(keys), "keys": packed(keys), "n": _squeezed(n.astype("<u4"))}

    def count(batches):
        block, found = None, None
        for batch in batches:
            for own, train, text in zip(*[batch.column(c) for c in ("block", "train", "text")]):
                if own.as_py() != block:
                    if found:
                        yield from (pa.RecordBatch.from_pylist([r], _COUNTED) for r in flush(block, found))
                    block, found = own.as_py(), {"word": Counts(), "gram": Counts()}
                raw = lowered(text.as_py())
                found["word"].add(words(raw), train.as_py())
                for chunk in gram_chunks(raw):
                    found["gram"].add(chunk, train.as_py())
        if found:
            yield from (pa.RecordBatch.from_pylist([r], _COUNTED) for r in flush(block, found))

    return count


_COUNTED = pa.schema(
    [("block", pa.int64()), ("kind", pa.string()), ("part", pa.int64()), ("size", pa.int64()), ("keys", pa.binary()), ("n", pa.binary())]
)
_COUNTED_DDL = "block long, kind string, part long, size long, keys binary, n binary"


def _merged(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    held = []
    for size, k, c in zip(*[table[c].to_pylist() for c in ("size", "keys", "n")]):
        held.append((unpacked(k, size), _stretched(c, size, "<u4").astype(np.int64)))
        if sum(len(x) for x, _ in held) >= 1 << 20:
            keys, n = counted(np.concatenate([keys, *[x for x, _ in held]]), np.concatenate([n, *[x for _, x in held]]))
            held = []
    return counted(np.concatenate([keys, *[x for x, _ in held]]), np.concatenate([n, *[x for _, x in held]]))


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def score(documents: DataFrame) -> DataFrame:
    """One row per row of ``documents`` (doc_id, text, ``train`` boolean): doc_id, ``train``,
    ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` and
    ``bits_per_byte``, the model's code length.

    The model learns from the rows with ``train``; every text is scored by it, its end
    included, A-Z in lower case. Words are what lies between white space, the end is one more;
    the base score is that of smoothed word counts. A null text is empty and has its end
    alone; a null ``train`` is false; repeated rows count each time; other columns are ignored;
    texts are read whole, of any length. Without training rows every bit has probability one
    half and no token is known; an empty table gives no rows.

    The texts are stored once, each task's rows as a block. A block sends its distinct words and
    grams with their training counts, packed by parts of the hash space; what it sends follows
    its length. Counts are merged per part, contexts are built per stem, and every block gets a
    file with the counts and probabilities of its own words and grams.
    """
    spark = documents.sparkSession
    given = documents.select("doc_id", F.coalesce("train", F.lit(False)).alias("train"), "text")
    texts = stored(given.withColumn("block", F.spark_partition_id().cast("long")), "texts")
    total = texts.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1)).first()[0] or 0
    parts = max(1, -(-total // PART_BYTES))
    sent = stored(texts.select("block", "train", "text").mapInArrow(_counted_blocks(parts), _COUNTED_DDL), "counts")

    def word_counts(key: tuple, table: pa.Table) -> pa.Table:
        keys, n = _merged(table)
        answers = []
        for size, k in zip(table["size"].to_pylist(), table["keys"].to_pylist()):
            answers.append(_squeezed(n[np.searchsorted(keys, unpacked(k, size))].astype("<i8")))
        rows = len(answers)
        columns = [table[c] for c in ("block", "kind", "part", "size", "keys")]
        return pa.table([*columns, pa.array(answers, pa.binary()), pa.array([int((n > 0).sum())] * rows, pa.int64()), pa.array([int(n.sum())] * rows, pa.int64())], names=[*_ANSWER, "distinct", "tokens"])

    answered = "block long, kind string, part long, size long, keys binary, answer binary"
    sent_words, sent_grams = sent.where("kind = 'word'"), sent.where("kind = 'gram'")
    word_answers = stored(sent_words.groupBy("part").applyInArrow(word_counts, f"{answered}, distinct long, tokens long"), "word-answers")
    of_parts = word_answers.groupBy("part").agg(F.first("distinct").alias("distinct"), F.first("tokens").alias("tokens"))
    distinct, tokens = of_parts.agg(F.coalesce(F.sum("distinct"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0))).first()

    probabilities = _gram_probabilities(sent_grams)

    def gram_answers(key: tuple, requests: pa.Table, known: pa.Table) -> pa.Table:
        keys = known["gram"].to_numpy().view(np.uint64)
        order = np.argsort(keys)
        keys, value = keys[order], known["log10"].to_numpy()[order]
        answers = []
        for size, k in zip(requests["size"].to_pylist(), requests["keys"].to_pylist()):
            answers.append(_squeezed(value[np.searchsorted(keys, unpacked(k, size))].astype("<f4")))
        return pa.table([*[requests[c] for c in ("block", "kind", "part", "size", "keys")], pa.array(answers, pa.binary())], names=_ANSWER)

    answers = sent_grams.groupBy("part").cogroup(probabilities.groupBy("part")).applyInArrow(gram_answers, answered)
    folder = fresh_folder(spark, "block-answers")

    def write(key: tuple, table: pa.Table) -> pa.Table:
        block, arrays = key[0].as_py(), {}
        for kind, width in (("word", "<i8"), ("gram", "<f4")):
            rows = [r for r in table.select(["kind", "size", "keys", "answer"]).to_pylist() if r["kind"] == kind]
            keys = np.concatenate([unpacked(r["keys"], r["size"]) for r in rows])
            order = np.argsort(keys)
            arrays[kind], arrays[f"{kind}_answer"] = keys[order], np.concatenate([_stretched(r["answer"], r["size"], width) for r in rows])[order]
        save_arrays(folder, f"{block}.npz", **arrays)
        return pa.table({"block": [block]})

    both = word_answers.select(*_ANSWER).union(answers.select(*_ANSWER))
    stored(both.groupBy("block").applyInArrow(write, "block long"), "answered")
    return _scored(texts, folder, distinct, tokens)


_ANSWER = ["block", "kind", "part", "size", "keys", "answer"]


def _gram_probabilities(sent: DataFrame) -> DataFrame:
    """(part, gram, log10): the log probability of every distinct gram."""

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        keys, n = _merged(table)
        return pa.table({"part": pa.array(np.full(len(keys), key[0].as_py())), "gram": _signed(keys), "n": n})

    counts = stored(sent.groupBy("part").applyInArrow(merge, "part long, gram long, n long"), "gram-counts")
    stem = F.shiftright("gram", 8).bitwiseAND(F.lit((1 << 8 * STEM) - 1))
    by_stem = counts.withColumn("stem", stem)

    def stems(batches):
        for rows in _stems(batches, ("stem", "gram", "n")):
            level = subtree(rows[1].view(np.uint64), rows[2])[STEM]
            yield pa.RecordBatch.from_pydict({c: level[c] for c in ("code", "zeros", "ones", "total", "weight")})

    fields = "code long, zeros long, ones long, total double, weight double"
    sorted_ = by_stem.select("stem", "gram", "n").repartition("stem").sortWithinPartitions("stem")
    levels = {STEM: stored(sorted_.mapInArrow(stems, fields), f"contexts-{STEM}")}

    def own(batches):
        for batch in batches:
            zeros, ones, longer = (batch.column(c).to_numpy() for c in ("zeros", "ones", "longer"))
            total, weight = weighted(zeros, ones, longer, False)
            yield pa.RecordBatch.from_pydict({"code": batch.column("code"), "zeros": zeros, "ones": ones, "total": total, "weight": weight})

    def shorter(depth: int):
        return F.shiftleft(F.shiftright("code", 8).bitwiseAND(F.lit((1 << 8 * depth) - 1)), 8) + F.col("code").bitwiseAND(F.lit(255))

    for depth in range(STEM - 1, -1, -1):
        summed = levels[depth + 1].groupBy(shorter(depth).alias("code")).agg(
            F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("total").alias("longer")
        )
        levels[depth] = stored(summed.mapInArrow(own, fields), f"contexts-{depth}")

    seen = F.col("zeros") + F.col("ones") > 0
    # Where not even the empty context decided this bit, it is one or not with equal chance.
    forms = levels[0].select("*", F.when(seen, 0.0).otherwise(0.5).alias("known"), F.when(seen, 1.0).otherwise(0.0).alias("rest"))
    for depth in range(STEM):
        estimate = (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1)
        above = forms.select(
            F.col("code").alias("up"), F.col("known").alias("k"), F.col("rest").alias("r"), estimate.alias("e"), F.col("weight").alias("w")
        )
        below = levels[depth + 1].withColumn("up", shorter(depth)).join(above, "up")
        forms = below.select(
            "code", "zeros", "ones", "weight",
            F.expr("CASE WHEN zeros + ones > 0 THEN k + r * w * e ELSE k + r * e END").alias("known"),
            F.expr("CASE WHEN zeros + ones > 0 THEN r * (1 - w) ELSE 0D END").alias("rest"),
        )
    at_stem = forms.select(
        F.shiftright("code", 8).alias("stem"), F.lit(None).cast("long").alias("part"), F.col("code").alias("gram"), F.lit(-1).cast("long").alias("n"), "known", "rest"
    )
    nothing = F.lit(0.0)
    rows = by_stem.select("stem", "part", "gram", "n", nothing.alias("known"), nothing.alias("rest")).union(at_stem)

    def probabilities(batches):
        for stem, part, gram, n, known, rest in _stems(batches, ("stem", "part", "gram", "n", "known", "rest")):
            form = n < 0
            order = np.argsort(gram[form])
            code, a, b = (c[form][order] for c in (gram, known, rest))
            keys = gram[~form]
            found = log_probabilities(keys.view(np.uint64), n[~form], code, a, b)
            yield pa.RecordBatch.from_pydict({"part": part[~form].astype(np.int64), "gram": keys, "log10": found})

    dealt = rows.repartition("stem").sortWithinPartitions("stem")
    return dealt.mapInArrow(probabilities, "part long, gram long, log10 double")


@lru_cache(maxsize=1)
def _answers(folder: str, block: int) -> dict[str, np.ndarray]:
    return load_arrays(folder, f"{block}.npz")


def _scored(texts: DataFrame, folder: str, distinct: int, tokens: int) -> DataFrame:
    fields = "doc_id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"

    def of_text(raw: bytes, known: dict[str, np.ndarray]) -> tuple:
        keys, n = counted(words(raw))
        c = known["word_answer"][np.searchsorted(known["word"], keys)]
        base = float(n @ np.log10((c + 0.5) / (tokens + 0.5 * (distinct + 1))))
        total = 0.0
        for found in gram_chunks(raw):
            keys, times = counted(found)
            total += float(times @ known["gram_answer"][np.searchsorted(known["gram"], keys)].astype(np.float64))
        return int(n.sum()), int(n[c > 0].sum()), base, total

    def scored(batches):
        for batch in batches:
            rows = []
            for block, text in zip(batch.column("block"), batch.column("text")):
                raw = lowered(text.as_py())
                n, known, base, total = of_text(raw, _answers(folder, block.as_py()))
                rows.append((n, known, tokens, base, total, -total / np.log10(2) / (len(raw) + 1)))
            made = [pa.array(c) for c in zip(*rows)] if rows else [pa.array([], t) for t in (pa.int64(),) * 3 + (pa.float64(),) * 3]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("train"), *made], [f.split()[0] for f in fields.split(", ")])

    return texts.mapInArrow(scored, fields)
