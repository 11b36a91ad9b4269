"""Language identification of texts that may mix languages.

Every language has a smoothed distribution over hashed byte trigrams. A text is a mixture of
languages: expectation-maximisation estimates their proportions from the likelihoods of its
trigrams, and the set of languages is the one with the best penalised likelihood.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from brightledger.llm.common import fold

HASH_BITS = 16
# Languages that a task counts before it hands its counts on.
COUNTED_TOGETHER = 64
SMOOTHING = 0.5
STEPS = 30
CONVERGED = 1e-4
PENALTY = 1.0
# Trigrams of one text overlap, so their likelihoods are not independent evidence.
OVERLAP = 3.0
FOLDS, HELD_OUT_FOLD = 4, 2
SLICE = 1 << 22
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
# Bytes 0..127 that are no letter count as one blank.
_CLASSES = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], np.uint32)


def trigram_counts(text: str) -> np.ndarray:
    """Counts of the hashed trigrams of the lower-case UTF-8 bytes of a whole text, with
    runs of non-letters as one blank. The bytes are taken in slices, each of which begins with
    the last two signs of the one before, so the counts are those of the text in one piece."""
    counts = np.zeros(1 << HASH_BITS, np.int64)
    raw = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)
    held, end = np.full(1, 32, np.uint32), np.full(1, 32, np.uint32)
    for at in range(0, len(raw) + 1, SLICE):
        last = at + SLICE > len(raw)
        classes = np.concatenate([held, _CLASSES[raw[at : at + SLICE]], end[:last]])
        classes = classes[np.concatenate([[True], (classes[1:] != 32) | (classes[:-1] != 32)])]
        grams = (classes[:-2] << np.uint32(16)) | (classes[1:-1] << np.uint32(8)) | classes[2:]
        hashed = (grams * np.uint32(0x9E3779B1)) >> np.uint32(32 - HASH_BITS)
        counts += np.bincount(hashed, minlength=1 << HASH_BITS)
        held = classes[-2:]
    return counts


@dataclass(frozen=True)
class LanguageModel:
    """Likelihoods of hashed trigrams by language, as far as a language has them: those of
    gram g are the entries from ``first[g]`` to ``first[g + 1]``; all others of a language have
    its ``least``. So a model grows with the grams that labels really have, and there may be
    any number of labels."""

    languages: tuple[str, ...]
    least: np.ndarray
    first: np.ndarray
    language: np.ndarray
    likelihood: np.ndarray

    @classmethod
    def over(cls, languages: list[str], grams: list[np.ndarray], counts: list[np.ndarray]) -> "LanguageModel":
        totals = np.array([c.sum() + SMOOTHING * (1 << HASH_BITS) for c in counts])
        gram = np.concatenate([*grams, np.zeros(0, np.int64)]).astype(np.int64)
        owner = np.repeat(np.arange(len(languages)), [len(g) for g in grams]).astype(np.int32)
        value = (np.concatenate([*counts, np.zeros(0)]) + SMOOTHING) / totals[owner]
        order = np.argsort(gram, kind="stable")
        first = np.concatenate([[0], np.cumsum(np.bincount(gram, minlength=1 << HASH_BITS))])
        return cls(tuple(languages), SMOOTHING / totals, first, owner[order], value[order])

    def likelihoods(self, seen: np.ndarray) -> np.ndarray:
        """Languages x the grams asked for."""
        low, high = self.first[seen], self.first[seen + 1]
        sizes = high - low
        at = np.repeat(high - np.cumsum(sizes), sizes) + np.arange(sizes.sum())
        given = np.repeat(self.least[:, None], len(seen), axis=1)
        given[self.language[at], np.repeat(np.arange(len(seen)), sizes)] = self.likelihood[at]
        return given

    def mixture(self, counts: np.ndarray) -> tuple[list[str], np.ndarray]:
        """The chosen languages of a text, by falling share, and their shares.

        Sets are grown in the order of the shares that all languages together get; a set is
        charged ``PENALTY * log(n)`` for each language, n the text's trigrams. No set fits
        better than all languages, so growing stops once that bound cannot pay for another.
        """
        seen = np.flatnonzero(counts)
        weights = counts[seen] / OVERLAP
        total, given = weights.sum(), self.likelihoods(seen)
        charge = PENALTY * np.log(max(2.0, total))
        shares, limit = expectation_maximisation(given, weights)
        alone = np.log(given) @ weights
        order = np.argsort(-shares, kind="stable")
        best = int(np.argmax(alone))
        order = np.concatenate([[best], order[order != best]])
        chosen, chosen_shares, reached = order[:1], np.ones(1), alone[best]
        for size in range(2, len(order) + 1):
            if limit - charge * size <= reached - charge * len(chosen):
                break
            some, fit = expectation_maximisation(given[order[:size]], weights)
            if fit - charge * size > reached - charge * len(chosen):
                chosen, chosen_shares, reached = order[:size], some, fit
        by_share = np.argsort(-chosen_shares, kind="stable")
        return [self.languages[i] for i in chosen[by_share]], chosen_shares[by_share]


def expectation_maximisation(given: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, float]:
    """Shares of the rows of ``given`` (likelihoods of each gram) and the log likelihood."""
    shares, total = np.full(len(given), 1 / len(given)), weights.sum()
    for _ in range(STEPS):
        mixed = shares @ given
        new = shares * (given @ (weights / mixed)) / total
        moved = np.abs(new - shares).max()
        shares = new
        if moved < CONVERGED:
            break
    return shares, float(np.log(shares @ given) @ weights)


def learn(documents: DataFrame, text: Column, lang: Column) -> LanguageModel:
    """A model of every language of the rows whose text and language are not null.

    Counts cover whole texts of all those rows. A task counts into one table per language and
    hands the tables on when there are ``COUNTED_TOGETHER`` of them, so its memory is bounded;
    what is shuffled and gathered are the grams that a language really has, 2**HASH_BITS of
    each at most, whatever the size of the input.
    """

    def handed_on(tables: dict[str, np.ndarray]):
        for name, table in tables.items():
            seen = np.flatnonzero(table)
            yield pa.RecordBatch.from_pydict({"lang": [name] * len(seen), "gram": seen.astype("int32"), "n": table[seen]})

    def counted(batches):
        tables: dict[str, np.ndarray] = {}
        for batch in batches:
            for value, name in zip(batch.column("text"), batch.column("lang").to_pylist()):
                if name not in tables:
                    if len(tables) == COUNTED_TOGETHER:
                        yield from handed_on(tables)
                        tables = {}
                    tables[name] = np.zeros(1 << HASH_BITS, np.int64)
                tables[name] += trigram_counts(value.as_py())
        yield from handed_on(tables)

    rows = documents.select(text.alias("text"), lang.alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    sums = (
        rows.mapInArrow(counted, "lang string, gram int, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .groupBy("lang")
        .agg(F.collect_list("gram").alias("grams"), F.collect_list("n").alias("ns"))
    )
    found = sums.orderBy("lang").toArrow()
    grams, counts = ([list_.values.to_numpy() for list_ in found.column(name)] for name in ("grams", "ns"))
    return LanguageModel.over(found.column("lang").to_pylist(), grams, counts)


def identify(documents: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``documents`` with a struct ``language`` of ``pred``, ``score`` and the ``mixture``, a
    list of (lang, share) by falling share.

    Only the text decides. ``pred`` is the language with the largest share and ``score`` that
    share. A null text, a text without any letter, and any text if no language was learned,
    are ``und`` with score 0 and an empty mixture. Whole texts are read, of any length;
    repeated rows stay; ties go to the language that sorts first; a column ``language`` of
    the input is replaced; an empty table gives no rows.
    """
    names = [c for c in documents.columns if c.lower() != "language"]
    kind = pa.struct(
        [("pred", pa.string()), ("score", pa.float64()), ("mixture", pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())])))]
    )
    shared = documents.sparkSession.sparkContext.broadcast(model)
    unknown = {"pred": UNKNOWN, "score": 0.0, "mixture": []}

    def of_text(value: str | None) -> dict:
        if value is None or not shared.value.languages or not _LETTER.search(value):
            return unknown
        languages, shares = shared.value.mixture(trigram_counts(value))
        shares = np.clip(shares, 0, 1)
        return {"pred": languages[0], "score": float(shares[0]), "mixture": [{"lang": n, "share": float(s)} for n, s in zip(languages, shares)]}

    def predicted(batches):
        for batch in batches:
            found = pa.array([of_text(value.as_py()) for value in batch.column(batch.schema.get_field_index(text))], kind)
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], found], [*names, "language"])

    fields = ", ".join(f"`{n}` {t}" for n, t in documents.dtypes if n in names)
    added = "language struct<pred: string, score: double, mixture: array<struct<lang: string, share: double>>>"
    return documents.mapInArrow(predicted, f"{fields}, {added}" if fields else added)


def held_out(doc_id: Column) -> Column:
    return fold(doc_id, FOLDS) == HELD_OUT_FOLD


def learn_from_folds(documents: DataFrame) -> LanguageModel:
    """A model from the labelled documents that are not held out."""
    return learn(documents.where(~held_out(F.col("doc_id"))), F.col("text"), F.col("lang"))
