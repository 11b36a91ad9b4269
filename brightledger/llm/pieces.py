"""Greedy word-piece lengths in one pass over each word.

The vocabulary is a trie. Every node has a failure link and the number of tokens that are
popped on the way along it, so a text's token count follows from one walk over its
characters, without cutting or naming a piece.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from brightledger.llm.ids import Kept, byte_letters

_BLANKS = re.compile(r"[ \t\n\r\f\v]+")
END_MARK = "</w>"
# Added to the code of a word's last letter, so that it is a symbol of its own.
LAST = 0x10000


class PieceCounter:
    """Counts the pieces that greedy longest match would cut a word into.

    ``follow[node]`` is the node's children by character, ``fail[node]`` where a walk that
    cannot go on continues (-1: nowhere) and ``pops[node]`` the pieces cut off on that way.
    For a node that spells a piece the whole string is popped and the walk continues at the
    root; for any other node its parent's link is followed until the last character fits,
    and the pops of all links passed add up.
    """

    def __init__(self, vocabulary: list[str]):
        self.follow: list[dict[str, int]] = [{}]
        whole, parent, letter = [False], [-1], [""]
        for piece in vocabulary:
            node = 0
            for c in piece:
                child = self.follow[node].get(c)
                if child is None:
                    child = self.follow[node][c] = len(whole)
                    self.follow.append({})
                    whole.append(False)
                    parent.append(node)
                    letter.append(c)
                node = child
            whole[node] = node > 0
        self.fail, self.pops = [-1] * len(whole), [0] * len(whole)
        level = list(self.follow[0].values())
        while level:
            for node in level:
                if whole[node]:
                    self.fail[node], self.pops[node] = 0, 1
                    continue
                back, popped = self.fail[parent[node]], self.pops[parent[node]]
                while back >= 0 and letter[node] not in self.follow[back]:
                    popped += self.pops[back]
                    back = self.fail[back]
                if back >= 0:
                    self.fail[node], self.pops[node] = self.follow[back][letter[node]], popped
            level = [child for node in level for child in self.follow[node].values()]
        self.kept = Kept()

    def count(self, symbols: str) -> int | None:
        """Pieces of one word; None if greedy matching gets stuck."""
        follow, fail, pops = self.follow, self.fail, self.pops
        node = total = 0
        for c in symbols:
            step = follow[node].get(c)
            while step is None:
                total += pops[node]
                node = fail[node]
                if node < 0:
                    return None
                step = follow[node].get(c)
            node = step
        while node > 0:
            total += pops[node]
            node = fail[node]
        return total if node == 0 else None


def vocabulary_pieces(vocabulary) -> list[str]:
    """The strings of a vocabulary without the mark of a word's end."""
    return [piece.removesuffix(END_MARK) or piece for piece in vocabulary]


def last_marked(word: str) -> str:
    """The letters of a word, the last one as the symbol that stands for a word's last letter."""
    return word[:-1] + chr(ord(word[-1]) + LAST)


def ending_pieces(vocabulary) -> list[str]:
    """The strings of a vocabulary, those with the mark of a word's end with its last letter
    marked: they fit nowhere but at the end of a word, and the others everywhere else."""
    bare = lambda piece: piece.removesuffix(END_MARK)
    return [last_marked(bare(piece)) if piece.endswith(END_MARK) and bare(piece) else piece for piece in vocabulary]


@lru_cache(maxsize=2)
def counter(path: str, word_ends: bool = False) -> tuple[PieceCounter, dict[int, str], bool]:
    """The counter, the letters of bytes, and whether words come with their last letter marked."""
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    word_ends = word_ends and any(piece.endswith(END_MARK) for piece in vocabulary)
    return PieceCounter((ending_pieces if word_ends else vocabulary_pieces)(vocabulary)), byte_letters(), word_ends


def count_tokens(texts: DataFrame, text: str, path: str, word_ends: bool = False) -> DataFrame:
    """The rows of ``texts`` with a struct ``counts`` of n_words, n_tokens, n_unknown.

    Words are what lies between white space, in lower case; a word's pieces are those of
    greedy longest match over its bytes from the first on, in the vocabulary file at
    ``path``. With ``word_ends`` a piece that carries the mark of a word's end fits only there
    and a piece without it only before; a vocabulary without such marks is taken as it is.
    Otherwise the marks are left off and any piece fits anywhere. A word in which greedy
    matching gets stuck counts as one token and as unknown. Null and empty texts have zeros; texts of any
    length are read whole; repeated rows stay; an existing column ``counts`` is replaced.
    """
    schema = T.StructType(
        [f for f in texts.schema.fields if f.name.lower() != "counts"]
        + [T.StructField("counts", T.StructType([T.StructField(n, T.LongType()) for n in ("n_words", "n_tokens", "n_unknown")]))]
    )

    def of_text(value: str | None) -> dict[str, int]:
        pieces, letters, marked = counter(path, word_ends)
        new, words, tokens, unknown = pieces.kept.new, 0, 0, 0

        def counted(word: str) -> int | None:
            lower = word.lower()
            symbols = lower if lower.isascii() and lower.isprintable() else "".join([letters[b] for b in lower.encode("utf-8", "surrogatepass")])
            return pieces.count(last_marked(symbols) if marked else symbols)

        for word in _BLANKS.split(value or ""):
            if not word:
                continue
            words += 1
            n = new.get(word, -1)
            if n == -1:
                n = pieces.kept.find(word, counted)
                new = pieces.kept.new
            if n is None:
                unknown += 1
                tokens += 1
            else:
                tokens += n
        return {"n_words": words, "n_tokens": tokens, "n_unknown": unknown}

    kind = pa.struct([("n_words", pa.int64()), ("n_tokens", pa.int64()), ("n_unknown", pa.int64())])

    def counted(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            found = pa.array([of_text(value.as_py()) for value in column], kind)
            kept = [n for n in batch.schema.names if n.lower() != "counts"]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in kept], found], [*kept, "counts"])
        counter(path, word_ends)[0].kept.forget()

    return texts.mapInArrow(counted, schema)
