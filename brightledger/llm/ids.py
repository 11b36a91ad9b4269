"""Token ids of whole texts by a public tokenizer, for use inside tasks."""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import numpy as np

# A text of white space, printable ASCII and Latin-1 letters needs no normalisation but lower
# case, and falls into parts as the vocabulary's own pattern has them; the library's model
# encodes each part once. Other texts are cut at white space, which the vocabularies used here
# drop, and words of other characters go through the library's whole pipeline.
_OTHER = re.compile(r"[^\t-\r -~À-ÖØ-öø-ÿ]")
_PARTS = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^a-zß-öø-ÿ0-9\s]+")
_BLANKS = re.compile(r"[ \t\n\r\f\v]+")
# Bytes of words, and of parts of words, kept per generation and process: when a generation is
# full, the one before it is forgotten, so words that recur stay. This changes no result.
KEPT_BYTES = 8 << 20
ENTRY_BYTES = 200  # of a word, besides its letters
# A word longer than this is encoded each time.
LONG_WORD = 64


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1
    stands for itself, the other bytes for the letters from U+0100 on, in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + n) for n, b in enumerate(others)}


@lru_cache(maxsize=2)
def encoder(path: str) -> "WordEncoder":
    return WordEncoder(path)


class WordEncoder:
    """Encodes with the tokenizers library, for vocabularies that drop white space: then
    the ids of a text are those of its blank-separated words, one after the other."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Strings of special tokens that occur in a text are found before the white space
        # is, so they may span it; texts that hold one are encoded in one piece.
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model, self.letters = self.tokenizer.model, byte_letters()
        # Ids as they lie in memory, so that those of a text are put together by one join.
        self.known, self.parts = Kept(), Kept()

    def forget(self) -> None:
        """Gives back what was kept for words, at the end of a task: its process may go on to
        quite other work."""
        self.known.forget()
        self.parts.forget()

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _part(self, part: str) -> bytes:
        letters = part if part.isascii() else "".join([self.letters[b] for b in part.encode()])
        return array("I", [token.id for token in self.model.tokenize(letters)]).tobytes()

    def _found(self, kept: "Kept", words: list[str], make) -> bytes:
        found = list(map(kept.new.get, words))
        if None in found:
            find = kept.find
            found = [find(words[at], make) if ids is None else ids for at, ids in enumerate(found)]
        return b"".join(found)

    def _plain(self, text: str) -> bytes:
        return self._found(self.parts, _PARTS.findall(text.lower()), self._part)

    def _word(self, word: str) -> bytes:
        return self._whole(word) if _OTHER.search(word) else self._plain(word)

    def encode(self, text: str | None, end: int) -> np.ndarray:
        """The ids of a text and then ``end``; null counts as empty."""
        text = text or ""
        if any(s in text for s in self.special):
            ids = self._whole(text)
        elif _OTHER.search(text):
            ids = self._found(self.known, _BLANKS.split(text), self._word)
        else:
            ids = self._plain(text)
        return np.frombuffer(ids + end.to_bytes(4, "little"), "<u4")


class Kept:
    """Results by word, in two generations of bounded size."""

    def __init__(self):
        self.forget()

    def forget(self) -> None:
        self.new: dict = {}
        self.old: dict = {}
        self.bytes = 0

    def find(self, word: str, make):
        ids = self.new.get(word)
        if ids is not None:
            return ids
        ids = self.old.get(word)
        if ids is None:
            ids = make(word)
        if len(word) <= LONG_WORD:
            if self.bytes >= KEPT_BYTES:
                self.new, self.old, self.bytes = {}, self.new, 0
            self.new[word] = ids
            self.bytes += ENTRY_BYTES + 3 * len(word)
        return ids
