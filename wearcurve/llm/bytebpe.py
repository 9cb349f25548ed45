"""Cutting texts into parts that a byte-level BPE tokenizer treats alone, so that parts can be remembered.

Its pattern takes one space with the word after it, and a line break between two words stands alone. So where
every white space of a text is a single space or line break between two words, the text may be cut before each
space and around each line break. Texts with any other white space, or with an added token's string, are not cut.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from string import punctuation

from wearcurve.llm.memo import LIMIT, Memo

#: The last character of the Latin blocks, whose letters all libraries know alike.
LATIN = "\u024f"
def base_of(word: str) -> str:
    """A word without the ASCII punctuation at its end, which is a part of its own after a Latin letter."""
    base = word.rstrip(punctuation)
    return base if base and base[-1] <= LATIN and base[-1].isalpha() else word


def is_plain(word: str) -> bool:
    """Whether a word is Latin letters alone, and so one pre-token, with or without the space before it."""
    return word.isalpha() and max(word) <= LATIN and len(word) <= 64


class Parts:
    """``get(text)``: the values of a text's parts in order, joined; ``value`` gives that of one part.

    ``spaced`` holds words with the space before them, or words that begin with the line break before them.
    ``bare`` holds words with nothing before them.
    """

    def __init__(self, value: Callable[[str], object], join: Callable, added: Sequence[str], memo: int = LIMIT):
        self.value, self.join, self.added = value, join, tuple(added)
        self.spaced = Memo(self._of_spaced, memo)
        self.bare = Memo(lambda word: self._of("", word, self.bare), memo)

    def _of_spaced(self, word: str):
        if word[0] == "\n":
            return self.join([self.bare["\n"], self.bare[word[1:]]])
        return self._of(" ", word, self.spaced)

    def _of(self, before: str, word: str, known: Memo):
        base = base_of(word)
        if len(base) < len(word):
            return self.join([known[base], self.bare[word[len(base) :]]])
        return self.value(before + word)

    def cut(self, text: str) -> list[str] | None:
        """The words of a text that may be cut, each but the first as ``spaced`` has it; else null."""
        if " ".join(text.split()) != text.replace("\n", " ") or any(a in text for a in self.added):
            return None
        return text.replace("\n", " \n").split(" ")

    def get(self, text: str | None):
        if not text:
            return self.join([])
        words = self.cut(text)
        return self.value(text) if words is None else self.of_words(words)

    def of_words(self, words: list[str]):
        values = [self.bare[words[0]]]
        values.extend(map(self.spaced.__getitem__, words[1:]))
        return self.join(values)
