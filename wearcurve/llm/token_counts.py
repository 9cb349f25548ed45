"""Token counts of whole texts without building the tokens of common words.

Offline, the vocabulary strings that encode alone as one token are found by merging each from its bytes. Then a
pre-token in that set counts one at once, and only the rest is merged. What a word counts is remembered per
Python worker. Null and empty texts count zero. Special strings inside texts count one token, as in the library's
default. Other columns pass through untouched, and any column name may be used.
"""

from __future__ import annotations

import heapq
import json
from dataclasses import dataclass
from functools import cached_property
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from wearcurve.llm.batches import small_batches
from wearcurve.llm.bytebpe import LATIN, Parts
from wearcurve.llm.memo import held


@dataclass(frozen=True)
class Vocabulary:
    """A byte-level BPE vocabulary file of the tokenizers library."""

    spec: str

    @cached_property
    def key(self) -> str:
        return sha256(self.spec.encode()).hexdigest()

    @cached_property
    def parsed(self) -> dict:
        return json.loads(self.spec)

    @cached_property
    def ranks(self) -> dict[tuple[str, str], int]:
        merges = self.parsed["model"]["merges"]
        return {tuple(m.split(" ") if isinstance(m, str) else m): i for i, m in enumerate(merges)}

    @property
    def added(self) -> list[str]:
        return [t["content"] for t in self.parsed["added_tokens"]]


def load_vocabulary(path: str) -> Vocabulary:
    """Read a vocabulary file on the driver; fail if it is of a kind that is not covered here."""
    with open(path, encoding="utf-8") as f:
        vocabulary = Vocabulary(f.read())
    spec = vocabulary.parsed
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    plain = all(not model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    tokens_plain = not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"])
    if (
        model["type"] != "BPE"
        or pre.get("type") != "ByteLevel"
        or pre.get("add_prefix_space")
        or not pre.get("use_regex", True)
        or spec.get("normalizer")
        or not plain
        or not tokens_plain
    ):
        raise ValueError(f"{path}: only plain byte-level BPE vocabularies are supported")
    return vocabulary


#: No rank: the pair is not merged.
_NONE = 1 << 60


def merged(symbols: str, ranks: dict[tuple[str, str], int]) -> list[str]:
    """Tokens of one pre-token: the pair of the lowest rank is merged first, the leftmost of equals."""
    if len(symbols) > 256:
        return _merged_long(symbols, ranks)
    parts, get = list(symbols), ranks.get
    pairs = [get(p, _NONE) for p in zip(parts, parts[1:], strict=False)]
    while pairs and (low := min(pairs)) != _NONE:
        k = pairs.index(low)
        parts[k] += parts.pop(k + 1)
        del pairs[k]
        if k:
            pairs[k - 1] = get((parts[k - 1], parts[k]), _NONE)
        if k < len(pairs):
            pairs[k] = get((parts[k], parts[k + 1]), _NONE)
    return parts


def _merged_long(symbols: str, ranks: dict[tuple[str, str], int]) -> list[str]:
    """The same with a queue of pairs, for pre-tokens of any length."""
    parts = list(symbols)
    n = len(parts)
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    queue = [(r, k) for k in range(n - 1) if (r := ranks.get((parts[k], parts[k + 1]))) is not None]
    heapq.heapify(queue)
    while queue:
        rank, k = heapq.heappop(queue)
        other = right[k]
        if parts[k] is None or other >= n or ranks.get((parts[k], parts[other])) != rank:
            continue  # one of the two has been merged meanwhile
        parts[k] += parts[other]
        parts[other] = None
        right[k] = right[other]
        if right[k] < n:
            left[right[k]] = k
            if (r := ranks.get((parts[k], parts[right[k]]))) is not None:
                heapq.heappush(queue, (r, k))
        if left[k] >= 0 and (r := ranks.get((parts[left[k]], parts[k]))) is not None:
            heapq.heappush(queue, (r, left[k]))
    return [p for p in parts if p is not None]


def byte_chars() -> dict[int, str]:
    """The character that stands for each byte: printable ones for themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


def whole_tokens(vocabulary: Vocabulary) -> frozenset[str]:
    """The vocabulary strings that are proved to encode alone as one token."""
    ranks = vocabulary.ranks
    return frozenset(s for s in vocabulary.parsed["model"]["vocab"] if len(merged(s, ranks)) == 1)


class Counter:
    """Counts tokens; one per Python worker."""

    def __init__(self, vocabulary: Vocabulary, whole: frozenset[str]):
        import re

        from tokenizers import pre_tokenizers

        self.ranks, self.whole = vocabulary.ranks, whole
        self.pre = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        added = sorted(vocabulary.added, key=len, reverse=True)
        self.chars = byte_chars()
        self.cut = re.compile("|".join(map(re.escape, added)) or "(?!)")
        self.parts = Parts(self._count, sum, added)

    def _count(self, part: str) -> int:
        if part.isalpha() or part[1:].isalpha() and part[0] == " ":
            if max(part) <= LATIN:  # one pre-token
                token = part.encode().decode("latin-1").translate(self.chars)
                return 1 if token in self.whole else len(merged(token, self.ranks))
        total = len(self.cut.findall(part))
        for between in self.cut.split(part):
            for token, _ in self.pre.pre_tokenize_str(between) if between else ():
                total += 1 if token in self.whole else len(merged(token, self.ranks))
        return total


def count_tokens(text: Column | str, vocabulary: Vocabulary) -> Column:
    """Tokens of whole texts as ``bigint``, equal to the length of the library's encoding."""
    small_batches()
    key = vocabulary.key
    whole = whole_tokens(vocabulary)
    spec = vocabulary.spec

    @F.arrow_udf("bigint")
    def counts(texts: pa.Array) -> pa.Array:
        counter = held("count" + key, lambda: Counter(Vocabulary(spec), whole))
        return pa.array([counter.parts.get(t) for t in texts.to_pylist()], pa.int64())

    return counts(F.col(text) if isinstance(text, str) else text)
