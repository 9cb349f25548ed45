"""Merge-type encoding of all words of a batch at once, with Arrow and numpy.

``cut`` splits texts into words with Arrow and names every word by its place in a dictionary, so that whatever a word
costs is paid once for each batch that holds it. ``BulkMerger`` merges all words of a dictionary together: every word
is a run of token ids in one array; a round looks up the ranks of all neighbours, takes each word's lowest (the
leftmost of equals) and merges that pair; words without a pair to merge leave. That is the order of a single word's
merges, so the result is that of merging each word by itself. ``gathered`` puts the ids of all places of all words
together. No Python object is made for a word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa

from wearcurve.llm.pieces import SPACE, PieceModel
from wearcurve.llm.token_counts import Vocabulary, byte_chars

_NONE = 1 << 40
#: Put where texts are cut; texts that hold it are not cut.
MARK = "\x01"
#: Letters that all libraries know alike: those of the Latin blocks.
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"


def slices(texts: pa.Array, most: int = 1 << 22) -> Iterator[pa.Array]:
    """Parts of an array of texts with some bytes each; a longer text is a part of its own."""
    import numpy as np
    import pyarrow.compute as pc

    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield texts.slice(at, end - at)
        at = end


def cut(texts: pa.Array, before: str):
    """Words of texts without nulls: the code of each place, where each text's places begin, and the dictionary.

    A text is cut before each space and each character of ``before``, and around each line break.
    """
    import numpy as np
    import pyarrow.compute as pc

    marked = pc.replace_substring(texts, "\n", f"{MARK}\n{MARK}")
    for c in [" ", *before]:
        marked = pc.replace_substring(marked, c, MARK + c)
    rows = pc.split_pattern(marked, MARK)
    coded = rows.flatten().dictionary_encode()
    starts = rows.offsets.to_numpy().astype(np.int64)
    return coded.indices.to_numpy().astype(np.int64), starts - starts[0], coded.dictionary


def content(words: pa.StringArray):
    """The bytes of all words one after the other."""
    import numpy as np

    offsets = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset : words.offset + len(words) + 1]
    data = words.buffers()[2]
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data and len(words) else np.zeros(0, dtype=np.uint8)


def ranges(starts, sizes):
    """start, start + 1, ... of each range, one after the other."""
    import numpy as np

    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def gathered(codes, ids, sizes):
    """Ids of the entries named by ``codes`` one after the other, and where each place ends; entry k has sizes[k] ids."""
    import numpy as np

    many = sizes[codes]
    return ids[ranges((np.cumsum(sizes) - sizes)[codes], many)], np.cumsum(many)


class BulkMerger:
    """Merges runs of ids: ``pairs`` (left, right, made), the pair that is merged first in front."""

    def __init__(self, pairs: Iterable[tuple[int, int, int]], many: int):
        import numpy as np

        table = np.array(list(pairs), dtype=np.int64).reshape(-1, 3)
        self.many = many
        keys = table[:, 0] * many + table[:, 1]
        self.made = table[:, 2]
        # hash tables of (key, rank); keys that meet another in one go to the next
        self.tables, ranks = [], np.arange(len(keys))
        while len(keys):
            factor, bits = np.uint64(0x9E3779B97F4A7C15 + 2 * len(self.tables)), max(10, int(len(keys)).bit_length() + 3)
            slots = ((keys.view(np.uint64) * factor) >> np.uint64(64 - bits)).astype(np.int64)
            _, first = np.unique(slots, return_index=True)
            key, rank = np.full(1 << bits, -1, dtype=np.int64), np.zeros(1 << bits, dtype=np.int64)
            key[slots[first]], rank[slots[first]] = keys[first], ranks[first]
            self.tables.append((factor, bits, key, rank))
            rest = np.ones(len(keys), dtype=bool)
            rest[first] = False
            keys, ranks = keys[rest], ranks[rest]

    def _ranks(self, keys):
        import numpy as np

        out = np.full(len(keys), _NONE, dtype=np.int64)
        for factor, bits, key, rank in self.tables:
            slots = ((keys.view(np.uint64) * factor) >> np.uint64(64 - bits)).astype(np.int64)
            found = np.flatnonzero(key[slots] == keys)
            out[found] = rank[slots[found]]
        return out

    def merged(self, tokens, sizes):
        """Ids of all words one after the other, and how many each has. ``tokens``: of all words, ``sizes``: none is 0."""
        import numpy as np

        if not len(sizes):
            return tokens, sizes
        out, names, final = [], np.arange(len(sizes)), np.zeros(len(sizes), dtype=np.int64)
        starts = np.cumsum(sizes) - sizes
        ranks = np.full(len(tokens), _NONE, dtype=np.int64)
        ranks[:-1] = self._ranks(tokens[:-1] * self.many + tokens[1:])
        ranks[starts[1:] - 1] = _NONE  # the last token of a word has no right neighbour
        while True:
            low = np.minimum.reduceat(ranks, starts)
            done = low == _NONE
            if done.any():
                gone = np.repeat(done, sizes)
                out.append((names[done], tokens[gone]))
                final[names[done]] = sizes[done]
                tokens, ranks = tokens[~gone], ranks[~gone]
                names, sizes, low = names[~done], sizes[~done], low[~done]
                if not len(names):
                    break
            at = np.flatnonzero(ranks == np.repeat(low, sizes))
            word = np.repeat(np.arange(len(names)), sizes)[at]
            at = at[np.concatenate([[True], word[1:] != word[:-1]])]
            tokens[at] = self.made[low]
            keep = np.ones(len(tokens), dtype=bool)
            keep[at + 1] = False
            tokens, ranks = tokens[keep], ranks[keep]
            sizes = sizes - 1
            starts = np.cumsum(sizes) - sizes
            at -= np.arange(len(at))  # each word before has lost one token
            last = starts + sizes - 1
            # only the neighbours of what was merged have new ranks
            right = np.minimum(at + 1, len(tokens) - 1)
            ranks[at] = np.where(at == last, _NONE, self._ranks(tokens[at] * self.many + tokens[right]))
            left = at[at > starts] - 1
            ranks[left] = self._ranks(tokens[left] * self.many + tokens[left + 1])
        ids, begin = np.empty(int(final.sum()), dtype=np.int64), np.cumsum(final) - final
        for of, found in out:
            ids[ranges(begin[of], final[of])] = found
        return ids, final


def byte_merger(vocabulary: Vocabulary):
    """The merger of a byte-level vocabulary, and the id of each byte."""
    import numpy as np

    vocab, chars = vocabulary.parsed["model"]["vocab"], byte_chars()
    pairs = ((vocab[a], vocab[b], vocab[a + b]) for a, b in vocabulary.ranks)
    return BulkMerger(pairs, max(vocab.values()) + 1), np.array([vocab[chars[b]] for b in range(256)], dtype=np.int64)


def piece_merger(model: PieceModel, normal: dict[str, int], below: int):
    """The merger of a piece model, and the id of each character under ``below`` or -1; a space stands for its sign.

    Any two neighbours that are a piece together are merged, the best score first.
    """
    import numpy as np

    pairs = [(-model.scores[i], normal[p[:k]], normal[p[k:]], i) for p, i in normal.items() for k in range(1, len(p)) if p[:k] in normal and p[k:] in normal]
    pairs.sort(key=lambda x: x[0])
    letters = np.array([normal.get(SPACE if c == 32 else chr(c), -1) for c in range(below)], dtype=np.int64)
    return BulkMerger((p[1:] for p in pairs), len(model.pieces)), letters
