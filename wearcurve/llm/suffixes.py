"""Order of suffixes by two-stage sorting, and the common prefixes of neighbours, for a batch of byte strings.

A suffix is *rising* if it is smaller than the one that starts a byte later. Only rising suffixes are sorted by
comparison. The others are induced: buckets are scanned in the order of their first byte, and every suffix found hands
the one before it, if that is not rising, to the next free place of its bucket. A bucket holds its falling suffixes
first, then its rising ones. A scan of a bucket is a few array operations; only suffixes that start with a run of the
bucket's own byte take one more step for each byte of the run.

Comparison stops after ``DEPTH`` bytes: suffixes that share as many are neighbours in any case. Strings are separate: a
string's end is smaller than any byte. Only wanted starts are sorted, and those that lead to them.
"""

from __future__ import annotations

DEPTH = 200


def order(data, begins, ends, last):
    """Wanted starts in suffix order. ``data``: bytes of all strings; a string is [begin, end), wanted are [begin, last]."""
    import numpy as np

    n = len(data)
    places = np.arange(n)
    step = np.empty(n, dtype=np.int8)
    step[:-1] = np.sign(data[1:].astype(np.int16) - data[:-1])
    step[ends - 1] = -1
    differs = np.where(step != 0, places, n)
    rising = step[np.minimum.accumulate(differs[::-1])[::-1]] > 0
    # a wanted suffix that is not rising needs all after it up to the next rising one
    next_rising = np.minimum.accumulate(np.where(rising, places, n)[::-1])[::-1]
    stop = np.minimum(next_rising[last], ends - 1)
    needed = np.zeros(n + 1, dtype=np.int32)
    np.add.at(needed, begins, 1)
    np.add.at(needed, stop + 1, -1)
    needed = np.cumsum(needed[:n]) > 0
    first = np.zeros(n, dtype=bool)
    first[begins] = True

    direct = np.flatnonzero(rising & needed)
    end_of = np.repeat(ends, ends - begins)
    raw = data.tobytes()
    keys = [raw[a:b] for a, b in zip(direct.tolist(), np.minimum(direct + DEPTH, end_of[direct]).tolist(), strict=True)]
    direct = direct[np.array(sorted(range(len(keys)), key=keys.__getitem__), dtype=np.int64)]
    bounds = np.searchsorted(data[direct], np.arange(257))

    buckets: list[list] = [[] for _ in range(256)]

    def induce(found) -> None:
        """Put what stands before each suffix found, if it is not rising, behind its bucket's falling suffixes."""
        before = found[~first[found]] - 1
        before = before[~rising[before]]
        if not len(before):
            return
        heads = data[before]
        at = np.argsort(heads, kind="stable")
        before, heads = before[at], heads[at]
        cuts = np.append(np.flatnonzero(np.append(True, heads[1:] != heads[:-1])), len(heads))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            buckets[heads[a]].append(before[a:b])

    # the empty suffixes come first of all; before each of them stands the last byte of a string
    tails = (ends - 1)[needed[ends - 1]]
    at = np.argsort(data[tails], kind="stable")
    for head, part in zip(*_runs(data[tails][at], tails[at]), strict=True):
        buckets[head].append(part)
    out = []
    for c in range(256):
        done = 0
        while done < len(buckets[c]):  # grows while it is scanned
            part = buckets[c][done]
            done += 1
            induce(part)
        rises = direct[bounds[c] : bounds[c + 1]]
        induce(rises)
        out += [*buckets[c], rises]
    found = np.concatenate(out) if out else np.zeros(0, dtype=np.int64)
    wanted = np.zeros(n + 1, dtype=np.int32)
    np.add.at(wanted, begins, 1)
    np.add.at(wanted, last + 1, -1)
    return found[np.cumsum(wanted[:n])[found] > 0]


def _runs(heads, values):
    import numpy as np

    if not len(heads):
        return [], []
    cuts = np.flatnonzero(heads[1:] != heads[:-1]) + 1
    return heads[np.append(0, cuts)].tolist(), np.split(values, cuts)


def common_prefixes(data, starts):
    """Bytes that each suffix and the one before it have in common, up to ``DEPTH``; every start has as many bytes."""
    import numpy as np

    out = np.zeros(len(starts), dtype=np.int64)
    if len(starts) < 2:
        return out
    words = np.ndarray((len(data) - 7,), dtype="<u8", buffer=np.ascontiguousarray(data), strides=(1,))
    alive, a, b = np.arange(1, len(starts)), starts[:-1], starts[1:]
    for k in range(0, DEPTH, 8):
        differ = words[a + k] ^ words[b + k]
        bad = differ != 0
        if bad.any():
            # the lowest set bit is in the first byte that differs
            low = (differ[bad] & (~differ[bad] + np.uint64(1))).astype(np.float64)
            out[alive[bad]] = k + np.log2(low).astype(np.int64) // 8
            alive, a, b = alive[~bad], a[~bad], b[~bad]
        if not len(alive):
            break
    out[alive] = DEPTH
    return out
