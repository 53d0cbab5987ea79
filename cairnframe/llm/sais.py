"""Suffix arrays by induced sorting, and permuted common prefixes, for one shard of text.

The top level has a small alphabet; its induction scans go bucket by bucket in numpy, each bucket in
one step, as runs of equal symbols have a closed form. Leftmost-smaller (LMS) substrings are sorted
by the same scans and named; if names repeat, the string of names is sorted by the same algorithm,
recursively, in plain lists, as its alphabet is as large as itself. All steps are linear.
"""

from __future__ import annotations

import numpy as np


def kinds_of(text: np.ndarray) -> np.ndarray:
    """True for S suffixes (smaller than the next one); the last one counts as S."""
    step = np.sign(text[1:].astype(np.int64) - text[:-1])  # > 0: S, < 0: L, 0: as the next
    place = np.where(step != 0, np.arange(len(step)), len(step))
    following = np.minimum.accumulate(place[::-1])[::-1]
    return np.r_[np.append(step, 1)[following] > 0, True]


def lms_of(kinds: np.ndarray) -> np.ndarray:
    return np.flatnonzero(kinds[1:] & ~kinds[:-1]) + 1


def common_prefixes(text: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lengths of the common prefixes of the suffixes at a and b (uint16 text with a unique end)."""
    whole = np.concatenate([text, np.zeros(4, np.uint16)])
    words = np.ndarray((len(text),), "<u8", whole.tobytes(), strides=(2,))
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    while len(live):
        x, y = a[live] + out[live], b[live] + out[live]
        inside = np.maximum(x, y) < len(text)
        live, x, y = live[inside], x[inside], y[inside]
        differ = words[x] ^ words[y]
        # Symbols that agree from the front: zero bits at the low end, 16 for each.
        low = differ & (~differ + np.uint64(1))
        agree = np.where(differ == 0, 4, np.bitwise_count(low - np.uint64(1)) // 16)
        out[live] += agree
        live = live[agree == 4]
    return np.minimum(out, len(text) - np.maximum(a, b))


def induce(text: np.ndarray, starts: np.ndarray, run_start: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The order of all suffixes that follows from `lms`, LMS suffixes in (assumed) order."""
    n, size = len(text), len(starts) - 1
    order = np.full(n, -1, np.int32)
    # LMS suffixes at the ends of their buckets, in order.
    symbols = text[lms]
    by = np.argsort(symbols, kind="stable")
    counts = np.bincount(symbols, minlength=size)
    lms_at = starts[1:] - counts
    order[np.repeat(lms_at, counts) + np.arange(len(lms)) - np.repeat(np.cumsum(counts) - counts, counts)] = lms[by]
    head, tail = starts[:-1].copy(), starts[1:].copy()

    def chains(e: np.ndarray) -> np.ndarray:
        """For entries in scan order, those that they bring into their own bucket: first all that stand one before, and so on."""
        length = e - run_start[e]
        if not length.any():
            return e[:0]
        own = np.repeat(np.arange(len(e)), length)
        back = np.arange(len(own)) - np.repeat(np.cumsum(length) - length, length) + 1
        return (e[own] - back)[np.argsort(back, kind="stable")]

    def place(p: np.ndarray, forward: bool) -> None:
        s = text[p]
        p = p[np.argsort(s, kind="stable")]
        found = np.bincount(s, minlength=size)
        rank = np.arange(len(p)) - np.repeat(np.cumsum(found) - found, found)
        if forward:
            order[np.repeat(head, found) + rank] = p
            np.add(head, found, out=head)
        else:
            order[np.repeat(tail, found) - 1 - rank] = p
            np.subtract(tail, found, out=tail)

    present = np.flatnonzero(np.diff(starts)).tolist()
    for c in present:
        e = order[starts[c] : head[c]]
        more = chains(e)
        if len(more):
            order[head[c] : head[c] + len(more)] = more
            head[c] += len(more)
            e = order[starts[c] : head[c]]
        p = np.concatenate([e, order[lms_at[c] : starts[c + 1]]]) - 1
        p = p[p >= 0]
        p = p[text[p] > c]
        if len(p):
            place(p, True)
    tail[text[-1]] -= 1  # the end of the text has no suffix after it that could bring it in
    for c in reversed(present):
        e = order[tail[c] : starts[c + 1]][::-1]
        more = chains(e)
        if len(more):
            tail[c] -= len(more)
            order[tail[c] : tail[c] + len(more)] = more[::-1]
            e = order[tail[c] : starts[c + 1]][::-1]
        p = np.concatenate([e, order[starts[c] : head[c]][::-1]]) - 1
        p = p[p >= 0]
        p = p[text[p] < c]
        if len(p):
            place(p, False)
    return order


def induce_names(text: list[int], kinds: bytes, heads: list[int], tails: list[int], lms: list[int]) -> list[int]:
    """The same for a string of names, one suffix at a time."""
    order = [-1] * len(text)
    at = tails.copy()
    for i in reversed(lms):
        at[text[i]] -= 1
        order[at[text[i]]] = i
    at = heads.copy()
    for j in order:
        if j > 0 and not kinds[j - 1]:
            c = text[j - 1]
            order[at[c]] = j - 1
            at[c] += 1
    at = tails.copy()
    for k in range(len(order) - 1, -1, -1):
        j = order[k]
        if j > 0 and kinds[j - 1]:
            c = text[j - 1]
            at[c] -= 1
            order[at[c]] = j - 1
    return order


def sorted_names(names: np.ndarray) -> np.ndarray:
    """Suffix array of a string of names whose last one is the least and occurs once."""
    counts = np.bincount(names)
    if len(counts) == len(names):
        return np.argsort(names)
    kinds = kinds_of(names)
    lms = lms_of(kinds)
    ends = np.cumsum(counts)
    text, flags, heads, tails = names.tolist(), kinds.astype(np.uint8).tobytes(), (ends - counts).tolist(), ends.tolist()
    order = np.array(induce_names(text, flags, heads, tails, lms.tolist()))
    return np.array(induce_names(text, flags, heads, tails, sort_lms(names, kinds, lms, order).tolist()))


def sort_lms(text: np.ndarray, kinds: np.ndarray, lms: np.ndarray, order: np.ndarray) -> np.ndarray:
    """LMS suffixes in order, given an order in which LMS substrings are sorted."""
    is_lms = np.zeros(len(text), bool)
    is_lms[lms] = True
    subs = order[is_lms[order]]
    end = np.zeros(len(text), np.int64)
    end[lms] = np.append(lms[1:], len(text) - 1)
    length = end[subs] - subs + 1
    # Equal substrings are neighbours; they are compared symbol by symbol, all pairs at once.
    same = np.flatnonzero(length[1:] == length[:-1])
    k = 0
    open_ = same
    new = np.ones(len(subs), bool)
    while len(open_):
        a, b = subs[open_] + k, subs[open_ + 1] + k
        agree = (text[a] == text[b]) & (kinds[a] == kinds[b])
        open_ = open_[agree]
        k += 1
        done = length[open_] <= k
        new[open_[done] + 1] = False
        open_ = open_[~done]
    name = np.zeros(len(text), np.int64)
    name[subs] = np.cumsum(new) - 1
    return lms[sorted_names(name[lms])]


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array of uint16 symbols; the last one is the least and occurs once."""
    if len(text) == 1:
        return np.zeros(1, np.int32)
    kinds = kinds_of(text)
    lms = lms_of(kinds)
    starts = np.r_[0, np.cumsum(np.bincount(text))]
    change = np.r_[True, text[1:] != text[:-1]]
    run_start = np.maximum.accumulate(np.where(change, np.arange(len(text)), 0))
    order = induce(text, starts, run_start, lms)
    return induce(text, starts, run_start, sort_lms(text, kinds, lms, order))


def permuted_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each position, the common prefix of its suffix with the one before it in the order.

    Where a position and the one before it in the order both stand one to the right of such a pair
    with a common symbol, the value is one less than that pair's; only the others are compared.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    own = np.r_[True, (before[1:] != before[:-1] + 1) | (before[:-1] < 0) | (text[:-1] != text[before[:-1]])]
    first = np.flatnonzero(own)
    value = np.zeros(len(first), np.int64)
    some = before[first] >= 0
    value[some] = common_prefixes(text, first[some], before[first[some]])
    group = np.cumsum(own) - 1
    return np.maximum(value[group] - (np.arange(n) - first[group]), 0)
