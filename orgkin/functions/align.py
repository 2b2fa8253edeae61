"""String alignment: LCS length and best-window ratio, then the fuzzy scores built on them.

Tokenising, sorting and set logic stay in Catalyst. Only the longest common
subsequence runs in Python, over whole Arrow batches: each step of the loop
advances every pair (or every window of every pair) of the batch by one character
with bit-parallel integer arithmetic, so there is no per-row Python.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orgkin.functions.text import _SPACE_RUN, _col

_LANES = 1 << 16  # 64-bit words worked on at once; bounds memory, not input


def _codepoints(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat code points and row offsets of a null-free string array."""
    lengths = pc.utf8_length(strings).to_numpy(zero_copy_only=False).astype(np.int64)
    text = "".join(strings.to_pylist())
    flat = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return flat, np.concatenate(([0], np.cumsum(lengths)))


def _subsequence(needles, needle_at, needle_len, texts, owner, start, width, seen=None) -> np.ndarray:
    """LCS of needle ``owner[r]`` and ``texts[start[r] : start[r]+width[r]]`` per row r.

    ``seen`` is told the lengths on the way: the characters read, the rows that read them, their LCS so far.
    """
    words = max(1, -(-int(needle_len.max(initial=0)) // 64))
    alphabet, codes = np.unique(np.concatenate((needles, texts)), return_inverse=True)
    ncodes, tcodes = codes[: len(needles)], codes[len(needles):]
    # place[p, c] has bit i set where character i of needle p is c
    place = np.zeros((len(needle_len), max(1, len(alphabet)), words), dtype=np.uint64)
    for i in range(int(needle_len.max(initial=0))):
        rows = np.flatnonzero(needle_len > i)
        place[rows, ncodes[needle_at[rows] + i], i >> 6] |= np.uint64(1 << (i & 63))

    order = np.argsort(-width, kind="stable")
    owner, start = owner[order], start[order]
    active = np.searchsorted(-width[order], -np.arange(int(width.max(initial=0))), side="left")
    state = np.full((len(order), words), np.uint64(0xFFFFFFFFFFFFFFFF))
    for t, n in enumerate(active):
        s = state[:n]
        hit = s & place[owner[:n], tcodes[start[:n] + t]]
        kept = s & ~hit
        total = np.empty_like(s)
        carry = np.zeros(n, dtype=np.uint64)
        for w in range(words):
            part = s[:, w] + hit[:, w]
            full = part + carry
            carry = ((part < s[:, w]) | (full < part)).astype(np.uint64)
            total[:, w] = full
        state[:n] = total | kept
        if seen is not None:
            seen(t + 1, order[:n], np.bitwise_count(~state[:n]).sum(axis=1))
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.bitwise_count(~state).sum(axis=1)
    return out


def _blocks(cost: np.ndarray):
    """Consecutive row ranges whose summed cost stays near the lane budget."""
    group = np.cumsum(cost) // _LANES
    edges = np.flatnonzero(np.diff(group)) + 1
    return np.split(np.arange(len(cost)), edges)


def _distinct(a: pa.Array, b: pa.Array):
    """First row of each distinct (a, b) and the row -> distinct position map."""
    ai = pc.dictionary_encode(a).indices.to_numpy(zero_copy_only=False).astype(np.int64)
    bi = pc.dictionary_encode(b).indices.to_numpy(zero_copy_only=False).astype(np.int64)
    _, first, back = np.unique(ai * len(b) + bi, return_index=True, return_inverse=True)
    return first, back


def _plain(x: pa.Array) -> pa.Array:
    return pc.fill_null(x.cast(pa.string()), "")


def _lcs_block(nf, no, tf, to, rows) -> np.ndarray:
    nl, tl = np.diff(no)[rows], np.diff(to)[rows]
    n_at, needles = _gather(nf, no, rows)
    t_at, texts = _gather(tf, to, rows)
    return _subsequence(needles, n_at, nl, texts, np.arange(len(rows)), t_at, tl)


def _gather(flat, offsets, rows, backwards=False):
    """Contiguous copy of the listed rows' characters with their new offsets."""
    lo, hi = offsets[rows], offsets[rows + 1]
    size = hi - lo
    at = np.concatenate(([0], np.cumsum(size)))[:-1]
    step = np.arange(int(size.sum()))
    index = np.repeat(hi - 1 + at, size) - step if backwards else np.repeat(lo - at, size) + step
    return at, flat[index]


def lcs_lengths(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Length of the longest common subsequence of a[i] and b[i]."""
    a, b = _plain(a), _plain(b)
    if not len(a):
        return np.zeros(0, dtype=np.int64)
    first, back = _distinct(a, b)
    a, b = a.take(pa.array(first)), b.take(pa.array(first))
    same = pc.equal(a, b).to_numpy(zero_copy_only=False)
    af, ao = _codepoints(a)
    bf, bo = _codepoints(b)
    swap = np.diff(ao) > np.diff(bo)
    out = np.where(same, np.diff(ao), 0)  # equal texts need no alignment
    for side, (nf, no, tf, to) in ((~swap, (af, ao, bf, bo)), (swap, (bf, bo, af, ao))):
        rows = np.flatnonzero(side & ~same)
        rows = rows[np.argsort(np.diff(no)[rows], kind="stable")]
        if len(rows):
            words = np.diff(no)[rows] // 64 + 1
            for block in _blocks(words * 8):
                out[rows[block]] = _lcs_block(nf, no, tf, to, rows[block])
    return out[back]


def _best_window(nf, no, tf, to) -> np.ndarray:
    """Best 2*LCS/(m+w) of needle i over the windows of text i; needles are not longer."""
    m, n = np.diff(no), np.diff(to)
    best = np.zeros(len(m))

    def score(rows, owner, offset, width):
        """Raise best[] over windows: row position, start within its text, width."""
        if not len(owner):
            return
        for block in _blocks((m[rows][owner] // 64 + 1)):
            o = owner[block]
            mine, local = np.unique(o, return_inverse=True)
            pick = rows[mine]
            n_at, needles = _gather(nf, no, pick)
            t_at, texts = _gather(tf, to, pick)
            lcs = _subsequence(
                needles, n_at, m[pick], texts, local, t_at[local] + offset[block], width[block]
            )
            ratio = 2.0 * lcs / (m[pick][local] + width[block])
            np.maximum.at(best, pick[local], ratio)

    rows = np.flatnonzero(m > 0)
    rows = rows[np.argsort(m[rows], kind="stable")]
    if not len(rows):
        return best
    # windows of the needle's own width
    full = n[rows] - m[rows] + 1
    owner = np.repeat(np.arange(len(rows)), full)
    offset = np.arange(int(full.sum())) - np.repeat(np.cumsum(full) - full, full)
    score(rows, owner, offset, m[rows][owner])
    # shorter windows at either end, unless even a full hit could not beat the best so far; one
    # pass from an end aligns all windows that begin there
    floor = np.floor(best[rows] * m[rows] / (2.0 - best[rows])).astype(np.int64)
    rows = rows[m[rows] - 1 > floor]
    for block in _blocks(m[rows] // 64 + 1) if len(rows) else ():
        pick = rows[block]
        for backwards in (False, True):
            n_at, needles = _gather(nf, no, pick, backwards)
            t_at, texts = _gather(tf, to, pick, backwards)

            def seen(width, who, lcs):
                at = pick[who]
                best[at] = np.maximum(best[at], 2.0 * lcs / (m[at] + width))

            _subsequence(needles, n_at, m[pick], texts, np.arange(len(pick)), t_at, m[pick] - 1, seen)
    return best


def window_ratios(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Best ratio of the shorter string against the windows of the longer one."""
    a, b = _plain(a), _plain(b)
    if not len(a):
        return np.zeros(0)
    first, back = _distinct(a, b)
    a, b = a.take(pa.array(first)), b.take(pa.array(first))
    af, ao = _codepoints(a)
    bf, bo = _codepoints(b)
    # a text that the other one holds scores 1 in that window; nothing holds an empty one
    held = np.array([bool(x) and bool(y) and (x in y or y in x) for x, y in zip(a.to_pylist(), b.to_pylist())], dtype=bool)
    out = np.where(held, 1.0, 0.0)
    shorter_a = np.diff(ao) <= np.diff(bo)
    shorter_b = np.diff(bo) <= np.diff(ao)  # equal lengths are tried both ways
    for side, (nf, no, tf, to) in ((shorter_a, (af, ao, bf, bo)), (shorter_b, (bf, bo, af, ao))):
        rows = np.flatnonzero(side & ~held)
        if len(rows):
            n_at, needles = _gather(nf, no, rows)
            t_at, texts = _gather(tf, to, rows)
            got = _best_window(
                needles, np.append(n_at, len(needles)), texts, np.append(t_at, len(texts))
            )
            out[rows] = np.maximum(out[rows], got)
    return out[back]


@F.arrow_udf(T.IntegerType())
def lcs_length(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array(lcs_lengths(a, b), type=pa.int32())


@F.arrow_udf(T.DoubleType())
def window_ratio(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array(window_ratios(a, b), type=pa.float64())


# For plans that measure pairs once: the optimizer never repeats these, nor moves them below a shuffle.
lcs_length_once = F.arrow_udf(lambda a, b: pa.array(lcs_lengths(a, b), type=pa.int32()), T.IntegerType()).asNondeterministic()
window_ratio_once = F.arrow_udf(lambda a, b: pa.array(window_ratios(a, b), type=pa.float64()), T.DoubleType()).asNondeterministic()


def tokens(c: Column | str) -> Column:
    return F.array_remove(F.split(F.regexp_replace(_col(c), _SPACE_RUN, " "), " "), "")


def sorted_words(c: Column | str) -> Column:
    return F.array_join(F.sort_array(tokens(c)), " ")


def ratio(lcs: Column, a: Column, b: Column) -> Column:
    size = F.length(a) + F.length(b)
    return F.when(size == 0, F.lit(1.0)).otherwise(2.0 * lcs / size)


def token_sort_ratio(a: Column | str, b: Column | str) -> Column:
    """Ratio of the two strings with their words in sorted order, 0..1."""
    sa, sb = sorted_words(a), sorted_words(b)
    return ratio(lcs_length(sa, sb), sa, sb)


def partial_ratio(a: Column | str, b: Column | str) -> Column:
    """Ratio of the shorter string with its best window in the longer one, 0..1."""
    return window_ratio(_col(a), _col(b))


def set_parts(ta: Column, tb: Column) -> tuple[Column, Column, Column]:
    """Sorted words of two lists: those of both, those of the first only, of the second only."""
    return (
        F.sort_array(F.array_intersect(ta, tb)), F.sort_array(F.array_except(ta, tb)),
        F.sort_array(F.array_except(tb, ta)),
    )


def set_side(both: Column, only: Column) -> Column:
    return F.array_join(F.concat(both, only), " ")


def set_ratio(
    ta: Column, tb: Column, both: Column, only_a: Column, only_b: Column, side_a: Column, side_b: Column, lcs: Column
) -> Column:
    """The word-set ratio from the parts above and the alignment of the two sides."""
    n = F.length(F.array_join(both, " "))
    whole = ratio(lcs, side_a, side_b)
    return (
        F.when((F.size(ta) == 0) | (F.size(tb) == 0), F.lit(0.0))
        .when(F.size(both) == 0, whole)
        .when((F.size(only_a) == 0) | (F.size(only_b) == 0), F.lit(1.0))
        .otherwise(
            F.greatest(
                whole, 2.0 * n / (n + F.length(side_a)), 2.0 * n / (n + F.length(side_b))
            )
        )
    )


def token_set_ratio(a: Column | str, b: Column | str) -> Column:
    """Ratio on shared and unshared words, order and repeats ignored, 0..1.

    The shared words are a prefix of either side, so only the two sides against
    each other need an alignment; the other two ratios follow from lengths.
    """
    ta, tb = tokens(a), tokens(b)
    both, only_a, only_b = set_parts(ta, tb)
    sides = set_side(both, only_a), set_side(both, only_b)
    return set_ratio(ta, tb, both, only_a, only_b, *sides, lcs_length(*sides))
