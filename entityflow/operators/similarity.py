"""Name similarity: a native rule for the default threshold, an Arrow scorer for the rest."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- native pieces ---------------------------------------------------------------


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence, one table row per character of ``a``."""
    width = F.length(b)

    def next_row(row, ch):
        def cell(new, j):
            same = F.substring(b, j, F.lit(1)) == ch
            value = F.when(same, F.get(row, j - 1) + 1).otherwise(F.greatest(F.get(row, j), F.get(new, j - 1)))
            return F.concat(new, F.array(value))

        return F.aggregate(F.sequence(F.lit(1), width), F.array(F.lit(0)), cell)

    start = F.array_repeat(F.lit(0), width + 1)
    return F.get(F.aggregate(F.split(a, ""), start, next_row), width)


# --- weighted ratio (0-100), for reported scores and other thresholds ------------


def _lcs(a: str, b: str) -> int:
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & masks.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _similarity(dist: int, total: int) -> float:
    return (1.0 - dist / total) * 100 if total else 100.0


def ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    return _similarity(total - 2 * _lcs(a, b), total)


def partial_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter text against any window of the longer one, cut windows at the ends included."""
    if not a or not b:
        return 100.0 if a == b else 0.0
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    best = _best_window(short, long)
    if len(a) == len(b) and best < 100.0:
        best = max(best, _best_window(long, short))
    return best


def _best_window(short: str, long: str) -> float:
    size = len(short)
    return max(
        ratio(short, long[max(0, end - size) : min(end, len(long))]) for end in range(1, len(long) + size)
    )


def token_ratio(a: str, b: str) -> float:
    """The better of the sorted-words ratio and the word-set ratio."""
    words_a, words_b = a.split(), b.split()
    best = ratio(" ".join(sorted(words_a)), " ".join(sorted(words_b)))
    common, only_a, only_b = set(words_a) & set(words_b), set(words_a) - set(words_b), set(words_b) - set(words_a)
    if not words_a or not words_b:
        return best
    if common and (not only_a or not only_b):
        return 100.0
    rest_a, rest_b = " ".join(sorted(only_a)), " ".join(sorted(only_b))
    shared = len(" ".join(sorted(common)))
    gap = 1 if shared else 0
    full_a, full_b = shared + gap + len(rest_a), shared + gap + len(rest_b)
    dist = len(rest_a) + len(rest_b) - 2 * _lcs(rest_a, rest_b)
    best = max(best, _similarity(dist, full_a + full_b))
    if shared:
        best = max(
            best,
            _similarity(gap + len(rest_a), shared + full_a),
            _similarity(gap + len(rest_b), shared + full_b),
        )
    return best


def partial_token_ratio(a: str, b: str) -> float:
    words_a, words_b = a.split(), b.split()
    only_a, only_b = set(words_a) - set(words_b), set(words_b) - set(words_a)
    if set(words_a) & set(words_b):
        return 100.0
    return max(
        partial_ratio(" ".join(sorted(words_a)), " ".join(sorted(words_b))),
        partial_ratio(" ".join(sorted(only_a)), " ".join(sorted(only_b))),
    )


def weighted_ratio(a: str, b: str) -> float:
    """Plain, word-based and partial ratios combined by how far the lengths differ."""
    if not a or not b:
        return 0.0
    stretch = max(len(a), len(b)) / min(len(a), len(b))
    score = ratio(a, b)
    if stretch < 1.5:
        return max(score, token_ratio(a, b) * 0.95)
    scale = 0.9 if stretch <= 8.0 else 0.6
    return max(score, partial_ratio(a, b) * scale, partial_token_ratio(a, b) * 0.95 * scale)
