"""Distances between words that know common slips."""

from __future__ import annotations

#: Letters that are often typed or heard for each other.
ALIKE = [set("aeiou"), set("lr"), set("bp"), set("dt"), set("gkjcq"), set("mn"), set("szc"), set("vwb"), set("yi"), set("fp"), set("zj")]
_CLOSE = {(a, b) for group in ALIKE for a in group for b in group}


def slip_distance(a: str, b: str, most: float) -> float:
    """Edit distance with swaps of neighbours; letters alike and doubled letters cost less. Beyond `most`: most + 1."""
    if a == b:
        return 0.0
    if abs(len(a) - len(b)) * 0.6 > most:
        return most + 1
    before, last = [], [0.8 * j for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        row = [0.8 * i]
        for j, y in enumerate(b, 1):
            if x == y:
                best = last[j - 1]
            else:
                best = last[j - 1] + (0.7 if (x, y) in _CLOSE else 1.0)
            drop = last[j] + (0.6 if i > 1 and a[i - 2] == x else 0.8)
            add = row[j - 1] + (0.6 if j > 1 and b[j - 2] == y else 0.8)
            if drop < best:
                best = drop
            if add < best:
                best = add
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y and before[j - 2] + 0.8 < best:
                best = before[j - 2] + 0.8
            row.append(best)
        if min(row) > most:
            return most + 1
        before, last = last, row
    return last[-1]


def slips_within(a: str, b: str, most: int) -> bool:
    """Whether a becomes b by at most `most` letters added, dropped, replaced or swapped with their neighbour."""
    if abs(len(a) - len(b)) > most:
        return False
    before, last = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            best = min(last[j - 1] + (x != y), last[j] + 1, row[j - 1] + 1)
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, before[j - 2] + 1)
            row.append(best)
        if min(row) > most:
            return False
        before, last = last, row
    return last[-1] <= most


def shortened(word: str, most: int) -> set[str]:
    out, edge = {word}, {word}
    for _ in range(most):
        edge = {w[:i] + w[i + 1 :] for w in edge for i in range(len(w))}
        out |= edge
    return out
