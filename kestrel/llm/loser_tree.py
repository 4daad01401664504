"""Merging sorted runs of byte strings with a loser tree that knows prefixes.

Each string that waits in the tree carries the length of the prefix it shares
with the string given out last. Of two waiting strings the one that shares more
is smaller, without a look at either; only at equal length are bytes compared,
from that place on, and the loser then carries the length shared with the winner.
So no byte of a prefix already known to be common is compared again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence


def shared_prefix(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the longest common prefix, known to be at least ``start``."""
    most = min(len(a), len(b))
    if start >= most or a[start] != b[start]:
        return start
    step = 8
    while start + step <= most and a[start:start + step] == b[start:start + step]:
        start += step
        step *= 2
    step = min(step, most - start)
    while step:
        if a[start:start + step] == b[start:start + step]:
            start += step
            step = min(step, most - start)
        else:
            step //= 2
    return start


def merge(runs: Sequence[tuple[Sequence[bytes], Sequence[int]]]) -> Iterator[tuple[int, int, int]]:
    """Merge runs given as (sorted strings, shared prefix with the run's previous
    string). Yields (run, place in the run, prefix shared with the string before it
    in the merged order). Equal strings come in the order of their runs."""
    k = 1
    while k < len(runs):
        k *= 2
    strings = [r[0] for r in runs]
    shares = [r[1] for r in runs]
    size = [len(s) for s in strings]
    place = [0] * len(runs)
    shared = [0] * k  # with the string given out last; -1: the run is at its end
    for i in range(k):
        if i >= len(runs) or not size[i]:
            shared[i] = -1

    def play(x: int, y: int) -> tuple[int, int]:
        """(winner, loser) of the runs x and y; sets what the loser shares."""
        p, q = shared[x], shared[y]
        if p != q:
            return (x, y) if p > q else (y, x)
        if p < 0:
            return x, y
        a, b = strings[x][place[x]], strings[y][place[y]]
        n = shared_prefix(a, b, p)
        if n == len(a) and (n < len(b) or x < y):
            shared[y] = n
            return x, y
        if n == len(b) or b[n] < a[n]:
            shared[x] = n
            return y, x
        shared[y] = n
        return x, y

    # Build: play every pair of a level, losers stay in the inner nodes.
    losers = [0] * k
    level = list(range(k))
    node = k // 2
    while len(level) > 1:
        up = []
        for i in range(0, len(level), 2):
            win, lose = play(level[i], level[i + 1])
            losers[node + i // 2] = lose
            up.append(win)
        level = up
        node //= 2
    winner = level[0]
    while shared[winner] >= 0:
        at = place[winner]
        yield winner, at, shared[winner]
        at += 1
        place[winner] = at
        shared[winner] = shares[winner][at] if at < size[winner] else -1
        node = (winner + k) // 2
        while node:
            other = losers[node]
            p, q = shared[winner], shared[other]
            if q > p:
                losers[node], winner = winner, other
            elif p == q and p >= 0:
                winner, losers[node] = play(winner, other)
            node //= 2
