"""Byte-pair merging with a heap of adjacent pairs and a linked list of symbols."""

from __future__ import annotations

from collections.abc import Callable
from heapq import heapify, heappop, heappush


def merge_pairs(symbols: list, rank: Callable) -> list:
    """Merge the adjacent pair of lowest rank, the leftmost of equals, until none has a rank.

    ``rank`` gives the rank of a joined pair or None. Symbols form a linked list; a heap entry whose symbols have
    changed since is skipped. A text of n symbols takes n log n steps.
    """
    n = len(symbols)
    if n < 2:
        return symbols
    heap = []
    for i in range(n - 1):
        r = rank(symbols[i] + symbols[i + 1])
        if r is not None:
            heap.append((r, i, symbols[i] + symbols[i + 1]))
    if not heap:
        return symbols
    heapify(heap)
    symbols = list(symbols)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    while heap:
        _, i, pair = heappop(heap)
        j = after[i] if symbols[i] is not None else n
        if j >= n or symbols[i] + symbols[j] != pair:
            continue
        symbols[i], symbols[j] = pair, None
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            r = rank(pair + symbols[k])
            if r is not None:
                heappush(heap, (r, i, pair + symbols[k]))
        h = before[i]
        if h >= 0:
            r = rank(symbols[h] + pair)
            if r is not None:
                heappush(heap, (r, h, symbols[h] + pair))
    return [s for s in symbols if s is not None]
