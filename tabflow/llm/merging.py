"""Merging adjacent symbols in order of priority, for both token operators."""

from __future__ import annotations

import heapq
from collections.abc import Callable

NEVER = float("inf")
SHORT = 48  # up to so many symbols a plain list is the faster agenda


def merge_adjacent(symbols: list[str], priority: Callable[[str, str], float]) -> list[str]:
    """Join neighbours until every pair's priority is ``NEVER``: the lowest first, then the leftmost.

    For long texts a heap is the agenda, and a pair that a merge has overtaken is dropped
    when its turn comes. So n symbols take O(n log n), however long the text.
    """
    if len(symbols) <= SHORT:
        return _merge_short(list(symbols), priority)
    parts: list[str | None] = list(symbols)
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    agenda: list[tuple[float, int, str, str]] = []

    def offer(left: int) -> None:
        right = after[left]
        if right < n and (p := priority(parts[left], parts[right])) != NEVER:
            heapq.heappush(agenda, (p, left, parts[left], parts[right]))

    for i in range(n - 1):
        offer(i)
    while agenda:
        _, left, a, b = heapq.heappop(agenda)
        right = after[left]
        if parts[left] != a or right >= n or parts[right] != b:
            continue
        parts[left], parts[right] = a + b, None
        after[left] = after[right]
        if after[left] < n:
            before[after[left]] = left
        offer(left)
        if before[left] >= 0:
            offer(before[left])
    return [x for x in parts if x is not None]


def _merge_short(parts: list[str], priority: Callable[[str, str], float]) -> list[str]:
    agenda = [priority(a, b) for a, b in zip(parts, parts[1:])]
    while agenda and (least := min(agenda)) != NEVER:
        at = agenda.index(least)
        del agenda[at]
        parts[at] += parts.pop(at + 1)
        if at:
            agenda[at - 1] = priority(parts[at - 1], parts[at])
        if at < len(agenda):
            agenda[at] = priority(parts[at], parts[at + 1])
    return parts
