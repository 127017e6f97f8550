"""Karmarkar-Karp multiway differencing of integer sizes."""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np


def _merged(a, b, parts: int, pairs: list[tuple[int, int]]):
    """Join two partial partitions with opposing imbalances: largest parts with smallest.

    A partition is (sums, nodes), descending, without its empty parts. ``pairs`` grows by one node
    for each two parts that become one.
    """
    (a_sums, a_nodes), (b_sums, b_nodes) = a, b
    both = max(0, len(a_sums) + len(b_sums) - parts)
    if both:
        cut_a, cut_b = len(a_sums) - both, len(b_sums) - both
        first = len(pairs)
        pairs.extend(zip(a_nodes[cut_a:].tolist(), b_nodes[cut_b:][::-1].tolist()))
        sums = np.concatenate([a_sums[:cut_a], b_sums[:cut_b], a_sums[cut_a:] + b_sums[cut_b:][::-1]])
        nodes = np.concatenate([a_nodes[:cut_a], b_nodes[:cut_b],
                                np.arange(first, first + both, dtype=np.int64)])
    else:
        sums, nodes = np.concatenate([a_sums, b_sums]), np.concatenate([a_nodes, b_nodes])
    order = (-sums).argsort(kind="stable")
    return sums[order], nodes[order]


def partition(sizes: Sequence[int], parts: int) -> list[list[int]]:
    """Indices of ``sizes`` in ``parts`` groups of near-equal sums.

    The two partial partitions with the widest spread between their largest and smallest part are
    merged until one is left. Ties go to the earlier index, so equal input gives equal output. No
    sizes give empty groups.
    """
    if parts < 1:
        raise ValueError("at least one part is needed")
    pairs: list[tuple[int, int]] = [(i, -1) for i in range(len(sizes))]
    made = [(np.array([s], dtype=np.int64), np.array([i], dtype=np.int64))
            for i, s in enumerate(sizes)]

    def spread(p) -> int:
        return int(p[0][0] - (p[0][-1] if len(p[0]) == parts else 0))

    heap = [(-spread(p), i) for i, p in enumerate(made)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, i = heapq.heappop(heap)
        _, j = heapq.heappop(heap)
        joined = _merged(made[i], made[j], parts, pairs)
        made[i] = made[j] = None
        made.append(joined)
        heapq.heappush(heap, (-spread(joined), len(made) - 1))
    groups: list[list[int]] = []
    for node in (made[heap[0][1]][1].tolist() if heap else []):
        members, todo = [], [node]
        while todo:
            left, right = pairs[todo.pop()]
            if right < 0:
                members.append(left)
            else:
                todo += (right, left)
        groups.append(sorted(members))
    return groups + [[] for _ in range(parts - len(groups))]


def windows(sizes: Sequence[int], capacity: int) -> list[list[int]]:
    """Near-equal groups of at most ``capacity``; their number rises whenever one exceeds it."""
    if not len(sizes):
        return []
    if max(sizes) > capacity:
        raise ValueError("a size exceeds the capacity")
    parts = -(-int(sum(sizes)) // capacity)
    while True:
        groups = partition(sizes, parts)
        over = sum(sum(sizes[i] for i in g) > capacity for g in groups)
        if not over:
            return groups
        parts += 1
