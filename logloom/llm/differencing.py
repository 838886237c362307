"""Multiway number partitioning by Karmarkar and Karp's differencing method."""

from __future__ import annotations

import heapq

import numpy as np


def differenced(sizes: np.ndarray, ways: int) -> list[list[int]]:
    """The numbers' places in ``ways`` groups of nearly equal sums.

    Each number begins as a partial partition with one filled group. The two partial partitions with the largest
    imbalance are merged, the fullest group of one with the emptiest of the other, until one is left. Only filled
    groups are kept, so memory grows with the numbers and not with numbers times ways.
    """
    count = len(sizes)
    if ways == 1 or count == 0:
        return [list(range(count))] + [[] for _ in range(ways - 1)]
    left, right = np.full(count, -1, np.int64), np.full(count, -1, np.int64)
    nodes = count
    single, at = np.argsort(-sizes, kind="stable"), 0
    merged: list[tuple[int, int, np.ndarray, np.ndarray]] = []

    def largest() -> tuple[int, int, np.ndarray, np.ndarray]:
        """The next by imbalance, then place: a number of its own or a merged partial partition."""
        nonlocal at
        if at < count and (not merged or (-int(sizes[single[at]]), int(single[at])) < merged[0][:2]):
            at += 1
            k = single[at - 1 : at]
            return -int(sizes[k[0]]), int(k[0]), sizes[k].astype(np.int64), k
        return heapq.heappop(merged)

    parts = count
    while parts > 1:
        before = at
        _, order, sums, trees = largest()
        if at > before:  # numbers in a row: with a group to spare the largest is the imbalance, so each joins the one before
            end = at
            while end < min(count, before + ways) and (not merged or (-int(sizes[single[end]]), int(single[end])) < merged[0][:2]):
                end += 1
            if end > at:
                at, trees = end, single[before:end].copy()
                sums, order = sizes[trees].astype(np.int64), int(trees[-1])
                parts -= len(trees) - 1
                least = int(sums[-1]) if len(sums) == ways else 0
                heapq.heappush(merged, (least - int(sums[0]), order, sums, trees))
                continue
        _, order, more, others = largest()
        parts -= 1
        if len(sums) == ways and len(more) == 1:  # one number into the emptiest group
            left[nodes - count], right[nodes - count] = trees[-1], others[0]
            total = sums[-1] + more[0]
            to = int(np.searchsorted(-sums[:-1], -total, "right"))
            sums[to + 1 :], trees[to + 1 :] = sums[to:-1], trees[to:-1]
            sums[to], trees[to] = total, nodes
            nodes += 1
        else:
            more, others = more[::-1], others[::-1]
            shared = max(0, len(sums) + len(more) - ways)
            alone = len(sums) - shared
            made = np.arange(nodes, nodes + shared)
            left[made - count], right[made - count] = trees[alone:], others[:shared]
            nodes += shared
            sums = np.concatenate([sums[:alone], sums[alone:] + more[:shared], more[shared:]])
            trees = np.concatenate([trees[:alone], made, others[shared:]])
            down = np.argsort(-sums, kind="stable")
            sums, trees = sums[down], trees[down]
        least = int(sums[-1]) if len(sums) == ways else 0
        heapq.heappush(merged, (least - int(sums[0]), order, sums, trees))
    groups = []
    for tree in largest()[3]:
        group, todo = [], [int(tree)]
        while todo:
            node = todo.pop()
            if node < count:
                group.append(node)
            else:
                todo += [int(right[node - count]), int(left[node - count])]
        groups.append(sorted(group))
    return groups + [[] for _ in range(ways - len(groups))]
