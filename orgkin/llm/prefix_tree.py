"""A prefix tree over ordered sets, searched for sets that overlap enough.

Plain NumPy on one bounded group of sets; the join in ``jaccard_join`` decides which sets
meet and splits large groups.
"""

from __future__ import annotations

import numpy as np


def enough(a, b, percent: int):
    """The least overlap at which sets of sizes ``a`` and ``b`` link."""
    return -(-percent * (a + b) // (100 + percent))


def _ranges(starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """The whole numbers of all the ranges, one after the other."""
    sizes = stops - starts
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


class PrefixTree:
    """Sets in one global order, tokens that most sets hold first, so that similar sets
    share a path. Unbranched stretches are one edge."""

    def __init__(self, sets: list[np.ndarray]):
        self.lengths = np.array([len(s) for s in sets])
        flat = np.concatenate(sets)
        values, inverse, counts = np.unique(flat, return_inverse=True, return_counts=True)
        rank = np.empty(len(values), np.int32)
        rank[np.argsort(-counts, kind="stable")] = np.arange(len(values), dtype=np.int32)
        tokens = rank[inverse]
        owner = np.repeat(np.arange(len(sets)), self.lengths)
        self.tokens = tokens[np.lexsort((tokens, owner))]
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        self.n_tokens = len(values)
        self._build()

    def of(self, i: int) -> np.ndarray:
        return self.tokens[self.starts[i]: self.starts[i + 1]]

    def _shared(self, i: int, j: int) -> int:
        a, b = self.of(i), self.of(j)
        k = min(len(a), len(b))
        other = np.flatnonzero(a[:k] != b[:k])
        return int(other[0]) if len(other) else k

    def _build(self) -> None:
        m = len(self.lengths)
        order = sorted(range(m), key=lambda i: self.of(i).astype(">u4").tobytes())
        self.order = np.array(order)  # leaf -> set
        shared = [self._shared(order[i], order[i + 1]) for i in range(m - 1)] + [0]
        # Nodes as (parent, depth, first leaf, end leaf); a stack holds the current path.
        parent, depth, first, end = [-1], [0], [0], [m]
        path = [0]
        for leaf in range(m):
            node = len(depth)
            parent.append(path[-1])
            depth.append(int(self.lengths[order[leaf]]))
            first.append(leaf)
            end.append(leaf + 1)
            path.append(node)
            common, last = shared[leaf], node
            while len(path) > 1 and depth[path[-1]] > common or path[-1] == node:
                last = path.pop()
                end[last] = leaf + 1
            if depth[path[-1]] < common:  # the edge to ``last`` branches here
                fork = len(depth)
                parent.append(path[-1])
                depth.append(common)
                first.append(first[last])
                end.append(m)
                parent[last] = fork
                path.append(fork)
        end[0] = m
        self.parent, self.depth = np.array(parent), np.array(depth)
        self.first, self.end = np.array(first), np.array(end)
        kids: list[list[int]] = [[] for _ in depth]
        for node in range(1, len(depth)):
            kids[parent[node]].append(node)
        level, self.levels = [0], []
        while level:
            self.levels.append(np.array(level))
            level = [k for n in level for k in kids[n]]
        self.kid_starts = np.concatenate([[0], np.cumsum([len(k) for k in kids])])
        self.kids = np.array([k for ks in kids for k in ks], np.int64)
        self.is_leaf = np.diff(self.kid_starts) == 0
        head = self.starts[self.order[self.first]]
        edge_from = head + np.where(self.parent >= 0, self.depth[self.parent], 0)
        self.last = self.tokens[np.maximum(head + self.depth - 1, 0)]
        # For each token the nodes on whose edges it lies; a shared path counts once.
        sizes = head + self.depth - edge_from
        node = np.repeat(np.arange(len(sizes)), sizes)
        on_edge = self.tokens[_ranges(edge_from, edge_from + sizes)]
        by_token = np.argsort(on_edge, kind="stable")
        self.posted = node[by_token]
        self.posts = np.searchsorted(on_edge[by_token], np.arange(self.n_tokens + 1))
        by_leaf = self.lengths[self.order]
        self.shortest = self._spread(by_leaf, np.minimum)
        self.longest = self._spread(by_leaf, np.maximum)

    def _spread(self, by_leaf: np.ndarray, pick) -> np.ndarray:
        """A value for each node from those of its leaves, from the lowest level up."""
        out = by_leaf[self.first].copy()
        for nodes in reversed(self.levels[1:]):
            pick.at(out, self.parent[nodes], out[nodes])
        return out

    def links(self, group: np.ndarray, probes: np.ndarray, percent: int) -> list[tuple[int, int]]:
        """Links between sets of different groups, at least one of them a probe, that join
        the groups; those within a group that has already formed are not looked for.

        A probe walks the tree level by level. All sets below a node share the overlap of
        their path; the node goes when that plus what can still follow, by the lengths of the
        probe and of the sets below, is too little.
        """
        group = group.copy()
        every = bool(probes.all())
        found: list[tuple[int, int]] = []
        stale = True
        for x in sorted(np.flatnonzero(probes), key=lambda i: -self.lengths[i]):
            if stale:
                by_leaf = group[self.order]
                low, high = self._spread(by_leaf, np.minimum), self._spread(by_leaf, np.maximum)
                stale = False
                if low[0] == high[0]:
                    break
            mine, size = self.of(x), self.lengths[x]
            gain = np.bincount(
                self.posted[_ranges(self.posts[mine], self.posts[mine + 1])], minlength=len(self.depth)
            )
            nodes, overlap = np.zeros(1, np.int64), np.zeros(1, np.int64)
            while len(nodes):
                begin, stop = self.kid_starts[nodes], self.kid_starts[nodes + 1]
                below = self.kids[_ranges(begin, stop)]
                over = np.repeat(overlap, stop - begin)
                far = ~((low[below] == group[x]) & (high[below] == group[x]))
                far &= self.longest[below] * 100 >= percent * size
                far &= self.shortest[below] <= (size if every else size * 100 // percent)
                below, over = below[far], over[far]
                over = over + gain[below]
                mine_left = size - np.searchsorted(mine, self.last[below], "right")
                mine_left = np.where(self.depth[below] > 0, mine_left, size)
                more = np.minimum(self.longest[below] - self.depth[below], mine_left)
                hope = over + more >= enough(size, self.shortest[below], percent)
                below, over = below[hope], over[hope]
                leaf = self.is_leaf[below]
                for y, o in zip(self.order[self.first[below[leaf]]], over[leaf], strict=True):
                    if group[y] != group[x] and o >= enough(size, self.lengths[y], percent):
                        found.append((int(x), int(y)))
                        group[group == group[y]] = group[x]
                        stale = True
                nodes, overlap = below[~leaf], over[~leaf]
        return found
