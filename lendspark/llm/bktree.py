"""BK-trees over 64-bit fingerprints, one per shard, built and searched for many shards at once.

A node's children are keyed by their Hamming distance to it, and at most one child has a given distance.
Trees are built level by level: of all fingerprints that reached the same node with the same distance, the
first becomes the child and the others go on below it. A search compares the query with a node and follows
only children whose distance to that node differs from the query's by at most the radius; by the triangle
inequality no other child can hold a match. Queries move through the trees together, as numpy arrays.
"""

from __future__ import annotations

import numpy as np

# Pairs of query and node that are compared in one step; bounds the memory of a search.
STEP = 1 << 19
_SPAN = 65  # distances of 64-bit fingerprints are 0 to 64


class Forest:
    """Trees over `values`, one for each distinct number in `shard` (equal numbers stand together)."""

    def __init__(self, values: np.ndarray, shard: np.ndarray):
        self.values = values
        n = len(values)
        first = np.ones(n, dtype=bool)
        first[1:] = shard[1:] != shard[:-1]
        self.roots = np.flatnonzero(first)
        self.shards = shard[self.roots]
        edge_keys, edge_nodes = [], []
        node_of = self.roots[np.cumsum(first) - 1]
        rest = np.flatnonzero(~first)
        node = node_of[rest]
        while len(rest):
            key = node * _SPAN + np.bitwise_count(values[rest] ^ values[node])
            order = np.argsort(key, kind="stable")
            rest, key = rest[order], key[order]
            lead = np.ones(len(key), dtype=bool)
            lead[1:] = key[1:] != key[:-1]
            chosen = rest[lead]
            edge_keys.append(key[lead])
            edge_nodes.append(chosen)
            node = chosen[np.cumsum(lead) - 1][~lead]
            rest = rest[~lead]
        keys = np.concatenate(edge_keys) if edge_keys else np.empty(0, dtype=np.int64)
        nodes = np.concatenate(edge_nodes) if edge_nodes else np.empty(0, dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.nodes = keys[order], nodes[order]

    def search(self, queries: np.ndarray, shard: np.ndarray, radius: int):
        """Yield (positions of queries, nodes) of all pairs within `radius` in the query's own shard."""
        at = np.searchsorted(self.shards, shard)
        known = at < len(self.shards)
        known[known] = self.shards[at[known]] == shard[known]
        asked = np.flatnonzero(known)
        waiting = [(asked[i : i + STEP], self.roots[at[asked[i : i + STEP]]]) for i in range(0, len(asked), STEP)]
        while waiting:
            query, node = waiting.pop()
            distance = np.bitwise_count(queries[query] ^ self.values[node]).astype(np.int64)
            hit = distance <= radius
            if hit.any():
                yield query[hit], node[hit]
            low = np.searchsorted(self.keys, node * _SPAN + np.maximum(distance - radius, 0))
            high = np.searchsorted(self.keys, node * _SPAN + np.minimum(distance + radius, _SPAN - 1), side="right")
            count = high - low
            ends = np.cumsum(count)
            begin = 0
            while begin < len(count):  # in steps, as a query may follow many edges
                base = ends[begin - 1] if begin else 0
                stop = max(begin + 1, int(np.searchsorted(ends, base + STEP, side="right")))
                part = count[begin:stop]
                total = int(part.sum())
                if total:
                    offset = np.repeat(np.cumsum(part) - part, part)
                    child = np.repeat(low[begin:stop], part) + np.arange(total) - offset
                    waiting.append((np.repeat(query[begin:stop], part), self.nodes[child]))
                begin = stop


def find(parent: np.ndarray, items: np.ndarray) -> np.ndarray:
    """The root of each item."""
    root = parent[items]
    while True:
        above = parent[root]
        if np.array_equal(above, root):
            return root
        root = above


def unite(parent: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Merge the sets of each pair; the smallest index of a set becomes its root."""
    while len(left):
        a, b = find(parent, left), find(parent, right)
        apart = a != b
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        parent[:] = find(parent, np.arange(len(parent)))
