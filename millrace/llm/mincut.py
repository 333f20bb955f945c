"""Minimum cuts of small local graphs (Dinic's algorithm)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence


def min_cut(source_cost: Sequence[float], sink_cost: Sequence[float], edges: Iterable[tuple[int, int, float]]) -> list[bool]:
    """The labelling of least cost: True for nodes on the source's side.

    A node on the sink's side pays its ``source_cost``, one on the source's side its ``sink_cost``; each undirected
    edge ``(i, j, weight)`` whose ends differ pays its weight. Of equal cuts it is the one with the fewest nodes on
    the source's side.
    """
    n = len(source_cost)
    s, t = n, n + 1
    head: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[float] = []

    def arc(u: int, v: int, forth: float, back: float) -> None:
        head[u].append(len(to))
        to.append(v)
        room.append(forth)
        head[v].append(len(to))
        to.append(u)
        room.append(back)

    for i in range(n):
        # What runs straight from source to sink over a node is spent on either side.
        gain = source_cost[i] - sink_cost[i]
        if gain > 0:
            arc(s, i, gain, 0.0)
        elif gain < 0:
            arc(i, t, -gain, 0.0)
    for i, j, weight in edges:
        if i != j and weight > 0:
            arc(i, j, weight, weight)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = [s]
        for u in queue:
            for e in head[u]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [level[i] >= 0 for i in range(n)]
        at = [0] * (n + 2)
        path: list[int] = []
        u = s
        while True:
            if u == t:
                push = min(room[e] for e in path)
                for e in path:
                    room[e] -= push
                    room[e ^ 1] += push
                first = next(k for k, e in enumerate(path) if room[e] <= tiny)
                u = to[path[first] ^ 1]
                del path[first:]
                continue
            while at[u] < len(head[u]):
                e = head[u][at[u]]
                if room[e] > tiny and level[to[e]] == level[u] + 1:
                    break
                at[u] += 1
            if at[u] < len(head[u]):
                path.append(head[u][at[u]])
                u = to[path[-1]]
            elif u == s:
                break
            else:
                level[u] = -1
                u = to[path.pop() ^ 1]
                at[u] += 1
