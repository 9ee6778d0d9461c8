"""Minimum cut of a small graph with two terminals, by blocking flows."""

from __future__ import annotations


def content_side(source: list[int], sink: list[int], edges: list[tuple[int, int, int, int]]) -> list[bool]:
    """Nodes on the source's side of a minimum cut.

    ``source[i]`` and ``sink[i]`` are the capacities that tie node i to the terminals, ``edges`` (a, b, capacity
    from a to b, capacity back). Of several minimum cuts it is that with the smallest source side.
    """
    n = len(source)
    # what can go straight from source over a node to the sink goes first; then a node has one terminal at most
    excess = [s - t for s, t in zip(source, sink, strict=True)]
    sources = [i for i in range(n) if excess[i] > 0]
    near: list[list[int]] = [[] for _ in range(n)]
    head: list[int] = []
    room: list[int] = []
    for a, b, there, back in edges:
        if there > 0 or back > 0:
            near[a].append(len(head))
            near[b].append(len(head) + 1)
            head += [b, a]
            room += [there, back]
    while True:
        level = [-1] * n
        queue = [i for i in sources if excess[i] > 0]
        for i in queue:
            level[i] = 0
        reached = False
        for i in queue:  # grows while it is read
            reached = reached or excess[i] < 0
            for e in near[i]:
                j = head[e]
                if room[e] > 0 and level[j] < 0:
                    level[j] = level[i] + 1
                    queue.append(j)
        if not reached:
            return [x >= 0 for x in level]
        turn = [0] * n
        for start in sources:
            while excess[start] > 0:
                path, i = [], start
                while excess[i] >= 0:
                    if turn[i] < len(near[i]):
                        e = near[i][turn[i]]
                        if room[e] > 0 and level[head[e]] == level[i] + 1:
                            path.append(e)
                            i = head[e]
                        else:
                            turn[i] += 1
                    elif path:
                        i = head[path.pop() ^ 1]
                        turn[i] += 1
                    else:
                        break
                if excess[i] >= 0:
                    break
                flow = min(excess[start], -excess[i], *(room[e] for e in path))
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                excess[start] -= flow
                excess[i] += flow
