import random
from collections import deque

from orgmill.operators import pages


def plain(seeds, edges):
    out, after = {s: 0 for s in seeds}, {}
    for a, b in edges:
        after.setdefault(a, []).append(b)
    queue = deque(out)
    while queue:
        a = queue.popleft()
        for b in after.get(a, ()):
            if b not in out:
                out[b] = out[a] + 1
                queue.append(b)
    return out


def found(spark, seeds, edges, rounds=None):
    got = pages.reach(spark.createDataFrame([(s,) for s in seeds], "id long"), spark.createDataFrame(edges, "a long, b long"), rounds).collect()
    assert len(got) == len({r["id"] for r in got})
    return {r["id"]: r["depth"] for r in got}


def test_a_chain_of_5000_pages_takes_few_rounds(spark):
    edges, rounds = [(i, i + 1) for i in range(5000)], []
    assert found(spark, [0], edges, rounds) == {i: i for i in range(5001)} and len(rounds) <= 20


def test_depths_equal_breadth_first(spark):
    rng = random.Random(4)
    for n, m, chains in ((30, 60, 6), (60, 40, 12), (8, 20, 2)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
        new = 1000
        for _ in range(chains):  # stretches between nodes, into nowhere, out of nowhere, and circles
            length = rng.randint(1, 12)
            own = list(range(new, new + length))
            new += length
            head, tail = rng.choice([rng.randrange(n), None]), rng.choice([rng.randrange(n), None])
            path = ([head] if head is not None else []) + own + ([tail] if tail is not None else [])
            edges += list(zip(path, path[1:]))
        edges += [(5000, 5001), (5001, 5002), (5002, 5000), (6000, 6000), (7, 7)]
        seeds = [rng.randrange(n), rng.randrange(n), 99, 1003]
        assert found(spark, seeds, edges + edges[:5]) == plain(seeds, edges)
    assert found(spark, [1], []) == {1: 0} and found(spark, [], [(1, 2)]) == {}
