import random

import pytest

from quernstone.operators.hierarchy import descendants, hierarchy


def brute(parent):
    out = {}
    for n in parent:
        seen, x, path = {n: 0}, n, [n]
        while True:
            p = parent[x]
            if p is None or p not in parent:
                out[n] = (x, len(path) - 1, list(reversed(path)))
                break
            if p in seen:
                out[n] = ("(cycle)", -1 if p == n or n in cycle_of(parent, p) else -2, [n])
                break
            seen[p] = len(path)
            path.append(p)
            x = p
    return out


def cycle_of(parent, x):
    out, y = {x}, parent[x]
    while y != x:
        out.add(y)
        y = parent[y]
    return out


def forest(kind, n, seed):
    r = random.Random(seed)
    if kind == "random":
        return {f"n{i}": (f"n{r.randrange(i)}" if i and r.random() < 0.97 else None) for i in range(n)}
    if kind == "chain":
        return {f"n{i}": f"n{i - 1}" if i else None for i in range(n)}
    if kind == "hub":
        return {f"n{i}": ("n0" if i % 3 else f"n{i - 1}") if i else None for i in range(n)}
    if kind == "cycles":
        return {f"n{i}": f"n{r.randrange(n)}" for i in range(n)}
    return {f"n{i}": f"n{(i + 1) % n}" for i in range(n)}  # one long cycle


@pytest.mark.parametrize("kind", ["random", "chain", "hub", "cycles", "ring"])
@pytest.mark.parametrize("base_rows", [3, 10_000])
def test_against_brute_force(spark, kind, base_rows):
    parent = forest(kind, 120, 7)
    df = spark.createDataFrame(list(parent.items()), "node string, parent string")
    got = {r.node: (r.root, r.depth, r.path) for r in hierarchy(df, paths=True, base_rows=base_rows, part_rows=20).collect()}
    assert got == brute(parent)


def test_without_paths_is_the_same(spark):
    parent = forest("random", 80, 3)
    df = spark.createDataFrame(list(parent.items()), "node string, parent string")
    got = {r.node: (r.root, r.depth) for r in hierarchy(df, base_rows=3, part_rows=15).collect()}
    assert got == {n: v[:2] for n, v in brute(parent).items()}


def test_self_parent_unknown_parent_extra_columns_and_empty(spark):
    df = spark.createDataFrame([("a", "a", 1, "x"), ("b", "zz", 2, "y"), ("c", None, 3, "z"), ("d", "a", 4, None)], "node string, parent string, depth int, root string")
    got = {r.node: (r.root, r.depth) for r in hierarchy(df).collect()}
    assert got == {"a": ("(cycle)", -1), "b": ("b", 0), "c": ("c", 0), "d": ("(cycle)", -2)}
    assert hierarchy(df.limit(0)).count() == 0


def test_descendants(spark):
    df = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("x", "x")], "node string, parent string")
    got = {(r.ancestor, r.descendant, r.distance) for r in descendants(hierarchy(df, paths=True)).collect()}
    assert got == {("a", "b", 1), ("a", "c", 2), ("b", "c", 1)}


def brute_pairs(parent):
    """Every ancestor of every node, once and at the least distance."""
    out = set()
    for n in parent:
        seen, x, k = {n}, n, 0
        while (x := parent[x]) in parent and x not in seen:
            seen.add(x)
            k += 1
            out.add((x, n, k))
    return out


def brute_chain(parent, n):
    """From the root, or the first node of a cycle that the chain meets, to the node."""
    path, on = [n], brute(parent)
    while on[path[-1]][1] != -1 and parent[path[-1]] in parent:
        path.append(parent[path[-1]])
    return list(reversed(path))


def mixed_forest():
    """Cycles of length 1, 2 and 9 with subtrees below them, and ordinary trees."""
    p = {"s": "s", "p": "q", "q": "p"} | {f"r{i}": f"r{(i + 4) % 9}" for i in range(9)}
    p |= {"a": None, "a1": "a", "a2": "a1"}
    for i in range(60):
        p[f"t{i}"] = ["s", "q", "r3", "r7", "a2"][i % 5] if i < 10 else f"t{i - 7}"
    return p


@pytest.mark.parametrize("base_rows", [30, 10_000])
def test_chains_and_descendants_of_cyclic_chains_against_brute_force(spark, base_rows):
    parent = mixed_forest()
    df = spark.createDataFrame(list(parent.items()), "node string, parent string")
    tree = hierarchy(df, paths=True, base_rows=base_rows, part_rows=20)
    assert {r.node: r.chain for r in tree.collect()} == {n: brute_chain(parent, n) for n in parent}
    got = [(r.ancestor, r.descendant, r.distance) for r in descendants(tree).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_pairs(parent)


def test_the_table_itself_is_never_solved_in_one_task(spark, monkeypatch):
    from quernstone.operators import hierarchy as h

    parent, levels, solve = forest("random", 60, 5), [], h._solve
    monkeypatch.setattr(h, "_solve", lambda edges, level, *a: levels.append(level) or solve(edges, level, *a))
    df = spark.createDataFrame(list(parent.items()), "node string, parent string")
    assert {r.node: (r.root, r.depth) for r in hierarchy(df).collect()} == {n: v[:2] for n, v in brute(parent).items()}
    assert levels == [0, 1]


@pytest.mark.parametrize("kind", ["chain", "random"])
def test_every_level_is_less_than_six_tenths_of_the_one_before(spark, monkeypatch, kind):
    from quernstone.operators import hierarchy as h

    parent, sizes, solve = forest(kind, 3000, 5), [], h._solve
    monkeypatch.setattr(h, "_solve", lambda edges, level, *a: sizes.append(edges.count()) or solve(edges, level, *a))
    df = spark.createDataFrame(list(parent.items()), "node string, parent string")
    assert {r.node: (r.root, r.depth) for r in hierarchy(df, base_rows=200).collect()} == {n: v[:2] for n, v in brute(parent).items()}
    assert len(sizes) > 2 and all(b < 0.6 * a for a, b in zip(sizes, sizes[1:], strict=False))


def test_no_fragment_is_hot(spark):
    from quernstone.operators import hierarchy as h

    rows = [(f"h{i}", "top") for i in range(2000)] + [(f"l{i}", f"h{i}") for i in range(2000)] + [("top", None)]
    rows += [(f"z{i}", f"l{i}") for i in range(2000)]
    df = spark.createDataFrame(rows, "node string, parent string")
    assert max(r["count"] for r in h._labels(df.where("node not like 'z%'"), 0).groupBy("label").count().collect()) < 60
