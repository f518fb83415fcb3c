import random
import uuid

from quire.operators import hierarchy as H
from quire.operators import labels as L


def _py_subtree(edges, nodes, root):
    if root not in nodes:
        return set()
    seen, stack = set(), [root]
    while stack:
        n = stack.pop()
        if n in seen:
            continue
        seen.add(n)
        stack.extend(c for p, c in edges if p == n)
    return seen


def _py_heights(edges, nodes):
    kids = {}
    for p, c in edges:
        kids.setdefault(p, []).append(c)
    h = {n: 0 for n in nodes if n not in kids}
    changed = True
    while changed:
        changed = False
        for p, cs in kids.items():
            if p not in h and all(c in h for c in cs):
                h[p] = 1 + max(h[c] for c in cs)
                changed = True
    out = {}
    for n in nodes:
        if n in h:
            out[n] = (h[n], True)
        else:
            resolved = [h[c] for c in kids.get(n, []) if c in h]
            out[n] = (1 + max(resolved) if resolved else -1, False)
    return out


def _graph(seed):
    rnd = random.Random(seed)
    nodes = {str(i) for i in range(1, 40)}
    edges = [(str(rnd.randint(1, i - 1)), str(i)) for i in range(2, 40)]
    edges += [(str(rnd.randint(1, 39)), str(rnd.randint(1, 39))) for _ in range(4)]  # cycles, duplicates
    return nodes, edges


def test_subtree_and_heights_match_python(spark):
    for seed in range(3):
        nodes, edges = _graph(seed)
        e = spark.createDataFrame(edges, "parent string, child string")
        n = spark.createDataFrame([(x,) for x in nodes], "id string")
        for root in ["1", "7", "missing"]:
            got = {r.id for r in H.subtree(e, n, root).collect()}
            assert got == _py_subtree(edges, nodes, root)
        got = {r.id: (r.height, r.resolved) for r in H.height_under(e, n).collect()}
        assert got == _py_heights(edges, nodes)


def test_cycle_with_resolved_leaf(spark):
    nodes = {"a", "b", "leaf", "self"}
    edges = [("a", "b"), ("b", "a"), ("b", "leaf"), ("self", "self")]
    e = spark.createDataFrame(edges, "parent string, child string")
    n = spark.createDataFrame([(x,) for x in nodes], "id string")
    got = {r.id: (r.height, r.resolved) for r in H.height_under(e, n).collect()}
    assert got == {"leaf": (0, True), "b": (1, False), "a": (-1, False), "self": (-1, False)}
    assert H.cycle_report(H.height_under(e, n)).first().n_unresolved == 3


def test_chain_of_a_thousand(spark):
    edges = [(f"p{i}", f"p{i + 1}") for i in range(1000)] + [("p3", "x"), ("p9", "x"), ("c1", "c2"), ("c2", "c1"), ("c2", "y")]
    nodes = {n for e in edges for n in e}
    e = spark.createDataFrame(edges, "parent string, child string")
    n = spark.createDataFrame([(x,) for x in nodes], "id string")
    assert sorted(r.id for r in H.subtree(e, n, "p500").collect()) == sorted(f"p{i}" for i in range(500, 1001))
    assert {r.id for r in H.subtree(e, n, "p4").collect()} == {f"p{i}" for i in range(4, 1001)} | {"x"}
    assert {r.id for r in H.subtree(e, n, "c1").collect()} == {"c1", "c2", "y"}
    got = {r.id: (r.height, r.resolved) for r in H.height_under(e, n).collect()}
    assert all(got[f"p{i}"] == (1000 - i, True) for i in range(1001))
    assert got["c1"] == (-1, False) and got["c2"] == (1, False) and got["y"] == (0, True)


def _ladder(levels):
    """Each level has two positions, and each of them reports to both of the level above."""
    return [(f"{p}{i}", f"{c}{i + 1}") for i in range(levels - 1) for p in "ab" for c in "ab"]


def _against_supervisors(levels):
    """A chain below ``r`` whose every position also reports to someone else, whose id is smaller."""
    chain = ["r", *[f"s{i}" for i in range(levels)]]
    return [*zip(chain, chain[1:]), *[(f"a{c}", c) for c in chain[1:]]]


def _frames(spark, edges, nodes=()):
    ids = {n for e in edges for n in e} | set(nodes)
    return (spark.createDataFrame(edges, "parent string, child string"),
            spark.createDataFrame([(x,) for x in ids], "id string"), ids)


def _jobs(spark, run):
    """Runs it and counts its Spark jobs."""
    group = f"hierarchy-{uuid.uuid4()}"
    spark.sparkContext.setJobGroup(group, "", False)
    out = run()
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, jobs


def test_two_supervisors_on_a_thousand_levels(spark):
    for edges, root in ((_ladder(1000), "b0"), (_against_supervisors(1000), "r")):
        e, n, ids = _frames(spark, edges)
        got, jobs = _jobs(spark, lambda: [r.id for r in H.subtree(e, n, root).collect()])
        assert sorted(got) == sorted(_py_subtree_fast(edges, root)) and jobs < 20
    heights = {r.id: r.height for r in H.height_under(*_frames(spark, _ladder(1000))[:2]).collect()}
    assert all(heights[f"{c}{i}"] == 999 - i for c in "ab" for i in range(1000))


def _py_subtree_fast(edges, root):
    kids = {}
    for p, c in edges:
        kids.setdefault(p, []).append(c)
    seen, todo = {root}, [root]
    while todo:
        for c in kids.get(todo.pop(), ()):
            if c not in seen:
                seen.add(c)
                todo.append(c)
    return seen


def _tangle(seed, n):
    rnd = random.Random(seed)
    edges = [(f"n{rnd.randint(max(0, i - 6), i - 1)}", f"n{i}") for i in range(1, n)]
    edges += [(f"n{rnd.randrange(n)}", f"n{rnd.randrange(n)}") for _ in range(n // 4)]
    edges += [("hot", f"n{i}") for i in range(0, n, 3)] + [(f"c{i}", f"c{(i + 1) % 5}") for i in range(5)]
    return edges + edges[:5]


def test_many_roots_by_rulers_and_by_rounds(spark):
    """Sampled rulers, salted children and joined rounds give the same as all in one."""
    edges = _tangle(4, 150)
    e, n, ids = _frames(spark, edges, ["alone"])
    roots = spark.createDataFrame([(x,) for x in [*sorted(ids)[::3], "missing"]], "root string")
    want = sorted((r, x) for r in sorted(ids)[::3] for x in _py_subtree_fast(edges, r))
    for rulers, extras in ((L.RULERS, L.EXTRAS), (20, L.EXTRAS), (L.RULERS, 0)):
        tree = L.label_hierarchy(e, n, rulers)
        labels = sorted(tree.nodes.collect(), key=lambda r: r.first)
        assert [r.first for r in labels] == list(range(len(ids)))
        assert all(r.first <= r.last < len(ids) for r in labels)
        assert sorted((r.root, r.id) for r in L.below(tree, roots, extras).collect()) == want


def test_subtree_is_a_range_scan(spark):
    e, n, _ = _frames(spark, [(f"n{(i - 1) // 3}", f"n{i}") for i in range(1, 200)])
    plan = H.subtree(e, n, "n1")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(first" in plan and "Join" not in plan


def test_heights_by_rounds(spark):
    for seed in range(2):
        edges = _tangle(seed, 60)
        e, n, ids = _frames(spark, edges, ["alone"])
        want = _py_heights(edges, ids)
        for tail in (0, 40, 10**6):
            assert {r.id: (r.height, r.resolved) for r in H.height_under(e, n, tail).collect()} == want


def test_empty_hierarchy(spark):
    e = spark.createDataFrame([], "parent string, child string")
    n = spark.createDataFrame([], "id string")
    assert H.subtree(e, n, "x").count() == 0 and H.height_under(e, n).count() == 0
    one = spark.createDataFrame([("x",)], "id string")
    assert [r.id for r in H.subtree(e, one, "x").collect()] == ["x"]
    assert [tuple(r) for r in H.height_under(e, one).collect()] == [("x", 0, True)]


def test_no_side_that_grows_is_broadcast(spark, monkeypatch):
    """Not one plan of labels, edge checks and subtree rows has a broadcast join, however small the files are."""
    plans = []

    def plan(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    for name in ("stored", "stored_counted"):
        monkeypatch.setattr(L, name, lambda df, *a, f=getattr(L, name): f(plan(df), *a))
    raw = spark.createDataFrame([(str(i), str(1 + i // 3)) for i in range(2, 400)] + [("1", ""), ("1", "9"), ("50", "2")], [
        "Position Number", "Reports To Position Number"])
    ids, edges = H.nodes(raw), H.build_edges(raw)
    valid = plan(H.edge_validity(edges, ids))
    tree = L.label_hierarchy(valid, ids, rulers=20)
    reached = plan(L.below(tree, ["1"])).select("id")
    rows = plan(H.subtree_rows(raw, reached)).collect()
    assert len(rows) == raw.count() and len(plans) > 10
    assert not any("BroadcastHashJoin" in p for p in plans)
