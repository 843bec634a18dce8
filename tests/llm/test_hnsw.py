import math

import numpy as np

from tidemark.llm import hnsw
from tidemark.llm.queries import QUERIES


def brute(rows, least=0.9):
    def fine(v):
        return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    best = {}
    for i, v in rows:
        if i is not None and fine(v):
            best[i] = min(best.get(i, v), v)
    ids = sorted(best)
    unit = {i: np.array(best[i], float) / np.abs(best[i]).max() for i in ids}
    unit = {i: v / np.sqrt(v @ v) for i, v in unit.items()}
    near = {i: [j for j in ids if j != i and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least] for i in ids}
    root = {}
    for i in ids:
        todo = [i] if i not in root else []
        while todo:
            x = todo.pop()
            if x not in root:
                root[x] = i
                todo += near[x]
    return sorted(((i, len(near.get(i, ())), root.get(i, i), i == root.get(i, i) if i is not None else True) for i, _ in rows), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_against_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert got(QUERIES["op2_embedding_neardup"](spark, sf_dir)) == brute(rows)


def test_clusters_wider_than_the_beam(make):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=24)
    rows = [(i, (centre + 0.1 * rng.normal(size=24)).tolist()) for i in range(300)]
    rows += [(1000 + i, rng.normal(size=24).tolist()) for i in range(300)]
    df = make([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, label int")
    assert got(hnsw.links(df, shards=2, beam=8, block=200)) == brute(rows)


def test_odd_vectors(make):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.1]), (3, [0.0, 0.0]), (4, None), (5, []), (6, [1.0, None]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [1.0, 0.0, 0.0]), (10, [-1.0, 0.0])]
    rows += [(None, [1.0, 0.0]), (1, [1.0, 0.0]), (11, [1e300, 1e299]), (12, [1e-300, 0.0]), (13, [5.0, 0.0, 0.1])]
    df = make([(i, v, 7) for i, v in rows], "vec_id long, embedding array<double>, kept int")
    assert got(hnsw.links(df, shards=2)) == brute(rows)
    assert hnsw.links(df.limit(0), shards=2).count() == 0
    assert got(hnsw.links(df.where("vec_id between 3 and 8"), shards=2)) == brute(rows[2:8])


def test_recall_of_a_graph():
    rng = np.random.default_rng(4)
    base = rng.normal(size=(400, 16))
    x = hnsw._unit(np.concatenate([base, base + 0.15 * rng.normal(size=base.shape), rng.normal(size=(2200, 16))]))
    graph = hnsw.Graph.load(hnsw.Graph(x).dump())
    found = graph.near(x, 0.9, 16)
    want = x @ x.T >= 0.9
    assert sum(want[i][f].sum() for i, f in enumerate(found)) >= 0.98 * want.sum()


def numbers(df):
    return {r.vec_id: (r.n_links, r.component_id) for r in df.collect()}


def test_half_a_shard_equal(make):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=16)
    x = np.concatenate([np.tile(centre, (5000, 1)), centre + 0.1 * rng.normal(size=(5000, 16))])
    unit = hnsw._unit(x)
    close = unit @ unit.T >= 0.9
    for r, f in enumerate(hnsw.Graph(unit).near(unit[::100], 0.9, 32)):
        assert set(np.flatnonzero(close[100 * r])) <= set(f.tolist())
    df = make([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    assert numbers(hnsw.links(df, shards=1)) == {i: (int(n) - 1, 0) for i, n in enumerate(close.sum(axis=1))}


def test_rare_links_among_copies(make):
    rng = np.random.default_rng(7)
    x = np.concatenate([np.repeat(rng.normal(size=(100, 32)), 60, axis=0), rng.normal(size=(1000, 32))])
    x = np.concatenate([x, x[-200:] + 0.3 * rng.normal(size=(200, 32))])
    unit = hnsw._unit(x)
    close = unit @ unit.T >= 0.9
    df = make([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = numbers(hnsw.links(df, shards=1))
    assert [got[i][0] for i in range(len(x))] == (close.sum(axis=1) - 1).tolist()


def test_a_graph_is_sent_once_for_several_blocks(make, monkeypatch):
    """Blocks of a lot share the graph, which carries no second copy of its vectors; lots of one block give the same."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 8))
    x = np.concatenate([x, x[:90] + 0.05 * rng.normal(size=(90, 8))])
    unit = hnsw._unit(x)
    graph = hnsw.Graph(unit)
    bare = graph.dump(vectors=False)
    assert len(bare) < len(graph.dump()) - graph.x.nbytes + 512
    again = hnsw.Graph.load(bare, unit)
    assert (again.x == graph.x).all() and all((a[0] == b[0]).all() and (a[1] == b[1]).all() for a, b in zip(again.layers, graph.layers))
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    df = make(rows, "vec_id long, embedding array<double>")
    for lot in (1, 3 * 8 * 50 * 8, hnsw.LOT):  # one block, three and all eight
        monkeypatch.setattr(hnsw, "LOT", lot)
        assert got(hnsw.links(df, shards=2, block=50)) == brute(rows)
