from __future__ import annotations

import numpy as np

from pyspark.sql import functions as F

from ordersight.llm import embedding_links as el
from ordersight.llm.components import components


def expected(rows):
    usable = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    size = max(len(v) for _, v in usable)
    x = np.array([np.append(v, np.zeros(size - len(v))) for _, v in usable])
    x /= np.linalg.norm(x, axis=1)[:, None]
    close = x @ x.T >= el.LEAST
    np.fill_diagonal(close, False)
    component = {i: i for i, _ in usable}
    for _ in usable:
        for a, b in zip(*np.nonzero(close)):
            i, j = usable[a][0], usable[b][0]
            component[i] = component[j] = min(component[i], component[j])
    links = {i: int(n) for (i, _), n in zip(usable, close.sum(1))}
    return sorted(((i, links.get(i, 0), component.get(i, i), component.get(i, i) == i or i is None) for i, _ in rows), key=repr)


def found(spark, rows):
    frame = spark.createDataFrame([(i, v, 1, "x", "y") for i, v in rows], "vec_id long, embedding array<float>, label int, id string, vector string")
    return sorted((tuple(r) for r in el.embedding_links(frame).collect()), key=repr)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, None]), (7, [nan, 1.0]), (8, [inf, 1.0]),
            (9, [1.0, 0.25]), (10, [0.0, 1.0]), (11, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (12, [1.0, 0.0])]
    assert found(spark, rows) == expected(rows)


def test_empty(spark):
    assert found(spark, []) == []


def test_random_groups(spark):
    """Many lone vectors, pairs, and groups larger than a list of neighbours."""
    draw = np.random.default_rng(4)
    rows = [draw.normal(size=32) for _ in range(700)]
    for center in range(30):
        rows += [rows[center] + draw.normal(size=32) * 0.2 for _ in range(1 + center % 3)]
    rows += [rows[0] + draw.normal(size=32) * 0.25 for _ in range(40)]
    rows += [rows[1]] * 20
    named = [(k, [float(np.float32(x)) for x in v]) for k, v in enumerate(rows)]
    mine, true = found(spark, named), expected(named)
    assert sum(r[1] for r in mine) >= 0.98 * sum(r[1] for r in true)
    assert sum(a == b for a, b in zip(mine, true)) >= 0.97 * len(true)
    assert all(a[1] <= b[1] for a, b in zip(mine, true))


def around(draw, center, cosine, count):
    """Vectors with about this cosine to each other."""
    center = center / np.linalg.norm(center)
    noise = draw.normal(size=(count, len(center)))
    noise -= np.outer(noise @ center, center)
    noise /= np.linalg.norm(noise, axis=1)[:, None]
    return center * np.sqrt(cosine) + noise * np.sqrt(1 - cosine)


def test_links_between_saturated_groups(spark):
    """Two clumps whose lists hold only links inside: 0.99 within a clump, 0.92 between them."""
    draw = np.random.default_rng(8)
    one, side = np.eye(64)[:2]
    clumps = [around(draw, c, 0.99, 12) for c in (one, 0.93 * one + np.sqrt(1 - 0.93**2) * side)]
    rows = [*clumps[0], *clumps[1], *draw.normal(size=(300, 64))]
    named = [(k, [float(np.float32(x)) for x in v]) for k, v in enumerate(rows)]
    true = expected(named)
    assert true[0][1] == 23 and sum(r[1] for r in true) == 24 * 23
    assert found(spark, named) == true


def test_parts_of_a_tight_group_meet(spark):
    """A leaf too large for one task is cut in another way by each tree, so the lists alone join its vectors."""
    draw = np.random.default_rng(5)
    rows = [*(draw.normal(size=64) + 1e-5 * draw.normal(size=(1100, 64))), *draw.normal(size=(500, 64))]
    frame = spark.createDataFrame([(k, [float(x) for x in v]) for k, v in enumerate(rows)], "vec_id long, embedding array<double>")
    lists, _ = el.neighbour_lists(el._usable(frame))
    links = lists.select(F.col("id").alias("a"), F.explode(F.arrays_zip("ids", "cosines")).alias("x")).where(F.col("x.cosines") >= el.LEAST)
    assert components(links.select("a", F.col("x.ids").alias("b"))).where("id < 1100").select("component").distinct().count() == 1
    mine = el.embedding_links(frame).where("vec_id < 1100").select("n_links", "component_id").distinct().collect()
    assert [tuple(r) for r in mine] == [(1099, 0)]


def test_all_pairs_when_the_audit_fails(spark, monkeypatch):
    """Lists that lost links, or a result that lost some beyond the lists, give way to all pairs."""
    draw = np.random.default_rng(6)
    rows = [*draw.normal(size=(150, 16)), *around(draw, np.eye(16)[0], 0.99, 30), *around(draw, np.eye(16)[3], 0.95, 5)]
    rows += [*rows[:20], *(x + 0.1 * draw.normal(size=16) for x in rows[20:60])]
    named = [(k, [float(np.float32(x)) for x in v]) for k, v in enumerate(rows)]
    monkeypatch.setattr(el, "BLOCK", 64)
    complete = el.neighbour_lists
    monkeypatch.setattr(el, "neighbour_lists", lambda *a: (complete(*a)[0].where("id % 3 = 0"), [0.5]))
    assert found(spark, named) == expected(named)
    monkeypatch.setattr(el, "neighbour_lists", lambda *a: (complete(*a)[0].where("id % 3 = 0"), [1.0]))
    assert found(spark, named) == expected(named)


def test_joined_ids():
    close = np.array([[1, 0, 0], [1, 1, 0], [0, 0, 1]], bool)
    one, other = el.joined_ids(np.array([7, 8, 9]), np.array([3, 4, 5]), close)
    assert one.tolist() == [3, 3, 5] and other.tolist() == [3, 3, 5]
