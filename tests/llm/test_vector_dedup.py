import numpy as np
import pytest
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, LongType, StringType, StructField, StructType

from sensorloom.llm import vector_dedup
from tests.conftest import tuples


def schema(number=FloatType(), key=LongType()) -> StructType:
    return StructType(
        [StructField("vec_id", key), StructField("embedding", ArrayType(number)), StructField("label", IntegerType())]
    )


def by_hand(rows: list[tuple], cosine: float = 0.98) -> list[tuple]:
    """All pairs, one after another."""

    def usable(vector):
        return vector is not None and len(vector) and all(x is not None and np.isfinite(x) for x in vector) and any(vector)

    links: dict[int, set[int]] = {i: set() for i in range(len(rows))}
    units = {i: vector_dedup.unit(np.array([r[1]]))[0] for i, r in enumerate(rows) if usable(r[1]) and None not in (r[0], r[2])}
    for i in units:
        for j in units:
            if i < j and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]) and units[i] @ units[j] >= cosine:
                links[i].add(j)
                links[j].add(i)
    out = []
    for i, (key, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            todo += (new := links[todo.pop()] - seen)
            seen |= new
        smallest = min((rows[j][0] for j in seen), default=key) if key is not None else None
        out.append((key, len(links[i]), smallest, key is None or key == smallest))
    return sorted(out, key=repr)


def clustered(rng: np.random.Generator, count: int, width: int = 16) -> np.ndarray:
    """Chains and clumps of vectors around a few centres, and vectors alone."""
    centers = rng.normal(size=(12, width))
    spread = rng.choice([0.01, 0.1, 0.25, 1.0], count)[:, None]
    return centers[rng.integers(0, 12, count)] + rng.normal(size=(count, width)) * spread


@pytest.mark.parametrize("block", [vector_dedup.BLOCK, 64, 7])
def test_equals_all_pairs(spark, block):
    rng = np.random.default_rng(5)
    vectors = clustered(rng, 900).astype(np.float32)
    vectors[300:420] = vectors[300]  # copies
    vectors[420:430] = 2 * vectors[301]  # the same direction
    labels = rng.choice([0, 1, 1, 1, 2], 900)
    rows = [(int(i), vectors[i].tolist(), int(labels[i])) for i in rng.permutation(900)]
    found = vector_dedup.near_vectors(spark.createDataFrame(rows, schema()), block=block)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert tuples(found) == by_hand(rows)


def test_vectors_that_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    one = [1.0, 0.0, 0.0]
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, -0.0, 0.0], 0), (4, [1.0, None, 0.0], 0), (5, [nan, 0.0, 0.0], 0), (6, [1.0, inf, 0.0], 0)]
    rows += [(7, one, None), (8, one, 0), (9, one, 0), (10, [1.0, -0.0, 0.0], 0), (None, one, 0), (None, None, None), (11, [1.0], 0)]
    rows += [(12, [1e300, 1e300, 0.0], 5), (13, [1e-300, 1e-300, 0.0], 5), (14, [-1.0, -1.0, 0.0], 5), (15, one, 1), (None, one, 0)]
    found = vector_dedup.near_vectors(spark.createDataFrame(rows, schema(DoubleType())))
    assert tuples(found) == by_hand(rows)


def test_repeated_identifiers_are_one_in_components(spark):
    a, b = [1.0, 0.0], [0.0, 1.0]
    rows = [(1, a, 0), (1, b, 0), (2, a, 0), (3, b, 0), (4, [1.0, 1.0], 0)]
    found = {(r["vec_id"], r["component_id"], r["kept"]) for r in vector_dedup.near_vectors(spark.createDataFrame(rows, schema())).collect()}
    assert found == {(1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True)}


def test_empty_table_other_names_and_kinds(spark):
    assert vector_dedup.near_vectors(spark.createDataFrame([], schema())).collect() == []
    rows = [("b", [1.0, 0.0], 1), ("a", [1.0, 0.01], 1), ("c", [0.0, 1.0], 1)]
    df = spark.createDataFrame(rows, schema(key=StringType()))
    more = df.selectExpr("*", *(f"'x' as `{c}`" for c in ("id", "vector", "one", "two", "copies", "node", "cell", "links", "a.b", "width")))
    assert tuples(vector_dedup.near_vectors(more)) == by_hand(rows)


def test_the_tree_nests_and_covers():
    rng = np.random.default_rng(1)
    points = vector_dedup.unit(clustered(rng, 700))
    nodes, order = vector_dedup.cover_tree(points)
    assert sorted(order) == list(range(700))
    points = points[order]
    for node in nodes:
        own = points[node["begin"] : node["end"]]
        assert np.linalg.norm(own - points[node["center"]], axis=1).max() <= node["radius"] + 1e-6
        children = nodes[node["first"] : node["last"]]
        if len(children):
            assert children["begin"][0] == node["begin"] and children["end"][-1] == node["end"]
            assert (children["begin"][1:] == children["end"][:-1]).all()
            assert children["center"][0] == node["center"]
            apart = np.linalg.norm(points[children["center"]][:, None] - points[children["center"]], axis=2)
            assert apart[~np.eye(len(children), dtype=bool)].min(initial=9) >= children["radius"].max() - 1e-6


def test_far_pairs_are_not_opened(monkeypatch):
    """Two far clumps: the pair of roots is dropped."""
    rng = np.random.default_rng(1)
    x, y = (vector_dedup.unit(c + 0.001 * rng.normal(size=(200, 8))) for c in (np.eye(8)[0], np.eye(8)[1]))
    blocks = []
    for points in (x, y):
        nodes, order = vector_dedup.cover_tree(points)
        blocks.append(vector_dedup.Block(points[order], np.ones(200, np.int64), nodes))
    opened = []
    monkeypatch.setattr(vector_dedup.Block, "opened", lambda self, node, f=vector_dedup.Block.opened: opened.append(node) or f(self, node))
    vector_dedup.traverse(*blocks)
    assert len(opened) == 2
    opened.clear()
    links, label = vector_dedup.linked_vectors(blocks[0], blocks[0], True)
    assert (links == 199).all() and (label == 0).all() and len(opened) <= 20
