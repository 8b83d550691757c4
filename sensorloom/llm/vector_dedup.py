"""Near duplicates among embeddings: vectors of one label whose cosine reaches a threshold are linked, exactly.

On unit vectors a cosine is a distance, `d * d = 2 - 2 * cos`, and distances obey the triangle inequality. So vectors are
held in cover trees: a node stands for all vectors within its covering radius, levels nest (a node is a child of itself)
and their radii halve. Two trees are traversed together: a pair of nodes whose centres lie further apart than both radii
and the threshold together holds no link and is dropped with all below it; a pair that lies within the threshold as a
whole is all links, and is counted without being opened.

1. Equal vectors are folded to one, with the number of its copies.
2. The top level: large labels have pivots, a bounded sample; each vector goes to its nearest one's cell. Other labels are
   one cell. Cells are cut to blocks of some `BLOCK` vectors, a tree each, with its centre and radius.
3. Pairs of blocks of one label whose centres are close enough meet in a task and are traversed. It returns a row per
   vector that has a link there: how many, and a member of its component, never the pairs.
4. Components of all links.

Where vectors of one label have no structure, no bound can prune, and the work is the square of a label's blocks.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from sensorloom.llm.components import components
from sensorloom.llm.frames import stored

COSINE = 0.98
# Vectors in a block.
BLOCK = 4_096
# Pivots of a label, and labels that have any: the largest, of two blocks or more each.
PIVOTS, PIVOT_LABELS = 64, 1_024
# Bounds are compared with this much to spare, as distances are rounded; links are decided by the cosine itself.
SLACK = 1e-6
# Levels end here: what is left of a node then is compared directly.
DEEPEST = 2.0**-20
# Numbers in a matrix of distances.
_MATRIX = 1 << 21

_NODE = np.dtype([("radius", "<f8"), ("center", "<i4"), ("first", "<i4"), ("last", "<i4"), ("begin", "<i4"), ("end", "<i4")])


def unit(points: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision, however large or small their numbers are."""
    points = points.astype(np.float64)
    points = points / np.abs(points).max(1, keepdims=True)
    return points / np.sqrt((points * points).sum(1, keepdims=True))


def _distances(cosines: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * cosines, 0))


def cover_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the tree over unit vectors, and an order of the vectors in which each node has a range of its own: its
    vectors are `begin` to `end`, its children the nodes `first` to `last` (none for a leaf), its centre a place."""
    order = np.arange(len(points))
    nodes, waiting = [], []

    def add(begin: int, members: np.ndarray, scale: float) -> None:
        far = _distances(points[members] @ points[members[0]])
        order[begin : begin + len(members)] = members
        waiting.append((members, far, scale))
        nodes.append([far.max() if len(members) > 1 else 0.0, members[0], 0, 0, begin, begin + len(members)])

    add(0, order.copy(), 2.0)
    for i, (members, far, scale) in enumerate(waiting):  # grows as it is read: level by level
        waiting[i] = None
        radius, begin = nodes[i][0], nodes[i][4]
        while scale >= radius and scale > DEEPEST:
            scale /= 2
        if len(members) == 1 or scale <= DEEPEST:
            continue
        nodes[i][2] = len(nodes)
        for group in _net(points, members, far, scale):
            add(begin, group, scale)
            begin += len(group)
        nodes[i][3] = len(nodes)
    table = np.array([tuple(n) for n in nodes], _NODE)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    table["center"] = place[table["center"]]
    return table, order


def _net(points: np.ndarray, members: np.ndarray, far: np.ndarray, scale: float) -> Iterator[np.ndarray]:
    """Groups of members within `scale` of their centre, which comes first; centres are further than that from each
    other. The node's own centre is the first."""
    near = far <= scale
    near[0] = True
    yield members[near]
    rest = members[~near]
    while len(rest):
        tried = rest[:64]
        close = _distances(points[tried] @ points[rest].T) <= scale
        free = np.ones(len(rest), bool)
        for i in range(len(tried)):
            if free[i]:
                close[i, i] = True
                own = close[i] & free
                free &= ~own
                own[i] = False
                yield np.append(tried[i], rest[own])
        rest = rest[free]


class Block:
    """A tree with its vectors in the tree's order."""

    def __init__(self, points: np.ndarray, weight: np.ndarray, nodes: np.ndarray) -> None:
        self.points, self.weight, self.nodes = unit(points), weight, nodes
        total = np.append(0, np.cumsum(weight))
        self.size = total[nodes["end"]] - total[nodes["begin"]]
        self.single = nodes["end"] - nodes["begin"] == 1

    def opened(self, node: int) -> np.ndarray:
        first, last = self.nodes["first"][node], self.nodes["last"][node]
        return np.arange(first, last) if last else np.array([node])


def traverse(a: Block, b: Block, cosine: float = COSINE) -> tuple[np.ndarray, np.ndarray]:
    """All links between two blocks, as pairs of nodes: every vector of the one is linked to every vector of the other."""
    near = np.sqrt(2 - 2 * cosine)
    found, work = [], [(0, 0)]
    while work:
        p, q = work.pop()
        ps, qs = a.opened(p), b.opened(q)
        if not a.nodes["last"][p] and not b.nodes["last"][q]:  # two leaves: vector by vector
            found.append(_leaves(a, b, p, q, cosine))
            continue
        step = max(1, _MATRIX // len(qs))
        y, radius = b.points[b.nodes["center"][qs]].T, b.nodes["radius"][qs]
        for part in (ps[i : i + step] for i in range(0, len(ps), step)):
            cosines = a.points[a.nodes["center"][part]] @ y
            apart, radii = _distances(cosines), a.nodes["radius"][part][:, None] + radius
            single = a.single[part][:, None] & b.single[qs]
            whole = np.where(single, cosines >= cosine, apart + radii <= near - SLACK)
            left = ~single & ~whole & (apart <= radii + near + SLACK)
            i, j = np.nonzero(whole)
            found.append(np.stack([_span(a, part[i]), _span(b, qs[j])], 1))
            i, j = np.nonzero(left)
            work.extend(zip(part[i].tolist(), qs[j].tolist()))
    links = np.concatenate(found) if found else np.zeros((0, 2, 2), np.int64)
    return links[:, 0], links[:, 1]


def _span(block: Block, nodes: np.ndarray) -> np.ndarray:
    return np.stack([block.nodes["begin"][nodes], block.nodes["end"][nodes]], 1).astype(np.int64)


def _leaves(a: Block, b: Block, p: int, q: int, cosine: float) -> np.ndarray:
    (x, y) = (block.nodes[["begin", "end"]][node] for block, node in ((a, p), (b, q)))
    i, j = np.nonzero(a.points[x["begin"] : x["end"]] @ b.points[y["begin"] : y["end"]].T >= cosine)
    i, j = i + x["begin"], j + y["begin"]
    return np.stack([np.stack([i, i + 1], 1), np.stack([j, j + 1], 1)], 1).astype(np.int64)


def _summed(spans: np.ndarray, other: np.ndarray, weight: np.ndarray, count: int) -> np.ndarray:
    """What each vector is linked to: the weights of the other side's spans over those it lies in."""
    total = np.append(0, np.cumsum(weight))
    more, change = total[other[:, 1]] - total[other[:, 0]], np.zeros(count + 1, np.int64)
    np.add.at(change, spans[:, 0], more)
    np.add.at(change, spans[:, 1], -more)
    return np.cumsum(change)[:-1]


def _labels(x: np.ndarray, y: np.ndarray, count: int) -> np.ndarray:
    """Components of vectors linked span to span: the smallest place in each."""
    ends = []
    for one, other in ((x, y), (y, x)):
        size = one[:, 1] - one[:, 0]
        inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        ends.append((np.repeat(one[:, 0], size) + inside, np.repeat(other[:, 0], size)))
    i, j = (np.concatenate(part) for part in zip(*ends))
    label = np.arange(count)
    while True:
        before = label.copy()
        least = np.minimum(label[i], label[j])
        for at in (i, j, before[i], before[j]):
            np.minimum.at(label, at, least)
        label = label[label]
        if (label == before).all():
            return label


def linked_vectors(a: Block, b: Block, same: bool, cosine: float = COSINE) -> tuple[np.ndarray, np.ndarray]:
    """For the vectors of both blocks in a row (of one, if they are the same): their links between the blocks, and the place
    of a vector of their component."""
    x, y = traverse(a, b, cosine)
    if same:
        links = _summed(x, y, b.weight, len(a.points))
        return links - np.where(links > 0, a.weight, 0), _labels(x, y, len(a.points))
    links = [_summed(x, y, b.weight, len(a.points)), _summed(y, x, a.weight, len(b.points))]
    return np.concatenate(links), _labels(x, y + len(a.points), len(a.points) + len(b.points))


# ---------------------------------------------------------------------------------------------------------------------
# Tables


def _usable(vector: Column) -> Column:
    """Not null, not empty, all components finite numbers, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    cosine: float = COSINE,
    block: int = BLOCK,
) -> DataFrame:
    """Per row: `vec_id`, `n_links` (other vectors linked directly), `component_id` (the smallest identifier reachable by links)
    and `kept` (whether it is the row's own). Linked are vectors of one label, and of one length, with that cosine or more.

    Vectors that are null, empty, zero or hold null or non-finite numbers, and those with a null label, are linked with
    nothing; so are rows with a null identifier, which are kept, their component null. Equal vectors are copies of each
    other and count as links. Rows of one identifier are in one component, and their vectors' links are counted together.
    Other columns are ignored; an empty table gives an empty result.
    """
    single = isinstance(vectors.schema[vector_col].dataType, ArrayType) and isinstance(
        vectors.schema[vector_col].dataType.elementType, FloatType
    )
    form = "float" if single else "double"
    vector = F.transform(F.col(vector_col).cast(f"array<{form}>"), lambda x: x + F.lit(0.0).cast(form))  # no negative zero
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), vector.alias("vector"))
    usable = F.col("id").isNotNull() & F.col("label").isNotNull() & _usable(F.col("vector"))
    # Two hashes of 64 bits stand for a vector's numbers.
    keys = [F.when(usable, F.xxhash64("vector")).alias("one"), F.when(usable, F.xxhash64(F.lit(1), "vector")).alias("two")]
    rows = rows.select("id", "label", "vector", F.size("vector").alias("width"), *keys)
    key = ["label", "width", "one", "two"]
    folded = rows.where("one is not null").groupBy(*key)
    distinct = stored(folded.agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.first("vector").alias("vector")))
    found = stored(_links(distinct, cosine, block, "<f4" if single else "<f8"))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    parts = components(found.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")).union(_bridges(rows, distinct)))
    own = rows.select("id", *key).join(distinct.select(*key, F.col("id").alias("node"), "copies"), key, "left")
    joined = own.join(links.withColumnRenamed("id", "node"), "node", "left").join(parts.withColumnRenamed("id", "node"), "node", "left")
    component = F.coalesce("component", "node", "id")
    return joined.select(
        F.col("id").alias("vec_id"),
        (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def _bridges(rows: DataFrame, distinct: DataFrame) -> DataFrame:
    """Identifiers with several vectors join what those are linked to."""
    several = rows.where("one is not null").groupBy("id").agg(F.count_distinct("label", "width", "one", "two").alias("n"))
    several = several.where("n > 1").select("id")
    key = ["label", "width", "one", "two"]
    named = rows.where("one is not null").select("id", *key).join(several, "id", "left_semi")
    nodes = distinct.select(*key, F.col("id").alias("node"))
    return named.join(nodes, key).where("node <> id").select(F.col("node").alias("a"), F.col("id").alias("b"))


def _links(distinct: DataFrame, cosine: float, block: int, number: str) -> DataFrame:
    """`id`, `links`, `root`: a row per vector and pair of blocks in which it has links."""
    kind = distinct.schema["id"].dataType.simpleString()
    pivots = _pivots(distinct, block)
    space = ["label", "width"]
    data = distinct.select(*space, "id", "copies", "vector")
    label = distinct.schema["label"].dataType.simpleString()
    head = f"label {label}, width int, cell bigint, "
    place = lambda batches: _celled(batches, pivots, number)
    celled = stored(data.mapInArrow(place, f"{head} id {kind}, copies bigint, vector binary"))
    sizes = celled.groupBy(*space, "cell").agg(F.ceil(F.count("*") / block).alias("blocks"))
    dealt = celled.join(sizes, [*space, "cell"])
    dealt = dealt.withColumn("cell", F.col("cell") * (1 << 40) + F.pmod(F.xxhash64("id", "vector"), "blocks")).drop("blocks")
    schema = f"{head} ids array<{kind}>, copies binary, points binary, nodes binary, center array<double>, radius double"

    def tree_of(rows: pa.Table) -> pa.Table:
        return _tree_row(rows, number)

    trees = stored(dealt.groupBy(*space, "cell").applyInArrow(tree_of, schema))
    heads = trees.select(*space, "cell", "center", "radius")
    left, right = (heads.select(*space, *(F.col(c).alias(f"{c}_{s}") for c in ("cell", "center", "radius"))) for s in "ab")
    dot = F.aggregate(F.zip_with("center_a", "center_b", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    apart = F.sqrt(F.greatest(2 - 2 * dot, F.lit(0.0)))
    near = float(np.sqrt(2 - 2 * cosine)) + SLACK
    pairs = left.join(right, space).where("cell_a <= cell_b").where(apart <= F.col("radius_a") + F.col("radius_b") + near)
    pairs = pairs.select(*space, "cell_a", "cell_b")
    for side in "ab":
        own = trees.select(*space, *(F.col(c).alias(f"{c}_{side}") for c in ("cell", "ids", "copies", "points", "nodes")))
        pairs = pairs.join(own.hint("merge"), [*space, f"cell_{side}"])
    return pairs.mapInArrow(lambda batches: _traversed(batches, cosine, number), f"id {kind}, links bigint, root {kind}")


def _pivots(distinct: DataFrame, block: int) -> dict[tuple, np.ndarray]:
    """Of each of the largest labels, at most some `PIVOTS` vectors, chosen by hash: `PIVOTS * PIVOT_LABELS` in all."""
    sizes = distinct.groupBy("label", "width").agg(F.count("*").alias("n")).where(F.col("n") >= 2 * block)
    large = sizes.orderBy(F.desc("n"), "label", "width").limit(PIVOT_LABELS)
    wanted = F.least(F.lit(PIVOTS), F.floor(F.col("n") / block))
    chosen = distinct.join(F.broadcast(large), ["label", "width"]).where(F.pmod(F.xxhash64("id", "one"), "n") < wanted)
    found: dict[tuple, list] = {}
    for row in chosen.select("label", "width", "vector").limit(PIVOTS * PIVOT_LABELS).collect():
        found.setdefault((row["label"], row["width"]), []).append(row["vector"])
    return {key: unit(np.array(vectors, np.float64)) for key, vectors in found.items()}


def _celled(batches: Iterator[pa.RecordBatch], pivots: dict[tuple, np.ndarray], number: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        labels, widths = batch.column("label").to_pylist(), batch.column("width").to_numpy()
        vectors = batch.column("vector")
        flat, ends = vectors.flatten().to_numpy(zero_copy_only=False).astype(number), np.append(0, np.cumsum(widths))
        cells = np.zeros(len(labels), np.int64)
        spaces: dict[tuple, list[int]] = {}
        for i, key in enumerate(zip(labels, widths.tolist())):
            if key in pivots:
                spaces.setdefault(key, []).append(i)
        for key, rows in spaces.items():
            own = unit(flat[ends[rows][:, None] + np.arange(key[1])])
            cells[rows] = (own @ pivots[key].T).argmax(1)
        data = [flat[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
        columns = [batch.column("label"), batch.column("width"), pa.array(cells), batch.column("id"), batch.column("copies")]
        names = ["label", "width", "cell", "id", "copies", "vector"]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(data, pa.binary())], names)


def _tree_row(rows: pa.Table, number: str) -> pa.Table:
    # Whatever order rows arrive in, the tree is the same.
    rows = rows.sort_by([("id", "ascending"), ("vector", "ascending")])
    width = rows.column("width")[0].as_py()
    points = np.frombuffer(b"".join(rows.column("vector").to_pylist()), number).reshape(-1, width)
    nodes, order = cover_tree(unit(points))
    copies = rows.column("copies").to_numpy()[order].astype("<i8")
    center = unit(points[order[nodes["center"][:1]]])[0]
    ids = rows.column("id").take(pa.array(order)).combine_chunks()
    values = [copies.tobytes(), points[order].tobytes(), nodes.tobytes()]
    out = {c: rows.column(c)[:1] for c in ("label", "width", "cell")}
    out["ids"] = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
    out |= {c: pa.array([v], pa.binary()) for c, v in zip(("copies", "points", "nodes"), values)}
    out["center"] = pa.array([center], pa.list_(pa.float64()))
    out["radius"] = pa.array([float(nodes["radius"][0])])
    return pa.table(out)


def _traversed(batches: Iterator[pa.RecordBatch], cosine: float, number: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kind = batch.schema.field("ids_a").type.value_type
        for i in range(batch.num_rows):
            a, b = (_block(batch, i, side, number) for side in "ab")
            same = batch.column("cell_a")[i].as_py() == batch.column("cell_b")[i].as_py()
            links, root = linked_vectors(a, b, same, cosine)
            parts = [batch.column(f"ids_{s}")[i].values for s in ("a" if same else "ab")]
            ids = pa.concat_arrays(parts).cast(kind)
            at = np.flatnonzero(links)
            if len(at):
                arrays = [ids.take(pa.array(at)), pa.array(links[at]), ids.take(pa.array(root[at]))]
                yield pa.RecordBatch.from_arrays(arrays, ["id", "links", "root"])


def _block(batch: pa.RecordBatch, i: int, side: str, number: str) -> Block:
    data = {c: batch.column(f"{c}_{side}")[i].as_buffer() for c in ("copies", "points", "nodes")}
    points = np.frombuffer(data["points"], number).reshape(-1, batch.column("width")[i].as_py())
    return Block(points, np.frombuffer(data["copies"], "<i8"), np.frombuffer(data["nodes"], _NODE))
