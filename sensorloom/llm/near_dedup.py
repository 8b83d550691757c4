"""Near duplicates by MinHash: documents whose sets of five-word shingles are alike to a given percentage are linked.

1. *Sketch.* One permutation: a set's hashes are dealt into `BINS` bins by their top bits, and the smallest of each bin is
   kept. An empty bin borrows from another by a random order of its own (optimal densification), the same for all
   documents, so bins agree with the probability of the sets' similarity, however small the sets.
2. *Copies.* Documents with the same set are one node from here on.
3. *Bands.* Groups of bins are hashed to buckets, by default 25 of 5: two sets of similarity 0.85 share no bucket with a
   probability of 5e-7. For 0.8, 28 groups of 4 come to 4e-7.
4. *Stars.* Each bucket has a centre, the member that is in the most company over all its buckets; candidate edges lead
   from the centre to the other members only, so a bucket of `n` gives `n - 1`. Links are confirmed on the full sets.
5. *The rest of a star.* Two members may be linked to each other though they are not to the centre. A member that is in
   the centre's component already needs no second link there; those left outside are compared with all members of other
   components, on the full sets, in blocks of bounded size. Only links are returned.
6. *Components* of all links.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.components import components
from sensorloom.llm.frames import quoted, stored, text_of

SHINGLE = 5
PERCENT = 85
BANDS, ROWS = 25, 5
BIN_BITS = 7
BINS = 1 << BIN_BITS
# Shingles on one side of a block of comparisons.
BLOCK = 400_000
# Numbers in a matrix of such a comparison.
_MATRIX = 1 << 23

_rng = np.random.default_rng(12)
_PROBES = np.array([_rng.permutation(BINS) for _ in range(BINS)])
_FACTORS = _rng.integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_EDGES = np.arange(BINS, dtype=np.uint64) << np.uint64(64 - BIN_BITS)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Each 64-bit number scrambled, one to one."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def shingles(text: str) -> np.ndarray:
    """The set of a text's shingles as sorted 64-bit hashes. Only A-Z are lowered; words are between ASCII white space."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(SHINGLE, len(words))
    count = len(words) - width + 1
    sums = np.full(count, width, np.uint64)
    for i in range(width):
        sums += hashes[i : i + count] * _FACTORS[i]
    return np.unique(_mixed(sums))


def sketch(found: np.ndarray) -> np.ndarray:
    """The smallest hash of each bin, of a set that is not empty."""
    first = np.searchsorted(found, _EDGES)
    filled = first < np.append(first[1:], len(found))
    values = found[np.minimum(first, len(found) - 1)]
    if filled.all():
        return values
    source = _PROBES[np.arange(BINS), filled[_PROBES].argmax(1)]
    return np.where(filled, values, values[source])


def bands(values: np.ndarray, count: int = BANDS, width: int = ROWS) -> np.ndarray:
    """One hash per band; the band's number is part of it."""
    rows = values[: count * width].reshape(count, width) * _FACTORS[:width]
    return _mixed(rows.sum(1, dtype=np.uint64) + np.arange(count, dtype=np.uint64) * _FACTORS[width]).view(np.int64)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = PERCENT,
    n_bands: int = BANDS,
    n_rows: int = ROWS,
) -> DataFrame:
    """Per row: `doc_id`, `n_shingles`, `component_id` (the smallest identifier reachable by links) and `kept` (whether it
    is the row's own). Sets alike to `percent` are linked; `n_bands` groups of `n_rows` bins, `BINS` at most, find them.

    A null or blank text has no shingles and is linked with nothing. A row with a null identifier is linked with nothing
    and kept, its component null. Rows with one identifier are one document: its texts' links count together. Other
    columns are ignored; an empty table gives an empty result.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    if n_bands * n_rows > BINS:
        raise ValueError(f"{n_bands} bands of {n_rows} need more than {BINS} bins")
    sketched = lambda batches: _sketched(batches, n_bands, n_rows)
    rows = stored(texts.mapInArrow(sketched, f"doc_id {_kind(texts)}, n_shingles bigint, digest binary, bands array<bigint>"))
    named = rows.where("doc_id is not null and n_shingles > 0")
    # Equal sets have equal bands: any row's will do.
    sets = stored(named.groupBy("digest").agg(F.min("doc_id").alias("id"), F.first("bands").alias("bands")))
    same = named.join(sets.select("digest", "id"), "digest").where("doc_id <> id").select(F.col("doc_id").alias("b"), "id")
    stars = stored(_stars(sets.select("id", F.explode("bands").alias("bucket"))))
    found = _links(texts, stars, percent)
    # Copies of a set need no part in the rounds that find components; documents with several sets do.
    several = named.groupBy("doc_id").agg(F.count_distinct("digest").alias("n")).where("n > 1").select("doc_id")
    bridges = same.join(several, same["b"] == several["doc_id"], "left_semi").select(F.col("id").alias("a"), "b")
    parts = components(found.select("a", "b").union(bridges))
    parts = parts.select(F.col("id").alias("_id"), "component")
    named_ids = rows.select("doc_id", "n_shingles", "digest").join(sets.select("digest", "id"), "digest", "left")
    own = F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("id")).otherwise(F.col("doc_id"))
    joined = named_ids.withColumn("_id", own).drop("id", "digest").join(parts, "_id", "left")
    component = F.coalesce("component", "_id")
    kept = F.coalesce(F.col("doc_id") == component, F.lit(True))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def drop_near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = PERCENT,
    n_bands: int = BANDS,
    n_rows: int = ROWS,
) -> DataFrame:
    """One row of each group, with all its columns: the one with the smallest identifier. Rows with a null identifier
    stay; repeated rows of the identifier that stays do, too."""
    found = near_duplicates(docs, id_col, text_col, percent, n_bands, n_rows)
    gone = found.where("not kept").select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(gone.hint("merge"), id_col, "left_anti").select(*map(quoted, docs.columns))


def _kind(df: DataFrame) -> str:
    return df.schema["doc_id"].dataType.simpleString()


def _sketched(batches: Iterator[pa.RecordBatch], n_bands: int, n_rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, digests, all_bands = [], [], []
        for text in batch.column("text"):
            found = shingles(text.as_py())
            sizes.append(len(found))
            digests.append(xxhash.xxh3_128_digest(found.tobytes()))
            all_bands.append(bands(sketch(found), n_bands, n_rows) if len(found) else [])
        arrays = [pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(all_bands, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", "n_shingles", "digest", "bands"])


def _stars(members: DataFrame) -> DataFrame:
    """Candidate edges `center`, `id` of all buckets (`id`, `bucket`)."""
    shared = members.groupBy("bucket").agg(F.count("*").alias("n"), F.min("id").alias("a"), F.max("id").alias("b"))
    shared = stored(members.join(shared.where("a < b").select("bucket", "n"), "bucket"))
    company = shared.groupBy("id").agg(F.sum("n").alias("company"))
    # Of members in equal company, the one with the smallest identifier, of whatever type.
    ranked = shared.join(company, "id").groupBy("bucket").agg(F.min(F.struct(-F.col("company"), "id")).alias("first"))
    centers = ranked.select("bucket", F.col("first.id").alias("center"))
    return shared.join(centers, "bucket").where("id <> center").select("center", "id").distinct()


def _links(texts: DataFrame, stars: DataFrame, percent: int) -> DataFrame:
    """Confirmed links `a`, `b`, enough of them for their components to be those of all links."""
    wanted = stars.select("id").union(stars.select("center")).distinct()
    kind = _kind(texts)
    # What grows with the table is joined by a shuffle at every size, so a small run has the plan, and the costs a row, of a
    # large one.
    needed = texts.join(wanted.withColumnRenamed("id", "doc_id").hint("merge"), "doc_id", "left_semi")
    sets = stored(needed.mapInArrow(_set_rows, f"id {kind}, size bigint, found binary"))
    of_id = sets.select("id", F.col("found").alias("of_id"))
    of_center = sets.select(F.col("id").alias("center"), F.col("found").alias("of_center"))
    pairs = stars.join(of_id.hint("merge"), "id").join(of_center.hint("merge"), "center").select("center", "id", "of_center", "of_id")
    linked = stored(pairs.mapInArrow(lambda batches: _tested(batches, percent), f"a {kind}, b {kind}"))
    rest = _rest(stars, sets, components(linked), kind, percent)
    return linked.union(rest)


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [shingles(text.as_py()) for text in batch.column("text")]
        arrays = [pa.array([len(f) for f in found], pa.int64()), pa.array([f.tobytes() for f in found], pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["id", "size", "found"])


def _tested(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for a, b in zip(batch.column("of_center"), batch.column("of_id")):
            x, y = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
            # Sets whose sizes are too far apart need no look.
            close = 100 * min(len(x), len(y)) >= percent * max(len(x), len(y))
            keep.append(close and _alike(_common(x, y), len(x), len(y), percent))
        left = batch.filter(pa.array(keep, pa.bool_()))
        yield pa.RecordBatch.from_arrays([left.column("center"), left.column("id")], ["a", "b"])


def _common(x: np.ndarray, y: np.ndarray) -> int:
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    return int((large[at] == small).sum())


def _alike(common, size, other, percent):
    return 100 * common >= percent * (size + other - common)


def _rest(stars: DataFrame, sets: DataFrame, parts: DataFrame, kind: str, percent: int) -> DataFrame:
    """Links between members of one star that the links to centres leave in different components."""
    part_of = parts.select("id", "component")
    members = stars.join(part_of, "id", "left").withColumn("part", F.coalesce("component", "id")).drop("component")
    center_part = part_of.select(F.col("id").alias("center"), F.col("component").alias("center_part"))
    members = members.join(center_part, "center", "left")
    outside = F.col("part") != F.coalesce("center_part", "center")
    members = members.select("center", "id", "part", outside.alias("outside")).join(sets.select("id", "size"), "id")
    members = stored(members)
    sizes = members.groupBy("center").agg(
        F.ceil(F.sum(F.when(F.col("outside"), F.col("size"))) / BLOCK).alias("blocks_out"),
        F.ceil(F.sum("size") / BLOCK).alias("blocks"),
        F.min("part").alias("low"),
        F.max("part").alias("high"),
    )
    # Nothing is left to compare where all members, centre apart, are one component, or none is outside.
    members = members.join(sizes.where("blocks_out is not null and low < high"), "center")
    spread = F.xxhash64("id", "center")
    row, column = F.pmod(spread, "blocks_out"), F.pmod(spread, "blocks")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    place = ("center", "id", "part")
    left = members.where("outside").select(*place, F.lit(True).alias("left"), row.alias("i"), every("blocks").alias("j"))
    right = members.select(*place, F.lit(False).alias("left"), every("blocks_out").alias("i"), column.alias("j"))
    blocks = left.union(right).join(sets.select("id", "found").hint("merge"), "id")
    return blocks.groupBy("center", "i", "j").applyInPandas(lambda rows: _block_links(rows, percent), f"a {kind}, b {kind}")


def _block_links(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Of all pairs across components, links that connect components not connected yet in this block."""
    found = [np.frombuffer(f, np.uint64) for f in rows["found"]]
    sizes = np.array([len(f) for f in found])
    values, place, times = np.unique(np.concatenate(found), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(found)), sizes)
    # A value that one set alone holds is common to no pair.
    column = np.where(times > 1, np.cumsum(times > 1) - 1, -1)[place]
    owner, column = owner[column >= 0], column[column >= 0]
    width = int((times > 1).sum())
    starts = np.searchsorted(owner, np.arange(len(found) + 1))

    def matrix(chosen: np.ndarray) -> np.ndarray:
        out = np.zeros((len(chosen), width), np.float32)
        for i, r in enumerate(chosen):
            out[i, column[starts[r] : starts[r + 1]]] = 1
        return out

    ids, side = rows["id"].to_numpy(), rows["left"].to_numpy()
    part, joined, links = rows["part"].to_numpy(), {}, []

    def root(label):
        while label in joined:
            label = joined[label]
        return label

    step = max(1, _MATRIX // max(width, 1))
    lefts, rights = np.flatnonzero(side), np.flatnonzero(~side)
    for x in (lefts[i : i + step] for i in range(0, len(lefts), step)):
        of_x = matrix(x)
        for y in (rights[i : i + step] for i in range(0, len(rights), step)):
            common = of_x @ matrix(y).T
            linked = _alike(common, sizes[x][:, None], sizes[y][None, :], percent) & (part[x][:, None] != part[y][None, :])
            for i, j in zip(*np.nonzero(linked)):
                a, b = root(part[x[i]]), root(part[y[j]])
                if a != b:
                    joined[a] = b
                    links.append((ids[x[i]], ids[y[j]]))
    return pd.DataFrame(links, columns=["a", "b"]) if links else pd.DataFrame({"a": ids[:0], "b": ids[:0]})
