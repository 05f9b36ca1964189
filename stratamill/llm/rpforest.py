"""Near-duplicate vectors by a forest of random-projection trees.

1. *Classes*: equal vectors of one label are one class, represented by its smallest id.
   Copies are counted, never paired.
2. *Trees*: each is a recursion of splits by a random direction at about the median. A
   vector within ``SPILL`` of a split goes to both sides. The directions of a tree's
   levels and the medians of its nodes are fitted to a bounded sample
   (``SAMPLE_VECTORS``); a node without a sample of its own splits at its level's median.
   The depth follows the number of vectors, so that leaves keep their size.
3. *Leaves* hold vectors of one label. Those above ``BLOCK`` vectors are dealt into
   blocks, and every two blocks of a leaf are compared as a group of their own: memory is
   that of two blocks, and a leaf of near copies that no split can part loses no pair.
4. *Verification* by cosine in double precision. Links are counted where two vectors meet
   first, and what leaves a group is a row per vector: its count, and one vector that
   it hangs together with. Counts are added, components found over these rows.

Two unit vectors of cosine 0.98 lie at most 0.2 apart; a split parts them only if their
projections differ by more than 2 x ``SPILL``, over three deviations in 64 dimensions.
With several trees a pair is missed with a chance far below 1e-6.

Defined cases: a null label, or a vector that is null, empty, zero or holds null or
non-finite components, links with nothing and is kept as its own component. Vectors of
different lengths never link. Rows without an id link with nothing, have no component
and are kept. Repeated rows count as vectors of their own; rows that share an id but not
the vector share their links. Empty tables give an empty
result. Extra columns are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamill.llm.components import components
from stratamill.sinks.written import written_once

TREES = 3
SPILL = 0.04
LEAF = 2048
BLOCK = 2048
SAMPLE_VECTORS = 20_000
# Rows placed, and vectors compared with a block, at a time.
PLACED_ROWS, SLICE = 2048, 256
SAMPLE_NODE = 64
# A spilling split leaves about this share of a node's vectors on either side.
_SHARE = 0.62
SEED = 3


class Tree:
    """Directions by level, and split points by node; a node is a number as of a binary heap."""

    def __init__(self, dimension: int, depth: int, sample: np.ndarray, seed: int):
        rng = np.random.default_rng(seed)
        directions = rng.standard_normal((max(depth, 1), dimension))
        self.directions = directions / np.linalg.norm(directions, axis=1, keepdims=True)
        self.depth = depth
        self.level_points = np.median(sample @ self.directions.T, axis=0) if len(sample) else np.zeros(max(depth, 1))
        self.points: dict[int, float] = {}
        nodes = {1: np.arange(len(sample))}
        for level in range(depth):
            projected = sample @ self.directions[level]
            below: dict[int, np.ndarray] = {}
            for node, rows in nodes.items():
                if len(rows) < SAMPLE_NODE:
                    continue
                point = float(np.median(projected[rows]))
                self.points[node] = point
                below[2 * node] = rows[projected[rows] < point]
                below[2 * node + 1] = rows[projected[rows] >= point]
            nodes = below

    def leaves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and leaves of unit vectors; a row is in several where it spills."""
        rows, nodes = np.arange(len(vectors)), np.ones(len(vectors), np.int64)
        for level in range(self.depth):
            kinds, which = np.unique(nodes, return_inverse=True)
            points = np.array([self.points.get(int(k), self.level_points[level]) for k in kinds])[which]
            away = (vectors @ self.directions[level])[rows] - points
            left, right = away <= SPILL, away >= -SPILL
            rows = np.concatenate((rows[left], rows[right]))
            nodes = np.concatenate((2 * nodes[left], 2 * nodes[right] + 1))
        return rows, nodes


def _vectors(values: list) -> np.ndarray:
    """As a matrix; rows whose squares would leave the range of doubles are scaled, which no cosine notices."""
    vectors = np.array(values, np.float64)
    size = np.abs(vectors).max(axis=1, keepdims=True)
    extreme = (size > 1e100) | (size < 1e-100)
    return np.where(extreme, vectors / size, vectors) if extreme.any() else vectors


def _units(values: list) -> np.ndarray:
    vectors = _vectors(values)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def fit_trees(classes: DataFrame, trees: int) -> dict[int, list[Tree]]:
    """By vector length, trees whose depth brings the largest label's leaves to about ``LEAF``."""
    sizes = classes.groupBy("dim", "label").agg(F.count("*").alias("n")).groupBy("dim").agg(F.max("n").alias("n"))
    fitted = {}
    for row in sizes.collect():
        depth = max(0, math.ceil(math.log(row["n"] / LEAF) / -math.log(_SHARE))) if row["n"] > LEAF else 0
        sample = np.zeros((0, row["dim"]))
        if depth:
            of_length = classes.where(F.col("dim") == row["dim"])
            picked = of_length.orderBy(F.xxhash64(F.lit(SEED), "node"), "node").limit(SAMPLE_VECTORS)
            sample = _units([r["vector"] for r in picked.select("vector").collect()])
        fitted[row["dim"]] = [Tree(row["dim"], depth, sample, SEED + t) for t in range(trees if depth else 1)]
    return fitted


def placed_vectors(classes: DataFrame, forest: dict[int, list[Tree]], id_type: str) -> DataFrame:
    """A row per class and leaf it is in: place (its tree and leaf), dim, label, node, copies, vector, places.

    ``places`` are all of the class, ascending: where two classes meet first can be told
    anywhere they meet.
    """

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.take(pa.array(np.flatnonzero(dims == dim)))
                units = _units(part.column("vector").to_pylist())
                found = [tree.leaves(units) for tree in forest[int(dim)]]
                rows = np.concatenate([rows for rows, _ in found])
                places = np.concatenate([(np.int64(t) << 48) + leaves for t, (_, leaves) in enumerate(found)])
                order = np.lexsort((places, rows))
                rows, places = rows[order], places[order]
                ends = np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=len(units)))))
                of_class = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(places))
                # In slices: each row takes its vector and its places with it.
                for a in range(0, len(rows), PLACED_ROWS):
                    at = pa.array(rows[a : a + PLACED_ROWS])
                    out = part.take(at)
                    columns = [pa.array(places[a : a + PLACED_ROWS])]
                    columns += [out.column(c) for c in ("dim", "label", "node", "copies", "vector")]
                    columns.append(of_class.take(at))
                    names = ["place", "dim", "label", "node", "copies", "vector", "places"]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    label = dict(classes.dtypes)["label"]
    schema = f"place long, dim int, label {label}, node {id_type}, copies long, vector array<double>, places array<long>"
    return classes.select("dim", "label", "node", "copies", "vector").mapInArrow(place, schema)


def _block_pairs(placed: DataFrame) -> DataFrame:
    """Each vector once for every pair of blocks of its leaf that it is in; ``block`` tells its own.

    A leaf of s vectors has b = ceil(s / BLOCK) blocks by a hash of the id; its block
    pairs are x <= y < b, so a vector is repeated b times.
    """
    leaf = ["place", "dim", "label"]
    sizes = placed.groupBy(*leaf).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("node", "place"), F.col("blocks")).cast("int")
    dealt = placed.join(sizes, leaf).withColumn("block", block)
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    both = dealt.select(*leaf, "node", "copies", "vector", "places", "block", others)
    return both.select(
        *leaf,
        "node",
        "copies",
        "vector",
        "places",
        F.least("block", "other").alias("x"),
        F.greatest("block", "other").alias("y"),
        "block",
    )


def _padded(places: list, fill: int) -> np.ndarray:
    out = np.full((len(places), max(map(len, places))), fill, np.int64)
    for row, found in zip(out, places, strict=True):
        row[: len(found)] = found
    return out


def _near_pairs(a: np.ndarray, b: np.ndarray, least_cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of pairs of that cosine, in slices of bounded size."""
    norm_a, norm_b = np.sqrt((a * a).sum(axis=1)), np.sqrt((b * b).sum(axis=1))
    units = (b / norm_b[:, None]).T
    for start in range(0, len(a), SLICE):
        near = (a[start : start + SLICE] / norm_a[start : start + SLICE, None]) @ units
        i, j = np.nonzero(near >= least_cosine - 1e-9)
        step = max(1, (1 << 22) // max(1, a.shape[1]))
        for k in range(0, len(i), step):
            p, q = i[k : k + step] + start, j[k : k + step]
            cosine = (a[p] * b[q]).sum(axis=1) / (norm_a[p] * norm_b[q])
            good = cosine >= least_cosine
            yield p[good], q[good]


def _meet_first(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray, place: int) -> np.ndarray:
    """Which pairs have no common place before ``place``, which both have; places are ascending."""
    out = np.empty(len(i), bool)
    step = max(1, (1 << 22) // (left.shape[1] * right.shape[1]))
    for k in range(0, len(i), step):
        own, others = left[i[k : k + step]], right[j[k : k + step]]
        common = (own[:, :, None] == others[:, None, :]).any(axis=2)
        out[k : k + step] = own[np.arange(len(own)), common.argmax(axis=1)] == place
    return out


def _roots(count: int, links: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest row number that each row is linked with, over any number of links."""
    root = np.arange(count)
    while True:
        before = root.copy()
        for i, j in links:
            least = np.minimum(root[i], root[j])
            np.minimum.at(root, i, least)
            np.minimum.at(root, j, least)
            np.minimum.at(root, before[i], least)
            np.minimum.at(root, before[j], least)
        root = root[root]
        if (root == before).all():
            return root


def vector_links(classes: DataFrame, least_cosine: float, trees: int = TREES) -> DataFrame:
    """``node``, ``others``, ``root``: rows that add up to the classes' links.

    A class's ``others`` sum to the copies of the classes of its label whose vectors have
    at least that cosine with its own; it hangs together with its ``root``. A pair is counted
    where its classes meet first, and no pair is written: a group of near copies gives a
    row or two per member and block pair.
    """
    id_type = dict(classes.dtypes)["node"]
    placed = written_once(placed_vectors(classes, fit_trees(classes, trees), id_type))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        place, same = int(group["place"].iloc[0]), group["x"].iloc[0] == group["y"].iloc[0]
        is_left = (group["block"] == group["x"]).to_numpy()
        left = np.flatnonzero(is_left)
        right = left if same else np.flatnonzero(~is_left)
        others, links = np.zeros(len(group), np.int64), []
        if len(left) and len(right):
            vectors = _vectors(group["vector"].tolist())
            places, copies = group["places"].tolist(), group["copies"].to_numpy()
            ours, theirs = _padded([places[k] for k in left], -1), _padded([places[k] for k in right], -2)
            for i, j in _near_pairs(vectors[left], vectors[right], least_cosine):
                # Within one block every pair is seen twice, once from either side.
                if same:
                    i, j = i[i != j], j[i != j]
                first = _meet_first(ours, theirs, i, j, place)
                i, j = left[i[first]], right[j[first]]
                np.add.at(others, i, copies[j])
                if not same:
                    np.add.at(others, j, copies[i])
                links.append(_star(len(group), i, j))
        linked = np.flatnonzero(others)
        nodes = group["node"].to_numpy()
        # Rows in the order of ids, so that the smallest row of a component is its smallest id.
        order = np.argsort(nodes, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        roots = order[_roots(len(group), [(rank[i], rank[j]) for i, j in links])[rank]]
        return pd.DataFrame({"node": nodes[linked], "others": others[linked], "root": nodes[roots[linked]]})

    keys = ["place", "dim", "label", "x", "y"]
    return _block_pairs(placed).groupBy(*keys).applyInPandas(compare, f"node {id_type}, others long, root {id_type}")


def _star(count: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewer links that connect the same rows."""
    root = _roots(count, [(i, j)])
    ends = np.flatnonzero(root != np.arange(count))
    return ends, root[ends]


def near_vectors(
    df: DataFrame,
    least_cosine: float = 0.98,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    trees: int = TREES,
) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``df``; ``key`` becomes ``vec_id``."""
    doubles = F.col(vector).cast("array<double>")
    rows = df.select(F.col(key).alias("vec"), F.col(label).alias("label"), doubles.alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    nonzero = F.exists("vector", lambda x: x != 0)
    usable = F.when(
        F.col("vec").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)),
        F.coalesce(nonzero, F.lit(False)),
    ).otherwise(F.lit(False))
    text = F.concat_ws(",", F.transform("vector", lambda x: (x + 0.0).cast("string")))
    # Equal vectors of one label have one mark; the others have none.
    mark = F.when(usable, F.sha2(F.concat_ws(";", F.col("label").cast("string"), text), 256))
    marked = written_once(rows.select("vec", "label", "vector", mark.alias("mark")))
    good = marked.where("mark is not null")
    classes = written_once(
        good.groupBy("mark").agg(
            F.min("vec").alias("node"),
            F.count("*").alias("copies"),
            F.min_by("vector", "vec").alias("vector"),
            F.min_by("label", "vec").alias("label"),
        ).withColumn("dim", F.size("vector"))
    )
    links = written_once(vector_links(classes, least_cosine, trees))
    roots = written_once(components(links.select(F.col("node").alias("u"), F.col("root").alias("v")).distinct()))
    linked = links.groupBy("node").agg(F.sum("others").alias("others"))
    summary = classes.select("mark", "node", "copies").join(linked, "node", "left").join(roots, "node", "left")
    judged = marked.select("vec", "mark").join(summary, "mark", "left")
    component = F.when(F.col("vec").isNotNull(), F.coalesce("root", "node", F.col("vec")))
    n_links = F.coalesce(F.col("copies") - 1, F.lit(0)) + F.coalesce("others", F.lit(0))
    return judged.select(
        F.col("vec").alias("vec_id"),
        n_links.cast("long").alias("n_links"),
        component.cast("long").alias("component_id"),
        F.coalesce(F.col("vec") == component, F.lit(True)).alias("kept"),
    )
