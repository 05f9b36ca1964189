"""Hard negatives of anchor vectors, by segment summaries that bound inner products.

1. *Summaries*: a vector is cut into ``SEGMENTS`` runs of components, of which mean and
   deviation are stored. Over a segment of length n, two vectors' products sum to
   n * (mean * mean) plus or minus at most n * (deviation * deviation), so the summaries
   bound a score from both sides. Summaries of longer segments follow from the stored
   ones: bounds start with the whole vector and are refined by halves of the list.
2. *Blocks*: anchors are a stated query set. They are dealt into blocks of about
   ``ANCHORS``, the other vectors into ``SHARDS`` shards, and each block meets each shard
   in one task, which reads its vectors as a stream, by ascending id. It keeps the best
   rows found so far for each anchor; the worst of them is the score that a later row has
   to exceed, and rows whose bounds rule that out, or the wanted range of scores, are not
   scored.
3. *Positives* first: the best rows of the anchor's label. Each sets the range of scores
   in which negatives are wanted. Then *negatives*, for all positives of an anchor at
   once. Per anchor and positive at most ``SHARDS`` times the wanted number are merged.

Memory is that of a block of anchors with their best rows, and one batch. Scores are
exact: doubles hold them while they stay below 2 ** 53, else Python integers are used.

Defined cases: rows without id or label, and vectors that are null or have a null or
non-finite component (also if only 256 times it is), take no part. Vectors of different
lengths have no score; empty ones have 0 with each other. Repeated rows count as rows of
their own, an anchor's copy too; equal scores go by id. Scores that a long cannot hold
are set to its end. A positive with a negative score has no negatives. Empty tables give
an empty result. Extra columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratamill.sinks.written import written_once

SEGMENTS = 16
ANCHORS = 2048
SHARDS = 16
SCALE = 256.0
ANCHOR_EVERY = 100
POSITIVES = 5
NEGATIVES = 10
LOW_PERCENT, HIGH_PERCENT = 30, 90
# Pairs bounded at a time; above this share of them left, whole blocks are scored instead of single pairs.
_PAIRS = 1 << 19
_DENSE = 0.1
_EXACT = 2.0**53
_END = (1 << 63) - 1
_SLACK = 1e-9


def summaries(values: np.ndarray, segments: int = SEGMENTS) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of each vector's segments, both times the root of the segment's length."""
    count, dim = values.shape
    starts = segment_starts(dim, segments)
    if not len(starts):
        return np.zeros((count, 0)), np.zeros((count, 0))
    lengths = np.diff(np.append(starts, dim))
    means = np.add.reduceat(values, starts, axis=1) / lengths
    off = values - np.repeat(means, lengths, axis=1)
    return means * np.sqrt(lengths), np.sqrt(np.add.reduceat(off * off, starts, axis=1))


def segment_starts(dim: int, segments: int) -> np.ndarray:
    return np.arange(min(segments, dim)) * dim // max(1, min(segments, dim))


def coarser(means: np.ndarray, deviations: np.ndarray, dim: int, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """The summaries of ``groups`` runs of the segments."""
    count = means.shape[1]
    if groups >= count:
        return means, deviations
    lengths = np.diff(np.append(segment_starts(dim, count), dim))
    starts = np.arange(groups) * count // groups
    total = np.add.reduceat(lengths, starts)
    level = np.add.reduceat(means * np.sqrt(lengths), starts, axis=1) / total
    off = means - np.repeat(level, np.diff(np.append(starts, count)), axis=1) * np.sqrt(lengths)
    spread = np.add.reduceat(off * off + deviations * deviations, starts, axis=1)
    return level * np.sqrt(total), np.sqrt(spread)


class Vectors:
    """Vectors of one length, with their summaries from coarse to fine."""

    def __init__(self, batch: pa.RecordBatch, dim: int):
        count = batch.num_rows
        self.ids, self.rows, self.labels = (batch.column(c).to_numpy() for c in ("id", "row", "label"))

        def matrix(name: str, width: int) -> np.ndarray:
            return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(count, width)

        self.dim, fine = dim, min(SEGMENTS, dim)
        self.values = matrix("v", dim)
        means, deviations = matrix("means", fine), matrix("deviations", fine)
        self.levels = [coarser(means, deviations, dim, g) for g in (1, 4) if g < fine] + [(means, deviations)]
        self.norms = np.sqrt((means * means + deviations * deviations).sum(axis=1))
        self.largest = float(np.abs(self.values).max(initial=0.0))

    def part(self, start: int, stop: int) -> Vectors:
        out = object.__new__(Vectors)
        out.dim, out.largest = self.dim, self.largest
        for name in ("ids", "rows", "labels", "values", "norms"):
            setattr(out, name, getattr(self, name)[start:stop])
        out.levels = [(m[start:stop], d[start:stop]) for m, d in self.levels]
        return out


def exact_scores(a: Vectors, b: Vectors, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    if a.largest * b.largest * max(1, a.dim) < _EXACT:
        return np.einsum("ij,ij->i", a.values[i], b.values[j]).astype(np.int64)
    return np.array([_long_score(a.values[x], b.values[y]) for x, y in zip(i, j, strict=True)], np.int64)


def _long_score(x: np.ndarray, y: np.ndarray) -> int:
    score = sum(int(p) * int(q) for p, q in zip(x.tolist(), y.tolist(), strict=True))
    return max(-_END, min(_END, score))


class Best:
    """The best rows of each anchor and range of scores, of a stream by ascending id."""

    def __init__(self, anchors: Vectors, lows: np.ndarray, highs: np.ndarray, most: int, same_label: bool):
        self.anchors, self.most, self.same_label = anchors, most, same_label
        self.least, self.highs = lows.copy(), highs
        self.found = [np.zeros(0, np.int64)] * 4
        self.new: list[tuple[np.ndarray, ...]] = []
        self.scored = self.met = 0

    def see(self, rows: Vectors) -> None:
        step = max(16, _PAIRS // max(1, len(self.anchors.ids)))
        start, width = 0, min(64, step)  # a short first look sets the scores to exceed
        while start < len(rows.ids):
            self._see(rows.part(start, start + width))
            start, width = start + width, step

    def _see(self, rows: Vectors) -> None:
        a = self.anchors
        equal = a.labels[:, None] == rows.labels[None, :]
        left = equal & (a.rows[:, None] != rows.rows[None, :]) if self.same_label else ~equal
        # The ranges of an anchor as one, widened so that rounding rules nothing out.
        slack = _SLACK * a.norms[:, None] * rows.norms[None, :]
        low = np.where(self.least <= self.highs, self.least, _END).min(axis=1).astype(float)
        high = np.where(self.least <= self.highs, self.highs, -_END).max(axis=1).astype(float)
        self.met += int(left.sum())
        pairs = None
        with np.errstate(over="ignore", invalid="ignore"):
            for (am, ad), (rm, rd) in zip(a.levels, rows.levels, strict=True):
                if pairs is None:
                    middle, radius = am @ rm.T, ad @ rd.T + slack
                    left &= ~((middle + radius < low[:, None]) | (middle - radius > high[:, None]))
                    if left.sum() <= _DENSE * left.size:
                        pairs = np.nonzero(left)
                else:
                    i, j = pairs
                    middle = np.einsum("ij,ij->i", am[i], rm[j])
                    radius = np.einsum("ij,ij->i", ad[i], rd[j]) + slack[i, j]
                    stays = ~((middle + radius < low[i]) | (middle - radius > high[i]))
                    pairs = i[stays], j[stays]
        if pairs is None and a.largest * rows.largest * max(1, a.dim) < _EXACT:
            scores = (a.values @ rows.values.T).astype(np.int64)
            self.scored += left.size
            for k in range(self.highs.shape[1]):
                i, j = np.nonzero(left & (scores >= self.least[:, k, None]) & (scores <= self.highs[:, k, None]))
                self._keep(i, j, scores[i, j], k, rows)
        else:
            i, j = pairs if pairs is not None else np.nonzero(left)
            scores = exact_scores(a, rows, i, j)
            self.scored += len(i)
            for k in range(self.highs.shape[1]):
                good = (scores >= self.least[i, k]) & (scores <= self.highs[i, k])
                self._keep(i[good], j[good], scores[good], k, rows)
        if sum(len(new[0]) for new in self.new) > max(len(self.found[0]), 1 << 10):
            self._compact()

    def _keep(self, i: np.ndarray, j: np.ndarray, scores: np.ndarray, k: int, rows: Vectors) -> None:
        if len(i):
            self.new.append((i * self.highs.shape[1] + k, scores, rows.ids[j], rows.rows[j]))

    def _compact(self) -> None:
        slot, score, ids, row = (np.concatenate(c) for c in zip(self.found, *self.new, strict=True))
        order = np.lexsort((row, ids, -score, slot))
        slot = slot[order]
        first = np.searchsorted(slot, slot)
        place = np.arange(len(slot)) - first
        kept = place < self.most
        order, slot, place = order[kept], slot[kept], place[kept]
        self.found, self.new = [slot, score[order], ids[order], row[order]], []
        full = place == self.most - 1
        # A later row has a larger id: it has to score more. Where nothing can, the range is closed.
        least = self.least.reshape(-1)
        top = self.found[1][full]
        least[slot[full]] = np.where(top < _END, top, _END - 1) + 1
        self.highs.reshape(-1)[slot[full][top == _END]] = -_END

    def result(self) -> list[np.ndarray]:
        """Anchor row, anchor id, range, score, id and row."""
        if self.new:
            self._compact()
        slot, score, ids, row = self.found
        at, k = np.divmod(slot, self.highs.shape[1])
        return [self.anchors.rows[at], self.anchors.ids[at], k, score, ids, row]


def usable_vectors(df: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """row, id, label, dim, v (whole numbers as doubles), means, deviations of the rows that take part."""
    doubles = F.col(vector).cast("array<double>")
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), doubles.alias("v"))
    scaled = F.transform("v", lambda x: x * SCALE)
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where("id is not null and label is not null and v is not null")
    rows = rows.withColumn("v", scaled).where(F.coalesce(finite, F.lit(False)))
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "id", "label", F.size("v").alias("dim"), "v")

    def summarize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                values = part.column("v").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, dim)
                values = np.floor(values)
                columns = [part.column(c) for c in ("row", "id", "label", "dim")]
                with np.errstate(over="ignore", invalid="ignore"):
                    columns += [_lists(x) for x in (values, *summaries(values))]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "id", "label", "dim", "v", "means", "deviations"])

    lists = ", ".join(f"{c} array<double>" for c in ("v", "means", "deviations"))
    return rows.mapInArrow(summarize, f"row long, id long, label long, dim int, {lists}")


def _lists(values: np.ndarray) -> pa.Array:
    count, width = values.shape
    offsets = pa.array(np.arange(count + 1) * width, pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(values.reshape(-1)))


def best_rows(anchors: DataFrame, rows: DataFrame, most: int, same_label: bool, blocks: int, shards: int) -> DataFrame:
    """anchor_row, anchor_id, k, place, score, id, row: the best rows of each anchor and range k of scores.

    ``anchors`` has lows and highs, the ends of the ranges, beside the columns of
    ``rows``. Best are the highest scores, of equal ones the smallest ids.
    """
    columns = ["dim", "id", "row", "label", "v", "means", "deviations"]
    block, shard = (F.pmod(F.xxhash64("row", F.lit(i)), F.lit(n)).cast("int") for i, n in ((1, blocks), (2, shards)))
    every_shard, every_block = (F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in (shards, blocks))
    asking = anchors.select(block.alias("block"), every_shard.alias("shard"), F.lit(0).alias("kind"), *columns, "lows", "highs")
    none = F.lit(None).cast("array<bigint>")
    asked = rows.select(every_block.alias("block"), shard.alias("shard"), F.lit(1).alias("kind"), *columns, none.alias("lows"), none.alias("highs"))
    met = asking.unionByName(asked).repartition(blocks * shards, "block", "shard")
    met = met.sortWithinPartitions("block", "shard", "dim", "kind", "id", "row")

    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, waiting, best = None, [], None

        def finish() -> Iterator[pa.RecordBatch]:
            if best is not None:
                names = ["anchor_row", "anchor_id", "k", "score", "id", "row"]
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in best.result()], names=names)

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("block", "shard", "dim", "kind")], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for start, stop in zip([0, *cuts], [*cuts, len(keys)], strict=True):
                if start == stop:
                    continue
                part, (*own, kind) = batch.slice(start, stop - start), keys[start].tolist()
                if own != group:
                    yield from finish()
                    group, waiting, best = own, [], None
                if kind == 0:
                    waiting.append(part)
                    continue
                if waiting:
                    together = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
                    lows, highs = (np.array(together.column(c).to_pylist(), np.int64) for c in ("lows", "highs"))
                    best, waiting = Best(Vectors(together, own[2]), lows, highs, most, same_label), []
                if best is not None:
                    best.see(Vectors(part, own[2]))
        yield from finish()

    found = met.mapInArrow(mine, "anchor_row long, anchor_id long, k long, score long, id long, row long")
    order = Window.partitionBy("anchor_row", "k").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)


def _percent(score: str, percent: int, up: bool):
    """``percent`` of a score that is not negative, rounded up or down; no step leaves the longs."""
    rest = f"({score} % 100) * {percent}" + (" + 99" if up else "")
    return F.expr(f"({score} div 100) * {percent} + ({rest}) div 100")


def hard_negatives(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    anchor_every: int = ANCHOR_EVERY,
    anchors_a_block: int = ANCHORS,
    shards: int = SHARDS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by ``anchor_every``; vectors are compared
    as they are, labels too.
    """
    rows = written_once(usable_vectors(df, key, vector, label))
    anchors = rows.where(F.col("id") % anchor_every == 0)
    blocks = max(1, -(-anchors.count() // anchors_a_block))
    lowest, highest = (F.array(F.lit(end).cast("long")) for end in (-_END, _END))
    asking = anchors.withColumns({"lows": lowest, "highs": highest})
    near = written_once(best_rows(asking, rows, positives, True, blocks, shards))
    ranges = near.where("score >= 0").select(
        "anchor_row",
        F.struct(
            "place",
            _percent("score", LOW_PERCENT, up=True).alias("low"),
            _percent("score", HIGH_PERCENT, up=False).alias("high"),
        ).alias("range"),
    )
    # Anchors with fewer positives get ranges that hold no score, so that all have as many.
    listed = ranges.groupBy("anchor_row").agg(F.collect_list("range").alias("ranges"))

    def ends(name: str, empty: int):
        def end_of(place):
            own = F.filter("ranges", lambda r: r["place"] == place + 1)
            return F.coalesce(F.get(own, F.lit(0))[name], F.lit(empty).cast("long"))

        return F.transform(F.sequence(F.lit(0), F.lit(positives - 1)), end_of)

    asking = anchors.join(listed, F.col("row") == F.col("anchor_row"))
    asking = asking.withColumns({"lows": ends("low", _END), "highs": ends("high", -_END)})
    far = best_rows(asking, rows, negatives, False, blocks, shards)
    far = far.select("anchor_row", (F.col("k") + 1).alias("of"), "place", "score", "id")
    near = near.select(
        "anchor_row", "anchor_id", F.col("place").alias("of"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return near.join(far, ["anchor_row", "of"]).select(
        "anchor_id",
        "positive_id",
        F.col("place").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
