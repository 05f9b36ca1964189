"""Near-duplicate documents by circulant MinHash.

1. *Sketch*, one pass over the texts: the set of word shingles is hashed to places of a
   fixed range; one permutation scatters the places, a second one, circularly shifted by
   k, gives the k-th signature value, its smallest over the set. Bands of the signature
   are hashed.
2. *Classes*: texts of the same words are one class, represented by its smallest doc_id.
   Copies are never paired.
3. *Candidates*: classes that share a band are a bucket. First, each class is paired with
   one other only: of its buckets' smallest classes the one it shares most bands with.
   Second, in buckets whose classes do not hang together yet, those outside of the
   largest component are paired with one class drawn from it. Third, classes that still
   share buckets with other components are joined by an exact prefix filter. So a group
   of near copies costs a few pairs per member, texts that merely share a long passage
   are not paired at all, and nothing is capped.
4. *Confirmation*: both texts of a pair are compared as full sets of word tuples.
5. Components of the links; the smallest doc_id of each is kept.

With 40 bands of 5 values, of which two must agree, a pair at the limit of 0.8 is missed
with a chance of 3e-6.
What is shuffled are sketches, band rows of three numbers, and the texts of candidates.

Defined cases: null or empty texts, or ones without words, have no shingles and link
with nothing. A text with fewer words than a shingle is one shingle. Rows without a
doc_id link with nothing, have no component and are kept. Rows that share a doc_id and
text are kept or not together; where they differ in text, each is judged by its own.
Empty tables give an empty result. Extra columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamill.llm.components import components
from stratamill.llm.tokens import chunks
from stratamill.sinks.written import written_once

BANDS, ROWS = 40, 5
# Open buckets that a class must be in to take part in the last step.
LEAST_SHARED = 2
SEED = 11
RANGE_BITS = 20
# Up to so many ids are broadcast; more are joined by a shuffle.
BROADCAST_IDS = 500_000
# Parts that the partners of one class are dealt into.
SALTS = 16
# Bytes of texts unpacked, and of one text hashed, at a time.
CHUNK_BYTES = 2 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xBF58476D1CE4E5B9)


def _mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer: multiply and fold."""
    x = (x ^ (x >> np.uint64(31))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _MIX2
    return x ^ (x >> np.uint64(32))


@lru_cache(maxsize=2)
def _coefficients(count: int) -> np.ndarray:
    return _mixed(np.arange(1, count + 1, dtype=np.uint64) * _MIX) | np.uint64(1)


def word_hashes(words: bytes) -> np.ndarray:
    """A 64-bit hash of each of the single-spaced words; those of a long text part by part."""
    parts, start = [], 0
    while start < len(words):
        stop = words.find(b" ", start + CHUNK_BYTES)
        stop = len(words) if stop < 0 else stop
        parts.append(_hashes_of_part(words[start:stop]))
        start = stop + 1
    return np.concatenate(parts) if len(parts) > 1 else parts[0]


def _hashes_of_part(words: bytes) -> np.ndarray:
    raw = np.frombuffer(words + b" ", np.uint8)
    stops = np.flatnonzero(raw == 32)
    starts = np.concatenate(([0], stops[:-1] + 1))
    lengths = stops - starts + 1
    within = np.arange(len(raw)) - np.repeat(starts, lengths)
    longest = int(lengths.max())
    values = (raw.astype(np.uint64) + np.uint64(1)) * _coefficients(1 << max(10, longest.bit_length()))[within]
    return _mixed(np.add.reduceat(values, starts))


def shingle_hashes(words: bytes, size: int) -> np.ndarray:
    """Distinct hashes of the runs of ``size`` words; of the whole sequence if it is shorter."""
    hashes = word_hashes(words)
    count = max(1, len(hashes) - size + 1)
    out = np.zeros(count, np.uint64)
    for k in range(min(size, len(hashes))):
        out = _mixed(out * _MIX2 + hashes[k : k + count])
    return np.unique(out)


@lru_cache(maxsize=2)
def _permutations(seed: int, values: int) -> tuple[np.ndarray, np.ndarray]:
    """The scattering permutation, and the circulant one as windows of ``values`` shifts."""
    rng = np.random.default_rng(seed)
    scatter = rng.permutation(1 << RANGE_BITS).astype(np.int32)
    circle = rng.permutation(1 << RANGE_BITS).astype(np.int32)
    circle = np.concatenate((circle, circle[: values - 1]))
    return scatter, np.lib.stride_tricks.sliding_window_view(circle, values)


def signature(shingles: np.ndarray, values: int, seed: int = SEED) -> np.ndarray:
    """``values`` circulant MinHash values of a set of shingle hashes."""
    scatter, shifts = _permutations(seed, values)
    places = scatter[(shingles >> np.uint64(64 - RANGE_BITS)).astype(np.int64)]
    out = None
    for i in range(0, len(places), 4096):
        least = shifts[places[i : i + 4096]].min(axis=0)
        out = least if out is None else np.minimum(out, least)
    return out


def band_hashes(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    grouped = values.astype(np.uint64).reshape(bands, rows)
    out = _mixed(np.arange(1, bands + 1, dtype=np.uint64))
    for k in range(rows):
        out = _mixed(out * _MIX2 + grouped[:, k])
    return out.view(np.int64)


def words_of(text: str) -> bytes:
    """Lower-cased (A-Z) words, single-spaced; bytes split exactly at space and 0x09 to 0x0D."""
    return b" ".join(text.encode("utf-8", "surrogatepass").lower().split())


def sketches(df: DataFrame, key: str, text: str, size: int, bands: int, rows: int) -> DataFrame:
    """``doc``, ``mark`` (hash of the raw text), ``print`` (of its words), ``n_shingles``, ``bands``."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 2, CHUNK_BYTES):
            prints, counts, flat = [], [], []
            for value in batch.column(2).to_pylist():
                words = words_of(value or "")
                prints.append(hashlib.blake2b(words, digest_size=16).digest() if words else None)
                shingles = shingle_hashes(words, size) if words else np.zeros(0, np.uint64)
                counts.append(len(shingles))
                flat.append(band_hashes(signature(shingles, bands * rows), bands, rows) if words else None)
            columns = [
                batch.column(0),
                batch.column(1),
                pa.array(prints, pa.binary()),
                pa.array(counts, pa.int64()),
                pa.array(flat, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "mark", "print", "n_shingles", "bands"])

    schema = f"doc {dict(df.dtypes)[key]}, mark long, print binary, n_shingles long, bands array<long>"
    rows_in = df.select(F.col(key).alias("doc"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))
    return rows_in.mapInArrow(sketch, schema)


def _size_fits(a: str, b: str, percent: int):
    return (F.col(a) * 100 >= F.col(b) * percent) & (F.col(b) * 100 >= F.col(a) * percent)


def _texts_of(ids: DataFrame, most: int, docs: DataFrame, key: str, text: str) -> DataFrame:
    """``_id``, ``_text``, ``_mark`` of the rows with one of the ids, of which there are ``most`` at most.

    Repeated rows are folded, within the partitions by id that joins behind it read.
    """
    texts = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text"), F.xxhash64(text).alias("_mark"))
    texts = texts.join(F.broadcast(ids) if most <= BROADCAST_IDS else ids, "_id", "left_semi")
    return texts.repartition("_id").dropDuplicates(["_id", "_mark"])


def _confirmed(pairs: DataFrame, docs: DataFrame, key: str, text: str, size: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b), a written table, whose full shingle sets are similar enough, as (u, v)."""
    needed = pairs.select(F.col("a").alias("_id")).union(pairs.select("b")).distinct()
    texts = _texts_of(needed, 2 * pairs.count(), docs, key, text)
    # A class that leads many others is sent once per part of its partners.
    salted = pairs.select("a", "b", F.pmod(F.xxhash64("b"), F.lit(SALTS)).alias("salt"))
    left = texts.select(F.col("_id").alias("a"), F.col("_text").alias("a_text"))
    left = salted.select("a", "salt").distinct().join(left, "a")
    right = texts.select(F.col("_id").alias("b"), F.col("_text").alias("b_text"))
    both = salted.join(right, "b").join(left, ["a", "salt"]).select("a", "b", "a_text", "b_text")

    def shingles(value: str) -> set[tuple[bytes, ...]]:
        words = words_of(value or "").split()
        if not words:
            return set()
        return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_set = None, set()
        for batch in batches:
            good = []
            # Row by row: a batch of two long texts a row is not unpacked as a whole.
            for a, b in zip(batch.column(2), batch.column(3), strict=True):
                a, b = a.as_py(), b.as_py()
                if a != last:
                    last, last_set = a, shingles(a)
                other = shingles(b)
                common = len(last_set & other)
                total = len(last_set) + len(other) - common
                good.append(total > 0 and 100 * common >= percent * total)
            kept = batch.filter(pa.array(good, pa.bool_()))
            yield kept.select(["a", "b"]).rename_columns(["u", "v"])

    kind = dict(pairs.dtypes)["a"]
    return both.mapInArrow(compare, f"u {kind}, v {kind}")


def near_duplicates(
    df: DataFrame,
    shingle_words: int = 5,
    percent: int = 80,
    key: str = "doc_id",
    text: str = "text",
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """doc_id, text_mark, n_shingles, component_id, kept: one row per row of ``df``.

    Linked are sets with ``100 * intersection >= percent * union``. ``text_mark`` is
    ``xxhash64`` of the text, which tells rows of one id apart.
    """
    sketch = written_once(sketches(df, key, text, shingle_words, bands, rows))
    usable = sketch.where("doc is not null and print is not null")
    first = F.min_by(F.struct("n_shingles", "bands"), "doc").alias("s")
    classes = written_once(usable.groupBy("print").agg(F.min("doc").alias("node"), first))
    buckets = written_once(_buckets(classes, percent))

    def confirmed(pairs: DataFrame) -> DataFrame:
        return written_once(_confirmed(written_once(pairs), df, key, text, shingle_words, percent))

    links = confirmed(_led_pairs(buckets))
    hung = _open_rows(buckets, links.select(F.col("v").alias("node"), F.col("u").alias("root")))
    links = links.unionByName(confirmed(_drawn_pairs(hung, percent)))
    roots = written_once(components(links))
    apart = written_once(_open_classes(_open_rows(buckets, roots)))
    more = confirmed(_prefix_pairs(apart, df, key, text, shingle_words, percent))
    if not more.isEmpty():
        roots = written_once(components(links.unionByName(more)))
    return _labelled(sketch, classes, roots)


def _buckets(classes: DataFrame, percent: int) -> DataFrame:
    """A row per class and band that others have too: band, node, n, leader (the band's smallest class)
    and whether the leader is another class of a size that allows the similarity."""
    rows = classes.select("node", F.col("s.n_shingles").alias("n"), F.explode("s.bands").alias("band"))
    shared = rows.groupBy("band").agg(F.count("*").alias("members"), F.min(F.struct("node", "n")).alias("least"))
    led = rows.join(shared.where("members > 1"), "band").select(
        "band", "node", "n", F.col("least.node").alias("leader"), F.col("least.n").alias("n_leader")
    )
    fits = (F.col("leader") < F.col("node")) & _size_fits("n", "n_leader", percent)
    return led.select("band", "node", "n", "leader", fits.alias("fits"))


def _led_pairs(buckets: DataFrame) -> DataFrame:
    """Each class with the leader that it shares most bands with."""
    led = buckets.where("fits").groupBy("node", "leader").agg(F.count("*").alias("shared"))
    best = led.groupBy("node").agg(F.min(F.struct(-F.col("shared"), F.col("leader").alias("leader"))).alias("best"))
    return best.select(F.col("best.leader").alias("a"), F.col("node").alias("b"))


def _open_rows(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows of the buckets that hold several components: band, node, n, root, most, drawn, n_drawn.

    ``most`` is the root with most classes in the bucket and ``drawn`` one of them, by a
    hash.
    """
    placed = buckets.select("band", "node", "n").join(roots, "node", "left")
    placed = placed.withColumn("root", F.coalesce("root", "node"))
    drawn = F.min(F.struct(F.xxhash64("band", "node").alias("at"), "node", "n")).alias("drawn")
    inside = placed.groupBy("band", "root").agg(F.count("*").alias("size"), drawn)
    largest = F.max(F.struct("size", "root", "drawn")).alias("m")
    several = inside.groupBy("band").agg(F.count("*").alias("roots"), largest).where("roots > 1")
    drawn = [F.col("m.root").alias("most"), F.col("m.drawn.node").alias("drawn"), F.col("m.drawn.n").alias("n_drawn")]
    return placed.join(several.select("band", *drawn), "band")


def _drawn_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Each class outside of a bucket's largest component with the one drawn from that."""
    pairs = rows.where((F.col("root") != F.col("most")) & _size_fits("n", "n_drawn", percent))
    return pairs.select(F.least("drawn", "node").alias("a"), F.greatest("drawn", "node").alias("b")).distinct()


def _open_classes(rows: DataFrame) -> DataFrame:
    """``_id`` and ``root`` of the classes that stand in ``LEAST_SHARED`` open buckets or more."""
    found = rows.groupBy("node", "root").agg(F.count("*").alias("buckets"))
    return found.where(F.col("buckets") >= LEAST_SHARED).select(F.col("node").alias("_id"), "root")


def _prefix_pairs(
    apart: DataFrame, docs: DataFrame, key: str, text: str, size: int, percent: int
) -> DataFrame:
    """All pairs of the classes ``apart``, of different components, that may be similar enough.

    An exact filter: with shingles ordered by their frequency, rarest first, similar sets
    share one of their first ``n - ceil(n * percent / 100) + 1``, and at the first common
    one enough are left on either side. A passage that thousands of texts share is
    behind the words that tell them apart, and brings no two of them together.
    """

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 2, CHUNK_BYTES):
            words = [words_of(value or "") for value in batch.column(2).to_pylist()]
            sets = [shingle_hashes(w, size).view(np.int64) if w else [] for w in words]
            columns = [batch.column(0), batch.column(1), pa.array(sets, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["_id", "_mark", "_hashes"])

    texts = _texts_of(apart.select("_id"), apart.count(), docs, key, text)
    schema = f"_id {dict(apart.dtypes)['_id']}, _mark long, _hashes array<long>"
    sets = written_once(texts.select("_id", "_mark", "_text").mapInArrow(hashes, schema))
    tokens = sets.select("_id", "_mark", F.explode("_hashes").alias("h"))
    counted = tokens.groupBy("h").agg(F.count("*").alias("df"))
    ordered = tokens.join(counted, "h").groupBy("_id", "_mark").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("o"))
    ordered = ordered.join(apart, "_id").withColumn("n", F.size("o"))
    first = F.col("n") - F.ceil(F.col("n") * percent / 100).cast("int") + 1
    prefix = ordered.select("_id", "root", "n", F.posexplode(F.transform(F.slice("o", 1, first), lambda t: t["h"])))
    prefix = written_once(prefix.withColumnRenamed("col", "h"))
    x, y = (prefix.select("h", *[F.col(c).alias(f"{c}_{side}") for c in ("_id", "root", "n", "pos")]) for side in "xy")
    common = F.least(F.col("n_x") - F.col("pos_x"), F.col("n_y") - F.col("pos_y"))
    enough = common * (100 + percent) >= (F.col("n_x") + F.col("n_y")) * percent
    pairs = x.join(y, "h").where((F.col("_id_x") < F.col("_id_y")) & (F.col("root_x") != F.col("root_y")) & enough)
    return pairs.select(F.col("_id_x").alias("a"), F.col("_id_y").alias("b")).distinct()


def _labelled(sketch: DataFrame, classes: DataFrame, roots: DataFrame) -> DataFrame:
    placed = sketch.select("doc", "mark", "print", "n_shingles").join(classes.select("print", "node"), "print", "left")
    rooted = placed.join(roots, "node", "left")
    component = F.when(F.col("doc").isNotNull(), F.coalesce("root", "node", "doc"))
    return rooted.select(
        F.col("doc").alias("doc_id"),
        F.col("mark").alias("text_mark"),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc") == component, F.lit(True)).alias("kept"),
    )
