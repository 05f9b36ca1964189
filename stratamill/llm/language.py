"""Language identification by a byte convolutional network.

Bytes of the lower-cased text are embedded; filters of several widths run over windows
of a fixed length, are max-pooled over the window, and a softmax over the languages
follows. As bytes are few, a filter of width w is w tables of 256 rows, so applying the
network is table look-ups and additions. It is trained in numpy on the driver, on a
bounded sample of labelled texts (``SAMPLE_TEXTS`` texts, ``CROPS`` pieces of
``CROP_CHARS`` characters each), and a few kilobytes of weights go to the tasks.

Every window of a whole text counts, weighted by its length. Prediction is one pass in
Arrow batches without a shuffle; memory is that of one batch. The sample takes the same
number of texts of each language as far as there are any, in the order of a hash; about
so many of each language are moved, dealt over tasks by ranges of the hash.

Defined cases: null texts and texts without a letter are ``und`` with score 0. Without a
labelled text everything is. Null labels and rows without a doc_id are never learned
from, and the latter are not held out. Ties go to the language that sorts first.
Repeated rows are judged each; empty tables give an empty result; extra columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratamill.llm.tokens import chunks
from stratamill.sinks.written import written_once

WINDOW = 192
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
UNKNOWN = "und"

SAMPLE_TEXTS = 4000
CROPS = 3
CROP_CHARS = 240
EPOCHS = 8
BATCH = 256
LEARNING_RATE = 0.01
SEED = 5
# Windows handled at a time, so that the filters' outputs stay in the cache.
TOGETHER = 64


def held_out(key: Column, folds: int = 3, fold: int = 1) -> Column:
    """Whether ``crc32`` of the key as text leaves the remainder ``fold``; false for a null key."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == fold, F.lit(False))


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray
    filters: dict[int, np.ndarray]
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray

    @classmethod
    def fresh(cls, languages: list[str], rng: np.random.Generator) -> Network:
        def normal(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        filters = {w: normal(w, EMBEDDING, FILTERS, scale=(w * EMBEDDING) ** -0.5) for w in WIDTHS}
        pooled = FILTERS * len(WIDTHS)
        return cls(
            languages,
            normal(256, EMBEDDING, scale=1.0),
            filters,
            np.zeros(pooled, np.float32),
            normal(pooled, len(languages), scale=pooled**-0.5),
            np.zeros(len(languages), np.float32),
        )

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters.values(), self.bias, self.dense, self.dense_bias]

    def convolved(self, windows: np.ndarray) -> Iterator[np.ndarray]:
        """For each width, the filters' values at every position: windows x positions x filters."""
        windows = windows.astype(np.intp)
        for width, kernel in self.filters.items():
            positions = windows.shape[1] - width + 1
            out = None
            for k in range(width):
                part = np.take(self.embedding @ kernel[k], windows[:, k : k + positions], axis=0, mode="clip")
                out = part if out is None else np.add(out, part, out=out)
            yield out

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        out = []
        for i in range(0, len(windows), TOGETHER):
            part = windows[i : i + TOGETHER]
            pooled = np.concatenate([c.max(axis=1) for c in self.convolved(part)], axis=1)
            out.append(_softmax(np.maximum(pooled + self.bias, 0) @ self.dense + self.dense_bias))
        return np.concatenate(out)

    def gradients(self, windows: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross-entropy, in the order of ``parameters``."""
        rows = np.arange(len(windows))
        peaks, pooled = [], []
        for c in self.convolved(windows):
            at = c.argmax(axis=1)
            peaks.append(at)
            pooled.append(np.take_along_axis(c, at[:, None, :], axis=1)[:, 0])
        active = np.concatenate(pooled, axis=1) + self.bias
        hidden = np.maximum(active, 0)
        error = _softmax(hidden @ self.dense + self.dense_bias)
        error[rows, target] -= 1
        error /= len(windows)
        back = (error @ self.dense.T) * (active > 0)
        d_embedding, d_filters = np.zeros_like(self.embedding), []
        column = np.arange(FILTERS)
        for i, (width, kernel) in enumerate(self.filters.items()):
            part = back[:, i * FILTERS : (i + 1) * FILTERS]
            d_kernel = np.empty_like(kernel)
            for k in range(width):
                # Only the position where a filter peaks passes its error on.
                byte = windows[rows[:, None], peaks[i] + k].astype(np.int64)
                flat = np.bincount((byte * FILTERS + column).ravel(), part.ravel(), 256 * FILTERS)
                table = flat.reshape(256, FILTERS).astype(np.float32)
                d_embedding += table @ kernel[k].T
                d_kernel[k] = self.embedding.T @ table
            d_filters.append(d_kernel)
        return [d_embedding, *d_filters, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def encoded(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace")


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows that cover every byte pattern of the texts, the text of each, and its bytes.

    They overlap by the widest filter less one. The last is filled up with zeros.
    """
    step = WINDOW - max(WIDTHS) + 1
    joined = np.frombuffer(b"".join(t + bytes(WINDOW) for t in texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    counts = np.maximum(1, -(-(sizes - max(WIDTHS) + 1) // step))
    owner = np.repeat(np.arange(len(texts)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    begins = np.cumsum(sizes + WINDOW) - sizes - WINDOW
    used = np.minimum(WINDOW, sizes[owner] - nth * step)
    return np.lib.stride_tricks.sliding_window_view(joined, WINDOW)[begins[owner] + nth * step], owner, used


def train(sample: list[tuple[str, str]]) -> Network | None:
    """A network for the (language, text piece) pairs; None without any."""
    languages = sorted({lang for lang, _ in sample})
    if not languages:
        return None
    rng = np.random.default_rng(SEED)
    network = Network.fresh(languages, rng)
    pieces = [encoded(text)[:WINDOW] for _, text in sample]
    target = np.array([languages.index(lang) for lang, _ in sample])
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in network.parameters()]
    step = 0
    for _ in range(EPOCHS):
        # Half of the pieces are cut short, so that short texts are learned as well.
        lengths = np.where(rng.random(len(pieces)) < 0.5, WINDOW, rng.integers(8, WINDOW, len(pieces)))
        cut = [p[:n].ljust(WINDOW, b"\0") for p, n in zip(pieces, lengths, strict=True)]
        windows = np.frombuffer(b"".join(cut), np.uint8).reshape(-1, WINDOW)
        order = rng.permutation(len(pieces))
        for i in range(0, len(order), BATCH):
            batch, step = order[i : i + BATCH], step + 1
            grads = network.gradients(windows[batch], target[batch])
            for p, g, (m, v) in zip(network.parameters(), grads, moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= LEARNING_RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return network


def _step(at: Column) -> Column:
    """Where a hash lies among all, in steps that grow with it: each is about a ninetieth of all before it.

    So the steps that hold the first texts of a language hold few others, however many texts
    there are, and a language has some thousand steps at most.
    """
    share = (at.cast("double") + F.lit(2.0**63) + F.lit(1.0)) / F.lit(2.0**64)
    return F.floor(F.log2(share) * 64)


def training_sample(
    df: DataFrame, key: str, text: str, lang: str, texts: int = SAMPLE_TEXTS
) -> list[tuple[str, str]]:
    """Pieces of at most ``texts`` labelled texts outside of the held-out fold.

    The texts of a language are taken in the order of a hash. They are counted by steps of
    it, which tells how many lie before each step, and numbered within their step: no task
    gets the texts of a whole language. Rows of equal id and text count once.
    """
    usable = df.where(
        F.col(lang).isNotNull() & F.col(key).isNotNull() & ~held_out(F.col(key)) & F.col(text).rlike(r"\p{L}")
    )
    marked = usable.select(
        F.col(lang).alias("lang"),
        F.col(key).alias("key"),
        F.col(text).alias("text"),
        F.xxhash64(F.lit(SEED), key, text).alias("at"),
    ).withColumn("step", _step(F.col("at")))
    sizes = marked.groupBy("lang", "step").agg(F.count_distinct("at").alias("n"))
    earlier = Window.partitionBy("lang").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    places = sizes.select("lang", "step", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    # Written, so that its size is known: the join is broadcast if that is small, and no text is moved.
    near = marked.join(written_once(places.where(F.col("before") < texts)), ["lang", "step"])
    room = F.greatest(F.length("text") - CROP_CHARS, F.lit(0)) + 1
    crops = [
        F.substring(F.col("text"), (F.pmod(F.xxhash64(F.lit(k), "key"), room) + 1).cast("int"), F.lit(CROP_CHARS))
        for k in range(CROPS)
    ]
    # Equal rows are folded before they move.
    once = near.groupBy("lang", "step", "before", "at").agg(F.min(F.array(*crops)).alias("crops"))
    within = F.row_number().over(Window.partitionBy("lang", "step").orderBy("at"))
    nth = once.select("lang", "crops", (F.col("before") + within).alias("nth")).where(F.col("nth") <= texts)
    rows = nth.orderBy("nth", "lang").limit(texts).select("lang", "crops").collect()
    return [(row["lang"], crop) for row in rows for crop in row["crops"]]


def predicted(df: DataFrame, network: Network | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``lang_pred`` and ``score`` of every row."""

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 1, 2 << 20):
            values = batch.column(1).to_pylist()
            lettered = [i for i, t in enumerate(values) if t and network and any(map(str.isalpha, t))]
            langs, scores = [UNKNOWN] * len(values), np.zeros(len(values))
            if lettered:
                windows, owner, used = windows_of([encoded(values[i]) for i in lettered])
                share = network.probabilities(windows) * used[:, None].astype(np.float64)
                total = np.add.reduceat(share, np.flatnonzero(np.diff(owner, prepend=-1)))
                mean = total / total.sum(axis=1, keepdims=True)
                best = mean.argmax(axis=1)
                for i, b, m in zip(lettered, best, mean, strict=True):
                    langs[i], scores[i] = network.languages[b], min(1.0, float(m[b]))
            columns = [batch.column(0), pa.array(langs, pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "lang_pred", "score"])

    schema = f"`{key}` {dict(df.dtypes)[key]}, lang_pred string, score double"
    return df.select(key, text).mapInArrow(predict, schema)


def identify(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``key``, ``held_out``, ``lang_pred``, ``score``, learned from the labels outside of the held-out fold."""
    network = train(training_sample(df, key, text, lang))
    return predicted(df, network, key, text).select(key, held_out(F.col(key)).alias("held_out"), "lang_pred", "score")
