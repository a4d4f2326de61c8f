"""Toxicity scores from a counterfactual-regularised linear classifier.

A text's features are its distinct words (runs outside ASCII separators, A-Z
lower-cased) as 64-bit hashes. The model is a logistic regression with an L1
term and no negative weights (words are evidence for toxicity only, so a long
clean text cannot outweigh an insult), fitted on a bounded sample of labelled rows (``sample_rows``, taken in
hash order of their ids). For every sampled text that names a group, its
identity terms are swapped for other terms of the same list, and the squared
change of the logit is added to the loss, so a neutral mention of any one group
moves no score. Only words in at least ``min_rows`` sampled texts can get a
weight. The sample's features reach the driver as positions in the list of those words
(bounded by ``sample_rows``), a slice of the sample at a time, so that its JVM never holds
them all; the weights go to all tasks.

Defined cases: a null or empty text has no words and scores the intercept; a
null id is never held out and never labelled; of several labels of one id the
largest counts; labels other than 0 and 1 are ignored; without any usable label
every score is 0; repeated rows are scored alike; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantspark.llm.common import byte_windows, fresh, read, scoped, stage, text_buffer, with_fields
from quantspark.llm.wordhash import separator_table, word_hashes
from quantspark.session import write_once

FOLDS = 5
WINDOW_BYTES = 1 << 18  # a window's temporaries take some fifty times as much
BATCH_BYTES = 8 << 20
# Batches between the JVM and the fit's tasks, both of which hold one whole.
SMALL_BATCHES = {"execution__arrow__maxRecordsPerBatch": "1500", "execution__arrow__maxBytesPerBatch": "8m"}
# Jobs in which the sample's features come to the driver.
SLICES = 8
SEPARATORS = separator_table(bytes(c for c in range(128) if not chr(c).isalnum()))
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("girl", "boy"), ("female", "male"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "natives", "refugees", "foreigners"), ("blind", "deaf", "disabled"),
)


@dataclass(frozen=True)
class Model:
    hashes: np.ndarray  # sorted
    weights: np.ndarray
    intercept: float


def held_out(id_col: str | Column = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _swaps(groups) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of identity terms and the hash each is swapped for."""
    words = [(a, g[(i + 1) % len(g)]) for g in groups for i, a in enumerate(g)]

    def hashed(texts):
        col = pa.array(texts)
        return word_hashes(*text_buffer(col), SEPARATORS, lower=True)[0]

    a, b = hashed([w for w, _ in words]), hashed([w for _, w in words])
    order = np.argsort(a)
    return a[order], b[order]


def _known(sorted_hashes: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions in ``h``, positions in ``sorted_hashes``) of what both hold."""
    at = np.searchsorted(sorted_hashes, h)
    hit = at < len(sorted_hashes)
    hit[hit] = sorted_hashes[at[hit]] == h[hit]
    return np.flatnonzero(hit), at[hit]


def _distinct(h: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((h, rows))
    h, rows = h[order], rows[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])
    return h[new], rows[new]


def _sample(docs: DataFrame, labels: DataFrame, sample_rows: int) -> DataFrame:
    """(place, toxic, text) of at most ``sample_rows`` labelled rows outside the held-out fold."""
    marks = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out())
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    picked = (docs.select("doc_id").join(marks, "doc_id").distinct()
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    texts = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")  # bounded by sample_rows
    return texts.dropDuplicates(["doc_id"]).select(F.xxhash64("doc_id").alias("place"), "toxic", "text")


def _features(sample: DataFrame) -> DataFrame:
    """(place, toxic, words: distinct word hashes)."""
    def run(batches):
        for batch in batches:
            data, offs = text_buffer(batch.column(2))
            for i, j in byte_windows(offs, WINDOW_BYTES):
                h, rows = _distinct(*word_hashes(data, offs[i:j + 1], SEPARATORS, lower=True))
                cut = np.searchsorted(rows, np.arange(j - i + 1)).astype(np.int32)
                words = pa.ListArray.from_arrays(pa.array(cut), pa.array(h.view(np.int64)))
                yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in batch.columns[:2]), words], names=["place", "toxic", "words"])

    return sample.mapInArrow(run, "place long, toxic int, words array<long>")


def _coded(features: DataFrame, table: np.ndarray) -> DataFrame:
    """(place, toxic, words: int32 positions in ``table`` of those it holds), in the order of ``place``."""
    def run(batches):
        for batch in batches:
            h = batch.column(2).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            on, at = _known(table, h)
            ends = np.cumsum(pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False))
            cuts = np.r_[0, np.searchsorted(on, ends)]
            raw = at.astype(np.int32).tobytes()
            words = pa.array([raw[4 * i:4 * j] for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist())], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], words], names=["place", "toxic", "words"])

    return features.mapInArrow(run, "place long, toxic int, words binary").orderBy("place")


def _sliced(coded: DataFrame):
    """Tables of all rows of ``coded``, which is written in the order of ``place``, by ranges of it."""
    edges = [-(1 << 63) + k * (1 << 64) // SLICES for k in range(1, SLICES)]
    for low, high in zip([None, *edges], [*edges, None]):
        part = coded if low is None else coded.filter(F.col("place") >= low)
        part = part if high is None else part.filter(F.col("place") < high)
        # one fixed order, so that reruns add up the same sums
        yield part.toArrow().sort_by("place")


def _runs(pieces, limit: int):
    """(positions, row offsets) of the rows of ``pieces`` in runs of at most ``limit``
    positions (one row at least), the same however the rows are cut into pieces."""
    col, sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)
    for more, cuts in pieces:
        col, sizes = np.concatenate([col, more]), np.concatenate([sizes, np.diff(cuts)])
        cuts = np.r_[0, np.cumsum(sizes)]
        i = 0
        for i, j in byte_windows(cuts, limit, rows=1 << 30):
            if j < len(sizes):
                yield col[cuts[i]:cuts[j]].copy(), cuts[i:j + 1] - cuts[i]
        col, sizes = col[cuts[i]:].copy(), sizes[i:]  # the last may go on
    if len(sizes):
        yield col, np.r_[0, np.cumsum(sizes)]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class _Rows:
    """Word positions of the sampled texts, row after row;
    sums go through them in runs of rows, so that no second copy is needed."""

    RUN = 1 << 18

    def __init__(self, pieces: Iterable[tuple[np.ndarray, np.ndarray]]):
        """(positions, row offsets) per run."""
        self.runs, at = [], 0
        for col, cuts in pieces:
            for i, j in byte_windows(cuts, self.RUN, rows=1 << 30):
                self.runs.append((at + i, at + j, col[cuts[i]:cuts[j]], np.diff(cuts[i:j + 1])))
            at += len(cuts) - 1
        self.n = at

    @classmethod
    def of(cls, tables) -> tuple[np.ndarray, _Rows]:
        """Labels and words of all rows; of the tables, one is held at a time."""
        toxic = [np.zeros(0)]

        def pieces():
            for table in tables:
                toxic.append(table.column("toxic").to_numpy().astype(np.float64))
                for column in table.column("words").chunks:
                    offs = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
                    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offs[0]:offs[-1]]
                    yield data.view(np.int32), (offs - offs[0]) // 4

        words = cls(_runs(pieces(), cls.RUN))
        return np.concatenate(toxic), words

    def keep(self, slot: np.ndarray) -> _Rows:
        """The words whose ``slot`` is not negative, under that number."""
        pieces = []
        for i, j, col, sizes in self.runs:
            new = slot[col]
            on = new >= 0
            cuts = np.r_[0, np.cumsum(np.bincount(np.repeat(np.arange(j - i), sizes)[on], minlength=j - i))]
            pieces.append((new[on].astype(np.int32), cuts))
        return _Rows(pieces)

    def by_row(self, values: np.ndarray) -> np.ndarray:
        out = np.empty(self.n)
        for i, j, col, sizes in self.runs:
            out[i:j] = np.bincount(np.repeat(np.arange(j - i), sizes), weights=values[col], minlength=j - i)
        return out

    def by_word(self, values: np.ndarray, words: int) -> np.ndarray:
        out = np.zeros(words)
        for i, j, col, sizes in self.runs:
            out += np.bincount(col, weights=np.repeat(values[i:j], sizes), minlength=words)
        return out

    def places(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, word) of every word that ``wanted`` marks."""
        rows, words = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        for i, j, col, sizes in self.runs:
            on = wanted[col]
            rows.append(np.repeat(np.arange(i, j), sizes)[on])
            words.append(col[on])
        return np.concatenate(rows), np.concatenate(words)


def train(docs: DataFrame, labels: DataFrame, groups=IDENTITY_TERMS, sample_rows: int = 50_000, min_rows: int = 5,
          l1: float | None = None, counterfactual: float = 1.0, steps: int = 150) -> Model:
    """Accelerated proximal gradient on mean log loss + l1 * w +
    counterfactual * mean squared logit change under the swaps, then once more
    with a fiftieth of ``l1`` over the words that kept a weight."""
    with scoped(docs.sparkSession, **SMALL_BATCHES):
        features = stage(_features(_sample(docs, labels, sample_rows)), "features")
    often = (features.select(F.explode("words").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n"))
             .filter(F.col("n") >= min_rows).select("h").toArrow().column("h").to_numpy())
    often = np.unique(often.astype(np.int64).view(np.uint64))
    a, b = _swaps(groups)
    vocab = np.unique(np.concatenate([often, a, b]))
    with scoped(docs.sparkSession, **SMALL_BATCHES):
        y, words = _Rows.of(_sliced(write_once(_coded(features, vocab), "coded")))
    if not len(y):
        return Model(np.zeros(0, np.uint64), np.zeros(0), -np.inf)
    pa.default_memory_pool().release_unused()
    n, m = len(y), len(vocab)

    # swapped pairs: for each text with identity terms, the words that go and come.
    # A word that does both (another term of its list is there too) cancels out.
    goes, comes = np.searchsorted(vocab, a), np.searchsorted(vocab, b)
    new_of = np.full(m, -1)
    new_of[goes] = comes
    gone_rows, gone = words.places(new_of >= 0)
    pair_rows, gone_pair = np.unique(gone_rows, return_inverse=True)
    pairs = len(pair_rows)
    come = np.unique(np.stack([gone_pair, new_of[gone]], axis=1), axis=0) if pairs else np.zeros((0, 2), np.int64)
    d_row, d_col = np.r_[gone_pair, come[:, 0]].astype(np.int64), np.r_[gone, come[:, 1]].astype(np.int64)
    d_val = np.r_[np.ones(len(gone)), -np.ones(len(come))]

    def fit(words, slot, free, penalty):
        """Weights and intercept of the words with a number in ``slot``; those that
        are not ``free`` stay without a weight."""
        d_on = slot[d_col] >= 0
        dc, dr, dv = slot[d_col[d_on]], d_row[d_on], d_val[d_on]
        m = len(free)
        # per-word step sizes: a bound of the curvature by row lengths
        width = words.by_row(np.ones(m)) + 1.0
        curve = words.by_word(width / (4 * n), m) + 1e-6
        if pairs:
            d_width = np.bincount(dr, minlength=pairs)
            curve += counterfactual * np.bincount(dc, weights=2.0 * d_width[dr] / pairs, minlength=m)
        bias_curve = width.sum() / (4 * n)
        mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        w, bias = np.zeros(m), float(np.log(mean / (1 - mean)))
        vw, vb, t = w, bias, 1.0
        for _ in range(steps):
            g = (_sigmoid(words.by_row(vw) + vb) - y) / n
            grad = words.by_word(g, m)
            if pairs:
                change = np.bincount(dr, weights=dv * vw[dc], minlength=pairs)
                grad += counterfactual * 2 / pairs * np.bincount(dc, weights=dv * change[dr], minlength=m)
            new_w, new_b = np.where(free, np.maximum(vw - (grad + penalty) / curve, 0), 0), vb - g.sum() / bias_curve
            t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
            vw, vb = new_w + (t - 1) / t_next * (new_w - w), new_b + (t - 1) / t_next * (new_b - bias)
            w, bias, t = new_w, new_b, t_next
        return w, float(bias)

    # noise in a mean over n rows shrinks with the root of n
    l1 = max(5e-4, 0.05 / np.sqrt(n)) if l1 is None else l1
    # a strong penalty picks the words, a weak one sets their weights
    keep = fit(words, np.arange(m), np.isin(vocab, often), l1)[0] != 0
    slot = np.where(keep, np.cumsum(keep) - 1, -1)
    words = words.keep(slot)  # few are left
    w, bias = fit(words, slot, np.ones(int(keep.sum()), bool), l1 / 50)
    vocab = vocab[keep]
    used = w != 0
    return Model(vocab[used], w[used], float(bias))


def _scores(model: Model, data: np.ndarray, offs: np.ndarray, maybe: np.ndarray) -> np.ndarray:
    out = np.full(len(offs) - 1, model.intercept)
    for i, j in byte_windows(offs, WINDOW_BYTES):
        h, rows = word_hashes(data, offs[i:j + 1], SEPARATORS, lower=True)
        on = maybe[(h & np.uint64(0xFFFFF)).astype(np.int64)]
        h, rows = h[on], rows[on]
        at = np.searchsorted(model.hashes, h)
        hit = at < len(model.hashes)
        hit[hit] = model.hashes[at[hit]] == h[hit]
        at, rows = at[hit], rows[hit]
        pair = np.unique(rows * len(model.hashes) + at) if len(at) else at
        if len(pair):
            out[i:j] += np.bincount(pair // len(model.hashes), weights=model.weights[pair % len(model.hashes)], minlength=j - i)
    return np.zeros(len(out)) if model.intercept == -np.inf else _sigmoid(out)


def add_scores(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score of its ``text``."""
    schema, at = with_fields(docs, **{name: T.DoubleType()}), docs.columns.index("text")

    def run(batches):
        maybe = np.zeros(1 << 20, bool)
        maybe[(model.hashes & np.uint64(0xFFFFF)).astype(np.int64)] = True
        for batch in batches:
            data, offs = text_buffer(batch.column(at))
            # answered in pieces, so that the JVM holds no second whole batch
            for i, j in byte_windows(offs, BATCH_BYTES):
                scores = _scores(model, data, offs[i:j + 1], maybe)
                yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in batch.columns), pa.array(scores)], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per document."""
    base = docs.select("doc_id", "text")
    scored = add_scores(base, train(base, labels.select("doc_id", "toxic"), **options))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that the classifier does not reject."""
    score = fresh(docs, "toxic_score")
    model = train(docs.select("doc_id", "text"), labels.select("doc_id", "toxic"), **options)
    return add_scores(docs, model, score).filter(F.col(score) < 0.5).select(*docs.columns)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
