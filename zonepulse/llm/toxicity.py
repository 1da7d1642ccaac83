"""Toxicity by a small convolutional text classifier, trained in numpy.

Words (runs of letters and digits, lower-cased in ASCII) are hashed to ``BUCKETS`` embeddings;
filters of several widths slide over the whole text, each filter's largest activation is
kept, and a logistic layer scores them.  The first embedding dimension starts as the word's
smoothed log-odds in the training documents; words not seen in training stay at zero.

The classifier is fitted on all labelled rows, three quarters for training and one for
calibration.  The training rows are dealt to shards of about ``SHARD_ROWS``.  In each epoch
every shard trains on its rows from the same network, and the changes are averaged: a shared
layer over all shards, an embedding over those that changed it.  Labels of more than
``BALANCED`` training rows weigh alike, smaller ones as many as they are.
Equal rows are one row with a weight.  Languages differ in what they confuse, so for each
language that function words in the *text* tell, the cutoff with the best F1 on the
calibration rows (counted per language and ``1 / CELLS`` of the score) is moved to
``THRESHOLD``, monotonically.  Labels, lang, source and doc_id are no input of a score.

A null or empty text gets the score of a text without words.  Null labels and rows without
doc_id aren't learnt from; if a class has no row, every score is that of the other's share.
Repeated rows each get their score; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bits import bit_filter, tester
from .common import durable_freed, durable_once
from .words import LOWER, SpanHash, slices, spans_of

BUCKETS = 1 << 17
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
PAD = max(WIDTHS) - 1
SHARD_ROWS = 4_096
BALANCED = 3_000
CELLS = 1 << 16
ID_BITS = 23
SCALE = 1 << 32  # changes are summed as whole numbers of 1 / SCALE, so in any order alike
EPOCHS = 8
THRESHOLD = 0.7

IN_WORD = np.zeros(256, dtype=bool)
IN_WORD[128:] = True
for _lo, _hi in ((48, 58), (65, 91), (97, 123)):
    IN_WORD[_lo:_hi] = True

# Function words that tell the language of a text.
FUNCTION_WORDS = {
    "en": "the and of to in is that it was for with are",
    "de": "der die und den das ist nicht ein eine mit sich auf",
    "fr": "le les et des est une dans que pour qui pas sur",
    "es": "el los y del que las por un con para una su",
}


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a slice, and the words before each row."""
    starts, ends = spans_of(IN_WORD[data], bounds)
    return SpanHash(LOWER[data])(starts, ends), np.searchsorted(starts, bounds)


def padded(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each word with ``PAD`` empty places after every row, and where rows start."""
    rows = len(first) - 1
    ids = np.full(len(hashes) + PAD * rows, BUCKETS, dtype=np.int64)
    row = np.repeat(np.arange(rows), np.diff(first))
    ids[np.arange(len(hashes)) + PAD * row] = (hashes % np.uint64(BUCKETS)).astype(np.int64)
    return ids, first[:-1] + PAD * np.arange(rows)


def language_hashes() -> dict[str, np.ndarray]:
    out = {}
    for name, listed in FUNCTION_WORDS.items():
        data = np.frombuffer(listed.encode(), dtype=np.uint8)
        out[name] = np.sort(word_hashes(data, np.array([0, len(data)]))[0])
    return out


def told_language(hashes: np.ndarray, first: np.ndarray, lists: dict[str, np.ndarray]) -> np.ndarray:
    """Index of the language with the most function words per row, -1 without any."""
    counts = []
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for listed in lists.values():
        at = np.minimum(listed.searchsorted(hashes), len(listed) - 1)
        counts.append(np.bincount(row[listed[at] == hashes], minlength=len(first) - 1))
    counts = np.stack(counts)
    return np.where(counts.max(0) > 0, counts.argmax(0), -1)


@dataclass
class Network:
    embedding: np.ndarray  # (BUCKETS + 1, DIM); the last row is the empty place
    filters: list[np.ndarray] = field(default_factory=list)  # per width (width, DIM, FILTERS)
    biases: list[np.ndarray] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(len(WIDTHS) * FILTERS))
    bias: float = 0.0
    cutoffs: dict[int, float] = field(default_factory=dict)  # by language index; -1 for the rest

    def activations(self, ids: np.ndarray, width: int) -> np.ndarray:
        """One filter width at every position.  A window that starts at an empty place counts
        as empty, so no window reaches into the next row."""
        k = WIDTHS.index(width)
        x = self.embedding[ids]
        out = np.tile(self.biases[k].astype(np.float32), (len(ids), 1))
        for j in range(width):
            out[: len(ids) - j] += x[j:] @ self.filters[k][j]
        out[ids == BUCKETS] = self.biases[k]
        return np.maximum(out, 0, out=out)

    def probabilities(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        pooled = [np.maximum.reduceat(self.activations(ids, w), starts, axis=0) for w in WIDTHS]
        margin = np.concatenate(pooled, axis=1) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))

    def calibrated(self, p: np.ndarray, language: np.ndarray) -> np.ndarray:
        """Monotone map per language that takes its cutoff to ``THRESHOLD``."""
        rest = self.cutoffs.get(-1, THRESHOLD)
        cut = np.array([self.cutoffs.get(int(i), rest) for i in language])
        return np.where(p < cut, THRESHOLD * p / cut, THRESHOLD + (1 - THRESHOLD) * (p - cut) / (1 - cut))


@dataclass
class Training:
    """A network and what its optimisers remember: Adam on the layers, Adagrad on the embeddings."""

    net: Network
    moments: list[tuple[np.ndarray, np.ndarray]]  # per layer, the last for the bias
    squares: np.ndarray
    step: float = 0.0

    @staticmethod
    def start(seen: np.ndarray, sizes: np.ndarray, seed: int = 11) -> Training:
        """``seen``: documents (clean, toxic) with each bucket; ``sizes``: all of them."""
        rng = np.random.Generator(np.random.PCG64(seed))
        odds = np.log((seen[1] + 0.5) / (sizes[1] + 1)) - np.log((seen[0] + 0.5) / (sizes[0] + 1))
        known = seen[0] + seen[1] > 0
        embedding = np.zeros((BUCKETS + 1, DIM), dtype=np.float32)
        embedding[:BUCKETS] = rng.normal(0, 0.05, (BUCKETS, DIM)) * known[:, None]
        embedding[:BUCKETS, 0] = np.where(known, odds / 4, 0)
        net = Network(embedding)
        for w in WIDTHS:
            f = rng.normal(0, 0.2, (w, DIM, FILTERS)).astype(np.float32)
            f[:, 0, :] = np.abs(f[:, 0, :]) + 0.3 / w
            net.filters.append(f)
            net.biases.append(np.zeros(FILTERS, dtype=np.float32))
        net.weights = np.abs(rng.normal(0, 0.2, len(WIDTHS) * FILTERS)).astype(np.float32)
        net.bias = -1.0
        moments = [(np.zeros_like(s), np.zeros_like(s)) for s in (*net.filters, *net.biases, net.weights, np.zeros(1))]
        return Training(net, moments, np.full(BUCKETS + 1, 1e-3, dtype=np.float32))

    def rows(self) -> np.ndarray:
        """Everything as rows of ``DIM + 1`` numbers: the embeddings with their squares, then the rest."""
        net = self.net
        layers = [*net.filters, *net.biases, net.weights, np.array([net.bias, self.step])]
        rest = np.concatenate([x.ravel() for x in (*layers, *(x for pair in self.moments for x in pair))]).astype(np.float64)
        rest = np.append(rest, np.zeros(-len(rest) % (DIM + 1)))
        return np.concatenate([np.column_stack([net.embedding, self.squares]), rest.reshape(-1, DIM + 1)])

    def changed(self, rows: np.ndarray) -> Training:
        """The state that ``rows`` describe; of this one only the layers' shapes matter."""
        rest, at = rows[BUCKETS + 1 :].ravel(), 0

        def take(like: np.ndarray) -> np.ndarray:
            nonlocal at
            at += like.size
            return rest[at - like.size : at].reshape(like.shape).astype(like.dtype)

        net = Network(rows[: BUCKETS + 1, :DIM].astype(np.float32))
        net.filters = [take(x) for x in self.net.filters]
        net.biases = [take(x) for x in self.net.biases]
        net.weights = take(self.net.weights)
        net.bias, step = (float(x) for x in take(np.zeros(2)))
        moments = [(take(m), take(v)) for m, v in self.moments]
        return Training(net, moments, rows[: BUCKETS + 1, DIM].astype(np.float32), step)

    def epoch(self, docs: list[np.ndarray], y: np.ndarray, weight: np.ndarray, rng: np.random.Generator) -> None:
        """One pass over ``docs``; gradients flow through the pooled places only."""
        net, squares = self.net, self.squares
        slots = [*net.filters, *net.biases, net.weights]
        order = rng.permutation(len(docs))
        for lo in range(0, len(order), 32):
            batch = order[lo : lo + 32]
            ids = np.concatenate([docs[i] for i in batch])
            starts = np.concatenate([[0], np.cumsum([len(docs[i]) for i in batch])]).astype(np.int64)
            pooled, places = [], []
            for w in WIDTHS:
                a = net.activations(ids, w)
                at = np.stack([starts[i] + a[starts[i] : starts[i + 1]].argmax(0) for i in range(len(batch))])
                places.append(at)
                pooled.append(a[at, np.arange(FILTERS)])
            features = np.concatenate(pooled, axis=1)
            p = 1 / (1 + np.exp(-np.clip(features @ net.weights + net.bias, -30, 30)))
            error = ((p - y[batch]) * weight[batch] / len(batch)).astype(np.float32)
            gradients: list[np.ndarray] = [np.zeros_like(s) for s in slots]
            gradients[-1] = features.T @ error + 1e-4 * net.weights
            rows, deltas = [], []
            for k, w in enumerate(WIDTHS):
                part = slice(k * FILTERS, (k + 1) * FILTERS)
                back = error[:, None] * net.weights[part] * (pooled[k] > 0)
                gradients[len(WIDTHS) + k] = back.sum(0)
                for j in range(w):
                    empty = ids[places[k]] == BUCKETS
                    token = np.where(empty, BUCKETS, ids[np.minimum(places[k] + j, len(ids) - 1)])
                    gradients[k][j] = np.einsum("bf,bfd->df", back, net.embedding[token])
                    rows.append(token.ravel())
                    deltas.append((back[:, :, None] * net.filters[k][j].T).reshape(-1, DIM))
            self.step += 1
            bias = np.array([net.bias])
            for s, g, (m, v) in zip([*slots, bias], [*gradients, error.sum(keepdims=True)], self.moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                s -= 0.01 * (m / (1 - 0.9**self.step)) / (np.sqrt(v / (1 - 0.999**self.step)) + 1e-7)
            net.bias = float(bias[0])
            token, delta = np.concatenate(rows), np.concatenate(deltas)
            touched, back_to = np.unique(token, return_inverse=True)
            total = np.zeros((len(touched), DIM), dtype=np.float32)
            np.add.at(total, back_to, delta)
            squares[touched] += (total**2).mean(1)
            net.embedding[touched] -= 0.02 * total / np.sqrt(squares[touched])[:, None]
            net.embedding[BUCKETS] = 0


CHANGES = [f"d{i}" for i in range(DIM + 1)]


def train(rows: DataFrame, sizes: np.ndarray, shards: int) -> Network:
    """The network after ``EPOCHS`` epochs on all of ``rows`` (ids, toxic, n, shard)."""

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = [np.zeros(0, np.int64), *(np.unique(x[x < BUCKETS]) for x in _split(batch.column(0)))]
            n = np.repeat(batch.column(2).to_numpy(), [len(x) for x in docs[1:]])
            toxic = np.repeat(batch.column(1).to_numpy(), [len(x) for x in docs[1:]]) == 1
            found, at = np.unique(np.concatenate(docs), return_inverse=True)
            counts = [np.bincount(at, n * c, len(found)).astype(np.int64) for c in (~toxic, toxic)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (found, *counts)], names=["bucket", "clean", "toxic"])

    got = (
        rows.select("ids", "toxic", "n").mapInArrow(buckets, "bucket long, clean long, toxic long")
        .groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow()
    )
    seen = np.zeros((2, BUCKETS))
    seen[:, got["bucket"].to_numpy()] = got["clean"].to_numpy(), got["toxic"].to_numpy()
    state = Training.start(seen, sizes)
    share = np.minimum(1, BALANCED / sizes)
    per_label = share * sizes.sum() / (share * sizes).sum()
    context = rows.sparkSession.sparkContext
    for turn in range(EPOCHS):
        before = state.rows()
        shared = context.broadcast(before)
        shapes = Training(replace(state.net, embedding=np.zeros((0, DIM))), state.moments, np.zeros(0))

        def changes(table: pa.Table) -> pa.Table:
            table = table.sort_by([("k", "ascending"), ("toxic", "ascending"), ("hash", "ascending")])
            own = shapes.changed(shared.value)  # noqa: B023
            y = table["toxic"].to_numpy()
            docs = [x for chunk in table["ids"].chunks for x in _split(chunk)]
            rng = np.random.Generator(np.random.PCG64([11, turn, table["shard"][0].as_py()]))  # noqa: B023
            own.epoch(docs, y.astype(np.float32), table["n"].to_numpy() * per_label[y], rng)
            delta = own.rows() - shared.value  # noqa: B023
            at = np.flatnonzero((delta != 0).any(1) | (np.arange(len(delta)) > BUCKETS))
            columns = [pa.array(c) for c in np.rint(delta[at] * SCALE).astype(np.int64).T]
            return pa.Table.from_arrays([pa.array(at), *columns], names=["at", *CHANGES])

        schema = f"at long, {', '.join(f'{c} long' for c in CHANGES)}"
        summed = durable_freed(
            rows.groupBy("shard").applyInArrow(changes, schema)
            .groupBy("at").agg(F.count("*").alias("shards"), *(F.sum(c).alias(c) for c in CHANGES))
        ).toArrow()
        total = np.stack([summed[c].to_numpy() for c in CHANGES], axis=1) / SCALE
        before[summed["at"].to_numpy()] += total / summed["shards"].to_numpy()[:, None]
        state = state.changed(before)
    return state.net


def best_cutoff(p: np.ndarray, y: np.ndarray, weight: np.ndarray, width: float = 0.0) -> float:
    """Cutoff with the highest weighted F1, midway to the next lower value; a value stands
    for the scores from ``p`` to ``p + width``."""
    order = np.argsort(-p, kind="stable")
    hit = np.cumsum(weight[order] * y[order])
    f1 = 2 * hit / (np.cumsum(weight[order]) + (weight * y).sum())
    f1[:-1][p[order][1:] == p[order][:-1]] = -1  # equal values are on one side
    i = int(f1.argmax())
    value = p[order][i]
    lower = p[order][p[order] < value]
    return float(np.clip((value + lower[0] + width) / 2 if len(lower) else value, 1e-6, 1 - 1e-6))


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from; so is a null doc_id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame) -> Network | float:
    """The network, or the share of toxic labels if there is only one class (0 without labels)."""
    known = (
        labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .withColumn("k", F.pmod(F.xxhash64("label_id"), F.lit(1 << 30)))
    )
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return 1.0 if sizes.get(1) else 0.0
    wanted = bit_filter(known.select("label_id"), ID_BITS)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, test = language_hashes(), tester(wanted)
        for batch in batches:
            batch = batch.filter(pa.array(test(batch.column(0).to_numpy())))
            for lo, hi, data, bounds in slices(batch.column(1)):
                hashes, first = word_hashes(data, bounds)
                ids, starts = padded(hashes, first)
                offsets = np.append(starts, len(ids)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo), pa.array(told_language(hashes, first, lists)),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32))),
                    ],
                    names=["label_id", "language", "ids"],
                )

    source = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("label_id"), F.col("text").cast("string").alias("text"))
    rows = durable_once(
        source.mapInArrow(encode, "label_id long, language long, ids array<int>").join(known, "label_id")
        .groupBy("label_id", "k", "toxic", "language", "ids").agg(F.count("*").alias("n"))
        .select("ids", "toxic", "n", "k", "language", F.xxhash64("ids").alias("hash"))
    )
    calibrate = F.col("k") % 4 == 0
    parts = rows.groupBy(calibrate.alias("c"), "toxic").agg(F.sum("n").alias("n"), F.count("*").alias("rows")).collect()
    if not parts:
        return 0.0
    counts = np.array([sum(r.n for r in parts if not r.c and r.toxic == t) for t in (0, 1)])
    if not counts.all():
        return sum(r.n for r in parts if r.toxic) / sum(r.n for r in parts)
    shards = -(-sum(r.rows for r in parts if not r.c) // SHARD_ROWS)
    net = train(rows.where(~calibrate).withColumn("shard", F.pmod(F.xxhash64("k", "hash"), F.lit(shards))), counts, shards)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = _split(batch.column(0))
            p = np.zeros(len(ids))
            for lo in range(0, len(ids), 64):
                some = ids[lo : lo + 64]
                starts = np.concatenate([[0], np.cumsum([len(x) for x in some])[:-1]]).astype(np.int64)
                p[lo : lo + 64] = net.probabilities(np.concatenate(some), starts)
            yield pa.RecordBatch.from_arrays([pa.array((p * CELLS).astype(np.int64)), *batch.columns[1:]], names=["cell", "toxic", "n", "language"])

    got = (
        rows.where(calibrate).select("ids", "toxic", "n", "language").mapInArrow(cells, "cell long, toxic int, n long, language long")
        .groupBy("language", "cell", "toxic").agg(F.sum("n").alias("n")).toArrow()
    )
    cell, y, weight, language = (got[c].to_numpy() for c in ("cell", "toxic", "n", "language"))
    p = cell / CELLS
    if (y * weight).sum():
        net.cutoffs[-1] = best_cutoff(p, y, weight, 1 / CELLS)
    for j in range(len(FUNCTION_WORDS)):
        own = language == j
        if (y * weight)[own].sum() >= 30:
            net.cutoffs[j] = best_cutoff(p[own], y[own], weight[own], 1 / CELLS)
    return net


def _split(chunk: pa.ListArray) -> list[np.ndarray]:
    flat, at = chunk.values.to_numpy(), chunk.offsets.to_numpy()
    return [flat[a:b].astype(np.int64) for a, b in zip(at, at[1:])]


def score(docs: DataFrame, model: Network | float) -> DataFrame:
    """(doc_id, held_out, score, predicted, language) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model) if isinstance(model, Network) else model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = language_hashes()
        names = list(lists)
        net = Network(**shared.value) if isinstance(shared.value, dict) else None
        for batch in batches:
            for lo, hi, data, bounds in slices(batch.column(2)):
                hashes, first = word_hashes(data, bounds)
                language = told_language(hashes, first, lists)
                if net is None:
                    value = np.full(hi - lo, float(shared.value))
                else:
                    value = net.calibrated(net.probabilities(*padded(hashes, first)), language)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(value),
                        pa.array((value >= THRESHOLD).astype(np.int32)), pa.array([names[i] if i >= 0 else None for i in language], pa.string()),
                    ],
                    names=["doc_id", "held_out", "score", "predicted", "language"],
                )

    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text")
    )
    return source.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, language string")
