"""Language identification by interpolated Kneser-Ney character models.

Each language has a model of character ``ORDER``-grams with absolute discounting and
continuation counts below the top order.  Texts are lower-cased, and every run of characters
that aren't letters counts as one space.  All models together are stored as sorted arrays of
n-gram hashes with one column per language, and a text gets the language with the lowest
cross-entropy per character.

The counts come from about ``FIT_DOCUMENTS`` labelled documents, chosen by hash, three
quarters of them; the last quarter calibrates the score (the probability, by a logistic fit,
that the prediction is right, from the margin to the second language and the length) and the
rejection (a text is marked ``rejected`` if its cross-entropy is above the
``1 - REJECT`` quantile of its language's own texts).  Prediction covers every whole text.

A null text, or one without a letter, is ``und`` with score 0.  Rows without lang or doc_id
aren't learnt from.  If nothing can be learnt, all rows are ``und``.  Ties go to the language
that sorts first.  Repeated rows each get their prediction; further columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import BASE, mix

ORDER = 4
FIT_DOCUMENTS = 20_000
REJECT = 0.005
SLICE_CHARS = 1 << 20
SPACE = 32


def letter_table() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def text_slices(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of runs of rows of about ``SLICE_CHARS`` characters."""
    texts: list[str] = []
    first = size = 0
    for i, value in enumerate(column):
        text = value.as_py() or ""
        if texts and size + len(text) > SLICE_CHARS:
            yield first, texts
            texts, first, size = [], i, 0
        texts.append(text)
        size += len(text)
    if texts:
        yield first, texts


def encoded(texts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each after ``ORDER - 1`` spaces, and the offsets of the texts."""
    pad = " " * (ORDER - 1)
    lowered = [pad + t.lower() for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in lowered])]).astype(np.int64)
    codes = np.where(letters[codes], codes, SPACE)
    keep = codes != SPACE
    keep[1:] |= codes[:-1] != SPACE
    for i in range(ORDER - 1):
        keep[bounds[:-1] + i] = True
    kept = np.concatenate([[0], np.cumsum(keep)])
    return codes[keep], kept[bounds]


def gram_hashes(codes: np.ndarray) -> list[np.ndarray]:
    """Hashes of the n-grams that end at each position, n = 0 .. ORDER (wrapping at the front)."""
    c = codes.astype(np.uint64) + np.uint64(1)
    out = [np.full(len(codes), 0x51ED270B, dtype=np.uint64)]
    for _ in range(ORDER):
        before = np.concatenate([out[-1][:1], out[-1][:-1]])
        out.append(mix(before * np.uint64(BASE) + c))
    return out


def string_hashes(grams: list[str]) -> np.ndarray:
    """``gram_hashes`` of strings of one length."""
    codes = np.frombuffer("".join(grams).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).reshape(len(grams), -1)
    h = np.full(len(grams), 0x51ED270B, dtype=np.uint64)
    for c in codes.T.astype(np.uint64):
        h = mix(h * np.uint64(BASE) + c + np.uint64(1))
    return h


@dataclass
class Models:
    languages: list[str]
    top: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))  # hashes of the seen ORDER-grams
    log_p: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))  # their log probabilities by language
    grams: list[np.ndarray] = field(default_factory=list)  # per order 1 .. ORDER: sorted hashes
    direct: list[np.ndarray] = field(default_factory=list)  # discounted shares by language
    contexts: list[np.ndarray] = field(default_factory=list)  # per order: sorted hashes of the contexts
    backoff: list[np.ndarray] = field(default_factory=list)  # weight of the next lower order
    floor: float = 1.0
    slope: float = 1.0
    bias: float = 0.0
    cutoffs: dict[str, float] = field(default_factory=dict)

    def _lookup(self, table: np.ndarray, values: np.ndarray, keys: np.ndarray, default: float) -> np.ndarray:
        if not len(table):
            return np.full((len(keys), len(self.languages)), default)
        at = np.minimum(table.searchsorted(keys), len(table) - 1)
        return np.where((table[at] == keys)[:, None], values[at], default)

    def interpolated(self, grams: list[np.ndarray], contexts: list[np.ndarray]) -> np.ndarray:
        """Log probabilities by language, from the hashes of orders 1 .. ORDER and of their contexts."""
        p = np.full((len(grams[0]), len(self.languages)), self.floor)
        for n in range(ORDER):
            p = self._lookup(self.grams[n], self.direct[n], grams[n], 0.0) + self._lookup(
                self.contexts[n], self.backoff[n], contexts[n], 1.0
            ) * p
        return np.log(p)

    def cross_entropies(self, texts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per text and language the cross-entropy per character, and the characters scored
        (0 for texts without a letter)."""
        codes, bounds = encoded(texts, letters)
        h = gram_hashes(codes)
        row = np.repeat(np.arange(len(texts)), np.diff(bounds))
        scored = np.ones(len(codes), dtype=bool)
        for i in range(ORDER - 1):
            scored[bounds[:-1] + i] = False
        at = np.flatnonzero(scored)
        key, row = h[ORDER][at], row[at]
        n = np.bincount(row, minlength=len(texts))
        sums = np.zeros((len(texts), len(self.languages)))
        place = np.minimum(self.top.searchsorted(key), max(0, len(self.top) - 1))
        seen = self.top[place] == key if len(self.top) else np.zeros(len(key), dtype=bool)
        for j in range(len(self.languages)):
            sums[:, j] = np.bincount(row[seen], self.log_p[place[seen], j], len(texts))
        if not seen.all():
            rest = at[~seen]
            _, first, back = np.unique(h[ORDER][rest], return_index=True, return_inverse=True)
            own = rest[first]
            values = self.interpolated([h[k][own] for k in range(1, ORDER + 1)], [h[k][own - 1] for k in range(ORDER)])
            for j in range(len(self.languages)):
                sums[:, j] += np.bincount(row[~seen], values[back, j], len(texts))
        has_letter = np.bincount(np.repeat(np.arange(len(texts)), np.diff(bounds)), codes != SPACE, len(texts)) > 0
        n = np.where(has_letter, n, 0)
        return -sums / np.maximum(n, 1)[:, None], n


def build(counts: dict[str, dict[str, int]]) -> Models:
    """Models from the ORDER-gram counts of every language."""
    languages = sorted(counts)
    model = Models(languages)
    if not languages:
        return model
    alphabet = {g[-1] for c in counts.values() for g in c}
    model.floor = 1.0 / (len(alphabet) + 1)
    direct: list[dict[str, list[float]]] = [{} for _ in range(ORDER)]
    backoff: list[dict[str, list[float]]] = [{} for _ in range(ORDER)]
    for j, language in enumerate(languages):
        level: dict[str, int] = dict(counts[language])
        for n in range(ORDER, 0, -1):
            ones = sum(c == 1 for c in level.values())
            twos = sum(c == 2 for c in level.values())
            discount = ones / (ones + 2 * twos) if ones and twos else 0.5
            total: Counter[str] = Counter()
            kinds: Counter[str] = Counter()
            for gram, c in level.items():
                total[gram[:-1]] += c
                kinds[gram[:-1]] += 1
            for gram, c in level.items():
                direct[n - 1].setdefault(gram, [0.0] * len(languages))[j] = max(c - discount, 0.0) / total[gram[:-1]]
            for context, t in total.items():
                backoff[n - 1].setdefault(context, [1.0] * len(languages))[j] = discount * kinds[context] / t
            # below the top order: in how many contexts a gram continues
            lower: Counter[str] = Counter()
            for gram in level:
                lower[gram[1:]] += 1
            level = lower
    for n in range(ORDER):
        for table, hashes, values in ((direct[n], model.grams, model.direct), (backoff[n], model.contexts, model.backoff)):
            h = string_hashes(list(table))
            order = np.argsort(h)
            hashes.append(h[order])
            values.append(np.array(list(table.values()), dtype=np.float64).reshape(len(h), -1)[order])
    seen = list(direct[-1])
    split = lambda f: string_hashes([f(g) for g in seen])
    grams = [split(lambda g, n=n: g[ORDER - n :]) for n in range(1, ORDER + 1)]
    contexts = [split(lambda g, n=n: g[ORDER - n : -1]) for n in range(1, ORDER + 1)]
    order = np.argsort(grams[-1])
    model.top = grams[-1][order]
    model.log_p = model.interpolated(grams, contexts)[order]
    return model


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from; so is a null doc_id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(True))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and bias of a ridge-regularised logistic fit by Newton's method."""
    w = np.array([1.0, 0.0])
    design = np.stack([x, np.ones(len(x))], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (y - p) - 0.01 * (w - [1.0, 0.0])
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2)
        w = w + np.linalg.solve(hessian, gradient)
    return max(float(w[0]), 0.0), float(w[1])


def _best(entropies: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index and entropy of the best language, and the margin to the second in units that
    allow for the length."""
    best = entropies.argmin(1)
    low = entropies[np.arange(len(best)), best]
    second = np.partition(entropies, 1, axis=1)[:, 1] if entropies.shape[1] > 1 else low + 1.0
    return best, low, (second - low) * np.sqrt(n)


def fit(docs: DataFrame, bound: int = FIT_DOCUMENTS) -> Models:
    spark = docs.sparkSession
    known = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"),
        F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(1 << 30)).alias("k"),
    )
    total = known.count()
    sample = known.where(F.col("k") < min(1 << 30, int((1 << 30) * bound / max(1, total))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letter_table()
        for batch in batches:
            found: dict[tuple[str, str], int] = defaultdict(int)
            langs = batch.column(1).to_pylist()
            for first, texts in text_slices(batch.column(0)):
                codes, bounds = encoded(texts, letters)
                key = gram_hashes(codes)[ORDER]
                lang_of = {v: i for i, v in enumerate(dict.fromkeys(langs[first : first + len(texts)]))}
                row_lang = np.array([lang_of[v] for v in langs[first : first + len(texts)]])
                scored = np.ones(len(codes), dtype=bool)
                for i in range(ORDER - 1):
                    scored[bounds[:-1] + i] = False
                at = np.flatnonzero(scored)
                lang = np.repeat(row_lang, np.diff(bounds))[at]
                for name, j in lang_of.items():
                    own = at[lang == j]
                    _, where, n = np.unique(key[own], return_index=True, return_counts=True)
                    for i, c in zip(own[where], n):
                        found[name, "".join(map(chr, codes[i - ORDER + 1 : i + 1]))] += int(c)
            keys = list(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array(list(found.values()), pa.int64())],
                names=["lang", "gram", "n"],
            )

    grams = (
        sample.where("k % 4 <> 0").select("text", "lang").mapInArrow(count, "lang string, gram string, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    )
    counts: dict[str, dict[str, int]] = defaultdict(dict)
    for lang, gram, n in zip(*(grams[c].to_pylist() for c in ("lang", "gram", "n"))):
        counts[lang][gram] = n
    model = build(counts)
    if not model.languages:
        return model
    shared = spark.sparkContext.broadcast(vars(model))  # plain data: tasks build the object

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, m = letter_table(), Models(**shared.value)
        for batch in batches:
            for first, texts in text_slices(batch.column(0)):
                entropies, n = m.cross_entropies(texts, letters)
                best, low, margin = _best(entropies, n)
                names = [m.languages[b] for b in best]
                out = pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(first, len(texts)), pa.array(names), pa.array(low), pa.array(margin), pa.array(n)],
                    names=["lang", "best", "low", "margin", "n"],
                )
                yield out.filter(pa.array(n > 0))

    got = (
        sample.where("k % 4 = 0").select("text", "lang")
        .mapInArrow(score, "lang string, best string, low double, margin double, n long").toArrow()
    )
    if got.num_rows:
        lang, best = np.array(got["lang"].to_pylist()), np.array(got["best"].to_pylist())
        low, margin = got["low"].to_numpy(), got["margin"].to_numpy()
        order = np.lexsort([margin, low])
        lang, best, low, margin = lang[order], best[order], low[order], margin[order]
        model.slope, model.bias = _logistic(margin, (lang == best).astype(float))
        for name in model.languages:
            own = low[(lang == name) & (best == name)]
            if len(own):
                model.cutoffs[name] = float(np.quantile(own, 1 - REJECT))
    return model


def predict(docs: DataFrame, model: Models) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, cross_entropy, rejected) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, m = letter_table(), Models(**shared.value)
        for batch in batches:
            for first, texts in text_slices(batch.column(2)):
                if m.languages:
                    entropies, n = m.cross_entropies(texts, letters)
                    best, low, margin = _best(entropies, n)
                    known = n > 0
                    score = np.where(known, 1 / (1 + np.exp(-np.clip(m.slope * margin + m.bias, -30, 30))), 0.0)
                    names = [m.languages[b] if k else "und" for b, k in zip(best, known)]
                    high = np.array([m.cutoffs.get(x, np.inf) for x in names])
                    rejected = ~known | (low > high)
                else:
                    known = rejected = np.zeros(len(texts), dtype=bool)
                    names, score, low, rejected = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts)), ~known
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(texts)), batch.column(1).slice(first, len(texts)),
                        pa.array(names, pa.string()), pa.array(score), pa.array(low, mask=~known), pa.array(rejected),
                    ],
                    names=["doc_id", "held_out", "lang_pred", "score", "cross_entropy", "rejected"],
                )

    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text")
    )
    return source.mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double, cross_entropy double, rejected boolean"
    )
