"""Cross-entropy difference of a target and a background word bigram model.

The background model is counted on all documents, the target model on the documents whose
labels say good quality and not toxic.  Both share one vocabulary, one list of bigrams and
one smoothing, so their losses can be compared token by token:

    P(w | v) = L * c(v w) / c(v) + (1 - L * kept(v) / c(v)) * (c(w) + K) / (N + K * (V + 1))

with kept(v) the count of the listed bigrams that start with v.  The vocabulary are all words
that occur twice at least, whatever the size of the corpus; words that occur once are one
unknown word.  Bigrams are listed by the same rule.  Words are lower-cased (A-Z); a document
starts after a start sign.

Tokens are kept in blocks: the distinct words of some 2 ** 19 tokens, and each token's place among
them.  A block asks for each of its words and bigrams once, in packed arrays dealt by hash over
parts of about ``2 ** part_bits`` tokens, and a part's task counts or looks them up and answers
every block in the order asked.  So a frequent word is one key of a block and no hot spot, and
what is shuffled is a few bytes for each distinct bigram of a block.  Once a block knows which
of its words occur once, it counts and asks for bigrams with the unknown word in their place.

The model is two durable tables of such parts, of words and of listed bigrams with their counts,
that grow with the corpus.

A document's ``score`` is its loss per token under the target model minus that under the
background model: lower is more like the target.  Null and empty texts, and all documents if
there is no target token, have null losses and score.  Labels that are null don't make a
target; of repeated labels the worst counts.  Repeated rows each get their score and each
count; a null doc_id is scored.  Further columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bits import bit_filter, tester
from .common import durable_once
from .words import BASE, SMALL_SLICE, mix, words
from .words import slices as slices_of

PART_BITS = 20
ID_BITS = 23
LAMBDA = 0.7
SMOOTH = 0.5
GROUP_TOKENS = 1 << 19  # tokens of a block
MIN_COUNT = 2
UNKNOWN, START = 1, 2  # in the place of a word's hash; the first two words of every block


@dataclass
class Model:
    """``words``: counts of known words (b, t) and of the listed bigrams that start with them
    (kept_b, kept_t), the latter of UNKNOWN and START too.  ``pairs``: counts (b, t) of the listed
    bigrams by ``pair_keys``.  Both are rows of packed arrays, one a part at most; b: background
    model, t: target model."""

    words: DataFrame
    pairs: DataFrame
    total: tuple[int, int]
    inside: tuple[int, int]  # tokens that are known words
    size: int  # known words
    bits: int  # there are 2 ** bits parts


def slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    return slices_of(column, SMALL_SLICE)


def pair_keys(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    return mix(mix(before) * np.uint64(BASE) + after)


def packed(values: np.ndarray) -> bytes:
    """Compressed plane by plane: first the lowest bytes of all values, at last the highest."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, n: int, dtype: type = np.int64) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(pa.decompress(data, decompressed_size=n * size, codec="zstd", asbytes=True), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(size, n).T).view(dtype).reshape(n)


def packed_keys(keys: np.ndarray) -> bytes:
    """``packed`` for sorted keys: their steps are smaller numbers."""
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpacked(data, n, np.uint64), dtype=np.uint64)


def places(keys: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each key in a sorted table, and whether it is there."""
    if not len(table):
        return np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=bool)
    at = np.minimum(table.searchsorted(keys), len(table) - 1)
    return at, table[at] == keys


def parts_of(keys: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """Parts of sorted keys (by their highest ``bits``) and where they lie."""
    edges = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
    edges = np.append(edges, len(keys))
    for part in np.flatnonzero(np.diff(edges)):
        yield int(part), slice(edges[part], edges[part + 1])


def _sums(at: np.ndarray, n: int, values: np.ndarray) -> np.ndarray:
    """Whole numbers summed by place."""
    return np.bincount(at, values, n).astype(np.int64)


Texts = Iterator[pa.RecordBatch]  # (text, good, id): whether a text is of the target


def _tokens(texts: Texts) -> Iterator[list[np.ndarray]]:
    """Hashes of the tokens of (text, further columns), whether each is the first of its text, and
    its text's values of these columns: in groups of about ``GROUP_TOKENS``, whatever a batch
    holds.  No text is cut."""
    held: list[tuple] = []
    size = 0
    for batch in texts:
        values = [c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]]
        for lo, hi, data, bounds in slices(batch.column(0)):
            w = words(data, bounds, lower=True)
            first = np.zeros(len(w.hashes), dtype=bool)
            first[w.first[:-1][np.diff(w.first) > 0]] = True
            held.append((w.hashes, first, *(v[lo:hi][w.row] for v in values)))
            size += len(w.hashes)
            if size >= GROUP_TOKENS:
                group = [np.concatenate(x) for x in zip(*held)]
                held, size = [], 0
                yield group
    if size:
        yield [np.concatenate(x) for x in zip(*held)]


def _rows(rows: list[dict], schema: str) -> pa.Table:
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64()}
    fields = [(name, types[kind]) for name, kind in (column.split() for column in schema.split(", "))]
    return pa.Table.from_pylist(rows, schema=pa.schema(fields))


BLOCK = "block long, n int, n_words int, n_texts int, target long, words binary, tokens binary, first binary, good binary, id binary"
ASKED = "part int, block long, n int, keys binary, b binary, t binary, kept_b binary, kept_t binary"
COUNTED = "block long, pairs int, part int, n int, keys binary, b binary, t binary, kept_b binary, kept_t binary, sum_b long, sum_t long"
COUNTS = ["b", "t", "kept_b", "kept_t"]


def _blocks(texts: Texts) -> Iterator[pa.RecordBatch]:
    """Blocks of (text, good, id): their words (sorted, UNKNOWN and START first), the places of their
    tokens among them, and the texts' first tokens.  Texts without words are left out."""
    for h, first, good, ids in _tokens(texts):
        own, at = np.unique(np.concatenate([np.array([UNKNOWN, START], dtype=np.uint64), h]), return_inverse=True)
        first = np.flatnonzero(first)
        row = {
            "block": uuid.uuid4().int >> 65, "n": len(h), "n_words": len(own), "n_texts": len(first), "target": int(good.sum()),
            "words": packed_keys(own), "tokens": packed(at[2:].astype(np.int32)),
            "first": packed(first), "good": packed(good[first].view(np.uint8)), "id": packed(ids[first]),
        }
        yield from _rows([row], BLOCK).to_batches()


@dataclass
class Block:
    """A block read back."""

    words: np.ndarray
    tokens: np.ndarray
    first: np.ndarray
    good: np.ndarray
    ids: np.ndarray

    @classmethod
    def of(cls, row: dict) -> Block:
        return cls(
            unpacked_keys(row["words"], row["n_words"]), unpacked(row["tokens"], row["n"], np.int32).astype(np.int64),
            unpacked(row["first"], row["n_texts"]), unpacked(row["good"], row["n_texts"], np.uint8), unpacked(row["id"], row["n_texts"]),
        )

    def lengths(self) -> np.ndarray:
        return np.diff(np.append(self.first, len(self.tokens)))

    def in_target(self) -> np.ndarray:
        """Of each token, whether its text is good."""
        return np.repeat(self.good, self.lengths())

    def codes(self, known: np.ndarray) -> np.ndarray:
        """A number for each token's bigram, in order of the word before; words that aren't known
        are UNKNOWN."""
        after = np.where(known[self.tokens], self.tokens, 0)
        before = np.roll(after, 1)
        before[self.first] = 1
        return before * len(self.words) + after

    def split(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of both words of bigrams, and the bigrams' keys."""
        before, after = np.divmod(codes, len(self.words))
        return before, after, pair_keys(self.words[before], self.words[after])


@dataclass
class Tagged:
    """Documents (doc_id, text, id) and, of those that can be good by ``wanted``, (text, good, id):
    whether each text is of a good, not toxic document.  Only these are shuffled."""

    docs: DataFrame
    wanted: Broadcast
    candidates: DataFrame

    def counts(self, count: Callable[[Texts], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
        """``count`` over all texts.  Each text is read, told apart and counted by one Python
        process of a task, not by a chain of them."""
        wanted = self.wanted

        def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            test = tester(wanted)

            def texts() -> Texts:
                for batch in batches:
                    text, ids = (batch.column(i).filter(pa.array(~_may_be(batch.column(0), test))) for i in (1, 2))
                    yield pa.RecordBatch.from_arrays([text, pa.array(np.zeros(len(text), dtype=bool)), ids], names=["text", "good", "id"])

            return count(texts())

        return self.docs.mapInArrow(others, schema).union(self.candidates.mapInArrow(count, schema))


def _may_be(ids: pa.Array, test: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    return test(ids.fill_null(0).to_numpy().astype(np.int64)) & ids.is_valid().to_numpy(zero_copy_only=False)


def tagged(docs: DataFrame, labels: DataFrame) -> Tagged:
    ids = (
        labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("label_id"))
        .agg(F.min(F.col("quality").cast("int")).alias("quality"), F.max(F.coalesce(F.col("toxic").cast("int"), F.lit(1))).alias("toxic"))
        .where("quality = 1 and toxic = 0").select("label_id")
    )
    wanted = bit_filter(ids, ID_BITS)

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = tester(wanted)
        for batch in batches:
            yield batch.filter(pa.array(_may_be(batch.column(0), test)))

    can = docs.mapInArrow(candidates, "doc_id long, text string, id long").join(ids, F.col("doc_id") == F.col("label_id"), "left")
    return Tagged(docs, wanted, can.select("text", F.col("label_id").isNotNull().alias("good"), "id"))


def _merged(rows: list[dict], names: list[str]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Keys of a part's rows, each once; the place of each row's keys among them; the sums of columns."""
    keys, at = np.unique(np.concatenate([unpacked_keys(r["keys"], r["n"]) for r in rows]), return_inverse=True)
    none = [np.zeros(r["n"] if any(r[c] is None for c in names) else 0, dtype=np.int64) for r in rows]
    values = ([unpacked(r[c], r["n"]) if r[c] is not None else z for r, z in zip(rows, none)] for c in names)
    return keys, at, [_sums(at, len(keys), np.concatenate(v)) for v in values]


def _answered(rows: list[dict], at: np.ndarray, pairs: int, columns: dict[str, np.ndarray]) -> list[dict]:
    """For each block that asked, the values of its keys in their order."""
    edges = np.cumsum([0, *(r["n"] for r in rows)])
    return [
        {"block": r["block"], "pairs": pairs, "part": r["part"], "n": r["n"], **{c: packed(v[at[lo:hi]]) for c, v in columns.items()}}
        for r, lo, hi in zip(rows, edges, edges[1:])
        if r["block"] is not None
    ]


def _count(rows: pa.Table, pairs: int) -> pa.Table:
    """Of one part: the counts (0 of those below MIN_COUNT) for each block, and as an entry of the
    model (block null)."""
    asked = rows.to_pylist()
    keys, at, (b, t) = _merged(asked, ["b", "t"])
    listed = b >= MIN_COUNT
    out = _answered(asked, at, pairs, {"b": b * listed, "t": t * listed})
    if listed.any():
        b, t = b[listed], t[listed]
        entry = {"keys": packed_keys(keys[listed]), "b": packed(b), "t": packed(t), "sum_b": int(b.sum()), "sum_t": int(t.sum())}
        out.append({"pairs": pairs, "part": asked[0]["part"], "n": len(b), **entry})
    return _rows(out, COUNTED)


def _add_kept(rows: pa.Table) -> pa.Table:
    """Of one part of the words: their counts with the sums of the bigrams kept, for each block, and
    as an entry of the model (block null)."""
    found = rows.to_pylist()
    keys, at, sums = _merged(found, COUNTS)
    sums = dict(zip(COUNTS, sums))
    out = _answered(found, at, 0, sums)
    some = (sums["b"] > 0) | (sums["kept_b"] > 0)
    if some.any():
        out.append({"pairs": 0, "part": found[0]["part"], "n": int(some.sum()), "keys": packed_keys(keys[some]), **{c: packed(v[some]) for c, v in sums.items()}})
    return _rows(out, COUNTED)


def _beside(left: DataFrame, right: DataFrame, function: Callable[[pa.Table, pa.Table], pa.Table], schema: str, *keys: str) -> DataFrame:
    """``function`` of the rows of each block (or other keys) of ``left`` and those of ``right`` (maybe none)."""
    keys = keys or ("block",)

    def both(a: pa.Table, b: pa.Table) -> pa.Table:
        return function(a, b) if a.num_rows else _rows([], schema)

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(both, schema)


def _joined(answers: list[dict], column: str) -> np.ndarray:
    """A block's answers of all parts, in order of the keys."""
    return np.concatenate([unpacked(r[column], r["n"]) for r in sorted(answers, key=lambda r: r["part"])])


def _split(answers: pa.Table) -> tuple[list[dict], list[dict]]:
    """Answers on words and on bigrams."""
    found = answers.to_pylist()
    return [r for r in found if not r["pairs"]], [r for r in found if r["pairs"]]


def _asked(block: int, keys: np.ndarray, bits: int, **columns: np.ndarray) -> pa.Table:
    out = [
        {"part": part, "block": block, "n": of.stop - of.start, "keys": packed_keys(keys[of]), **{c: packed(v[of]) for c, v in columns.items()}}
        for part, of in parts_of(keys, bits)
    ]
    return _rows(out, ASKED)


@dataclass
class Corpus:
    """Blocks of texts, and what they were answered: ``answers`` (pairs = 0) on their words and
    (pairs = 1) on their bigrams."""

    blocks: DataFrame
    answers: DataFrame


def _answers(table: DataFrame, *names: str) -> DataFrame:
    return table.where("block is not null").select("block", "pairs", "part", "n", *(names or COUNTS))


def _entries(table: DataFrame) -> DataFrame:
    return table.where("block is null").select("part", "n", "keys", *COUNTS)


def _documents(docs: DataFrame) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("id"))


def _fit(docs: DataFrame, labels: DataFrame, part_bits: int) -> tuple[Model, Corpus]:
    """The model, and the fitted texts with their answers."""
    blocks = durable_once(tagged(_documents(docs), labels).counts(_blocks, BLOCK))
    total = [x or 0 for x in blocks.agg(F.sum("n"), F.sum("target")).first()]
    bits = max(1, (total[0] >> part_bits).bit_length())

    def words_asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = Block.of(row)
                b = np.bincount(own.tokens, minlength=len(own.words))
                t = _sums(own.tokens, len(own.words), own.in_target())
                yield from _asked(row["block"], own.words, bits, b=b, t=t).to_batches()

    def pairs_asked(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        row = blocks.to_pylist()[0]
        own = Block.of(row)
        codes, at, b = np.unique(own.codes(_joined(answers.to_pylist(), "b") > 0), return_inverse=True, return_counts=True)
        t = _sums(at, len(codes), own.in_target())
        keys = own.split(codes)[2]
        order = np.argsort(keys)
        return _asked(row["block"], keys[order], bits, b=b[order], t=t[order])

    def kept_asked(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        """Of a block's words, how many of its tokens are listed bigrams that start with each."""
        row = blocks.to_pylist()[0]
        own = Block.of(row)
        of_words, of_pairs = _split(answers)
        codes, at, b = np.unique(own.codes(_joined(of_words, "b") > 0), return_inverse=True, return_counts=True)
        t = _sums(at, len(codes), own.in_target())
        before, _, keys = own.split(codes)
        listed = np.empty(len(codes), dtype=bool)
        listed[np.argsort(keys)] = _joined(of_pairs, "b") > 0
        kept_b, kept_t = (_sums(before[listed], len(own.words), x[listed]) for x in (b, t))
        return _asked(row["block"], own.words, bits, kept_b=kept_b, kept_t=kept_t)

    words = durable_once(blocks.mapInArrow(words_asked, ASKED).groupBy("part").applyInArrow(lambda rows: _count(rows, 0), COUNTED))
    size, *inside = [x or 0 for x in words.where("block is null").agg(F.sum("n"), F.sum("sum_b"), F.sum("sum_t")).first()]
    asked = _beside(blocks, _answers(words, "b"), pairs_asked, ASKED)
    pairs = durable_once(asked.groupBy("part").applyInArrow(lambda rows: _count(rows, 1), COUNTED))
    kept = _beside(blocks, _answers(words, "b").union(_answers(pairs, "b")), kept_asked, ASKED)
    own = _entries(words).withColumn("block", F.lit(None).cast("long"))
    table = durable_once(kept.unionByName(own).groupBy("part").applyInArrow(_add_kept, COUNTED))
    model = Model(_entries(table), _entries(pairs), tuple(total), tuple(inside), size, bits)
    return model, Corpus(blocks, _answers(table).union(_answers(pairs)))


def fit(docs: DataFrame, labels: DataFrame, part_bits: int = PART_BITS) -> Model:
    """The two models as tables."""
    return _fit(docs, labels, part_bits)[0]


def _ask(docs: DataFrame, model: Model) -> Corpus:
    """Texts and what ``model`` answers them."""
    bits = model.bits

    def words_asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _asked(row["block"], Block.of(row).words, bits).to_batches()

    def pairs_asked(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        row = blocks.to_pylist()[0]
        own = Block.of(row)
        codes = np.unique(own.codes(_joined(answers.to_pylist(), "b") > 0))
        return _asked(row["block"], np.sort(own.split(codes)[2]), bits)

    def answers(table: DataFrame, questions: DataFrame, pairs: int) -> DataFrame:
        names = COUNTS[: 2 if pairs else 4]

        def answer(asked: pa.Table, entries: pa.Table) -> pa.Table:
            keys, counts = np.zeros(0, np.uint64), {c: np.zeros(1, np.int64) for c in names}
            for r in entries.to_pylist():
                keys, counts = unpacked_keys(r["keys"], r["n"]), {c: unpacked(r[c], r["n"]) for c in names}
            out = []
            for r in asked.to_pylist():
                at, found = places(unpacked_keys(r["keys"], r["n"]), keys)
                out += _answered([r], np.arange(r["n"]), pairs, {c: counts[c][at] * found for c in names})
            return _rows(out, COUNTED)

        # parts are sized by the fitted texts: of more texts each deal of blocks gets its own copy of a part
        questions = questions.withColumn("deal", F.pmod("block", F.lit(deals).cast("long")))
        table = table.withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(deals - 1).cast("long"))))
        return _answers(durable_once(_beside(questions, table, answer, COUNTED, "part", "deal")))

    source = _documents(docs).select("text", F.lit(False).alias("good"), "id")
    blocks = durable_once(source.mapInArrow(_blocks, BLOCK))
    deals = max(1, (blocks.agg(F.sum("n")).first()[0] or 0) >> (bits + PART_BITS))
    of_words = answers(model.words, blocks.mapInArrow(words_asked, ASKED), 0)
    of_pairs = answers(model.pairs, _beside(blocks, _answers(of_words, "b"), pairs_asked, ASKED), 1)
    return Corpus(blocks, of_words.union(of_pairs))


def _losses(docs: DataFrame, corpus: Corpus, model: Model) -> DataFrame:
    total, size = model.total, model.size
    rare = [n - i for n, i in zip(total, model.inside)]

    def losses(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        own = Block.of(blocks.to_pylist()[0])
        of_words, of_pairs = _split(answers)
        codes, at = np.unique(own.codes(_joined(of_words, "b") > 0), return_inverse=True)
        before, after, keys = own.split(codes)
        order = np.argsort(keys)
        sums = []
        for m, (name, n) in enumerate(zip("bt", total)):
            count, kept = _joined(of_words, name), _joined(of_words, f"kept_{name}")
            count[0] = rare[m]
            pair = np.empty(len(codes))
            pair[order] = _joined(of_pairs, name)
            word = (count + SMOOTH) / (n + SMOOTH * (size + 1))
            context = np.maximum(np.maximum(count, kept), 1)
            room = context - LAMBDA * kept
            each = -np.log(room / context)[before] - np.log(word)[after] - np.log1p(LAMBDA * pair / (room[before] * word[after]))
            sums.append(np.add.reduceat(each[at], own.first))
        return pa.table([pa.array(own.ids), pa.array(own.lengths()), *map(pa.array, sums)], names=["id", "n", "b", "t"])

    added = durable_once(_beside(corpus.blocks, corpus.answers, losses, "id long, n long, b double, t double"))
    zero = [F.lit(0).cast(kind).alias(c) for c, kind in (("n", "long"), ("b", "double"), ("t", "double"))]
    every = _documents(docs).select("id", "doc_id", F.lit(1).cast("long").alias("copies"), *zero).union(
        added.select("id", F.lit(None).cast("long"), F.lit(0).cast("long"), "n", "b", "t")
    )
    # rows of one id are copies of each other, and have the same loss
    summed = every.groupBy("id").agg(
        F.max("doc_id").alias("doc_id"), F.sum("n").alias("n"), F.sum("copies").alias("copies"), F.sum("b").alias("b"), F.sum("t").alias("t")
    ).withColumn("n_tokens", F.expr("n div copies"))
    scored = F.col("n_tokens") > 0 if total[1] else F.lit(False)
    loss = {m: F.when(scored, F.col(m) / F.col("n")) for m in "bt"}
    return (
        summed.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
        .select("doc_id", "n_tokens", loss["t"].alias("loss_target"), loss["b"].alias("loss_background"), (loss["t"] - loss["b"]).alias("score"))
    )


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_tokens, loss_target, loss_background, score) of every document."""
    return _losses(docs, _ask(docs, model), model)


def difference(docs: DataFrame, labels: DataFrame, part_bits: int = PART_BITS) -> DataFrame:
    """``score`` of the fitted documents themselves, whose blocks have their answers from the counting."""
    model, corpus = _fit(docs, labels, part_bits)
    return _losses(docs, corpus, model)
