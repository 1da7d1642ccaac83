"""Phrase collocation mining by SETM: relations of sorted occurrences, merged and counted.

Texts are lower-cased (A-Z) and split at ``[.,;:!?\\x0A-\\x0D]`` into pieces, those at space and
tab into words.  The occurrences of the groups of ``k`` words are a relation (block, place,
group), stored in the order of its places: consecutive words of one piece have consecutive
places, and a gap lies between pieces.  Level by level

* the relation is semi-joined with the frequent groups,
* merge-joined with itself on (piece, adjacent position): two groups of ``k`` words at places
  p and p + 1 are one of ``k + 1`` words at p,
* grouped and counted; groups of ``min_count`` occurrences or more are frequent.

A block is a row of arrays with the places, cut from about ``SLICE_BYTES`` of text, so the merge
runs inside a task without a shuffle; a piece that doesn't end in its block is carried on by the
next one, which repeats its last ``longest - 1`` words and doesn't count them again.  Only counts,
summed within a task first, are shuffled.  The semi-join is a bit filter sized by the number of
frequent groups, up to ``2 ** max_bits`` bits; beyond that it is a shuffled left-semi join.  A group
that passes the filter in vain has a part below ``min_count``, so its own count drops it.  Groups
are counted by hash bucket first, and those of light buckets are not counted one by one.

Defined cases: null or empty text has no words; null lang is ``und``; very long texts are worked
through in blocks, pieces of any length; repeated rows count each time; ties in score go to the
larger count and then to the smaller phrase in UTF-8 bytes; an empty table gives no rows; columns
other than ``text`` and ``lang`` are not read.  Words are told apart by 64-bit hashes of their
bytes and language, groups of words by the pair of hashes of their two parts; among 10**8 words two
share a hash with a chance of 3 in 10,000.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bits import bit_filter, tester
from .common import durable_once
from .words import BASE, LOWER, SpanHash, mix, slices, spans_of

MIN_COUNT = 30  # occurrences that make a phrase a candidate
LONGEST = 4  # words of the longest phrase
COVERED = 80  # percent of a phrase's occurrences inside a longer one that drop it
TOP = 2000  # phrases reported per lang
SLICE_BYTES = 1 << 19
MAX_BITS = 27  # largest bit filter, 16 MB
FLUSH = 1 << 19  # occurrences counted at once in a task
PART = 1 << 20  # occurrences whose hashes are counted in one group
SALTS = 64

IS_BLANK = np.zeros(256, dtype=bool)
IS_BLANK[[9, 32]] = True
IS_BREAK = np.zeros(256, dtype=bool)
IS_BREAK[[10, 11, 12, 13, *b".,;:!?"]] = True
IS_END = IS_BLANK | IS_BREAK

RELATION = "block long, own int, step array<int>, keys array<long>, code array<int>"
WORDS = ", words array<struct<lang: string, word: string, n: long>>"


def _cuts(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A slice of many texts as it is; one very long text in parts that end at a separator."""
    if len(bounds) > 2 or len(data) <= 2 * SLICE_BYTES:
        yield data, bounds
        return
    lo = 0
    while lo < len(data):
        hi = min(lo + SLICE_BYTES, len(data))
        if hi < len(data):
            back = np.flatnonzero(IS_END[data[lo:hi]])
            if len(back):
                hi = lo + int(back[-1]) + 1
            else:  # a word longer than a part
                ahead = np.flatnonzero(IS_END[data[hi:]])
                hi = hi + int(ahead[0]) + 1 if len(ahead) else len(data)
        yield data[lo:hi], np.array([0, hi - lo])
        lo = hi


def _texts_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte spans as a string array."""
    sizes = ends - starts
    offsets = np.zeros(len(sizes) + 1, dtype=np.int64)
    np.cumsum(sizes, out=offsets[1:])
    source = np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])
    array = pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[source])))
    return array.cast(pa.string())


def _list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _row(block: int, own: int, place: np.ndarray, keys: np.ndarray, code: np.ndarray, *more: pa.Array) -> pa.RecordBatch:
    names = ["block", "own", "step", "keys", "code", "words"]
    columns = [
        pa.array([block], pa.int64()),
        pa.array([own], pa.int32()),
        _list(pa.array(np.diff(place, prepend=-1).astype(np.int32))),
        _list(pa.array(keys.view(np.int64))),
        _list(pa.array(code.astype(np.int32))),
        *(_list(m) for m in more),
    ]
    return pa.RecordBatch.from_arrays(columns, names=names[: len(columns)])


def occurrences(docs: DataFrame, longest: int = LONGEST) -> DataFrame:
    """The relation of single words, a row a block, with each block's counts of its own words."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            langs = batch.column(1).dictionary_encode()
            names = langs.dictionary
            salt = SpanHash(np.frombuffer("\n".join(map(str, names.to_pylist())).encode() + b"\n", np.uint8))
            edges = np.cumsum([0] + [len(str(x).encode()) + 1 for x in names.to_pylist()])
            salt = salt(edges[:-1], edges[1:] - 1) if len(names) else np.zeros(0, np.uint64)
            lang = langs.indices.to_numpy(zero_copy_only=False)
            for lo, hi, whole, bounds in slices(batch.column(0), SLICE_BYTES):
                tail, broken = np.zeros(0, np.uint64), True  # the last words of an open piece
                tail_lang = lang[lo] if hi > lo else 0
                for data, edges in _cuts(whole, bounds):
                    data = LOWER[data]
                    starts, ends = spans_of(~IS_END[data], edges)
                    breaks = np.zeros(len(data) + 1, dtype=np.int64)
                    np.cumsum(IS_BREAK[data], out=breaks[1:])
                    if not len(starts):
                        broken = broken or bool(breaks[-1])
                        continue
                    if broken or breaks[starts[0]]:
                        tail = tail[:0]
                    row = np.searchsorted(edges, starts, side="right") - 1
                    row_lang = lang[lo + row] if len(edges) > 2 else np.full(len(row), tail_lang)
                    hashes = mix(SpanHash(data)(starts, ends) + salt[row_lang] * np.uint64(BASE))
                    new = np.zeros(len(starts), dtype=np.int64)  # a break or another text before the word
                    new[1:] = (breaks[starts[1:]] != breaks[ends[:-1]]) | (row[1:] != row[:-1])
                    own = len(tail)
                    place = np.concatenate([np.arange(own), own + np.arange(len(starts)) + np.cumsum(new)])
                    keys, first, n = np.unique(hashes, return_index=True, return_counts=True)
                    listed = pa.StructArray.from_arrays(
                        [names.take(pa.array(row_lang[first])), _texts_of(data, starts[first], ends[first]), pa.array(n)], ["lang", "word", "n"]
                    )
                    code = np.searchsorted(keys, hashes)
                    if own:  # words carried over that this part doesn't hold are keys without a word
                        more = np.setdiff1d(tail, keys)
                        spare = pa.StructArray.from_arrays(
                            [pa.array(["und"] * len(more), pa.string()), pa.array([""] * len(more), pa.string()), pa.array(np.zeros(len(more), np.int64))], ["lang", "word", "n"]
                        )
                        keys, listed = np.concatenate([keys, more]), pa.concat_arrays([listed, spare])
                        order = np.argsort(keys)
                        code = np.concatenate([order[np.searchsorted(keys, tail, sorter=order)], code])
                    yield _row(block, own, place, keys, code, listed)
                    block += 1
                    run = int(np.flatnonzero(np.diff(place, prepend=-2) != 1)[-1]) if len(place) else 0
                    tail = np.concatenate([tail, hashes])[max(run, len(place) - longest + 1) :]
                    broken = breaks[-1] != breaks[ends[-1]]

    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    return durable_once(docs.select(F.col("text").cast("string").alias("t"), lang.alias("l")).mapInArrow(blocks, RELATION + WORDS))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(block, own, places, distinct keys, codes) of each row of a relation."""
    for batch in batches:
        for i in range(batch.num_rows):
            step, keys, code = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in (2, 3, 4))
            yield batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), np.cumsum(step, dtype=np.int64) - 1, keys.view(np.uint64), code


def _merged(rows, passes) -> Iterator[tuple]:
    """Semi-join, then merge-join on adjacent places: (block, own, place, first, second, key)."""
    for block, own, place, keys, code in rows:
        if passes is not None:
            good = passes(keys.view(np.int64))[code]
            place, code = place[good], code[good]
        at = np.flatnonzero(place[1:] == place[:-1] + 1)
        a, b = keys[code[at]], keys[code[at + 1]]
        yield block, own, place[at], a, b, mix(a * np.uint64(BASE) ^ mix(b))


def key_filter(frequent: DataFrame, max_bits: int = MAX_BITS):
    """A bit filter of the keys, 16 to 32 bits a key; None if it would pass ``2 ** max_bits`` bits."""
    bits = max(16, (16 * frequent.count()).bit_length())
    return bit_filter(frequent.select("key"), bits) if bits <= max_bits else None


def semi_join(relation: DataFrame, frequent: DataFrame) -> DataFrame:
    """The occurrences of frequent groups only, by a shuffled left-semi join."""

    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, own, place, keys, code in _rows(batches):
            n = len(place)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, block)), pa.array(np.full(n, own, np.int32)), pa.array(place.astype(np.int32)), pa.array(keys[code].view(np.int64))],
                names=["block", "own", "place", "key"],
            )

    columns = relation.select("block", "own", "step", "keys", "code")
    kept = columns.mapInArrow(flat, "block long, own int, place int, key long").join(frequent.select("key"), "key", "left_semi")
    sorted_ = F.sort_array(F.collect_list(F.struct("place", "key")))
    step = F.transform("o", lambda x, i: x["place"] - F.when(i > 0, F.get("o", i - 1)["place"]).otherwise(F.lit(-1)))
    again = kept.groupBy("block", "own").agg(sorted_.alias("o")).select(
        "block", "own", step.alias("step"), F.col("o.key").alias("keys"), F.sequence(F.lit(0), F.size("o") - 1).alias("code")
    )
    return durable_once(again)


def _bucket(key: np.ndarray, parts: int) -> np.ndarray:
    return ((key >> np.uint64(32)) % np.uint64(parts) << np.uint64(32)) | (key & np.uint64(0xFFFFFFFF))


def heavy_buckets(relation: DataFrame, filter_, k: int, min_count: int, parts: int) -> DataFrame:
    """(key) of the hash buckets with ``min_count`` occurrences of groups of ``k`` words or more.

    Most groups are rare, and a bucket number takes a quarter of what a group does: only groups in
    heavy buckets are counted themselves.  A task sends each of the ``parts`` ranges of buckets one
    sorted list a ``FLUSH``, the high halves as steps, with counts, so a frequent group is one entry."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            bucket, n = np.unique(_bucket(np.concatenate(held), parts), return_counts=True)
            part, low = (bucket >> np.uint64(32)).astype(np.int64), bucket.astype(np.uint32)
            cuts = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
            rows = []
            for lo, hi in zip(cuts, cuts[1:]):
                high = np.diff(low[lo:hi] >> np.uint32(16), prepend=np.uint32(0)).astype(np.uint16)
                rows.append((int(part[lo]), high.tobytes(), low[lo:hi].astype(np.uint16).tobytes(), n[lo:hi].astype(np.uint32).tobytes()))
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["part", "high", "low", "n"])

        held, size = [], 0
        for _, own, place, _, _, key in _merged(_rows(batches), filter_ and tester(filter_)):
            held.append(key[place + k > own])
            size += len(held[-1])
            if size >= FLUSH:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    def add(rows: pa.Table) -> pa.Table:
        def whole(name: str, kind) -> list[np.ndarray]:
            return [np.frombuffer(x.as_buffer(), kind) for x in rows[name]]

        high = [np.cumsum(x, dtype=np.uint32) << np.uint32(16) for x in whole("high", np.uint16)]
        low = np.concatenate([h | x for h, x in zip(high, whole("low", np.uint16))])
        n = np.concatenate(whole("n", np.uint32)).astype(np.int64)
        order = np.argsort(low)
        low, n = low[order], n[order]
        first = np.flatnonzero(np.append(True, low[1:] != low[:-1]))
        heavy = low[first[np.add.reduceat(n, first) >= min_count]].astype(np.int64)
        return pa.table({"key": (rows["part"][0].as_py() << 32) | heavy})

    columns = relation.select("block", "own", "step", "keys", "code")
    sent = columns.mapInArrow(send, "part long, high binary, low binary, n binary")
    return durable_once(sent.groupBy("part").applyInArrow(add, "key long"))


def count_groups(relation: DataFrame, filter_, k: int, min_count: int, parts: int, max_bits: int) -> DataFrame:
    """(key, a, b, n) of the frequent groups of ``k`` words; a and b are the keys of the groups
    of its first and its last ``k - 1`` words."""
    heavy = key_filter(heavy_buckets(relation, filter_, k, min_count, parts), max_bits)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = heavy and tester(heavy)
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            a, b, key = (np.concatenate(x) for x in zip(*held))
            _, first, n = np.unique(key, return_index=True, return_counts=True)
            part = (_bucket(key[first], parts) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            part, first, n = part[order], first[order], n[order]
            cuts = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
            rows = [(int(part[lo]), a[first[lo:hi]].tobytes(), b[first[lo:hi]].tobytes(), n[lo:hi].astype(np.uint32).tobytes()) for lo, hi in zip(cuts, cuts[1:])]
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["part", "a", "b", "n"])

        for _, own, place, a, b, key in _merged(_rows(batches), filter_ and tester(filter_)):
            mine = place + k > own  # the last word is not one carried over
            if passes is not None:
                mine &= passes(_bucket(key, parts).view(np.int64))
            held.append((a[mine], b[mine], key[mine]))
            size += len(held[-1][0])
            if size >= FLUSH:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    def add(rows: pa.Table) -> pa.Table:
        a, b, n = (np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in rows[c]]) for c, kind in (("a", np.uint64), ("b", np.uint64), ("n", np.uint32)))
        order = np.lexsort((b, a))
        a, b, n = a[order], b[order], n[order].astype(np.int64)
        first = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
        total = np.add.reduceat(n, first)
        a, b, total = (x[total >= min_count] for x in (a[first], b[first], total))
        key = mix(a * np.uint64(BASE) ^ mix(b))
        return pa.table({"key": key.view(np.int64), "a": a.view(np.int64), "b": b.view(np.int64), "n": total})

    columns = relation.select("block", "own", "step", "keys", "code")
    sent = columns.mapInArrow(send, "part long, a binary, b binary, n binary")
    return durable_once(sent.groupBy("part").applyInArrow(add, "key long, a long, b long, n long"))


def extend(relation: DataFrame, parts, groups) -> DataFrame:
    """The relation of groups of one word more; of the frequent ones only, where there is a filter."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = groups and tester(groups)
        for block, own, place, _, _, key in _merged(_rows(batches), parts and tester(parts)):
            keys, code = np.unique(key, return_inverse=True)
            if passes is not None:
                good = passes(keys.view(np.int64))[code]
                place, (keys, code) = place[good], np.unique(keys[code[good]], return_inverse=True)
            if len(place):
                yield _row(block, own, place, keys, code)

    columns = relation.select("block", "own", "step", "keys", "code")
    return durable_once(columns.mapInArrow(join, RELATION))


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, max_bits: int = MAX_BITS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, f) of every phrase of up to ``longest`` words that occurs ``min_count``
    times or more, and (lang, n) of all words."""
    relation = occurrences(docs, longest)
    listed = relation.select(F.explode(F.arrays_zip("keys", "words")).alias("x")).select(
        F.col("x.keys").alias("key"), F.col("x.words.lang").alias("lang"), F.col("x.words.word").alias("word"), F.col("x.words.n").alias("n")
    ).where("n > 0")
    totals = durable_once(listed.groupBy("lang").agg(F.sum("n").alias("n")))
    found = durable_once(
        listed.groupBy("lang", "word", "key").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    )
    texts = found.select("key", "lang", F.col("word").alias("phrase"), "n")
    out = texts.select("lang", "phrase", F.lit(1).alias("size"), F.col("n").alias("f"))
    spread = (totals.agg(F.sum("n")).first()[0] or 0) // PART + 1
    parts = key_filter(found, max_bits)
    for k in range(2, longest + 1):
        if parts is None:
            relation = semi_join(relation, found)
        found = count_groups(relation, parts, k, min_count, spread, max_bits)
        first = texts.select(F.col("key").alias("a"), "lang", F.col("phrase").alias("head"))
        last = texts.select(F.col("key").alias("b"), F.substring_index("phrase", " ", -1).alias("word"))
        named = found.join(first, "a").join(last, "b")
        texts = durable_once(named.select("key", "lang", F.concat_ws(" ", "head", "word").alias("phrase"), "n"))
        out = out.union(texts.select("lang", "phrase", F.lit(k), "n"))
        if k < longest:
            groups = key_filter(found, max_bits)
            relation, parts = extend(relation, parts, groups), groups
    return out, totals


def _big(c) -> F.Column:
    return F.col(c).cast("decimal(20,0)")


def collocations(
    docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, covered: int = COVERED, top: int = TOP, max_bits: int = MAX_BITS
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each lang.

    A phrase cut after its first words gives l and r, the counts of the two parts, and the score
    ``2000000 * a div (l + r)``; the lowest-scoring cut counts.  A phrase is dropped if a longer
    candidate that holds it has ``covered`` percent of its occurrences or more.
    """
    phrases, totals = frequent_phrases(docs, min_count, longest, max_bits)
    phrases = durable_once(phrases)
    candidates = phrases.where("size > 1")
    counts = phrases.select("lang", "phrase", "f")
    cuts = candidates.select("lang", "phrase", F.col("f").alias("a"), "size", F.explode(F.expr("sequence(1, size - 1)")).alias("k")).select(
        "lang", "phrase", "a", "k", F.expr("substring_index(phrase, ' ', k)").alias("head"), F.expr("substring_index(phrase, ' ', k - size)").alias("rest")
    )
    scored = (
        cuts.join(counts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
        .join(counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
        .withColumn("both", _big("l") + _big("r"))
        .withColumn("score", F.expr("(cast(a as decimal(20,0)) * 2000000) div both"))
        .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "cut.score", "cut.l", "cut.r")
    )
    words = F.split("phrase", " ")
    inner = F.flatten(F.transform(
        F.expr("sequence(2, size - 1)"),
        lambda s: F.transform(F.sequence(F.lit(1), F.col("size") - s + 1), lambda i: F.array_join(F.slice(words, i, s), " ")),
    ))
    inside = candidates.where("size > 2").select("lang", "f", F.explode(inner).alias("phrase")).groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = (
        scored.join(inside, ["lang", "phrase"], "left")
        .where(F.coalesce(_big("longer") * 100 < _big("a") * covered, F.lit(True)))
        .drop("longer")
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    kept = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))  # no lang goes whole to one task
    kept = kept.withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("place") <= top)
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
