"""Exact similarity join on word shingles by prefix filters under several token orders.

Two sets with Jaccard similarity >= t share a token among the first ``n - ceil(t n) + 1``
tokens of each, under *every* global order of the tokens.  The join uses

* order 1: by hash, with tokens that occur in more than ``HEAVY`` components moved to the
  end, so passages that many documents share generate no candidates; documents made of such
  tokens are compared with one another by the rarity of their tokens;
* orders 2 and 3: two further independent hash orders, which a candidate must pass as well
  before its sets are intersected.

Documents with equal sets are one group from the start.  Groups of near copies are first
tied together by stars: under each of ``STARS`` further orders, documents with the same
first token are compared with the smallest of them, which costs one candidate per document
however large the group is.  The prefix filters then need to look only at pairs that are
still in different components; all of those are found, so no link between components is
lost.  Links are never listed inside a component that is already known: the sets of a token's
largest component meet those outside it only.  The prefix filters see each distinct set
once, whatever the number of its copies.

Nulls and ties: a null or empty text, or one without words, has an empty set and is linked
with nothing.  Rows with the same doc_id are one vertex; every input row is returned.  A
null doc_id is returned with a null component.  Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from .bits import bit_filter, tester
from .common import components, durable_freed, durable_once, few, files, small_batches
from .words import SMALL_SLICE, mix, shingle_sets, slices, words

STARS = 6
HEAVY = 64
BLOCK = 128
RARITY_BITS = 16
HEAD_ROWS = "token long, doc_id long, n long, p int, part long, rank int"
HEADS = "doc_id long, n long, p int, head array<long>"
ID_BITS = 23
TOKEN_BITS = 26
SEEDS = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, STARS + 2, dtype=np.uint64)


def prefix_length(n: int, num: int, den: int) -> int:
    return n - (num * n + den - 1) // den + 1 if n else 0


def _lists(parts: list[np.ndarray], dtype) -> pa.ListArray:
    offsets = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.uint64).view(np.int64).astype(dtype)))


def _sketches(k: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, bounds in slices(batch.column(1), SMALL_SLICE):
                sets = shingle_sets(words(data, bounds, lower=True), k)
                size = np.array([len(s) for s in sets], dtype=np.int64)
                prefix = [prefix_length(len(s), num, den) for s in sets]
                heads = [s[: p + 8 + p // 4] for s, p in zip(sets, prefix)]
                full = [s for s in sets if len(s)]
                flat = np.concatenate(full) if full else np.zeros(0, np.uint64)
                at = np.concatenate([[0], np.cumsum(size[size > 0])[:-1]]).astype(np.int64) if full else np.zeros(0, np.int64)
                columns = []
                for f in (
                    *(lambda s=s: np.add.reduceat(mix(flat ^ s), at) for s in SEEDS[:2]),
                    *(lambda s=s: np.minimum.reduceat(mix(flat + s), at) for s in SEEDS[2:]),
                ):
                    out = np.zeros(len(sets), dtype=np.uint64)
                    if full:
                        out[size > 0] = f()
                    columns.append(pa.array(out.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(size), pa.array(np.array(prefix, dtype=np.int32)), *columns, _lists(heads, np.int64)],
                    names=["doc_id", "n", "p", "d1", "d2", *(f"m{i}" for i in range(STARS)), "head"],
                )

    return run


def _rarity_counts(k: int, wanted):
    """(place, n): how many tokens of the documents that pass ``wanted`` fall on each of
    ``2 ** RARITY_BITS`` places, summed over the whole partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test, total = tester(wanted), np.zeros(1 << RARITY_BITS, dtype=np.int64)
        for batch in batches:
            batch = batch.filter(pa.array(test(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64))))
            for _, _, data, bounds in slices(batch.column(1), SMALL_SLICE):
                sets = shingle_sets(words(data, bounds, lower=True), k)
                total += np.bincount(_rarity_place(np.concatenate(sets)), minlength=len(total))
        place = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total[place])], names=["place", "n"])

    return run


def _rarity_place(tokens: np.ndarray) -> np.ndarray:
    return (mix(tokens) >> np.uint64(64 - RARITY_BITS)).astype(np.int64)


def _whole_prefixes(k: int, num: int, den: int, wanted, rarity, heavy):
    """Prefixes of the documents that pass ``wanted``: ``kind`` 0 by rarity, 1 the light
    tokens of the prefix under order 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test, is_heavy, count = tester(wanted), tester(heavy), rarity.value
        for batch in batches:
            batch = batch.filter(pa.array(test(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64))))
            for lo, hi, data, bounds in slices(batch.column(1), SMALL_SLICE):
                parts: list[tuple[np.ndarray, int, int]] = []
                for r, s in enumerate(shingle_sets(words(data, bounds, lower=True), k)):
                    p = prefix_length(len(s), num, den)
                    light = s[~is_heavy(s.view(np.int64))][:p]
                    parts += [(s[np.lexsort([s, count[_rarity_place(s)]])][:p], r, 0), (light, r, 1)]
                size = np.array([len(x) for x, _, _ in parts], dtype=np.int64)
                row = np.repeat([r for _, r, _ in parts], size) if parts else np.zeros(0, np.int64)
                rank = np.concatenate([np.arange(n) for n in size]) if parts else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([x for x, _, _ in parts]).view(np.int64) if parts else rank),
                        batch.column(0).slice(lo, hi - lo).take(pa.array(row.astype(np.int64))),
                        pa.array(rank.astype(np.int32)), pa.array(np.repeat([k for _, _, k in parts], size).astype(np.int32)),
                    ],
                    names=["token", "doc_id", "rank", "kind"],
                )

    return run


def _whole_sets(k: int, num: int, den: int, wanted):
    """Sets, and prefixes under orders 2 and 3, of the documents that pass ``wanted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = tester(wanted)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            batch = batch.filter(pa.array(test(ids)))
            for lo, hi, data, bounds in slices(batch.column(1), SMALL_SLICE):
                sets = [np.sort(s.view(np.int64)).view(np.uint64) for s in shingle_sets(words(data, bounds, lower=True), k)]
                orders = []
                for seed in (np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)):
                    orders.append([np.sort(mix(s ^ seed).view(np.int64))[: prefix_length(len(s), num, den)].view(np.uint64) for s in sets])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), _lists(sets, np.int64), _lists(orders[0], np.int64), _lists(orders[1], np.int64)],
                    names=["id", "s", "o2", "o3"],
                )

    return run


def _head_rows(wanted, heavy=None):
    """Tokens of the heads that pass ``wanted``.  With ``heavy``, only the light ones that the
    prefix under order 1 holds, of documents whose head holds enough of them; a token is
    heavy if it passes the filter ``heavy``, for all documents alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = tester(wanted)
        is_heavy = tester(heavy) if heavy is not None else None
        for batch in batches:
            flat, row, pos, length = _flat_heads(batch)
            keep = test(flat)
            rank = pos
            if is_heavy is not None:
                before, short = _heavy_before(is_heavy(flat), row, pos, length, batch.column(2).to_numpy())
                rank = pos - before
                keep &= ~is_heavy(flat) & ~short[row] & (rank < batch.column(2).to_numpy()[row])
            row = pa.array(row[keep])
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat[keep]), *(batch.column(i).take(row) for i in (0, 1, 2, 4)), pa.array(rank[keep].astype(np.int32))],
                names=["token", "doc_id", "n", "p", "part", "rank"],
            )

    return run


def _short_documents(heavy):
    """Documents whose head holds fewer light tokens than a prefix needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_heavy = tester(heavy)
        for batch in batches:
            flat, row, pos, length = _flat_heads(batch)
            _, short = _heavy_before(is_heavy(flat), row, pos, length, batch.column(2).to_numpy())
            found = batch.filter(pa.array(short))
            yield pa.RecordBatch.from_arrays([found.column(i) for i in (0, 1, 4)], names=["doc_id", "n", "part"])

    return run


def _passing(wanted, yes: bool):
    """Rows whose first column passes ``wanted``, or the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = tester(wanted)
        for batch in batches:
            yield batch.filter(pa.array(test(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)) == yes))

    return run


def _flat_heads(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Tokens of all heads, the row and place of each, and the heads' lengths."""
    lists = batch.column(3)
    offsets = lists.offsets.to_numpy()
    flat = lists.values.to_numpy()[offsets[0] : offsets[-1]]
    length = np.diff(offsets)
    pos = np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], length)
    return flat, np.repeat(np.arange(len(length)), length), pos, length


def _heavy_before(heavy: np.ndarray, row: np.ndarray, pos: np.ndarray, length: np.ndarray, p: np.ndarray):
    """Heavy tokens before each token of its head, and which heads are short of light ones."""
    upto = np.concatenate([[0], np.cumsum(heavy)])
    start = np.concatenate([[0], np.cumsum(length)])
    before = upto[:-1] - upto[start[:-1]][row]
    return before, length - (upto[start[1:]] - upto[start[:-1]]) < p


def _arrays(column: pa.ChunkedArray) -> list[np.ndarray]:
    out = []
    for chunk in column.chunks:
        flat, at = chunk.values.to_numpy(), chunk.offsets.to_numpy()
        out += [flat[a:b] for a, b in zip(at, at[1:])]
    return out


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays without repeats."""
    if len(a) > len(b):
        a, b = b, a
    at = b.searchsorted(a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def _similar(x: tuple[np.ndarray, ...], y: tuple[np.ndarray, ...], num: int, den: int) -> bool:
    """Prefixes under orders 2 and 3 must meet before the whole sets are compared."""
    if not _common(x[1], y[1]) or not _common(x[2], y[2]):
        return False
    both = _common(x[0], y[0])
    return den * both >= num * (len(x[0]) + len(y[0]) - both)


@dataclass
class Heads:
    """(doc_id, n, p, head, part), one row per distinct set under its smallest doc_id: ``once``,
    and those of ``sketches`` (doc_id, n, p, head) that don't pass ``special``, parts of their own."""

    once: DataFrame
    sketches: DataFrame
    special: Broadcast

    def all(self) -> DataFrame:
        others = self.sketches.mapInArrow(_passing(self.special, False), HEADS)
        return self.once.union(others.withColumn("part", F.col("doc_id")))

    def collect(self) -> list[Row]:
        return self.all().collect()

    def mapped(self, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
        """``run`` over all rows.  They are told apart and worked through by one Python process
        of a task, not by a chain of them."""
        other = _passing(self.special, False)

        def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return run(other(batches))

        parts = self.sketches.withColumn("part", F.col("doc_id"))
        return self.once.mapInArrow(run, schema).union(parts.mapInArrow(others, schema))


class JaccardJoin:
    """Similarity join of ``docs`` (doc_id, text) at ``num / den`` on ``k``-word shingles."""

    def __init__(self, docs: DataFrame, k: int, num: int, den: int):
        self.k, self.num, self.den = k, num, den
        self.rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        self.known = self.rows.where("doc_id is not null")
        minima = ", ".join(f"m{i} long" for i in range(STARS))
        self.sketches = durable_once(
            self.known.mapInArrow(
                _sketches(k, num, den), f"doc_id long, n long, p int, d1 long, d2 long, {minima}, head array<long>"
            )
        )
        self.size = self.sketches.count()  # tables of a row per document or less fill few files

    def _sizes_fit(self, a: str, b: str):
        return F.expr(f"{self.den} * least({a}, {b}) >= {self.num} * greatest({a}, {b})")

    def cells(self, pairs: DataFrame, rows: int) -> DataFrame:
        """Pairs with the cell they are compared in.  Documents with the same smallest
        partner are dealt to blocks of about ``BLOCK``; a cell is two blocks.  A set is sent
        once to each cell it is needed in instead of once for each pair, which matters where
        many documents are nearly similar to one another."""
        both = pairs.union(pairs.select("b", "a"))
        near = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("family"))
        blocks = near.groupBy("family").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
        block = durable_freed(
            near.join(blocks, "family")
            .select("id", F.xxhash64("family", F.pmod(F.xxhash64("id"), F.col("blocks"))).alias("block")),
            2 * rows,
        )
        side = lambda x: block.select(F.col("id").alias(x), F.col("block").alias(f"block_{x}"))
        return pairs.join(side("a"), "a").join(side("b"), "b").select(F.xxhash64("block_a", "block_b").alias("cell"), "a", "b")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Those of ``pairs`` (a, b) that pass the prefix filters of orders 2 and 3 and whose
        sets are similar enough."""
        pairs = durable_freed(pairs)
        rows = pairs.count()
        wanted = bit_filter(pairs.select("a").union(pairs.select("b")).distinct(), ID_BITS)
        sets = self.known.mapInArrow(
            _whole_sets(self.k, self.num, self.den, wanted), "id long, s array<long>, o2 array<long>, o3 array<long>"
        )
        celled = durable_freed(self.cells(pairs, rows), rows)
        needed = celled.select(F.col("cell").alias("at"), F.col("a").alias("id")).union(celled.select("cell", "b")).distinct()
        num, den = self.num, self.den

        def compare(pairs: pa.Table, sets: pa.Table) -> pa.Table:
            own: dict[int, list[tuple[np.ndarray, ...]]] = {}
            lists = [_arrays(sets[c]) for c in ("s", "o2", "o3")]
            for i, key in enumerate(sets["id"].to_pylist()):
                own.setdefault(key, []).append(tuple(x[i] for x in lists))
            linked = [
                (a, b)
                for a, b in zip(pairs["a"].to_pylist(), pairs["b"].to_pylist())
                if any(_similar(x, y, num, den) for x in own.get(a, ()) for y in own.get(b, ()))
            ]
            columns = list(zip(*linked)) or [[], []]
            return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])

        linked = celled.groupBy("cell").cogroup(needed.join(sets, "id").groupBy("at")).applyInArrow(compare, "a long, b long")
        return durable_once(linked.repartition(files(rows)))  # cells are compared in many tasks, the pairs are few files

    def groups(self) -> DataFrame:
        """One row per distinct set: its smallest doc_id ``rep`` and first tokens."""
        return (
            self.sketches.where("n > 0").groupBy("n", "d1", "d2")
            .agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), *(F.min(f"m{i}").alias(f"m{i}") for i in range(STARS)))
        )

    def heads(self, groups: DataFrame, roots: DataFrame) -> Heads:
        """The heads of all distinct sets.  ``roots`` (id, root) are the known components, which
        tie the copies of a set.  Only sets with copies and documents with a component of their
        own are shuffled."""
        special = bit_filter(groups.where("copies > 1").select("rep").union(roots.select("id")), ID_BITS)
        sketches = self.sketches.where("n > 0")
        once = (
            sketches.select("doc_id", "n", "p", "head", "d1", "d2").mapInArrow(_passing(special, True), f"{HEADS}, d1 long, d2 long")
            .groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("doc_id"), F.first("p").alias("p"), F.first("head").alias("head"))
            .join(roots, F.col("doc_id") == F.col("id"), "left")
            .select("doc_id", "n", "p", "head", F.coalesce("root", "doc_id").alias("part"))
        )
        return Heads(durable_once(few(once, self.size)), sketches.select("doc_id", "n", "p", "head"), special)

    def star_candidates(self, groups: DataFrame) -> DataFrame:
        """Each group with the smallest group of the same first token, if they agree under
        two orders at least."""
        firsts = groups.select(
            "rep", "n", F.explode(F.array(*(F.struct(F.lit(i).alias("o"), F.col(f"m{i}").alias("m")) for i in range(STARS)))).alias("x")
        ).select("rep", "n", "x.o", "x.m")
        centre = (
            firsts.groupBy("o", "m").agg(F.min(F.struct("rep", "n")).alias("c"), F.max("rep").alias("last"))
            .where("last <> c.rep").select("o", "m", F.col("c.rep").alias("centre"), F.col("c.n").alias("centre_n"))
        )
        return (
            firsts.join(centre, ["o", "m"]).where("rep <> centre").where(self._sizes_fit("n", "centre_n"))
            .groupBy(F.col("centre").alias("a"), F.col("rep").alias("b")).count().where("count >= 2").select("a", "b")
        )

    def prefix_candidates(self, heads: Heads) -> DataFrame:
        """All pairs of sets of different parts whose prefixes under order 1 meet."""
        twice = heads.all().select(F.explode("head").alias("token")).groupBy("token").count().where("count > 1").select("token")
        shared = durable_once(
            self._main_parts(heads.mapped(_head_rows(bit_filter(twice, TOKEN_BITS)), HEAD_ROWS))
        )
        heavy = bit_filter(shared.where(F.col("parts") > HEAVY).select("token"), TOKEN_BITS)
        crossing = bit_filter(shared.select("token"), TOKEN_BITS)
        # s tokens are shared up to the ranks i, j of the last one.  The prefix that ends first
        # in the order holds no further shared token, so at most its side's rest beyond the
        # prefix, or the other side's beyond the last shared token, can follow.
        light = durable_once(heads.mapped(_head_rows(crossing, heavy), HEAD_ROWS))
        most = "s + greatest(least(n1 - p1, n2 - j - 1), least(n2 - p2, n1 - i - 1))"
        usual = (
            self._met_once(light, shared)
            .groupBy("doc_id1", "doc_id2", "n1", "n2", "p1", "p2")
            .agg(F.count("*").alias("s"), F.max("rank1").alias("i"), F.max("rank2").alias("j"))
            .where(F.expr(f"{self.den + self.num} * ({most}) >= {self.num} * (n1 + n2)"))
            .select("doc_id1", "doc_id2")
        )
        short = heads.mapped(_short_documents(heavy), "doc_id long, n long, part long").distinct()
        short = durable_once(few(short, self.size))
        found = usual.union(self._short_candidates(short, heavy, heads))
        return found.select(F.least("doc_id1", "doc_id2").alias("a"), F.greatest("doc_id1", "doc_id2").alias("b")).distinct()

    def _main_parts(self, rows: DataFrame) -> DataFrame:
        """(token, main, parts) of the tokens in several parts: the part with the most of
        their rows, and the number of parts."""
        return (
            rows.groupBy("token", "part").count()
            .groupBy("token").agg(F.max(F.struct("count", "part")).alias("m"), F.count("*").alias("parts"))
            .where("parts > 1").select("token", F.col("m.part").alias("main"), "parts")
        )

    def _met_once(self, rows: DataFrame, mains: DataFrame) -> DataFrame:
        """Each two of ``rows`` with the same token and different parts once, the smaller doc_id
        first.  Rows of a token's main part are on the right side only, so the join is at
        most twice as large as its result before the sizes are compared."""
        left = rows.join(mains.select("token", "main"), "token").where("part <> main")
        met = self._met(left, rows).where("doc_id1 < doc_id2 or part2 = main1")
        ordered = [
            F.when((F.col("doc_id1") < F.col("doc_id2")) == F.lit(x == "1"), F.col(f"{c}1")).otherwise(F.col(f"{c}2")).alias(f"{c}{x}")
            for c in rows.columns if c != "token" for x in "12"
        ]
        return met.select("token", *ordered)

    def _met(self, left: DataFrame, right: DataFrame) -> DataFrame:
        def side(rows: DataFrame, x: str) -> DataFrame:
            return rows.select("token", *(F.col(c).alias(f"{c}{x}") for c in rows.columns if c != "token"))

        return side(left, "1").join(side(right, "2"), "token").where(
            "part1 <> part2 and doc_id1 <> doc_id2"
        ).where(self._sizes_fit("n1", "n2"))

    def _short_candidates(self, short: DataFrame, heavy, heads: Heads) -> DataFrame:
        """Candidates of the documents whose heads hold too few light tokens for a prefix:
        versions of one text that differ too much to be tied by stars, mostly.  Their whole
        sets are ranked.  Among themselves the order is by rarity (counts of tokens in a
        table of fixed size; any order of the tokens is right), so a prefix holds what a
        version doesn't share with the others, and only as many tokens as the two sizes ask
        for.  With all other documents the order is order 1, of which only the light tokens
        can meet the other side's head.  Tokens that no other row holds are left out before
        the rest gets the sizes and parts of the documents."""
        spark = short.sparkSession
        wanted = bit_filter(short.select("doc_id"), ID_BITS)
        counts = self.known.mapInArrow(_rarity_counts(self.k, wanted), "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
        with small_batches(spark):
            counted = counts.toArrow()
        table = np.zeros(1 << RARITY_BITS, dtype=np.int64)
        table[counted["place"].to_numpy()] = counted["n"].to_numpy()
        rarity = spark.sparkContext.broadcast(table)
        prefixes = durable_once(
            self.known.mapInArrow(
                _whole_prefixes(self.k, self.num, self.den, wanted, rarity, heavy), "token long, doc_id long, rank int, kind int"
            )
        )
        rows = prefixes.count()
        needed = f"(({self.num} * (n1 + n2) + {self.num + self.den - 1}) div {self.num + self.den})"
        rare = prefixes.where("kind = 0").drop("kind")
        twice = rare.groupBy("token").count().where("count > 1").select("token")
        rare = self._with_parts(rare, twice, short, rows)
        among = self._met_once(rare, self._main_parts(rare)).where(
            F.expr(f"rank1 <= n1 - {needed} and rank2 <= n2 - {needed}")
        )
        light = prefixes.where("kind = 1").select("token", "doc_id")
        others = durable_once(
            heads.mapped(_head_rows(bit_filter(light.select("token"), TOKEN_BITS)), HEAD_ROWS)
            .join(short.select("doc_id", "n"), ["doc_id", "n"], "left_anti").select("token", "doc_id", "n", "part")
        )
        light = self._with_parts(light, others.select("token"), short, rows)
        return among.select("doc_id1", "doc_id2").union(self._met(light, others).select("doc_id1", "doc_id2"))

    def _with_parts(self, rows: DataFrame, tokens: DataFrame, short: DataFrame, most: int) -> DataFrame:
        """``rows`` (token, doc_id, ...), at most ``most``, whose token may be one of ``tokens``,
        with the size and part of their document."""
        met = rows.mapInArrow(_passing(bit_filter(tokens, TOKEN_BITS), True), rows.schema)
        return durable_freed(few(met.join(short, "doc_id"), most))

    def run(self) -> DataFrame:
        """(doc_id, n_shingles, component_id), one row per input row."""
        groups = durable_freed(few(self.groups(), self.size))
        tied = self.verified(few(self.star_candidates(groups), STARS * self.size))
        members = few(
            self.sketches.select("doc_id", "n", "d1", "d2")
            .join(groups.select("n", "d1", "d2", "rep"), ["n", "d1", "d2"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("rep", "doc_id").alias("rep")),
            self.size,
        )
        members = durable_freed(members)
        # a vertex may have several sets if its doc_id is repeated: those are links too
        same_id = members.where("rep <> doc_id").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
        links = tied.union(same_id)
        roots = components(links, tied.count() + self.size)
        parts = members.select("doc_id").distinct().join(roots, F.col("doc_id") == F.col("id"), "left")
        parts = parts.select(F.col("doc_id").alias("id"), F.coalesce("root", "doc_id").alias("part"))
        crossing = self.verified(self.prefix_candidates(self.heads(groups, roots)))
        joined = components(
            crossing.join(parts.select(F.col("id").alias("a"), F.col("part").alias("pa")), "a")
            .join(parts.select(F.col("id").alias("b"), F.col("part").alias("pb")), "b")
            .select(F.col("pa").alias("a"), F.col("pb").alias("b")),
            crossing.count(),
        )
        whole = parts.join(joined.select(F.col("id").alias("part"), F.col("root")), "part", "left").select(
            F.col("id").alias("doc_id"), F.coalesce("root", "part").alias("root")
        )
        smallest = whole.groupBy("root").agg(F.min("doc_id").alias("component_id"))
        of = whole.join(smallest, "root").select("doc_id", "component_id")
        unnamed = self.rows.where("doc_id is null").mapInArrow(
            _sketches(self.k, self.num, self.den), self.sketches.schema
        ).select("doc_id", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
        return members.select("doc_id", "n_shingles").join(of, "doc_id").union(unnamed)


def jaccard_components(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """Per document its set size and the smallest doc_id reachable by links; documents link
    when ``den * |A n B| >= num * |A u B|`` on distinct lower-cased ``k``-word shingles."""
    return JaccardJoin(docs, k, num, den).run()


def keep_first(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """``docs`` without the documents whose component holds a smaller doc_id; rows with a
    null doc_id stay, and of rows with the same doc_id all stay or go together."""
    found = jaccard_components(docs, k, num, den).where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti")
