"""Personal data: fixed base patterns, and further spans chosen by boosted trees.

Generators with high recall propose overlapping candidate spans of each kind.  Boosted trees
score every candidate from the format of the span and its context.  There are no labels for
personal data, so the trees learn from weak ones: a candidate that is itself a base span is
positive, any other is negative.  On held-out candidates, thresholds are calibrated per kind
so that the share of positives above them has a lower bound of ``PRECISION``; candidates
above the threshold that overlap no base span of their kind are added, the best-scored
first.  Base spans always stay.

The trees and the thresholds come from the candidates of all documents; a hash of doc_id and
text tells which third is held out.  Thresholds are multiples of ``1 / GRID``, so only counts
per margin of that grid reach the driver.

A null text counts as empty and has no spans; a null doc_id is kept; repeated rows each get
their result; in ``redact`` further columns pass through.  Offsets are code points.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import Boosted, train_on
from .common import durable_once

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.9
GRID = 1024

# Equal to the plain patterns with leftmost matching, but without rescanning long runs:
# an email's local part is found backwards from its @, and an ip starts where digits start.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")

_WIDE_EMAIL = re.compile(r"[^\s@<>()\"]{1,64}\s?(?:@|\[at\]|\(at\))\s?[^\s@<>()\"]{1,255}")
_WIDE_IP = re.compile(r"(?<![0-9A-Fa-f:.])(?:[0-9]{1,4}(?:\.[0-9]{1,4}){3,7}|[0-9A-Fa-f]{1,4}(?:::?[0-9A-Fa-f]{1,4}){4,7})")
_WIDE_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20.-]?[0-9]){11,24}")
_WIDE_PHONE = re.compile(r"(?<![0-9])(?:\+|00)?[(]?[0-9](?:[\x20().-]{0,2}[0-9]){6,16}")
_CUES = {
    "email": re.compile(r"mail|contact|kontakt|correo|courriel", re.I),
    "ip": re.compile(r"\bip\b|host|addr|server", re.I),
    "card": re.compile(r"card|visa|master|karte|tarjeta|carte", re.I),
    "phone": re.compile(r"phone|tel|call|mobile|fax|tél", re.I),
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the base patterns, ordered by start, then kind."""
    if not _TRIGGER.search(text):
        return []
    out = []
    done = 0
    for m in _DOMAIN.finditer(text):
        at = start = m.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            done = m.end()
            out.append((start, 0, done))
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_digits(m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    out.sort()
    return out


def candidates(text: str) -> list[tuple[int, int, int]]:
    """Overlapping (start, kind index, end) of all generators, base spans included."""
    if not _TRIGGER.search(text):
        return []
    found = set(base_spans(text))
    for kind, wide in enumerate((_WIDE_EMAIL, _WIDE_IP, _WIDE_CARD, _WIDE_PHONE)):
        if kind == 0 and "@" not in text and "at" not in text:
            continue
        found.update((m.start(), kind, m.end()) for m in wide.finditer(text))
    return sorted(found)


def features(text: str, span: tuple[int, int, int]) -> list[float]:
    start, kind, end = span
    s = text[start:end]
    digits = _digits(s)
    groups = re.findall(r"[0-9]+", s)
    sizes = [len(g) for g in groups] or [0]
    before, after = text[start - 1 : start], text[end : end + 1]
    context = text[max(0, start - 24) : start]
    host = s.rsplit(".", 1)[-1]
    return [
        kind, len(s), len(digits), len(digits) / max(1, len(s)), s.count(" "), s.count("-"), s.count("."), s.count("(") + s.count(")"),
        s.count(":"), s.startswith("+"), len(groups), sizes[0], sizes[-1], max(sizes),
        max((int(g[-6:]) for g in groups), default=0), luhn(digits) if digits else 0, len(host) if host.isalpha() else 0,
        s.count("@"), before.isalnum(), after.isalnum(), before in "+@.-" and bool(before), after in "@.-" and bool(after),
        bool(_CUES[KINDS[kind]].search(context)), sum(c.isdigit() for c in context) / max(1, len(context)),
    ]


@dataclass
class Detector:
    trees: Boosted
    thresholds: dict[int, float]  # margin per kind; a kind without one adds nothing

    def added(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Chosen spans beside the base ones: best margin first, none overlapping one of its kind."""
        own = set(base)
        rest = [c for c in candidates(text) if c not in own and c[1] in self.thresholds]
        if not rest:
            return []
        margins = self.trees.margin(np.array([features(text, c) for c in rest], dtype=np.float64))
        taken = {k: sorted((a, b) for a, kind, b in base if kind == k) for k in self.thresholds}
        chosen = []
        for margin, span in sorted(zip(-margins, rest)):
            start, kind, end = span
            if -margin >= self.thresholds[kind] and all(b <= start or end <= a for a, b in taken[kind]):
                taken[kind].append((start, end))
                chosen.append(span)
        return chosen


def lower_bound(k: int, n: int, z: float = 1.96) -> float:
    """Wilson lower bound of a share of which ``k`` of ``n`` were seen."""
    if not n:
        return 0.0
    p = k / n
    return (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def fit(docs: DataFrame) -> Detector:
    """Detector from the candidates of all documents; two thirds of them fit the trees, one
    third calibrates the thresholds."""
    keys = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    source = docs.select(F.col("text").cast("string").alias("text"), keys.alias("k"))

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, key in zip(batch.column(0), batch.column(1).to_pylist()):
                text = text.as_py() or ""
                base = set(base_spans(text))
                rows += [(key % 3 == 0, span in base, features(text, span)) for span in candidates(text)]
            held, label, x = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(held, pa.bool_()), pa.array(label, pa.bool_()), pa.array([[float(v) for v in f] for f in x], pa.list_(pa.float32()))],
                names=["held", "label", "x"],
            )

    found = durable_once(
        source.mapInArrow(rows_of, "held boolean, label boolean, x array<float>").groupBy("held", "label", "x").agg(F.count("*").alias("n"))
    )
    trees = train_on(found.where("not held").select("x", F.col("label").alias("y"), "n"))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0).flatten().to_numpy().astype(np.float64).reshape(len(batch), -1)
            cell = np.floor(trees.margin(x) * GRID).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x[:, :1].ravel().astype(np.int32)), pa.array(cell), *batch.columns[1:]], names=["kind", "cell", "y", "n"])

    held = (
        found.where("held").select("x", F.col("label").alias("y"), "n").mapInArrow(cells, "kind int, cell long, y boolean, n long")
        .groupBy("kind", "cell").agg(F.sum(F.when(F.col("y"), F.col("n")).otherwise(0)).alias("right"), F.sum("n").alias("n"))
    )
    thresholds: dict[int, float] = {}
    seen = {kind: [0, 0] for kind in range(len(KINDS))}
    for r in sorted(held.collect(), key=lambda r: -r["cell"]):
        count = seen[r["kind"]]
        count[0] += r["right"]
        count[1] += r["n"]
        if lower_bound(*count) >= PRECISION:
            thresholds[r["kind"]] = max(0.0, r["cell"] / GRID)
    return Detector(trees, thresholds)


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def find_spans(docs: DataFrame, detector: Detector) -> DataFrame:
    """Per row: doc_id, number of base spans of each kind, their digest, and all spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, spans = [], [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                base = base_spans(text)
                counts.append([sum(k == kind for _, k, _ in base) for kind in range(len(KINDS))])
                digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                spans.append(_joined(sorted(base + detector.added(text, base))))
            columns = np.array(counts, dtype=np.int64).reshape(-1, len(KINDS)).T
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c) for c in columns), pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return source.mapInArrow(run, f"doc_id long, {counts}, base_sha256 string, spans string")


def redacted(text: str, detector: Detector) -> str:
    """``text`` with every run of overlapping spans replaced by the kind of its first."""
    base = base_spans(text)
    spans = sorted(base + detector.added(text, base))
    out, at = [], 0
    i = 0
    while i < len(spans):
        start, kind, end = spans[i]
        i += 1
        while i < len(spans) and spans[i][0] < end:
            end = max(end, spans[i][2])
            i += 1
        out += [text[at:start], f"<{KINDS[kind].upper()}>"]
        at = end
    return "".join(out) + text[at:]


def redact(docs: DataFrame, detector: Detector) -> DataFrame:
    """``docs`` with personal data replaced in ``text``, and ``n_chars`` of changed rows set anew."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            before = [t.as_py() for t in batch.column(at)]
            after = [t if t is None else redacted(t, detector) for t in before]
            columns = batch.columns
            columns[at] = pa.array(after, batch.schema.field(at).type)
            n = batch.schema.get_field_index("n_chars")
            if n >= 0:
                sizes = [len(b) if b is not None and a != b else old for a, b, old in zip(before, after, columns[n].to_pylist())]
                columns[n] = pa.array(sizes, batch.schema.field(n).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
