"""Base spans against the plain patterns; redaction; odd rows."""

from __future__ import annotations

import hashlib
import random
import re

from zonepulse.llm import boosting, pii

PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
]


def plain(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m.group())
            total = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits)))
            if (
                kind == 0
                or (kind == 1 and all(int(x) <= 255 for x in m.group().split(".")))
                or (kind == 2 and 14 <= len(digits) <= 19 and total % 10 == 0)
                or (kind == 3 and 10 <= len(digits) <= 15)
            ):
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans():
    rnd = random.Random(1)
    parts = ["a", "b", "@", "@", ".", "1", "2", "9", "+", "-", " ", "(", ")", "25", "192.168.", "x@y.z", "4031 0657 2738 0220", "é", "_%"]
    for _ in range(20000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25)))
        assert pii.base_spans(text) == plain(text), text
    assert pii.base_spans("a" * 200000 + "1" * 200000 + "." * 1000) == []


def test_operator(spark):
    rows = [(1, "mail bob.x@mail.example.com or call +1 (555) 123-4567 now"), (2, "card 4111 1111 1111 1111 host 10.0.0.1"),
            (3, None), (4, ""), (None, "version 300.1.2.3 and 12345"), (1, "mail bob.x@mail.example.com or call +1 (555) 123-4567 now")] * 8
    docs = spark.createDataFrame([(i, t, 0, "s") for i, t in rows], "doc_id long, text string, n_chars long, spans string")
    detector = pii.fit(docs)
    got = pii.find_spans(docs, detector).collect()
    assert len(got) == len(rows)
    names = ("n_email", "n_ip", "n_card", "n_phone")
    for r in got:
        text = {1: rows[0][1], 2: rows[1][1], None: rows[4][1]}.get(r.doc_id) or ""
        base = plain(text)
        joined = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert [r[n] for n in names] == [sum(x[1] == k for x in base) for k in range(4)]
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) - {""} <= set(r.spans.split(","))
    clean = pii.redact(docs, detector).collect()
    first = next(r for r in clean if r.doc_id == 1)
    assert first.text.startswith("mail <EMAIL> or call <PHONE>") and first.n_chars == len(first.text)
    assert [r.text for r in clean if r.doc_id == 3] == [None] * 8
    assert pii.find_spans(docs.limit(0), pii.fit(docs.limit(0))).count() == 0


def test_all_documents_are_learnt_from(spark):
    import numpy as np

    size = 24_000  # above the 20,000 documents that were once drawn
    docs = spark.range(size).selectExpr(
        "id as doc_id", "concat('host ', pmod(hash(id, 1), 400), '.0.0.', pmod(hash(id, 2), 300), ' end') as text"
    )
    keys = {r.doc_id: r.k for r in docs.selectExpr("doc_id", "pmod(xxhash64(doc_id, text), 1 << 30) as k").collect()}
    y, x, held = [], [], []
    for r in docs.collect():
        base = set(pii.base_spans(r.text))
        for c in pii.candidates(r.text):
            y.append(c in base)
            x.append([float(np.float32(v)) for v in pii.features(r.text, c)])
            held.append(keys[r.doc_id] % 3 == 0)
    y, x, held = np.array(y, float), np.array(x), np.array(held)
    detector = pii.fit(docs)
    n, k = (~held).sum(), y[~held].sum()
    assert abs(detector.trees.bias - np.log((k + 1) / (n - k + 1))) < 1e-12
    whole = boosting.train(x[~held], y[~held])
    assert all((a == b).all() for a, b in zip(detector.trees.edges, whole.edges)) and len(detector.trees.trees) == 60
    assert np.abs(detector.trees.margin(x) - whole.margin(x)).max() < 0.01
    chosen = held & (detector.trees.margin(x) >= detector.thresholds[1])
    assert pii.lower_bound(y[chosen].sum(), chosen.sum()) >= pii.PRECISION


def test_trees_learn_and_are_deterministic():
    import numpy as np

    rng = np.random.Generator(np.random.PCG64(1))
    x = rng.normal(size=(2000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0.5)).astype(float)
    model = boosting.train(x[:1500], y[:1500])
    held = model.margin(x[1500:]) > 0
    assert (held == y[1500:]).mean() > 0.95
    assert (boosting.train(x[:1500], y[:1500]).margin(x) == model.margin(x)).all()
    assert boosting.train(np.zeros((0, 3)), np.zeros(0)).margin(np.zeros((2, 3))).tolist() == [0.0, 0.0]
