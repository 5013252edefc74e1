"""Operator 9: the fixed patterns by themselves, and what the models add."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

from ferrolite.llm import queries as Q
from ferrolite.llm import secrets


def base(text):
    out = []
    for k, (kind, pattern, least, group) in enumerate(
        [("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 12, 2), ("access", re.compile(r"AKIA[A-Z0-9]+"), 18, 0), ("hex", re.compile(r"[0-9a-f]+"), 16, 0)]
    ):
        out += [(m.start(), k, m.end(), kind) for m in pattern.finditer(text) if len(m[group]) >= least]
    return sorted(out)


def test_base_spans(spark, sf, rows):
    text = {r["doc_id"]: r["text"] or "" for r in rows}
    got = Q.op9_secret_scan(spark, sf).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(text)
    for r in got:
        spans = base(text[r["doc_id"]])
        want = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[3] == k for s in spans) for k in ("assign", "access", "hex")]
        mine = [s.split(":") for s in r["spans"].split(",")] if r["spans"] else []
        assert [s for s in mine if s[0] != "markov"] == [[kind, str(a), str(b)] for a, _, b, kind in spans]
        assert [int(s[1]) for s in mine] == sorted(int(s[1]) for s in mine)


def test_models_tell_random_strings_from_names(docs):
    model = secrets.fit(docs)
    import pyarrow as pa

    unseen = secrets.random_strings(400, seed=77)
    hit = [len(s) > 0 for s in secrets.found_in(pa.array([f"see {x} there" for x in unseen]), model)]
    assert sum(hit) > 0.95 * len(hit)
    names = [x for x in secrets.identifiers(600, seed=78) if len(x) >= secrets.RUN] + ["internationalization-and-localization", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "Donaudampfschifffahrtsgesellschaft", "-" * 60, "0" * 40]
    assert sum(len(s) > 0 for s in secrets.found_in(pa.array([f"see {x} there" for x in names]), model)) <= 0.01 * len(names)


def test_odd_rows_and_redaction(odd, odd_rows, none):
    model = secrets.Markov(secrets.random_strings(300), secrets.identifiers(300))
    got = secrets.scan(odd, model).collect()
    assert len(got) == len(odd_rows)
    spans = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in got}
    assert spans[3] == spans[4] == spans[1] == [] and spans[11] == [("assign", 2, 25), ("access", 26, 46)]
    clean = secrets.redact(odd, model)
    assert clean.columns == odd.columns and clean.count() == len(odd_rows)
    assert {r["doc_id"]: r["text"] for r in clean.collect()}[11] == "\U0001f600 [secret] [secret] \x00"
    assert secrets.scan(none, model).count() == 0 and secrets.redact(none, model).count() == 0
    assert secrets.fit(none).ratio.shape == model.ratio.shape


def test_markov_spans_equal_the_naive_version(make):
    """Transitions counted one by one; maximal runs of key characters outside of what the patterns find."""
    draw = random.Random(5)
    secret, plain = secrets.random_strings(1500, 1), secrets.identifiers(1500, 2)

    def logs(samples):
        pairs = Counter((a, b) for s in samples for a, b in zip(s, s[1:]))
        rows = Counter(a for s in samples for a in s[:-1])
        n = len(secrets._CHARS)
        return lambda a, b: math.log((pairs[a, b] + 0.5) / (rows[a] + 0.5 * n))

    p, q = logs(secret), logs(plain)
    texts = []
    for _ in range(150):
        parts = [draw.choice([*secrets.random_strings(1, draw.random()), *secrets.identifiers(1, draw.random()), "a" * 30, "token=" + "Ab3" * 8, "0123456789abcdef0123", "AKIA" + "Z9" * 9, "é", "word"]) for _ in range(9)]
        texts.append(draw.choice([" ", ", ", "\u00e9"]).join(parts))
    got = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"] if s["kind"] == "markov"] for r in secrets.scan(make([(k, t, None) for k, t in enumerate(texts)]), secrets.Markov(secret, plain)).collect()}
    found = 0
    for k, text in enumerate(texts):
        fixed = [(a, b) for a, _, b, _ in base(text)]
        want = []
        for m in re.finditer(r"[A-Za-z0-9+/=_-]{20,}", text):
            ratio = sum(p(a, b) - q(a, b) for a, b in zip(m[0], m[0][1:]))
            if abs(ratio - secrets.RATIO) > 1e-6 and ratio >= secrets.RATIO and len(set(m[0])) >= secrets.DISTINCT and all(m.end() <= a or m.start() >= b for a, b in fixed):
                want.append(m.span())
        assert got[k] == want
        found += len(want)
    assert found > 50
