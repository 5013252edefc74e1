"""Operator 1: held-out accuracy, and sizes against the library's own compressor."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import zstandard
from pyspark.sql import functions as F

from ferrolite.llm import langid
from ferrolite.llm import queries as Q


def test_held_out_accuracy(spark, sf, rows):
    got = {r["doc_id"]: r for r in Q.op1_language_id(spark, sf).collect()}
    assert set(got) == {r["doc_id"] for r in rows}
    known = [r for r in rows if r["lang"] is not None and r["text"] and len(r["text"].split()) >= 5]
    held = [r for r in known if got[r["doc_id"]]["held_out"]]
    assert all(got[r["doc_id"]]["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert len(held) > 100 and sum(got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert {r["lang_pred"] for r in got.values()} <= {r["lang"] for r in rows} | {"und"}


def test_margin_rejects():
    names, held = ["de", "en"], {"en": b"the cat sat on the mat and the dog ran after the ball " * 20, "de": "der hund lief über die straße und die katze saß im garten ".encode() * 20}
    coders = langid.Compressors(held)
    assert coders.names == names
    best, score, gap, rejected = langid.judge(names, coders.sizes("The dog sat on the mat, and the cat ran!"), 0.01)
    assert best == "en" and score > 0.5 and gap > 0.01 and not rejected
    assert langid.judge(names, [10, 10], 0.01) == ("de", 0.5, 0.0, True)


def test_odd_rows(odd, odd_rows, none):
    held = {"en": b"the quick brown fox jumps over the lazy dog again", "de": "ein sehr langer text über vieles zwei wörter".encode()}
    got = langid.identify(odd, held).collect()
    assert len(got) == len(odd_rows)
    of = {r["doc_id"]: r for r in got}
    assert [(of[k]["lang_pred"], of[k]["score"]) for k in (3, 4, 5, 8)] == [("und", 0.0)] * 4
    assert (of[1]["lang_best"], of[9]["lang_best"]) == ("en", "de")
    assert {r["lang_pred"] for r in langid.identify(odd, {}).collect()} == {"und"}
    assert langid.identify(none, held).count() == 0 and langid.fit_dictionaries(none, F.lit(True)) == {}
    assert set(langid.fit_dictionaries(odd, F.lit(True))) == {"de", "en"}


def test_equals_the_naive_version(spark, make):
    """Dictionaries by counting in Python, sizes by a compressor of its own for every chunk, repeated rows counted once."""
    draw = random.Random(2)
    words = {k: ["".join(draw.choices(a, k=draw.randint(2, 9))) for _ in range(3000)] for k, a in (("en", "abcdefgh"), ("fr", "abcdefgé"))}
    rows = [(k, " ".join(draw.choices(words[lang], k=draw.randint(1, 400))) + "! 42", lang) for k in range(80) for lang in [draw.choice(["en", "fr"])]]
    train = F.col("doc_id") % 4 != 2
    most = 9000
    got = langid.fit_dictionaries(make(rows + rows[:30] * 5), train, dict_bytes=most)
    for lang in words:
        seen = Counter(w for d, t, of in rows if of == lang and d % 4 != 2 for w in set(re.findall(r"[^\W\d_]+", t.lower())))
        kept, used = [], 0
        for w, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0])):
            used += len(w.encode()) + 1
            if used > most:
                break
            kept.append(w)
        assert got[lang] == (" ".join(reversed(kept)) + " ").encode() and len(got[lang]) > 0.9 * most
    coders = langid.Compressors(got)
    for _, text, _ in rows:
        data = re.sub(r"[\W\d_]+", " ", text.lower()).encode()
        want = []
        for name in sorted(got):
            params = zstandard.ZstdCompressionParameters.from_level(5, dict_size=len(got[name]), source_size=langid.CHUNK, min_match=4, strategy=zstandard.STRATEGY_GREEDY, write_content_size=0, write_checksum=0)
            d = zstandard.ZstdCompressionDict(got[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=params)
            want.append(sum(len(zstandard.ZstdCompressor(dict_data=d, compression_params=params).compress(data[at : at + langid.CHUNK])) for at in range(0, len(data), langid.CHUNK)))
        assert coders.sizes(text) == want
    judged = {r["doc_id"]: r["lang_best"] for r in langid.identify(make(rows), got).collect()}
    assert all(judged[d] == min(zip(coders.sizes(t), coders.names, strict=True))[1] for d, t, _ in rows)
