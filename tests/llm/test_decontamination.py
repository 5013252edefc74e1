"""Operator 3: planted items, word for word and re-parameterised, and clean texts."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from ferrolite.llm import decontaminate as D
from ferrolite.llm import queries as Q

ITEMS = [
    (1, "A train leaves Paris at 9 and travels 120 km to Lyon in 3 hours, then it waits 20 minutes before it goes on to Rome."),
    (2, "If Alice gives 5 apples to Bob and Bob gives 5 pears to Alice, how many fruits does Alice have in the end?"),
    (3, "short item"), (4, ""), (5, None), (None, "an item without any id that no document can be said to hold"), (1, "A train leaves Paris at 9 and travels 120 km to Lyon in 3 hours, then it waits 20 minutes before it goes on to Rome."),
]


def test_template_tokens():
    t = D.Templates(pa.array(["He saw Alice and 12 kg, 3.5 of it. Then Bob Smith left.", "12", "Paris", "Élan VITAL élan"]))
    kinds = [t.kind[t.bounds[k] : t.bounds[k + 1]].tolist() for k in range(4)]
    names, num, unit = int(D.NAME), int(D.NUM), int(D.UNIT)
    assert kinds == [[0, 0, names, 0, num, unit, num, 0, 0, 0, names, 0], [num], [0], [0, 0, 0]]
    assert t.hashes[t.bounds[3]] == t.hashes[t.bounds[4] - 1]  # capitals of two bytes


@pytest.fixture
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id bigint, text string")


def test_planted_items(make, items):
    one, two = ITEMS[0][1], ITEMS[1][1]
    other = one.replace("Paris", "Berlin").replace("120", "350").replace("Lyon", "Munich").replace("3 hours", "4 hours").replace("20", "35").replace("Rome", "Vienna").replace(" 9 ", " 7 ")
    mixed = two.replace("gives 5 pears", "gives 8 pears")  # one value of the item would stand for two
    rows = [(10, f"Before it. {one} After it.", None), (11, f"Again: {other}", None), (12, two.upper(), None), (13, mixed, None), (14, "Nothing of this kind is in here, only 12 plain words and a few more.", None), (15, " ".join(one.split()[:6]), None), (16, "a Short  ITEM here", None), (17, "x y z " + " ".join(one.split()[:14]) + " z y x", None)]
    got = {(r["doc_id"], r["item_id"]): r for r in D.matches(make(rows + rows[:2]), items).collect()}
    assert {(10, 1), (11, 1)} <= set(got) and got[10, 1]["coverage"] == 1.0 and got[10, 1]["exact"] and not got[11, 1]["exact"]
    assert {(12, 2), (16, 3), (17, 1)} <= set(got)  # in other letters, and a passage of 13 words
    assert (13, 2) not in got and (14, 1) not in got and (14, 2) not in got and (15, 1) not in got
    left = sorted(r["doc_id"] for r in D.clean(make(rows + rows[:2] + rows[4:5]), items).collect())
    assert 14 in left and left.count(14) == 2 and not {10, 11} & set(left)


def test_every_verbatim_item_is_found(spark, sf, rows):
    """The items that a document holds word for word, found by plain search, are all among the matches."""

    def plain(text):
        return " " + " ".join(re.findall(r"[^\W_]+", (text or "").lower())) + " "

    marks = {r["item_id"]: plain(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    want = {(r["doc_id"], k) for r in rows for t in [plain(r["text"])] for k, m in marks.items() if len(m) > 2 and m in t}
    got = {(r["doc_id"], r["item_id"]) for r in Q.op3_decontamination(spark, sf).collect()}
    assert want and want <= got
    held = {d for d, _ in got}
    assert len(held) < 0.2 * len(rows)


def test_odd_rows(odd, odd_rows, none, items):
    assert D.matches(odd, items).count() == 0
    left = D.clean(odd, items)
    assert left.columns == odd.columns and left.count() == len(odd_rows)
    assert D.matches(odd, items.limit(0)).count() == 0 and D.clean(odd, items.limit(0)).count() == len(odd_rows)
    assert D.matches(none, items).count() == 0 and D.clean(none, items).count() == 0


def test_word_for_word_needs_no_slots(make, spark):
    """One of two equal numbers changed, a list number before the item, few plain words, two short runs on a diagonal."""
    long = "If 12 students of the first class and then 7 students of another class meet 12 teachers at noon how many people are there in all of the rooms that day"
    plain = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty " + " ".join(f"w{c}" for c in "abcdefghijklmnopqrstuvwxyz")
    items = spark.createDataFrame([(1, long), (2, "5 apples and 5 pears lie here, take 5 or 6 of them"), (3, "What is 3 + 4 * 5 - 6"), (4, plain)], "item_id bigint, text string")
    words = plain.split()
    broken = " ".join(words[:10] + ["stop"] + words[11:21] + ["stop"] * (len(words) - 21))  # runs of 10 words, one diagonal
    rows = [(1, long.replace("7 students", "9 students").replace("12 teachers", "13 teachers"), None), (2, "3. 5 apples and 5 pears lie here, take 5 or 6 of them.", None), (3, "9. What is 3 + 4 * 5 - 6?", None),
            (4, "3. 8 apples and 8 pears lie here, take 8 or 9 of them.", None), (5, broken, None), (6, " ".join(words[5:18]), None), (7, " ".join(words[5:17]), None), (8, "What is 7 + 4 * 5 - 6?", None)]
    got = {(r["doc_id"], r["item_id"]): r for r in D.matches(make(rows), items).collect()}
    assert set(got) == {(1, 1), (2, 2), (3, 3), (4, 2), (6, 4)}
    assert got[2, 2]["exact"] and not got[4, 2]["exact"] and got[3, 3]["coverage"] == 1.0


def naive(docs, items, coverage=0.5):
    """(doc, item) pairs held, by plain loops over Python lists (ASCII texts)."""

    def tokens(text, reading):
        out = []
        for m in re.finditer(r"[A-Za-z]+|[0-9]+", text):
            w, a = m.group(), m.start()
            kind = "num" if w.isdigit() and reading else ""
            if reading == 2 and re.match(r"[A-Z][a-z]", w) and a >= 2 and text[a - 1] == " " and re.match(r"[A-Za-z0-9,;'\"()-]", text[a - 2]):
                kind = "name"
            out.append([kind, w.lower(), a, m.end()])
        for k in range(len(out) - 1, 0, -1):
            if reading and out[k][0] != "num" and out[k - 1][0] == "num" and out[k][1] in D.UNITS:
                out[k][0] = "unit"
        merged = []
        for kind, w, a, b in out:
            if merged and kind and merged[-1][0] == kind and (kind != "num" or (a == merged[-1][3] + 1 and not text[a - 1].isspace())):
                merged[-1][1:] = [text[merged[-1][2] : b].lower(), merged[-1][2], b]
            else:
                merged.append([kind, w, a, b])
        return [(k, w) for k, w, _, _ in merged]

    def windows(t, reading, width):
        for at in range(len(t) - width + 1):
            x = t[at : at + width]
            if (reading == 0 and width >= D.LEAST_LITERAL) or sum(not k and not w.isdigit() for k, w in x) >= min(D.PLAIN, width):
                yield at, tuple(k or w for k, w in x), [(k, w) for k, w in x if k]

    out = set()
    for i, item in items:
        for reading in (0, 1, 2):
            t = tokens(item, reading)
            width = min(len(t), D.WIDTH)
            mine = list(windows(t, reading, width)) if width else []
            for d, text in docs:
                lines = {}
                for dp, form, ds in windows(tokens(text, reading), reading, width) if mine else []:
                    for ip, f, s in mine:
                        if f == form:
                            at, slots = lines.setdefault(dp - ip, (set(), set()))
                            at.add(ip)
                            slots |= set(zip(s, ds))
                good = [at for at, slots in lines.values() if len({a for a, _ in slots}) == len(slots)]
                run = any(all(p + k in at for k in range(min(D.VERBATIM, len(mine)))) for at in good for p in at)
                if mine and (run if reading == 0 else len(set().union(*good)) / len(mine) >= coverage):
                    out.add((d, i))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_equals_the_naive_version(spark, make, seed):
    draw = random.Random(seed)
    plain = "if gives to and then how many much of the in a box takes away were left over buys sells for each one at".split()

    def sentence(n):
        kinds = (lambda: draw.choice(plain), lambda: draw.choice(["Ann", "Bob", "Carl Smith", "Dora"]), lambda: f"{draw.choice(['3', '7', '12', '3.5', '1,000'])} {draw.choice(['apples', 'km', 'hours', 'kg'])}")
        return " ".join(draw.choices(kinds, [6, 1, 1])[0]() for _ in range(n)).capitalize() + draw.choice([".", "?"])

    items = [(k, sentence(draw.choice([3, 5, 9, 20, 40]))) for k in range(25)]
    swaps = {"Ann": "Eve", "Bob": "Max", "Dora": "Ida", "apples": "pears", "3": "9", "12": "45", "7": "8"}
    docs = []
    for d in range(60):
        text = draw.choice(items)[1]
        for a, b in swaps.items():
            if draw.random() < 0.5:
                text = re.sub(rf"\b{a}\b", b, text, count=draw.choice([0, 1]))
        words = text.split()
        at = draw.randrange(len(words)) if draw.random() < 0.4 else None
        if at is not None:
            words[at : at + draw.choice([1, 4])] = [draw.choice(plain)]
        docs.append((d, f"{draw.choice(['', '3. ', sentence(12) + ' '])}{' '.join(words)} {sentence(10)}"))
    got = {(r["doc_id"], r["item_id"]) for r in D.matches(make([(d, t, None) for d, t in docs]), spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    want = naive(docs, items)
    assert want and got == want


def test_long_texts_in_pieces(spark, make, items, monkeypatch):
    """Pieces change nothing: places, slots and windows are those of the whole text."""
    draw = random.Random(3)
    words = [draw.choice(["walks", "to", "the", "Bob", "Carl", "3", "4.5", "km", "and", "then", "x1", "Ümlaut"]) for _ in range(40_000)]
    for at in (5_000, 17_777, 39_000):
        words[at : at + 1] = ITEMS[0][1].split()
    text = " ".join(words)
    found = []
    for long in (1 << 30, 1 << 15):
        monkeypatch.setattr(D, "LONG", long)
        t = [D.Templates(pa.array([text]), reading) for reading in D.READINGS]
        whole = [x.hashes[x.bounds[0] : x.bounds[1]].tolist() for x in t]
        if long < len(text):
            parts = list(D.pieces(np.frombuffer(text.encode(), np.uint8), long // 2))
            assert len(parts) > 10
            for n, reading in enumerate(D.READINGS):
                again = []
                for piece, own in parts:
                    x = D.Templates(piece, reading)
                    again += x.hashes[: np.searchsorted(x.starts, own)].tolist()
                assert again == whole[n]
        found.append(sorted(tuple(r) for r in D.matches(make([(1, text, None)]), items).collect()))
    assert found[0] and found[0] == found[1]
    assert list(D.pieces(np.zeros(0, np.uint8))) == []
    assert b"".join(p[0].as_py().encode()[:n] if isinstance(p[0].as_py(), str) else b"" for p, n in D.pieces(np.full(3 << 20, 120, np.uint8))) == b"x" * (3 << 20)
