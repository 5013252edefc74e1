"""Operator 7: types and formats are kept, surrogates stay distinct, texts elsewhere unchanged."""

from __future__ import annotations

import random
import re

import pytest

from ferrolite.llm import queries as Q
from ferrolite.llm import surrogates as S

KEY = S.Keyed(b"test")


@pytest.mark.parametrize("radix, n", [(10, 1), (10, 2), (10, 3), (26, 2), (5, 3), (2, 1), (21, 2)])
def test_permutations_leave_nothing_in_place(radix, n):
    got = [KEY.number(x, radix, n, "t") for x in range(radix**n)]
    assert sorted(got) == list(range(radix**n)) and all(x != y for x, y in enumerate(got))


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


def test_formats():
    text = "Write to Jane.Doe42@mail.example.org or call +49 170 1234567 or (555) 123-4567; card 4111 1111 1111 1111, host 192.168.10.7, id 123-45-6789. Mr. Smith saw Anna Miller; Miller left. Анна пришла."
    spans = S.entities(text)
    kinds = [(k, text[a:b]) for a, b, k in spans]
    assert ("email", "Jane.Doe42@mail.example.org") in kinds and ("card", "4111 1111 1111 1111") in kinds and ("ip", "192.168.10.7") in kinds and ("ssn", "123-45-6789") in kinds
    assert [x for k, x in kinds if k == "name"] == ["Smith", "Anna", "Miller", "Miller", "Анна"]
    assert sum(k == "phone" for k, _ in kinds) == 2
    new = S.replaced(text, spans, KEY)
    assert new == S.replaced(text, spans, KEY) and new != S.replaced(text, spans, S.Keyed(b"other"))
    made = {x: S._MAKE[k](KEY, x) for k, x in kinds}
    assert all(x != y and len(x) == len(y) for x, y in made.items() if x not in ("Anna", "Анна", "192.168.10.7"))
    assert re.fullmatch(r"[A-Z][a-z]{3}\.[A-Z][a-z]{2}\d{2}@[a-z]{4}\.[a-z]{7}\.org", made["Jane.Doe42@mail.example.org"])
    assert luhn(made["4111 1111 1111 1111"].replace(" ", "")) and made["+49 170 1234567"].startswith("+49 ")
    assert made["Anna"] in S.FIRST["f", "latin"].split() and made["Анна"] in S.FIRST["f", "cyrillic"].split()
    assert new.count(made["Miller"]) == 2 and [k for _, _, k in S.entities(new)].count("email") == 1
    gaps = [text[a:b] for a, b in zip([0] + [e for _, e, _ in spans], [s for s, _, _ in spans] + [len(text)], strict=True)]
    assert all(g in new for g in gaps)


def test_corpus(spark, sf, docs, rows):
    got = {r["doc_id"]: r for r in Q.op7_pii_surrogates(spark, sf).collect()}
    assert set(got) == {r["doc_id"] for r in rows}
    assert S.collisions(docs, Q.SURROGATE_KEY).count() == 0
    address = re.compile(r"[\w.+-]+@[\w-]+\.[\w.-]*\w")
    found = 0
    for r in rows:
        for m in address.findall(r["text"] or ""):
            found += 1
            assert m not in got[r["doc_id"]]["text"]
        if not got[r["doc_id"]]["spans"]:
            assert got[r["doc_id"]]["text"] == r["text"]
    assert found > 0


def test_odd_rows(odd, odd_rows, none):
    got = S.pseudonymise(odd, b"k").collect()
    assert len(got) == len(odd_rows)
    of = {r["doc_id"]: r["text"] for r in got}
    assert of[3] is None and of[4] == "" and of[10] == "x" * 300_000
    assert S.pseudonymise(none, b"k").count() == 0 and S.collisions(none, b"k").count() == 0


def test_cards_have_a_check_digit_and_names_are_european():
    text = "Hans Müller met Jürgen Weber and Pierre Dupont; order 1700000000000, 0000000000000000 and 4111111111111112 are no cards, 4111111111111111 is one."
    kinds = [(k, text[a:b]) for a, b, k in S.entities(text)]
    assert kinds == [("name", x) for x in ("Hans", "Müller", "Jürgen", "Weber", "Pierre", "Dupont")] + [("card", "4111111111111111")]


def naive(text):
    """Entities but names, by plain rules on white-space tokens."""
    out = set()
    for m in re.finditer(r"[^\s,;()]+", text):
        t = m.group().rstrip(".")
        digits = re.sub(r"\D", "", t)
        if re.fullmatch(r"[\w.]+@[\w.]+\.[a-z]{2,}", t):
            out.add(("email", t))
        elif re.fullmatch(r"\d{1,3}(\.\d{1,3}){3}", t) and all(int(x) < 256 and x == str(int(x)) for x in t.split(".")):
            out.add(("ip", t))
        elif re.fullmatch(r"\d{3}-\d{2}-\d{4}", t):
            out.add(("ssn", t))
        elif t.isdigit() and 13 <= len(t) <= 19 and t[0] in "23456" and luhn(digits) and len(set(t)) > 1:
            out.add(("card", t))
    return out


def test_equals_the_naive_version_and_keeps_coreference(spark):
    draw = random.Random(4)

    def token():
        return draw.choice([
            lambda: draw.choice("the of and then a b".split()), lambda: f"user{draw.randrange(40)}@mail{draw.randrange(3)}.org", lambda: ".".join(str(draw.randrange(300)) for _ in range(4)),
            lambda: f"{draw.randrange(1000):03}-{draw.randrange(100):02}-{draw.randrange(10000):04}", lambda: str(draw.randrange(10 ** draw.choice([12, 15, 16, 19, 20]))), lambda: "411111111111111" + str(draw.randrange(10)),
        ])()

    texts = [" ".join(token() for _ in range(draw.randrange(40))) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    made = {}
    for r in S.checked(docs, b"naive").collect():
        text = texts[r["doc_id"]]
        got = {(s["kind"], text[s["start"] : s["end"]]) for s in r["spans"]}
        assert got == naive(text)
        at = shift = 0
        for s in r["spans"]:
            old = text[s["start"] : s["end"]]
            new = r["text"][s["start"] + shift : s["end"] + shift + 0]
            if s["kind"] == "ip":  # numbers of other lengths
                new = re.match(r"[\d.]*\d", r["text"][s["start"] + shift :]).group()
            shift += len(new) - len(old)
            assert made.setdefault((s["kind"], old), new) == new != old
            at = s["end"]
        assert at <= len(text)
    assert len({(k, v) for (k, _), v in made.items()}) == len(made) > 200


def test_a_colliding_key_is_passed_over(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "write to a@b.org and c@d.org")], "doc_id bigint, text string")
    real, seen = S.collisions, []
    monkeypatch.setattr(S, "collisions", lambda d, key, digests=frozenset(): (seen.append(key), real(d, key) if len(seen) > 1 else d)[1])
    assert S.checked(docs, b"k").first()["text"] == S.pseudonymise(docs, b"k#1").first()["text"] and seen == [b"k", b"k#1"]


def test_entities_that_collide_get_digests(spark, monkeypatch):
    """A name whose only letter has no other of its kind keeps it under every key, and so do all of them in the end."""
    monkeypatch.setitem(S._MAKE, "name", lambda k, s: s if s == "Weber" else "Qax" if s in ("Alice", "Bob") else S._other_name(k, s))
    docs = spark.createDataFrame([(1, "Alice Weber met Mr Bob and Jane Miller"), (2, "again Alice Weber came, a@b.org")], "doc_id bigint, text string")
    for most in (10_000, 1):
        monkeypatch.setattr(S, "REMAPPED", most)
        a, b = (r["text"].split() for r in S.checked(docs, b"k").orderBy("doc_id").collect())
        assert a[:2] == b[1:3] and len({a[0], a[1], a[4], a[6], a[7]}) == 5 and not {"Alice", "Weber", "Bob", "Qax"} & {*a, *b}


@pytest.mark.parametrize("text", ["hosts 10.0.0.1 and 10.0.0.01", "Anna Պետրոսյան came", "mail ___@--.com now", "John ALice met Alice"])
def test_odd_entities_stop_nothing(spark, text):
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    r = S.checked(docs, b"k").first()
    assert S.collisions(docs, b"k").count() == 0 and len(r["spans"]) == len(S.entities(text))
    assert all(text[s["start"] : s["end"]] not in r["text"].split() for s in r["spans"])


def test_random_names_of_many_scripts_stay_apart():
    draw, keyed = random.Random(7), S.Keyed(b"fuzz")
    ranges = ((65, 123), (0xC0, 0x250), (0x370, 0x400), (0x400, 0x590), (0x5D0, 0x650), (0x900, 0x970), (0x10A0, 0x1100), (0x1E00, 0x2150), (0x4E00, 0x5000), (0xAC00, 0xAD00), (0x10400, 0x10450), (0xFB00, 0xFB07))
    pools = [[c for c in map(chr, range(*r)) if c.isalpha()] for r in ranges]
    names = {"".join(draw.choice(p if draw.random() < 0.9 else draw.choice(pools)) for _ in range(draw.randint(2, 8))) for p in (draw.choice(pools) for _ in range(10_000))}
    names |= {f for n in S._FIRST_OF for f in (n, n.lower(), n.swapcase(), n[0] + n[1:].upper())}
    made = {n: S.surrogate(keyed, "name", n) for n in names}
    assert len(set(made.values())) == len(names) and all(n != m and len(n) == len(m) or n in S._FIRST_OF for n, m in made.items())
    assert all(n != m for n, m in made.items())
