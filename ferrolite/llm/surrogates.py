"""Operator 7: personal data replaced by keyed surrogates of the same type, format, script and gender.

Entities are e-mail addresses, phone numbers, payment cards (numbers with a right check digit), IPv4 addresses, social
security numbers and names of persons. A surrogate is a keyed permutation of the entity's own letters and digits within its format, so that two
entities never get the same surrogate, the same entity gets the same one in every document, and no table of entities
is gathered. First names are permuted within the list of their gender and script; other names keep the pattern of
vowels and consonants (letters of other scripts are permuted within their block) and are walked on until they collide
with no listed name. ``checked`` counts the outcome over the whole corpus first; entities that would share a surrogate or
keep their own, if there are any, get one made from a digest. Whatever the texts hold, it raises nothing.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrolite.llm.common import as_text, only, tuned

KINDS = ("email", "phone", "card", "ip", "ssn", "name")

# Common first names by gender and script, and titles.
FIRST = {
    ("f", "latin"): "Alice Anna Barbara Carol Catherine Clara Diana Elena Elizabeth Emma Eva Grace Hannah Helen Irene Jane Jennifer Jessica Julia Karen Laura Linda Lisa Lucy Margaret Maria Marie Martha Mary Nancy Olivia Patricia Rachel Rebecca Ruth Sarah Sophie Susan Teresa Victoria Camille Carmen Chiara Claire Giulia Heike Ingrid Isabelle Lucía Monika Nathalie Petra Pilar Sabine Ursula",
    ("m", "latin"): "Adam Albert Andrew Anthony Arthur Benjamin Brian Charles Christopher Daniel David Edward Eric Frank George Henry Jack Jacob James John Jonathan Joseph Kevin Liam Lucas Martin Matthew Michael Nicholas Oliver Patrick Paul Peter Richard Robert Samuel Stephen Thomas Walter William Antonio Carlos Dieter François Giovanni Giuseppe Günther Hans Heinz Jacques Javier Jean José Juan Jürgen Karl Klaus Louis Luis Marco Matthias Michel Miguel Pablo Pedro Philippe Pierre Stefan Uwe Wolfgang",
    ("f", "cyrillic"): "Анна Вера Галина Дарья Екатерина Елена Ирина Ксения Людмила Мария Надежда Наталья Ольга Светлана Татьяна Юлия",
    ("m", "cyrillic"): "Александр Алексей Андрей Борис Виктор Владимир Дмитрий Иван Игорь Константин Максим Михаил Николай Олег Павел Сергей",
    ("f", "greek"): "Άννα Αικατερίνη Βασιλική Γεωργία Δέσποινα Ελένη Ειρήνη Κατερίνα Μαρία Σοφία",
    ("m", "greek"): "Αλέξανδρος Ανδρέας Βασίλης Γιώργος Δημήτρης Κώστας Μιχάλης Νίκος Παναγιώτης Χρήστος",
}
TITLES = "Mr Mrs Ms Miss Dr Prof Herr Frau Monsieur Madame Señor Señora"
_VOWELS = ("aeiou", "аеиоуыэюя", "αεηιουω", "áéíóú", "àèìòù", "äöü")
_CONSONANTS = ("bcdfghjklmnpqrstvwxyz", "бвгджзклмнпрстфхцчшщ", "βγδζθκλμνξπρστφχψ")

_LISTS = {k: v.split() for k, v in FIRST.items()}
#: Listed names as they are written, and in capitals; any other spelling is another entity.
_FIRST_OF = {form: (key, i) for key, names in _LISTS.items() for i, name in enumerate(names) for form in (name.upper(), name)}
_NAMES = frozenset(n for names in _LISTS.values() for n in names) | frozenset(n.upper() for names in _LISTS.values() for n in names)
_TITLE_SET = frozenset(TITLES.split())

_PATTERN = re.compile(
    r"(?P<email>(?<![\w.+%-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}(?![\w-]))"
    r"|(?P<phone>(?<![\w.+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\d\w])|(?<![\w.+])\+\d{1,3}(?:[ .-]?\d{1,4}){3,6}(?![\w]))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<ip>(?<![\w.])(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?:\.(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)){3}(?![\w]|\.\d))"
    r"|(?P<card>(?<![\w])(?:\d{4}(?P<sep>[ -])\d{4}(?P=sep)\d{4}(?P=sep)\d{4}|\d{13,19})(?![\w]))"
)
_LETTERS = re.compile(r"[^\W\d_]+")
_HAS = re.compile(r"[\d@]")
_PERSON = re.compile(r"(?:\b(?P<title>" + "|".join(_TITLE_SET) + r")\.?[ ]+)?\b(?P<first>[^\W\d_]+)(?:[ ](?P<middle>[^\W\d_]\.))?(?:[ ](?P<last>[^\W\d_]+(?:-[^\W\d_]+)?))?")


class Keyed:
    """Permutations under one secret key: bijections of each domain that leave nothing in its place."""

    def __init__(self, key: bytes) -> None:
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _draw(self, tweak: str, *parts: int) -> int:
        return int.from_bytes(hashlib.blake2b(f"{tweak}|{'|'.join(map(str, parts))}".encode(), key=self.key, digest_size=24).digest(), "big")

    def _feistel(self, x: int, radix: int, n: int, tweak: str, back: bool) -> int:
        """A permutation of the n-digit numbers of a radix: ten rounds over two halves."""
        if n == 1:
            move = self._draw(tweak, radix)
            return (x - move if back else x + move) % radix
        u = n // 2
        sizes = (radix**u, radix ** (n - u))
        halves = [x // sizes[1], x % sizes[1]]
        rounds = range(9, -1, -1) if back else range(10)
        for r in rounds:
            side = r % 2
            move = self._draw(tweak, r, n, halves[1 - side])
            halves[side] = (halves[side] + (-move if back else move)) % sizes[side]
        return halves[0] * sizes[1] + halves[1]

    def number(self, x: int, radix: int, n: int, tweak: str) -> int:
        """Permute, add one, permute back: again a permutation, and none of its points is fixed."""
        y = (self._feistel(x, radix, n, tweak, False) + 1) % radix**n
        return self._feistel(y, radix, n, tweak, True)

    def string(self, s: str, alphabet: str, tweak: str) -> str:
        """A string over the alphabet of the same length."""
        if not s:
            return s
        radix, x = len(alphabet), 0
        for c in s:
            x = x * radix + alphabet.index(c)
        x, out = self.number(x, radix, len(s), f"{tweak}:{alphabet[0]}{radix}"), []
        for _ in s:
            x, k = divmod(x, radix)
            out.append(alphabet[k])
        return "".join(reversed(out))

    def within(self, s: str, tweak: str, alphabets: tuple[str, ...]) -> str:
        """Each alphabet's characters of ``s`` permuted among their places, other letters among those of their block and
        kind; case and all other characters stay."""
        # Only letters whose capital is their own are put in lower case: others would be taken for them.
        low = [x if len(x := c.lower()) == 1 and x.upper() == c else c for c in s]
        out = list(low)
        others = {a for c in low if not c.isascii() for a in [_block(c)] if len(a) > 1}
        for a in (*alphabets, *sorted(others)):
            places = [k for k, c in enumerate(low) if c in a]
            for k, c in zip(places, self.string("".join(low[k] for k in places), a, tweak), strict=True):
                out[k] = c
        return "".join(o.upper() if c != x else o for o, c, x in zip(out, s, low, strict=True))

    def token(self, kind: str, s: str) -> str:
        """A name or address made from a digest, as different from others' as the digests are."""
        x, letters = self._draw(f"token{kind}", *s.encode("utf-8", "surrogatepass")), []
        for _ in range(24):
            x, k = divmod(x, 26)
            letters.append(_ABC[k])
        word = "".join(letters)
        return f"{word}@example.{s.rpartition('.')[2]}" if kind == "email" else word.capitalize()


_KNOWN = frozenset("".join((*_VOWELS, *_CONSONANTS, "abcdefghijklmnopqrstuvwxyz")))


def _class(c: str) -> tuple[str, str, bool] | None:
    """Script (the first word of its name) and general category of a letter, and whether it has a capital of its own; null for those that the alphabets have and
    for capitals that are written as their small letter with a mark for it."""
    low = c.lower()
    if c in _KNOWN or not c.isalpha() or (len(low) == 1 and low != c and low.upper() == c):
        return None
    high = c.upper()
    return unicodedata.name(c, "").split(" ")[0], unicodedata.category(c), len(high) == 1 and high != c and high.lower() == c


@lru_cache(maxsize=1024)
def _blocks(start: int) -> dict[tuple, str]:
    """The letters of each class among the 128 code points from ``start`` on."""
    out: dict[tuple, str] = {}
    for x in map(chr, range(start, start + 128)):
        if (k := _class(x)) is not None:
            out[k] = out.get(k, "") + x
    return out


@lru_cache(maxsize=4096)
def _block(c: str) -> str:
    """The letters of the same class among the 128 code points around ``c``; one that is alone there goes with the others
    of this kind among 1024. Every letter is in one such alphabet only."""
    kind = _class(c)
    if kind is None:
        return ""
    near = _blocks(ord(c) >> 7 << 7)[kind]
    if len(near) > 1:
        return near
    start = ord(c) >> 10 << 10
    return "".join(x for at in range(start, start + 1024, 128) if len(x := _blocks(at).get(kind, "")) == 1)


_DIGITS, _ABC = "0123456789", "abcdefghijklmnopqrstuvwxyz"


def _luhn(payload: str) -> int:
    total = 0
    for k, c in enumerate(reversed(payload)):
        d = int(c) * (2 if k % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def _is_card(s: str) -> bool:
    """Digits of a payment card: a first digit that issuers use and a right check digit."""
    own = re.sub(r"\D", "", s)
    return own[0] in "23456" and len(set(own)) > 1 and _luhn(own[:-1]) == int(own[-1])


def _is_one(kind: str, s: str) -> bool:
    """Cards need a right check digit, addresses a letter or digit before their last dot."""
    return _is_card(s) if kind == "card" else kind != "email" or any(c.isalnum() for c in s.rpartition(".")[0])


def _digits_replaced(s: str, new: str, skip: int = 0) -> str:
    """``s`` with its digits, but for the first ``skip``, replaced in turn."""
    it, out, seen = iter(new), [], 0
    for c in s:
        if c.isdigit() and c.isascii():
            seen += 1
            out.append(next(it) if seen > skip else c)
        else:
            out.append(c)
    return "".join(out)


def _email(k: Keyed, s: str) -> str:
    local, _, domain = s.rpartition("@")
    host, _, top = domain.rpartition(".")
    return f"{k.within(local, 'local', (_ABC, _DIGITS))}@{k.within(host, 'host', (_ABC, _DIGITS))}.{top}"


def _phone(k: Keyed, s: str) -> str:
    code = re.match(r"\+(\d{1,3})(?=[ .(-])", s)
    skip = len(code[1]) if code else (min(2, sum(c.isdigit() for c in s) - 4) if s[0] == "+" else 0)
    own = re.sub(r"\D", "", s)
    return _digits_replaced(s, k.string(own[skip:], _DIGITS, f"phone{own[:skip]}"), skip)


def _card(k: Keyed, s: str) -> str:
    """The check digit keeps its distance from the right one, so valid numbers stay valid."""
    own = re.sub(r"\D", "", s)
    payload = own[0] + k.string(own[1:-1], _DIGITS, f"card{own[0]}")
    return _digits_replaced(s, payload + str((_luhn(payload) + int(own[-1]) - _luhn(own[:-1])) % 10))


def _ip(k: Keyed, s: str) -> str:
    x = 0
    for part in s.split("."):
        x = x * 256 + int(part)
    x = k.number(x, 256, 4, "ip")
    return ".".join(str(x >> b & 255) for b in (24, 16, 8, 0))


def _ssn(k: Keyed, s: str) -> str:
    return _digits_replaced(s, k.string(s.replace("-", ""), _DIGITS, "ssn"))


def _first(k: Keyed, s: str) -> str:
    """The next name of the same gender and script, in a keyed order."""
    key, i = _FIRST_OF[s]
    names = _LISTS[key]
    order = sorted(range(len(names)), key=lambda j: k._draw(f"first{key}", j))
    name = names[order[(order.index(i) + 1) % len(names)]]
    return name if s == names[i] else name.upper()


def _other_name(k: Keyed, s: str) -> str:
    """Vowels stay vowels and consonants consonants; walked on until the outcome is no listed name."""
    if s in _FIRST_OF:
        return _first(k, s)
    out = s
    for _ in range(64):
        out = k.within(out, "name", _VOWELS + _CONSONANTS)
        if out not in _FIRST_OF:
            break
    return out


_MAKE: dict[str, Callable[[Keyed, str], str]] = {"email": _email, "phone": _phone, "card": _card, "ip": _ip, "ssn": _ssn, "name": _other_name}


def _person_spans(text: str, taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Parts of persons' names: a listed first name, with a surname after it, or a title with a surname; and each
    surname again wherever else in the text it stands alone."""
    present = set(_LETTERS.findall(text))
    if not (present & _NAMES or present & _TITLE_SET):
        return []
    found: set[tuple[int, int]] = set()
    last: set[str] = set()
    at = 0
    while m := _PERSON.search(text, at):
        at = m.end("first")
        first, surname = m["first"], m["last"]
        listed = first in _NAMES
        if listed:
            found.add(m.span("first"))
            if surname and surname[0].isupper() and len(surname) > 1:
                found.add(m.span("last"))
                last.add(surname)
                at = m.end("last")
        elif m["title"] and first[0].isupper() and len(first) > 1:
            found.add(m.span("first"))
            last.add(first)
    if last:
        found |= {m.span() for m in re.finditer(r"\b(?:" + "|".join(map(re.escape, sorted(last | {x.upper() for x in last}))) + r")\b", text)}
    return [(a, b, "name") for a, b in found if all(b <= s or a >= e for s, e, _ in taken)]


def entities(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, in order, without overlaps."""
    out = [(m.start(), m.end(), m.lastgroup) for m in _PATTERN.finditer(text) if _is_one(m.lastgroup, m.group())] if _HAS.search(text) else []
    named = sorted(_person_spans(text, out))
    end = -1
    for a, b, kind in named:
        if a >= end:
            out.append((a, b, kind))
            end = b
    return sorted(out)


#: Entities that are mapped one by one at most (they travel with the tasks); beyond, all of their kind get digests.
REMAPPED = 10_000


def surrogate(key: Keyed, kind: str, s: str, digests: frozenset = frozenset()) -> str:
    """``digests`` has the kinds and the (kind, entity) pairs that get one made from a digest."""
    return key.token(kind, s) if digests and (kind in digests or (kind, s) in digests) else _MAKE[kind](key, s)


def replaced(text: str, spans: list[tuple[int, int, str]], key: Keyed, digests: frozenset = frozenset()) -> str:
    out, at = [], 0
    for a, b, kind in spans:
        out += [text[at:a], surrogate(key, kind, text[a:b], digests)]
        at = b
    return "".join([*out, text[at:]])


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("spans", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))])


def pseudonymise(docs: DataFrame, key: bytes, digests: frozenset = frozenset()) -> DataFrame:
    """doc_id, text with surrogates, spans array<struct<kind, start, end>> (of the original text) for each row.

    Every whole text is handled row by row: nothing is shuffled, and repeated rows, null ids and extra columns change
    nothing. A null text stays null; an empty one, and one without entities, stays as it is.
    """
    tuned(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keyed = Keyed(key)
        for batch in batches:
            column = batch.column("text")
            texts, spans = [], []
            for valid, x in zip(column.is_valid().to_pylist(), as_text(column), strict=True):
                text = x.as_py()
                here = entities(text)
                texts.append((replaced(text, here, keyed, digests) if here else text) if valid else None)
                spans.append([{"kind": k, "start": a, "end": b} for a, b, k in here])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(spans, _SCHEMA.field("spans").type)], schema=_SCHEMA)

    rows = only(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id bigint, text string, spans array<struct<kind:string,start:bigint,end:bigint>>")


def checked(docs: DataFrame, key: bytes, attempts: int = 2) -> DataFrame:
    """``pseudonymise`` with the first of ``attempts`` keys made from ``key`` under which distinctness and change hold over
    the whole corpus. If none does, entities that collide get surrogates made from digests (24 letters of a keyed hash,
    for names and addresses; all other kinds are permutations that can't collide): ``REMAPPED`` of them one by one, or
    else all of their kind. One key serves all documents, so an entity has one surrogate everywhere. No entity, whatever
    its script or spelling, stops the others."""
    for n in range(attempts):
        own = key + b"#%d" % n if n else key
        if not collisions(docs, own).take(1):
            return pseudonymise(docs, own)
    digests: frozenset = frozenset()
    for _ in range(2):
        found = colliding(docs, own, digests)
        few = found.limit(REMAPPED + 1).collect()
        if not few:
            break
        digests |= {(r["kind"], r["entity"]) for r in few} if len(few) <= REMAPPED else {r["kind"] for r in found.select("kind").distinct().collect()}
    return pseudonymise(docs, own, frozenset(d for d in digests if (d if isinstance(d, str) else d[0]) in ("name", "email")))


def _made(docs: DataFrame, key: bytes, digests: frozenset = frozenset()) -> DataFrame:
    """kind, entity, surrogate: the distinct entities of the corpus."""
    tuned(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keyed = Keyed(key)
        for batch in batches:
            rows = {(k, t[a:b]) for t in (x.as_py() for x in as_text(batch.column("text"))) for a, b, k in entities(t)}
            made = [(k, s, surrogate(keyed, k, s, digests)) for k, s in sorted(rows)]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in made], pa.string()) for c in range(3)], names=["kind", "entity", "surrogate"])

    return only(docs, "text").mapInArrow(run, "kind string, entity string, surrogate string").distinct()


def collisions(docs: DataFrame, key: bytes, digests: frozenset = frozenset()) -> DataFrame:
    """kind, surrogate, entities: surrogates that several different entities of the corpus share (none are expected),
    and entities that are their own surrogate (with ``entities`` 1). Counted in Spark over distinct entities."""
    shared = _made(docs, key, digests).groupBy("kind", "surrogate").agg(F.count(F.lit(1)).alias("entities"), F.max(F.col("entity") == F.col("surrogate")).alias("same"))
    return shared.where("entities > 1 or same").select("kind", "surrogate", "entities")


def colliding(docs: DataFrame, key: bytes, digests: frozenset = frozenset()) -> DataFrame:
    """kind, entity: those behind ``collisions``."""
    return _made(docs, key, digests).join(collisions(docs, key, digests).select("kind", "surrogate"), ["kind", "surrogate"], "left_semi").select("kind", "entity")
