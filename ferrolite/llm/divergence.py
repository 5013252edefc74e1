"""Operator 11: how far the sources of a language diverge in their terms, and which terms set a source apart.

Plain relational: matches of the term pattern are exploded and counted by group, groups are crossed with the kept
vocabulary of their language so that zeros are there, the dense table is joined with itself on language and term, and
sums are ranked in windows. Texts are read once; what is moved are counts that each task has combined before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrolite.llm.common import only, stash

#: A term, once A-Z are lower case: letters, and whatever is not ASCII.
TERM = r"[a-z\x{80}-\x{10FFFF}]+"
NO_TERM = r"[\x00-\x40\x5B-\x60\x7B-\x7F]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Documents of a language that a kept term is in, parts of a whole, ranks of terms.
LEAST_DOCS, PARTS, TERM_RANKS = 10, 1_000_000_000, 10
#: Characters of a text whose terms are one array at most; longer texts are cut between terms.
PIECE = 1 << 20
#: Rows of the dense table that one task makes at least before it is dealt over more of them.
DENSE_ROWS = 1 << 18


def lowered(text: Column) -> Column:
    """Only A-Z become lower case. Texts of ASCII alone take the quick way, which does the same to them."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def pieces(text: Column, size: int = PIECE) -> Column:
    """The text in pieces of about ``size`` characters; each cut is at the first character after it that is in no term."""
    n = F.char_length(text)

    def cut(k: Column) -> Column:
        at = F.regexp_instr(F.substring(text, k * size + 1, n), F.lit(NO_TERM))
        return F.when(k == 0, F.lit(1)).when(at == 0, n + 1).otherwise(k * size + at)

    cuts = F.transform(F.sequence(F.lit(0), F.floor(n / F.lit(size)).cast("int") + 1), lambda k: F.least(cut(k), n + 1))
    return F.transform(F.sequence(F.lit(1), F.size(cuts) - 1), lambda k: F.substring(text, F.get(cuts, k - 1), F.get(cuts, k) - F.get(cuts, k - 1)))


def _terms(text: str = "text") -> Column:
    return F.regexp_extract_all(text, F.lit(TERM), F.lit(0))


def term_counts(docs: DataFrame, piece: int = PIECE) -> DataFrame:
    """lang, source, term, occurrences, docs: how often a term is in a group and in how many of its documents (rows)."""
    rows = only(docs, "text", "lang", "source").select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")], F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("lang", "source", F.octet_length("text").alias("bytes"), lowered(F.col("text")).alias("text"))
    # A text's terms are exploded, and its distinct ones after them, which count its documents.
    short = rows.where(F.col("bytes") <= piece).select("lang", "source", _terms().alias("terms"))
    short = short.select("lang", "source", F.size("terms").alias("n"), F.posexplode(F.concat("terms", F.array_distinct("terms"))).alias("at", "term"))
    again = F.col("at") >= F.col("n")
    short = short.select("lang", "source", "term", F.when(again, 0).otherwise(1).cast("bigint").alias("here"), F.when(again, 1).otherwise(0).cast("bigint").alias("d"))
    # A longer text is exploded piece by piece, and its own counts are made first.
    long = rows.where(F.col("bytes") > piece).withColumn("number", F.monotonically_increasing_id())
    long = long.select("lang", "source", "number", F.explode(pieces(F.col("text"), piece)).alias("text"))
    long = long.select("lang", "source", "number", F.explode(_terms()).alias("term")).groupBy("lang", "source", "number", "term").agg(F.count(F.lit(1)).alias("here"))
    both = short.union(long.select("lang", "source", "term", "here", F.lit(1).cast("bigint")))
    return both.groupBy("lang", "source", "term").agg(F.sum("here").alias("occurrences"), F.sum("d").alias("docs"))


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (count + 2) / (total + 2 kept)), in whole numbers of up to 38 digits."""
    top = F.lit(PARTS).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)")
    return F.lit(1).cast("bigint") + F.call_function("div", top, (total + 2 * kept).cast("decimal(20,0)"))


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); shares stay under 2^31, so that nothing overflows."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, term_ranks: int = TERM_RANKS, piece: int = PIECE) -> DataFrame:
    """lang, source, part, item, value, rank of every (lang, source) group that occurs.

    A null text, lang or source is an empty one; each row is a document of its own, repeated rows and rows that share an
    id included. A language keeps the terms in at least ``least_docs`` of its documents; each of its groups, and the
    language as a whole, gives each of them a smoothed share. Part ``pair`` has each other source of the language with the
    summed gaps of all kept terms (0 without any), all of them; part ``term`` the ``term_ranks`` terms whose share in
    the group exceeds the language's most. Ties are ranked by the item's bytes. A group alone in its language has no
    pairs. No rows give no rows. Texts over ``piece`` bytes are cut between terms, which changes no count.
    """
    spark = docs.sparkSession
    counts = stash(term_counts(docs, piece))
    groups = only(docs, "lang", "source").select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    kept = counts.groupBy("lang", "term").agg(F.sum("occurrences").alias("lang_count"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs).drop("docs")
    kept = stash(kept)
    totals = kept.groupBy("lang").agg(F.sum("lang_count").alias("lang_total"), F.count(F.lit(1)).alias("kept"))
    own = counts.join(kept.select("lang", "term"), ["lang", "term"], "left_semi")
    own_totals = own.groupBy("lang", "source").agg(F.sum("occurrences").alias("total"))
    groups = groups.join(own_totals, ["lang", "source"], "left").join(totals, "lang", "left").na.fill(0)
    groups = stash(groups)

    # Few languages hold all groups and all terms: terms are dealt by a salt, and groups copied for each salt.
    size = groups.agg(F.sum("kept").alias("n")).first()["n"] or 0
    salts = max(1, -(-size // DENSE_ROWS))
    salt = F.pmod(F.xxhash64("term"), F.lit(salts))
    cells = groups.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))).join(kept.withColumn("salt", salt), ["lang", "salt"])
    cells = cells.join(own.select("lang", "source", "term", "occurrences"), ["lang", "source", "term"], "left").withColumn("occurrences", F.coalesce("occurrences", F.lit(0)))
    dense = stash(
        cells.select(
            "lang", "source", "term", "occurrences",
            share(F.col("occurrences"), F.col("total"), F.col("kept")).alias("p"), share(F.col("lang_count"), F.col("lang_total"), F.col("kept")).alias("q"),
        )
    )

    one, two = dense.select("lang", "term", "source", "p"), dense.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("p2"))
    sums = one.join(two, ["lang", "term"]).where("source < item").groupBy("lang", "source", "item").agg(F.sum(gap(F.col("p"), F.col("p2"))).alias("value"))
    sums = stash(sums)
    empty = groups.where("kept = 0").select("lang", "source")
    zeros = empty.join(empty.select("lang", F.col("source").alias("item")), "lang").where("source <> item").select("lang", "source", "item", F.lit(0).cast("bigint").alias("value"))
    pairs = sums.union(sums.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")).union(zeros)

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order)
    terms = dense.where("occurrences > 0 and p > q").select("lang", "source", F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))
    terms = terms.withColumn("rank", rank).where(F.col("rank") <= term_ranks)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("rank", rank).withColumn("part", F.lit("pair")).select(*columns).union(terms.withColumn("part", F.lit("term")).select(*columns))
