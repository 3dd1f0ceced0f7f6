"""Licence scan by canonical digests.

A text is reduced to a canonical form: lower case, copyright lines left out,
equivalent spellings made one, every run of other characters than letters and
digits a space. Whole texts, and each of their lines, are hashed and joined to
the digests of known licences and notices, whose forms are made the same way.
A whole text that is no known one in this form is
held against them once more without lines that start with copyright and name a
holder, "all rights reserved" and list markers; texts without any word that a
known second form needs are left out of that. All of it is column expressions; the known digests are broadcast when they are
counted to be few.

Defined results: null or empty texts, and texts of copyright lines alone, match
nothing; equal lines of a document are found each; rows that repeat an id are
scanned each; an empty table gives no rows; columns other than id and text are
ignored.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, functions as F

from tickspan.llm.licence_texts import FULL, KNOWN
from tickspan.llm.quality import let
from tickspan.session import cut_lineage

BROADCAST_KNOWN = 100_000
#: Equivalent spellings, applied in this order to known and scanned texts alike.
SPELLINGS = (("licenc", "licens"), ("copyright owner", "copyright holder"), ("per cent", "percent"),
             ("non commercial", "noncommercial"), ("sub licens", "sublicens"), ("gement", "gment"), ("fulfill", "fulfil"),
             ("whilst", "while"), ("isation", "ization"), ("favour", "favor"), ("behaviour", "behavior"),
             ("analogue", "analog"), ("https", "http"))
#: A copyright line names a year or a holder after the word, or a year after the sign: "(c)" alone is also a list marker.
COPYRIGHT = (r"^[^\p{L}\p{N}\n]*(?:\([c]\)[ \t]*(?:[0-9]{4}|copyright[ \t]*(?:[0-9]|<|\[))|\x{A9}|"
             r"copyright[ \t]*(?:\(c\)|\x{A9}|[0-9]|by\b|the\b|<|\[))[^\n]*")
#: What the second form of whole texts leaves out, before lower-casing: lines of "copyright" and a name. Prose that wraps
#: after "copyright" goes on in small letters or with one of these.
HOLDER = (r"(?m)^[^\p{L}\p{N}\n]*(?:\([cC]\)[ \t]*)?(?:(?i:copyright)|\x{A9})[ \t]*:?[ \t]*(?=\p{Lu}|[0-9])"
          r"(?!(?i:holder|owner|notice|licen|interest|statement|protect|permission|right|infring|disclaim|material|assign|grant|claim|"
          r"doctrine|restriction|condition|treat|office|status|(?:and|or|in|of|to|is|as|are|on|law|act|by[ \t]+the|applies|for|under|work|"
          r"works|term|terms|if|that|which|with|may|shall|must|will|you|we|all|any|no|not|it|its|this|these|from|be|has)\b))[^\n]*")
RESERVED = r"all[ \t\n]+rights[ \t\n]+reserved\b"
#: Known forms up to which words are sought that every one of them holds one of.
ANCHORED = 1_000
MARKER = r"(?m)^[ \t]*(?:[-*+\x{2022}]|\(?(?:[0-9]{1,2}|[a-z]|[ivx]{1,4})[.)])(?=[ \t])"


def canonical(text: Column) -> Column:
    """The canonical form, lines kept apart."""
    form = F.regexp_replace(F.lower(text), "(?md)" + COPYRIGHT, "")
    form = F.regexp_replace(form, r"[^\p{L}\p{N}\n]+", " ")
    for a, b in SPELLINGS:
        form = F.replace(form, F.lit(a), F.lit(b))
    return form


def bare(text: Column) -> Column:
    """The second canonical form, of a whole text, in one line."""
    form = F.lower(F.regexp_replace(text, HOLDER, ""))
    for what in (RESERVED, MARKER):
        form = F.regexp_replace(form, what, "")
    return one_line(canonical(form))


def one_line(form: Column) -> Column:
    return F.trim(F.regexp_replace(form, r"[ \n]+", " "))


def known_digests(known: DataFrame) -> DataFrame:
    """``license, digest, bare`` of texts in ``license, text``; equal forms once."""
    forms = F.array(F.struct(F.lit(False).alias("bare"), one_line(canonical(F.col("text"))).alias("form")),
                    F.struct(F.lit(True).alias("bare"), bare(F.col("text")).alias("form")))
    return (known.select("license", F.inline(forms)).where("form <> ''")
            .groupBy(F.sha2("form", 256).alias("digest"), "bare").agg(F.min("license").alias("license")))


def anchors(forms: list[str]) -> list[str]:
    """Words of which every form holds one, long ones first: few, so that most
    texts need not be brought into the second form."""
    left, out = [{w for w in f.split() if len(w) > 6} or set(f.split()) for f in forms], []
    while left:
        often = Counter(w for words in left for w in words)
        best = max(sorted(often), key=often.__getitem__)
        out.append(best)
        left = [words for words in left if best not in words]
    return out


def scan(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per match: ``<id>, scope`` (text or line), ``line`` (from 1; 0
    for the whole text), ``license, digest``. ``known``: ``license, text``, in
    place of the texts held here."""
    spark = docs.sparkSession
    if known is None:
        known = spark.createDataFrame([*KNOWN, *FULL], "license string, text string")
    digests = cut_lineage(known_digests(known))
    n = digests.count()
    if n <= BROADCAST_KNOWN:
        digests = F.broadcast(digests)
    may = lambda f: F.lit(True)
    if n <= ANCHORED:
        # A text's second form holds only words that its first form holds as well.
        held = anchors([r[0] for r in known.select(bare(F.col("text"))).distinct().collect() if r[0]])
        may = lambda f: F.exists(F.lit(held) if held else F.array().cast("array<string>"), lambda a: F.contains(f, a))
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                      F.monotonically_increasing_id().alias("_row"))
    # The whole text twice, then its lines.
    units = let(canonical(F.col("text")), lambda f: F.concat(
        F.array(one_line(f), F.when(may(f), bare(F.col("text"))).otherwise("")), F.transform(F.split(f, "\n"), lambda x: F.trim(x))))
    rows = src.select("_row", "id", F.posexplode(units).alias("at", "form")).where("form <> ''")
    found = rows.select("_row", "id", F.greatest(F.col("at") - 1, F.lit(0)).alias("line"), (F.col("at") == 1).alias("bare"),
                        F.sha2("form", 256).alias("digest")).join(digests, ["digest", "bare"])
    best = found.groupBy("_row", "id", "line").agg(F.min(F.struct("bare", "license", "digest")).alias("m"))
    return best.select(F.col("id").alias(id_col), F.when(F.col("line") == 0, "text").otherwise("line").alias("scope"),
                       F.col("line").cast("long").alias("line"), "m.license", "m.digest")
