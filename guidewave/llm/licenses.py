"""License scans by diagonal voting, in DataFrame operations only.

All rolling word k-gram hashes of the documents are joined to the places of the
same k-grams in license templates.  A match votes for its diagonal (place in the
document minus place in the template); neighbouring diagonals, which a few
inserted or missing words shift, are merged, and a merged span stands if it
covers enough of its template.  Grams are compared word by word, so a hash
collision casts no vote.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .textruns import texts_of

GRAM = 2
#: share of a template's grams that a span must hold
COVERED = 0.6
#: words by which the diagonals of one span may drift from one to the next
DRIFT = 3


@dataclass(frozen=True)
class Template:
    """A base template counts where its words stand consecutively; the others may be worn."""

    label: str
    words: str
    base: bool = False


# fixed values: base phrases, then phrases of well-known licenses, in our own cut
TEMPLATES = (
    Template("cc-by", "cc by", True),
    Template("gpl", "general public license", True),
    Template("reserved", "all rights reserved", True),
    Template("apache", "licensed under the apache license version 2 0"),
    Template("cc-by-nc", "licensed under cc by nc 4 0"),
    Template("gnu-gpl-3", "this work is licensed under the gnu general public license version 3"),
    Template("mit", "released under the mit license"),
    Template("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license"),
    Template("copyright", "this work is protected by copyright"),
)

_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: gram position and template of the row that stands for the document itself
_SELF = -1


def words_of(text: Column) -> Column:
    """Words of a text, lower-cased in A-Z."""
    return F.filter(F.split(F.translate(text, _UPPER, _LOWER), _NOT_WORD), lambda w: w != "")


def template_grams(spark, templates: tuple[Template, ...], gram: int = GRAM) -> DataFrame:
    """(template, place, first, second, hash): every gram of every template; as many rows as the templates have words."""
    rows = []
    for k, t in enumerate(templates):
        words = t.words.split()
        rows += [(k, i, words[i : i + gram]) for i in range(len(words) - gram + 1)]
    frame = spark.createDataFrame(rows, "template int, place int, words array<string>")
    return frame.select("template", "place", F.col("words").alias("gram"), _hash(F.col("words"), F.lit(0), gram).alias("hash"))


def _hash(words: Column, at: Column, gram: int) -> Column:
    return F.xxhash64(*[F.get(words, at + k) for k in range(gram)])


def votes(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, gram: int = GRAM) -> DataFrame:
    """(row, doc_id, n_words, template, diagonal, hits, least, most): votes per document, template and diagonal.

    hits, least and most are the number, first and last of the template places
    hit.  One more row per document, of template -1, keeps documents without
    any vote and carries their number of words.
    """
    spark = docs.sparkSession
    marker = F.lit(0).cast("long")
    counted = texts_of(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", words_of(F.col("text")).alias("words"))
    hashes = F.transform(F.sequence(F.lit(0), F.size("words") - gram), lambda i: _hash(F.col("words"), i, gram))
    hashes = F.when(F.size("words") >= gram, hashes).otherwise(F.array().cast("array<long>"))
    grams = counted.select("row", "doc_id", "words", F.posexplode(F.concat(F.array(marker), hashes)).alias("at", "hash"))
    own = template_grams(spark, templates, gram)
    self_row = spark.createDataFrame([(_SELF, 0, [])], "template int, place int, gram array<string>").withColumn("hash", marker)
    # the templates are a fixed list, so the table of their grams may be broadcast at any size of the corpus
    met = grams.join(F.broadcast(own.unionByName(self_row)), "hash")
    real = (F.col("template") >= 0) & (F.col("at") > 0) & (F.slice("words", F.greatest(F.col("at"), F.lit(1)), gram) == F.col("gram"))
    met = met.where(((F.col("template") == _SELF) & (F.col("at") == 0)) | real)
    return (met.groupBy("row", "doc_id", "template", (F.col("at") - 1 - F.col("place")).alias("diagonal"))
            .agg(F.first(F.size("words")).alias("n_words"), F.count("*").alias("hits"), F.min("place").alias("least"), F.max("place").alias("most")))


def spans(voted: DataFrame, templates: tuple[Template, ...] = TEMPLATES, gram: int = GRAM, covered: float = COVERED, drift: int = DRIFT) -> DataFrame:
    """(row, doc_id, n_words, template, first_word, last_word, coverage): merged diagonals that cover enough, and the documents' own rows.

    Diagonals at most ``drift`` apart belong together if the later one goes on
    in the template where the earlier one stopped; a full diagonal stands alone.
    """
    lengths = voted.sparkSession.createDataFrame([(k, len(t.words.split()) - gram + 1, t.base) for k, t in enumerate(templates)] + [(_SELF, 1, True)], "template int, n_grams int, base boolean")
    own = voted.join(F.broadcast(lengths), "template")
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    full = F.col("hits") == F.col("n_grams")
    joins = (F.col("diagonal") - F.lag("diagonal").over(order) <= drift) & (F.col("least") > F.lag("most").over(order)) & ~F.lag(full).over(order) & ~full & ~F.col("base")
    placed = own.withColumn("group", F.sum(F.when(F.coalesce(joins, F.lit(False)), 0).otherwise(1)).over(order))
    merged = (placed.groupBy("row", "doc_id", "template", "group")
              .agg(F.max("n_words").alias("n_words"), F.min(F.col("diagonal") + F.col("least")).alias("first_word"), F.max(F.col("diagonal") + F.col("most") + gram - 1).alias("last_word"),
                   (F.sum("hits") / F.first("n_grams")).alias("coverage"), F.first("base").alias("base")))
    return merged.where((F.col("template") == _SELF) | F.when(F.col("base"), F.col("coverage") == 1).otherwise(F.col("coverage") >= covered)).drop("group")


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """(doc_id, n_words, found): for every row of ``docs`` its license spans.

    found is an array of (label, base, first_word, last_word, coverage), words
    counted from 0.  Null texts are empty and have no words; repeated rows stay
    apart; other columns are left out; an empty table gives no rows.
    """
    spark = docs.sparkSession
    names = spark.createDataFrame([(k, t.label) for k, t in enumerate(templates)], "template int, label string")
    found = spans(votes(docs, templates), templates).join(F.broadcast(names), "template", "left")
    span = F.when(F.col("template") >= 0, F.struct("label", "base", "first_word", "last_word", "coverage"))
    return found.groupBy("row", "doc_id").agg(F.max("n_words").cast("long").alias("n_words"), F.array_sort(F.collect_list(span)).alias("found")).drop("row")
