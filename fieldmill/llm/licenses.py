"""License phrases and templates in texts, by an exact set-similarity join.

A text is its words; a block is any run of consecutive words as long as a template may stretch.  A
template is found in a block that holds at least its threshold of the template's distinct words (a
base phrase: all of them, then checked word by word).  The words of all templates are ordered by how
often they occur in the whole corpus, rarest first.

* Prefix filter: a block that misses at most m words of a template holds one of its m + 1 rarest.  So
  only places of such words are joined with the templates.
* Length filter: what is left of a text must have as many words as the template needs.
* Positional filter: the words of a block that come after the joined word in the global order, and
  the template's that do, must leave room for the number needed.

Only Spark SQL functions are used.  The templates are a parameter of a few hundred words, so their
tables and the order of their words are literals.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmill.llm.tables import cut

#: what is not a word: ASCII other than digits and lower-case letters
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    #: share of the distinct words that must be there, in percent
    percent: int = 90
    #: the words have to stand consecutively
    phrase: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def distinct(self) -> list[str]:
        return list(dict.fromkeys(self.words))

    @property
    def need(self) -> int:
        return -(-self.percent * len(self.distinct) // 100)

    @property
    def stretch(self) -> int:
        """Words that a block for this template has."""
        return len(self.words) if self.phrase else len(self.words) * 5 // 4


BASE = (
    Template("gpl", "gnu general public license", 100, True),
    Template("apache", "apache license", 100, True),
    Template("cc-by", "cc by", 100, True),
    Template("mit", "mit license", 100, True),
)
NOTICES = (
    Template("gpl-3.0", "licensed under the gnu general public license version 3"),
    Template("gpl-2.0", "licensed under the gnu general public license version 2"),
    Template("lgpl", "licensed under the gnu lesser general public license version"),
    Template("apache-2.0", "licensed under the apache license version 2 0"),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0"),
    Template(
        "mit-text",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files to deal in the software without restriction",
    ),
    Template(
        "bsd-text",
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
    ),
)


def words_of(text: Column) -> Column:
    """The words of a text (null: none), with A-Z lowered."""
    lowered = F.translate(
        F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase
    )
    return F.array_remove(F.split(lowered, BREAK), "")


def _literal(words: list[str]) -> Column:
    return F.array(*map(F.lit, words)) if words else F.array().cast("array<string>")


def word_frequencies(docs: DataFrame, words: list[str]) -> dict[str, int]:
    """How often each of ``words`` stands in all texts."""
    found = (
        docs.select(F.explode(words_of(F.col("text"))).alias("word"))
        .where(F.col("word").isin(words))
        .groupBy("word")
        .count()
        .collect()  # at most one row for each of ``words``
    )
    return dict.fromkeys(words, 0) | {r["word"]: r["count"] for r in found}


def scan(docs: DataFrame, base=BASE, notices=NOTICES) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_words, n_base, first_word, last_word, base_labels, labels
    and score.

    ``n_base`` counts the places of base phrases, ``first_word`` and ``last_word`` are the least and
    greatest word at which one starts (from 0, null without any), ``base_labels`` their labels and
    ``labels`` these with the labels of notices, both distinct, sorted and joined by commas.
    ``score`` is the greatest share of a found template that is there (1 for a base phrase, 0 for
    nothing).  Null and empty texts have no words; null ids and repeated rows are rows like others;
    an empty input gives no rows; other columns are ignored.
    """
    templates = [*base, *notices]
    vocabulary = sorted({w for t in templates for w in t.words})
    count = word_frequencies(docs, vocabulary)
    order = sorted(vocabulary, key=lambda w: (count[w], w))
    rank = {w: k for k, w in enumerate(order)}
    width = max(t.stretch for t in templates)
    rows, prefix = [], set()
    for number, t in enumerate(templates):
        ranked = sorted(t.distinct, key=rank.get)
        for k, word in enumerate(ranked[: len(ranked) - t.need + 1]):
            prefix.add(word)
            rows.append((word, number, t.label, t.phrase, t.words, t.distinct, t.need, t.stretch,
                         t.words.index(word), k, rank[word]))
    joined = docs.sparkSession.createDataFrame(
        rows,
        "word string, template int, label string, phrase boolean, words array<string>,"
        " tokens array<string>, need int, stretch int, offset int, place int, rank int",
    )

    # places of prefix words, each with the words around it
    read = docs.select("doc_id", words_of(F.col("text")).alias("w"))
    places = F.array_compact(
        F.transform("w", lambda x, i: F.when(x.isin(sorted(prefix)), i))
    )
    read = read.select("doc_id", F.size("w").cast("long").alias("n_words"), "w", places.alias("at"))
    begin = lambda p: F.greatest(p - (width - 1), F.lit(0))
    blocks = F.transform(
        "at",
        lambda p: F.struct(
            p.alias("at"),
            begin(p).alias("begin"),
            F.slice("w", begin(p) + 1, p - begin(p) + width).alias("near"),
        ),
    )
    read = cut(
        read.select(
            F.monotonically_increasing_id().alias("row"), "doc_id", "n_words", blocks.alias("blocks")
        )
    )

    near, at = F.col("near"), F.col("at") - F.col("begin")
    candidates = (
        read.select("row", F.explode("blocks").alias("b"))
        .select("row", "b.*")
        .withColumn("word", F.element_at(near, at + 1))
        .join(F.broadcast(joined), "word")
    )
    known = _literal(order)
    later = F.filter(
        F.array_distinct(F.array_intersect(near, known)),
        lambda x: F.array_position(known, x) - 1 > F.col("rank"),
    )
    room = 1 + F.least(F.size("tokens") - F.col("place") - 1, F.size(later)) + F.col("place")
    candidates = candidates.where(F.size(near) >= F.col("need")).where(room >= F.col("need"))

    start = at - F.col("offset")
    stands = (
        F.when(start >= 0, F.slice(near, F.greatest(start, F.lit(0)) + 1, F.size("words")))
        == F.col("words")
    )
    bases = candidates.where("phrase").where(F.coalesce(stands, F.lit(False)))
    bases = bases.select(
        "row",
        "label",
        F.lit(True).alias("base"),
        (F.col("begin") + start).cast("long").alias("start"),
        F.lit(1.0).alias("share"),
    )
    # the best block holding the word starts with a word of the template
    starts = F.filter(
        F.sequence(F.greatest(at - F.col("stretch") + 1, F.lit(0)), at),
        lambda s: F.array_contains(F.col("tokens"), F.element_at(near, s + 1)),
    )
    overlap = F.array_max(
        F.transform(
            starts,
            lambda s: F.size(
                F.array_intersect(F.slice(near, s + 1, F.col("stretch")), F.col("tokens"))
            ),
        )
    )
    found = candidates.where("not phrase").withColumn("overlap", overlap)
    found = found.where("overlap >= need").select(
        "row",
        "label",
        F.lit(False).alias("base"),
        F.lit(None).cast("long").alias("start"),
        (F.col("overlap") / F.size("tokens")).alias("share"),
    )
    base_label = F.when(F.col("base"), F.col("label"))
    found = (
        bases.union(found)
        .groupBy("row")
        .agg(
            F.count_if("base").alias("n_base"),
            F.min("start").alias("first_word"),
            F.max("start").alias("last_word"),
            F.array_join(F.array_sort(F.collect_set(base_label)), ",").alias("base_labels"),
            F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
            F.max("share").alias("score"),
        )
    )
    empty = F.lit("")
    return read.select("row", "doc_id", "n_words").join(found, "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", empty).alias("base_labels"),
        F.coalesce("labels", empty).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
