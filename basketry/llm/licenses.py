"""License scan by diagonal voting, in DataFrame functions only.

Every rolling word k-gram of every text is hashed and joined with the k-gram
positions of the license templates (a fixed table, so it is broadcast). A match
at text word ``pos`` and template word ``tpos`` votes for the diagonal
``pos - tpos``: all k-grams of one copy of a template lie on one diagonal, and a
copy with words inserted or left out on a few neighbouring ones. Votes are
summed per diagonal, neighbouring diagonals are merged to candidate spans, and a
span counts if it covers enough of its template. A span with fewer k-grams, down
to one, counts if the words around one of its diagonals hold enough of the
template's words in order. A phrase that must stand word for word counts where
one diagonal holds all its k-grams consecutively.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.llm.common import ascii_lower, materialise, small, text_or_empty

K = 3
#: diagonals this many words apart belong to one copy of a template
MAX_SHIFT = 3
#: share of a template's k-grams that a span must hold, or of its words in order
MIN_SCORE = 0.75
_SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# fixed values: phrases that must stand word for word, and their labels
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
# fixed values: public license wordings found by similarity, and their labels
TEMPLATES = (
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2-notice", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
)


def words_of(name: str = "text") -> Column:
    """Words of the lower-cased text; none for a null or empty text."""
    return F.filter(F.split(ascii_lower(text_or_empty(name)), _SEPARATOR), lambda w: w != "")


def template_grams(spark: SparkSession, k: int = K) -> DataFrame:
    """``label, exact, grams, tpos, hash, w1..wk``: one row per template k-gram."""
    rows = []
    for exact, entries in ((True, PHRASES), (False, TEMPLATES)):
        for label, text in entries:
            words = text.split()
            if len(words) < k:
                raise ValueError(f"template {label!r} has fewer than {k} words")
            rows += [(label, exact, len(words) - k + 1, i, *words[i : i + k]) for i in range(len(words) - k + 1)]
    names = [f"t{i}" for i in range(k)]
    schema = "label string, exact boolean, grams int, tpos int, " + ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame(rows, schema).withColumn("t_hash", F.xxhash64(*names))


def votes(docs: DataFrame, k: int = K) -> DataFrame:
    """``doc_id, version, label, exact, grams, pos, tpos``: each k-gram of a text
    that stands in a template. ``version`` is a hash of the text."""
    spark = docs.sparkSession
    words = docs.select("doc_id", F.xxhash64(text_or_empty()).alias("version"), words_of().alias("words"))
    shifted = [F.col("words"), *[F.slice("words", F.lit(i + 1), F.greatest(F.size("words") - i, F.lit(0))) for i in range(1, k)]]
    # the last k-grams hold nulls and match nothing; a filter on the words would split every text again
    grams = words.select("doc_id", "version", F.posexplode(F.arrays_zip(*shifted)).alias("pos", "gram"))
    parts = [F.col("gram").getField(name) for name in ("words", *map(str, range(1, k)))]
    grams = grams.select("doc_id", "version", "pos", *[p.alias(f"g{i}") for i, p in enumerate(parts)])
    grams = grams.withColumn("hash", F.xxhash64(*[f"g{i}" for i in range(k)]))
    t = template_grams(spark, k)
    same = F.col("hash") == F.col("t_hash")
    for i in range(k):  # equal hashes of different words are no match
        same = same & (F.col(f"g{i}") == F.col(f"t{i}"))
    return grams.join(F.broadcast(t), same).select("doc_id", "version", "label", "exact", "grams", "pos", "tpos")


_KEY = ["doc_id", "version", "label", "exact"]


def diagonals(votes_: DataFrame) -> DataFrame:
    """``doc_id, version, label, exact, grams, diagonal, hits, count``: one row per diagonal run,
    votes whose words follow each other within a template's length."""
    runs = votes_.withColumn("diagonal", F.col("pos") - F.col("tpos")).groupBy(*_KEY, "grams", "diagonal")
    # a set: repeated rows of one document vote once
    return runs.agg(F.collect_set("tpos").alias("hits")).withColumn("count", F.size("hits"))


def spans(votes_: DataFrame, k: int = K, max_shift: int = MAX_SHIFT, min_score: float = MIN_SCORE) -> DataFrame:
    """``doc_id, version, label, exact, first, last, score, diagonals``: the spans, in words, with their share of k-grams."""
    return spans_of(diagonals(votes_), k, max_shift, min_score)


def spans_of(diagonals: DataFrame, k: int = K, max_shift: int = MAX_SHIFT, min_score: float = MIN_SCORE) -> DataFrame:
    """The spans of these diagonals, which are read more than once."""
    key = _KEY
    exact = diagonals.where(F.col("exact") & (F.col("count") == F.col("grams")))
    exact = exact.select(*key, F.col("diagonal").alias("first"), (F.col("diagonal") + F.col("grams") + (k - 2)).alias("last"), F.lit(1.0).alias("score"), F.array("diagonal").alias("diagonals"))

    order = Window.partitionBy(*key).orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(order)
    fuzzy = diagonals.where(~F.col("exact")).withColumn("new", F.when(gap <= max_shift, 0).otherwise(1))
    fuzzy = fuzzy.withColumn("span", F.sum("new").over(order))
    fuzzy = fuzzy.groupBy(*key, "grams", "span").agg(
        F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits"),
        F.collect_set("diagonal").alias("diagonals"),
        F.min(F.col("diagonal") + F.array_min("hits")).alias("first"),
        F.max(F.col("diagonal") + F.array_max("hits") + (k - 1)).alias("last"),
    )
    fuzzy = fuzzy.withColumn("score", F.size("hits") / F.col("grams")).where(F.col("score") >= min_score)
    return exact.unionByName(fuzzy.select(*key, "first", "last", "score", "diagonals"))


def words_in_order(words: Column, template: Column) -> Column:
    """Length of the longest common subsequence of two arrays of words."""
    cell = lambda row, j: F.coalesce(F.element_at(row, j), F.lit(0))

    def next_row(row: Column, word: Column) -> Column:
        def step(done: Column, j: Column) -> Column:
            same = F.when(F.element_at(template, j) == word, 1).otherwise(0)
            return F.concat(done, F.array(F.greatest(cell(done, F.lit(-1)), cell(row, j + 1), cell(row, j) + same)))

        return F.aggregate(F.sequence(F.lit(1), F.size(template)), F.array(F.lit(0)), step)

    start = F.transform(F.sequence(F.lit(0), F.size(template)), lambda _: F.lit(0))
    return cell(F.aggregate(words, start, next_row), F.lit(-1))


def edited_copies(docs: DataFrame, weak: DataFrame, max_shift: int = MAX_SHIFT, min_score: float = MIN_SCORE) -> DataFrame:
    """``doc_id, version, label, exact, first, score``: the ``weak`` spans whose
    text holds enough of the template's words in order, at most ``max_shift`` words off a diagonal.
    Only texts with such a span are split into words again."""
    templates = F.create_map(*[x for label, text in TEMPLATES for x in (F.lit(label), F.array(*map(F.lit, text.split())))])
    # one row per text, so that it is split into words once, however many spans it has
    weak = weak.groupBy(F.col("doc_id").alias("f_id"), F.col("version").alias("f_version")).agg(
        F.flatten(F.collect_list(F.transform("diagonals", lambda d: F.struct("label", "exact", d.alias("first"))))).alias("weak")
    )
    rows = docs.select("doc_id", F.xxhash64(text_or_empty()).alias("version"), "text")
    rows = rows.join(small(materialise(weak)), F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("version") == F.col("f_version")))
    rows = rows.select("doc_id", "version", "weak", words_of().alias("words"))

    def window(x: Column) -> Column:
        template = F.element_at(templates, x["label"])
        start = F.greatest(x["first"] - max_shift, F.lit(0))
        end = x["first"] + F.size(template) + max_shift
        near = F.slice("words", start + 1, F.greatest(end - start, F.lit(0))).alias("near")
        return F.struct(x["label"].alias("label"), x["exact"].alias("exact"), x["first"].alias("first"), template.alias("template"), near)

    # a diagonal takes along its few words, not the text
    rows = rows.select("doc_id", "version", F.inline(F.transform("weak", window)))
    # no more words stand in order than are there at all
    there = F.size(F.filter("template", lambda w: F.array_contains("near", w)))
    near = rows.where(there >= min_score * F.size("template"))
    scored = near.withColumn("score", words_in_order(F.col("near"), F.col("template")) / F.size("template"))
    return scored.where(F.col("score") >= min_score).select("doc_id", "version", "label", "exact", "first", "score")


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score``.

    ``n_base`` counts the places of the exact phrases, ``first_word`` and
    ``last_word`` are their smallest and largest start. ``labels`` adds those of
    the similar templates; ``score`` is the best share of a template found (1 for
    a phrase, 0 for none): of its k-grams or, where these are too few, of its words
    in order. A null or empty text has no words and no labels.
    Repeated rows each get the same result; null ids are matched like others. An
    empty table gives an empty result; other columns are not read. The work on a
    text grows as its length: a diagonal is checked on the words around it alone.
    """
    # the texts are split and matched once: what is left of them then is small
    every = spans_of(materialise(diagonals(votes(docs))), min_score=0)
    strong = every.where(F.col("score") >= MIN_SCORE).select("doc_id", "version", "label", "exact", "first", "score")
    found = strong.unionByName(edited_copies(docs, every.where(F.col("score") < MIN_SCORE))).groupBy("doc_id", "version").agg(
        F.count_if("exact").alias("n_base"),
        F.min(F.when(F.col("exact"), F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("exact"), F.col("first"))).cast("long").alias("last_word"),
        F.collect_set(F.when(F.col("exact"), F.col("label"))).alias("base"),
        F.collect_set("label").alias("every"),
        F.max("score").alias("score"),
    )
    found = found.withColumnsRenamed({"doc_id": "f_id", "version": "f_version"})
    rows = docs.select("doc_id", F.xxhash64(text_or_empty()).alias("version"), F.size(words_of()).cast("long").alias("n_words"))
    rows = rows.join(found, F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("version") == F.col("f_version")), "left")
    joined = lambda c: F.coalesce(F.array_join(F.array_sort(c), ","), F.lit(""))
    return rows.select(
        "doc_id", "n_words",
        F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
        joined("base").alias("base_labels"), joined("every").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
