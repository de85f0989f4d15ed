"""License scan by diagonal voting (native: DataFrame functions only).

Every rolling word k-gram of every text is hashed and equi-joined to the k-gram positions of a few license templates
(a literal table: its size is fixed by the templates, so it is broadcast). A hit at word ``pos`` of the text and
``tpos`` of the template votes for the diagonal ``pos - tpos``. Votes are counted per (row, template, diagonal);
diagonals at most ``slack`` apart are merged, which bridges inserted or missing words; a merged span is kept when
enough of the template's k-grams voted for it. Base phrases ask for all their k-grams on a single diagonal, so they
are found exactly where the phrase's words stand consecutively.

Null texts count as empty; empty texts and texts of one word have no spans and give a row with zero counts. Repeated
rows stay apart. Extra columns are ignored, and an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import inline_table, pair_words, row_id, text_of, word_array


@dataclass(frozen=True)
class Template:
    label: str
    words: str
    base: bool = False


#: Base phrases (fixed values of the contract) and notices that the method looks for with tolerance.
TEMPLATES = (
    Template("gpl", "gnu general public license", True),
    Template("apache", "apache license", True),
    Template("cc-by", "cc by", True),
    Template("mit", "mit license", True),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    Template("lgpl", "gnu lesser general public license"),
    Template("agpl", "gnu affero general public license"),
    Template("apache-2.0", "licensed under the apache license version 2 0"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license"),
    Template("cc-by-nc", "licensed under cc by nc"),
    Template("cc-by-sa", "licensed under cc by sa"),
    Template("cc-by-nd", "licensed under cc by nd"),
    Template("cc0", "cc0 1 0 universal public domain dedication"),
    Template("reserved", "all rights reserved"),
)
K = 2


def license_spans(docs: DataFrame, templates=TEMPLATES, k: int = K, slack: int = 3, min_cover: float = 0.8,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per verified span: row, doc_id, n_words, label, base, start (word), n_template_words, votes, cover;
    rows without any span are kept once with a null label, so a report needs no second pass over the texts."""
    if any(len(t.words.split()) < k for t in templates):
        raise ValueError(f"every template needs at least {k} words")
    spark = docs.sparkSession
    cells = [(n, t.label, t.base, len(t.words.split()) - k + 1, p, *t.words.split()[p:p + k])
             for n, t in enumerate(templates) for p in range(len(t.words.split()) - k + 1)]
    names = ["tpl", "label", "base", "grams", "tpos"] + [f"w{j}" for j in range(k)]
    positions = inline_table(spark, cells, names).select(
        F.xxhash64(*[f"w{j}" for j in range(k)]).alias("h"), *names[:5])
    tokens = docs.select(row_id().alias("row"), F.col(id_col).alias("doc_id"), word_array(text_of(text_col)).alias("words"))
    grams = tokens.select("row", "doc_id", F.size("words").alias("n_words"), pair_words("words", k).alias("grams_"))
    hits = grams.select("row", "doc_id", "n_words", F.posexplode_outer("grams_").alias("pos", "h")).join(
        F.broadcast(positions), "h", "left")
    # bits of the template's k-grams that voted: one that votes again on a near diagonal covers nothing more
    words = range(max((len(t.words.split()) - k for t in templates), default=0) // 63 + 1)
    places = [F.bit_or(F.when(F.floor(F.col("tpos") / 63) == w, F.call_function("shiftleft", F.lit(1).cast("long"), F.col("tpos") % 63))).alias(f"bits{w}")
              for w in words]
    votes = hits.groupBy("row", "doc_id", "n_words", "tpl", "label", "base", "grams",
                         (F.col("pos") - F.col("tpos")).alias("diagonal")).agg(F.count("tpos").alias("votes"), *places)
    # exact phrases need all their votes at once; a lone vote of a notice counts if its span is covered
    kept = votes.where(F.col("tpl").isNull() | ~F.col("base") | (F.col("votes") == F.col("grams")))
    order = Window.partitionBy("row", "tpl").orderBy("diagonal")
    step = F.col("diagonal") - F.lag("diagonal").over(order)
    marked = kept.withColumn("opens", F.when(F.col("base") | step.isNull() | (step > slack), 1).otherwise(0))
    merged = marked.withColumn("span", F.sum("opens").over(order)).groupBy(
        "row", "doc_id", "n_words", "tpl", "label", "base", "grams", "span").agg(
        F.greatest(F.min("diagonal"), F.lit(0)).cast("long").alias("start"), F.sum("votes").alias("votes"),
        sum((F.bit_count(F.coalesce(F.bit_or(f"bits{w}"), F.lit(0).cast("long"))) for w in words), F.lit(0)).alias("covered"))
    cover = F.col("covered") / F.col("grams")
    verified = F.col("tpl").isNotNull() & (cover >= min_cover)
    return merged.select(
        "row", "doc_id", F.col("n_words").cast("long").alias("n_words"),
        *[F.when(verified, F.col(c)).alias(c) for c in ("label", "base", "start")],
        F.when(verified, F.col("grams") + (k - 1)).alias("n_template_words"),
        F.when(verified, F.col("votes")).alias("votes"), F.when(verified, cover).alias("cover"))


def license_report(docs: DataFrame, **options) -> DataFrame:
    """One row per document: counts and places of base phrases, labels, and the best cover as the score."""
    spans = license_spans(docs, **options)
    base = F.col("label").isNotNull() & F.col("base")
    joined = lambda keep: F.array_join(F.array_sort(F.collect_set(F.when(keep, F.col("label")))), ",")
    return spans.groupBy("row", "doc_id", "n_words").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.col("label").isNotNull()).alias("labels"),
        F.coalesce(F.max("cover"), F.lit(0.0)).alias("score"),
    ).drop("row")
