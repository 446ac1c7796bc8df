"""License scans by diagonal voting.

Texts and templates are words of letters and digits, A-Z lower-cased. Spark
joins every pair of consecutive words of every text, by a hash and then by the
words themselves, to the pairs of the templates, a table of fixed size. A pair
found at word p of a text and word t of a template votes for the diagonal
p - t and covers two words of the template. Each diagonal is merged with those
up to ``DRIFT`` away, which bridges inserted and missing words, and the merged
span is verified: it counts if it covers ``COVER`` of its template, however its
words are spread over the diagonals. Of spans up to ``DRIFT`` apart the one that
covers most counts, then the one with most words on its own diagonal, then the
smallest diagonal.

Base phrases must stand word for word, that is, one diagonal must cover them
wholly; all their places are counted. Null counts as an empty text. Every row
gives one row, whatever its id; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .packing import block_numbers, partitions
from .text import ALNUM, blocks, bound_batches, mix, numbered, output, words

DRIFT = 2
COVER = 0.8
LONGEST = 62  # words of a template: covered words are the bits of a long

# Phrases and their labels.
BASE = [
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
]
# Notices of public licenses and their labels.
NOTICES = [
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "gnu lesser general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights"),
    ("public-domain", "this work is in the public domain"),
]


def _word_hashes(distinct: pa.LargeBinaryArray) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w) for w in distinct.to_pylist()), np.uint64, len(distinct))


def _pair_hashes(hashes: np.ndarray) -> np.ndarray:
    """Of each word and the next; the last word's is of no account."""
    following = np.roll(hashes, -1)
    return mix(hashes * np.uint64(0x9E3779B97F4A7C15) + following).view(np.int64)


def templates(spark: SparkSession, base=BASE, notices=NOTICES) -> DataFrame:
    """(hash, word, next, template, at, words, label, base) of each pair."""
    rows = []
    for number, (label, text) in enumerate([*base, *notices]):
        spelt = text.split()
        if not 2 <= len(spelt) <= LONGEST:
            raise ValueError(f"a template has 2 to {LONGEST} words: {text}")
        distinct = pa.array([w.encode() for w in spelt], pa.large_binary())
        hashes = _pair_hashes(_word_hashes(distinct))
        for at in range(len(spelt) - 1):
            rows.append((int(hashes[at]), spelt[at], spelt[at + 1], number, at, len(spelt), label, number < len(base)))
    return spark.createDataFrame(
        rows, "hash long, word string, next string, template int, at int, words int, label string, base boolean"
    )


def pairs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, at, hash, word, next, id): every pair of consecutive words of every
    row, and for each row one with ``at`` = -1 - its number of words. ``row``
    numbers the rows of this evaluation."""
    bound_batches(docs.sparkSession)
    result = pa.schema(
        [
            ("row", pa.int64()),
            ("at", pa.int32()),
            ("hash", pa.int64()),
            ("word", pa.string()),
            ("next", pa.string()),
            ("id", pa.int64()),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = next(block_numbers())
        for rows in blocks(batches, "text"):
            found = words(rows["text"], ALNUM, lower=True)
            counts = np.diff(found.first)
            n = rows.num_rows
            yield output(
                result,
                row=np.arange(start, start + n),
                at=-1 - counts,
                hash=pa.nulls(n, pa.int64()),
                word=pa.nulls(n, pa.string()),
                next=pa.nulls(n, pa.string()),
                id=rows["id"].combine_chunks(),
            )
            if len(found) > 1:
                values = found.values()
                distinct, codes = numbered(values)
                hashes = _pair_hashes(_word_hashes(distinct)[codes])[:-1]
                owner = found.owner()
                spelt = values.cast(pa.large_string()).cast(pa.string())
                table = pa.RecordBatch.from_arrays(
                    [
                        pa.array(start + owner[:-1]),
                        pa.array((np.arange(len(codes)) - found.first[owner])[:-1].astype(np.int32)),
                        pa.array(hashes),
                        spelt.slice(0, len(codes) - 1),
                        spelt.slice(1),
                        pa.nulls(len(codes) - 1, pa.int64()),
                    ],
                    schema=result,
                )
                last = np.flatnonzero(np.diff(owner))  # the pair crosses two texts
                yield table.filter(pa.array(~np.isin(np.arange(len(codes) - 1), last))) if len(last) else table
            start += n

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        cut, "row long, at int, hash long, word string, next string, id long"
    )


def scan(
    docs: DataFrame, base=BASE, notices=NOTICES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_words, spans) of each row; ``spans`` lists (label, template, base,
    first, cover): the verified places, the first word's number from 0, and the
    share of the template that is covered."""
    spark = docs.sparkSession
    known = F.broadcast(templates(spark, base, notices).withColumnRenamed("at", "t"))  # as large as the templates
    met = (
        pairs(docs, id_col, text_col)
        .join(known, ["hash", "word", "next"], "left")
        .filter("at < 0 or template is not null")
        .select("row", "at", "id", "template", "t", "words", "label", "base")
        .repartition(partitions(spark), "row")
    )
    bit = F.expr("shiftleft(3L, t)")
    votes = met.groupBy("row", "template", (F.col("at") - F.col("t")).alias("diagonal")).agg(
        F.max("id").alias("id"),
        F.min("at").alias("least"),
        F.bit_or(bit).alias("covered"),
        F.first("words").alias("words"),
        F.first("label").alias("label"),
        F.first("base").alias("base"),
    )
    near = Window.partitionBy("row", "template").orderBy("diagonal").rangeBetween(-DRIFT, DRIFT)
    own = F.bit_count("covered")
    merged = F.when(F.col("base"), own).otherwise(F.bit_count(F.bit_or("covered").over(near)))
    rank = F.struct("merged", "own", -F.col("diagonal"))
    spans = votes.withColumns({"own": own, "merged": merged}).select(
        "row",
        "id",
        "least",
        "template",
        "label",
        "base",
        F.greatest("diagonal", F.lit(0)).alias("first"),
        (F.col("merged") / F.col("words")).alias("cover"),
        # of merged diagonals one stands for all
        F.when(F.col("base"), F.col("own") == F.col("words")).otherwise(rank == F.max(rank).over(near)).alias("leads"),
    )
    span = F.struct("label", "template", "base", "first", "cover")
    counts = F.col("template").isNull()
    return spans.groupBy("row").agg(
        F.max(F.when(counts, F.col("id"))).alias(id_col),
        F.max(F.when(counts, -1 - F.col("least"))).cast("long").alias("n_words"),
        F.collect_list(F.when(~counts & F.col("leads") & (F.col("cover") >= COVER), span)).alias("spans"),
    ).drop("row")


def report(docs: DataFrame) -> DataFrame:
    """The digest columns of each document."""
    found = scan(docs)
    base = F.filter("spans", lambda s: s["base"])
    places = F.transform(base, lambda s: s["first"].cast("long"))

    def joined(spans):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["cover"])), F.lit(0.0)).alias("score"),
    )
