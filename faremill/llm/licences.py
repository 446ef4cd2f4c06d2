"""Licence scan: normalised text compared to licence notices and bodies by the Dice coefficient of word bigrams.

Texts are lower-cased and reduced to words of letters and digits, line breaks ignored. Compared with each
template are every window of as many words as the template has (at the end of the text, what is left of
one), the whole text, and each line and sentence by itself.

Two sets of a and b bigrams reach Dice d only if ``a * d <= b * (2 - d)`` and the same the other way round.
So a text must hold ``d / (2 - d)`` of a template's bigrams to match anywhere. An equality join of all
bigrams with the fixed list of templates, which is broadcast (its size is that of the list), and a count
find these texts; only they are read again. In them only windows with so many hits are scored: of the hits
in order, each run of that number within a window's length says where such windows start.

Everything is DataFrame functions; only bigrams that a template holds, and the texts that go on, are shuffled.

Defined results: null and empty texts hold nothing; a text of one word has no bigram and matches nothing;
texts are scanned whole; of several places that match one template the best counts, of equal ones a line or
sentence before a window, then the first line in order of characters and the first window; a line is given as it
stands, a window as its normalised words; repeated rows of one id are reported once; a null id is kept; extra
columns are ignored; an empty table gives an empty result. Bigrams and rows are identified by 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faremill.llm.common import small_side, stored, text_of
from faremill.llm.licence_texts import BODIES

DICE = 80

# fixed values: short notices in common use, by SPDX-like name
NOTICES = {
    "MIT": "Released under the MIT License.",
    "MIT-licensed": "This project is licensed under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
    "LGPL": "This library is licensed under the GNU Lesser General Public License, version 2.1.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license",
    "BSD-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-long": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "proprietary": "All rights reserved.",
}
TEMPLATES = NOTICES | BODIES


def _neighbours(words: Column) -> Column:
    """Hashes of the pairs of neighbouring words, in order."""
    count = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(F.slice(words, F.lit(1), count), F.slice(words, F.lit(2), count), lambda a, b: F.xxhash64(a, b))


def _words(text: Column) -> Column:
    """Words of letters and digits, lower-cased."""
    return F.split(F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), " ")


def notices(spark, listed: dict[str, str] | None = None) -> DataFrame:
    """(notice, length, size, held): of each template the number of bigrams, and the distinct ones."""
    rows = list((listed or TEMPLATES).items())
    frame = spark.createDataFrame(rows, "notice string, body string").withColumn("all", _neighbours(_words(F.col("body"))))
    held = F.array_distinct("all")
    return frame.select("notice", F.size("all").alias("length"), F.size(held).alias("size"), held.alias("held"))


def _needed(size: Column, dice: int) -> Column:
    """The least number of common bigrams with a template of ``size``."""
    return F.ceil(size * dice / (200 - dice)).cast("int")


def _lines(chosen: DataFrame, known: DataFrame, dice: int) -> DataFrame:
    """doc_id, notice, dice, rank and line of the lines, sentences and whole texts that match."""
    lines = F.split("text", "\n")
    sentences = F.flatten(F.transform(lines, lambda x: F.split(x, r"(?<=[.!?;])\s+")))
    cut = F.concat(
        F.transform(F.array_distinct(F.concat(lines, sentences)), lambda x: F.struct(F.lit(0).alias("rank"), x.alias("line"))),
        F.array(F.struct(F.lit(1).alias("rank"), F.col("text").alias("line"))),
    )
    held = chosen.select("doc_id", "able", F.inline_outer(cut)).withColumn("pairs", F.array_distinct(_neighbours(_words(F.col("line")))))
    n, size = F.size("pairs"), F.col("size")
    common = F.size(F.array_intersect("pairs", "held"))
    # n times size: a condition on n alone would be pushed down and work out the bigrams once more
    fits = (n * size > 0) & (n * dice <= size * (200 - dice)) & (size * dice <= n * (200 - dice))
    tried = held.select("doc_id", "rank", "line", "pairs", F.explode("able").alias("own_notice"))
    good = tried.join(F.broadcast(known), (F.col("own_notice") == F.col("notice")) & fits & (common * 200 >= (n + size) * dice))
    return good.select("doc_id", "notice", (2 * common / (n + size)).alias("dice"), "rank", "line")


def _windows(chosen: DataFrame, known: DataFrame, dice: int) -> DataFrame:
    """doc_id, notice, dice, rank and line of each text's best window for each template."""
    one = chosen.withColumn("words", _words(F.col("text"))).withColumn("pairs", _neighbours(F.col("words")))
    one = one.select("doc_id", "words", "pairs", F.explode("able").alias("notice")).join(F.broadcast(known), "notice")
    places = F.filter(F.transform("pairs", lambda h, i: F.when(F.array_contains("held", h), i)), lambda i: i.isNotNull())
    one = one.withColumn("places", places).withColumn("need", _needed(F.col("size"), dice))
    count = F.greatest(F.size("places") - F.col("need") + 1, F.lit(0))
    runs = F.zip_with(
        F.slice("places", F.lit(1), count),
        F.slice("places", F.col("need"), count),
        lambda a, b: F.struct(a.alias("last"), F.greatest(b - F.col("length") + 1, F.lit(0)).alias("first")),
    )
    runs = F.filter(runs, lambda r: r["first"] <= r["last"])
    one = one.withColumn("starts", F.array_distinct(F.flatten(F.transform(runs, lambda r: F.sequence(r["first"], r["last"])))))

    def scored(start: Column) -> Column:
        window = F.array_distinct(F.slice("pairs", start + 1, F.col("length")))
        common, total = F.size(F.array_intersect(window, F.col("held"))), F.size(window) + F.col("size")
        return F.struct(F.when(common * 200 >= total * dice, 2 * common / total).alias("dice"), (-start).alias("first"))

    one = one.withColumn("best", F.array_max(F.transform("starts", scored))).where(F.col("best.dice").isNotNull())
    window = F.slice("words", 1 - F.col("best.first"), F.col("length") + 1)
    return one.select("doc_id", "notice", F.col("best.dice").alias("dice"), F.lit(1).alias("rank"), F.concat_ws(" ", window).alias("line"))


def scan(docs: DataFrame, dice: int = DICE, doc_id: str = "doc_id", text: str = "text", listed: dict[str, str] | None = None) -> DataFrame:
    """doc_id, notice, dice and line of the best match of each template in each document."""
    known = notices(docs.sparkSession, listed)
    source = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    source = source.withColumn("key", F.xxhash64("doc_id", "text"))
    # outer, as Spark puts a filter on the array's size before other explodes, which works out the bigrams once more
    hits = source.select("key", F.explode_outer(F.array_distinct(_neighbours(_words(F.col("text"))))).alias("pair"))
    hits = hits.join(F.broadcast(known.select("notice", "size", F.explode("held").alias("pair"))), "pair")
    # repeated rows count their bigrams again, which only lets more texts through
    able = hits.groupBy("key", "notice").agg(F.count("*").alias("common"), F.first("size").alias("size"))
    able = able.where(F.col("common") >= _needed(F.col("size"), dice)).groupBy("key").agg(F.collect_list("notice").alias("able"))
    chosen = source.join(small_side(stored(able, "licence-candidates")), "key")
    good = _lines(chosen, known, dice).union(_windows(chosen, known, dice))
    best = good.groupBy("doc_id", "notice").agg(F.max("dice").alias("dice"), F.min(F.struct(-F.col("dice"), "rank", "line")).alias("first"))
    return best.select("doc_id", "notice", "dice", F.col("first.line").alias("line"))


def scan_sql(dice: int = DICE) -> str:
    """Lines and sentences against ``NOTICES`` alone, in DuckDB over ``documents``: no windows, whole texts or bodies."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    rows = ", ".join(f"({quoted(name)}, {quoted(body)})" for name, body in NOTICES.items())
    normal = lambda x: f"trim(regexp_replace(lower({x}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
    pairs = lambda x: (
        f"list_distinct([string_split({x}, ' ')[i] || ' ' || string_split({x}, ' ')[i + 1] "
        f"for i in range(1, len(string_split({x}, ' ')))])"
    )
    return f"""
WITH notices AS (SELECT notice, {pairs(normal('body'))} AS pairs FROM (VALUES {rows}) AS v(notice, body)),
lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
parts AS (
  SELECT doc_id, line FROM lines UNION
  SELECT doc_id, unnest(string_split(regexp_replace(line, '([.!?;])[ \\t\\n\\x0b\\f\\r]+', '\\1' || chr(1), 'g'), chr(1))) FROM lines),
held AS (SELECT DISTINCT doc_id, line, {normal('line')} AS plain FROM parts WHERE length(line) > 0),
bags AS (SELECT doc_id, line, {pairs('plain')} AS pairs FROM held),
scored AS (
  SELECT doc_id, notice, line, len(list_intersect(b.pairs, n.pairs)) AS common, len(b.pairs) + len(n.pairs) AS total
  FROM bags b JOIN notices n ON list_has_any(b.pairs, n.pairs)),
good AS (SELECT *, 2 * common / total AS dice FROM scored WHERE common * 200 >= total * {dice})
SELECT doc_id, notice, max(dice) AS dice, arg_min(line, (-dice, line)) AS line FROM good GROUP BY doc_id, notice"""
