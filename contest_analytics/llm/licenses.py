"""Find licence notices: fixed phrases, and templates by an exact set-similarity join.

Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z are lower-cased. Phrases are counted where
their words stand consecutively in the text. For templates a text is cut into blocks at blank lines; a
block's and a template's tokens are their distinct shingles of five words (of fewer words: all of them as
one). A block is labelled if it holds at least ``PER_CENT`` of a template's tokens.

1. Tokens that no template has cannot count, so a row keeps only the template tokens of its blocks, and
   none if the text lacks the words that every match needs.
   Rows whose blocks hold the same tokens are one group, and blocks of the same tokens one set.
2. The number of such texts with a token, over all of them, orders the tokens, rare ones first.
3. Of a template of n tokens a block has to hold m = ceil(n * PER_CENT / 100). Blocks with fewer than m
   template tokens cannot (length filter). One of the template's first n - m + 1 tokens has to be in the
   block, and among the block's tokens it stands where at least m are left (prefix filter, both sides).
   What is left behind the first token that both share bounds the overlap (positional filter).
4. What passes all three is compared as whole sets.

A document's score is its best containment, 1 where a phrase stands. A null or empty text has no words
and no labels. Repeated rows have equal results each. Templates without words or label are ignored;
without any only phrases count. Long texts are one row of arrays. Other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contest_analytics.llm.text import SHINGLE_WORDS, let, lower_ascii, shingle_hashes
from contest_analytics.session import cut_lineage

PER_CENT, SALTS = 75, 16
NO_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

# The phrases and labels of the query's contract.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Well-known licence notices, (label, words).
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    (
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance"
        " with the License. You may obtain a copy of the License at",
    ),
    (
        "apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is"
        " distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the Software), to deal in the Software without restriction, including without limitation"
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation",
    ),
    (
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was"
        " not distributed with this file, You can obtain one at",
    ),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]


def spaced_words(text: Column) -> Column:
    """The words with two spaces between them and one at either end; one space for a text without words.

    So a phrase in this form is found by plain search, also where two of them meet.
    """
    plain = F.regexp_replace(lower_ascii(F.coalesce(text, F.lit(""))), NO_WORD, "  ")
    return let(F.trim(plain), lambda s: F.when(s == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), s, F.lit(" "))))


def count_words(spaced: Column) -> Column:
    """One more than there are gaps; spaces are single bytes."""

    def count(s: Column) -> Column:
        gaps = F.octet_length(s) - F.octet_length(F.replace(s, F.lit("  "), F.lit(" ")))
        return F.when(s == " ", 0).otherwise(gaps + 1).cast("bigint")

    return let(spaced, count)


def word_list(spaced: Column) -> Column:
    empty = F.array().cast("array<string>")
    return F.when(spaced == " ", empty).otherwise(F.split(F.trim(spaced), "  "))


def phrase_places(spaced: Column, phrase: str) -> Column:
    """The (n, first, last) word places where a phrase stands; first and last are null without any."""
    sought = " " + phrase.replace(" ", "  ") + " "
    size = len(phrase.split(" "))

    def places(s: Column) -> Column:
        parts = F.split(s, sought)  # of letters and spaces, so no pattern
        n = F.size(parts) - 1
        before, after = F.element_at(parts, 1), F.element_at(parts, -1)
        outer = lambda part: count_words(F.concat(F.lit(" "), F.trim(part), F.lit(" ")))
        blank = lambda part: F.trim(part) == ""
        first = F.when(blank(before), 0).otherwise(outer(before))
        behind = F.when(blank(after), 0).otherwise(outer(after))
        return F.struct(
            n.cast("bigint").alias("n"), first.cast("bigint").alias("first"),
            (count_words(s) - behind - size).cast("bigint").alias("last"),
        )

    none = F.lit(None).cast("struct<n:bigint,first:bigint,last:bigint>")
    return F.when(spaced.contains(sought), places(spaced)).otherwise(none)


def shingles(words: Column) -> Column:
    return F.array_distinct(shingle_hashes(words))


def template_tokens(docs: DataFrame, templates: Sequence[tuple[str, str]], per_cent: int) -> DataFrame:
    """(t, label, need, x): the tokens of the templates, a table of the caller's own size."""
    listed = [(i, label, text) for i, (label, text) in enumerate(templates) if label]
    rows = docs.sparkSession.createDataFrame(listed, "t int, label string, text string")
    rows = rows.select("t", "label", shingles(word_list(spaced_words(F.col("text")))).alias("s")).where("size(s) > 0")
    need = F.floor((F.size("s") * per_cent + 99) / 100).cast("int").alias("need")
    return rows.select("t", "label", F.size("s").alias("n"), need, F.explode("s").alias("x"))


def telling_words(templates: Sequence[tuple[str, str]], per_cent: int) -> list[str]:
    """Words of which a text has one at least if it meets any template's threshold.

    Of each template, long words are taken until fewer tokens are without any of them than the
    threshold needs.
    """
    chosen: set[str] = set()
    for label, text in templates:
        words = re.findall("[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)) if label else []
        tokens = {tuple(words[i : i + SHINGLE_WORDS]) for i in range(max(1, len(words) - SHINGLE_WORDS + 1))} if words else set()
        need = -(-len(tokens) * per_cent // 100)
        for word in sorted(set(words), key=lambda w: (w not in chosen, -len(w), w)):
            if sum(chosen.isdisjoint(t) for t in tokens) < need:
                break
            chosen.add(word)
    return sorted(chosen)


def scan(docs: DataFrame, phrases: Mapping[str, str], wanted: Sequence[int], telling: Sequence[str]) -> DataFrame:
    """Every row's words and phrases, and ``blocks``: the template tokens of its blocks that hold any.

    A text without any of the words ``telling`` meets no template and is not cut up.
    """
    may = F.col("_spaced").rlike(" (?:" + "|".join(telling) + ") ") if telling else F.lit(False)
    cut = F.split(F.coalesce("_text", F.lit("")), "\\n[\\x20\\x09\\x0D]*\\n")

    def tokens(block: Column) -> Column:
        return F.filter(shingles(word_list(spaced_words(block))), lambda x: x.isin(list(wanted)))

    none = F.array().cast("array<array<bigint>>")
    found = F.filter(F.transform(cut, lambda block: F.sort_array(tokens(block))), lambda s: F.size(s) > 0)
    places = {f"_p{i}": phrase_places(F.col("_spaced"), phrase) for i, phrase in enumerate(phrases)}
    rows = docs.select("doc_id", F.col("text").alias("_text"), spaced_words(F.col("text")).alias("_spaced"))
    rows = rows.select(
        "doc_id", count_words(F.col("_spaced")).alias("n_words"), *(c.alias(name) for name, c in places.items()),
        (F.when(may, F.array_distinct(found)).otherwise(none) if wanted else none).alias("blocks"),
    )
    every = F.filter(F.array(*(F.col(name) for name in places)), lambda p: p.isNotNull()) if places else None
    labels = [F.when(F.col(f"_p{i}").isNotNull(), label) for i, label in enumerate(phrases.values())]
    strings = F.array().cast("array<string>")
    if every is None:
        every = F.array().cast("array<struct<n:bigint,first:bigint,last:bigint>>")
    return rows.select(
        "doc_id",
        "n_words",
        F.aggregate(every, F.lit(0).cast("bigint"), lambda total, p: total + p["n"]).alias("n_base"),
        F.array_min(F.transform(every, lambda p: p["first"])).alias("first_word"),
        F.array_max(F.transform(every, lambda p: p["last"])).alias("last_word"),
        (F.array_compact(F.array(*labels)) if labels else strings).alias("base"),
        "blocks",
        F.when(F.size("blocks") > 0, F.xxhash64("blocks")).alias("k"),
    )


def contained(groups: DataFrame, tokens: DataFrame) -> DataFrame:
    """``k, labels, score`` of the groups (k, rows, blocks) with a block that meets a template's threshold."""
    # The global order: in how many texts a token stands, counted over all of them.
    held = groups.select("rows", F.explode(F.array_distinct(F.flatten("blocks"))).alias("x"))
    order = tokens.select("x").distinct().join(held.groupBy("x").agg(F.sum("rows").alias("df")), "x", "left")
    order = F.broadcast(cut_lineage(order.select("x", F.struct(F.coalesce("df", F.lit(0)).alias("df"), F.col("x").alias("h")).alias("rank"))))

    sets = groups.select("k", F.explode("blocks").alias("s"))
    distinct = sets.select(F.xxhash64("s").alias("b"), "s").groupBy("b").agg(F.first("s").alias("s"))
    ranked = distinct.select("b", F.explode("s").alias("x")).join(order, "x").groupBy("b")
    ranked = ranked.agg(F.sort_array(F.collect_list("rank")).alias("u"))  # at most all templates' tokens
    mine = tokens.join(order, "x").groupBy("t", "label", "n", "need").agg(F.sort_array(F.collect_list("rank")).alias("v"))

    prefix = mine.select("t", "label", "n", "need", "v", F.posexplode(F.expr("slice(v, 1, n - need + 1)")).alias("i", "rank"))
    probes = ranked.select("b", "u", F.size("u").alias("size"), F.posexplode("u").alias("j", "rank"))
    met = probes.join(F.broadcast(prefix), "rank").where("size >= need AND size - j >= need")
    first = met.groupBy("b", "t").agg(  # the first token that both share
        F.min_by(F.struct("i", "j"), "rank").alias("at"), *(F.first(c).alias(c) for c in ("u", "v", "n", "need", "label"))
    )
    possible = first.where("least(n - at.i, size(u) - at.j) >= need")
    shared = F.size(F.array_intersect("u", "v"))
    found = possible.where(shared >= F.col("need")).select("b", "label", (shared / F.col("n")).alias("part"))
    return (
        sets.select("k", F.xxhash64("s").alias("b")).join(found, "b").groupBy("k")
        .agg(F.collect_set("label").alias("labels"), F.max("part").alias("score"))
    )


def find_licenses(
    docs: DataFrame,
    phrases: Mapping[str, str] = PHRASES,
    templates: Sequence[tuple[str, str]] = tuple(TEMPLATES),
    per_cent: int = PER_CENT,
) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base, labels, score`` of every row.

    ``phrases`` are lower-case words with one space between them, with their labels; none may overlap
    itself. ``base`` and ``labels`` are sorted arrays; the second holds the first.
    """
    tokens = template_tokens(docs, templates, per_cent)
    wanted = sorted({row.x for row in tokens.select("x").collect()})  # the caller's templates
    rows = cut_lineage(scan(docs, phrases, wanted, telling_words(templates, per_cent)))
    groups = rows.where("k IS NOT NULL").groupBy("k").agg(F.count("*").alias("rows"), F.first("blocks").alias("blocks"))
    found = contained(cut_lineage(groups), tokens)
    # One group may hold a third of all rows; the others have no key. Both are dealt by a salt.
    salted = found.select(F.col("k").alias("_k"), "labels", "score", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_s"))
    salt = F.pmod(F.xxhash64("doc_id", "n_words"), F.lit(SALTS)).cast("int")
    has = rows.where("k IS NOT NULL").withColumn("salt", salt)
    joined = has.join(salted, (F.col("k") == F.col("_k")) & (F.col("salt") == F.col("_s")), "left").drop("_k", "_s", "salt")
    bare = rows.where("k IS NULL").select(
        "*", F.lit(None).cast("array<string>").alias("labels"), F.lit(None).cast("double").alias("score")
    )
    every = joined.unionByName(bare)
    return every.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_sort(F.array_distinct("base")).alias("base"),
        F.array_sort(F.array_union("base", F.coalesce("labels", F.array().cast("array<string>")))).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("score", F.lit(0.0))).alias("score"),
    )
