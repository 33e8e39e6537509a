"""License scan: an exact set-similarity join of text blocks with license templates, and the places of license phrases.

Only built-in expressions run. Blocks are lines, and runs of up to LINES neighbouring lines, none of them blank, which have at
most WIDE words for each of the template's: so a notice that is wrapped over lines is found as well, and words scattered over
a long passage aren't. A template is found in a block when the block has at least `threshold` of the template's distinct words.
Prefix, length and positional filters rule pairs out before they are compared; none of them loses a pair.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, keep, table, text_or_empty

#: ASCII characters that stand between words: all but letters and digits.
BETWEEN = "".join(c for c in map(chr, range(128)) if not c.isalnum())

#: Phrases whose words stand consecutively, and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Templates by label: short notices and the opening sentences of well-known licenses.
TEMPLATES = {
    "mit": (
        "released under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
    ),
    "apache": (
        "licensed under the apache license version 2 0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
    ),
    "gpl": (
        "this work is licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation",
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met",
    ),
    "cc-by-nc": ("licensed under cc by nc 4 0", "creative commons attribution noncommercial 4 0 international license"),
    "cc-by-sa": ("licensed under cc by sa 4 0", "creative commons attribution sharealike 4 0 international license"),
    "mpl": ("this source code form is subject to the terms of the mozilla public license v 2 0",),
}
THRESHOLD = 0.85
#: Lines of a block at most, and words of a block of several lines for each distinct word of a template at most.
LINES, WIDE = 6, 2


def _spaced(text: Column) -> Column:
    """Lower-cased words with blanks between and around them, some of them repeated. One pass, without a regular expression."""
    return F.concat(F.lit(" "), F.translate(text, UPPER + BETWEEN, LOWER + " " * len(BETWEEN)), F.lit(" "))


def _words(spaced: Column) -> Column:
    return F.array_remove(F.split(spaced, " "), "")


def _has_any(words: Column, wanted: list[str]) -> Column:
    return F.arrays_overlap(words, F.array(*map(F.lit, wanted)))


def template_words(docs: DataFrame, vocabulary: list[str], text_col: str) -> dict[str, int]:
    """How often each word of the templates occurs in all texts. As many rows as the templates have words."""
    words = docs.select(F.explode(F.split(_spaced(text_or_empty(text_col)), " ")).alias("word"))
    counted = words.where(F.col("word").isin(vocabulary)).groupBy("word").agg(F.count("*").alias("n"))
    return {r.word: r.n for r in counted.collect()}


def template_matches(
    docs: DataFrame,
    templates: dict[str, tuple[str, ...]] = TEMPLATES,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
    lines: int = LINES,
) -> DataFrame:
    """Every (id, block, template) whose containment reaches the threshold: id, key, block (number of its first line), lines (how many
    it has), label, template, containment.

    key is a hash of the text, so that rows that share an id stay apart. Words are ordered by their number in all texts,
    rarest first. A block holding ceil(threshold * size) words of a template has one of the first
    size - that + 1 of them (prefix), has at least that many words (length), and from the first word it shares on both
    sides must still have enough (position).
    """
    sets = [(label, i, sorted({*text.split()})) for label, texts in templates.items() for i, text in enumerate(texts)]
    vocabulary = sorted({w for _, _, s in sets for w in s})
    counts = template_words(docs, vocabulary, text_col)
    place = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}
    index, rare = [], set()
    for label, i, s in sets:
        ordered, need = sorted(s, key=place.get), ceil(threshold * len(s) - 1e-9)
        head = ordered[: len(ordered) - need + 1]
        rare.update(head)
        index += [(w, label, i, at, len(ordered), need, ordered) for at, w in enumerate(head)]
    names = ("word", "label", "template", "at", "size", "need", "words")
    literals = [
        F.struct(*[(F.array(*map(F.lit, v)) if n == "words" else F.lit(v)).alias(n) for n, v in zip(names, x, strict=True)])
        for x in index
    ]
    prefixes = docs.sparkSession.range(1).select(F.inline(F.array(*literals)))
    near = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(text_or_empty(text_col)).alias("key"),
        text_or_empty(text_col).alias("text"),
    ).where(_has_any(_words(_spaced(F.col("text"))), sorted(rare)))
    known = F.array(*[F.lit(w) for w in sorted(vocabulary, key=place.get)])
    told = lambda words: F.struct(F.array_intersect(known, words).alias("words"), F.size(words).alias("n"))
    each = near.select("id", "key", F.transform(F.transform(F.split("text", "\n"), lambda x: _words(_spaced(x))), told).alias("each"))

    def block(first: Column, many: Column) -> Column:
        part = F.slice("each", first + 1, many)
        words = F.array_intersect(known, F.flatten(F.transform(part, lambda x: x["words"])))  # in the global order
        whole = F.aggregate(part, F.lit(0), lambda n, x: n + x["n"])
        plain = (many == 1) | ~F.exists(part, lambda x: x["n"] == 0)
        return F.struct(first.alias("block"), many.alias("lines"), words.alias("words"), whole.alias("n"), plain.alias("plain"))

    last = F.size("each")
    runs = F.transform(F.sequence(F.lit(0), last - 1), lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(lines), last - i)), lambda k: block(i, k)))
    blocks = each.select("id", "key", F.inline(F.flatten(runs))).where(F.col("plain") & _has_any(F.col("words"), sorted(rare)))
    entry = blocks.select(
        "id", "key", "block", "lines", "n", F.col("words").alias("have"), F.posexplode("words").alias("block_at", "word")
    )
    met = entry.join(F.broadcast(prefixes), "word").where(  # the templates are a fixed parameter of a few hundred rows
        (F.size("have") >= F.col("need"))
        & ((F.col("lines") == 1) | (F.col("n") <= WIDE * F.col("size")))
        & (1 + F.least(F.col("size") - F.col("at") - 1, F.size("have") - F.col("block_at") - 1) >= F.col("need"))
    )
    shared = F.size(F.array_intersect("have", "words"))
    found = met.withColumn("containment", shared / F.col("size")).where(shared >= F.col("need"))
    return found.groupBy("id", "key", "block", "lines", "label", "template").agg(F.max("containment").alias("containment"))


def scan(
    docs: DataFrame,
    templates: dict[str, tuple[str, ...]] = TEMPLATES,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Null and empty texts have no words and no labels. Rows that share an id are scanned each on its own; rows equal in id
    and text give equal rows. Other columns are not read. score is the largest containment of a template that was found,
    1 where a phrase stands, and 0 without either. labels are empty text where there is none.
    """
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(text_or_empty(text_col)).alias("key"),
        _words(_spaced(text_or_empty(text_col))).alias("words"),
    )

    def starts(phrase: str) -> Column:
        parts = phrase.split()

        def stands(i: Column) -> Column:
            hit = F.get("words", i) == parts[0]
            for k, part in enumerate(parts[1:], 1):
                hit = hit & (F.get("words", i + k) == part)
            return hit

        last = F.size("words") - len(parts)
        none = F.array().cast("array<int>")
        maybe = (last >= 0) & F.array_contains("words", parts[-1])
        return F.when(maybe, F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), stands)).otherwise(none)

    rows = rows.select(
        "id",
        "key",
        F.size("words").cast("long").alias("n_words"),
        F.array(*[F.struct(F.lit(y).alias("label"), starts(p).alias("at")) for p, y in PHRASES]).alias("hits"),
    )
    places = F.flatten(F.transform("hits", lambda h: h["at"]))
    base = F.transform(F.filter("hits", lambda h: F.size(h["at"]) > 0), lambda h: h["label"])
    rows = rows.select(
        "id",
        "key",
        "n_words",
        F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(base)).alias("base"),
    )
    found = keep(template_matches(docs, templates, threshold, id_col, text_col), "matches")
    by_doc = found.groupBy(F.col("id").alias("_id"), F.col("key").alias("_key")).agg(
        F.collect_set("label").alias("more"), F.max("containment").alias("best")
    )
    joined = rows.join(by_doc, rows["id"].eqNullSafe(by_doc["_id"]) & (rows["key"] == by_doc["_key"]), "left")
    more = F.coalesce("more", F.array().cast("array<string>"))
    return joined.select(
        F.col("id").alias(id_col),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", more)), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


def oracle() -> str:
    """DuckDB SQL for the whole scan."""
    sets = [(y, sorted({*t.split()})) for y, texts in TEMPLATES.items() for t in texts]
    values = ", ".join(f"('{y}', {words})" for y, words in sets)
    between = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    low = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
    hits = " + ".join(
        f"[{{'y': '{y}', 'at': list_filter(range(len(w)), lambda i: "
        + " and ".join(f"w[i + {k + 1}] = '{word}'" for k, word in enumerate(p.split()))
        + ")}]"
        for p, y in PHRASES
    )
    return f"""
with t(label, words) as (values {values}),
d as (select doc_id, {low} as low, regexp_extract_all({low}, '{between}') as w from documents),
h as (select doc_id, len(w) as n_words, {hits} as hits from d),
p as (select *, flatten(list_transform(hits, lambda h: h.at)) as places,
             list_sort(list_transform(list_filter(hits, lambda h: len(h.at) > 0), lambda h: h.y)) as base from h),
l as (select doc_id, list_transform(string_split(low, chr(10)), lambda x: regexp_extract_all(x, '{between}')) as ls from d),
i as (select doc_id, ls, unnest(range(len(ls))) as pos from l),
k as (select doc_id, ls, pos, unnest(range(1, least({LINES}, len(ls) - pos) + 1)) as lines from i),
r as (select doc_id, lines, ls[pos + 1 : pos + lines] as part from k),
f as (select doc_id, lines, flatten(part) as ws from r where lines = 1 or len(list_filter(part, lambda x: len(x) = 0)) = 0),
b as (select row_number() over () as b, doc_id, lines, len(ws) as n, list_distinct(ws) as have from f),
u as (select b, doc_id, lines, n, unnest(have) as word from b),
v as (select row_number() over () as t, label, words from t),
x as (select t, label, len(words) as size, unnest(words) as word from v),
m as (select doc_id, label, max(share) as share from (
        select doc_id, label, count(*) / any_value(size) as share from u join x using (word)
        where lines = 1 or n <= {WIDE} * size group by b, doc_id, t, label) where share >= {THRESHOLD} group by doc_id, label),
g as (select doc_id, list(label) as more, max(share) as best from m group by doc_id)
select p.doc_id, n_words, len(places)::bigint as n_base, list_min(places)::bigint as first_word, list_max(places)::bigint as last_word,
       array_to_string(base, ',') as base_labels,
       array_to_string(list_sort(list_distinct(base || coalesce(more, []))), ',') as labels,
       case when len(places) > 0 then 1.0::double else coalesce(best, 0)::double end as score
from p left join g using (doc_id)
"""


def op6_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
