"""Licence scans with a positional index of rare words; column expressions only.

Every template (a licence text or a short licence phrase) is indexed under its rarest words,
those with the highest inverse document frequency over the templates, with their positions.
The words of a file that the index holds are looked up, their postings are intersected by
relative position (file place less template place), and the phrases that a template must have
are verified in the file at the place the alignment gives.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Licence phrases and their labels: fixed values.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Passages of public licence texts: fixed values.
TEMPLATES = {
    "apache": (
        "you may not use this file except in compliance with the license you may obtain a copy "
        "of the license at http www apache org licenses license 2 0 unless required by "
        "applicable law or agreed to in writing software distributed under the license is "
        "distributed on an as is basis without warranties or conditions of any kind either "
        "express or implied"
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met redistributions of source "
        "code must retain the above copyright notice this list of conditions and the following "
        "disclaimer"
    ),
    "cc-by": (
        "this work is licensed under a creative commons attribution 4 0 international license"
    ),
    "gpl": (
        "this program is free software you can redistribute it and or modify it under the terms "
        "of the gnu general public license as published by the free software foundation either "
        "version 3 of the license or at your option any later version"
    ),
    "isc": (
        "permission to use copy modify and or distribute this software for any purpose with or "
        "without fee is hereby granted provided that the above copyright notice and this "
        "permission notice appear in all copies"
    ),
    "mit": (
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files the software to deal in the software "
        "without restriction including without limitation the rights to use copy modify merge "
        "publish distribute sublicense and or sell copies of the software"
    ),
    "mpl": (
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a "
        "copy of the mpl was not distributed with this file you can obtain one at http mozilla "
        "org mpl 2 0"
    ),
}

# Words in a row that a file must have to be given a template's label: fixed values.
KEY_PHRASES = {
    "apache": "unless required by applicable law",
    "bsd": "redistribution and use in source and binary forms",
    "cc-by": "creative commons attribution",
    "gpl": "gnu general public license",
    "isc": "permission to use copy modify and or distribute this software",
    "mit": "permission is hereby granted free of charge",
    "mpl": "mozilla public license",
}


@dataclass(frozen=True)
class Template:
    """A text to find: its rare words with their places, and the phrase it must have."""

    label: str
    rare: tuple[tuple[str, int], ...]
    phrase: tuple[str, ...]
    phrase_at: int
    base: bool


def build_index(
    phrases: Mapping[str, str] = PHRASES,
    templates: Mapping[str, str] = TEMPLATES,
    key_phrases: Mapping[str, str] = KEY_PHRASES,
    rare_words: int = 8,
) -> list[Template]:
    """The index; a phrase is listed under its single rarest word, a text under several.

    Of words found in equally many templates the longer one counts as rarer.
    """
    split = lambda text: text.split(" ")
    texts = [set(split(t)) for t in [*phrases, *templates.values()]]
    found = Counter(w for t in texts for w in t)
    idf = {w: math.log(len(texts) / n) for w, n in found.items()}

    def rarest(words: Sequence[str], n: int) -> tuple[tuple[str, int], ...]:
        once = {w: i for i, w in reversed(list(enumerate(words)))}
        return tuple(sorted(once.items(), key=lambda x: (-idf[x[0]], -len(x[0]), x[1]))[:n])

    index = [
        Template(label, rarest(split(text), 1), tuple(split(text)), 0, True)
        for text, label in phrases.items()
    ]
    for label, text in templates.items():
        words, phrase = split(text), split(key_phrases[label])
        at = next(i for i in range(len(words)) if words[i : i + len(phrase)] == phrase)
        index.append(Template(label, rarest(words, rare_words), tuple(phrase), at, False))
    return index


def _stands(words: Column, at: Column, phrase: Sequence[str]) -> Column:
    """Whether the words of ``phrase`` stand in ``words`` from place ``at`` on."""
    hits = [F.get(words, at + j) == w for j, w in enumerate(phrase)]
    return F.coalesce(reduce(lambda a, b: a & b, hits), F.lit(False)) & (at >= 0)


def _looked_up(words: Column, hits: Column, template: Template) -> Column:
    """Relative positions of the file and the template, one per posting that meets a hit."""
    def postings(word: str, place: int) -> Column:
        return F.transform(F.filter(hits, lambda i: F.get(words, i) == word), lambda i: i - place)

    lists = [postings(word, place) for word, place in template.rare]
    return F.flatten(F.array(*lists)) if len(lists) > 1 else lists[0]


def _alignment(shifts: Column) -> Column:
    """Struct of the most frequent relative position and its count; the smallest on a tie."""
    start = F.struct(
        F.lit(None).cast("int").alias("now"), F.lit(0).alias("run"),
        F.lit(0).alias("most"), F.lit(0).alias("shift"),
    )

    def step(state: Column, x: Column) -> Column:
        run = F.when(x.eqNullSafe(state["now"]), state["run"] + 1).otherwise(1)
        return F.struct(
            x.alias("now"), run.alias("run"), F.greatest(run, state["most"]).alias("most"),
            F.when(run > state["most"], x).otherwise(state["shift"]).alias("shift"),
        )

    return F.aggregate(F.array_sort(shifts), start, step)


def _phrase_places(words: Column, hits: Column, t: Template) -> Column:
    """Starts of the phrase of a one-phrase template."""
    return F.filter(_looked_up(words, hits, t), lambda at: _stands(words, at, t.phrase))


def _share(words: Column, hits: Column, t: Template) -> Column:
    """Struct of the best alignment's share of rare words and whether the key phrase is there."""
    best = F.array(_alignment(_looked_up(words, hits, t)))
    judged = F.transform(best, lambda b: F.struct(
        (b["most"] / len(t.rare)).alias("share"),
        _stands(words, b["shift"] + t.phrase_at, t.phrase).alias("phrase"),
    ))
    return F.when(F.size(hits) > 0, judged[0])


def _labelled(starts: Column, label: str) -> Column:
    return F.transform(starts, lambda at: F.struct(F.lit(label).alias("label"), at.alias("start")))


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.array_compact(labels))), ",")


def scan(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    index: Sequence[Template] | None = None,
    least_share: float = 0.6,
) -> DataFrame:
    """Per row the id, counts and labels, and the places found.

    ``n_words, n_base, first_word, last_word, base_labels, labels, score`` and ``places``, an
    array of ``label, start`` for all base phrases.  ``score`` is 1 with a base phrase, else
    the largest share of a template's rare words in one alignment.  A template gives its label
    when that share is at least ``least_share`` and its key phrase stands in the alignment.  A
    null or empty text has no word and no label, very long ones are read whole, repeated rows
    get equal answers, an empty table gives an empty result; other columns are not read.
    """
    index = list(build_index() if index is None else index)
    vocabulary = sorted({w for t in index for w, _ in t.rare})
    base = [t for t in index if t.base]
    texts = [t for t in index if not t.base]
    words, hits = F.col("_words"), F.col("_hits")
    lowered = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), UPPER, LOWER)
    found = (
        df.select(F.col(id_col), F.regexp_extract_all(lowered, F.lit(f"({WORD})"), F.lit(1)).alias("_words"))
        .withColumn(
            "_hits",
            F.filter(
                F.transform(words, lambda w, i: F.when(w.isin(vocabulary), i).otherwise(-1)),
                lambda i: i >= 0,
            ),
        )
        .select(
            id_col, F.size("_words").cast("long").alias("n_words"),
            *[_phrase_places(words, hits, t).alias(f"_b{n}") for n, t in enumerate(base)],
            *[_share(words, hits, t).alias(f"_t{n}") for n, t in enumerate(texts)],
        )
    )
    starts = [F.col(f"_b{n}") for n in range(len(base))]
    n_base = reduce(lambda a, b: a + b, [F.size(s) for s in starts])
    base_labels = F.array(*[F.when(F.size(s) > 0, F.lit(t.label)) for s, t in zip(starts, base, strict=True)])
    shares = [F.coalesce(F.col(f"_t{n}.share"), F.lit(0.0)) for n in range(len(texts))]
    text_labels = F.array(*[
        F.when((share >= least_share) & F.col(f"_t{n}.phrase"), F.lit(t.label))
        for n, (share, t) in enumerate(zip(shares, texts, strict=True))
    ])
    places = F.flatten(
        F.array(*[_labelled(s, t.label) for s, t in zip(starts, base, strict=True)])
    )
    every = F.flatten(F.array(*starts))
    return found.select(
        id_col,
        "n_words",
        n_base.cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"),
        _joined(base_labels).alias("base_labels"),
        _joined(F.concat(base_labels, text_labels)).alias("labels"),
        F.when(n_base > 0, F.lit(1.0)).otherwise(F.greatest(*shares, F.lit(0.0))).alias("score"),
        places.alias("places"),
    )


def scan_sql(source: str = "documents", least_share: float = 0.6) -> str:
    """The same result as DuckDB SQL, by unnested words and joins instead of arrays."""
    index = build_index()
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    listed = lambda ws: "[" + ", ".join(map(quote, ws)) + "]"
    base = ", ".join(f"({quote(t.label)}, {listed(t.phrase)})" for t in index if t.base)
    rare = ", ".join(
        f"({quote(t.label)}, {quote(w)}, {at})" for t in index if not t.base for w, at in t.rare
    )
    text = ", ".join(
        f"({quote(t.label)}, {len(t.rare)}, {listed(t.phrase)}, {t.phrase_at})"
        for t in index if not t.base
    )
    pattern = re.sub("'", "''", WORD)
    return f"""WITH base(label, phrase) AS (VALUES {base}),
        rare(label, w, p) AS (VALUES {rare}),
        texts(label, size, phrase, phrase_at) AS (VALUES {text}),
        f AS (SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{pattern}') AS ws
              FROM {source}),
        tokens AS (SELECT doc_id, i - 1 AS i, ws[i] AS w
              FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM f)),
        places AS (SELECT t.doc_id, b.label, t.i FROM tokens t JOIN base b ON t.w = b.phrase[1]
              JOIN f ON f.doc_id = t.doc_id
              WHERE f.ws[t.i + 1 : t.i + len(b.phrase)] = b.phrase),
        counted AS (SELECT doc_id, label, i - p AS shift, count(*) AS n
              FROM tokens JOIN rare USING (w) GROUP BY ALL),
        best AS (SELECT doc_id, label, max(n) AS n, arg_min(shift, (-n, shift)) AS shift
              FROM counted GROUP BY ALL),
        aligned AS (SELECT doc_id, label, n / size AS share,
                shift + phrase_at >= 0 AND f.ws[shift + phrase_at + 1 : shift + phrase_at + len(phrase)]
                  = phrase AS has
              FROM best JOIN texts USING (label) JOIN f USING (doc_id)),
        labels AS (SELECT DISTINCT doc_id, label FROM (SELECT doc_id, label FROM places UNION ALL
              SELECT doc_id, label FROM aligned WHERE share >= {least_share} AND has))
        SELECT f.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
          CAST((SELECT count(*) FROM places p WHERE p.doc_id = f.doc_id) AS BIGINT) AS n_base,
          (SELECT CAST(min(i) AS BIGINT) FROM places p WHERE p.doc_id = f.doc_id) AS first_word,
          (SELECT CAST(max(i) AS BIGINT) FROM places p WHERE p.doc_id = f.doc_id) AS last_word,
          coalesce((SELECT string_agg(DISTINCT label, ',' ORDER BY label) FROM places p
            WHERE p.doc_id = f.doc_id), '') AS base_labels,
          coalesce((SELECT string_agg(label, ',' ORDER BY label) FROM labels l
            WHERE l.doc_id = f.doc_id), '') AS labels,
          CASE WHEN EXISTS (SELECT 1 FROM places p WHERE p.doc_id = f.doc_id) THEN 1.0::DOUBLE
            ELSE coalesce((SELECT max(share) FROM aligned a WHERE a.doc_id = f.doc_id), 0.0)::DOUBLE
          END AS score
        FROM f"""
