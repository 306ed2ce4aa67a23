"""License scan by a positional index of rare words.

Each file is cut into words once; of these the ones that any license template has are
stored with their places, a positional index by file. How many files hold a word is
counted over the whole table. For each template a file's highest-IDF words are looked
up first; a template of which one is missing is given up at once. The words' places,
less their positions in a key phrase, are then intersected: what is left are starts of
the whole phrase, so a phrase is verified word by word. All key phrases of a template
are mandatory and have to agree on where the template begins, within a tolerance. The
score is the IDF share of the template's words that stand where they should; from
``ACCEPT`` on the file gets the template's label.

``PHRASES`` are templates of one key phrase whose places are reported one by one.

Only built-in functions run. The text is read and cut in one pass without a shuffle;
what is shuffled are counts of the templates' words, and their number is fixed.

Defined results: words are runs of ASCII letters and digits and of all other code
points above 127; A-Z count as lower-case. A null text is empty and has no words. A
file without a label has empty lists and score 0. Equal rows get equal results. A null
id stays null. An empty table gives an empty result. Other columns are dropped.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import Stage

SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Words by which key phrases may be nearer to or further from each other than in a template.
TOLERANCE = 16
ACCEPT = 0.6


@dataclass(frozen=True)
class Template:
    """``text`` in lower case, words joined by spaces; ``keys`` are mandatory phrases of it."""

    label: str
    text: str
    keys: tuple[str, ...] = field(default=())

    @property
    def words(self) -> list[str]:
        return self.text.split()

    def phrases(self) -> list[tuple[int, list[str]]]:
        """Each key phrase's words and its position in the template."""
        found = []
        for key in self.keys or (self.text,):
            words = key.split()
            at = next((k for k in range(len(self.words)) if self.words[k : k + len(words)] == words), None)
            if at is None:
                raise ValueError(f"{key!r} is no phrase of template {self.label}")
            found.append((at, words))
        return found


PHRASES = (
    Template("mit", "under the mit license"),
    Template("apache-2", "apache license version 2"),
    Template("cc-by-nc", "cc by nc"),
)

# Notices of public licenses, and short forms that name one.
TEMPLATES = (
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
        ("permission is hereby granted free of charge", "to deal in the software without restriction"),
    ),
    Template("mit", "the mit license"),
    Template("mit", "licensed under mit"),
    Template(
        "apache-2",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
        ("apache license version 2 0", "except in compliance with the license"),
    ),
    Template("apache-2", "apache license 2 0"),
    Template(
        "gpl-2",
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
        "free software foundation either version 2 of the license or at your option any later version",
        ("gnu general public license", "either version 2 of the license"),
    ),
    Template(
        "gpl-3",
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
        "free software foundation either version 3 of the license or at your option any later version",
        ("gnu general public license", "either version 3 of the license"),
    ),
    Template("gpl-2", "gnu general public license version 2"),
    Template("gpl-3", "gnu general public license version 3"),
    Template("gpl-2", "gnu gpl v2"),
    Template("gpl-3", "gnu gpl v3"),
    Template("lgpl", "gnu lesser general public license"),
    Template("agpl", "gnu affero general public license"),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met redistributions of source code must retain the above copyright notice",
        ("redistribution and use in source and binary forms", "provided that the following conditions are met"),
    ),
    Template("bsd", "under the bsd license"),
    Template("bsd", "bsd 2 clause"),
    Template("bsd", "bsd 3 clause"),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
        ("permission to use copy modify", "with or without fee is hereby granted"),
    ),
    Template("isc", "under the isc license"),
    Template(
        "mpl-2",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ("subject to the terms of the mozilla public license",),
    ),
    Template("mpl-2", "mozilla public license version 2 0"),
    Template("epl-2", "eclipse public license v 2 0"),
    Template("cc-by", "cc by 4 0"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc-by-nd", "cc by nd"),
    Template("cc-by", "creative commons attribution 4 0 international license"),
    Template("cc-by-sa", "creative commons attribution sharealike"),
    Template("cc-by-nc", "creative commons attribution noncommercial"),
    Template("cc0", "cc0 1 0 universal"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
    Template("zlib", "in no event will the authors be held liable for any damages arising from the use of this software"),
    Template("proprietary", "all rights reserved"),
)


def positions(docs: DataFrame, words: list[str], doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words and ``hits``: (word, place) of all words of ``words``, in order of place."""
    # Lower case turns one sign of several bytes into an ASCII letter; the length tells.
    known = lambda w: F.lower(w).isin(words) & (F.octet_length(w) == F.octet_length(F.lower(w)))
    # Splitting is much faster than extracting; it leaves an empty part where a text begins or ends with a separator.
    found = docs.select(F.col(doc).alias("doc_id"), F.split(F.coalesce(F.col(text), F.lit("")), SEPARATOR, -1).alias("parts"))
    before = (F.element_at("parts", 1) == "").cast("int")
    behind = ((F.size("parts") > 1) & (F.element_at("parts", -1) == "")).cast("int")
    found = found.select("doc_id", "parts", before.alias("before"), (F.size("parts") - before - behind).alias("n"))
    placed = F.transform(
        "parts", lambda w, i: F.when(known(w), F.struct(F.lower(w).alias("word"), (i - F.col("before")).alias("place")))
    )
    hits = F.filter(placed, lambda x: x.isNotNull())
    return found.select("doc_id", F.col("n").cast("long").alias("n_words"), hits.alias("hits"))


def rarity(index: DataFrame, words: list[str]) -> dict[str, float]:
    """IDF of each of ``words`` over all files. A row for each of these words reaches the driver, and no more."""
    seen = index.select(F.explode(F.concat(F.array(F.lit("")), F.array_distinct("hits.word"))).alias("word"))
    files = {r["word"]: r["n"] for r in seen.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {w: math.log((files.get("", 0) + 1) / (files.get(w, 0) + 1)) + 1 for w in words}


_KIND = (
    "array<struct<label:string,needed:array<string>,words:array<struct<word:string,k:int,idf:double>>,"
    "keys:array<struct<at:int,words:array<struct<word:string,k:int,idf:double>>>>>>"
)


def _table(templates: tuple[Template, ...], idf: dict[str, float]) -> Column:
    """The templates as one constant: words with position and IDF, key phrases rarest word first."""
    rarest = lambda words: sorted(words, key=lambda x: (-idf[x["word"]], x["word"], x["k"]))
    placed = lambda words: [{"word": w, "k": k, "idf": idf[w]} for k, w in enumerate(words)]
    rows = []
    for t in templates:
        phrases = t.phrases()
        needed = rarest([{"word": w, "k": 0} for w in {w for _, words in phrases for w in words}])
        keys = [{"at": at, "words": rarest(placed(words))} for at, words in phrases]
        rows.append({"label": t.label, "needed": [x["word"] for x in needed], "words": placed(t.words), "keys": keys})
    return F.from_json(F.lit(json.dumps(rows)), _KIND)


def _offsets(word: Column) -> Column:
    """Where the phrase or template of ``word`` would begin, by each place of the word."""
    return F.transform(F.filter("hits", lambda h: h["word"] == word["word"]), lambda h: h["place"] - word["k"])


def _starts(key: Column) -> Column:
    """Places at which a key phrase's words stand one after another."""
    first = _offsets(F.element_at(key["words"], 1))
    rest = F.slice(key["words"], F.lit(2), F.size(key["words"]))
    return F.aggregate(rest, first, lambda left, w: F.when(F.size(left) > 0, F.array_intersect(left, _offsets(w))).otherwise(left))


def _buckets(places: Column) -> Column:
    return F.transform(places, lambda p: F.floor(p / F.lit(TOLERANCE)))


def _wide(buckets: Column) -> Column:
    return F.flatten(F.transform(buckets, lambda b: F.array(b - 1, b, b + 1)))


def _matches(templates: Column) -> Column:
    """label, starts (of the first key phrase) and share of each template whose key phrases stand in the file."""
    likely = F.filter(templates, lambda t: F.forall(t["needed"], lambda w: F.array_contains("present", w)))

    def matched(t: Column) -> Column:
        first = F.element_at(t["keys"], 1)
        return F.struct(
            t["label"].alias("label"),
            t["words"].alias("words"),
            first["at"].alias("at"),
            _starts(first).alias("starts"),
            F.slice(t["keys"], F.lit(2), F.size(t["keys"])).alias("keys"),
        )

    def agreed(m: Column) -> Column:
        """Only the starts near which every other key phrase agrees."""
        begins = lambda at, places: _buckets(F.transform(places, lambda p: p - at))
        common = F.aggregate(
            m["keys"],
            F.array_distinct(begins(m["at"], m["starts"])),
            lambda left, k: F.when(
                F.size(left) > 0, F.array_intersect(left, _wide(begins(k["at"], _starts(k))))
            ).otherwise(left),
        )
        return F.struct(m["label"].alias("label"), m["words"].alias("words"), m["starts"].alias("starts"), common.alias("common"))

    def weighed(m: Column) -> Column:
        near = _wide(m["common"])
        total = F.aggregate(m["words"], F.lit(0.0), lambda a, w: a + w["idf"])
        stands = F.aggregate(
            m["words"],
            F.lit(0.0),
            lambda a, w: a + F.when(F.arrays_overlap(_buckets(_offsets(w)), near), w["idf"]).otherwise(F.lit(0.0)),
        )
        return F.struct(m["label"].alias("label"), m["starts"].alias("starts"), F.round(stands / total, 6).alias("share"))

    some = F.filter(F.transform(likely, matched), lambda m: F.size(m["starts"]) > 0)
    agreeing = F.filter(F.transform(some, agreed), lambda m: F.size(m["common"]) > 0)
    return F.transform(agreeing, weighed)


def scan(
    docs: DataFrame,
    stage: Stage,
    doc: str = "doc_id",
    text: str = "text",
    phrases: tuple[Template, ...] = PHRASES,
    templates: tuple[Template, ...] = TEMPLATES,
) -> DataFrame:
    """doc_id, n_words, places (of all phrases), phrase_labels, labels, score and matches of every row."""
    words = sorted({w for t in (*phrases, *templates) for w in t.words})
    index = stage.table(positions(docs, words, doc, text), "license_words")
    idf = rarity(index, words)
    found = index.withColumn("present", F.array_distinct("hits.word"))
    found = found.withColumn("phrases", _matches(_table(phrases, idf))).withColumn("templates", _matches(_table(templates, idf)))
    found = found.withColumn("accepted", F.filter("templates", lambda m: m["share"] >= ACCEPT))
    return found.select(
        "doc_id",
        "n_words",
        F.array_sort(F.flatten("phrases.starts")).alias("places"),
        F.array_sort(F.array_distinct("phrases.label")).alias("phrase_labels"),
        F.array_sort(F.array_union("phrases.label", "accepted.label")).alias("labels"),
        F.coalesce(F.array_max(F.concat("phrases.share", "accepted.share")), F.lit(0.0)).alias("score"),
        F.concat("phrases", "accepted").alias("matches"),
    )
