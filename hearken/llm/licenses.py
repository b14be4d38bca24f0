"""License scans by diagonal voting, in DataFrame functions alone.

Every text's rolling word grams are joined with the grams of phrase templates: pairs of words for the base phrases, GRAM
words for the longer notices. A match at word p of a template's gram t votes for the diagonal p - t. A base phrase stands
where all its grams vote on one diagonal. For notices, a diagonal is merged with its neighbours up to BAND beyond it, so
words put in or left out cost only their own votes; the span of such a band is verified by the template's words that it
has, each counted once however often they are voted for: VERIFIED of the template's words, and of the span's, at least. A
share of words cannot tell licences that differ in one, so a notice has deciding grams (its version, its kind), each of which
must have voted. Pairs of words that no template has go where they are read; the others are joined by hash and compared as
strings, so no hash decides.

Nulls and empty texts have no words and score 0; texts are scanned whole; each row is answered by itself, even where
doc_ids repeat or are null; an empty table gives an empty result; other columns are ignored. The templates are a table
of the caller's size, a gram a row, which is part of the plan and broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Phrases and labels that are always reported. Fixed values.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Notices, whole and in their usual one-line forms. Fixed values.
TEMPLATES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at": "apache-2.0",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache-2.0",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction": "mit",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd",
    "licensed under the gnu general public license version 3": "gpl-3.0",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl-notice",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "gpl-notice",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under the creative commons attribution license": "cc-by",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
    "mozilla public license version 2 0": "mpl-2.0",
}
#: Grams that tell a licence from its neighbours, by label: a span has to have those of them that its notice has, unbroken.
#: Fixed values.
DECIDING = {
    "apache-2.0": ("version 2 0",),
    "mit": ("the mit license", "without restriction"),
    "isc": ("with or without fee",),
    "bsd": ("with or without modification",),
    "gpl-3.0": ("gnu general public", "license version 3"),
    "gpl-notice": ("gnu general public",),
    "cc-by-nc": ("by nc 4",),
    "cc-by": ("commons attribution license", "commons attribution 4 0"),
    "mpl-2.0": ("mozilla public license", "license v 2 0", "license version 2 0"),
}
GRAM, VERIFIED, BAND = 3, 0.75, 4
APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lowered(text: Column) -> Column:
    """A-Z in lower case. lower() does the same to ASCII, and maps nothing else to it but these two letters."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    rare = text.contains("\u0130") | text.contains("\u212a")
    return F.when(rare, F.translate(text, upper, upper.lower())).otherwise(F.lower(text))


def words_of(text: Column) -> Column:
    """Maximal runs of digits, letters and characters beyond ASCII."""
    return F.array_remove(F.split(lowered(F.coalesce(text, F.lit(""))), APART), "")


def deciding(phrase: str, label: str) -> list[int]:
    """The places of a notice's grams that lie in one of its deciding runs of words."""
    own, places = phrase.split(), set()
    for run in DECIDING.get(label, ()):
        words = run.split()
        for at in range(len(own) - len(words) + 1):
            if own[at : at + len(words)] == words:
                first = max(0, min(at, len(own) - GRAM))
                places |= set(range(first, max(first, at + len(words) - GRAM) + 1))
    return sorted(places)


def _rows(base: dict[str, str], longer: dict[str, str]) -> list[str]:
    """SQL rows (template, label, base, total, place, gram, third, must), one for each gram; a base phrase's have no third
    word, and their total is that of its grams; a notice's is that of its words; must are the places that have to vote."""
    rows = []
    for number, (phrase, label) in enumerate([*base.items(), *longer.items()]):
        own, always = phrase.split(), number < len(base)
        if len(own) < (2 if always else GRAM):
            raise ValueError(f"a template is too short: {phrase}")
        must = "" if always else ", ".join(map(str, deciding(phrase, label)))
        for t in range(len(own) - (1 if always else GRAM - 1)):
            third = "CAST(NULL AS STRING)" if always else f"'{own[t + 2]}'"
            fixed = f"{number}, '{label}', {str(always).lower()}, {len(own) - always}, {t}"
            rows.append(f"({fixed}, '{own[t]} {own[t + 1]}', {third}, CAST(array({must}) AS array<int>))")
    return rows


def templates(spark: SparkSession, base: dict[str, str] = BASE, longer: dict[str, str] = TEMPLATES) -> DataFrame:
    """template, label, base, total, place, gram, third, must: a row for each gram, as a table of the plan itself."""
    names = "template, label, base, total, place, gram, third, must"
    return spark.sql(f"SELECT * FROM VALUES {', '.join(_rows(base, longer))} AS t({names})")


def scan(docs: DataFrame, base: dict[str, str] = BASE, longer: dict[str, str] = TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row."""
    known = templates(docs.sparkSession, base, longer).withColumn("key", F.xxhash64("gram")).withColumnsRenamed({"gram": "phrase", "third": "after"})
    cut = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), words_of(F.col("text").cast("string")).alias("words"))
    from_word = lambda k: F.expr(f"slice(words, {k}, greatest(size(words), 1))")
    pairs = F.zip_with("words", from_word(2), lambda a, b: F.concat(a, F.lit(" "), b))
    some = sorted({" ".join(p) for phrase in [*base, *longer] for p in zip(phrase.split(), phrase.split()[1:])})
    every = F.zip_with(pairs, from_word(3), lambda a, b: F.struct(a.alias("gram"), b.alias("third")))
    placed = F.transform(every, lambda g, i: F.when(g["gram"].isin(some), F.struct(i.alias("pos"), g["gram"].alias("gram"), g["third"].alias("third"))))
    rows = cut.select("doc_id", "row", F.size("words").cast("long").alias("n_words"), F.explode_outer(F.array_compact(placed)).alias("own"))
    rows = rows.select("doc_id", "row", "n_words", "own.pos", "own.gram", "own.third")
    match = (F.xxhash64("gram") == F.col("key")) & (F.col("gram") == F.col("phrase")) & (F.col("after").isNull() | (F.col("after") == F.col("third")))
    voted = rows.join(F.broadcast(known), match, "left")  # a row of each text is left, and one of nothing for idle pairs
    voted = voted.select("row", "doc_id", "n_words", "template", "label", "base", "total", (F.col("pos") - F.col("place")).alias("diagonal"), "place", "must")
    firsts = [F.first(c).alias(c) for c in ("doc_id", "n_words", "label", "base", "total", "must")]
    lines = voted.repartition("row").groupBy("row", "template", "diagonal").agg(*firsts, F.collect_list("place").alias("places"))
    band = Window.partitionBy("row", "template").orderBy("diagonal").rangeBetween(0, BAND)
    near = F.flatten(F.collect_list("places").over(band))
    covered = F.array_distinct(F.flatten(F.transform(near, lambda p: F.sequence(p, p + (GRAM - 1)))))
    decided = F.size(F.array_except("must", near)) == 0
    span = F.max(F.col("diagonal") + F.array_max("places") + GRAM).over(band) - F.min(F.col("diagonal") + F.array_min("places")).over(band)
    told = lines.withColumn("share", F.when(~F.col("base") & decided, F.size(covered) / F.greatest("total", span)))
    told = told.withColumn("whole", F.col("base") & (F.size("places") == F.col("total"))).withColumn("seen", F.col("whole") | (F.col("share") >= VERIFIED))
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return told.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.count(F.when(F.col("whole"), 1)).alias("n_base"),
        F.min(F.when(F.col("whole"), F.col("diagonal").cast("long"))).alias("first_word"),
        F.max(F.when(F.col("whole"), F.col("diagonal").cast("long"))).alias("last_word"),
        joined(F.when(F.col("whole"), F.col("label"))).alias("base_labels"),
        joined(F.when(F.col("seen"), F.col("label"))).alias("labels"),
        F.coalesce(F.max(F.when(F.col("seen"), F.when(F.col("whole"), 1.0).otherwise(F.col("share")))), F.lit(0.0)).alias("score"),
    ).drop("row")


def oracle() -> str:
    """The same in DuckDB's SQL, told from words and their positions: base phrases are compared with slices of the text, and
    a notice is seen where, from some run of its words on, enough of its words stand in runs shifted by 0 to BAND words."""
    musts = ", ".join(f"({i}, {deciding(phrase, label)}::INT[])" for i, (phrase, label) in enumerate(TEMPLATES.items()))
    values = lambda names: ", ".join(f"({i}, '{phrase}', '{label}')" for i, (phrase, label) in enumerate(names.items()))
    return rf"""
        WITH base(b, phrase, label) AS (VALUES {values(BASE)}),
             notices(n, phrase, label) AS (VALUES {values(TEMPLATES)}),
             must(n, places) AS (VALUES {musts}),
             d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
             spots AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d),
             found AS (SELECT r, i - 1 AS p, label FROM spots JOIN base ON w[i] = string_split(phrase, ' ')[1] AND w[i:i + len(string_split(phrase, ' ')) - 1] = string_split(phrase, ' ')),
             f AS (SELECT r, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word, list_sort(list(DISTINCT label)) AS ls FROM found GROUP BY r),
             runs AS (SELECT n, phrase, label, t, x FROM (SELECT n, phrase, label, string_split(phrase, ' ') AS x, unnest(range(1, len(string_split(phrase, ' ')) - {GRAM - 2})) AS t FROM notices)),
             same AS (SELECT r, n, label, len(x) AS words, i, t FROM spots JOIN runs ON w[i] = x[t] AND w[i + 1] = x[t + 1] AND w[i:i + {GRAM - 1}] = x[t:t + {GRAM - 1}]),
             near AS (SELECT a.r, a.n, a.label, a.words, a.i, a.t, b.i AS other, b.t - 1 AS place, unnest(range(b.t, b.t + {GRAM})) AS word
                      FROM same a JOIN same b ON a.r = b.r AND a.n = b.n AND (b.i - b.t) - (a.i - a.t) BETWEEN 0 AND {BAND}),
             shares AS (SELECT r, label, count(DISTINCT word)::DOUBLE / greatest(words, max(other) + {GRAM} - min(other)) AS share
                        FROM near JOIN must USING (n) GROUP BY r, n, label, words, i, t, places HAVING len(list_filter(places, lambda p: NOT list_contains(list(DISTINCT place), p))) = 0),
             s AS (SELECT r, max(share) AS share, list(DISTINCT label) AS ls FROM shares WHERE share >= {VERIFIED} GROUP BY r)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
               array_to_string(coalesce(f.ls, []), ',') AS base_labels,
               array_to_string(list_sort(list_distinct(list_concat(coalesce(f.ls, []), coalesce(s.ls, [])))), ',') AS labels,
               CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score
        FROM d LEFT JOIN f USING (r) LEFT JOIN s USING (r)"""
