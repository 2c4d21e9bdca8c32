"""License scan: ordered signature rules on the words of a text.

A rule has a label, a priority (1 is strongest), a keyword and a regular
expression over words.  Rules are tried on a text only if it passes a cheap
prefilter (one of the ``GATE`` stems occurs) and then only if the rule's own
keyword occurs.  Overlapping detections are resolved by containment: a detection
is suppressed if its interval lies inside that of a detection of the same or a
stronger priority (of equal intervals the earlier rule stays).

Everything is DataFrame functions.  The text becomes its words, each between two
spaces of its own, so that neighbouring matches never share a space and the
place of a match counts in words.  Detections are one row each; a window over a
text's detections finds what is contained, and one aggregation brings each text
back to one row (both on the same key: one shuffle, of detections only).

Rules come from a table of license families times sentence forms (generated), after the
hand-written notices.  No rule repeats a group without a bound, as the JVM's regexes take a
stack frame for each repeat: texts of any length are answered.

Defined cases: null text counts as empty; a text without detections has empty
labels and score 0; repeated rows, also of equal ids, each give a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_of

#: Phrases that count in any text (fixed values), and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Stems of which every rule's keyword has one; a text without any has no detections.
GATE = ("licen", "spdx", "creativecommons", "public domain", "permission", "redistribution", "gnu", "copyleft", "warrant", "waived")

WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
_A_Z, _a_z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Sentences of the license texts themselves: (label, keyword, words).
NOTICES = (
    ("mit", "permission", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "permission", "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("apache", "license", "you may not use this file except in compliance with the license"),
    ("gpl", "gnu", "it under the terms of the gnu general public license"),
    ("lgpl", "gnu", "it under the terms of the gnu (?:lesser|library) general public license"),
    ("agpl", "gnu", "it under the terms of the gnu affero general public license"),
    ("mpl", "license", "this source code form is subject to the terms of the mozilla public license"),
    ("zlib", "permission", "permission is granted to anyone to use this software for any purpose"),
    ("boost", "permission", "permission is hereby granted free of charge to any person or organization"),
    ("unlicense", "public domain", "this is free and unencumbered software released into the public domain"),
    ("public domain", "public domain", "(?:placed|released|dedicated) (?:in|into|to) the public domain"),
    ("cc0", "waived", "to the extent possible under law (?:[^ ]+ ){0,60}?waived all copyright"),
    ("copyleft", "copyleft", "copyleft(?: all wrongs reserved)?"),
    ("proprietary", "permission", "(?:no part|may not be) (?:of this \\w+ may be )?reproduced without (?:(?:prior|written|express) ){0,6}permission"),
    ("warranty disclaimer", "warrant", "provided as is without warranty of any kind"),
    ("warranty disclaimer", "warrant", "without warranties or conditions of any kind"),
    ("apache", "license", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("gpl", "license", "everyone is permitted to copy and distribute verbatim copies of this license document"),
    ("wtfpl", "license", "everyone is permitted to copy and distribute verbatim or modified copies of this license document"),
    ("mpl", "license", "the contents of this file are subject to the mozilla public license"),
    ("epl", "license", "the accompanying program is provided under the terms of this eclipse public license"),
    ("cddl", "license", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("eupl", "licen", "this european union public licen[sc]e the eupl applies to the work"),
    ("ofl", "license", "this font software is licensed under the sil open font license"),
    ("artistic", "license", "this license establishes the terms under which a given free software package may be copied modified distributed and or redistributed"),
    ("php", "permission", "the name php must not be used to endorse or promote products derived from this software without prior written permission"),
    ("postgresql", "permission", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("bsl business", "licens", "the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work"),
    ("ms pl", "license", "this license governs use of the accompanying software if you use the software you accept this license"),
    ("cc", "license", "the work as defined below is provided under the terms of this creative commons public license"),
    ("openssl", "permission", "the names openssl toolkit and openssl project must not be used to endorse or promote products derived from this software without prior written permission"),
    ("gfdl", "license", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("no derivatives", "licens", "you may not distribute modified versions of the licensed (?:material|work)"),
)

#: (label, identifier words, names as they stand in prose).
FAMILIES = (
    ("mit", "mit", "mit|expat"),
    ("mit 0", "mit 0", "mit 0|mit no attribution"),
    ("apache", "apache", "apache(?: software)?"),
    ("apache 2.0", "apache 2 0", "apache(?: software)? license version 2(?: 0)?|apache 2(?: 0)?"),
    ("apache 1.1", "apache 1 1", "apache(?: software)? license version 1 1|apache 1 1"),
    ("bsd", "bsd", "(?:simplified |modified |revised |new |original )?bsd|bsd style"),
    ("bsd 2 clause", "bsd 2 clause", "bsd 2 clause|2 clause bsd|two clause bsd|freebsd"),
    ("bsd 3 clause", "bsd 3 clause", "bsd 3 clause|3 clause bsd|three clause bsd"),
    ("gpl", "gpl", "(?:gnu )?(?:gpl|general public)"),
    ("gpl 2.0", "gpl 2 0(?: only| or later)?", "gpl ?v? ?2(?: 0)?|gnu general public license version 2"),
    ("gpl 3.0", "gpl 3 0(?: only| or later)?", "gpl ?v? ?3(?: 0)?|gnu general public license version 3"),
    ("lgpl", "lgpl", "(?:gnu )?(?:lgpl|lesser general public|library general public)"),
    ("lgpl 2.1", "lgpl 2 1(?: only| or later)?", "lgpl ?v? ?2 1|lesser general public license version 2 1"),
    ("lgpl 3.0", "lgpl 3 0(?: only| or later)?", "lgpl ?v? ?3(?: 0)?|lesser general public license version 3"),
    ("agpl", "agpl 3 0(?: only| or later)?", "(?:gnu )?(?:agpl(?: ?v? ?3)?|affero general public)"),
    ("mpl", "mpl", "mpl|mozilla public"),
    ("mpl 2.0", "mpl 2 0", "mpl ?v? ?2 0|mozilla public license version 2 0"),
    ("epl", "epl", "epl|eclipse public"),
    ("epl 2.0", "epl 2 0", "epl ?v? ?2 0|eclipse public license version 2 0"),
    ("cddl", "cddl 1 [01]", "cddl|common development and distribution"),
    ("isc", "isc", "isc|internet systems consortium"),
    ("zlib", "zlib", "zlib(?: libpng)?"),
    ("boost", "bsl 1 0", "boost(?: software)?|bsl 1 0"),
    ("unlicense", "unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl|do what the fuck you want to public"),
    ("artistic", "artistic(?: [12] 0)?", "artistic|perl artistic"),
    ("eupl", "eupl 1 [0-2]", "eupl|european union public"),
    ("postgresql", "postgresql", "postgresql"),
    ("openssl", "openssl", "openssl(?: ssleay)?"),
    ("python", "psf 2 0|python 2 0", "psf|python software foundation"),
    ("php", "php 3 0[1]?", "php"),
    ("ruby", "ruby", "ruby"),
    ("ofl", "ofl 1 1", "ofl|sil open font|open font"),
    ("odbl", "odbl 1 0", "odbl|open database|open data commons open database"),
    ("pddl", "pddl 1 0", "pddl|public domain dedication and"),
    ("cc", "cc", "cc|creative commons"),
    ("cc by 4.0", "cc by 4 0", "(?:cc|creative commons) (?:by|attribution)(?: 4 0)?(?: international)?"),
    ("cc by sa 4.0", "cc by sa 4 0", "(?:cc|creative commons) (?:by sa|attribution share ?alike)(?: 4 0)?(?: international)?"),
    ("cc by nc", "cc by nc 4 0", "(?:cc|creative commons) (?:by nc|attribution non ?commercial)(?: 4 0)?(?: international)?"),
    ("cc by nd", "cc by nd 4 0", "(?:cc|creative commons) (?:by nd|attribution no ?derivatives)(?: 4 0)?(?: international)?"),
    ("cc by nc sa", "cc by nc sa 4 0", "(?:cc|creative commons) (?:by nc sa|attribution non ?commercial share ?alike)(?: 4 0)?"),
    ("cc by nc nd", "cc by nc nd 4 0", "(?:cc|creative commons) (?:by nc nd|attribution non ?commercial no ?derivatives)(?: 4 0)?"),
    ("cc0", "cc0 1 0", "cc0|cc zero|creative commons zero"),
    ("gfdl", "gfdl 1 [1-3](?: only| or later)?", "gfdl|gnu free documentation"),
    ("ms pl", "ms pl", "ms pl|microsoft public"),
    ("ms rl", "ms rl", "ms rl|microsoft reciprocal"),
    ("osl", "osl 3 0", "osl|open software"),
    ("afl", "afl 3 0", "afl|academic free"),
    ("ncsa", "ncsa", "ncsa|university of illinois ncsa open source"),
    ("cecill", "cecill(?: 2 1)?", "cecill"),
    ("bsl business", "busl 1 1", "busl|business source"),
    ("sspl", "sspl 1 0", "sspl|server side public"),
    ("elastic", "elastic 2 0", "elastic"),
    ("openrail", "openrail", "(?:creativeml )?open ?rail(?: m)?|responsible ai"),
    ("llama", "llama", "llama(?: [23])?(?: community)?"),
    ("x11", "x11", "x11|x consortium"),
    ("vim", "vim", "vim"),
    ("w3c", "w3c", "w3c(?: software)?"),
    ("blueoak", "blueoak 1 0 0", "blue ?oak(?: model)?"),
    ("mulan", "mulanpsl 2 0", "mulan(?: psl)?|mulan permissive software"),
)

#: (priority, keyword, words with the family's names or identifier in place).
FORMS = (
    (1, "spdx", "spdx license identifier (?:ID)"),
    (2, "licens", "(?:licensed|dual licensed|released|distributed|published|available|provided) under (?:the )?(?:terms (?:of|and conditions of) )?(?:the |an? )?(?:NAME)(?: licen[sc]e)?"),
    (3, "licen", "(?:NAME) licen[sc]e(?: agreement)?"),
    (4, "licen", "licen[sc]es? (?:is |type |name |under )?(?:the )?(?:NAME)"),
)

#: What a detection of a priority is worth.
WORTH = {1: 1.0, 2: 0.875, 3: 0.75, 4: 0.5}


def rules() -> list[tuple[int, str, int, str, str]]:
    """(number, label, priority, keyword, regex over doubled spaces)."""
    found = [(label, 1, keyword, words) for label, keyword, words in NOTICES]
    for priority, keyword, form in FORMS:
        for label, ident, names in FAMILIES:
            found.append((label, priority, keyword, form.replace("ID", ident).replace("NAME", names)))
    return [(n, label, p, k, w.replace(" ?", "(?:  )?").replace(" ", "  ").replace("(?:    )?", "(?:  )?"))
            for n, (label, p, k, w) in enumerate(found)]


def lowered(text: Column) -> Column:
    return F.translate(text, _A_Z, _a_z)


def _spaced(words: Column) -> Column:
    return F.concat(F.lit(" "), F.array_join(words, "  "), F.lit(" "))


def _whole(regex: Column) -> Column:
    """The regex between two spaces."""
    return F.concat(F.lit(" ("), regex, F.lit(") "))


def _intervals(spaced: Column, regex: Column) -> Column:
    """[start, end) of the regex's matches, in words: the matches are marked,
    and the marks sit on the first and last word."""
    marked = F.regexp_replace(spaced, _whole(regex), F.lit(" \x01$1\x02 "))
    words = F.split(F.trim(marked), "  ")
    at = lambda test: F.transform(F.filter(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))), test), lambda x: x["i"])
    return F.transform(F.arrays_zip(at(lambda x: x["w"].startswith("\x01")).alias("s"), at(lambda x: x["w"].endswith("\x02")).alias("e")),
                       lambda x: F.struct(x["s"].alias("start"), (x["e"] + 1).alias("end")))


def _places(spaced: Column, phrase: str, label: str) -> Column:
    """Where a phrase stands, with its label."""
    return F.transform(_intervals(spaced, F.lit(phrase.replace(" ", "  "))), lambda x: F.struct(x["start"].alias("start"), F.lit(label).alias("label")))


def detections(docs: DataFrame) -> DataFrame:
    """Detections of every text, one row each (one row with nulls for a text
    without any): row, doc_id, n_words, base, rule, label, priority, start, end, kept."""
    text = F.coalesce(text_of(docs), F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "text", F.size(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).cast("long").alias("n_words"))
    low = F.lower("text")
    # "public domain" may be split over lines: the gate asks for its last word
    gated = F.lit(False)
    for stem in GATE:
        gated = gated | low.contains(stem.split(" ")[-1])
    spaced = F.when(gated, _spaced(F.regexp_extract_all(lowered(F.col("text")), F.lit(WORD), F.lit(0))))
    rows = rows.select("row", "doc_id", "n_words", spaced.alias("spaced"))
    base = F.concat(*[_places(F.col("spaced"), phrase, label) for phrase, label in BASE])
    ordered = F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(label).alias("label"), F.lit(p).alias("priority"), F.lit(k.replace(" ", "  ")).alias("keyword"), F.lit(x).alias("regex"))
                        for n, label, p, k, x in rules()])
    fit = F.filter(ordered, lambda r: F.col("spaced").contains(r["keyword"]) & F.rlike(F.col("spaced"), _whole(r["regex"])))
    rows = rows.select("row", "doc_id", "n_words", "spaced", F.when(F.col("spaced").isNotNull(), base).alias("base"),
                       F.when(F.col("spaced").isNotNull(), fit).alias("fit"))
    # a text's base places stay on one of its rows: a copy a detection would grow with the square of their number
    tried = rows.select("row", "doc_id", "n_words", "base", "spaced", F.posexplode_outer("fit").alias("nth", "r"))
    tried = tried.select("row", "doc_id", "n_words", F.when(F.coalesce("nth", F.lit(0)) == 0, F.col("base")).alias("base"), "spaced", "r")
    found = tried.select("row", "doc_id", "n_words", "base", F.col("r.rule").alias("rule"), F.col("r.label").alias("label"), F.col("r.priority").alias("priority"),
                         F.posexplode_outer(F.when(F.col("r").isNotNull(), _intervals(F.col("spaced"), F.col("r.regex")))).alias("nth", "at"))
    found = found.withColumn("base", F.when(F.coalesce("nth", F.lit(0)) == 0, F.col("base")))
    found = found.select("row", "doc_id", "n_words", "base", "rule", "label", "priority", F.col("at.start").alias("start"), F.col("at.end").alias("end"))
    before = Window.partitionBy("row").orderBy(F.col("start").asc_nulls_last(), F.col("end").desc(), "priority", "rule").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.lit(False)
    for p in WORTH:
        reach = F.max(F.when(F.col("priority") <= p, F.col("end"))).over(before)
        inside = inside | ((F.col("priority") == p) & F.coalesce(reach >= F.col("end"), F.lit(False)))
    return found.withColumn("kept", F.col("start").isNotNull() & ~inside)


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: words, base places, labels, score, kept detections."""
    kept = F.when(F.col("kept"), F.struct("start", "end", "label", "rule", "priority"))
    # collect_list, not first, for the places: first copies its value at each row
    rows = detections(docs).groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.get(F.collect_list("base"), F.lit(0)).alias("base"), F.sort_array(F.collect_list(kept)).alias("found"))
    base = F.coalesce("base", F.array().cast("array<struct<start:int,label:string>>"))
    names = lambda x: F.array_join(F.array_sort(F.array_distinct(x)), ",")
    starts, labels = F.transform(base, lambda b: b["start"]), F.transform(base, lambda b: b["label"])
    worth = F.array_max(F.transform("found", lambda f: _worth(f["priority"])))
    return rows.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"), names(labels).alias("base_labels"),
        names(F.concat(labels, F.transform("found", lambda f: f["label"]))).alias("labels"),
        F.greatest(F.coalesce(worth, F.lit(0.0)), F.when(F.size(base) > 0, 0.5).otherwise(0.0)).alias("score"), "found")


def _worth(priority: Column) -> Column:
    out = F.lit(0.0)
    for p, w in WORTH.items():
        out = F.when(priority == p, w).otherwise(out)
    return out


def oracle_sql() -> str:
    """The same in SQL, over the whole table."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    table = ",\n".join(f"({n}, {quoted(label)}, {p}, {quoted(k.replace(' ', '  '))}, {quoted(x)})" for n, label, p, k, x in rules())
    base = " UNION ALL ".join(f"SELECT id, i - 1 AS start, {quoted(label)} AS label FROM b WHERE " + " AND ".join(
        f"words[i + {j}] = {quoted(w)}" for j, w in enumerate(p.split(" "))) for p, label in BASE)
    worth = " ".join(f"WHEN {p} THEN {w}" for p, w in WORTH.items())
    inside = " OR ".join(f"(priority = {p} AND coalesce(max(CASE WHEN priority <= {p} THEN fin END) OVER w >= fin, false))" for p in WORTH)
    return f"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_A_Z}', '{_a_z}'), '{WORD}') AS words FROM documents),
s AS (SELECT id, ' ' || array_to_string(words, '  ') || ' ' AS spaced FROM d),
r(rule, label, priority, keyword, regex) AS (VALUES {table}),
m AS (SELECT id, rule, label, priority, string_split(trim(regexp_replace(spaced, ' (' || regex || ') ', ' ' || chr(1) || '\\1' || chr(2) || ' ', 'g'), ' '), '  ') AS marked
      FROM s JOIN r ON contains(spaced, keyword)),
n AS (SELECT id, rule, label, priority, list_filter(list_transform(marked, lambda x, i: CASE WHEN starts_with(x, chr(1)) THEN i - 1 END), lambda x: x IS NOT NULL) AS a,
             list_filter(list_transform(marked, lambda x, i: CASE WHEN ends_with(x, chr(2)) THEN i END), lambda x: x IS NOT NULL) AS z FROM m),
f AS (SELECT id, rule, label, priority, unnest(a) AS start, unnest(z) AS fin FROM n),
k AS (SELECT id, label, priority, {inside} AS inside FROM f
      WINDOW w AS (PARTITION BY id ORDER BY start, fin DESC, priority, rule ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
b AS (SELECT id, words, unnest(range(1, len(words) + 1)) AS i FROM d WHERE list_contains(words, 'license')),
p AS ({base}),
pb AS (SELECT id, count(*) AS n, min(start) AS lo, max(start) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM p GROUP BY id),
l AS (SELECT id, label FROM p UNION SELECT id, label FROM k WHERE NOT inside),
pl AS (SELECT id, string_agg(label, ',' ORDER BY label) AS labels FROM l GROUP BY id),
ps AS (SELECT id, max(CASE priority {worth} END) AS score FROM k WHERE NOT inside GROUP BY id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base, lo AS first_word, hi AS last_word, coalesce(pb.labels, '') AS base_labels,
       coalesce(pl.labels, '') AS labels, CAST(greatest(coalesce(score, 0), CASE WHEN n > 0 THEN 0.5 ELSE 0 END) AS DOUBLE) AS score
FROM d LEFT JOIN pb USING (id) LEFT JOIN pl USING (id) LEFT JOIN ps USING (id)
"""
