"""Licence recognition by sentences, then by ordered rules over sentence identifiers.

A text is cut into parts at line ends, after end marks, and before the openers of
licence sentences, so that a notice inside running text is met as well. Parts are
normalised (lower case, letters and digits only, years and holders left out), which takes
comment leaders away. A part, or a run of parts in a row, that equals an entry of a table of
known sentences is that sentence, so notices are met whatever their line width, and known
sentences may run across ':' and line ends. Each has an identifier. The identifiers of a
document, in order, are then matched with licence rules: a rule is an ordered list of
identifiers that must appear one after the other, other known sentences may stand
between. Where several rules of a family match, those with more sentences win over rules that
they contain.

Sentence and rule tables are fixed and small, so they are broadcast. Only texts with a
licence word are looked at; what moves is one row per recognised sentence. The identifiers
of one document meet in one row, so its size is that of the document's notices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_rows

# Known licence sentences, normalised, by identifier.
SENTENCES = [
    ("MIT-REF", "released under the mit license"),
    ("MIT-REF", "licensed under the mit license"),
    ("MIT-REF", "this project is licensed under the mit license"),
    ("MIT-REF", "this software is released under the mit license"),
    ("SPDX-MIT", "spdx license identifier mit"),
    ("MIT-GRANT", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("MIT-NOTICE", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("AS-IS", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("NO-LIABILITY", "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    ("APACHE-REF", "licensed under the apache license version 2 0"),
    ("APACHE-REF", "this project is licensed under the apache license version 2 0"),
    ("APACHE-GRANT", "licensed under the apache license version 2 0 the license"),
    ("APACHE-USE", "you may not use this file except in compliance with the license"),
    ("APACHE-COPY", "you may obtain a copy of the license at"),
    ("APACHE-AS-IS", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("APACHE-LIMITS", "see the license for the specific language governing permissions and limitations under the license"),
    ("SPDX-APACHE", "spdx license identifier apache 2 0"),
    ("GPL3-REF", "this work is licensed under the gnu general public license version 3"),
    ("GPL3-REF", "licensed under the gnu general public license version 3"),
    ("GPL-FREE", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("GPL2-FREE", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("GPL-HOPE", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("GPL-DETAILS", "see the gnu general public license for more details"),
    ("GPL-COPY", "you should have received a copy of the gnu general public license along with this program"),
    ("SPDX-GPL3", "spdx license identifier gpl 3 0 or later"),
    ("SPDX-GPL3", "spdx license identifier gpl 3 0 only"),
    ("BSD-GRANT", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("BSD-SOURCE", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("BSD-BINARY", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("BSD-ENDORSE", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("CC-BY-NC-REF", "licensed under cc by nc 4 0"),
    ("CC-BY-NC-REF", "this work is licensed under cc by nc 4 0"),
    ("CC-BY-REF", "licensed under cc by 4 0"),
    ("CC-BY-SA-REF", "licensed under cc by sa 4 0"),
    ("CC0-REF", "licensed under cc0 1 0"),
]
# Licence, family, whether commercial use is free, ordered sentence identifiers.
RULES = [
    ("MIT", "mit", True, ["MIT-REF"]),
    ("MIT", "mit", True, ["SPDX-MIT"]),
    ("MIT", "mit", True, ["MIT-GRANT", "MIT-NOTICE", "AS-IS"]),
    ("MIT-0", "mit", True, ["MIT-GRANT", "AS-IS"]),
    ("Apache-2.0", "apache", True, ["APACHE-REF"]),
    ("Apache-2.0", "apache", True, ["SPDX-APACHE"]),
    ("Apache-2.0", "apache", True, ["APACHE-GRANT", "APACHE-USE", "APACHE-COPY", "APACHE-AS-IS", "APACHE-LIMITS"]),
    ("GPL-3.0", "gpl", False, ["GPL3-REF"]),
    ("GPL-3.0", "gpl", False, ["SPDX-GPL3"]),
    ("GPL-3.0", "gpl", False, ["GPL-FREE", "GPL-HOPE"]),
    ("GPL-2.0", "gpl", False, ["GPL2-FREE", "GPL-HOPE"]),
    ("BSD-2-Clause", "bsd", True, ["BSD-GRANT", "BSD-SOURCE", "BSD-BINARY"]),
    ("BSD-3-Clause", "bsd", True, ["BSD-GRANT", "BSD-SOURCE", "BSD-BINARY", "BSD-ENDORSE"]),
    ("CC-BY-NC-4.0", "cc", False, ["CC-BY-NC-REF"]),
    ("CC-BY-4.0", "cc", True, ["CC-BY-REF"]),
    ("CC-BY-SA-4.0", "cc", False, ["CC-BY-SA-REF"]),
    ("CC0-1.0", "cc", True, ["CC0-REF"]),
]
# Where a licence sentence opens inside running text, and words that all of them hold.
OPENERS = "(?:Licensed under|Released under|This (?:work|project|software|program) is|Permission is hereby|Redistribution|SPDX-License-Identifier|You may (?:not use|obtain)|Unless required by|See the|The above copyright|In no event shall|Neither the name|You should have)"
WORDS = r"licen[sc]|permission|warrant|redistribut|liable|spdx|free software"
_BREAK = rf"\n+|(?<=[.!?:])[ \t]+|(?<=\S)[ \t]+(?={OPENERS})"
# Where a known sentence may also begin or end inside a part: the Apache notice goes on after ';' and into a URL.
_FINE = r"(?<=;)[ \t]+|[ \t]+(?=<?https?://)"
# A run of parts, each marked <place>, that is a known sentence; longer sentences first.
_RUN = r"<\d+>(?:" + "|".join(w.replace(" ", r"(?: |<\d+>)") for w in sorted({w for _, w in SENTENCES}, key=lambda w: (-len(w), w))) + ")(?=<)"


def normalised(sentence: Column) -> Column:
    """Lower case, single blanks, letters and digits only; years of a notice left out."""
    plain = F.regexp_replace(F.lower(sentence), r"\bcopyright\b.{0,80}?\b(19|20)\d\d\b", " ")
    return F.trim(F.regexp_replace(plain, r"[^a-z0-9]+", " "))


def sentence_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SENTENCES, "sentence_id string, sentence string")


def recognised(docs: DataFrame) -> DataFrame:
    """One row per known sentence of a document: ``doc_id, digest, at, sentence_id``.

    ``at`` is the place of the sentence's first part among all parts of the text; ``digest``
    tells texts with one doc_id apart.
    """
    rows = text_rows(docs).filter(F.lower("text").rlike(WORDS)).withColumn("digest", F.xxhash64("text"))
    rows = rows.select("doc_id", "digest", F.split("text", _BREAK).alias("parts"))
    marked = lambda part, at: F.concat(F.lit("<"), at.cast("string"), F.lit(">"), normalised(part))
    whole = F.filter(F.transform("parts", lambda x, i: F.when(F.lower(x).rlike(WORDS), marked(x, i))), lambda x: x.isNotNull())
    # Letters that lead comment lines go, and parts of marks alone do not stand between others.
    fine = F.transform("parts", lambda x, i: F.transform(F.split(x, _FINE), lambda y: marked(F.regexp_replace(y, r"(?i)^\s*(?:rem|dnl)\s", " "), i)))
    fine = F.filter(F.flatten(fine), lambda x: ~x.endswith(">"))
    runs = F.regexp_extract_all(F.concat(F.array_join(fine, ""), F.lit("<")), F.lit(_RUN), F.lit(0))
    met = rows.select("doc_id", "digest", F.explode(F.array_distinct(F.concat(whole, runs))).alias("met"))
    met = met.select("doc_id", "digest", F.regexp_extract("met", r"^<(\d+)>", 1).cast("int").alias("at"), F.trim(F.regexp_replace("met", r"<\d+>", " ")).alias("sentence"))
    return met.join(F.broadcast(sentence_table(docs.sparkSession)), "sentence").select("doc_id", "digest", "at", "sentence_id")


def _holds(have: Column, want: list[str]) -> Column:
    """Whether ``want`` is an ordered part of the array ``have``: a fold counting its met items."""
    steps = F.array(*[F.lit(w) for w in want])
    met = F.aggregate(have, F.lit(0), lambda k, x: F.when((k < len(want)) & (F.get(steps, k) == x), k + 1).otherwise(k))
    return met == len(want)


def licenses(docs: DataFrame) -> DataFrame:
    """``doc_id, license, family, commercial, n_sentences, first_at`` per document and licence.

    Documents without a known notice have no row, nor have null and empty texts or empty
    tables. Rows repeated in full count once; a null doc_id is kept as it is; columns
    besides doc_id and text are ignored. A rule inside a longer matched rule of its family
    is left out; equal licences from several rules give one row.
    """
    seen = recognised(docs).distinct().groupBy("doc_id", "digest").agg(F.array_sort(F.collect_list(F.struct("at", "sentence_id"))).alias("seen"))
    names = F.transform("seen", lambda x: x["sentence_id"])
    tries = []
    for name, family, commercial, want in RULES:
        longer = [w for _, f, _, w in RULES if f == family and len(w) > len(want) and _inside(want, w)]
        hit = _holds(names, want)
        for w in longer:
            hit = hit & ~_holds(names, w)
        first = _first_at(want[0])
        tries.append(F.when(hit, F.struct(F.lit(name).alias("license"), F.lit(family).alias("family"), F.lit(commercial).alias("commercial"), F.lit(len(want)).alias("n"), first.alias("at"))))
    found = seen.select("doc_id", "digest", F.explode(F.array_compact(F.array(*tries))).alias("x")).select("doc_id", "digest", "x.*")
    return found.groupBy("doc_id", "digest", "license", "family", "commercial").agg(F.max("n").alias("n_sentences"), F.min("at").alias("first_at")).drop("digest")


def _first_at(sentence_id: str) -> Column:
    return F.get(F.filter("seen", lambda x: x["sentence_id"] == sentence_id), F.lit(0))["at"]


def _inside(short: list[str], long: list[str]) -> bool:
    rest = iter(long)
    return all(x in rest for x in short)


def op4_licenses(spark, sf_dir: str) -> DataFrame:
    return licenses(table(spark, sf_dir, "documents"))


def _values(rows) -> str:
    return ", ".join("(" + ", ".join("'" + str(x).replace("'", "''") + "'" for x in row) + ")" for row in rows)


#: The oracle covers rules of any length by joining the rule's identifiers in order.
OP4_SQL = f"""
WITH known(sentence_id, sentence) AS (VALUES {_values(SENTENCES)}),
rules(rule, license, family, commercial, wants) AS (VALUES {", ".join(f"({k}, '{n}', '{f}', {c}, {w})" for k, (n, f, c, w) in enumerate(RULES))}),
texts AS (SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM documents WHERE regexp_matches(lower(text), '{WORDS}')),
cut AS (SELECT doc_id, text, regexp_split_to_array(regexp_replace(regexp_replace(text, '([.!?:])[ \\t]+', '\\1' || chr(10), 'g'), '[ \\t]+({OPENERS[3:]}', chr(10) || '\\1', 'g'), '\\n+') AS s FROM texts),
said AS (SELECT doc_id, text, unnest(s) AS sentence, generate_subscripts(s, 1) - 1 AS pos FROM cut),
plain AS (SELECT doc_id, text, pos, trim(regexp_replace(regexp_replace(lower(sentence), '\\bcopyright\\b.{{0,80}}?\\b(19|20)\\d\\d\\b', ' ', 'g'), '[^a-z0-9]+', ' ', 'g')) AS sentence FROM said WHERE regexp_matches(lower(sentence), '{WORDS}')),
seen AS (SELECT doc_id, text, list(sentence_id ORDER BY pos) AS ids, list(pos ORDER BY pos) AS ats FROM (SELECT DISTINCT doc_id, text, pos, sentence_id FROM plain JOIN known USING (sentence)) GROUP BY ALL),
tried AS (SELECT s.*, r.*, list_reduce(list_prepend(0, list_transform(ids, lambda x: list_position(wants, x))), lambda k, p: CASE WHEN p = k + 1 THEN p ELSE k END) AS met FROM seen s, rules r),
hits AS (SELECT *, ats[list_position(ids, wants[1])] AS pos FROM tried WHERE met = len(wants)),
kept AS (SELECT h.* FROM hits h WHERE NOT EXISTS (SELECT 1 FROM hits o WHERE o.doc_id IS NOT DISTINCT FROM h.doc_id AND o.text = h.text AND o.family = h.family AND len(o.wants) > len(h.wants)
  AND list_reduce(list_prepend(0, list_transform(o.wants, lambda x: list_position(h.wants, x))), lambda k, p: CASE WHEN p = k + 1 THEN p ELSE k END) = len(h.wants)))
SELECT doc_id, license, family, commercial, max(len(wants))::INTEGER AS n_sentences, min(pos)::INTEGER AS first_at FROM kept GROUP BY doc_id, text, license, family, commercial
"""
