"""Licence scans by sentence rules, in DataFrame functions only.

Texts are cut into sentences, sentences are normalised and looked up among the known licence sentences; what is left of
a document is a short sequence of sentence identifiers, which is matched against rules: ordered lists of identifiers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

#: Known sentences, normalised. The wording of public licences and of usual licence lines.
SENTENCES = {
    "apache-line": "licensed under the apache license version 2 0",
    "apache-grant": "licensed under the apache license version 2 0 the license",
    "apache-use": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "apache-basis": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-see": "see the license for the specific language governing permissions and limitations under the license",
    "gpl3-line": "this work is licensed under the gnu general public license version 3",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-see": "see the gnu general public license for more details",
    "cc-by-nc-line": "licensed under cc by nc 4 0",
    "cc-by-line": "licensed under cc by 4 0",
    "cc-by-sa-line": "licensed under cc by sa 4 0",
    "mit-line": "released under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "bsd-forms": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "rights": "all rights reserved",
}
#: Rules: licence and the order of its sentences.
RULES = {
    "apache-2.0/line": ("Apache-2.0", ("apache-line",)),
    "apache-2.0/header": ("Apache-2.0", ("apache-grant", "apache-use", "apache-copy")),
    "apache-2.0/full": ("Apache-2.0", ("apache-grant", "apache-use", "apache-copy", "apache-basis", "apache-see")),
    "gpl-3.0/line": ("GPL-3.0", ("gpl3-line",)),
    "gpl-3.0/header": ("GPL-3.0", ("gpl-free", "gpl-hope", "gpl-see")),
    "cc-by-nc-4.0/line": ("CC-BY-NC-4.0", ("cc-by-nc-line",)),
    "cc-by-4.0/line": ("CC-BY-4.0", ("cc-by-line",)),
    "cc-by-sa-4.0/line": ("CC-BY-SA-4.0", ("cc-by-sa-line",)),
    "mit/line": ("MIT", ("mit-line",)),
    "mit/text": ("MIT", ("mit-grant", "mit-notice", "as-is")),
    "bsd-2/text": ("BSD-2-Clause", ("bsd-forms", "bsd-source", "bsd-binary")),
    "reserved": ("proprietary", ("rights",)),
}
BREAK = r"[.!?]\s+|\n+"


def normal(sentence: Column) -> Column:
    """ASCII letters and digits in lower case, one space between words."""
    return F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))


def scan(docs: DataFrame, sentences: dict[str, str] = SENTENCES, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per rule match: doc_id, rule, licence, first_sentence, last_sentence (places in the document, from 0).

    A rule matches where the sentences of its list follow each other in order among the document's sentences that
    belong to the rule; other text may stand between them. Null and empty texts match nothing. Rows with one id and
    one text count once; rows with one id and different texts are different documents. Other columns are ignored.
    """
    spark = docs.sparkSession
    known = spark.createDataFrame([(text, sid) for sid, text in sentences.items()], "sentence string, sid string")
    steps = spark.createDataFrame([(sid, name, licence, k, len(order)) for name, (licence, order) in rules.items() for k, sid in enumerate(order)],
                                  "sid string, rule string, licence string, step int, n int")
    cut = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text")).where("text IS NOT NULL")
    pieces = cut.select("doc_id", "text", F.posexplode(F.split("text", BREAK)).alias("at", "piece"))
    hits = pieces.withColumn("sentence", normal(F.col("piece"))).join(F.broadcast(known), "sentence")  # a row per known sentence
    sequence = hits.select("doc_id", F.md5("text").alias("content"), "at", "sid").distinct()
    own = ["doc_id", "content", "rule"]
    placed = (sequence.join(F.broadcast(steps), "sid")
              .withColumn("__island", F.row_number().over(Window.partitionBy(*own).orderBy("at", "step")) - F.col("step")))
    return (placed.groupBy(*own, "licence", "n", "__island")
            .agg(F.count(F.lit(1)).alias("__found"), F.min("at").alias("first_sentence"), F.max("at").alias("last_sentence"))
            .where("__found = n").select("doc_id", "rule", "licence", "first_sentence", "last_sentence"))


def oracle_sql(sentences: dict[str, str] = SENTENCES, rules=RULES) -> str:
    known = ", ".join(f"('{s}', '{i}')" for i, s in sentences.items())
    steps = ", ".join(f"('{sid}', '{name}', '{licence}', {k}, {len(order)})" for name, (licence, order) in rules.items() for k, sid in enumerate(order))
    return rf"""
WITH known(sentence, sid) AS (VALUES {known}), steps(sid, rule, licence, step, n) AS (VALUES {steps}),
pieces AS (SELECT doc_id, md5(text) AS content, string_split_regex(text, '[.!?]\s+|\n+') AS list FROM documents WHERE text IS NOT NULL),
numbered AS (SELECT doc_id, content, (i - 1)::INT AS pos, trim(regexp_replace(lower(list[i]), '[^a-z0-9]+', ' ', 'g')) AS sentence
             FROM pieces, unnest(range(1, len(list) + 1)) AS u(i)),
hits AS (SELECT DISTINCT doc_id, content, pos, sid FROM numbered JOIN known USING (sentence)),
placed AS (SELECT *, row_number() OVER (PARTITION BY doc_id, content, rule ORDER BY pos, step) - step AS island FROM hits JOIN steps USING (sid))
SELECT doc_id, rule, licence, min(pos) AS first_sentence, max(pos) AS last_sentence FROM placed
GROUP BY doc_id, content, rule, licence, n, island HAVING count(*) = n"""
