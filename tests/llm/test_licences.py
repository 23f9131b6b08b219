from tallyridge.llm import licences as L

SCHEMA = "doc_id long, text string, rule string, sid string"


def scan(spark, rows):
    got = L.scan(spark.createDataFrame([(i, t, "r", "s") for i, t in rows], SCHEMA))
    return sorted(tuple(r) for r in got.collect())


def test_lines_and_ordered_texts(spark):
    bsd = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n"
    source = " * Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n"
    binary = (" * Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
              "and/or other materials provided with the distribution.\n")
    rows = [(1, "Some text. Licensed under the Apache License, Version 2.0.\nMore."), (2, bsd + source + "Other words here.\n" + binary), (3, bsd + binary + source),
            (4, "released   UNDER the MIT\tlicense"), (4, "released   UNDER the MIT\tlicense"), (5, None), (6, ""), (7, "All rights reserved. x. All rights reserved!"), (8, "not all rights reserved")]
    assert scan(spark, rows) == [
        (1, "apache-2.0/line", "Apache-2.0", 1, 1), (2, "bsd-2/text", "BSD-2-Clause", 0, 3), (4, "mit/line", "MIT", 0, 0), (7, "reserved", "proprietary", 0, 0),
        (7, "reserved", "proprietary", 2, 2)]


def test_repeated_sequences_and_empty_table(spark):
    sentences = {"a": "one two", "b": "three four"}
    docs = spark.createDataFrame([(1, "One two. Three four. x y. One two. Three four. Three four. One two")], "doc_id long, text string")
    got = L.scan(docs, sentences, {"r": ("Lic", ("a", "b"))}).collect()
    assert sorted((r.first_sentence, r.last_sentence) for r in got) == [(0, 1), (3, 4)]
    assert L.scan(docs.limit(0)).count() == 0


def test_rules_name_known_sentences():
    assert {sid for _, order in L.RULES.values() for sid in order} == set(L.SENTENCES)
    assert len(set(L.SENTENCES.values())) == len(L.SENTENCES)
