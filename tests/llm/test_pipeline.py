import random

import pytest

import __spark_entry__ as entry
import corpus_pipeline as P


def words(rng, n):
    return [("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8)))) for _ in range(n)]


@pytest.fixture
def corpus(spark, tmp_path):
    rng = random.Random(8)
    items = [(k, " ".join(words(rng, 30))) for k in range(3)]
    rows, labels = [], []
    for i in range(260):
        w = words(rng, rng.randrange(30, 90))
        toxic = i % 5 == 0
        if toxic:
            w[3], w[20] = "scum", "vile"
        rows.append([i, " ".join(w), "en", "s", 0])
        labels.append((i, int(toxic), 1))
    rows.append([300, rows[1][1], "en", "s", 0])
    rows.append([301, rows[2][1] + " tail", "en", "s", 0])
    rows.append([302, " ".join(words(rng, 20)) + " " + items[1][1].upper() + " end", "en", "s", 0])
    rows.append([303, " ".join(words(rng, 20)) + " password=abcdefghijkl0 end", "en", "s", 0])
    rows += [[304, None, None, None, None], [305, "", "en", "s", 0], [None, "some lone words of no id", None, None, None]]
    for r in rows:
        r[4] = None if r[1] is None else len(r[1])
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path), rows


def test_every_stage_takes_effect(spark, corpus):
    folder, rows = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    ids = {r[0] for r in rows}
    seen = []
    for k, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, folder)
        if k < len(P.STAGES) - 1:
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        out.write.parquet(f"{folder}/out{k}")
        docs = spark.read.parquet(f"{folder}/out{k}")
        seen.append({r.doc_id for r in docs.select("doc_id").collect()})
    toxic = {i for i in range(260) if i % 5 == 0}
    assert len(seen[0] & toxic) <= 3 and ids - toxic <= seen[0]
    assert seen[1] == seen[0] - {300, 301}
    assert seen[2] == seen[1] - {302}
    masked = {r.doc_id: r for r in spark.read.parquet(f"{folder}/out3").collect()}
    assert seen[3] == seen[2] and "[secret] end" in masked[303].text and masked[303].n_chars == len(masked[303].text)
    assert masked[304].text is None and seen[4] == seen[3]
    whole = sorted(map(tuple, P.run(spark, folder).collect()), key=repr)
    assert {r[:5] for r in whole} == {tuple(r)[:5] for r in docs.collect()}


def test_registered():
    names = set(entry.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 14)}
    assert set(entry.oracle_sql()) <= names
