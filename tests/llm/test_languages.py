import random

import numpy as np

from tallyridge.llm import languages as L

SOUNDS = {"xa": "ka lo mi re tu".split(), "yo": "sch ei ung ber ach".split(), "zu": "ção nh ões lh á".split()}
SCHEMA = "doc_id long, text string, lang string, score string"


def sentence(rng, lang, n):
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n)) + "."


def corpus(seed, n=300):
    rng = random.Random(seed)
    return [(i, sentence(rng, lang, rng.randrange(4, 40)), lang, "?") for i in range(n) for lang in [rng.choice(sorted(SOUNDS))]]


def test_held_out_accuracy_mixtures_and_odd_rows(spark):
    rng = random.Random(9)
    mixed = sentence(rng, "xa", 60) + " " + sentence(rng, "yo", 20)
    odd = [(900, None, "xa", None), (901, "", None, None), (902, "12 .. 7²", "yo", None), (903, mixed, None, None), (903, mixed, None, None), (None, "kalo mire", None, None)]
    docs = spark.createDataFrame(corpus(1) + odd, SCHEMA)
    model = L.learn(docs.where(~L.held_out()))
    assert model.languages == ("xa", "yo", "zu")
    got = L.identify(docs, model)
    assert got.columns == ["doc_id", "text", "lang", "languages", "lang_pred", "score"]
    rows = got.collect()
    known = [r for r in rows if r.doc_id is not None and r.doc_id < 900]
    assert np.mean([r.lang == r.lang_pred for r in known]) == 1
    special = {r.doc_id: r for r in rows}
    assert all((special[k].lang_pred, special[k].score, special[k].languages) == ("und", 0.0, {}) for k in (900, 901, 902))
    assert set(special[903].languages) == {"xa", "yo"} and 0.65 < special[903].languages["xa"] < 0.85 and special[903].lang_pred == "xa"
    assert special[None].lang_pred == "xa" and len(rows) == len(corpus(1)) + 6


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame(corpus(2, 5), SCHEMA)
    model = L.learn(docs.where("lang IS NULL"))
    assert {(r.lang_pred, r.score) for r in L.identify(docs, model).collect()} == {("und", 0.0)}
    assert L.identify(docs.limit(0), L.learn(docs)).count() == 0


def test_proportions_equal_plain_em():
    x = np.random.default_rng(1).random((50, 3))
    share = np.full(3, 1 / 3)
    for _ in range(12):
        share = np.array([np.mean([share[k] * row[k] / sum(share * row) for row in x]) for k in range(3)])
    assert np.allclose(L.proportions(x, np.full(3, 1 / 3))[0], share, atol=5e-3)


def test_trigrams_of_words():
    starts, at = L.grams(["ab", "abc", "b"], 16)
    assert starts.tolist() == [0, 2, 5] and len(at) == 6
    assert at[0] == at[2] and at[:2].tolist() != at[2:4].tolist()
