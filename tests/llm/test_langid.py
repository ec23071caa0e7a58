import random

import numpy as np
from pyspark.sql import functions as F

from tickloom.llm import langid
from tickloom.llm.queries import QUERIES

SYLLABLES = {"aa": ["ka", "lo", "mi", "tur"], "bb": ["sch", "ein", "ung", "ber"], "cc": ["é", "oux", "ion", "re"]}


def sentence(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(2, 4))) for _ in range(n))


def corpus(spark, n=90):
    rng = random.Random(8)
    rows = [(i, sentence(rng, lang := list(SYLLABLES)[i % 3], 40), lang) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_numerals_are_no_letters(spark):
    assert langid.words_of("½ ② Ⅳ ² x² aⅣb 3c٣d") == ["x", "a", "b", "c", "d"]
    model = langid.fit(corpus(spark), F.lit(True))
    rows = spark.createDataFrame([(1, "½ ② Ⅳ"), (2, "²"), (3, "2² ka")], "doc_id long, text string")
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.label(rows, model).collect()}
    assert found[1] == found[2] == ("und", 0.0) and found[3][0] == "aa"


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op10_crf_language"](spark, sf_dir).join(docs, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == docs.count() and 0 < len(held) < len(rows)
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_words_of_a_switched_text(spark):
    model = langid.fit(corpus(spark), F.lit(True))
    rng = random.Random(9)
    text = f"{sentence(rng, 'aa', 12)}. {sentence(rng, 'bb', 20)}! {sentence(rng, 'cc', 6)}"
    row = langid.label(spark.createDataFrame([(text,)], "text string"), model, spans=True).first()
    assert [s["lang"] for s in row["lang_spans"]] == ["aa", "bb", "cc"]
    assert all(abs(s["words"] - n) <= 1 for s, n in zip(row["lang_spans"], (12, 20, 6)))
    assert row["lang_pred"] == "bb" and abs(row["score"] - 20 / 38) < 0.05


def test_learns_from_training_rows_only(spark):
    docs = corpus(spark)
    model = langid.fit(docs, F.col("lang") != "cc")
    assert model["languages"] == ["aa", "bb"]
    assert langid.fit(docs, F.lit(False)) is None
    # The language column of a row to be labelled has no effect.
    wrong = docs.withColumn("lang", F.lit("bb"))
    first = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.label(docs, model).collect()}
    assert first == {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.label(wrong, model).collect()}


def test_odd_rows(odd, nothing):
    odd = odd.withColumn("__text", F.lit("x"))
    model = langid.fit(odd, F.lit(True), iterations=2)
    rows = langid.label(odd, model, spans=True).collect()
    assert len(rows) == odd.count()
    und = {r["doc_id"] for r in rows if r["lang_pred"] == langid.UNDETERMINED}
    assert und == {3, 4, 6, 7} and all(r["score"] == 0 and r["lang_spans"] == [] for r in rows if r["doc_id"] in und)
    assert sum(s["words"] for r in rows if r["doc_id"] == 5 for s in r["lang_spans"]) == 60_000
    assert langid.fit(nothing, F.lit(True)) is None
    assert langid.label(nothing, model).collect() == []
    assert {r["lang_pred"] for r in langid.label(odd, None).collect()} == {langid.UNDETERMINED}


def test_a_kept_text_travels_once(spark, monkeypatch):
    """The texts of a task's batch lie in the executor and in the worker; a second copy doubles both."""
    docs = corpus(spark)
    model, sent = langid.fit(docs, F.lit(True), iterations=2), []
    plain = type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, *args: (sent.append(self.columns), plain(self, *args))[1])
    whole = langid.label(docs, model)
    bare = langid.label(docs, model, keep=["doc_id"])
    assert sent == [["doc_id", "text", "lang"], ["doc_id", "_text"]]
    assert whole.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    assert sorted(r[0:1] + r[3:] for r in whole.collect()) == sorted(tuple(r) for r in bare.collect())
    assert {tuple(r)[:3] for r in whole.collect()} == {tuple(r) for r in docs.collect()}
    # A text of another type is read as a string and kept as it is.
    coded = langid.label(docs.withColumn("text", F.encode("text", "UTF-8")), model).first()
    assert isinstance(coded["text"], (bytes, bytearray)) and coded["lang_pred"] in model["languages"]


def test_words_are_kept_in_bounds(monkeypatch):
    """Also within the texts that are labelled together, whose word numbers stay valid."""
    rng = random.Random(3)
    texts = [sentence(rng, lang, 30).split() for lang in SYLLABLES for _ in range(20)]
    weights = np.random.default_rng(4).normal(size=(langid.SIZE, 3)).astype(np.float32)

    def scores(bound):
        monkeypatch.setattr(langid, "CACHED_WORDS", bound)
        words, flat, most = langid.Words(weights, {}), [], 0
        for text in texts:
            flat.append(words.number([text])[1])
            most = max(most, len(words.numbers))
        return most, words.potentials[np.concatenate(flat)]

    most, found = scores(50)
    assert most <= 50 + 30
    assert (found == scores(10**6)[1]).all()
