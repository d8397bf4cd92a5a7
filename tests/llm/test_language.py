import os

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm.language import LanguageModel, fit_languages, identify_languages
from ledgerloom.llm.queries import QUERIES

from .messy import ROWS, documents

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_held_out_accuracy(spark):
    out = QUERIES["op6_language"](spark, FOLDER)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    hit = out.join(docs, "doc_id").where("held_out").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.min("score"), F.max("score")
    ).first()
    assert hit[0] > 0.97 and 0 <= hit[1] and hit[2] <= 1
    assert out.count() == docs.count()


def test_messy_rows(spark):
    train = [(i, f"the quick brown fox {i} and the dog", "en", "a") for i in range(30)]
    train += [(i, f"der schnelle braune fuchs {i} und der hund", "de", "a") for i in range(30)]
    train += [(i, f"le renard brun {i} et le chien", "fr", "a") for i in range(30)]
    train += [(i, f"el zorro marrón {i} y el perro", "es", "a") for i in range(30)]
    train += [(i, f"qaz wsx edc {i}", "xx", "a") for i in range(30)]
    df = documents(spark, train)
    model = fit_languages(df, "text", "lang", F.col("doc_id"), F.lit(True))
    assert model.families == ["germanic", "romance", "xx"]
    out = identify_languages(documents(spark), model)
    assert out.count() == len(ROWS) and set(out.columns) == set(documents(spark).columns)
    of = {r.text: (r.lang_pred, r.score) for r in out.collect()}
    for text in (None, "", " \t\n\x0b\x0c\r ", "!!! ... 123 \n\n"):
        assert of[text] == ("und", 0.0)
    same = identify_languages(df, model).where("lang_pred != lang").count()
    assert same == 0


def test_little_to_learn_from(spark):
    df = documents(spark)
    assert fit_languages(documents(spark, []), "text", "lang", F.col("doc_id"), F.lit(True)) is None
    assert {r.lang_pred for r in identify_languages(df, None).collect()} == {"und"}
    one = fit_languages(df.where("lang = 'en'"), "text", "lang", F.col("doc_id"), F.lit(True))
    assert {r.lang_pred for r in identify_languages(df, one).collect()} == {"und", "en"}
    assert identify_languages(documents(spark, []), one).count() == 0


def test_the_model_is_not_fitted_in_the_driver(spark, monkeypatch):
    driver, fit = os.getpid(), LanguageModel.__init__

    def fitted(self, langs, x):
        assert os.getpid() != driver
        fit(self, langs, x)

    monkeypatch.setattr(LanguageModel, "__init__", fitted)
    texts = [(i, "the cat sat there" if i % 2 else "die Katze sitzt dort", "en" if i % 2 else "de") for i in range(20)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string, lang string")
    model = fit_languages(docs, "text", "lang", F.col("doc_id"), F.lit(True))
    assert model.langs == ["de", "en"] and len(model.machines) == 1
