"""Letters, rare languages and repeated ids."""

import random

from pyspark.sql import functions as F

from goldpan.llm import language


def test_number_signs_are_no_letters():
    for text in ("½ ²", "Ⅻ", "①", "12 ³ !", "", None, "__"):
        assert language.letters_only(text) == ""
    assert language.letters_only("½ é 3") != "" and language.letters_only("A1b") == " a b "


def test_a_rare_language_is_learned_and_null_ids_are_spread(spark):
    rng = random.Random(1)
    letters = {"aa": "abcde", "bb": "fghij", "zz": "klmno"}
    rows = []
    for k in range(3000):
        lang = "zz" if k % 100 == 0 else "aa" if k % 2 else "bb"
        rows.append((None if k % 3 else k, " ".join("".join(rng.choice(letters[lang]) for _ in range(6)) for _ in range(12)), lang))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = language.fit_language_model(df, language.Settings(sample_rows=120, buckets=1 << 10))
    assert model.languages == ("aa", "bb", "zz")
    scored = df.select("lang", language.predict_language(df, model).alias("p"))
    assert scored.where("lang = 'zz' and p.lang_pred = 'zz'").count() >= 27
    assert scored.where(F.col("lang") == F.col("p.lang_pred")).count() > 2900
