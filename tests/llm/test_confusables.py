import unicodedata

from pyspark.sql import functions as F

from quillspark.llm import confusables as C


def forms(spark, texts):
    df = spark.createDataFrame([(k, -1, t) for k, t in enumerate(texts)], "poem_no long, line_id int, text string")
    return {r["text"]: (r["form"], list(r["kinds"])) for r in C.canonical(df).collect()}


def test_cases(spark):
    cases = {
        "Ｈｖｅｒ　ｄａｇ": ("Hver dag", ["space", "wide"]), "måne": ("måne", ["mark"]), "Kom̄ nu": ("Kom̄ nu", []), "N\xadå​r﻿": ("Når", ["invisible"]), "a b c": ("a b c", ["space"]),
        "Stuеsværdеt rejѕer": ("Stuesværdet rejser", ["alike"]), "(λόγος) [песня] Ζεύς": ("(λόγος) [песня] Ζεύς", []), "ɡlɑd": ("glad", ["alike"]), "Sօllæbe": ("Sollæbe", ["alike"]), "Η​ver": ("Hver", ["alike", "invisible"]),
        "ậ": ("ậ", ["mark"]), "ậ": ("ậ", ["mark"]), "ȫx́": ("ȫx́", ["mark"]), "Ʒ ö ÿ é": ("Ʒ ö ÿ é", []), "́ x": ("́ x", []), "е": ("е", []), "a" * 3000 + "​": ("a" * 3000, ["invisible"]),
    }
    assert forms(spark, list(cases)) == cases


def test_marks_are_composed_as_by_the_standard(spark):
    import random

    rnd = random.Random(7)
    marks = ["́", "̈", "̊", "̣", "̂", "̄", "̧"]
    texts = ["".join(rnd.choice("aeiouyscn xq") + "".join(rnd.choice(marks) for _ in range(rnd.randint(0, 3))) for _ in range(6)) for _ in range(150)]
    got = forms(spark, texts)
    assert {t: got[t][0] for t in got} == {t: unicodedata.normalize("NFC", t) for t in got}


def test_poems(spark):
    body = "array<struct<id:int,stanza_id:int,text:string>>"
    rows = [(1, "Ｈｖｅｒ", [(0, 0, "ren"), (1, 0, "a b"), (2, 0, None), (3, 0, ""), (4, 0, "sÃ  dÃ¸d")]), (2, None, None), (3, "", [None])]
    df = spark.createDataFrame(rows, f"poem_no long, title string, body {body}").withColumns({"pos": F.lit(1), "ch": F.lit("x"), "text": F.lit("Ａ")})
    assert {(r["poem_no"], r["line_id"]) for r in C.changed_poems(df).collect()} == {(1, -1), (1, 1)}
    assert C.changed_poems(df.limit(0)).count() == 0


def test_invisible_characters_of_the_last_planes(spark):
    got = forms(spark, ["H\U000E0041ver", "da\U000E0100g", "\U000E0001Sol", "ren \U0001F600"])
    assert got == {"H\U000E0041ver": ("Hver", ["invisible"]), "da\U000E0100g": ("dag", ["invisible"]), "\U000E0001Sol": ("Sol", ["invisible"]), "ren \U0001F600": ("ren \U0001F600", [])}
