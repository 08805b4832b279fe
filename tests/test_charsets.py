"""Undeclared legacy charsets (P11): whole texts, short ones, and bytes that are nothing."""

import pytest
from pyspark.sql import functions as F

from trawl.functions import http
from trawl.sources.fixtures import LEGACY_TEXTS

MORE = [
    ("WINDOWS-1251", "Новости спорта и погоды"), ("WINDOWS-1251", "Киев: сегодня прошла встреча министров, которая длилась три часа."),
    ("KOI8-R", "Сегодня состоялось заседание совета, на котором обсуждались вопросы экономики."), ("ISO-8859-5", "Москва является столицей и крупнейшим городом страны."),
    ("SHIFT_JIS", "ニュースとスポーツの記事はこちらからどうぞ。"), ("EUC-JP", "東京は日本の首都であり、世界でもっとも大きな都市のひとつです。"),
    ("EUC-KR", "서울은 대한민국의 수도이며 정치와 경제의 중심지이다."), ("GB18030", "中国是世界上人口最多的国家之一，有很长的历史和文化。"),
    ("BIG5", "台灣是一個美麗的地方，有很多好吃的東西和友善的人。"), ("WINDOWS-1253", "Η Αθήνα είναι η πρωτεύουσα της Ελλάδας και το μεγαλύτερο κέντρο της χώρας."),
    ("WINDOWS-1256", "القاهرة هي عاصمة مصر وأكبر مدنها من حيث عدد السكان"),
    ("WINDOWS-1252", "L'été dernier, Zoé a vécu près de la forêt où les élèves étudiaient."), ("WINDOWS-1252", "¿Dónde está el niño? Mañana, señor."),
    ("WINDOWS-1252", "“Quotes” – and a café"), ("WINDOWS-1252", "é"), ("WINDOWS-1252", "æøå ÆØÅ på blåbær"),
]


@pytest.mark.parametrize("charset,text", LEGACY_TEXTS + MORE)
def test_undeclared_charset(spark, charset, text):
    page = f"<html><body><p>{text}</p></body></html>"
    df = spark.createDataFrame([("text/html", page.encode(charset))], "ct string, b binary").withColumn("cs", http.resolve_charset(F.col("ct"), F.col("b")))
    row = df.select("cs", http.decode_content(F.col("b"), F.col("cs")).alias("t")).first()
    assert (row["cs"], row["t"]) == (charset, page)


@pytest.mark.parametrize("body", [b"\xff\xfe\x00\x01\x80" * 50, bytes(range(128, 256)), b"\x80", b"\x81" * 100_000])
def test_bytes_that_are_no_text_get_the_default(spark, body):
    df = spark.createDataFrame([(body,)], "b binary")
    assert df.select(http.sniffed_charset(F.col("b")).alias("c")).first()["c"] in ("WINDOWS-1252", "UTF-8")


def test_null_and_empty_bodies(spark):
    df = spark.createDataFrame([(None,), (b"",)], "b binary")
    assert [r["c"] for r in df.select(http.resolve_charset(F.lit("text/html"), F.col("b")).alias("c")).collect()][1] == "UTF-8"
