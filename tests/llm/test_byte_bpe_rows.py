"""Byte BPE keeps several texts in a stored row and each text's columns and ids apart."""

import datetime

from pyspark.sql import functions as F

from jobweave.llm import byte_bpe
from jobweave.llm.byte_bpe import Vocabulary, decode_packed, encode, encode_packed

VOCABULARY = Vocabulary({bytes([b]): b for b in range(256)} | {b"ab": 256, b"abc": 257, b"cab": 258, b"aa": 259})
SCHEMA = "id long, text string, tags array<string>, at timestamp_ntz, part struct<a: int, b: array<int>>"


def rows(n):
    at = datetime.datetime(2021, 1, 1)
    out = [(i % 7 or None, f"abcab rare{i} aab" * (i % 5), [None, str(i)] if i % 3 else None, at, (i, [i])) for i in range(n)]
    return [*out, (1, None, None, None, None), (1, "", [], at, (None, None)), (2, "caba " * 40_000, ["x"], at, (1, [])), (3, "naïve ½", [], None, (2, None))]


def test_texts_share_stored_rows(spark, monkeypatch):
    stored = {}
    stage = byte_bpe.stage

    def counted(df, label):
        out = stage(df, label)
        stored[label] = out.count()
        return out

    monkeypatch.setattr(byte_bpe, "stage", counted)
    docs = spark.createDataFrame([(i, f"w{i} ab") for i in range(4_000)], "id long, text string").repartition(2)
    out = encode_packed(docs, VOCABULARY, r"\w+| ", common_words=10)
    assert out.filter(F.octet_length("ids") > 0).count() == 4_000
    assert 0 < sum(n for label, n in stored.items() if label.startswith("bpe-texts")) <= 40


def test_columns_stay_with_their_text(spark):
    given = rows(300)
    docs = spark.createDataFrame(given, SCHEMA).repartition(3)
    for common in (0, 1 << 17):
        out = encode_packed(docs, VOCABULARY, r"\w+|\W", common_words=common)
        assert out.columns == [*docs.columns, "ids"]
        back = out.withColumn("back", decode_packed(F.col("ids"), VOCABULARY)).drop("ids").collect()
        want = [(*r, bytes((r[1] or "").encode())) for r in given]
        assert sorted(map(repr, (tuple(r[:4]) + (r[4] and tuple(r[4]), bytes(r[5])) for r in back))) == sorted(map(repr, want))
    replaced = encode(docs.withColumnRenamed("at", "ids"), VOCABULARY, r"\w+|\W", keep=["id", "ids"])
    assert replaced.columns == ["id", "ids"] and replaced.count() == len(given)
