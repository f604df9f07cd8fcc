"""Language ID: texts in no learned language, and ids that repeat."""

import corpus_pipeline
from jobweave.llm import language_id

FOREIGN = [
    "T\u00e4m\u00e4 on tavallinen suomenkielinen lause jossa kerrotaan s\u00e4\u00e4st\u00e4 ja ihmisist\u00e4 jotka asuvat pieness\u00e4 kyl\u00e4ss\u00e4",
    "To jest zwyk\u0142e polskie zdanie o pogodzie i o ludziach kt\u00f3rzy mieszkaj\u0105 w ma\u0142ej wsi nad jeziorem",
    "\u042d\u0442\u043e \u043e\u0431\u044b\u0447\u043d\u043e\u0435 \u043f\u0440\u0435\u0434\u043b\u043e\u0436\u0435\u043d\u0438\u0435 \u043d\u0430 \u0440\u0443\u0441\u0441\u043a\u043e\u043c \u044f\u0437\u044b\u043a\u0435 \u043e \u043f\u043e\u0433\u043e\u0434\u0435",
    "xqzv kjwq zzxk qwpj vvkx jqxz wkqz pqxv",
]


def test_unlearned_languages_go(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    more = spark.createDataFrame([(10**6 + i, t, None, None, len(t)) for i, t in enumerate(FOREIGN)], docs.schema)
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, docs.union(more), sf_dir).collect()}
    assert not kept & {10**6 + i for i in range(len(FOREIGN))}
    assert kept >= {r.doc_id for r in docs.filter("lang is not null and text rlike '[a-z]{3}'").collect()}


def test_floors():
    model = language_id.LanguageModel(["a", "b", "c"], None, {"a": ["x"], "b": ["y", "z"], "c": ["w"]}, {})
    assert model.floors() == {"x": 1 / 3, "y": 1 / 6, "z": 1 / 6, "w": 1 / 3}


def test_one_vector_for_each_id(spark, monkeypatch):
    rows = [(1 + i % 20, f"some {i} english words number {i}", "en") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    frame, seen = type(docs), []
    collect = frame.toArrow
    monkeypatch.setattr(frame, "toArrow", lambda df: seen.append(collect(df)) or seen[-1])
    language_id.train(docs)
    taken = docs.filter(~language_id.held_out("doc_id")).select("doc_id").distinct().count()
    assert [t.num_rows for t in seen] == [taken]
