"""What byte BPE stores is packed like other stage tables."""

from jobweave.llm.byte_bpe import Vocabulary, encode_packed, tokenizer_files


def test_stored_texts_are_packed(spark):
    files = tokenizer_files()
    docs = spark.createDataFrame([(1, "one two three"), (2, None), (3, "two unheard-of words")], "doc_id long, text string")
    encoded = encode_packed(docs, Vocabulary.load(files.path("byte_bpe_multi_50k.tiktoken")), files.PATTERN, keep=["doc_id"])
    assert encoded.inputFiles() and all("zstd" in f for f in encoded.inputFiles())
    assert encoded.count() == 3
