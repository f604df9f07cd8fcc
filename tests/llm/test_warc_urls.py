"""Urls come back as they were stored, and pushed filters find them."""

import pytest

from jobweave.llm import warc

URLS = ["http://x/a%20b", "http://x/a%0Ab?c=100%", "http://x/a\r\nWARC-Type: y", " http://x/ ", "http://x/\u00e9%\u200b", "", "http://x/a b"]


def test_urls_come_back(spark):
    rows = [(i, u, f"<p>{i}</p>") for i, u in enumerate(URLS)]
    path = warc.write_pages(spark.createDataFrame(rows, "page_id long, url string, html string"))
    read = warc.read_warc(spark, path)
    assert sorted(r.target_uri for r in read.collect()) == sorted(URLS)
    for i, u in enumerate(URLS[:3]):
        assert [r.record_id for r in read.filter(read.target_uri == u).collect()] == [f"urn:page:{i}"]


@pytest.mark.parametrize("value", ["http://x/a%20b", "http://x/%25"])
def test_archives_of_others_are_not_decoded(value):
    head = [b"WARC/1.1", b"WARC-Type: response", b"WARC-Target-URI: " + value.encode(), b"Content-Length: 0"]
    assert warc.parse_head(head)[0]["target_uri"] == value
