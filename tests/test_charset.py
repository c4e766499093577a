"""Pages given as bytes."""

import pytest

from pagelake.params import RunParams
from pagelake.sources.charset import declared_charset, page_text
from pagelake.sources.extract import distinct_pages, extract_records, read_pages

P = RunParams.fixed()
META = '<meta http-equiv="Content-Type" content="text/html; charset={}">'


@pytest.mark.parametrize("data,text", [
    (b"", ""),
    ("﻿é".encode(), "é"),
    (b"\xff\xfe" + "é€".encode("utf-16-le"), "é€"),
    (b"\xfe\xff" + "é€".encode("utf-16-be"), "é€"),
    ("é€".encode(), "é€"),
    (b"caf\xe9 \x80", "café €"),
    (b"\xe9\x81", "é�"),
    (META.format("shift_jis").encode() + "日本".encode("shift_jis"), META.format("shift_jis") + "日本"),
    (b"<META CHARSET=koi8-r>" + "да".encode("koi8-r"), "<META CHARSET=koi8-r>да"),
    (b"<meta charset='latin1'>\x93x\x94", "<meta charset='latin1'>“x”"),
    (b"<meta charset=utf-8>caf\xe9", "<meta charset=utf-8>café"),  # the declaration is wrong
    ("<meta charset=utf-16>é".encode(), "<meta charset=utf-16>é"),
    ("<meta charset=hex>é".encode(), "<meta charset=hex>é"),
    ("<meta charset=no-such>é".encode(), "<meta charset=no-such>é"),
    (b"<meta charset=unicode_escape>\\u0041", "<meta charset=unicode_escape>\\u0041"),
])
def test_text_of_bytes(data, text):
    assert page_text(data) == text


def test_only_the_head_declares():
    assert declared_charset(b"<meta name=x><meta charset=big5>") == "big5"
    assert page_text(b" " * 2000 + b"<meta charset=koi8-r>\xe9").endswith("é")


def test_byte_pages_through_the_folder_source_and_repeated(spark, tmp_path):
    (tmp_path / "a.html").write_bytes("<p>naïve</p>".encode("utf-16"))
    (tmp_path / "b.html").write_bytes("<p>naïve</p>".encode("cp1252"))
    pages = read_pages(spark, str(tmp_path), fmt="html")
    assert [r.content["text"] for r in extract_records(pages, P).collect()] == ["naïve"] * 2
    twice = extract_records(distinct_pages(pages.unionByName(pages)), P).collect()
    assert len({r.record_id for r in twice}) == 4 and {r.content["text"] for r in twice} == {"naïve"}


def test_null_and_empty_bytes(spark):
    pages = spark.createDataFrame([(1, "u", None), (2, "v", bytearray()), (3, "w", bytearray(b"<p>x"))], "page_id long, url string, html binary")
    assert [(r.source_url, r.content["text"]) for r in extract_records(pages, P).collect()] == [("w", "x")]
