"""Text functions: hand-derived packing cases, and properties."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarnwork.functions import text
from tarnwork.operators import stages

NOTES = "<SPEAKER_NOTES>x</SPEAKER_NOTES>"
CASES = [
    ("aaaa. bbbb. cccc.", 12, 6, ["aaaa. bbbb.", "bbbb. cccc."]),
    ("aaaa. bbbb. cccccccc.", 12, 6, ["aaaa. bbbb.", "bbbb. cccccccc."]),
    ("aaaa. bbbb. cccc.", 12, 0, ["aaaa. bbbb.", "cccc."]),
    ("a" * 20 + ".", 12, 6, ["a" * 20 + "."]),
    (f"aaaa. bbbb. {NOTES} cccc.", 12, 6, ["aaaa. bbbb.", "bbbb.", NOTES, "cccc."]),
    ("<TABLE_REFERENCE> a. b", 12, 6, ["<TABLE_REFERENCE> a.", "b"]),
    ("", 800, 100, []),
    ("   \n ", 800, 100, []),
    ("<TABLE_REFERENCE>" + "a," * 5000 + "</TABLE_REFERENCE>", 800, 100, ["<TABLE_REFERENCE>" + "a," * 5000 + "</TABLE_REFERENCE>"]),
    ("Slide title. Some bullet text. <SPEAKER_NOTES>" + "n" * 412 + "</SPEAKER_NOTES> Tail.", 400, 50, ["Slide title. Some bullet text.", "Slide title. Some bullet text.", "<SPEAKER_NOTES>" + "n" * 412 + "</SPEAKER_NOTES>", "Tail."]),
]


def chunks(spark, texts, size, overlap, native):
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    rows = stages.chunked(d, size=size, overlap=overlap, native=native).orderBy("doc_id", "chunk_no").collect()
    return [[r.content for r in rows if r.doc_id == i] for i in range(len(texts))]


@pytest.mark.parametrize("native", [True, False])
def test_packing_cases(spark, native):
    for size, overlap in {(c[1], c[2]) for c in CASES}:
        some = [c for c in CASES if (c[1], c[2]) == (size, overlap)]
        assert chunks(spark, [c[0] for c in some], size, overlap, native) == [c[3] for c in some]


def test_image_case(spark):
    image = '<IMAGE_REFERENCE src="s" page="1" index="1">' + "d" * 608 + "</IMAGE_REFERENCE>"
    got = chunks(spark, ["Hello world. " * 100 + image + "Tail."], 300, 50, True)[0]
    assert len(image) == 670 or len(image) == 671
    assert [len(c) for c in got][:6] == [298, 298, 298, 298, 259, 38] and got[6] == image and got[7] == "Tail."


def test_native_and_arrow_packing_agree(spark, data):
    d = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    for size, overlap in ((800, 100), (60, 30), (40, 0)):
        a, b = (stages.chunked(d, size=size, overlap=overlap, native=n) for n in (True, False))
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_tags_stay_whole(spark):
    body = " ".join(f"Sentence {i}. <TABLE_REFERENCE>a.\nb! {i}</TABLE_REFERENCE>" for i in range(30))
    for c in chunks(spark, [body], 50, 20, True)[0]:
        assert len(re.findall("<TABLE_REFERENCE>", c)) == len(re.findall("</TABLE_REFERENCE>", c))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 30), st.booleans()), max_size=40), st.integers(2, 40), st.integers(0, 30))
def test_every_span_is_in_some_range(spans, size, overlap):
    ranges = text.pack_lengths([n for n, _ in spans], [p for _, p in spans], size, overlap)
    assert {i for a, b in ranges for i in range(a, b)} == set(range(len(spans)))
    assert all(a < b for a, b in ranges)
    for (a, b), (c, d) in zip(ranges, ranges[1:]):
        assert b >= c and (d > b or (d == b and c > a) or (a, b) == (c, d))


def test_spans_of_tags(spark):
    rows = {
        "a. b <TABLE_REFERENCE>x. y</TABLE_REFERENCE> c": [("a.", False), ("b", False), ("<TABLE_REFERENCE>x. y</TABLE_REFERENCE>", True), ("c", False)],
        "<SPEAKER_NOTES>1\n2</SPEAKER_NOTES>": [("<SPEAKER_NOTES>1\n2</SPEAKER_NOTES>", True)],
        "<SPEAKER_NOTES>a <TABLE_REFERENCE>b</TABLE_REFERENCE> c</SPEAKER_NOTES>d": [("<SPEAKER_NOTES>a <TABLE_REFERENCE>b</TABLE_REFERENCE> c</SPEAKER_NOTES>", True), ("d", False)],
        "<table_reference>x</table_reference>": [("<table_reference>x</table_reference>", False)],
    }
    d = spark.createDataFrame([(k,) for k in rows], "text string").select("text", text.spans(F.col("text")).alias("s"))
    assert {r.text: [tuple(x) for x in r.s] for r in d.collect()} == rows


def test_normalize_and_hashes(spark):
    d = spark.createDataFrame([("Hello\tWORLD\n  hi",), ("Hello   World",), ("Hello World",), ("ﬁ X ",), (None,), ("",)], "t string")
    got = [r[0] for r in d.select(text.normalize("t")).collect()]
    assert got == ["hello world hi", "hello world", "hello world", "fi x", None, ""]
    assert [r[0] for r in d.limit(3).select(text.normalize_native(F.col("t"))).collect()] == got[:3]
    h = [r[0] for r in d.select(text.content_hash(text.normalize("t"))).collect()]
    assert h[1] == h[2] and len(h[0]) == 64 and h[4] is None
    assert 0 < text.simhash_of("the quick brown fox jumps over the lazy dog".split()) < 1 << 63 and text.simhash_of([]) == 0


def test_splice(spark):
    empty = '<IMAGE_REFERENCE src="U" page="{}" index="1"></IMAGE_REFERENCE>'
    d = spark.createDataFrame([(f"a {empty.format(1)} b {empty.format(2)} {empty.format(3)} <IMAGE_REFERENCE src=\"U\" page=\"1\" index=\"1\">kept</IMAGE_REFERENCE>", {"1:1": "S $1 \\", "3:1": ""})], "text string, m map<string,string>")
    body = d.select(text.splice(F.col("text"), F.col("m"))).first()[0]
    filled = '<IMAGE_REFERENCE src="U" page="{}" index="1">\n{}\n</IMAGE_REFERENCE>'
    none = "[image summary unavailable]"
    assert body == f"a {filled.format(1, 'S $1 ' + chr(92))} b {filled.format(2, none)} {filled.format(3, none)} <IMAGE_REFERENCE src=\"U\" page=\"1\" index=\"1\">kept</IMAGE_REFERENCE>"
    assert spark.range(1).select(text.image_placeholder(F.lit(2), F.lit(3), F.lit("U"))).first()[0] == '<IMAGE_REFERENCE src="U" page="2" index="3"></IMAGE_REFERENCE>'
    assert spark.range(1).select(text.notes_block(F.lit(" n\n"))).first()[0] == "<SPEAKER_NOTES>n</SPEAKER_NOTES>"
