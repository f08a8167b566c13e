import pytest
from pyspark.sql import functions as F

from tarnwork.functions import keys, models, resilience


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_prefixes_and_keys(spark):
    for kb, part in keys.KNOWLEDGE_BASES.items():
        assert one(spark, keys.documents_prefix(F.lit(kb))) == f"raw/{part}/documents"
        assert one(spark, keys.images_prefix(F.lit(kb))) == f"raw/{part}/images"
    assert one(spark, keys.documents_prefix(F.lit("Other"))) is None
    assert one(spark, keys.image_key(F.lit("Construction"), F.lit("doc-123"), F.lit(4), F.lit(2), F.lit("png"))) == "raw/construction/images/doc-123/4_2.png"


@pytest.mark.parametrize("url, bucket, key", [("s3://bucket/path/to/file.pdf", "bucket", "path/to/file.pdf"), ("S3://b//k?x=1#f", "b", "k"), ("s3://b", "b", ""), ("https://nope.example.com/x", None, None), ("s3:///k", None, None), (None, None, None)])
def test_object_urls(spark, url, bucket, key):
    got = one(spark, keys.parse_object_url(F.lit(url).cast("string")))
    assert (got.bucket, got.key, got.error is None) == (bucket, key, bucket is not None)


def test_request():
    keys.check_request(None, 1)
    for kb, n in (("Other", 1), (None, 0), (None, 101)):
        with pytest.raises(ValueError):
            keys.check_request(kb, n)


class OperationalError(Exception):
    pass


class ConnectTimeout(Exception):
    pass


def test_classifier():
    assert all(resilience.classify(e) for e in (TimeoutError(), ConnectionResetError(), OperationalError(), ConnectTimeout()))
    assert not any(resilience.classify(e) for e in (ValueError(), KeyError(), TypeError(), NotImplementedError(), resilience.BreakerOpen(), RuntimeError(), OSError()))


def test_routes_and_backoff(spark):
    rows = [(True, 1, 3, "parse_pdf", "parse_pdf"), (True, 3, 3, "embed_chunks", "failure_handler"), (True, 0, 3, "parse_pdf", "parse_pdf"), (False, 0, 3, "select_parser", "failure_handler"), (None, 0, 3, "x", "failure_handler"), (True, 0, 3, None, "failure_handler")]
    d = spark.createDataFrame(rows, "r boolean, c int, m int, n string, want string")
    assert all(r[0] == r[1] for r in d.select(resilience.route(F.col("r"), F.col("c"), F.col("m"), F.col("n")), "want").collect())
    b = spark.createDataFrame([(1,), (2,), (3,), (6,)], "a int").select(resilience.backoff(F.col("a")).alias("s"), resilience.jittered(resilience.backoff(F.col("a"))).alias("j")).collect()
    assert [r.s for r in b] == [1, 2, 4, 30] and all(0.5 * r.s <= r.j < r.s for r in b)


def test_breaker():
    now = [0.0]
    b = resilience.Breaker("x", clock=lambda: now[0])

    def bad():
        raise TimeoutError

    for kind in (TimeoutError, TimeoutError, resilience.BreakerOpen, resilience.BreakerOpen):
        with pytest.raises(kind):
            b.call(bad)
    now[0] = 61
    assert b.call(lambda: 5) == 5 and b.failures == 0


class Short:
    def __call__(self, texts):
        return [[1.0]]


class Flaky:
    def __call__(self, image):
        if image == b"bad":
            raise ValueError
        return "" if image == b"empty" else " fine "


def test_models(spark):
    assert one(spark, models.data_url(F.lit(bytearray(range(200))))).startswith("data:image/png;base64,AAEC") and "\n" not in one(spark, models.data_url(F.lit(bytearray(range(200)))))
    images = spark.createDataFrame([("d", 1, 1, bytearray(b"ok")), ("d", 1, 2, bytearray(b"empty")), ("d", 1, 3, bytearray(b"bad"))], "doc_id string, page int, image_index int, content binary")
    assert [r.summary for r in models.summarize(images, Flaky).orderBy("image_index").collect()] == ["fine", "[image summary unavailable]", "[image summary unavailable]"]
    rows = spark.createDataFrame([(i, f"text {i % 3}") for i in range(40)], "i int, t string").coalesce(1)
    good = models.embed(rows, "t", dimension=64, make=lambda: models.HashingEmbedder(64)).orderBy("i").collect()
    assert all(len(r.vector) == 64 and r.error is None for r in good) and good[0].vector == good[3].vector != good[1].vector
    wrong = models.embed(rows, "t", Short, dimension=1).collect()
    assert all(r.vector is None and r.error.type == "RuntimeError" and not r.error.retryable for r in wrong[:16])
