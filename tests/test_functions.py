import base64
import gzip
import json

import pytest
from pyspark.sql import functions as F

from pagemill import constants as C
from pagemill.functions import bodies, clock, encoding, keys, text, whole
from pagemill.sources import listing

PAGES = [b"", b"a", b"ab", b"abc", b"x" * 57, b"x" * 58, bytes(range(256)) * 3, "é漢😀".encode()]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(i, p) for i, p in enumerate(PAGES)], "i int, page binary")


def test_base64_equals_the_standard_encoding(pages):
    for row in pages.select("page", encoding.base64_text(F.col("page")).alias("b")).collect():
        assert row["b"] == base64.b64encode(row["page"]).decode()


def test_base64_length(pages):
    rows = pages.select(
        encoding.base64_length(F.octet_length("page")).alias("n"),
        F.length(encoding.base64_text(F.col("page"))).alias("m"),
    ).collect()
    assert all(r["n"] == r["m"] for r in rows)


@pytest.mark.parametrize("key", ["a/b.parquet_1", 'q"uo\\te', "tab\tnew\nline\x01\x7f", "é漢😀  ", ""])
def test_request_size_is_the_size_of_the_json_text(spark, key):
    df = spark.createDataFrame([(key, p) for p in PAGES], "id string, page binary")
    for row in df.select("id", "page", encoding.request_size(F.col("id"), F.octet_length("page")).alias("n")).collect():
        url = C.DATA_URL_PREFIX + base64.b64encode(row["page"]).decode()
        request = {
            "custom_id": [row["id"]],
            "body": {"document": {"type": "image_url", "image_url": url}, "include_image_base64": True},
        }
        assert row["n"] == len(json.dumps(request).encode())


def test_decode_undoes_encode_and_gzip(spark):
    rows = [(p, z) for p in PAGES for z in (p, gzip.compress(p))]
    df = spark.createDataFrame(rows, "page binary, sent binary")
    sent = encoding.decode_page(encoding.data_url(F.col("sent")))
    found = df.select("page", encoding.is_gzip(sent).alias("z"), encoding.gunzip(sent).alias("back")).collect()
    assert all(r["back"] == r["page"] for r in found)
    assert sum(r["z"] for r in found) == len(PAGES)


def test_broken_gzip_is_left_as_it_is(spark):
    broken = gzip.compress(b"page" * 50)[:20]
    df = spark.createDataFrame([(broken,), (b"\x1f\x8b",), (None,)], "page binary")
    assert [r[0] for r in df.select(encoding.gunzip("page")).collect()] == [broken, b"\x1f\x8b", None]


def test_only_gzip_leaves_the_jvm(spark):
    pages = [b"plain", gzip.compress(b"packed"), None, b"", gzip.compress(b"")]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "id int, page binary")
    unpacked = df.select("id", encoding.gunzip(F.col("page")).alias("raw"))
    assert [r["raw"] for r in unpacked.orderBy("id").collect()] == [b"plain", b"packed", None, b"", b""]
    plan = unpacked._jdf.queryExecution().executedPlan().toString()
    call = next(line for line in plan.splitlines() if "ArrowEvalPython" in line)
    # What is sent to Python is null where a page is not gzip, or a column that is.
    assert "CASE WHEN" in call or "CASE WHEN" in plan.split("ArrowEvalPython", 1)[1]


def test_plain_base64_needs_no_data_url(spark):
    df = spark.createDataFrame([("YWJj",), ("data:image/png;base64,YWJj",)], "url string")
    assert [bytes(r[0]) for r in df.select(encoding.decode_page(F.col("url"))).collect()] == [b"abc", b"abc"]


def test_pdf_header(spark):
    df = spark.createDataFrame([(b"%PDF-1.4 x",), (b" %PDF-",), (b"",), (None,)], "page binary")
    assert [r[0] for r in df.select(encoding.is_pdf(F.col("page"))).collect()] == [True, False, False, False]


@pytest.mark.parametrize(
    "key,name",
    [
        ("jsonl/abc.jsonl", "abc"),
        ("abc.jsonl", "abc"),
        ("a/b/c/abc.jsonl", "abc"),
        ("jsonl/v1.2.x.jsonl", "v1.2.x"),
        ("jsonl/é漢.jsonl", "é漢"),
        ("jsonl/plain", "plain"),
    ],
)
def test_response_key(spark, key, name):
    df = spark.createDataFrame([(key,)], "k string")
    assert df.select(keys.response_key(F.col("k"))).first()[0] == f"ocr/{name}_ocr_pages.jsonl"


def test_object_path(spark):
    df = spark.createDataFrame([("s3://b", "k/x"), ("b", "k/x")], "b string, k string")
    assert [r[0] for r in df.select(keys.object_path(F.col("b"), F.col("k"))).collect()] == ["b/k/x"] * 2


@pytest.mark.parametrize(
    "root,uri,key",
    [
        ("/tmp/b", "file:///tmp/b/x/b/y%20z.parquet", "x/b/y z.parquet"),
        ("file:///tmp/b/", "file:/tmp/b/a+b.parquet", "a+b.parquet"),
        ("s3a://bucket", "s3a://bucket/p/q%25.parquet", "p/q%.parquet"),
        ("hdfs:///data", "hdfs://host:8020/data/data/k", "data/k"),
    ],
)
def test_key_below_a_folder(spark, root, uri, key):
    df = spark.createDataFrame([(uri,)], "u string")
    assert df.select(listing.key_under(root, F.col("u"))).first()[0] == key


BODIES = [
    ('{"s3_key":"parquets/a.parquet"}', ["parquets/a.parquet"]),
    ("parquets/a.parquet", ["parquets/a.parquet"]),
    ('{"bucket":"b","key":"text/sample.txt","job_id":"abc123"}', ["text/sample.txt"]),
    ('{"s3_key":"","key":"k"}', ["k"]),
    ('{"s3_keys":["a","b"]}', ["a", "b"]),
    ('{"s3_keys":[],"s3Uri":"u"}', ["u"]),
    ("{}", ["{}"]),
    ('{"s3_key":null,"s3_uri":"u"}', ["u"]),
    ('{"s3_key":0,"key":"k"}', ["k"]),
    ('{"s3_key":0.0,"key":false,"s3Uri":{},"s3_uri":"u"}', ["u"]),
    ('{"s3_key":"0"}', ["0"]),
    ('{"s3_key":"false","key":"k"}', ["false"]),
    ('{"key":"k","s3_key":"s"}', ["s"]),
    ('"abc"', None),
    ("123", None),
    ("null", None),
    ("[1]", None),
    ('{"s3_key":5}', None),
    ('{"s3_key":{"a":1}}', None),
    ('{"s3_key": "cut', ['{"s3_key": "cut']),
    ('{"s3_key":"x","s3_key":"y"}', ["y"]),
    (' {"s3_key" : "k" , "other" : [1, {"s3_key": "z"}] } ', ["k"]),
    ("", [""]),
    ("{not json}", ["{not json}"]),
]


def test_message_bodies(spark):
    df = spark.createDataFrame([(b,) for b, _ in BODIES], "body string")
    work = bodies.named_work(F.col("body"), bodies.body_kind(F.col("body")), bodies.key_fields(bodies.parsed_fields(F.col("body"))))
    found = df.select("body", bodies.work_keys(work).alias("keys")).collect()
    assert [(r["body"], r["keys"]) for r in found] == BODIES


def test_receive_count(spark):
    rows = [({C.RECEIVE_COUNT_ATTRIBUTE: "4"},), ({"other": "9"},), (None,)]
    df = spark.createDataFrame(rows, "a map<string,string>")
    assert [r[0] for r in df.select(bodies.receive_count(F.col("a"))).collect()] == [4, 1, 1]


def test_letters_and_errors(spark):
    row = (
        spark.range(1)
        .select(
            bodies.announcement(F.lit("k/é")).alias("a"),
            bodies.failed_keys_letter(F.array(F.lit("k"))).alias("f"),
            bodies.failed_pages_letter(F.lit("k")).alias("p"),
            bodies.last_error(F.lit("x" * 2000)).alias("e"),
        )
        .first()
    )
    assert json.loads(row["a"]) == {"s3_key": "k/é"}
    assert json.loads(row["f"]) == {"failed_keys": ["k"], "reason": "worker_processing_failed"}
    assert json.loads(row["p"]) == {"failed_pages": "k", "reason": "ocr_processing_failed"}
    assert len(row["e"]) == 1024


def test_clock(spark):
    try:
        for zone in ("America/New_York", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            at = clock.from_utc_text(F.lit("2024-01-01 00:00:07.179575"))
            row = spark.range(1).select(clock.iso_utc(at).alias("i"), clock.epoch_seconds(at).alias("e")).first()
            assert (row["i"], row["e"]) == ("2024-01-01T00:00:07.179575Z", 1704067207)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_whole_division_keeps_large_ids(spark):
    df = spark.createDataFrame([(2**62 + 1,), (7,)], "n long")
    assert [r[0] for r in df.select(whole.quotient(F.col("n"), 2)).collect()] == [2**61, 3]


def test_text(spark):
    df = spark.createDataFrame([("A<br>B <BR />\x00C\t\t d \x07 ", "“Été” — l’an  2\n X")], "a string, b string")
    row = df.select(
        text.clean(F.col("a")).alias("clean"),
        text.normalise(F.col("b")).alias("normal"),
        text.tokens(F.col("b")).alias("tokens"),
        text.line_count(F.col("b")).alias("lines"),
        text.letter_ratio(F.lit("")).alias("none"),
        text.letter_ratio(F.lit("ab1.")).alias("half"),
    ).first()
    assert row["clean"] == "A B C d"
    assert row["normal"] == "\"été\" - l'an 2 x"
    assert row["tokens"] == ["Été", "l", "an", "2", "X"]
    assert (row["lines"], row["none"], row["half"]) == (2, 0.0, 0.5)
