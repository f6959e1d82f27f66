"""Explicit schemas of everything the stages read or write."""

from pyspark.sql import types as T

PAGE_FILE = T.StructType([T.StructField("page_bytes", T.BinaryType())])

REQUEST_BODY = T.StructType(
    [
        T.StructField(
            "document",
            T.StructType(
                [
                    T.StructField("type", T.StringType()),
                    T.StructField("image_url", T.StringType()),
                ]
            ),
        ),
        T.StructField("include_image_base64", T.BooleanType()),
    ]
)

REQUEST_LINE = T.StructType(
    [
        T.StructField("custom_id", T.StringType()),
        T.StructField("body", REQUEST_BODY),
    ]
)

RESPONSE_PAGE = T.StructType(
    [
        T.StructField("index", T.IntegerType()),
        T.StructField("markdown", T.StringType()),
        T.StructField("images", T.ArrayType(T.StringType())),
        T.StructField(
            "dimensions",
            T.StructType(
                [
                    T.StructField("dpi", T.IntegerType()),
                    T.StructField("height", T.IntegerType()),
                    T.StructField("width", T.IntegerType()),
                ]
            ),
        ),
    ]
)

RESPONSE = T.StructType(
    [
        T.StructField("pages", T.ArrayType(RESPONSE_PAGE)),
        T.StructField("model", T.StringType()),
        T.StructField("document_annotation", T.StringType()),
        T.StructField(
            "usage_info",
            T.StructType(
                [
                    T.StructField("pages_processed", T.IntegerType()),
                    T.StructField("doc_size_bytes", T.LongType()),
                ]
            ),
        ),
    ]
)

MESSAGE = T.StructType(
    [
        T.StructField("message_id", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
    ]
)

STATE_EVENT = T.StructType(
    [
        T.StructField("stage", T.StringType()),
        T.StructField("s3_key", T.StringType()),
        T.StructField("event", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("pages_inc", T.LongType()),
        T.StructField("attempt_inc", T.LongType()),
        T.StructField("total_pages", T.LongType()),
        T.StructField("last_error", T.StringType()),
        T.StructField("event_ts", T.TimestampType()),
        T.StructField("seq", T.LongType()),
    ]
)

ANNOUNCEMENT = T.StructType(
    [
        T.StructField("s3_key", T.StringType()),
        T.StructField("body", T.StringType()),
    ]
)

DEAD_LETTER = T.StructType(
    [
        T.StructField("body", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("keys", T.ArrayType(T.StringType())),
        T.StructField("at", T.TimestampType()),
    ]
)

OUTCOME = T.StructType(
    [
        T.StructField("queue", T.StringType()),
        T.StructField("message_id", T.StringType()),
        T.StructField("outcome", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("seconds", T.DoubleType()),
    ]
)
