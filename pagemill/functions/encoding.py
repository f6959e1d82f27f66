"""Page payloads: base64, data URLs, request bodies, size estimate, decoding."""

from __future__ import annotations

import gzip
import json
import zlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill import constants as C
from pagemill.functions.whole import quotient

# Bytes of one request's JSON text apart from its id and its encoded page.
REQUEST_FRAME_BYTES = len(
    json.dumps(
        {
            "custom_id": [""],
            "body": {
                "document": {"type": C.DOCUMENT_TYPE, "image_url": C.DATA_URL_PREFIX},
                "include_image_base64": C.INCLUDE_IMAGE_BASE64,
            },
        }
    )
)


def base64_text(data: Column) -> Column:
    """Base64 without the line breaks that Spark's ``base64`` puts in every 76 characters."""
    return F.translate(F.base64(data), "\r\n", "")


def data_url(data: Column) -> Column:
    return F.concat(F.lit(C.DATA_URL_PREFIX), base64_text(data))


def request_body(data: Column) -> Column:
    """Request body struct for one page."""
    document = F.struct(
        F.lit(C.DOCUMENT_TYPE).alias("type"),
        data_url(data).alias("image_url"),
    )
    return F.struct(
        document.alias("document"),
        F.lit(C.INCLUDE_IMAGE_BASE64).alias("include_image_base64"),
    )


def base64_length(n_bytes: Column) -> Column:
    """Length of the base64 text of ``n_bytes`` bytes, in whole numbers."""
    return quotient(n_bytes + 2, 3) * 4


def json_ascii_length(text: Column) -> Column:
    """Length of ``text`` written as an ASCII-only JSON string, quotes not counted."""

    def count(pattern: str) -> Column:
        return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))

    two_chars = count(r'["\\\n\r\t\x08\x0C]')
    six_chars = count(r"[\x00-\x07\x0B\x0E-\x1F\x7F\x{80}-\x{FFFF}]")
    twelve_chars = count(r"[\x{10000}-\x{10FFFF}]")
    return (F.length(text) + two_chars + six_chars * 5 + twelve_chars * 11).cast("long")


def request_size(custom_id: Column, n_bytes: Column) -> Column:
    """Estimated JSON size of one request from its id and its page's byte count.

    The page itself is not needed, so sizes can be planned without moving pages.
    """
    frame = F.lit(REQUEST_FRAME_BYTES).cast("long")
    return frame + json_ascii_length(custom_id) + base64_length(n_bytes)


def strip_data_url(url: Column) -> Column:
    """The encoded part of a data URL, NULL if it has none; any other text is returned as it is."""
    payload = F.try_element_at(F.split(url, ","), F.lit(2))
    return F.when(url.startswith(C.DATA_URL_MARK), payload).otherwise(url)


def is_gzip(data: Column) -> Column:
    return F.hex(F.substring(data, 1, 2)) == F.lit(C.GZIP_MAGIC_HEX)


def decompressed(data: bytes | None) -> bytes | None:
    """Decompress a gzip value; leave others, and values that do not decompress, as they are."""
    if data is None or data[:2] != bytes.fromhex(C.GZIP_MAGIC_HEX):
        return data
    try:
        return gzip.decompress(data)
    except (OSError, EOFError, zlib.error):
        return data


def gunzip(data: Column | str) -> Column:
    """:func:`decompressed` on a column. Only values that are gzip leave the JVM."""
    data = F.col(data) if isinstance(data, str) else data
    packed = is_gzip(data)

    def unpack(values: pd.Series) -> pd.Series:
        return values.map(decompressed)

    unpacked = F.pandas_udf(unpack, T.BinaryType())(F.when(packed, data))
    return F.when(packed, unpacked).otherwise(data)


def decode_page(url: Column) -> Column:
    """Raw bytes of a request's page, before decompression; NULL if they are not base64."""
    return F.try_to_binary(strip_data_url(url), F.lit("base64"))


def starts_as_pdf(data: bytes | None) -> bool:
    return data is not None and data.startswith(C.PDF_MARK.encode())


def is_pdf(data: Column) -> Column:
    """Header test only: says that the bytes claim to be a PDF, not that they parse."""
    return F.coalesce(F.substring(data, 1, len(C.PDF_MARK)) == F.lit(C.PDF_MARK.encode()), F.lit(False))
