"""Batch inference: decode a batch's pages, call a provider once, keep page identity.

A provider is any ``Callable[[list[bytes]], str]``: the pages of one batch in order, one
JSON response out. It runs in the executors, one call per batch, and a batch is bounded
by the batch limits. What a provider needs (credentials, endpoints, retries) is its own
business; a call that raises becomes an ``error`` value and leaves other batches alone.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill import schemas
from pagemill.functions import encoding

Provider = Callable[[list[bytes]], str]

RESPONSES = T.StructType(
    [
        T.StructField("batch_key", T.StringType()),
        T.StructField("custom_ids", T.ArrayType(T.StringType())),
        T.StructField("aside", T.ArrayType(T.StringType())),
        T.StructField("response", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("seconds", T.DoubleType()),
    ]
)
MALFORMED = "malformed request line"
NO_VALID_PAGE = "no valid page"
WRONG_SHAPE = "response without a list of pages"


def text_provider(pages: list[bytes]) -> str:
    """Stand-in for a model: each page's text is the page decoded as UTF-8."""
    return json.dumps(
        {
            "pages": [
                {
                    "index": i,
                    "markdown": page.decode("utf-8", "replace"),
                    "images": [],
                    "dimensions": {"dpi": 200, "height": 2339, "width": 1654},
                }
                for i, page in enumerate(pages)
            ],
            "model": "text",
            "document_annotation": None,
            "usage_info": {
                "pages_processed": len(pages),
                "doc_size_bytes": sum(len(page) for page in pages),
            },
        }
    )


def check_response(response: str) -> None:
    """Raise unless a response is a JSON object with a list of pages that carry an index and a text."""
    parsed = json.loads(response)
    pages = parsed.get("pages") if isinstance(parsed, dict) else None
    if not isinstance(pages, list):
        raise ValueError(WRONG_SHAPE)
    for page in pages:
        whole = isinstance(page, dict) and type(page.get("index")) is int
        if not whole or not isinstance(page.get("markdown"), str | None):
            raise ValueError(WRONG_SHAPE)


def decode_pages(lines: DataFrame) -> DataFrame:
    """Add ``raw``, the decoded and decompressed page, and ``is_pdf``.

    For looking at pages; :func:`run_provider` does the same where it has the pages in
    Python anyway.
    """
    decoded = lines.withColumn("raw", encoding.gunzip(encoding.decode_page(F.col("url"))))
    return decoded.withColumn("is_pdf", encoding.is_pdf(F.col("raw"))).drop("url")


def split_valid(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pages to send, and the pages put aside because they are not PDFs."""
    aside = pages.filter(~F.col("is_pdf")).drop("raw", "is_pdf")
    return pages.filter("is_pdf").drop("is_pdf"), aside


def run_provider(lines: DataFrame, provider: Provider, require_pdf: bool = True) -> DataFrame:
    """One row per batch: the pages sent, the pages put aside, the response or the error, the time taken.

    Pages travel as they are stored, compressed or not, and enter Python once: they are
    decompressed and tested there, just before the call. Lines have pages as they are (``page``) or
    as a data URL (``url``). The ids come back beside the
    response, so matching response pages to page ids needs no second shuffle.
    """

    def call(key: str | None, lines: list[tuple]) -> tuple:
        began = time.monotonic()
        sent, aside, response, error = [], [], None, None
        if any(malformed or page is None for _, page, malformed in lines):
            error = MALFORMED
        else:
            pages = [(i, encoding.decompressed(raw)) for i, raw, _ in lines]
            valid = [encoding.starts_as_pdf(page) or not require_pdf for _, page in pages]
            sent = [i for (i, _), ok in zip(pages, valid) if ok]
            aside = [i for (i, _), ok in zip(pages, valid) if not ok]
            try:
                if not sent:
                    raise LookupError(NO_VALID_PAGE)
                response = provider([page for (_, page), ok in zip(pages, valid) if ok])
                check_response(response)
            except Exception as problem:  # the provider is foreign code
                response, error = None, f"{type(problem).__name__}: {problem}"
        return key, sent, aside, response, error, time.monotonic() - began

    def calls(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # A batch's lines follow one another, and may go on in the next frame.
        key, lines = None, []
        for pdf in batches:
            answered = []
            for now, place, *line in zip(pdf["batch_key"], pdf["place"], pdf["custom_id"], pdf["page"], pdf["malformed"]):
                if place == 1 and lines:
                    answered.append(call(key, lines))
                    lines = []
                key = now
                lines.append(tuple(line))
            if answered:
                yield pd.DataFrame(answered, columns=RESPONSES.names)
        if lines:
            yield pd.DataFrame([call(key, lines)], columns=RESPONSES.names)

    page = F.col("page") if "page" in lines.columns else encoding.decode_page(F.col("url")).alias("page")
    raw = lines.select("batch_key", "line_no", "custom_id", page, "malformed")
    # The numbering brings a batch into one task, sorted; where the lines are dealt by batch already, they stay.
    place = F.row_number().over(Window.partitionBy("batch_key").orderBy("line_no"))
    return raw.withColumn("place", place).drop("line_no").mapInPandas(calls, RESPONSES)


def quarantined(responses: DataFrame) -> DataFrame:
    """``batch_key, custom_id`` of the pages put aside."""
    return responses.select("batch_key", F.explode("aside").alias("custom_id"))


def sent_pages(responses: DataFrame) -> DataFrame:
    """``batch_key, index, custom_id`` of the pages sent: the manifest of the call."""
    return responses.select("batch_key", F.posexplode("custom_ids").alias("index", "custom_id"))


def split_errors(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Responses, and the batches whose call failed."""
    return responses.filter(F.col("error").isNull()), responses.filter(F.col("error").isNotNull())


def response_pages(responses: DataFrame) -> DataFrame:
    """One row per response page, with the id of the page it belongs to.

    ``index`` counts the pages sent, from 0. A page the provider leaves out has no row;
    an index outside the batch keeps its row with a NULL id.
    """
    parsed = responses.withColumn("_doc", F.from_json("response", schemas.RESPONSE))
    carried = ["batch_key"] + (["custom_ids"] if "custom_ids" in responses.columns else [])
    pages = parsed.select(
        *carried,
        F.col("_doc.model").alias("model"),
        F.inline("_doc.pages"),
    )
    flat = pages.select(
        *carried,
        "index",
        "markdown",
        F.size("images").cast("long").alias("n_images"),
        "dimensions.dpi",
        "dimensions.height",
        "dimensions.width",
        "model",
    )
    if "custom_ids" not in carried:
        return flat
    return flat.withColumn("custom_id", F.get("custom_ids", F.col("index"))).drop("custom_ids")


def join_manifest(pages: DataFrame, sent: DataFrame) -> DataFrame:
    """Page ids for stored responses that carry only ``index``."""
    return pages.join(sent, ["batch_key", "index"], "left")


def usage(responses: DataFrame) -> DataFrame:
    """Pages and bytes each response says it covered; failed calls have none."""
    answered, _ = split_errors(responses)
    parsed = answered.withColumn("_doc", F.from_json("response", schemas.RESPONSE))
    return parsed.select(
        "batch_key",
        "_doc.model",
        F.col("_doc.usage_info.pages_processed").cast("long").alias("pages_processed"),
        F.col("_doc.usage_info.doc_size_bytes").alias("doc_size_bytes"),
    )
