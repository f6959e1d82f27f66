"""Names: page ids, batch objects, response objects, object paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemill import constants as C


def page_id(s3_key: Column, page_no: Column) -> Column:
    """``{s3_key}_{page_no}``."""
    return F.concat_ws("_", s3_key, page_no)


def page_digest(custom_id: Column, size: Column) -> Column:
    """``struct(a, b)``: two numbers of 60 bits each that stand for a page and its size."""
    digest = F.md5(F.concat_ws(":", custom_id, size.cast("string")).cast("binary"))

    def number(start: int) -> Column:
        return F.conv(F.substring(digest, start, 15), 16, 10).cast("decimal(20,0)")

    return F.struct(number(1).alias("a"), number(17).alias("b"))


def batch_key(sums: tuple[Column, Column], n_pages: Column, prefix: str = C.JSONL_PREFIX) -> Column:
    """Batch object name: a digest of all its pages, by the sums of their :func:`page_digest`.

    A rerun over the same pages overwrites the object; other pages, or pages of other sizes,
    have another one. Sums combine before a shuffle, which a list of pages would not.
    """
    digest = F.sha2(F.concat_ws(",", *(s.cast("string") for s in sums), n_pages.cast("string")), 256)
    return F.concat(F.lit(prefix + "/"), digest, F.lit(C.JSONL_SUFFIX))


def base_name(key: Column) -> Column:
    """Last path segment without its extension."""
    return F.regexp_extract(key, r"([^/]+?)(\.[^/.]*)?$", 1)


def response_key(key: Column, prefix: str = C.RESPONSE_PREFIX) -> Column:
    """Response object name for a batch object name."""
    return F.concat(F.lit(prefix + "/"), base_name(key), F.lit(C.RESPONSE_SUFFIX))


def bucket_name(bucket: Column) -> Column:
    """Bucket without its URI scheme."""
    return F.regexp_replace(bucket, f"^{C.BUCKET_SCHEME}", "")


def object_key(key: Column) -> Column:
    """Key of an object that is named by a URI of its bucket; other keys as they are."""
    return F.regexp_replace(key, f"^{C.BUCKET_SCHEME}[^/]*/", "")


def object_path(bucket: Column, key: Column) -> Column:
    """``bucket/key`` with the scheme removed from the bucket."""
    return F.concat_ws("/", bucket_name(bucket), key)
