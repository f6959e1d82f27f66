"""Batching a page stream with the open batch carried from one micro-batch to the next.

The page stage closes a file's last batch in the micro-batch that reads it. Here a batch
stays open until it is full, whichever micro-batches its pages come from, as one writer
shared by all messages would have it. State per shard is three numbers; payloads are not
kept. Pages of a shard are taken in the order of arrival, within a micro-batch by ``order``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pagemill import constants as C
from pagemill.operators.batching import batch_ends

STATE = "batch_no long, held long, pages long"


def continue_batches(sizes: np.ndarray, held: int, pages: int, max_bytes: int, max_pages: int):
    """Batch of each page counted from the open one, whether it closes it, and what stays open."""
    count = len(sizes)
    total = np.cumsum(sizes, dtype=np.int64)
    first = min(int(np.searchsorted(total, max_bytes - held, side="left")) + 1, max_pages - pages)
    offset, closes = np.zeros(count, dtype=np.int64), np.zeros(count, dtype=bool)
    if first > count:
        return offset, closes, held + int(total[-1]), pages + count
    closes[first - 1] = True
    ends, at = batch_ends(sizes, max_bytes, max_pages), first
    held = pages = 0
    while at < count:
        end = int(ends[at])
        held, pages = int(sizes[at:end].sum()), end - at
        if held >= max_bytes or pages >= max_pages:
            closes[end - 1], held, pages = True, 0, 0
        at = end
    offset[1:] = np.cumsum(closes[:-1])
    return offset, closes, held, pages


def carry_batches(
    pages: DataFrame,
    shard: str,
    order: str,
    size: str = "size",
    max_bytes: int = C.MAX_BATCH_BYTES,
    max_pages: int = C.MAX_BATCH_PAGES,
    flush_after_ms: int | None = None,
) -> DataFrame:
    """Add ``batch_no`` and ``closes`` (the page fills its batch) to a stream of narrow rows.

    With ``flush_after_ms`` a batch that waits longer for its next page is closed as it
    is: a row without a page, ``closes`` set, says so.
    """
    columns = [shard, order, size]
    kept = [pages.schema[c] for c in columns]
    output = T.StructType(
        [
            *[T.StructField(f.name, f.dataType) for f in kept],
            T.StructField("batch_no", T.LongType()),
            T.StructField("closes", T.BooleanType()),
        ]
    )

    def step(key: tuple, frames: Iterator[pd.DataFrame], open_batch: GroupState) -> Iterator[pd.DataFrame]:
        batch_no, held, count = open_batch.get if open_batch.exists else (0, 0, 0)
        if open_batch.hasTimedOut:
            open_batch.update((batch_no + 1, 0, 0))
            empty = pd.Series([None], dtype="Int64")
            yield pd.DataFrame(
                {shard: [key[0]], order: empty, size: empty, "batch_no": [batch_no], "closes": [True]}
            )
            return
        arrived = pd.concat(list(frames)).sort_values(order)
        offset, closes, held, count = continue_batches(
            arrived[size].to_numpy(), held, count, max_bytes, max_pages
        )
        open_batch.update((batch_no + int(closes.sum()), held, count))
        if flush_after_ms is not None and count:
            open_batch.setTimeoutDuration(flush_after_ms)
        yield arrived.assign(batch_no=batch_no + offset, closes=closes)

    timeout = (
        GroupStateTimeout.NoTimeout if flush_after_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    )
    return (
        pages.select(*columns)
        .groupBy(shard)
        .applyInPandasWithState(step, output, STATE, "append", timeout)
    )
