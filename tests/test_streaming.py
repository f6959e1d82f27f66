import dataclasses
import json
import os
from datetime import datetime, timedelta, timezone

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from pagemill import constants as C
from pagemill import schemas
from pagemill.operators import inference, routing, state
from pagemill.operators import requests as R
from pagemill.plans import bulk, streams, tables
from pagemill.sources import containers
from pagemill.sources import messages as message_source
from pagemill.sources import pages as page_source
from pagemill.streaming import carry, stages
from pagemill.streaming.workspace import TABLES, Workspace


def write_file(bucket, key, pages):
    path = os.path.join(bucket, key)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    table = pa.table({"other": list(range(len(pages))), "page_bytes": pa.array(pages, pa.binary())})
    pq.write_table(table, path)


def pages_of(name, count):
    return [f"%PDF- {name} {i}".encode() for i in range(count)]


FILES = {"parquets/a.parquet": 10, "parquets/b c.parquet": 3, "deep/bucket/d+{1,2}%20.parquet": 5}


@pytest.fixture
def bucket(tmp_path):
    root = str(tmp_path / "bucket")
    for key, count in FILES.items():
        write_file(root, key, pages_of(key, count))
    write_file(root, "parquets/empty.parquet", [])
    write_file(root, "deep/bucket/d+_1_2_%20.parquet", pages_of("not asked for", 2))
    with open(os.path.join(root, "parquets/broken.parquet"), "wb") as f:
        f.write(b"PAR1 this is not parquet")
    return root


BODIES = [
    ("1", '{"s3_key":"parquets/a.parquet"}', None),
    ("2", "parquets/b c.parquet", "2"),
    ("3", '{"s3_keys":["deep/bucket/d+{1,2}%20.parquet","parquets/a.parquet"]}', None),
    ("4", "parquets/absent.parquet", None),
    ("5", "parquets/broken.parquet", None),
    ("6", "parquets/a.parquet", "3"),
    ("7", "123", None),
    ("8", "parquets/empty.parquet", None),
]
FIXED = datetime(2024, 5, 1, tzinfo=timezone.utc)
LIMITS = stages.Limits(max_pages=4, max_attempts=2, clock=lambda: FIXED)


def message_rows(spark, bodies):
    rows = [(i, b, {C.RECEIVE_COUNT_ATTRIBUTE: n} if n else None) for i, b, n in bodies]
    return spark.createDataFrame(rows, schemas.MESSAGE)


def statuses(spark, ws, stage):
    log = ws.read(spark, "state").filter(F.col("stage") == stage)
    return {r["s3_key"]: r for r in state.current_state(log).collect()}


def outcomes(spark, ws):
    return sorted((r["message_id"], r["outcome"]) for r in ws.read(spark, "outcomes").collect())


def letters(spark, ws):
    return sorted(r["body"] for r in ws.read(spark, "dead_letters").collect())


def everything(spark, ws):
    tables = ("state", "announcements", "dead_letters", "outcomes", "manifest")
    return {t: sorted(map(str, ws.read(spark, t).collect())) for t in tables}


def test_both_stages_over_page_files(spark, tmp_path, bucket):
    ws = Workspace(str(tmp_path / "ws"))
    source = stages.PageFiles(bucket)
    message_source.write_messages(message_rows(spark, BODIES), ws.path("messages/first"))
    stages.run_page_stage(spark, ws, source, LIMITS)

    now = statuses(spark, ws, C.STAGE_PAGES)
    for key, count in FILES.items():
        assert (now[key]["status"], now[key]["total_pages"], now[key]["pages_processed"]) == ("done", count, count)
    assert (now["parquets/empty.parquet"]["status"], now["parquets/empty.parquet"]["total_pages"]) == ("done", 0)
    # Failed keys come back within the run until they are given up.
    for key in ("parquets/absent.parquet", "parquets/broken.parquet"):
        assert (now[key]["status"], now[key]["attempts"]) == ("failed", 2)
    assert 0 < len(now["parquets/broken.parquet"]["last_error"]) <= 1024
    gone = [f'{{"failed_keys":["parquets/{name}.parquet"],"reason":"worker_processing_failed"}}' for name in ("absent", "broken")]
    assert letters(spark, ws) == sorted(["123", "parquets/a.parquet", *gone])
    first = [o for o in outcomes(spark, ws) if not o[0].startswith("retry")]
    assert first == [
        ("1", "processed"), ("2", "processed"), ("3", "processed"), ("4", "failed"), ("5", "failed"),
        ("6", "forwarded_to_dlq"), ("7", "forwarded_to_dlq"), ("8", "processed"),
    ]
    assert [o for i, o in outcomes(spark, ws) if i.startswith("retry")] == ["forwarded_to_dlq"] * 2

    # The plan equals the one made in batch over the same files.
    pages = stages.PageFiles(bucket).pages(spark, list(FILES))
    named = R.name_batches(R.batch_members(R.page_sizes(pages), max_pages=4))
    columns = ["custom_id", "batch_key", "pos"]
    planned = ws.read(spark, "manifest").select(*columns)
    assert sorted(map(tuple, planned.collect())) == sorted(map(tuple, named.select(*columns).collect()))
    enqueued = statuses(spark, ws, C.STAGE_OCR)
    assert {r["status"] for r in enqueued.values()} == {"enqueued"} and len(enqueued) == 6

    # A file that is there by now is asked for again.
    write_file(bucket, "parquets/absent.parquet", pages_of("late", 1))
    message_source.write_messages(message_rows(spark, [("9", "s3://bucket/parquets/absent.parquet", None)]), ws.path("messages/second"))
    stages.run_page_stage(spark, ws, source, LIMITS)
    assert statuses(spark, ws, C.STAGE_PAGES)["parquets/absent.parquet"]["status"] == "done"

    # Nothing new: nothing happens.
    before = everything(spark, ws)
    stages.run_page_stage(spark, ws, source, LIMITS)
    assert everything(spark, ws) == before

    calls = []

    def provider(sent):
        if b"late" in sent[0]:
            raise RuntimeError("model is away")
        return inference.text_provider(sent)

    stages.run_ocr_stage(spark, ws, provider, LIMITS)
    found = {r["custom_id"]: r["markdown"] for r in ws.read(spark, "response_pages").collect()}
    assert found == {f"{k}_{i + 1}": p.decode() for k, n in FILES.items() for i, p in enumerate(pages_of(k, n))}
    ocr = statuses(spark, ws, C.STAGE_OCR)
    assert sorted(r["status"] for r in ocr.values()) == ["done"] * 6 + ["failed"]
    late = [r for r in statuses(spark, ws, C.STAGE_OCR).values() if r["status"] == "failed"]
    assert (late[0]["attempts"], late[0]["last_error"]) == (2, "RuntimeError: model is away")
    gone = [json.loads(b) for b in letters(spark, ws) if "failed_pages" in b]
    assert gone == [{"failed_pages": late[0]["s3_key"], "reason": "ocr_processing_failed"}]
    assert len(statuses(spark, ws, C.STAGE_RESPONSES)) == 6
    assert not calls


@pytest.mark.parametrize("slice_keys", [100, 1])
def test_a_repeated_micro_batch_changes_nothing(spark, tmp_path, slice_keys):
    ws = Workspace(str(tmp_path / "ws"))
    pages = [(k, i + 1, p) for k, n in FILES.items() for i, p in enumerate(pages_of(k, n))]
    pages.append(("parquets/junk.parquet", 1, b"not a pdf"))
    page_source.write_page_table(
        spark.createDataFrame(pages, "s3_key string, page_no long, page_bytes binary"), ws.path("pages")
    )
    limits = stages.Limits(max_pages=4, max_attempts=1, slice_keys=slice_keys, clock=lambda: FIXED)
    rows = message_rows(spark, [(i, b, n) for i, b, n in BODIES if "broken" not in b] + [("9", "parquets/junk.parquet", None)])
    process = stages.page_stage(ws, stages.PageTable(ws.path("pages")), limits)
    process(rows, 0)
    first = everything(spark, ws)
    assert len(first["manifest"]) == 19
    process(rows, 0)
    assert everything(spark, ws) == first
    # As a later micro-batch everything is skipped but what failed.
    process(rows, 1)
    assert len(everything(spark, ws)["manifest"]) == 19

    announced = ws.read(spark, "announcements").select(
        F.sha2("body", 256).alias("message_id"), "body", F.lit(None).cast("map<string,string>").alias("attributes")
    )
    announced = spark.createDataFrame(announced.collect(), schemas.MESSAGE)
    ocr = stages.ocr_stage(ws, inference.text_provider, limits)
    ocr(announced, 0)
    answered = sorted(map(str, ws.read(spark, "response_pages").collect()))
    ocr(announced, 0)
    assert sorted(map(str, ws.read(spark, "response_pages").collect())) == answered
    assert len(answered) == 18
    assert [r["custom_id"] for r in ws.read(spark, "quarantine").collect()] == ["parquets/junk.parquet_1"]
    failed = [r for r in statuses(spark, ws, C.STAGE_OCR).values() if r["status"] == "failed"]
    assert [r["last_error"] for r in failed] == ["LookupError: no valid page"]


def test_folding_the_log_keeps_the_state_and_the_skips(spark, tmp_path):
    ws = Workspace(str(tmp_path / "ws"))
    pages = [(k, i + 1, p) for k, n in FILES.items() for i, p in enumerate(pages_of(k, n))]
    page_source.write_page_table(
        spark.createDataFrame(pages, "s3_key string, page_no long, page_bytes binary"), ws.path("pages")
    )
    limits = stages.Limits(max_pages=4, max_attempts=1, clock=lambda: FIXED)
    process = stages.page_stage(ws, stages.PageTable(ws.path("pages")), limits)
    batches = [message_rows(spark, [b]) for b in BODIES[:4]]
    for epoch in (0, 1, 2):
        process(batches[epoch], epoch)
    before = statuses(spark, ws, C.STAGE_PAGES)
    assert len(before) == 3
    ws.fold_state(spark)
    assert statuses(spark, ws, C.STAGE_PAGES) == before
    ws.fold_state(spark)
    assert statuses(spark, ws, C.STAGE_PAGES) == before
    # Micro-batch 2 is not folded: run again it does the same once more.
    manifest = sorted(map(str, ws.read(spark, "manifest").collect()))
    process(batches[2], 2)
    assert sorted(map(str, ws.read(spark, "manifest").collect())) == manifest
    assert statuses(spark, ws, C.STAGE_PAGES) == before
    # Later ones see what is folded.
    process(batches[0], 3)
    process(batches[3], 4)
    assert sorted(map(str, ws.read(spark, "manifest").collect())) == manifest
    ws.fold_state(spark)
    now = statuses(spark, ws, C.STAGE_PAGES)
    assert {k: now[k] for k in before} == before and now["parquets/absent.parquet"]["status"] == "failed"
    assert ws.read(spark, "state").count() < spark.read.parquet(ws.path("state")).count()


def test_waiting_batches_are_flushed(spark, tmp_path):
    landing, out = tmp_path / "landing", str(tmp_path / "out")
    landing.mkdir()
    pd.DataFrame({"shard": ["a"] * 3, "n": [1, 2, 3], "size": [1, 1, 1]}).to_parquet(landing / "1.parquet")
    stream = spark.readStream.schema("shard string, n long, size long").parquet(str(landing))
    batched = carry.carry_batches(stream, "shard", "n", max_bytes=100, max_pages=2, flush_after_ms=1500)
    query = (
        batched.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "check"))
        .trigger(processingTime="500 milliseconds").start(out)
    )
    try:
        found = []
        for _ in range(40):
            query.awaitTermination(1)
            found = [tuple(r) for r in spark.read.schema(batched.schema).parquet(out).orderBy("batch_no", "n").collect()] \
                if os.path.isdir(os.path.join(out, "_spark_metadata")) else []
            if len(found) == 4:
                break
    finally:
        query.stop()
    assert sorted(found, key=str) == sorted(
        [("a", 1, 1, 0, False), ("a", 2, 1, 0, True), ("a", 3, 1, 1, False), ("a", None, None, 1, True)], key=str
    )


def test_bulk_run_equals_the_streams_and_can_be_repeated(spark, tmp_path, bucket):
    ws = Workspace(str(tmp_path / "ws"))
    limits = stages.Limits(max_pages=4, max_attempts=1, clock=lambda: FIXED)
    keys = spark.createDataFrame([(k,) for k in FILES], "s3_key string")
    bulk.run_pages(ws, stages.PageFiles(bucket), keys, limits, waves=2)
    batches = bulk.announced(ws, keys)
    assert batches.count() == 6
    bulk.run_inference(ws, inference.text_provider, batches, limits)
    pages = sorted(map(str, ws.read(spark, "response_pages").collect()))
    assert len(pages) == sum(FILES.values())
    bulk.run_pages(ws, stages.PageFiles(bucket), keys, limits, waves=2)
    bulk.run_inference(ws, inference.text_provider, bulk.announced(ws, keys), limits)
    assert sorted(map(str, ws.read(spark, "response_pages").collect())) == pages
    # Three files and six batches, started once each.
    assert ws.read(spark, "state").filter(F.col("event") == C.EVENT_STARTED).count() == 9
    assert ws.next_epoch(spark, C.STAGE_PAGES) == 4


def test_mixed_batches_hold_pages_of_several_files(spark, tmp_path):
    ws = Workspace(str(tmp_path / "ws"))
    pages = [(k, i + 1, p) for k, n in FILES.items() for i, p in enumerate(pages_of(k, n))]
    page_source.write_page_table(
        spark.createDataFrame(pages, "s3_key string, page_no long, page_bytes binary"), ws.path("pages")
    )
    limits = stages.Limits(max_pages=4, mixed=True)
    stages.page_stage(ws, stages.PageTable(ws.path("pages")), limits)(message_rows(spark, BODIES[:3]), 0)
    sizes = sorted(r["count"] for r in ws.read(spark, "manifest").groupBy("batch_key").count().collect())
    assert sizes == [2, 4, 4, 4, 4]


MIXED_FILES = {"parquets/a.parquet": 3, "parquets/b.parquet": 23, "parquets/c.parquet": 1, "parquets/d.parquet": 4}


def mixed_source(spark, ws):
    pages = [(k, i + 1, p) for k, n in MIXED_FILES.items() for i, p in enumerate(pages_of(k, n))]
    rows = spark.createDataFrame(pages, "s3_key string, page_no long, page_bytes binary")
    page_source.write_page_table(rows, ws.path("pages"))
    return stages.PageTable(ws.path("pages"))


def batches_of(spark, ws):
    """Ids of every batch in order, by the plan and as stored."""
    planned: dict = {}
    for r in ws.read(spark, "manifest").orderBy("pos").collect():
        planned.setdefault(r["batch_key"], []).append(r["custom_id"])
    stored: dict = {}
    if not planned:
        return []
    located = ws.read(spark, "containers")
    for r in containers.read(spark, ws.path("batches"), located).orderBy("pos").collect():
        stored.setdefault(r["batch_key"], []).append(r["custom_id"])
    assert stored == planned
    return sorted(planned.values())


def in_fours(files):
    ids = [f"{k}_{i + 1}" for k, n in sorted(files.items()) for i in range(n)]
    return sorted(ids[i : i + 4] for i in range(0, len(ids), 4))


def key_rows(spark, keys):
    return message_rows(spark, [(f"m-{k}", k, None) for k in keys])


@pytest.mark.parametrize("slice_keys", [1, 10_000])
def test_slices_do_not_show_in_mixed_batches(spark, tmp_path, slice_keys):
    ws = Workspace(str(tmp_path / "ws"))
    limits = stages.Limits(max_pages=4, mixed=True, slice_keys=slice_keys, clock=lambda: FIXED)
    stages.page_stage(ws, mixed_source(spark, ws), limits)(key_rows(spark, [*MIXED_FILES, "parquets/none.parquet"]), 0)
    assert batches_of(spark, ws) == in_fours(MIXED_FILES)
    now = statuses(spark, ws, C.STAGE_PAGES)
    assert {k: r["total_pages"] for k, r in now.items() if r["status"] == "done"} == MIXED_FILES


def test_open_batches_wait_for_the_next_micro_batch(spark, tmp_path):
    ws = Workspace(str(tmp_path / "ws"))
    source = mixed_source(spark, ws)
    limits = stages.Limits(max_pages=4, mixed=True, carry=True, clock=lambda: FIXED)
    process = stages.page_stage(ws, source, limits)
    first, later = list(MIXED_FILES)[:2], list(MIXED_FILES)[2:]
    process(key_rows(spark, first), 0)
    # 26 pages: six batches, and two pages of the second file wait.
    full = [ids for ids in in_fours({k: MIXED_FILES[k] for k in first}) if len(ids) == 4]
    assert len(full) == 6 and batches_of(spark, ws) == full
    now = statuses(spark, ws, C.STAGE_PAGES)
    assert [now[k]["status"] for k in first] == ["done", "processing"]

    # The second file is asked for again while it waits; the micro-batch runs twice.
    for _ in range(2):
        process(key_rows(spark, [first[1], *later]), 1)
        now = statuses(spark, ws, C.STAGE_PAGES)
        assert (now[first[1]]["status"], now[first[1]]["total_pages"]) == ("done", 23)
        assert [now[k]["status"] for k in later] == ["done", "processing"]
    for _ in range(2):
        stages.flush_waiting(spark, ws, source, limits)
        assert batches_of(spark, ws) == in_fours(MIXED_FILES)
        now = statuses(spark, ws, C.STAGE_PAGES)
        assert {k: (r["status"], r["total_pages"], r["pages_processed"]) for k, r in now.items()} == {
            k: ("done", n, n) for k, n in MIXED_FILES.items()
        }
    announced = sorted(r["s3_key"] for r in ws.read(spark, "announcements").collect())
    assert announced == sorted({r["batch_key"] for r in ws.read(spark, "manifest").collect()})
    assert len(statuses(spark, ws, C.STAGE_OCR)) == len(announced) == 8
    assert stages.waiting_pages(spark, ws, 1).isEmpty()


def test_batches_that_wait_too_long_are_written(spark, tmp_path):
    ws = Workspace(str(tmp_path / "ws"))
    hour = timedelta(hours=1)
    limits = stages.Limits(max_pages=4, mixed=True, carry=True, flush_after=hour, clock=lambda: FIXED)
    source = mixed_source(spark, ws)
    stages.page_stage(ws, source, limits)(key_rows(spark, ["parquets/a.parquet"]), 0)
    assert batches_of(spark, ws) == []
    late = dataclasses.replace(limits, clock=lambda: FIXED + hour)
    stages.page_stage(ws, source, late)(key_rows(spark, ["parquets/none.parquet"]), 1)
    assert [len(b) for b in batches_of(spark, ws)] == [3]
    assert statuses(spark, ws, C.STAGE_PAGES)["parquets/a.parquet"]["status"] == "done"


def test_carried_batches_cross_micro_batches(spark, tmp_path):
    rng = np.random.default_rng(3)
    sizes = {"hot": rng.integers(1, 60, 90), "cold": rng.integers(1, 60, 7)}
    landing, out = tmp_path / "landing", str(tmp_path / "out")
    landing.mkdir()

    def run():
        stream = spark.readStream.schema("shard string, n long, size long").parquet(str(landing))
        batched = carry.carry_batches(stream, "shard", "n", max_bytes=150, max_pages=5)
        query = (
            batched.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "check"))
            .trigger(availableNow=True).start(out)
        )
        query.awaitTermination()

    for lo, hi in ((0, 2), (2, 40), (40, 41), (41, 90)):
        rows = [(k, i, int(s)) for k, v in sizes.items() for i, s in enumerate(v) if lo <= i < hi]
        pd.DataFrame(rows, columns=["shard", "n", "size"]).to_parquet(landing / f"{lo}.parquet")
        run()
    found = spark.read.parquet(out).orderBy("shard", "n").collect()
    for shard, values in sizes.items():
        batch, held, pages, wanted = 0, 0, 0, []
        for n, size in enumerate(values):
            held, pages = held + size, pages + 1
            full = bool(held >= 150 or pages >= 5)
            wanted.append((n, batch, full))
            if full:
                batch, held, pages = batch + 1, 0, 0
        assert [(r["n"], r["batch_no"], r["closes"]) for r in found if r["shard"] == shard] == wanted


def test_carried_batches_of_more_files_than_one_trigger_takes(spark, tmp_path):
    """Files in no order of ids: the batches are those of the ids in order."""
    rng = np.random.default_rng(6)
    count = 3 * (streams.MAX_FILES + 6)
    ids = rng.permutation(count)
    folder = tmp_path / "documents.parquet"
    folder.mkdir()
    texts = {int(i): "x" * int(n) for i, n in enumerate(rng.integers(0, 9000, count))}
    for n, own in enumerate(np.split(ids, count // 3)):
        rows = [(int(i), texts[int(i)], "ab"[int(i % 3 == 0)]) for i in own]
        pd.DataFrame(rows, columns=["doc_id", "text", "source"]).to_parquet(folder / f"{n}.parquet")
        os.utime(folder / f"{n}.parquet", (1_700_000_000 + n, 1_700_000_000 + n))
    found = streams.stream_carried_batches(spark, str(tmp_path)).orderBy("s3_key", "doc_id").collect()
    assert len(found) == count
    state = {}
    for r in found:
        batch, held, pages = state.get(r["s3_key"], (0, 0, 0))
        held, pages = held + r["size"], pages + 1
        full = held >= tables.MAX_BYTES or pages >= tables.MAX_PAGES
        assert (r["batch_no"], r["closes"]) == (batch, full)
        state[r["s3_key"]] = (batch + 1, 0, 0) if full else (batch, held, pages)
    assert all(batch > 0 for batch, _, _ in state.values())


def test_continue_batches_equals_one_pass():
    rng = np.random.default_rng(5)
    for _ in range(300):
        sizes = rng.integers(0, 40, rng.integers(1, 30))
        max_bytes, max_pages = int(rng.integers(1, 100)), int(rng.integers(1, 7))
        held, pages = int(rng.integers(0, max_bytes)), int(rng.integers(0, max_pages))
        wanted, batch, h, p = [], 0, held, pages
        for size in sizes:
            h, p = h + size, p + 1
            full = h >= max_bytes or p >= max_pages
            wanted.append((batch, full))
            if full:
                batch, h, p = batch + 1, 0, 0
        offset, closes, h2, p2 = carry.continue_batches(sizes, held, pages, max_bytes, max_pages)
        assert list(zip(offset, closes)) == wanted and (h2, p2) == (h, p)


ODD_KEYS = ["", "..", "../x", "a//b", "http://host:9/x", "s3://b", "{", "parquets", "p:q", "a\x01b", "*"]


@pytest.mark.parametrize("slice_keys", [1000, 2])
def test_keys_of_any_kind_end_the_same_in_slices_of_any_size(spark, tmp_path, bucket, slice_keys):
    ws = Workspace(str(tmp_path / "ws"))
    limits = stages.Limits(max_pages=4, max_attempts=1, slice_keys=slice_keys, clock=lambda: FIXED)
    keys = [*FILES, "parquets/broken.parquet", "parquets/absent.parquet", *ODD_KEYS]
    rows = message_rows(spark, [(str(i), json.dumps({"s3_keys": [k]}), None) for i, k in enumerate(keys)])
    stages.page_stage(ws, stages.PageFiles(bucket), limits)(rows, 0)
    now = statuses(spark, ws, C.STAGE_PAGES)
    assert {k for k, r in now.items() if r["status"] == "done"} == set(FILES)
    assert {k for k, r in now.items() if r["status"] == "failed"} == set(keys) - set(FILES)
    assert all(r["last_error"] == stages.NOT_FOUND for k, r in now.items() if r["status"] == "failed" and "broken" not in k)


def test_a_problem_that_is_no_file_fails_the_micro_batch(spark, tmp_path, bucket, monkeypatch):
    ws = Workspace(str(tmp_path / "ws"))
    monkeypatch.setattr(stages.PageFiles, "pages", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        stages.page_stage(ws, stages.PageFiles(bucket), LIMITS)(message_rows(spark, BODIES[:1]), 0)


def test_bulk_runs_end_failed_keys(spark, tmp_path, bucket):
    ws = Workspace(str(tmp_path / "ws"))
    keys = spark.createDataFrame([("parquets/a.parquet",), ("parquets/absent.parquet",)], "s3_key string")
    bulk.run_pages(ws, stages.PageFiles(bucket), keys, stages.Limits(max_pages=4, max_attempts=3))
    now = statuses(spark, ws, C.STAGE_PAGES)
    assert (now["parquets/absent.parquet"]["status"], now["parquets/absent.parquet"]["attempts"]) == ("failed", 3)
    assert len(letters(spark, ws)) == 1 and not os.path.exists(ws.path("messages"))


def test_lines_that_are_no_messages_keep_their_text(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    good = '{"message_id":"1","body":"k","attributes":{"ApproximateReceiveCount":"2"}}'
    odd = '{"message_id":"2","body":"k2","attributes":{"ApproximateReceiveCount":"x"}}'
    (landing / "m.json").write_text(good + "\nnot json {\n\n" + odd + "\n")
    out = str(tmp_path / "out")
    query = (
        message_source.message_stream(spark, str(landing)).writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start(out)
    )
    query.awaitTermination()
    rows = spark.read.schema(schemas.MESSAGE).parquet(out)
    good_rows, poison = routing.split_poison(routing.with_receive_count(rows))
    assert [(r["message_id"], r["body"]) for r in good_rows.collect()] == [("1", "k")]
    assert sorted(r["body"] for r in poison.collect()) == ["k2", "not json {"]
    assert all(r["message_id"] for r in poison.collect())


def test_kafka_headers_are_attributes(spark):
    schema = "topic string, partition int, offset long, value binary, headers array<struct<key:string,value:binary>>"
    rows = spark.createDataFrame(
        [("t", 0, 5, b"k", [(C.RECEIVE_COUNT_ATTRIBUTE, b"3"), ("x", b"1"), ("x", b"2")]), ("t", 0, 6, b"k", None)], schema
    )
    found = message_source.kafka_messages(rows)
    counted = routing.with_receive_count(found).orderBy("message_id").collect()
    assert [(r["message_id"], r["receive_count"]) for r in counted] == [("t-0-5", 3), ("t-0-6", 1)]
    assert counted[0]["attributes"]["x"] == "2"


def test_streams_read_tables_of_many_files(spark, tmp_path):
    from pagemill.plans import streams

    whole = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    whole.repartition(5).write.parquet(str(tmp_path / "events.parquet"))
    for name in ("documents", "labels"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").repartition(3).write.parquet(str(tmp_path / f"{name}.parquet"))
    for query in (streams.stream_message_keys, streams.stream_outcome_counts, streams.stream_state):
        one = sorted(map(str, query(spark, "/root/testdata/sf0.001").collect()))
        many = sorted(map(str, query(spark, str(tmp_path)).collect()))
        assert one and one == many


@pytest.mark.parametrize("table", [True, False])
def test_keys_without_an_object_plan_nothing(spark, tmp_path, table):
    root = f"{tmp_path}/stored"
    pages = spark.createDataFrame([("there", n, b"%PDF-") for n in (1, 2)], "s3_key string, page_no long, page_bytes binary")
    if table:
        page_source.write_page_table(pages, root)
    else:
        pages.select("page_bytes").coalesce(1).write.parquet(f"{root}/part")
    source = stages.PageTable(root) if table else stages.PageFiles(root)
    ws = Workspace(f"{tmp_path}/ws")
    keys = spark.createDataFrame([(f"absent-{i}",) for i in range(30)] + [("there",)] * table, "s3_key string")
    bulk.run_pages(ws, source, keys, stages.Limits(max_attempts=1, slice_keys=5))
    me = (C.STAGE_PAGES, 0)
    # Thirty absent keys are six slices or more; only the one key that is there is planned.
    for name in ("manifest", "runs", "containers"):
        folder = f"{tmp_path}/ws/{name}/writer={me[0]}/epoch=0"
        assert len([s for s in (os.listdir(folder) if os.path.isdir(folder) else []) if s.startswith("step=slice")]) == int(table)
    checks = ws.read(spark, "checks", only=me)
    assert checks.filter("error IS NOT NULL").count() == 30 and checks.count() == 30 + table
    assert ws.read(spark, "dead_letters").count() == 30
    done = state.current_state(ws.read(spark, "state")).filter(F.col("status") == C.STATUS_DONE)
    assert [tuple(r) for r in done.filter(F.col("stage") == C.STAGE_PAGES).select("s3_key", "total_pages").collect()] == [("there", 2)] * table


def test_page_tables_are_planned_by_stored_lengths(spark, tmp_path):
    root = f"{tmp_path}/stored"
    stored = [("new/a", 1, b"x", 100), ("new/a", 2, b"xyz", None), ("0123", 1, None, None)]
    rows = spark.createDataFrame(stored, "s3_key string, page_no long, page_bytes binary, n_bytes long")
    rows.write.partitionBy("s3_key").parquet(root)
    # A table from before lengths were stored.
    rows.limit(2).select(F.lit("old").alias("s3_key"), "page_no", "page_bytes").coalesce(1).write.partitionBy("s3_key").mode("append").parquet(root)
    found = {(r["s3_key"], r["page_no"]): r["n_bytes"] for r in page_source.scan_page_lengths(spark, root).collect()}
    assert found == {("new/a", 1): 100, ("new/a", 2): 3, ("0123", 1): None, ("old", 1): 1, ("old", 2): 3}
    sizes = stages.PageTable(root).sizes(spark, ["new/a", "old"])
    measured = rows.filter("s3_key = 'new/a' AND page_no = 1").withColumn("page_bytes", F.expr("cast(repeat('x', 100) AS binary)"))
    expected = R.page_sizes(measured.drop("n_bytes")).first()["size"]
    assert sizes.count() == 4 and sizes.filter("s3_key = 'new/a' AND page_no = 1").first()["size"] == expected


def test_keys_of_a_page_table_are_known_without_opening_it(spark, tmp_path):
    root = f"{tmp_path}/stored"
    pages = spark.createDataFrame([("a/b c%+.parquet", 1, b"x"), ("0123", 1, b"y")], "s3_key string, page_no long, page_bytes binary")
    page_source.write_page_table(pages, root)
    os.makedirs(f"{root}/s3_key=unreadable")
    with open(f"{root}/s3_key=unreadable/part-0.parquet", "wb") as f:
        f.write(b"this is not parquet")
    source = stages.PageTable(root)
    assert sorted(r["s3_key"] for r in source.known(spark).collect()) == ["0123", "a/b c%+.parquet", "unreadable"]
    assert source.existing(spark, ["0123", "123", "a/b c%+.parquet"]) == ["0123", "a/b c%+.parquet"]


def test_nothing_runs_for_tables_that_are_not_there(spark, tmp_path):
    ws = Workspace(str(tmp_path / "ws"))
    for rows in (ws.read(spark, "state"), ws.read(spark, "waiting", only=(C.STAGE_PAGES, 0)), ws.empty(spark, "runs")):
        assert rows._jdf.queryExecution().optimizedPlan().toString().startswith("LocalRelation <empty>")
    assert ws.empty(spark, "runs").dtypes == spark.createDataFrame([], TABLES["runs"]).dtypes


def test_gathered_pages_are_written_where_they_are(spark, tmp_path):
    pages = spark.range(30).select(F.lit("k").alias("s3_key"), (F.col("id") + 1).alias("page_no"), F.lit(b"x").alias("page_bytes"))
    files = {}
    for gathered in (True, False):
        root = f"{tmp_path}/{gathered}"
        page_source.write_page_table(pages.repartition(3), root, gathered)
        files[gathered] = len([name for name in os.listdir(f"{root}/s3_key=k") if name.startswith("part-")])
        assert page_source.scan_page_table(spark, root).count() == page_source.scan_page_lengths(spark, root).distinct().count() == 30
    assert files == {True: 3, False: 1}
