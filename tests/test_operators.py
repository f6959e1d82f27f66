import hashlib
import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pagemill import constants as C
from pagemill import schemas
from pagemill.operators import inference, metrics, ordinals, routing, state
from pagemill.operators import requests as R
from pagemill.operators import text as TX
from pagemill.session import working_folder
from pagemill.sources import containers
from pagemill.sources import pages as page_source
from pagemill.sources import requests as request_source
from pagemill.sources import responses as response_source


def test_ordinals_do_not_depend_on_the_span(spark):
    rows = [("hot", i * 3) for i in range(300)] + [("small", -5), ("small", 0), ("small", 2**60)]
    df = spark.createDataFrame(rows, "s3_key string, id long").repartition(5)
    wanted = {("hot", i * 3): i + 1 for i in range(300)}
    wanted |= {("small", -5): 1, ("small", 0): 2, ("small", 2**60): 3}
    for span in (1, 7, 1 << 16):
        found = ordinals.with_ordinal(df, ["s3_key"], "id", span=span).collect()
        assert {(r["s3_key"], r["id"]): r["page_no"] for r in found} == wanted


def test_file_positions(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("a", 1), ("c", 1), ("b", 2)], "s3_key string, page_no long")
    found = ordinals.file_positions(df, [], "s3_key").orderBy("pos").collect()
    assert [(r["s3_key"], r["page_no"], r["pos"]) for r in found] == [
        ("a", 1, 1), ("a", 2, 2), ("b", 1, 3), ("b", 2, 4), ("c", 1, 5),
    ]


def test_file_positions_do_not_depend_on_the_span(spark):
    rows = [("s", "hot", i + 1) for i in range(200)] + [("s", "a", 1), ("s", "z", 1), ("t", "a", 1)]
    df = spark.createDataFrame(rows, "shard string, s3_key string, page_no long").repartition(4)
    wanted = {("s", "a", 1): 1, ("s", "z", 1): 202, ("t", "a", 1): 1} | {("s", "hot", i + 1): i + 2 for i in range(200)}
    for span in (1, 13, 1 << 16):
        found = ordinals.file_positions(df, ["shard"], "s3_key", span=span).collect()
        assert {(r["shard"], r["s3_key"], r["page_no"]): r["pos"] for r in found} == wanted


def test_sharded_mixed_batches(spark):
    rows = [(f"f{i}", n + 1, b"x" * 30) for i in range(12) for n in range(i)]
    pages = spark.createDataFrame(rows, "s3_key string, page_no long, page_bytes binary").repartition(3)
    members = R.batch_members(R.page_sizes(pages), mixed=True, shards=3, max_pages=5)
    named = R.name_batches(members, mixed=True)
    requests = R.batched_pages(pages, R.page_runs(named))
    assert requests.select("custom_id").distinct().count() == requests.count() == len(rows)
    assert sorted(map(tuple, requests.select("batch_key", "pos", "custom_id").collect())) == sorted(
        map(tuple, named.select("batch_key", "pos", "custom_id").collect())
    )
    sizes = [r["count"] for r in named.groupBy("batch_key", "shard").count().collect()]
    assert len([n for n in sizes if n < 5]) <= 3 and max(sizes) == 5


def log_of(spark, events):
    rows = [
        ("pages", key, event, state.EVENT_STATUS[event], int(event == "page"), int(event == "failed"),
         total, error, datetime(2024, 1, 1, 0, 0, at), at)
        for at, (key, event, total, error) in enumerate(events)
    ]
    return spark.createDataFrame(rows, schemas.STATE_EVENT)


EVENTS = [
    ("a", "registered", None, None),
    ("a", "started", None, None),
    ("a", "page", None, None),
    ("a", "failed", None, "first"),
    ("b", "registered", None, None),
    ("a", "started", None, None),
    ("a", "page", None, None),
    ("a", "failed", None, "second"),
    ("c", "started", None, None),
    ("c", "page", None, None),
    ("c", "finished", 1, None),
    ("d", "page", None, None),
    ("e", "failed", None, "x" * 10),
]


def test_current_state_and_its_compaction(spark):
    log = log_of(spark, EVENTS)
    now = {r["s3_key"]: r for r in state.current_state(log).collect()}
    seen = {k: (r["status"], r["attempts"], r["pages_processed"], r["total_pages"], r["last_error"]) for k, r in now.items()}
    assert seen == {
        "a": ("failed", 2, 2, None, "second"),
        "b": ("enqueued", 0, 0, None, None),
        "c": ("done", 0, 1, 1, None),
        "d": (None, 0, 1, None, None),
        "e": ("failed", 1, 0, None, "x" * 10),
    }
    compact = state.compact_log(log)
    assert compact.groupBy("s3_key").count().agg(F.max("count")).first()[0] <= 2
    assert {r["s3_key"]: r for r in state.current_state(compact).collect()} == now
    assert {r["s3_key"]: r for r in state.current_state(state.compact_log(compact)).collect()} == now


def test_skip_register_and_look_up(spark):
    log = log_of(spark, EVENTS)
    keys = spark.createDataFrame([(k,) for k in "abcxx"], "s3_key string")
    at = F.lit(datetime(2024, 1, 2))
    assert sorted(r[0] for r in state.skip_done(keys, log, "pages").collect()) == ["a", "b", "x", "x"]
    assert [r["s3_key"] for r in state.skipped_results(keys, log, "pages").collect()] == ["c"]
    assert state.skip_done(keys, log, "ocr").count() == 5
    registered = state.register_absent(keys, log, "pages", at)
    assert [(r["s3_key"], r["status"]) for r in registered.collect()] == [("x", "enqueued")]
    again = log.unionByName(registered)
    assert state.register_absent(keys, again, "pages", at).count() == 0
    assert sorted(r[0] for r in state.pending_keys(again, "pages").collect()) == ["b", "x"]
    found = {r["s3_key"]: r["status"] for r in state.look_up(keys, log, "pages").collect()}
    assert found == {"a": "failed", "b": "enqueued", "c": "done", "x": None}


def test_error_is_cut(spark):
    keys = spark.createDataFrame([("k",)], "s3_key string")
    event = state.state_events(keys, "pages", C.EVENT_FAILED, F.current_timestamp(), error=F.lit("y" * 3000))
    assert event.schema == schemas.STATE_EVENT or event.dtypes == spark.createDataFrame([], schemas.STATE_EVENT).dtypes
    row = event.first()
    assert (len(row["last_error"]), row["attempt_inc"], row["status"]) == (1024, 1, "failed")


def test_routing(spark):
    messages = spark.createDataFrame(
        [("1", "k", None), ("2", "k", {C.RECEIVE_COUNT_ATTRIBUTE: "2"}), ("3", "raw", {C.RECEIVE_COUNT_ATTRIBUTE: "3"})],
        schemas.MESSAGE,
    )
    good, poison = routing.split_poison(routing.with_receive_count(messages))
    assert sorted(r["message_id"] for r in good.collect()) == ["1", "2"]
    assert [r["body"] for r in routing.raw_letters(poison, F.current_timestamp()).collect()] == ["raw"]
    found = spark.createDataFrame([("processed",), ("forwarded_to_dlq",), ("failed",), (None,)], "o string")
    assert [r[0] for r in found.select(routing.is_acknowledged(F.col("o"))).collect()] == [True, True, False, False]


PAGES = [("f/a.parquet", i, f"%PDF- page {i} é\n".encode()) for i in range(1, 12)] + [("f/b.parquet", 1, b"no pdf")]


@pytest.fixture(scope="module")
def stored(spark):
    pages = spark.createDataFrame(PAGES, "s3_key string, page_no long, page_bytes binary").repartition(3)
    named = R.name_batches(R.batch_members(R.page_sizes(pages), max_pages=4))
    root = working_folder(spark, "stored")
    request_source.write_batches(R.batched_pages(pages, R.page_runs(named)), root)
    return spark, root, named


def test_batch_objects_hold_request_lines_in_order(stored):
    spark, root, named = stored
    files = spark.read.text(f"{root}/*", wholetext=True).collect()
    assert len(files) == 4
    for row in files:
        lines = [json.loads(line) for line in row[0].splitlines()]
        assert all(set(line) == {"custom_id", "body"} for line in lines)
        numbers = [int(line["custom_id"].rsplit("_", 1)[1]) for line in lines]
        assert numbers == sorted(numbers)
        assert lines[0]["body"]["include_image_base64"] is True
    lines = request_source.read_batches(spark, root)
    assert not lines.filter("malformed").count()
    assert lines.count() == len(PAGES)


def test_writing_batches_again_changes_nothing(stored):
    spark, root, named = stored
    before = sorted(map(tuple, request_source.read_batches(spark, root).collect()))
    pages = spark.createDataFrame(PAGES, "s3_key string, page_no long, page_bytes binary").repartition(7)
    request_source.write_batches(R.batched_pages(pages, R.page_runs(named)), root)
    assert sorted(map(tuple, request_source.read_batches(spark, root).collect())) == before


def test_containers_hold_what_single_objects_hold(stored, tmp_path):
    spark, root, named = stored
    pages = spark.createDataFrame(PAGES, "s3_key string, page_no long, page_bytes binary").repartition(5)
    for part in ("a", "b"):  # the second one holds every batch again
        containers.write(R.batched_pages(pages, R.page_runs(named)), f"{tmp_path}/part={part}")
    parts = [containers.index(spark, str(tmp_path), f"{tmp_path}/part={part}") for part in ("a", "b")]
    located = parts[0].unionByName(parts[1])
    assert located.count() == 8 and located.agg(F.sum("pages")).first()[0] == 2 * len(PAGES)
    rows = containers.read(spark, str(tmp_path), located)
    lines = containers.as_lines(rows)
    expected = inference.run_provider(request_source.read_batches(spark, root), inference.text_provider).drop("seconds")
    found = inference.run_provider(lines, inference.text_provider).drop("seconds")
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)
    # As JSON lines they are the same objects.
    target = working_folder(spark, "exported")
    request_source.write_batches(rows, target)
    assert sorted(map(tuple, request_source.read_batches(spark, target).collect())) == sorted(
        map(tuple, request_source.read_batches(spark, root).collect())
    )
    # One batch, and an index that names an object which is gone.
    key = located.orderBy("batch_key").first()["batch_key"]
    gone = spark.createDataFrame([(key, "part=z/gone.parquet", 1)], located.schema)
    some = containers.read(spark, str(tmp_path), located.filter(F.col("batch_key") == key).unionByName(gone))
    assert {r["batch_key"] for r in some.collect()} == {key}
    assert [r["pos"] for r in some.orderBy("pos").collect()] == list(range(1, some.count() + 1))
    assert containers.read(spark, str(tmp_path), gone).count() == 0


def test_one_job_writes_very_many_batches(spark, tmp_path):
    n = 100_000
    pages = spark.range(2 * n).select(
        F.concat(F.lit("jsonl/"), F.sha2((F.col("id") % n).cast("string"), 256)).alias("batch_key"),
        (F.col("id") + 7).alias("pos"),
        F.concat(F.lit("f_"), "id").alias("custom_id"),
        F.encode(F.col("id").cast("string"), "UTF-8").alias("page_bytes"),
    )
    containers.write(pages, f"{tmp_path}/part=a")
    objects = [name for name in os.listdir(f"{tmp_path}/part=a") if name.endswith(".parquet")]
    assert len(objects) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    located = containers.index(spark, str(tmp_path), f"{tmp_path}/part=a")
    assert located.count() == n and located.filter("pages <> 2").isEmpty()
    keys = ["jsonl/" + hashlib.sha256(str(i).encode()).hexdigest() for i in (0, 5, 99_999)]
    rows = containers.read(spark, str(tmp_path), located.filter(F.col("batch_key").isin(keys)))
    assert {r["batch_key"] for r in rows.collect()} == set(keys)
    found = sorted((r["pos"], bytes(r["page_bytes"])) for r in rows.collect())
    assert found == [(1, b"0"), (1, b"5"), (1, b"99999"), (2, b"100000"), (2, b"100005"), (2, b"199999")]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "batch_key" in plan.split("PushedFilters")[1][:200]


def test_containers_of_no_batches(spark, tmp_path):
    none = spark.createDataFrame([], containers.PAGES)
    containers.write(none, f"{tmp_path}/part=a")
    located = containers.index(spark, str(tmp_path), f"{tmp_path}/part=a")
    assert located.isEmpty() and containers.read(spark, str(tmp_path), located).isEmpty()


def test_provider_sees_valid_pages_in_order(stored):
    spark, root, _ = stored
    lines = request_source.read_batches(spark, root)
    valid, aside = inference.split_valid(inference.decode_pages(lines))
    assert [r["custom_id"] for r in aside.collect()] == ["f/b.parquet_1"] and valid.count() == 11
    responses = inference.run_provider(lines, inference.text_provider).persist()
    assert [tuple(r)[1] for r in inference.quarantined(responses).collect()] == ["f/b.parquet_1"]
    assert inference.sent_pages(responses).count() == 11
    errors = responses.filter("error IS NOT NULL").collect()
    assert [r["error"] for r in errors] == ["LookupError: no valid page"]
    responses = responses.filter("error IS NULL")
    found = {r["custom_id"]: r["markdown"] for r in inference.response_pages(responses).collect()}
    assert found == {f"{k}_{n}": p.decode() for k, n, p in PAGES if p.startswith(b"%PDF-")}

    target = working_folder(spark, "documents")
    response_source.write_responses(responses, target)
    read = response_source.read_responses(spark, target)
    assert read.count() == 3
    assert {json.loads(r["response"])["usage_info"]["pages_processed"] for r in read.collect()} == {4, 3}
    assert sum(r["pages_processed"] for r in inference.usage(responses).collect()) == 11


def test_provider_failures_stay_in_their_batch(stored):
    spark, root, _ = stored

    def picky(pages):
        if b"page 5" in pages[0]:
            raise RuntimeError("no")
        if b"page 9" in pages[0]:
            return "not json"
        return inference.text_provider(pages[1:])

    lines = request_source.read_batches(spark, root)
    done, failed = inference.split_errors(inference.run_provider(lines, picky))
    assert done.count() == 1
    errors = sorted(r["error"] for r in failed.collect())
    assert errors[0].startswith("JSONDecodeError") and errors[2] == "RuntimeError: no"
    # A page without an answer has no row.
    assert inference.response_pages(done).count() == 3


def test_malformed_lines_fail_their_batch(spark, tmp_path):
    folder = tmp_path / "batch_key=jsonl%2Fx.jsonl"
    folder.mkdir()
    good = '{"custom_id":"a_1","body":{"document":{"type":"image_url","image_url":"data:image/jpeg;base64,JVBERi0="},"include_image_base64":true}}'
    (folder / "x.json").write_text(good + "\n{broken\n" + '{"custom_id":"a_3","body":{}}\n')
    lines = request_source.read_batches(spark, str(tmp_path))
    found = [(r["batch_key"], r["line_no"], r["malformed"]) for r in lines.orderBy("line_no").collect()]
    assert found == [("jsonl/x.jsonl", 1, False), ("jsonl/x.jsonl", 2, True), ("jsonl/x.jsonl", 3, True)]
    row = inference.run_provider(lines, inference.text_provider).first()
    assert (row["response"], row["error"]) == (None, inference.MALFORMED)


def test_pages_that_are_not_base64_fail_their_own_batch(spark, tmp_path):
    def line(number, url):
        return json.dumps({"custom_id": f"a_{number}", "body": {"document": {"type": "image_url", "image_url": url}, "include_image_base64": True}})

    good = "data:image/jpeg;base64,JVBERi0="
    for name, second in {"good": good, "tail": good + "=x", "comma": "data:image/jpeg;base64", "length": "data:x,JVBER"}.items():
        folder = tmp_path / f"batch_key={name}"
        folder.mkdir()
        (folder / "x.json").write_text(line(1, good) + "\n" + line(2, second) + "\n")
    rows = inference.run_provider(request_source.read_batches(spark, str(tmp_path)), inference.text_provider).collect()
    assert {r["batch_key"]: r["error"] for r in rows} == {
        "good": None, "tail": inference.MALFORMED, "comma": inference.MALFORMED, "length": inference.MALFORMED,
    }


@pytest.mark.parametrize(
    "response", ["[]", "{}", '{"pages": 3}', '{"pages": [1]}', '{"pages": [{"markdown": "m"}]}', '{"pages": [{"index": "0"}]}', '{"pages": [{"index": 0, "markdown": {}}]}']
)
def test_a_response_of_another_shape_is_an_error(stored, response):
    spark, root, _ = stored
    rows = inference.run_provider(request_source.read_batches(spark, root), lambda pages: response).collect()
    assert all(r["response"] is None and r["error"] for r in rows)


def test_batch_names_follow_all_pages_and_their_sizes(spark):
    def name(rows):
        df = spark.createDataFrame(rows, "s3_key string, page_no long, page_bytes binary")
        members = R.batch_members(R.page_sizes(df), mixed=True, max_pages=10)
        return {r["batch_key"] for r in R.name_batches(members, mixed=True).collect()}

    first = name([("a", 1, b"x"), ("b1", 1, b"x"), ("c", 1, b"x")])
    assert first == name([("a", 1, b"x"), ("b1", 1, b"x"), ("c", 1, b"x")])
    assert not first & name([("a", 1, b"x"), ("b2", 1, b"x"), ("c", 1, b"x")])
    assert not first & name([("a", 1, b"x"), ("b1", 1, b"x" * 9), ("c", 1, b"x")])


def test_a_batch_moves_its_pages_once(stored):
    spark, root, named = stored
    pages = spark.createDataFrame(PAGES, "s3_key string, page_no long, page_bytes binary")
    runs = R.page_runs(named)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        placed = R.encoded(R.batched_pages(pages, F.broadcast(runs)).repartition("batch_key"))
        plan = placed._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(batch_key" in line and "REPARTITION" in line]
    assert len(moved) == 1
    # Encoding stands above the exchange.
    assert plan.index("base64") < plan.index(moved[0])


def test_response_fields_we_do_not_know_stay_in_the_document(spark):
    document = json.dumps({"pages": [{"index": 0, "markdown": "m", "images": [{"id": "i"}], "new": 1}], "more": 2})
    df = spark.createDataFrame([("b", ["x_1"], [], document, None, 0.5)], inference.RESPONSES)
    row = inference.response_pages(df).first()
    assert (row["custom_id"], row["markdown"], row["n_images"], row["dpi"]) == ("x_1", "m", 1, None)


def test_page_files_and_parts(spark, tmp_path):
    docs = spark.range(100).select("id", F.encode(F.col("id").cast("string"), "UTF-8").alias("page_bytes"))
    one = str(tmp_path / "bucket")
    docs.orderBy("id").coalesce(1).withColumn("other", F.lit(1)).write.parquet(f"{one}/parquets/a b+c%2.parquet")
    pages = page_source.scan_pages(spark, one)
    rows = pages.orderBy("page_no").collect()
    assert [(r["page_no"], int(r["page_bytes"])) for r in rows] == [(i + 1, i) for i in range(100)]
    assert rows[0]["s3_key"].startswith("parquets/a b+c%2.parquet/part-")
    assert page_source.pages_per_file(pages).first()["total_pages"] == 100

    many = str(tmp_path / "many")
    page_source.write_page_files(docs.repartition(9), "id", many)
    rows = page_source.scan_page_parts(spark, many).orderBy("page_no").collect()
    assert [(r["page_no"], int(r["page_bytes"])) for r in rows] == [(i + 1, i) for i in range(100)]


def test_staging_registers_once(spark):
    pages = spark.createDataFrame(PAGES, "s3_key string, page_no long, page_bytes binary")
    root = working_folder(spark, "staged")
    log = spark.createDataFrame([], schemas.STATE_EVENT)
    events, messages = page_source.stage_pages(pages, root, log, F.lit(datetime(2024, 1, 1)))
    events = spark.createDataFrame(events.collect(), schemas.STATE_EVENT)
    assert sorted(r["body"] for r in messages.collect()) == ['{"s3_key":"f/a.parquet"}', '{"s3_key":"f/b.parquet"}']
    assert {r["status"] for r in events.collect()} == {"enqueued"} and events.count() == 2
    again, _ = page_source.stage_pages(pages, root, events, F.lit(datetime(2024, 1, 2)))
    assert again.count() == 0
    assert page_source.scan_page_table(spark, root).count() == len(PAGES)
    kept = page_source.scan_page_table(spark, root).filter("s3_key = 'f/b.parquet'")
    assert "PartitionFilters: [isnotnull(s3_key" in kept._jdf.queryExecution().executedPlan().toString()


def test_metrics(spark):
    t = [datetime(2024, 1, 1, h) for h in range(6)]
    rows = [
        ("q", "1", "processed", t[0], t[2], 0.5),
        ("q", "2", "processed", t[1], t[3], 2.0),
        ("q", "3", "forwarded_to_dlq", t[1], None, 9.0),
        ("r", "4", "write_failed", t[4], t[5], 1.0),
    ]
    df = spark.createDataFrame(rows, schemas.OUTCOME)
    counts = {r["queue"]: tuple(r)[1:] for r in metrics.outcome_counts(df).collect()}
    assert counts == {"q": (3, 2, 1, 0), "r": (1, 0, 1, 1)}
    buckets = metrics.proc_time_histogram(df, [1.0, 2.0, 4.0]).orderBy("bucket").collect()
    assert [(r["le"], r["cumulative"]) for r in buckets] == [(1.0, 1), (2.0, 2), (4.0, 2), (None, 2)]
    assert metrics.in_flight(df, F.lit(t[1])).first()[0] == 3
    assert metrics.in_flight(df, F.lit(t[2])).first()[0] == 2
    series = {r["period"].hour: r["in_flight"] for r in metrics.in_flight_series(df).collect()}
    assert series == {0: 1, 1: 3, 2: 2, 3: 1, 4: 2, 5: 1}


def test_salted_expansion_changes_nothing(spark):
    tokens = spark.createDataFrame([(i, 0, "the" if i % 3 else f"w{i}") for i in range(200)], "doc_id long, pos int, token string")
    aliases = spark.createDataFrame([("the", "THE"), ("w3", "W3"), ("unused", "U")], "alias string, canonical string")
    plain = sorted(map(tuple, TX.expand_entities(tokens, aliases).select("doc_id", "token", "entity").collect()), key=str)
    salted = sorted(map(tuple, TX.expand_entities(tokens, aliases, 5).select("doc_id", "token", "entity").collect()), key=str)
    assert plain == salted and len(plain) == 200


def test_entities_are_counted_before_they_are_shuffled(spark):
    docs = spark.createDataFrame([(1, "b a b c b"), (2, "c"), (3, ""), (4, None)], "doc_id long, text string")
    aliases = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y")], "alias string, canonical string").filter("alias <> 'c'")
    expected = {(1, "x", 4, 0 + 1 + 2 + 4), (1, None, 1, 3), (2, None, 1, 0)}
    for salts in (1, 3):
        found = TX.entity_counts(docs, aliases, "doc_id", F.col("text"), salts)
        assert {tuple(r) for r in found.collect()} == expected
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        # One aggregate, above the join with the aliases.
        assert plan.index("Aggregate") < plan.index("Join") and plan.count("Aggregate") == 1


def test_a_malformed_line_among_many_batches_fails_its_own(spark, tmp_path):
    good = '{"custom_id":"a_1","body":{"document":{"type":"image_url","image_url":"data:image/jpeg;base64,JVBERi0="},"include_image_base64":true}}'
    rows = [("x", 1, good), ("x", 2, "{broken"), ("y", 1, good)]
    spark.createDataFrame(rows, request_source.LINES).write.parquet(f"{tmp_path}/lines")
    answered = inference.run_provider(request_source.read_lines(spark, f"{tmp_path}/lines"), inference.text_provider).collect()
    assert {r["batch_key"]: r["error"] for r in answered} == {"x": inference.MALFORMED, "y": None}


def test_a_provider_meets_every_batch_once_and_whole(spark):
    # Batches of 1 to 5 lines, frames of 2 lines: most batches go on in another frame.
    rows = [(f"b{b:03d}", n + 1, f"{b}_{n}", b"%PDF-" + bytes([b, n]), False) for b in range(60) for n in range(b % 5 + 1)]
    lines = spark.createDataFrame(rows, "batch_key string, line_no int, custom_id string, page binary, malformed boolean")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        answered = inference.run_provider(lines.repartition(7), inference.text_provider).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert {r["batch_key"]: r["custom_ids"] for r in answered} == {
        f"b{b:03d}": [f"{b}_{n}" for n in range(b % 5 + 1)] for b in range(60)
    }
    assert len(answered) == 60 and not any(r["error"] for r in answered)


def test_objects_are_as_many_as_tasks_and_not_as_batches(spark, stored, tmp_path):
    n = 20_000
    responses = spark.range(n).select(
        F.concat(F.lit("jsonl/"), "id", F.lit(".jsonl")).alias("batch_key"), F.concat(F.lit('{"n":\n'), "id", F.lit("}")).alias("response")
    )
    response_source.write_responses(responses, f"{tmp_path}/documents/part=a")
    files = [name for _, _, names in os.walk(tmp_path / "documents") for name in names if name.endswith(".parquet")]
    assert len(files) <= 8
    read = response_source.read_responses(spark, f"{tmp_path}/documents")
    assert read.count() == n and read.filter("response_key LIKE '%/77_%'").first()["response"].startswith('{"n":\n77')
    # One object for each where a consumer wants that.
    response_source.export_responses(responses.limit(3), f"{tmp_path}/objects")
    assert len([name for name in os.listdir(tmp_path / "objects") if name.startswith("response_key=")]) == 3

    # The lines of many batches in an object are those of one object per batch.
    _, root, named = stored
    pages = spark.createDataFrame(PAGES, "s3_key string, page_no long, page_bytes binary").repartition(5)
    request_source.write_lines(R.batched_pages(pages, R.page_runs(named)), f"{tmp_path}/lines")
    assert not [name for name in os.listdir(tmp_path / "lines") if "=" in name]
    found = request_source.read_lines(spark, f"{tmp_path}/lines")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, request_source.read_batches(spark, root).collect()))
    texts = {r[0] for r in spark.read.text(f"{root}/*").collect()}
    assert {r["line"] for r in spark.read.parquet(f"{tmp_path}/lines").collect()} == texts
