"""Streams against the batch operators: several batches, then a restart from the checkpoint."""

import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from wayfare.operators import changes, members, orders, tracks
from wayfare.operators.spread import latest_per_key
from wayfare.schemas import MESSAGE
from wayfare.sources import derived
from wayfare.sources.maintained import MaintainedTable
from wayfare.streaming import jobs, lifecycle, progress, sources

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.select(*sorted(df.columns)).collect())


def deliver(df, path, parts):
    """Write messages as ``parts`` files by offset; returns the writer of the next part."""
    df = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                     for f in MESSAGE])
    bounds = df.agg(F.max("offset")).first()[0] + 1
    for i in range(parts):
        low, high = bounds * i // parts, bounds * (i + 1) // parts
        (df.where((F.col("offset") >= low) & (F.col("offset") < high)).coalesce(1)
         .write.mode("append").parquet(path))
        yield df.where(F.col("offset") < high)


def run_in_parts(spark, messages, tmp_path, start, current, expected, parts=3):
    """Each part is delivered, processed by a fresh query on the same checkpoint, and compared."""
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    for so_far in deliver(messages, source, parts):
        query = start(sources.file_messages(spark, source, max_files=1), out, checkpoint)
        query.awaitTermination()
        assert rows(current(out)) == rows(expected(so_far))
    # A restart without new input must count nothing twice.
    start(sources.file_messages(spark, source), out, checkpoint).awaitTermination()
    assert rows(current(out)) == rows(expected(messages))


def test_order_totals(spark, tmp_path):
    run_in_parts(spark, derived.order_messages(spark, SF), tmp_path, jobs.start_order_totals,
                 lambda out: jobs.current_order_totals(spark, out), orders.order_totals)


@pytest.mark.parametrize("entity", ["order", "user"])
def test_changes(spark, tmp_path, entity):
    run_in_parts(spark, derived.change_messages(spark, SF), tmp_path, jobs.start_changes,
                 lambda out: jobs.current_entities(spark, out, entity),
                 lambda m: changes.latest_state(m, entity), parts=2)


def test_lifecycles(spark, tmp_path):
    run_in_parts(spark, derived.gps_messages(spark, SF), tmp_path, jobs.start_lifecycles,
                 lambda out: jobs.current_lifecycles(spark, out),
                 lambda m: tracks.order_lifecycle(tracks.track_messages(m)))


def test_first_seen(spark, tmp_path):
    run_in_parts(spark, derived.gps_messages(spark, SF), tmp_path, jobs.start_first_seen,
                 lambda out: jobs.current_hourly_orders(spark, out),
                 lambda m: tracks.hourly_orders(tracks.gps_points(m)))


def test_tracks(spark, tmp_path):
    columns = ["rowkey", "driver_id", "epoch", "lng", "lat", "offset", "city_code"]
    run_in_parts(spark, derived.gps_messages(spark, SF), tmp_path, jobs.start_tracks,
                 lambda out: jobs.current_tracks(spark, out).select(*columns),
                 lambda m: tracks.track_table(tracks.gps_points(m)).select(*columns), parts=2)


def test_order_detail(spark, tmp_path):
    columns = ["rowkey", "departure_time", "starting_lng", "offset"]
    run_in_parts(spark, derived.order_messages(spark, SF), tmp_path, jobs.start_order_detail,
                 lambda out: jobs.current_order_detail(spark, out).select(*columns),
                 lambda m: latest_per_key(orders.order_detail(m), ["rowkey"], ["offset"]).select(*columns), parts=2)


def paths(tmp_path, *names):
    return [str(tmp_path / n) for n in names]


def files_in(folder):
    return [p for p in Path(folder).rglob("*.parquet") if p.is_file()]


def test_each_batch_is_evaluated_once(spark, tmp_path):
    source, out, checkpoint = paths(tmp_path, "in", "out", "cp")
    messages = derived.change_messages(spark, SF)
    for _ in deliver(messages, source, 3):
        pass
    for name, start in (("totals", jobs.start_order_totals), ("changes", jobs.start_changes), ("tracks", jobs.start_tracks)):
        query = start(sources.file_messages(spark, source, max_files=1), f"{out}-{name}", f"{checkpoint}-{name}")
        query.awaitTermination()
        assert sum(p["numInputRows"] for p in query.recentProgress) == messages.count(), name


def test_running_job_is_compacted(spark, tmp_path):
    source, out, checkpoint = paths(tmp_path, "in", "out", "cp")
    messages = derived.order_messages(spark, SF)
    for _ in deliver(messages, source, 9):
        pass
    jobs.start_order_totals(sources.file_messages(spark, source, max_files=1), out, checkpoint, compact_every=2).awaitTermination()
    assert rows(jobs.current_order_totals(spark, out)) == rows(orders.order_totals(messages))
    # Batch 8 and the pair folded last, which readers of the manifest before may still use.
    left = [int(p.name.removeprefix("batch_id=")) for p in Path(out, "deltas/run=0").iterdir()]
    assert sorted(left) == [6, 7, 8]
    assert len(list(Path(out, "base").iterdir())) == 2
    _, state = jobs.order_total_table(spark, out).manifest()
    assert state["folded"] == {"0": 7}
    # By hand, while no batch comes: the rest is folded, and a second time there is nothing to do.
    store = jobs.order_total_table(spark, out)
    assert store.compact() and not store.compact()
    assert rows(store.current()) == rows(orders.order_totals(messages))


def test_a_new_checkpoint_wins_and_fences_the_old_one(spark, tmp_path):
    source, out, old, new = paths(tmp_path, "in", "out", "cp-old", "cp-new")
    messages = derived.order_messages(spark, SF)
    for at, _ in enumerate(deliver(messages, source, 4)):
        if at == 2:  # three batches: more than the new checkpoint will have
            jobs.start_order_totals(sources.file_messages(spark, source, max_files=1), out, old).awaitTermination()
    jobs.start_order_totals(sources.file_messages(spark, source), out, new).awaitTermination()
    assert rows(jobs.current_order_totals(spark, out)) == rows(orders.order_totals(messages))
    with pytest.raises(StreamingQueryException, match="newer checkpoint"):
        jobs.start_order_totals(sources.file_messages(spark, source, max_files=1), out, old).awaitTermination()
    # What the old one wrote before it was fenced off does not come back with a compaction.
    assert jobs.order_total_table(spark, out).compact()
    assert rows(jobs.current_order_totals(spark, out)) == rows(orders.order_totals(messages))


def test_messages_delivered_twice_are_one_row(spark, tmp_path):
    source, out, checkpoint = paths(tmp_path, "in", "out", "cp")
    messages = derived.gps_messages(spark, SF)
    want = rows(tracks.track_table(tracks.gps_points(messages)))
    for _ in range(2):
        for _ in deliver(messages, source, 2):
            jobs.start_tracks(sources.file_messages(spark, source, max_files=1), out, checkpoint, compact_every=3).awaitTermination()
    assert rows(jobs.current_tracks(spark, out).drop("day")) == want
    assert jobs.track_table(spark, out).compact()
    assert rows(jobs.current_tracks(spark, out).drop("day")) == want


def test_compaction_rewrites_touched_days_only(spark, tmp_path):
    store = MaintainedTable(spark, str(tmp_path / "t"), ["k"], ["v"], partitions=["city", "day"])
    first = spark.createDataFrame([(1, 1, "a", "2024-01-01"), (2, 1, "a", "2024-01-02"), (3, 1, "b c", None)],
                                  "k int, v int, city string, day string")
    store.append(first, "r", 0)
    assert store.compact()
    store.append(first.where("k <> 2").withColumn("v", F.lit(2)), "r", 1)
    store.append(first.where("k = 1").withColumn("v", F.lit(3)), "r", 2)
    assert store.compact()
    _, state = store.manifest()
    newer = {p for p, g in state["base"].items() if g == max(state["base"].values())}
    assert len(state["base"]) == 3 and newer == set(state["base"]) - {"city=a/day=2024-01-02"}
    want = {(1, 3, "a", "2024-01-01"), (2, 1, "a", "2024-01-02"), (3, 2, "b c", None)}
    assert {tuple(r) for r in store.current().collect()} == want
    store.append(first.where("k = 2").withColumn("v", F.lit(9)), "r", 3)
    assert store.compact()
    assert {tuple(r) for r in store.current().collect()} == {(k, 9 if k == 2 else v, c, d) for k, v, c, d in want}
    assert len(files_in(tmp_path / "t/base")) <= 5


def test_a_batch_that_is_not_finished_is_not_read(spark, tmp_path):
    store = MaintainedTable(spark, str(tmp_path / "t"), ["k"])
    with pytest.raises(FileNotFoundError):
        store.current()
    frame = spark.createDataFrame([(1, 1)], "k int, v int")
    store.append(frame, "r", 0)
    store.append(frame.withColumn("v", F.lit(2)), "r", 1)
    (tmp_path / "t/deltas/run=0/batch_id=1/_SUCCESS").unlink()
    assert [tuple(r) for r in store.current().collect()] == [(1, 1)]
    store.append(frame.withColumn("v", F.lit(2)), "r", 1)
    assert [tuple(r) for r in store.current().collect()] == [(1, 2)]


def test_compacted_alliances_keep_cells_that_later_writes_lack(spark, tmp_path):
    source, out, checkpoint = paths(tmp_path, "in", "out", "cp")
    messages = derived.alliance_updates(spark, SF)
    for _ in deliver(messages, source, 4):
        jobs.start_changes(sources.file_messages(spark, source), out, checkpoint, compact_every=3).awaitTermination()
    want = rows(changes.latest_state(messages, "alliance"))
    assert rows(jobs.current_entities(spark, out, "alliance")) == want
    assert jobs.entity_table(spark, out, "alliance").compact()
    kept = jobs.current_entities(spark, out, "alliance")
    assert rows(kept) == want
    assert kept.where("linkman is not null").count() == 17  # keys by 2 or 3, of 25


def state_rows(query):
    return [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]


def test_ended_orders_leave_the_state(spark, tmp_path):
    source, out, checkpoint = paths(tmp_path, "in", "out", "cp")
    messages = derived.gps_messages(spark, SF)
    for _ in deliver(messages, source, 3):
        pass
    query = jobs.start_lifecycles(sources.file_messages(spark, source, max_files=1), out, checkpoint, compact_every=2)
    query.awaitTermination()
    want = tracks.order_lifecycle(tracks.track_messages(messages))
    assert rows(jobs.current_lifecycles(spark, out)) == rows(want)
    last = tracks.track_messages(messages).groupBy("city_code", "order_id").agg(F.max_by("is_end", "offset").alias("ended"))
    assert state_rows(query)[-1] == last.where("not ended").count() < last.count()
    # All that is open ends.
    ends = last.where("not ended").select(
        F.when(F.col("city_code") == "610100", "xi_an_gps_topic").otherwise("cheng_du_gps_topic_2").alias("topic"),
        F.col("order_id").alias("key"), F.lit("end").alias("value"), F.lit(10**9).alias("offset"), F.lit("2024-02-01 00:00:00").alias("ts"))
    ends = ends.select(*[F.col(f.name).cast(f.dataType) for f in MESSAGE])
    ends.coalesce(1).write.mode("append").parquet(source)
    query = jobs.start_lifecycles(sources.file_messages(spark, source), out, checkpoint)
    query.awaitTermination()
    assert state_rows(query)[-1] == 0
    assert rows(jobs.current_lifecycles(spark, out)) == rows(want.withColumn("closed", F.lit(True)))


@pytest.mark.parametrize("seed", range(3))
def test_lives_do_not_depend_on_batches(seed):
    draw = random.Random(seed)
    messages = [(i, draw.randint(0, 50), draw.random() < 0.2) for i in range(60)]

    def lives_of(sizes):
        state, stored, at = None, {}, 0
        for n in sizes:
            part, at = messages[at:at + n], at + n
            if part:
                draw.shuffle(part)
                state, out = lifecycle.fold_messages(state, *map(np.array, zip(*part, strict=True)))
                stored |= {row[0]: row for row in out}
        return stored

    assert lives_of([60]) == lives_of([1] * 60) == lives_of([7, 0, 13, 30, 10])


def test_first_seen_with_expiry(spark, tmp_path):
    """Two hours of points that go on for days: the state holds what is young, the hourly counts are those of all."""
    source, out, checkpoint = paths(tmp_path, "in", "out", "cp")
    day = F.expr("timestamp_ntz'2024-01-01 00:00:00'")
    messages = spark.range(6000).select(
        F.lit("xi_an_gps_topic").alias("topic"), F.lit(None).cast("string").alias("key"),
        F.concat_ws(",", F.lit("d"), F.concat(F.lit("o"), (F.col("id") / 20).cast("int")),
                    (F.lit(1_704_067_200) + F.col("id") * 60 - F.pmod(F.col("id") * 7, F.lit(11)) * 300).cast("string"),
                    F.lit("1"), F.lit("2")).alias("value"), F.col("id").alias("offset"), day.alias("ts"))
    for _ in deliver(messages, source, 6):
        pass
    query = jobs.start_first_seen(sources.file_messages(spark, source, max_files=1), out, checkpoint, compact_every=4, expire_s=7200)
    query.awaitTermination()
    want = rows(tracks.hourly_orders(tracks.gps_points(messages)))
    assert rows(jobs.current_hourly_orders(spark, out)) == want
    held = state_rows(query)
    assert max(held) < 300 and held[-1] < 150 < 6000 / 20


def test_word_count_lines(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.txt").write_text("are you ok\n")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    jobs.start_word_count(sources.text_lines(spark, str(source)), out, checkpoint).awaitTermination()
    (source / "b.txt").write_text("are  we\n")
    jobs.start_word_count(sources.text_lines(spark, str(source)), out, checkpoint).awaitTermination()
    found = {r["word"]: r["occurrences"] for r in jobs.current_word_counts(spark, out).collect()}
    assert found == {"are": 2, "you": 1, "ok": 1, "": 1, "we": 1}
    whole = members.word_count(spark.read.text(str(source)), "value")
    assert found == {r["word"]: r["occurrences"] for r in whole.collect()}


@pytest.mark.parametrize("flush_every", [1, 2, 100])
def test_progress(spark, tmp_path, flush_every):
    """Reports of real queries through the session's listener bus; none is lost, however few at a time are written."""
    source, out, checkpoint, log = paths(tmp_path, "in", "out", "cp", "log")
    for _ in deliver(derived.order_messages(spark, SF), source, 3):
        pass
    with progress.ProgressLog(spark, log, flush_every):
        queries = [start(sources.file_messages(spark, source, max_files=1), f"{out}{i}", f"{checkpoint}{i}")
                   for i, start in enumerate((jobs.start_order_totals, jobs.start_order_detail))]
        for query in queries:
            query.awaitTermination()
    tables = [progress.recent_progress(spark, query) for query in queries]
    stored = spark.read.parquet(log)
    assert rows(stored) == rows(tables[0].unionByName(tables[1]))
    assert stored.groupBy("query_id").agg(F.sum("records").alias("n")).select("n").distinct().first()[0] == 1500
    assert stored.where("total_delay_ms < duration_ms").count() == 0


def test_progress_tells_of_a_failed_write(spark, tmp_path):
    source, out, checkpoint = paths(tmp_path, "in", "out", "cp")
    for _ in deliver(derived.order_messages(spark, SF), source, 1):
        pass
    (tmp_path / "log").write_text("not a folder")
    log = progress.ProgressLog(spark, str(tmp_path / "log"), 1).__enter__()
    jobs.start_order_totals(sources.file_messages(spark, source), out, checkpoint).awaitTermination()
    with pytest.raises(Exception, match="(?i)exist|directory|not a"):
        log.close()


def test_preview(spark, tmp_path, capfd):
    source, = paths(tmp_path, "in")
    for _ in deliver(derived.order_messages(spark, SF), source, 1):
        pass
    query = jobs.start_preview(sources.file_messages(spark, source), n=3)
    query.awaitTermination()
    assert query.recentProgress[0]["sink"]["numOutputRows"] == 1500


def test_processing_time_trigger(spark, tmp_path):
    source, out, checkpoint = paths(tmp_path, "in", "out", "cp")
    parts = deliver(derived.order_messages(spark, SF), source, 2)
    next(parts)
    query = jobs.start_order_totals(sources.file_messages(spark, source), out, checkpoint, seconds=1)
    try:
        query.processAllAvailable()
        next(parts)
        query.processAllAvailable()
    finally:
        query.stop()
    assert rows(jobs.current_order_totals(spark, out)) == rows(orders.order_totals(derived.order_messages(spark, SF)))


def test_kafka_options():
    options = sources.kafka_options("broker:9092", max_offsets=5000)
    assert options["subscribe"] == "hai_kou_order_topic,cheng_du_order_topic,xi_an_order_topic"
    assert options["maxOffsetsPerTrigger"] == "5000" and options["failOnDataLoss"] == "false"
