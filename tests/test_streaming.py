"""Streams must equal the batch queries, over several micro-batches and restarts."""

import pytest
from pyspark.sql import functions as F

from kinora.operators.similar import ItemSimilarity
from kinora.plans import content, realtime
from kinora.schema import RATING_EVENT
from kinora.sources import fixtures as fx
from kinora.sources import streams
from kinora.streaming import recommender, versions


@pytest.fixture()
def files(spark, sf, tmp_path):
    """Rating events as several files, not in time order."""
    events = fx.rating_events(spark, sf).withColumn("part", F.pmod(F.xxhash64("event_id"), F.lit(5)))
    parts = [events.where(F.col("part") == i).drop("part") for i in range(5)]
    source = tmp_path / "events"

    def add(indexes):
        for i in indexes:
            parts[i].coalesce(1).write.mode("append").parquet(str(source))

    return str(source), add


def _stream(spark, source):
    return streams.file_source(spark, source, RATING_EVENT, files_per_trigger=1)


def _lists(df):
    zipped = F.arrays_zip("recent_ids", "recent_mids", "recent_scores")
    return df.select("uid", F.posexplode(zipped).alias("pos", "x")).select(
        "uid", (F.col("pos") + 1).alias("rank"), F.col("x.recent_ids").alias("event_id"), F.col("x.recent_mids").alias("mid")
    )


def test_recent_lists_survive_a_restart(spark, sf, files, tmp_path):
    source, add = files
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for indexes in ([0, 1, 2], [3, 4]):
        add(indexes)
        recommender.start_recent_lists(_stream(spark, source), out, state, availableNow=True).awaitTermination()
    batch = realtime.recent_ratings(fx.rating_events(spark, sf)).select("uid", "rank", "event_id", "mid")
    streamed = _lists(recommender.current(spark, out))
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    recommender.compact(spark, out)
    folded = _lists(recommender.current(spark, out))
    assert folded.exceptAll(batch).count() == 0 and batch.exceptAll(folded).count() == 0


def test_recommender_keeps_one_row_per_user(spark, sf, files, tmp_path):
    source, add = files
    add([0, 1])
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    similarity = content.similarity(fx.movies(spark, sf))
    seen = fx.ratings(spark, sf).select("uid", F.col("mid").alias("item")).distinct()
    for indexes in ([], [2]):
        add(indexes)
        recommender.start_recommender(
            _stream(spark, source), lambda: similarity, lambda: seen, out, state, availableNow=True
        ).awaitTermination()
    rows = recommender.current(spark, out)
    users = spark.read.parquet(source).select("uid").distinct()
    assert rows.count() == users.count() == rows.select("uid").distinct().count()


def test_newest_event_of_a_micro_batch_wins(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    rows = [(2, 1, 20, 5.0, 100), (1, 1, 10, 5.0, 100), (3, 1, 30, 5.0, 50)]
    spark.createDataFrame(rows, RATING_EVENT).coalesce(1).write.parquet(source)
    pairs = spark.createDataFrame([(20, 40, 0.9), (40, 20, 0.9), (10, 50, 0.9), (50, 10, 0.9)], "source int, target int, score double")
    seen = spark.createDataFrame([(9, 9)], "uid int, item int")
    recommender.start_recommender(
        _stream(spark, source), lambda: ItemSimilarity(pairs), lambda: seen, out, state, availableNow=True
    ).awaitTermination()
    row = recommender.current(spark, out).first()
    assert row.uid == 1 and [(r.mid, r.score) for r in row.recs] == [(40, 4.5)]


def test_a_hot_user_is_cut_before_the_shuffle(spark):
    from kinora.streaming.recent import newest_per_user

    rows = [(i, 1, i % 50, 3.0, i // 3) for i in range(5000)]
    events = spark.createDataFrame(rows, RATING_EVENT).coalesce(1)
    cut = events.mapInPandas(newest_per_user(20), RATING_EVENT)
    assert cut.count() <= 20
    assert {r.event_id for r in cut.collect()} == set(range(4980, 5000))


def test_messages_and_log_lines_through_files(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    spark.createDataFrame([("x MOVIE_RATING_PREFIX: 1|2|3|4",), ("noise",)], "value string").write.text(source)
    lines = spark.readStream.text(source)
    streams.start_file_sink(streams.ratings_from_log(lines), out, state, availableNow=True).awaitTermination()
    assert [r.value for r in spark.read.parquet(out).collect()] == ["1|2|3|4"]


# -- the versioned logs -------------------------------------------------------------------------


SHAPE = "uid int, mid int"


def _log(spark, path, *batches):
    for batch, rows in enumerate(batches):
        versions.append(spark.createDataFrame(rows, SHAPE), path, batch)


def _now(spark, path):
    return {tuple(r) for r in recommender.current(spark, path, SHAPE).collect()}


FOUR = [[(1, 1), (2, 1)], [(1, 2)], [(3, 3)], [(2, 4)]]
STATE = {(1, 2), (2, 4), (3, 3)}


def test_compaction_keeps_the_newest_rows(spark, tmp_path):
    path = str(tmp_path / "log")
    assert _now(spark, path) == set() and versions.batches(spark, path) == []
    recommender.compact(spark, path)  # nothing to fold yet
    _log(spark, path, *FOUR)
    old_reader = recommender.current(spark, path)
    for _ in range(2):
        recommender.compact(spark, path)
        assert versions.batches(spark, path) == [3] and _now(spark, path) == STATE
    assert {tuple(r) for r in old_reader.collect()} == STATE  # its folders are still there
    versions.append(spark.createDataFrame([(3, 9)], SHAPE), path, 3)  # the newest batch is repeated
    versions.append(spark.createDataFrame([(3, 8)], SHAPE), path, 1)  # a folded one counts once
    assert _now(spark, path) == {(1, 2), (2, 1), (3, 9)}
    with pytest.raises(ValueError):
        versions.append(spark.createDataFrame([("x",)], "uid string"), path, 4)


@pytest.mark.parametrize("step", ["_write_folder", "publish", "_put_text", "rename", "hint"])
@pytest.mark.parametrize("action", ["append", "compact"])
def test_a_failure_at_any_step_loses_nothing(spark, tmp_path, monkeypatch, step, action):
    """The step fails once; the log reads as before or as after the change, and the change can be repeated."""
    path = str(tmp_path / "log")
    _log(spark, path, *FOUR)
    put = versions._put_text

    def broken(*args, **kwargs):
        raise RuntimeError("lost")

    def put_but(session, where, text, replace):
        """Fails after the file was written, before (rename) or after (hint) the manifest counts."""
        if replace == (step == "hint"):
            raise RuntimeError("lost")
        return put(session, where, text, replace)

    def act():
        if action == "append":
            versions.append(spark.createDataFrame([(1, 7)], SHAPE), path, 4)
        else:
            recommender.compact(spark, path)

    after = STATE - {(1, 2)} | {(1, 7)} if action == "append" else STATE
    with monkeypatch.context() as patch:
        if step in ("rename", "hint"):
            patch.setattr(versions, "_put_text", put_but)
        else:
            patch.setattr(versions, step, broken)
        with pytest.raises(RuntimeError):
            act()
        assert _now(spark, path) == (after if step == "hint" else STATE)
    act()
    assert _now(spark, path) == after
    versions.vacuum(spark, path, keep=1, older_than=0)
    assert _now(spark, path) == after


def test_a_write_that_dies_inside_the_job_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "log")
    _log(spark, path, *FOUR)
    bad = spark.range(4).select(F.col("id").cast("int").alias("uid"), F.when(F.col("id") == 3, F.raise_error(F.lit("lost"))).cast("int").alias("mid"))
    with pytest.raises(Exception, match="lost"):
        versions.append(bad, path, 4)
    assert _now(spark, path) == STATE


def test_two_writers_at_once(spark, tmp_path, monkeypatch):
    """Who comes second with a manifest number applies the change to the other's."""
    path = str(tmp_path / "log")
    _log(spark, path, *FOUR)
    write, late = versions._write_folder, []

    def slow(rows, where):
        folder = write(rows, where)
        if not late:
            late.append(1)
            versions.append(spark.createDataFrame([(5, 5)], SHAPE), path, 4)
        return folder

    monkeypatch.setattr(versions, "_write_folder", slow)
    recommender.compact(spark, path)
    assert _now(spark, path) == STATE | {(5, 5)} and versions.batches(spark, path) == [3, 4]
    taken = versions.manifest(spark, path)[0]
    assert not versions._put_text(spark, f"{path}/manifests/{taken}", "{}", replace=False)


def test_vacuum_keeps_what_readers_need(spark, tmp_path):
    path = str(tmp_path / "log")
    versions.vacuum(spark, path)
    _log(spark, path, *FOUR)
    recommender.compact(spark, path)
    versions.vacuum(spark, path, keep=2, older_than=0)
    assert len(list((tmp_path / "log" / "data").iterdir())) == 5 and _now(spark, path) == STATE
    versions.vacuum(spark, path, keep=1, older_than=0)
    assert len(list((tmp_path / "log" / "data").iterdir())) == 2 and _now(spark, path) == STATE
    versions.append(spark.createDataFrame([(1, 7)], SHAPE), path, 4)
    assert _now(spark, path) == STATE - {(1, 2)} | {(1, 7)}


# -- the chain from log lines to lists ------------------------------------------------------------


def test_chain_repeats_batches_without_trace(spark, tmp_path):
    """Two outputs of one query; a batch that is run again, and one that died between the outputs, count once."""
    source, out, gone, state = (str(tmp_path / n) for n in ("in", "out", "gone", "state"))
    shape = "event_id long, value string"
    pairs = spark.createDataFrame([(20, 40, 0.9), (40, 20, 0.9), (10, 50, 0.9), (50, 10, 0.9)], "source int, target int, score double")
    seen = spark.createDataFrame([(9, 9)], "uid int, item int")
    files = [
        [(1, "x MOVIE_RATING_PREFIX: 1|20|5|100"), (2, "x MOVIE_RATING_PREFIX:"), (3, "noise")],
        [(4, "MOVIE_RATING_PREFIX: 1|10|4|200"), (5, "MOVIE_RATING_PREFIX: 1|10"), (6, "MOVIE_RATING_PREFIX: 2|20|5|1")],
    ]

    def run(similarity=lambda: ItemSimilarity(pairs)):
        lines = streams.file_source(spark, source, shape, files_per_trigger=1)
        recommender.start_chain(lines, similarity, lambda: seen, out, gone, state, availableNow=True).awaitTermination()

    def result():
        recs = {r["uid"]: [x["mid"] for x in r["recs"]] for r in recommender.current(spark, out).collect()}
        return recs, sorted((r["event_id"], r["stage"], r["value"]) for r in versions.rows(spark, gone).collect())

    def add(i):
        spark.createDataFrame(files[i], shape).coalesce(1).write.mode("append").parquet(source)

    add(0)
    run()
    assert result() == ({1: [40]}, [(2, "filter", "x MOVIE_RATING_PREFIX:")])
    add(1)

    def lost():
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        run(lost)  # the rejects are written, the lists are not
    assert result()[0] == {1: [40]}
    run()
    whole = ({1: [50], 2: [40]}, [(2, "filter", "x MOVIE_RATING_PREFIX:"), (5, "parse", "1|10")])
    assert result() == whole
    (tmp_path / "state" / "commits" / "1").unlink()  # as if the driver died before it noted the batch
    (tmp_path / "state" / "commits" / ".1.crc").unlink(missing_ok=True)
    run()
    assert result() == whole


def test_incomplete_events_are_kept_as_rejects(spark, tmp_path):
    source, out, gone, state = (str(tmp_path / n) for n in ("in", "out", "gone", "state"))
    rows = [(1, 1, 20, 5.0, 100), (2, None, 20, 5.0, 100), (3, 1, 20, None, 101)]
    spark.createDataFrame(rows, RATING_EVENT).coalesce(1).write.parquet(source)
    pairs = spark.createDataFrame([(20, 40, 0.9), (40, 20, 0.9)], "source int, target int, score double")
    seen = spark.createDataFrame([(9, 9)], "uid int, item int")
    recommender.start_recommender(
        _stream(spark, source), lambda: ItemSimilarity(pairs), lambda: seen, out, state, rejects=gone, availableNow=True
    ).awaitTermination()
    assert [(r["uid"], len(r["recs"])) for r in recommender.current(spark, out).collect()] == [(1, 1)]
    turned_away = versions.rows(spark, gone).orderBy("event_id").collect()
    assert [(r["event_id"], r["stage"]) for r in turned_away] == [(2, "event"), (3, "event")]
    assert "20" in turned_away[0]["value"]


def test_console_sink_and_processing_time(spark, tmp_path):
    """K4, F16 and the 2 s trigger: a running query prints its batches; lines carry the time they were handled."""
    import time
    from datetime import datetime, timezone

    source, state, stamped = (str(tmp_path / n) for n in ("in", "state", "stamped"))
    spark.createDataFrame([("x MOVIE_RATING_PREFIX: 1|2|3|4",), ("noise",)], "value string").write.text(source)
    lines = spark.readStream.text(source)
    before = datetime.now(timezone.utc).replace(tzinfo=None)
    streams.start_file_sink(streams.ratings_from_log(lines, stamp=True), stamped, state + "1", availableNow=True).awaitTermination()
    at = spark.read.parquet(stamped).selectExpr("date_format(processed_at, 'yyyy-MM-dd HH:mm:ss.SSSSSS') AS at").first()["at"]
    assert before <= datetime.fromisoformat(at) <= datetime.now(timezone.utc).replace(tzinfo=None)
    running = streams.start_console_sink(streams.ratings_from_log(lines), state + "2")
    try:
        deadline = time.time() + 60
        while not (running.lastProgress or {}).get("numInputRows") and time.time() < deadline:
            time.sleep(0.2)
        assert running.isActive and any(p["numInputRows"] == 2 for p in running.recentProgress)
        assert running.lastProgress["sink"]["description"].startswith("org.apache.spark.sql.execution.streaming.ConsoleTable")
    finally:
        running.stop()
