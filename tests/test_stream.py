import json
import time

from panelspark import schemas
from panelspark.streaming import observations as O


def land(folder, name, records):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps(records))


def record(city, hour, aqi, parameter="NO2"):
    return {
        "DateObserved": "2024-01-01",
        "HourObserved": hour,
        "ParameterName": parameter,
        "AQI": aqi,
        "Category": {"Number": 1, "Name": "Good"},
        "TargetCity": city,
    }


def run(spark, root):
    query = O.start_store(
        O.landed_observations(spark, str(root / "landed"), files_per_batch=1),
        str(root / "history"),
        str(root / "snapshot"),
        str(root / "checkpoint"),
    )
    assert query.awaitTermination(120)
    history = O.read_history(spark, str(root / "history"))
    snapshot = O.read_snapshot(spark, str(root / "snapshot"))
    return history, {(r.CITY, r.POLLUTANT_TYPE): r.VALUE for r in snapshot.collect()}


def test_history_grows_and_snapshot_is_the_last_batch(spark, tmp_path):
    landed = tmp_path / "landed"
    land(landed / "run1", "a.json", [record("Boston", 1, 40), record("Miami", 1, 20)])
    history, snapshot = run(spark, tmp_path)
    assert history.count() == 2 and snapshot == {("Boston", "NO2"): 40, ("Miami", "NO2"): 20}
    assert history.first().CATEGORY_NAME == "Good"

    land(landed / "run2", "b.json", [record("Boston", 2, 50)])
    history, snapshot = run(spark, tmp_path)
    assert history.count() == 3 and snapshot == {("Boston", "NO2"): 50}  # Miami is missing from the batch
    latest = {(r.CITY, r.POLLUTANT_TYPE): r.VALUE for r in O.latest_stream(history).collect()}
    assert latest == {("Boston", "NO2"): 50, ("Miami", "NO2"): 20}

    history, snapshot = run(spark, tmp_path)  # nothing new
    assert history.count() == 3 and snapshot == {("Boston", "NO2"): 50}

    land(landed / "run3", "c.json", [])  # an empty batch
    (landed / "run3" / "broken.json").write_text("[{")
    history, snapshot = run(spark, tmp_path)
    assert history.count() == 3 and snapshot == {("Boston", "NO2"): 50}


def test_a_replayed_batch_replaces_itself(spark, tmp_path):
    df = spark.createDataFrame([], schemas.AQI_OBSERVATION)
    rows = spark.createDataFrame(
        [("2024-01-01", 1, None, None, None, None, None, "NO2", 7, (1, "Good"), "Boston")], df.schema
    )
    paths = str(tmp_path / "history"), str(tmp_path / "snapshot")
    for _ in range(2):
        O.store_batch(rows, 0, *paths)
    O.store_batch(df, 1, *paths)
    assert O.read_history(spark, paths[0]).count() == 1
    assert O.read_snapshot(spark, paths[1]).first().VALUE == 7


def test_a_new_checkpoint_adds_to_the_history(spark, tmp_path):
    land(tmp_path / "landed", "a.json", [record("Boston", 1, 40)])
    run(spark, tmp_path)
    land(tmp_path / "landed", "b.json", [record("Miami", 2, 50)])
    query = O.start_store(
        O.landed_observations(spark, str(tmp_path / "landed")), *(str(tmp_path / n) for n in ("history", "snapshot", "fresh"))
    )
    assert query.awaitTermination(120)
    stored = O.read_history(spark, str(tmp_path / "history"))
    assert sorted((r.TARGETCITY, r.batch_id) for r in stored.collect()) == [("Boston", 0), ("Boston", 0), ("Miami", 0)]
    assert stored.select("run").distinct().count() == 2


def test_observations_without_city_are_kept(spark, tmp_path):
    bare = {"AQI": 5, "HourObserved": 3}
    land(tmp_path / "landed", "a.json", [record("Boston", 1, 40), bare])
    history, _ = run(spark, tmp_path)
    assert sorted((r.TARGETCITY or "", r.AQI) for r in history.collect()) == [("", 5), ("Boston", 40)]


def test_a_failed_switch_leaves_the_old_snapshot(spark, tmp_path, monkeypatch):
    land(tmp_path / "landed", "a.json", [record("Boston", 1, 40)])
    run(spark, tmp_path)
    rows = spark.createDataFrame([("2024-01-01", 1, None, None, None, None, None, "NO2", 7, (1, "Good"), "Miami")], schemas.AQI_OBSERVATION)
    monkeypatch.setattr(O, "_pointers", lambda *a: 1 / 0)  # after the new rows are written, before they count
    try:
        O.store_batch(rows, 5, str(tmp_path / "history"), str(tmp_path / "snapshot"))
    except ZeroDivisionError:
        pass
    monkeypatch.undo()
    assert [r.CITY for r in O.read_snapshot(spark, str(tmp_path / "snapshot")).collect()] == ["Boston"]


def test_latest_as_a_stream(spark, tmp_path):
    """The state of the running aggregate is one row per city and pollutant."""
    land(tmp_path / "landed", "a.json", [record("Boston", 1, 40), record("Boston", 3, 60), record("Miami", 2, 5)])
    land(tmp_path / "landed", "b.json", [record("Boston", 2, 50)])
    from panelspark.plans.airquality import history_rows

    stream = O.landed_observations(spark, str(tmp_path / "landed"), files_per_batch=1)
    query = (
        O.latest_stream(history_rows(stream))
        .writeStream.outputMode("complete")
        .format("memory")
        .queryName("latest_now")
        .trigger(availableNow=True)
        .start()
    )
    assert query.awaitTermination(120)
    assert {(r.CITY, r.VALUE) for r in spark.table("latest_now").collect()} == {("Boston", 60), ("Miami", 5)}


def test_malformed_files_are_set_down(spark, tmp_path):
    landed = tmp_path / "landed"
    for n in range(5):
        land(landed, f"{n}.json", [record("Boston", n, n)])
    (landed / "bad 1.json").write_text('[{"AQI": 3}, ')
    (landed / "bad2.json").write_text("no json")
    paths = [str(tmp_path / name) for name in ("history", "snapshot", "checkpoint")]
    stream = O.landed_observations(spark, str(landed), files_per_batch=2, keep_malformed=True)
    query = O.start_store(stream, *paths, rejected_path=str(tmp_path / "rejected"))
    assert query.awaitTermination(120)
    assert len(query.recentProgress) == 4  # seven files, two at a time
    assert sorted(r.AQI for r in O.read_history(spark, paths[0]).collect()) == [0, 1, 2, 3, 4]
    rejected = O.read_rejected(spark, str(tmp_path / "rejected"))
    assert sorted((r.file.rsplit("/", 1)[1], r.length) for r in rejected.collect()) == [("bad%201.json", 13), ("bad2.json", 7)]
    assert rejected.filter("run is null or batch_id is null").isEmpty()
    assert O.read_rejected(spark, str(tmp_path / "nowhere")).isEmpty()


def test_files_that_are_done_with_move_to_the_archive(spark, tmp_path):
    def names(folder):
        return sorted(p.name for p in (tmp_path / folder).rglob("*.json"))

    for n in range(3):
        land(tmp_path / "landed", f"{n}.json", [record("Boston", n, n)])
        stream = O.landed_observations(spark, str(tmp_path / "landed"), files_per_batch=1, archive=str(tmp_path / "done"))
        query = O.start_store(stream, *(str(tmp_path / name) for name in ("history", "snapshot", "checkpoint")))
        assert query.awaitTermination(120)
        deadline = time.monotonic() + 20
        while len(names("done")) < n and time.monotonic() < deadline:
            time.sleep(0.2)
    assert names("done") + names("landed") == ["0.json", "1.json", "2.json"] and "0.json" in names("done")
    assert O.read_history(spark, str(tmp_path / "history")).count() == 3


def test_latest_values_are_kept_by_state(spark, tmp_path):
    """Equals the batch operator; a city that is missing from a batch stays, an older row changes nothing."""
    from panelspark.plans.airquality import history_rows, latest_per_key

    batches = [
        [record("Boston", 1, 40), record("Miami", 2, 5)],
        [record("Boston", 3, 60), record("Boston", 3, 55), record("Denver", 1, 9)],
        [record("Boston", 2, 99), record(None, 1, 7), record("Miami", 2, 6)],
    ]
    for n, batch in enumerate(batches):
        land(tmp_path / "landed", f"{n}.json", batch)
        rows = history_rows(O.landed_observations(spark, str(tmp_path / "landed")))
        query = O.start_latest(rows, str(tmp_path / "latest"), str(tmp_path / "checkpoint"))
        assert query.awaitTermination(120)
        assert query.lastProgress["stateOperators"][0]["numRowsUpdated"] == len({r["TargetCity"] for r in batch})
    latest = {(r.CITY, r.VALUE) for r in O.read_snapshot(spark, str(tmp_path / "latest")).collect()}
    assert latest == {("Boston", 60), ("Miami", 6), ("Denver", 9), (None, 7)}
    everything = history_rows(spark.read.schema(schemas.AQI_OBSERVATION).json(str(tmp_path / "landed"), multiLine=True))
    batch = latest_per_key(everything, ["DATEOBSERVED", "HOUROBSERVED"])
    assert {(r.TARGETCITY, r.AQI) for r in batch.collect()} == latest


def test_interval_trigger(spark, tmp_path):
    land(tmp_path / "landed", "a.json", [record("Boston", 1, 40)])
    query = O.start_store(
        O.landed_observations(spark, str(tmp_path / "landed")),
        str(tmp_path / "history"),
        str(tmp_path / "snapshot"),
        str(tmp_path / "checkpoint"),
        every=O.EVERY_20_MINUTES,
    )
    try:
        # The first batch runs at once, the next one in 20 minutes.
        deadline = time.monotonic() + 60
        while not query.recentProgress and time.monotonic() < deadline:
            time.sleep(0.2)
        assert O.read_history(spark, str(tmp_path / "history")).count() == 1
    finally:
        query.stop()
