import json
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from fleet.plans.runs import artifact_map, child_runs, group_run_name, log_runs, search_runs
from fleet.sources import sinks, tables
from fleet.streaming.images import image_rows, ingest_images, label_counts


def _png(width, height):
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    rows = b"".join(b"\x00" + b"\x10" * (3 * width) for _ in range(height))
    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def _jpeg_header(width, height):
    app = b"\xff\xe0" + struct.pack(">H", 16) + b"JFIF\x00" + b"\x00" * 9
    frame = b"\xff\xc0" + struct.pack(">HBHHB", 17, 8, height, width, 3) + b"\x00" * 9
    return b"\xff\xd8" + app + frame


def _put(root, label, name, content):
    folder = root / "flower_photos" / label
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(content)


def test_image_stream_takes_each_file_once(spark, tmp_path):
    root, target, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    _put(root, "daisy", "a.jpg", _png(500, 410))
    _put(root, "daisy", "b.jpg", _png(100, 410))
    _put(root, "rose", "c.jpg", _jpeg_header(640, 480))
    _put(root, "rose", "broken.jpg", b"not an image")
    _put(root, "rose", "skipped.txt", b"text")
    run = lambda: ingest_images(spark, str(root), target, checkpoint, partitions=4).awaitTermination()
    run()
    assert spark.read.parquet(target).count() == 4
    _put(root, "daisy", "d.jpg", _png(401, 400))
    run()
    run()
    saved = spark.read.parquet(target)
    assert saved.count() == 5 and saved.select("path").distinct().count() == 5
    assert saved.where("size.width IS NULL").count() == 1
    assert [tuple(r) for r in label_counts(saved).collect()] == [("rose", 1), ("daisy", 2)]
    assert saved.where("label = 'daisy'").count() == 3


def test_image_stream_to_a_table(spark, tmp_path):
    _put(tmp_path / "in", "tulip", "a.jpg", _png(2, 3))
    ingest_images(spark, str(tmp_path / "in"), "images_saved", str(tmp_path / "ck"), table=True).awaitTermination()
    assert spark.table("images_saved").select("size.width", "size.height").first() == (2, 3)


def test_image_and_binary_readers(spark, tmp_path):
    _put(tmp_path, "daisy", "a.jpg", _png(6, 4))
    image = tables.read_images(spark, str(tmp_path)).first()
    assert (image["size"]["width"], image["size"]["height"]) == (6, 4) and len(image["content"]) == 72
    raw = image_rows(tables.read_binary_files(spark, str(tmp_path))).first()
    assert raw["label"] == "daisy" and raw["size"]["width"] == 6 and bytes(raw["content"]) == _png(6, 4)


def test_delimited_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 0, 1), (2, 1, 0)], "SESSION int, ISCORRECT int, ISOLD int")
    df.coalesce(1).write.option("sep", "\t").option("header", True).csv(str(tmp_path / "t"))
    for schema in (None, "SESSION int, ISCORRECT int, ISOLD int"):
        assert sorted(map(tuple, tables.read_delimited(spark, str(tmp_path / "t"), schema).collect())) == [(1, 0, 1), (2, 1, 0)]


def test_tables_and_lineage(spark):
    calls = []
    builder = lambda: calls.append(1) or spark.range(3)
    assert sinks.ensure_table(spark, "made", builder) and not sinks.ensure_table(spark, "made", builder) and len(calls) == 1
    assert tables.read_table(spark, "made", limit=2, lineage_table="lineage").count() == 2
    row = spark.table("lineage").first()
    assert row["name"].startswith("read-made-") and row["source_table"] == "made" and row["properties"]["table"] == "made"
    sinks.overwrite_table(spark.range(5), "made")
    assert spark.table("made").count() == 5
    forecast = spark.sql("SELECT 'g' AS g, DATE '2024-01-01' AS ds, 1.5D AS yhat")
    sinks.append_forecast(forecast, "g", "forecasts")
    sinks.append_forecast(forecast, "g", "forecasts")
    assert spark.table("forecasts").dtypes == [("group_name", "string"), ("ds", "date"), ("yhat", "float")]
    assert spark.table("forecasts").count() == 2


def test_fallback_hides_only_missing_tables(spark, tmp_path):
    sinks.write_parquet(spark.range(4), str(tmp_path / "p"))
    assert tables.read_with_fallback(spark, "nowhere.made", str(tmp_path / "p")).count() == 4
    with pytest.raises(ZeroDivisionError):
        tables.read_with_fallback(spark, "nowhere.made", str(tmp_path / "p"), lambda df: 1 / 0)


def test_vectors_of_another_length_fail(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0],)], "v array<float>")
    assert tables.checked_vectors(df.limit(1), "v", 2).count() == 1
    with pytest.raises(Exception, match="expected 2 numbers"):
        tables.checked_vectors(df, "v", 2).collect()


def test_small_results_only(spark):
    assert len(sinks.to_driver(spark.range(5), 5)) == 5
    with pytest.raises(ValueError):
        sinks.to_driver(spark.range(6), 5)


def test_run_log(spark, tmp_path):
    results = spark.createDataFrame([("a", 0, {"lr": 0.1}, 2.0), ("a", 1, {"lr": 0.2}, 1.0)], "g string, trial_id int, params map<string,double>, value double")
    day = F.lit("2024-03-05").cast("date")
    runs = child_runs(results, "parent", group_run_name(["g"], day), "params", "rmse")
    log_runs(runs, "runs")
    best = child_runs(results.where("trial_id = 1"), "parent", group_run_name(["g"], day, best=True), "params", "rmse")
    log_runs(best, "runs")
    log = spark.table("runs")
    assert search_runs(log, "group_a_240305", {"parentRunId": "parent"}).count() == 2
    latest = search_runs(log, "BEST_group_", latest=True).first()
    assert latest["metrics"] == {"rmse": 1.0} and latest["params"] == {"lr": "0.2"} and latest["run_name"] == "BEST_group_a_240305"
    places = artifact_map(results.where("trial_id = 1").withColumn("run_id", F.lit("r1")), ["g"], "7")
    sinks.write_json_lines(places, str(tmp_path / "map"))
    lines = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "map")).collect()]
    assert lines == [{"group_id": "a", "experiment_id": "7", "local_run_model_path": "r1/best_model/model"}]
