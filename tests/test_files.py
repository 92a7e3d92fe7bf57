"""Readers and writers: what is written comes back."""

import json
import struct
import zlib

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import pixels, predict
from tessera.operators.tiling import TileSpec
from tessera.sources import coco, labels, records


def tables(spark):
    images = spark.createDataFrame([(1, "a.jpg", 100, 80), (2, "b.png", 50, 50)], "image_id long, file_name string, width int, height int")
    anns = spark.createDataFrame(
        [(10, 1, 1, 1.0, 2.0, 30.0, 40.0, [[1.0, 2.0, 31.0, 2.0, 31.0, 42.0]], 0.5), (11, 1, 2, 0.0, 0.0, 5.0, 5.0, [], None)],
        "ann_id long, image_id long, category_id int, x double, y double, w double, h double, segmentation array<array<double>>, score double",
    )
    cats = spark.createDataFrame([(1, "cat"), (2, "dog")], "category_id int, name string")
    return coco.CocoTables(images, anns, cats)


def test_coco_document_round_trip(spark, tmp_path):
    parts = tmp_path / "parts"
    coco.write_coco_document(tables(spark), str(parts))
    path = str(tmp_path / "coco.json")
    (tmp_path / "coco.json").write_text("".join(p.read_text() for p in sorted(parts.glob("part-*"))))
    doc = json.loads((tmp_path / "coco.json").read_text())
    assert [i["id"] for i in doc["images"]] == [1, 2] and len(doc["categories"]) == 2
    assert [a["id"] for a in doc["annotations"]] == [10, 11] and doc["licenses"] == [] and "score" not in doc["annotations"][1]
    assert doc["annotations"][0]["bbox"] == [1.0, 2.0, 30.0, 40.0] and doc["annotations"][0]["area"] == 1200.0
    back = coco.read_coco(spark, path)
    assert back.images.count() == 2 and back.categories.count() == 2
    row = back.annotations.orderBy("ann_id").first()
    assert (row["x"], row["h"], row["score"], row["segmentation"]) == (1.0, 40.0, 0.5, [[1.0, 2.0, 31.0, 2.0, 31.0, 42.0]])


def test_document_without_categories(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"images": [{"id": 1, "file_name": "a.jpg", "width": 1, "height": 1}], "annotations": []}))
    assert coco.read_coco(spark, str(tmp_path / "c.json")).categories.count() == 0


def test_coco_lines_and_metadata(spark, tmp_path):
    t = tables(spark)
    coco.write_coco_lines(t, str(tmp_path / "lines"))
    assert coco.read_coco_lines(spark, str(tmp_path / "lines")).annotations.count() == 2
    rows = {r["image_id"]: r["objects"] for r in records.metadata_records(t.images, t.annotations).collect()}
    assert rows[1]["id"] == [10, 11] and rows[1]["bbox"][0] == [1.0, 2.0, 30.0, 40.0] and rows[2]["id"] == []


def test_bucketed_tables_join_without_shuffle(spark):
    t = tables(spark)
    spark.sql("CREATE DATABASE IF NOT EXISTS vision")
    coco.save_tables(t, "vision", buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("vision.annotations").join(spark.table("vision.images"), "image_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and joined.count() == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP DATABASE vision CASCADE")


def test_yolo_and_voc_lines(spark, tmp_path):
    t = tables(spark)
    lines = records.yolo_detection_lines(t.annotations, t.images)
    labels.write_yolo_labels(lines, str(tmp_path / "yolo"))
    row = spark.read.parquet(str(tmp_path / "yolo")).first()
    assert row["label_file"] == "a.txt" and row["text"].split("\n")[0] == "1 0.16 0.275 0.3 0.5"
    voc = records.voc_result_lines(t.annotations.withColumnRenamed("ann_id", "det_id").filter("score IS NOT NULL"), t.images)
    labels.write_line_files(voc, str(tmp_path / "voc"), "category_id")
    back = labels.read_voc_results(spark, str(tmp_path / "voc")).first()
    assert (back["image_key"], back["score"], back["x1"], back["y2"]) == ("a", 0.5, 2.0, 43.0)


def test_voc_xml(spark, tmp_path):
    def obj(name, difficult, x):
        return (
            f"<object><name>{name}</name><pose>Left</pose><truncated>0</truncated><difficult>{difficult}</difficult>"
            f"<bndbox><xmin>{x}</xmin><ymin>2</ymin><xmax>30</xmax><ymax>40</ymax></bndbox></object>"
        )

    (tmp_path / "a.xml").write_text(
        f"<annotation><filename>a.jpg</filename><size><width>100</width><height>80</height><depth>3</depth></size>{obj('cat', 0, 5)}{obj('dog', 1, 7)}</annotation>"
    )
    rows = labels.read_voc_xml(spark, str(tmp_path)).orderBy("name").collect()
    assert [(r["name"], r["difficult"], r["xmin"]) for r in rows] == [("cat", False, 5), ("dog", True, 7)]
    train = labels.read_voc_xml(spark, str(tmp_path), training=True, keep_difficult=False).collect()
    assert [(r["name"], r["xmin"], r["ymax"]) for r in train] == [("cat", 4, 39)]


def test_metric_csv(spark, tmp_path):
    (tmp_path / "r.csv").write_text("   epoch,   loss,  map\n    0,   0.5,  0.1\n    1,   bad,  0.2\n")
    rows = labels.read_metric_csv(spark, str(tmp_path / "r.csv"), ["epoch", "loss", "map"]).collect()
    assert [tuple(r) for r in rows] == [(0.0, 0.5, 0.1), (1.0, None, 0.2)]


def png(pixels: np.ndarray) -> bytes:
    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    h, w, _ = pixels.shape
    raw = b"".join(b"\0" + pixels[i].tobytes() for i in range(h))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def test_images_from_files_to_tiles_and_crops(spark, tmp_path):
    picture = np.arange(5 * 7 * 3, dtype=np.uint8).reshape(5, 7, 3)
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.PNG").write_bytes(png(picture))
    (tmp_path / "note.txt").write_text("no image")
    assert [r["file_name"] for r in labels.scan_images(spark, str(tmp_path)).collect()] == ["a.PNG"]
    scanned = spark.read.format("image").option("recursiveFileLookup", True).option("pathGlobFilter", "*.PNG").load(str(tmp_path))
    rows = pixels.image_rows(scanned, F.lit(1).cast("long"))
    bgr = picture[:, :, ::-1]

    for mode in ("constant", "reflect", "edge", "wrap"):
        tiles = pixels.tile_pixels(rows, TileSpec(4, 4, mode=mode)).collect()
        assert len(tiles) == 4
        for t in tiles:
            cut = bgr[t["tile_y"] : t["tile_y"] + 4, t["tile_x"] : t["tile_x"] + 4]
            extra = {"constant_values": 114} if mode == "constant" else {}
            want = np.pad(cut, ((0, 4 - cut.shape[0]), (0, 4 - cut.shape[1]), (0, 0)), mode=mode, **extra)
            assert bytes(t["data"]) == want.tobytes()
    assert pixels.tile_pixels(rows, TileSpec(4, 4, mode="drop")).count() == 1

    boxes = spark.createDataFrame([(1, 1, 2.0, 1.0, 3.0, 2.0), (2, 1, 5.0, -1.0, 4.0, 3.0)], "ann_id long, image_id long, x double, y double, w double, h double")
    crops = {r["ann_id"]: np.frombuffer(r["data"], np.uint8).reshape(r["height"], r["width"], 3) for r in pixels.crop_pixels(rows, boxes).collect()}
    assert (crops[1] == bgr[1:3, 2:5]).all()
    assert (crops[2][1:, :2] == bgr[0:2, 5:7]).all() and not crops[2][0].any() and not crops[2][:, 2:].any()
    assert pixels.crop_pixels(rows, boxes, padded=True).first()["width"] == 7


def test_blank_tiles_are_skipped_and_warp_identity(spark):
    grey = spark.createDataFrame([(1, 4, 4, 1, bytes([114] * 16))], "image_id long, height int, width int, nChannels int, data binary")
    assert pixels.tile_pixels(grey, TileSpec(4, 4)).count() == 0
    a = np.arange(12, dtype=np.uint8).reshape(3, 4, 1)
    assert (pixels.warp_array(a, (1, 0, 0, 0, 1, 0), False, "none", 0.0, 0) == a).all()
    assert (pixels.warp_array(a, (1, 0, 0, 0, 1, 0), True, "none", 0.0, 0) == a[:, ::-1]).all()
    moved = pixels.warp_array(a, (1, 0, 1, 0, 1, 0), False, "none", 0.0, 0)
    assert (moved[:, 1:] == a[:, :-1]).all() and not moved[:, 0].any()


def test_square_is_rasterised_to_its_pixels():
    row, start, end = pixels.polygon_runs(np.array([[1.0, 2.0], [4.0, 2.0], [4.0, 5.0], [1.0, 5.0]]))
    assert row.tolist() == [2, 3, 4] and start.tolist() == [1, 1, 1] and end.tolist() == [4, 4, 4]


def test_failing_image_is_reported_and_skipped(spark):
    def model():
        def run(inputs):
            if any(v == "bad" for v in inputs):
                raise ValueError("cannot decode")
            return [[(0, 1, 0.5, 0.0, 0.0, 1.0, 1.0, None)] for _ in inputs]

        return run

    df = spark.createDataFrame([(i, "bad" if i == 3 else "ok") for i in range(6)], "image_id long, content string")
    rows = predict.batch_predict(df, model, batch_size=4).collect()
    assert {r["image_id"]: r["error"] for r in rows} == {0: None, 1: None, 2: None, 3: "cannot decode", 4: None, 5: None}
