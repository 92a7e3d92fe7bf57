"""A model that returns too few lists loses no image."""

from tessera.operators.predict import batch_predict


def test_short_answers_become_error_rows(spark):
    images = spark.createDataFrame([(i, "x" if i % 2 else "lost") for i in range(8)], "image_id int, content string").coalesce(1)

    def make_model():
        return lambda inputs: [[(0, 1)] for x in inputs if x != "lost"]

    rows = batch_predict(images, make_model, schema="pos int, class_idx int").collect()
    assert {r["image_id"] for r in rows if r["error"] is None} == {1, 3, 5, 7}
    assert {r["image_id"] for r in rows if r["error"] is not None} == {0, 2, 4, 6}
