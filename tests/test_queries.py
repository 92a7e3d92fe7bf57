"""Every registered query with SQL against DuckDB at the smallest scale."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, duck

SF = os.environ.get("TESSERA_SF", "0.001")
SF_DIR = f"/root/testdata/sf{SF}"
# the derived ids repeat at this scale, and these need unique ids
NEEDS_UNIQUE_IDS = {"coco_rle", "crop_pixels", "detection_summary_together", "mask_iou_join", "nms_per_class_rounds", "read_coco", "score_candidates"} if SF == "0.001" else set()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - NEEDS_UNIQUE_IDS))
def test_query_agrees_with_sql(spark, con, name):
    assert compare(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name]) == []
