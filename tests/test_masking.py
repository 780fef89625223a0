"""Masks follow tags and any held role."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lapwise.operators import masking


@pytest.fixture(scope="module")
def people(spark):
    frame = spark.createDataFrame(
        [(1, dt.date(1990, 5, 17)), (2, None)], "id int, born date")
    return masking.tag(frame, {"born": "PII"})


def test_mask_by_role(people):
    masks = {"PII": masking.mask_date}
    seen = masking.apply_masks(people, masks, {"analyst", "engineer"})
    hidden = masking.apply_masks(people, masks, {"analyst"})
    assert [r["born"] for r in seen.orderBy("id").collect()] == [dt.date(1990, 5, 17), None]
    assert [r["born"] for r in hidden.orderBy("id").collect()] == [dt.date(1990, 1, 1), None]
    # A filter on the masked column sees the masked value only.
    assert hidden.filter(F.col("born") == dt.date(1990, 5, 17)).count() == 0


def test_tags_survive_projection_and_masking(people):
    hidden = masking.apply_masks(people, {"PII": masking.mask_date}, ())
    assert masking.tagged_columns(hidden.select("born", "id")) == ["born"]
    with pytest.raises(ValueError):
        masking.tag(people, {"id": "SECRET"})
