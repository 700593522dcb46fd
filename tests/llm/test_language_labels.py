"""Too many labels raise before counts are collected."""

import pytest
from pyspark.sql import DataFrame

from incidentlake.llm.language_id import fit


def test_labels_are_counted_before_anything_is_collected(spark, monkeypatch):
    def collected(self):
        raise AssertionError("counts were collected")

    docs = spark.range(40).selectExpr("concat('text ', id) as text", "concat('l', id) as lang")
    assert len(fit(docs, max_languages=40)["languages"]) == 40
    monkeypatch.setattr(type(docs), "toArrow", collected)
    monkeypatch.setattr(DataFrame, "toArrow", collected)
    with pytest.raises(ValueError):
        fit(docs, max_languages=39)
