import json
from collections.abc import Sequence

import pytest


@pytest.fixture
def frame(spark):
    """Rows as a DataFrame that was read from Parquet, as the operators get it."""
    def make(rows: Sequence[tuple], schema: str, tmp):
        path = str(tmp / "rows")
        spark.createDataFrame(list(rows), schema).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)
    return make


@pytest.fixture
def docs(frame, tmp_path):
    def make(texts, extra: str = "", values: tuple = ()):
        rows = [(i, t, *values) for i, t in (texts.items() if isinstance(texts, dict) else enumerate(texts) if not texts or not isinstance(texts[0], tuple) else texts)]
        return frame(rows, "doc_id long, text string" + (f", {extra}" if extra else ""), tmp_path)
    return make
