from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def documents(spark):
    """Rows of (doc_id, text, lang, source) as a frame with clashing extra columns."""

    def make(rows, kinds="doc_id long, text string, lang string, source string"):
        frame = spark.createDataFrame(rows, kinds)
        for name in ("n", "size", "fp", "word", "key", "rank", "_at", "node", "root", "h", "row", "target", "rate"):
            frame = frame.withColumn(name, frame[frame.columns[0]])
        return frame

    return make
