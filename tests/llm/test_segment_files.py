"""Files of an index hold each segment by itself."""

from __future__ import annotations

from pathlib import Path

import pyarrow.parquet as pq

from eventmart.llm import common, lexical_search


def test_a_row_group_holds_one_segment(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "SEGMENT_BYTES", 2_000)
    monkeypatch.setattr(common, "PIECE_BYTES", 500)
    monkeypatch.setattr(lexical_search, "pieces", lambda batches: common.pieces(batches, limit=500))
    docs = spark.range(400).selectExpr("id AS doc_id", "concat_ws(' ', 'lamp', id, id % 7, repeat('word ', 10)) AS text").coalesce(1)
    index = lexical_search.build_index(docs)
    files = [pq.ParquetFile(f).metadata for f in Path(index.stored_path).glob("*.parquet")]
    groups = [m.row_group(k).num_rows for m in files for k in range(m.num_row_groups)]
    assert len(groups) > 3 and set(groups) == {1}
    assert index.selectExpr("sum(documents)").first()[0] == 400
    common.discard(spark, index)
