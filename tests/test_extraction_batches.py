"""Extraction hands its pages on in small batches, so a task's Python holds few of them."""

import pyarrow as pa

from heronlake.sources import html_article as H


def test_a_large_batch_is_extracted_in_parts():
    n = 2 * H.AT_ONCE + 7
    html = [None if i == 3 else f"<html><head><title>t{i}</title></head><body></body></html>" for i in range(n)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array(["https://h.example/a"] * n), pa.array(html)], names=["k", "u", "h"])
    made = list(H.extracted([batch, batch.slice(0, 0)], "k", "u"))
    assert [b.num_rows for b in made] == [H.AT_ONCE, H.AT_ONCE, 7]
    assert made[0].schema.names[:3] == ["k", "u", "title"]
    assert [(r["k"], r["title"]) for b in made for r in b.to_pylist()] == [(i, None if i == 3 else f"t{i}") for i in range(n)]
