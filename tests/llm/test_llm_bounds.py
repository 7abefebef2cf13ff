"""What one task holds at a time does not grow with a group or with the number of queries."""

import numpy as np
import pytest

from trackloom.llm import hilbert


@pytest.mark.parametrize("kept", [1, 1 << 16])
def test_queries_of_a_block_come_in_tiles(spark, monkeypatch, kept):
    draw = np.random.default_rng(4)
    x = draw.normal(size=(700, 8))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    sizes = []
    plain = hilbert.best

    def watched(queries, *rest):
        sizes.append(len(queries))
        return plain(queries, *rest)

    import pyarrow as pa

    monkeypatch.setattr(hilbert, "best", watched)
    rows = [(0, b, i, q, x[i].tolist()) for b in (0, 1) for q in (False, True) for i in range(700) if q or i % 2 == b]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.float64())))]
    batch = pa.RecordBatch.from_arrays(columns, names=["curve", "block", "vec_id", "query", "vector"])
    batches = [batch.slice(i, 130) for i in range(0, batch.num_rows, 130)]
    found = [r for out in hilbert._search_rows(8, 5, 64, kept)(iter(batches)) for r in out.to_pylist()]
    assert max(sizes) <= 64
    scores = x @ x.T
    np.fill_diagonal(scores, -np.inf)
    for q in range(700):
        mine = sorted({(-r["score"], r["vec_id"]) for r in found if r["query_id"] == q})[:5]
        assert [v for _, v in mine] == np.argsort(-scores[q])[:5].tolist()
