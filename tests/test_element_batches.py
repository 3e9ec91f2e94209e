"""Elements of pages are handed on in small parts, whatever a batch or a page holds."""

import pyarrow as pa

from avisflow.operators import elements
from avisflow.plans import collect


def test_elements_leave_in_parts_and_none_is_lost():
    one = '<div class="jftiEf"><i class="d4r55">x</i></div>'
    pages = pa.RecordBatch.from_pydict({"page_id": pa.array([1, 2, None, 4], pa.int64()), "html": [one * 1000, None, one * 3, ""]})
    parts = list(elements._element_batches([pages, pages.slice(2, 1)], "page_id", collect.REVIEW_ELEMENTS, collect.REVIEW_FIELDS))
    assert max(p.num_rows for p in parts) <= elements.ROWS_AT_ONCE
    got = [(r["page_id"], r["position"]) for p in parts for r in p.to_pylist()]
    assert got == [(1, i) for i in range(1000)] + [(None, i) for i in range(3)] * 2
    assert parts[0].to_pylist()[0]["author"] == ["x", None, None]
