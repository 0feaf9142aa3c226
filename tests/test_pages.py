"""The paged source: every page once, over stops, restarts and pages that are fetched late."""

import json

import pytest

from quillmill.sources.pages import PageReader
from quillmill.streaming import index


def page(root, query, cursor, items, after=None):
    (root / query).mkdir(parents=True, exist_ok=True)
    (root / query / f"{cursor}.json").write_text(json.dumps({"items": items, "cursor": after} if after else {"items": items}))


def test_every_page_once(spark, tmp_path):
    root, where = tmp_path / "pages", [str(tmp_path / x) for x in ("out", "check")]
    run = lambda: index.collect_pages(spark, str(root), *where).awaitTermination()
    seen = lambda: sorted((r.query, r.cursor, r.identifier) for r in spark.read.parquet(where[0]).collect())
    page(root, "q1", "start", [{"identifier": "a", "isbn": "0306406152; 9780306406157"}], "c1")
    page(root, "q1", "c2", [{"identifier": "c", "isbn": []}, {"identifier": "a", "isbn": ["9780306406157"]}])
    run()
    assert seen() == [("q1", "start", "a")]  # the page between them is not there yet
    run()
    assert len(seen()) == 1
    page(root, "q1", "c1", [{"identifier": "b", "isbn": ["junk", "9780306406157"]}], "c2")
    page(root, "q2", "start", [{"identifier": "d"}])
    run()
    want = [("q1", "c1", "b"), ("q1", "c2", "a"), ("q1", "c2", "c"), ("q1", "start", "a"), ("q2", "start", "d")]
    assert seen() == want
    run()
    assert seen() == want and [(r.isbn, r.ids) for r in index.collected_index(spark, where[0]).collect()] == [("9780306406157", ["a", "b"])]


def test_offsets(tmp_path):
    reader = PageReader({"path": str(tmp_path / "none")})
    assert reader.latestOffset() == reader.initialOffset() == {}
    for cursor, after in (("start", "c1"), ("c1", "c2"), ("c2", None)):
        page(tmp_path, "q", cursor, [{"identifier": cursor}], after)
    reader = PageReader({"path": f"file://{tmp_path}"})
    assert reader.latestOffset() == {"q": ""}
    assert [p.cursor for p in reader.partitions({"q": "c1"}, {"q": "c2"})] == ["c1"] and [p.cursor for p in reader.partitions({}, {"q": ""})] == ["start", "c1", "c2"]
    assert reader.partitions({"q": ""}, {"q": ""}) == []
    page(tmp_path, "loop", "start", [], "x")
    page(tmp_path, "loop", "x", [], "start")
    with pytest.raises(ValueError, match="back to itself"):
        PageReader({"path": str(tmp_path)}).latestOffset()
