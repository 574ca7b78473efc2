"""Template verdicts of the url filter on small trees, and its edge cases."""

import pytest

from lakestrata.llm import url_filter

SCHEMA = "page_id long, url string, bad boolean"


def verdicts(spark, rows):
    pages = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], SCHEMA)
    return url_filter.judge(pages, [], bad=pages["bad"]).orderBy("page_id").collect()


@pytest.fixture(scope="module")
def deep():
    """Two folders that part at the fifth segment; a small bad folder on a hot host; one on a host without labels."""
    rows = [(f"http://x.com/a/b/c/d/spam/{k}", True if k < 45 else None) for k in range(50)]
    rows += [(f"http://x.com/a/b/c/d/news/p{k}", False if k < 5 else None) for k in range(50)]
    rows += [(f"http://hot.com/dir{chr(97 + k % 20)}/x", False) for k in range(2000)]
    rows += [(f"http://hot.com/casino/{chr(97 + k)}", True if k < 21 else None) for k in range(26)]
    return rows + [(f"http://none.com/casino/{k}", None) for k in range(30)]


def test_templates_reject_at_any_depth_and_share(spark, deep):
    got = verdicts(spark, deep)
    for row in got:
        bad = "/spam/" in row.url or "hot.com/casino/" in row.url
        assert row.verdict == ("block" if bad else "allow"), row


def test_same_rates_stay_apart_where_labels_part_below(spark):
    rows = [(f"http://h.com/{a}/{b}/{k}", a == b if k < 20 else None) for a in "pq" for b in "pq" for k in range(30)]
    for row in verdicts(spark, rows):
        _, _, _, a, b, _ = row.url.split("/")
        assert row.verdict == ("block" if a == b else "allow")


def test_alike_segments_merge_and_few_labels_do_not_reject(spark):
    rows = [(f"http://h.com/{d}/{k}", d in "xyz") for d in "abcdefxyz" for k in range(12)]
    rows += [("http://h.com/a/last", None), ("http://two.com/s/1", True), ("http://two.com/s/2", None)]
    got = verdicts(spark, rows)
    assert {r.template for r in got if r.url.split("/")[3] in "xyz"} == {"/{+}"}
    assert {r.template for r in got if r.host == "h.com" and r.url.split("/")[3] in "abcdef"} == {"/{-}"}
    assert got[-1].verdict == "allow"


def test_odd_urls_tables_and_names(spark):
    long = "http://l.com/" + "/".join(f"s{chr(97 + k % 26)}" for k in range(3000))
    rows = [(None, True), ("", None), ("no host", False), ("http:///path", True), (long, None), (long, None)]
    got = verdicts(spark, rows)
    assert [r.verdict for r in got] == ["allow"] * 6 and [r.host for r in got] == [""] * 4 + ["l.com"] * 2
    empty = spark.createDataFrame([], SCHEMA)
    assert url_filter.judge(empty, [("block", "com/")]).count() == 0
    clash = spark.createDataFrame([("http://a.com/x", 1, 2, 3, 4, "t")],
                                  "url string, segments int, reject int, labelled int, seg int, template string")
    row = url_filter.judge(clash, [("block", "com/")]).first()
    assert (row.segments, row.reject, row.labelled, row.seg, row.verdict) == (1, 2, 3, 4, "block")
