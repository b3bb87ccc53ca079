"""Feeds of each format, and polls that give every entry once."""

import datetime as dt

import pytest

from tessera.sources import feeds as FD

RSS = """<?xml version="1.0"?><rss version="2.0" xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><title>c</title>
<item><title>One &amp; two</title><link>http://a/1</link><guid>g1</guid><pubDate>Tue, 02 Jan 2024 03:04:05 +0100</pubDate><description><![CDATA[<b>x</b>]]></description></item>
<item><title>No guid</title><link>http://a/2</link><dc:date>2024-01-03T00:00:00Z</dc:date></item>
<item><title>Nothing else</title></item></channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><title>f</title><entry><id>urn:1</id><title>A</title><link rel="self" href="s"/><link href="http://b/1"/>
<updated>2024-05-05T10:00:00+02:00</updated><summary>sum</summary></entry><entry><id>urn:2</id><title type="html">B <b>b</b></title><published>nonsense</published></entry></feed>"""
RSS1 = """<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns="http://purl.org/rss/1.0/"><channel rdf:about="c"/><item rdf:about="http://c/1"><title>C</title><link>http://c/l</link></item></rdf:RDF>"""
UTC = dt.UTC


def test_rss():
    fmt, e = FD.parse_feed(RSS.encode())
    assert fmt == "rss" and [x["entry_id"] for x in e[:2]] == ["g1", "http://a/2"] and len(e[2]["entry_id"]) == 64
    assert e[0] == {"entry_id": "g1", "title": "One & two", "link": "http://a/1", "published": dt.datetime(2024, 1, 2, 2, 4, 5, tzinfo=UTC), "summary": "<b>x</b>"}
    assert e[1]["published"] == dt.datetime(2024, 1, 3, tzinfo=UTC) and e[2]["published"] is None


def test_atom_and_rss1():
    fmt, e = FD.parse_feed(ATOM.encode())
    assert fmt == "atom" and [(x["entry_id"], x["title"], x["link"], x["summary"]) for x in e] == [("urn:1", "A", "http://b/1", "sum"), ("urn:2", "B b", None, None)]
    assert e[0]["published"] == dt.datetime(2024, 5, 5, 8, tzinfo=UTC) and e[1]["published"] is None
    fmt, e = FD.parse_feed(RSS1.encode())
    assert fmt == "rss1" and (e[0]["entry_id"], e[0]["link"]) == ("http://c/1", "http://c/l")


@pytest.mark.parametrize("bad", ["", "<rss><channel>", "plain", "<html/>"])
def test_no_feed(bad):
    with pytest.raises(ValueError):
        FD.parse_feed(bad.encode())


def test_polls(spark, tmp_path):
    folder, target, ckpt = (str(tmp_path / x) for x in ("in", "out", "ckpt"))

    def land(feed, poll, text):
        p = tmp_path / "in" / f"feed={feed}" / f"poll={poll}"
        p.mkdir(parents=True)
        (p / "answer.xml").write_text(text)

    poll = lambda: sorted((r["feed"], r["poll"], r["position"], r["entry_id"][:9]) for r in FD.new_entries(spark, folder, target, ckpt).collect())
    item = lambda *keys: "<rss><channel>" + "".join(f"<item><guid>{k}</guid></item>" for k in keys) + "</channel></rss>"
    land("a", 1, item("k2", "k1"))
    land("b", 1, ATOM)
    assert poll() == [("a", 1, 0, "k2"), ("a", 1, 1, "k1"), ("b", 1, 0, "urn:1"), ("b", 1, 1, "urn:2")]
    assert poll() == []  # nothing has landed
    land("a", 2, item("k3", "k2"))
    land("a", 3, item("k4", "k3"))
    land("b", 2, "<broken")
    land("c%20x", 1, item("k1"))
    assert poll() == [("a", 2, 0, "k3"), ("a", 3, 0, "k4"), ("c x", 1, 0, "k1")]
    bad = FD.FeedReader(folder)
    rows = [r for p in bad.partitions({"a": 3, "b": 1, "c%20x": 1}, bad.latestOffset()) for r in bad.read(p)]
    assert len(rows) == 1 and rows[0][0] == "b" and "not XML" in rows[0][-1]


def test_many_feeds_share_partitions(tmp_path, monkeypatch):
    for i in range(50):
        p = tmp_path / f"feed=f{i:02d}" / "poll=1"
        p.mkdir(parents=True)
        (p / "a.xml").write_text(f"<rss><channel><item><guid>k{i}</guid></item></channel></rss>")
    r = FD.FeedReader(str(tmp_path))
    assert len(r.partitions({}, r.latestOffset())) == 1
    monkeypatch.setattr(FD, "PARTITION_POLLS", 20)
    parts = r.partitions({"f03": 1}, r.latestOffset())  # one feed is read already
    assert [len(p.polls) for p in parts] == [20, 20, 9]
    assert sorted((x[0], x[1], x[2], x[4]) for p in parts for x in r.read(p)) == [(f"f{i:02d}", 1, 0, f"k{i}") for i in range(50) if i != 3]
    monkeypatch.setattr(FD, "PARTITION_BYTES", 150)
    assert max(len(p.polls) for p in r.partitions({}, r.latestOffset())) == 2  # 62 bytes each
    assert [list(r.read(p)) for p in r.partitions(r.latestOffset(), r.latestOffset())] == [[]]


def test_land(spark, tmp_path):
    rows = [("a b/c", 1, "<rss><channel><item><guid>k</guid></item></channel></rss>"), ("d", 3, ATOM), (None, 1, None)]
    for _ in range(2):  # a repeated task writes the same files
        FD.land(spark.createDataFrame(rows, "feed string, poll int, document string"), str(tmp_path / "in"))
    r = FD.FeedReader(str(tmp_path / "in"))
    assert r.latestOffset() == {"a%20b%2Fc": 1, "d": 3, FD.NO_NAME: 1}
    got = sorted((x[0], x[1], x[4]) for p in r.partitions({}, r.latestOffset()) for x in r.read(p))
    assert got == [("a b/c", 1, "k"), ("d", 3, "urn:1"), ("d", 3, "urn:2")]
    assert not [p for p in (tmp_path / "in").rglob(".*")]
