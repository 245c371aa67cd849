"""Feeds parsed by columns against the parser of one feed at a time."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidewire.sources import feeds, feeds_xml

RSS = """<?xml version="1.0" encoding="utf-8"?><rss xmlns:content="http://purl.org/rss/1.0/modules/content/" xmlns:dc="http://x/dc"><channel><title>T</title>
<item><title>A &lt;b&gt;bold&lt;/b&gt; claim &amp;amp; more</title><link>https://e.com/1</link><pubDate>Wed, 02 Oct 2024 13:00:00 GMT</pubDate><description><![CDATA[<p>Hi &amp; you&nbsp;&#8217;s &#x41;</p>]]></description><content:encoded><![CDATA[<p>Long   text</p>]]></content:encoded></item>
<item><title>B</title><link>https://e.com/2</link><dc:date>2024-10-02T13:00:00+02:00</dc:date></item>
<item><title>no link</title></item><item><link>https://e.com/4</link></item><item><title> </title><link>https://e.com/5</link></item><item><title>bad link</title><link>javascript:x</link></item>
<item><title>C</title><link> https://e.com/6 </link><pubDate>nonsense</pubDate><dc:date>2024-10-02</dc:date><description></description></item>
<item><title>D</title><link>http://e.com/7</link><pubDate>2 Oct 24 7:05 -0330</pubDate></item><item><title>E</title><link>http://e.com/8</link><pubDate>Thu, 03 Oct 2024 01:02:03 EST</pubDate></item></channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><title>F</title><entry><title type="html">G &amp;lt;i&amp;gt; é</title><link rel="self" href="https://e.com/s"/><link href="https://e.com/9"/><updated>2024-10-02T13:00:00Z</updated><summary>S</summary><content type="html">&lt;p&gt;whole&lt;/p&gt;</content></entry>
<entry><title>H</title><link rel="alternate" href="https://e.com/10"/><published>2024-10-02T13:00:00.250</published></entry></feed>"""
RDF = """<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns="http://purl.org/rss/1.0/"><channel><title>c</title></channel><item><title>I</title><link>https://e.com/11</link></item></rdf:RDF>"""


@pytest.mark.parametrize("most", [50, 2])
def test_columns_equal_the_parser(spark, most):
    bodies = {"rss": RSS.encode(), "atom": ATOM.encode(), "rdf": RDF.encode(), "latin": '<?xml version="1.0" encoding="ISO-8859-1"?><rss><channel><item><title>é</title><link>https://e.com/x</link></item></channel></rss>'.encode("latin-1"), "none": b"<rss><channel/></rss>"}
    files = spark.createDataFrame([*bodies.items(), ("broken", b"<rss><channel><item>"), ("text", b"not xml"), ("null", None)], "source_id string, content binary")
    out = feeds_xml.feed_entries(files, most)
    want = sorted((s, at, url, title, when and when.replace(tzinfo=None), summary, content) for s, body in bodies.items() for at, url, title, when, summary, content in feeds.parse_feed(body, most))
    got = out.collect()
    assert sorted((r.source_id, r.entry, r.url, r.title, r.published_at, r.summary, r.content) for r in got if r.error is None) == want
    assert sorted(r.source_id for r in got if r.error) == ["broken", "text"]
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString() and "Pandas" not in out._jdf.queryExecution().executedPlan().toString()


def test_references_are_read_once(spark):
    texts = ["&amp;lt;", "&#x1F600;!", "a & b &unknown; &eacute;", "&#65;&#66;", "", None, "&amp"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.u for r in rows.select("i", feeds_xml.unescaped(F.col("t")).alias("u")).orderBy("i").collect()]
    assert got == ["&lt;", "\U0001f600!", "a & b &unknown; é", "AB", "", None, "&amp"]
