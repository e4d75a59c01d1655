"""Named references beyond the common ones, and links in every form of quotes."""

import html

from pyspark.sql import functions as F

from shelfcast.llm import warc


def test_all_names_of_the_html_table(spark):
    text = "caf&eacute; &uuml;ber Stra&szlig;e &Eacute; &NotEqualTilde; &amp;eacute; &nope; &AMP; R&D; a & b &#233;"
    row = spark.range(1).select(warc.decode_entities(F.lit(text)).alias("t")).first()
    assert row.t == html.unescape(text)


def test_links_without_quotes_and_with_the_other_quote(spark):
    page = """<a href=/a>1</a> <a class=x href=/b?q=1 id=y>2</a> <a href="/it's">3</a> <a href='/say"x"'>4</a>
      <A HREF = "/c">5</A> <a href=''>6</a>"""
    pages = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
    rows = warc.derive_records(warc.page_responses(pages, warc.DATE)).where("warc_type = 'metadata'").collect()
    links = [x.removeprefix("outlink: ") for x in rows[0].block.split("\r\n") if x.startswith("outlink: ")]
    assert links == ["/a", "/b?q=1", "/it's", '/say"x"', "/c", ""]
