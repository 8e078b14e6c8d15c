"""Copies of a page without article markup keep their text."""

from geoloom.llm import html_extract


def test_copies_of_a_page_do_not_blank_each_other(spark):
    page = lambda *own: "<html><body><div>Our site</div>" + "".join(f"<p>{x}</p>" for x in own) + "<div>All rights</div></body></html>"
    rows = [
        (1, "http://a/news/one?x=1", page("first text", "and more")),
        (2, "http://a/news/one?x=2", page("first text", "and more")),
        (3, "http://a/news/two", page("second text")),
        (4, "http://b/only?x=1", page("third text")),
        (5, "http://b/only?x=2", page("third text")),
    ]
    found = {r.page_id: r.text for r in html_extract.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert "first text\nand more" in found[1] and found[2] == "first text\nand more" and found[3] == "second text"
    assert "third text" in found[4] and "third text" in found[5]
