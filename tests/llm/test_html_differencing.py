"""Differencing decides structured pages, too."""

from citylens.llm import op10_html

PROMO = "<div class='content'><p>we are the site and this long text of ours stands on every page of it</p><p>call us</p></div>"


def texts(spark, rows):
    out = op10_html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return {r.page_id: r.text for r in out}


def test_a_repeated_container_is_not_the_main_text(spark):
    page = "<body>{}<article><p>{}</p></article></body>"
    rows = [(i, f"http://h.org/{i}", page.format(PROMO, f"story {i} told in some words of its own")) for i in range(4)]
    # alone in its host nothing tells that the container repeats: the kind with most text
    rows += [(9, "http://alone.org/", page.format(PROMO, "story 9"))]
    rows += [(20 + i, f"http://twice.org/{i}", page.format(PROMO, f"long {i} " + "word " * 30)) for i in range(2)] * 2        # repeated rows
    got = texts(spark, rows)
    assert {i: got[i] for i in range(4)} == {i: f"story {i} told in some words of its own" for i in range(4)}
    assert got[9].startswith("we are the site") and got[20].startswith("long 0") and got[21].startswith("long 1")


def test_shared_lines_of_an_article_stay(spark):
    page = "<body><article><p>a story that two pages carry</p><p>{}</p></article><p>footer words</p></body>"
    rows = [(i, f"http://h.org/{i}", page.format(f"end {i} of some length that is not shared")) for i in range(3)]
    assert texts(spark, rows) == {i: f"a story that two pages carry\nend {i} of some length that is not shared" for i in range(3)}


def test_lines_with_equal_hashes_and_texts_align_alike():
    mine, other = ["a", "bb", "ccc", "bb"], ["bb", "x", "ccc"]
    pairs = [[(hash(x), len(x)) for x in lines] for lines in (mine, other)]
    assert op10_html.shared(*pairs) == op10_html.shared(mine, other)
    assert op10_html.near_copies(*pairs) == op10_html.near_copies(mine, other)
    assert op10_html._main_place(pairs[0], [1, 3, 1, 3], {2}) == op10_html._main_place(mine, [1, 3, 1, 3], {2}) == op10_html.ARTICLE
