from skyledger.llm import html_text


def test_elements_open_without_end(spark):
    text = "a paragraph of some words that go on for a while"
    for tag in ("div", "font", "b"):
        page = f"<html><body>{f'<{tag}>' * 6000}{text}"
        assert html_text.extract(page) in (text, "")
    pages = spark.createDataFrame([(1, "u", "<article><p>" + text + "<font>" * 5000 + text + "</article>"), (2, "u", None)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.main_texts(pages, html_text.DEFAULT_WEIGHTS).collect()}
    assert got[1] and got[2] == ""


P = "This is a long paragraph of the story with many plain words that goes on for quite a while and says things."
S = "A short closing paragraph here."
NAV = '<nav><ul><li><a href="/">Home</a></li><li><a href="/x">News</a></li></ul></nav>'
END = "<footer>(c) me</footer></body></html>"
ARTICLES = {
    f"<html><body>{NAV}<article>{''.join(f'<div><p>{P} {k}</p></div>' for k in range(12))}</article>{END}": [f"{P} {k}" for k in range(12)],
    f"<html><body>{NAV}<article><div class='row'><div class='col'><h1>The headline of it</h1><p>{P} lead</p></div></div><p>{P * 4}</p></article>{END}": ["The headline of it", f"{P} lead", P * 4],
    f"<html><body>{NAV}<article><h1>The headline of it</h1><p>{P * 3}</p><div class='ad'>buy our stuff now</div><p>{S}</p></article>{END}": ["The headline of it", P * 3, S],
    f"<html><body><div class='story'><p>{P} one</p><p>{P} two</p></div>{NAV}<div class='story'><p>{P} three</p></div>{END}": [f"{P} one", f"{P} two", f"{P} three"],
}


def test_articles_parted_by_tags_that_labelled_pages_have_beside_theirs(spark):
    pages = [r.html or "" for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").orderBy("page_id").collect()]
    weights = html_text.fit_weights(pages[:100])
    alone = html_text.Weights(weights.odds, weights.tags)
    for page, want in ARTICLES.items():
        assert html_text.extract(page, weights).split("\n") == want
        assert len(html_text.extract(page, alone).split("\n")) < len(want)  # the best region by itself is but a part
    # Pages like the labelled ones have nothing to add to their best region.
    assert all(html_text.extract(p, weights) == html_text.extract(p, alone) for p in pages[100:])


def test_kinds_of_blocks():
    events = html_text.parse("<p>one <b>two</b> three four <a>five</a></p><li><a>six</a> <a>seven</a></li><h2>x</h2><div>" + "w " * 100 + "</div><p> </p>")
    assert [kind for _, _, kind, _ in html_text.block_list(events)] == [("p", 1, False), ("li", 0, True), ("h", 0, False), ("", 4, False)]
