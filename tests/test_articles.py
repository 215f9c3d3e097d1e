from newsevents.operators.articles import attach_content, extract_articles


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_script_trap_and_unclosed_paragraphs(spark):  # M1
    html = ('<html><head><title>T &amp; U</title><script>var t="</p>";</script></head><body>'
            '<article><h1>Head</h1><p><b>First &lt;one&gt;<br><p>Second</p> <p>  </p></article></body></html>')
    r = extract_articles(pages(spark, [(1, "u", html)])).first()
    assert r.title == "T & U"
    assert r.paragraphs == ["First <one>", "Second"]
    assert r.content == "First <one>\n\nSecond"
    assert "var t" not in r.content


def test_long_article_kept_whole(spark):  # Q16
    text = "word " * 20000
    html = f"<html><body><article><p>{text}</p></article></body></html>"
    r = extract_articles(pages(spark, [(1, "u", html)])).first()
    assert len(r.content.encode()) > 65535 and r.content == text.strip()


def test_body_fallback_keeps_prose_only(spark):
    html = ("<html><body><p><a href='/x'>Home</a> <a href='/y'>News</a></p>"
            "<p>The cat sat on the mat and it was in the sun.</p><p>Buy now</p></body></html>")
    r = extract_articles(pages(spark, [(1, "u", html)])).first()
    assert r.paragraphs == ["The cat sat on the mat and it was in the sun."]


def test_attach_content_inner_and_failed_fetch(spark):  # J2, F2, Q15, Q28
    arts = extract_articles(pages(spark, [(1, "a", "<article><p>x</p></article>"), (2, "b", None),
                                          (3, "c", "<article></article>")]))
    events = spark.createDataFrame([(10, "a"), (11, "a"), (12, "b"), (13, "c"), (14, None), (15, "zz")],
                                   "cameo long, source_url string")
    got = sorted((r.cameo, r.content) for r in attach_content(events, arts).collect())
    assert got == [(10, "x"), (11, "x"), (13, "")]


def test_hot_url_cited_by_most_events(spark):  # a third of rows on one key, and more
    arts = extract_articles(pages(spark, [(1, "hot", "<article><p>big story</p></article>"),
                                          (2, "cold", "<article><p>small</p></article>")]))
    rows = [(i, "hot") for i in range(3000)] + [(10_000 + i, "cold") for i in range(10)]
    events = spark.createDataFrame(rows, "cameo long, source_url string").repartition(7)
    got = attach_content(events, arts).groupBy("content").count().collect()
    assert {r["content"]: r["count"] for r in got} == {"big story": 3000, "small": 10}


def paragraphs(spark, html):
    return extract_articles(pages(spark, [(1, "u", html)])).first().paragraphs


def test_character_references(spark):
    got = paragraphs(spark, "<article><p>&#8217; &rsquo; &mdash; &#x27; &#x1F600; &amp;lt; &nosuch; &#0; &#xD800; &AMP; a&nbsp;b & c &#99999999; &eacute;")
    assert got == ["\u2019 \u2019 \u2014 ' \U0001F600 &lt; &nosuch; \ufffd \ufffd & a b & c &#99999999; \u00e9"]


def test_several_nested_and_open_articles(spark):
    assert paragraphs(spark, "<article><p>one</p></article><p>between</p><ARTICLE class=x><p>two</p></ARTICLE>") == ["one", "two"]
    assert paragraphs(spark, "<article><p>a</p><article><p>b</p></article><p>c</p></article><p>d</p>") == ["a", "b", "c"]
    assert paragraphs(spark, "<article><p>open<p>to the end") == ["open", "to the end"]
    assert paragraphs(spark, "</article><article><p>x</p></article></article>") == ["x"]


def test_open_noise_runs_to_the_end(spark):
    assert paragraphs(spark, "<article><p>kept</p><script>var a = '<p>no</p>'") == ["kept"]
    assert paragraphs(spark, "<article><p>kept</p><!-- <p>no</p>") == ["kept"]
    assert paragraphs(spark, "<p>no article</p>") == []


def test_refetched_url_counts_once(spark):
    arts = extract_articles(pages(spark, [(1, "a", "<article><p>old</p></article>"), (7, "a", "<article><p>new</p></article>"),
                                          (3, "a", "<article><p>mid</p></article>"), (9, "a", None)]))
    events = spark.createDataFrame([(10, "a"), (10, "a")], "cameo long, source_url string")
    assert [(r.cameo, r.content) for r in attach_content(events, arts).collect()] == [(10, "new")] * 2


def test_a_megabyte_of_open_tags(spark):  # linear in the page, whatever is left open
    units = ["<", "<p ", "<p", "<article ", "<script ", "<title>", "<title", "<body ", "<!-- ", "&", "&a", "<p>", "</p>", "<a href=", "<article>", "<div><p>", "<style>x"]
    rows = [(i, "u", u * (1_000_000 // len(u))) for i, u in enumerate(units)]
    rows.append((99, "u", "<title>a <b>x</b> &lt;</title><article><p>1 < 2 and <i>3</i></p></article>"))
    got = {r.page_id: r for r in extract_articles(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).select("page_id", "title", "paragraphs").collect()}
    assert len(got) == len(rows) and got[99].title == "a x <" and got[99].paragraphs == ["1 < 2 and 3"]
