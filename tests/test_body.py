from newsevents.functions.body import scored_paragraphs
from newsevents.operators.articles import extract_articles

LONG = "The cat sat on the mat and it was in the sun for the day, but not as long as that."
MORE = "There was a dog with it, and they were at the house of the man who is in this story."


def test_navigation_and_links_are_out():
    html = f"""<nav><ul><li><p><a href=x>The home of the news and the weather that is on</a></p></ul></nav>
    <div id=main><h1>Head</h1><p>{LONG}<p>{MORE}</p><p><a href=a>More of the same</a> <a href=b>and the rest of it</a></p></div>
    <footer><p>This is the end of the page, and it was made by us for you.</p></footer>"""
    assert scored_paragraphs(html) == [LONG, MORE]


def test_best_block_wins_and_neighbours_stay():
    html = f"""<div><div><p>{LONG}</p><p>"No!"</p><p>{MORE}</p><p>He left.</p><p>Buy now</p></div>
    <div><p>Read this too, if it is not late.</p></div></div><div><p>Ads are a part of the web.</p></div>"""
    # a line between prose stays, and a sentence near it; a label behind it does not; prose beside the block does
    assert scored_paragraphs(html) == [LONG, '"No!"', MORE, "He left.", "Read this too, if it is not late."]


def test_sections_of_one_article():
    html = f"<div><section><p>{LONG}</p></section><section><p>{MORE}</p></section></div><div><p>It is by the way.</p></div>"
    assert scored_paragraphs(html) == [LONG, MORE]


def test_other_languages():
    html = "<div><p>Kurz.</p></div><div><p>Der Hund ist mit der Katze auf dem Dach und sie sind nicht allein.</p></div><div><p><a>Ein</a></p></div>"
    assert scored_paragraphs(html) == ["Der Hund ist mit der Katze auf dem Dach und sie sind nicht allein."]


def test_broken_markup():
    assert scored_paragraphs(f"</div></p><div><p>{LONG}<div><p>{MORE}</p></table>") == [LONG, MORE]
    assert scored_paragraphs(f"<td>{LONG}<p>{MORE}</td><td>") == [LONG, MORE]
    assert scored_paragraphs("<pre>" + LONG) == [LONG]
    assert scored_paragraphs("") == scored_paragraphs(None) == scored_paragraphs("<div>no paragraph</div>") == []
    assert scored_paragraphs("<div>" * 50_000 + f"<p>{LONG}</p>" + "</div>" * 50_000 + "</p>" * 50_000) == [LONG]
    assert len(scored_paragraphs(f"<p>{LONG}" * 20_000)) == 20_000


def test_through_spark(spark):
    page = f"<html><head><title>T</title><script>'<p>'</script></head><body><div><p>{LONG} &amp;<p><b>{MORE}</div></body></html>"
    rows = [(1, "u", page), (2, "v", page.replace("<div>", "<article>").replace("</div>", "</article>")), (3, "w", None), (4, "x", "")]
    got = {r.page_id: r for r in extract_articles(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1].paragraphs == got[2].paragraphs == [LONG + " &", MORE] and got[1].title == "T"
    assert got[3].content is None and got[3].paragraphs == [] and got[4].content == ""
