"""Copies of a page under other URLs do not take its text away."""

import fixtures

from tallywatch.llm import html_text


def page(*own):
    return "".join(f"<div>{x}</div>" for x in ("Site name", *own, "Imprint and terms"))


def test_copies_under_url_variants_keep_their_text(spark):
    long = "a long paragraph that stands on this page alone and says a good deal more than the site"
    rows = [(i, f"http://h.org/a?utm_source={i}", page(long, "second"), "t", "p") for i in range(5)]
    rows += [(10, "http://h.org/b", page("other text"), "t", "p")]
    # two crawls that differ in one short line, on a host of their own
    text = " ".join([long, long, long, "end"])
    rows += [(20 + i, f"http://n.org/a?x={i}", page(text, f"day {i}"), "t", "p") for i in range(2)]
    # a page with an article is no other page's copy
    rows += [(30, "http://m.org/a", f"<article><p>{long}</p></article>", "t", "p")]
    found = html_text.extract_pages(fixtures.frame(spark, rows, fixtures.PAGES)).collect()
    texts = {r.page_id: r.text for r in found}
    assert len(found) == len(rows)
    assert [texts[i] for i in range(5)] == [f"{long}\nsecond"] * 5
    assert texts[10] == "other text" and texts[30] == long
    for i in range(2):
        assert text in texts[20 + i] and f"day {i}" in texts[20 + i]
