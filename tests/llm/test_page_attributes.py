"""Elements are site parts by their own attributes only."""

import pytest

from tallywatch.llm import html_text

KEPT = [
    '<p><a href="/hidden/x">word</a></p>', '<p title="The hidden truth">word</p>',
    '<p data-hidden="false">word</p>', '<p><a href="/p?id=nav">word</a></p>',
    "<p title='a class=\"menu\" here'>word</p>", '<p data-role="navigation">word</p>',
    '<div class="entry-content has-sidebar">word</div>', '<div class="no-sidebar">word</div>',
    '<div class="overflow-hidden">word</div>',
]
GONE = [
    '<p hidden>word</p>', '<p hidden="">word</p>', '<p HIDDEN=hidden>word</p>',
    "<p aria-hidden='true'>word</p>", '<div class="left-sidebar">word</div>', '<p id=nav>word</p>',
    '<p data-x="1" class="promo">word</p>', '<div class="hidden">word</div>',
    '<p style="display: none">word</p>', '<div role="navigation">word</div>',
]


@pytest.mark.parametrize("part", KEPT)
def test_values_of_other_attributes_do_not_hide(part):
    assert html_text.main_text(f"<article><p>a</p>{part}<p>b</p></article>", []) == "a\nword\nb"


@pytest.mark.parametrize("part", GONE)
def test_own_attributes_hide(part):
    assert html_text.main_text(f"<article><p>a</p>{part}<p>b</p></article>", []) == "a\nb"


@pytest.mark.parametrize("begin", [
    '<article class="post comments-open">', '<article id="post-notice-2024">',
    '<main class="page no-sidebar">', '<div role="main" class="has-menu">',
    '<article class="category-social category-login">'])
def test_an_article_is_not_the_site_by_parts_of_its_names(begin):
    page = f"<nav>menu</nav>{begin}<p>text</p></article></main></div><footer>end</footer>"
    assert html_text.main_text(page, []) == "text"


@pytest.mark.parametrize("part, kept", [
    ('<div class="social-science">word</div>', True), ('<section id="login-flow">word</section>', True),
    ('<div class="comment-free-zone">word</div>', True), ('<div id="ad-astra">word</div>', True),
    ('<div class="notice-period">word</div>', True), ('<div class="share-price">word</div>', True),
    ('<div class="related-posts">word</div>', False), ('<div class="ad-slot-300x250">word</div>', False),
    ('<div class="social share-buttons">word</div>', False), ('<div id="site-footer">word</div>', False),
    ('<div class="cookie-banner">word</div>', False), ('<ul class="comment-list"><li>word</ul>', False),
])
def test_names_of_several_words(part, kept):
    page = f"<article><p>a</p>{part}<p>b</p></article>"
    assert html_text.main_text(page, []) == ("a\nword\nb" if kept else "a\nb")


@pytest.mark.parametrize("part", [
    '<section class="comments"><article>Nice post!</article></section>',
    '<aside><article>Related card</article></aside>',
    '<article class="comment"><p>I agree.</p></article>',
    '<footer><div><article>Old news</article></div></footer>',
    '<div id="comments"><article><article>Nested reply</article></article></div>',
])
def test_articles_of_site_parts_are_not_the_text(part):
    for page in (f"<article><p>text</p></article>{part}", f"<article><p>text</p>{part}</article>",
                 f"{part}<main><p>text</p></main>"):
        assert html_text.main_text(page, []) == "text"


def test_an_article_after_a_part_that_was_never_closed():
    page = "<nav><ul><li>menu<article><p>text</p></article><footer>end</footer>"
    assert html_text.main_text(page, []) == "text"
    # closed by its parent only, which is no end of its own
    page = "<div><nav><p>menu</div><article><p>text</p></article>"
    assert html_text.main_text(page, []) == "text"


def test_an_article_in_a_closed_part_is_better_than_no_text():
    page = '<div class="header-wrapper"><nav>menu</nav><article><p>text</p></article></div>'
    assert html_text.main_text(page, []) == "text"
    assert html_text.main_text("<nav>menu</nav><footer>end</footer>", []) == ""
