"""Which class and id names are page furniture, and generated pages read by brute force."""

import random

import pytest

from kiln.llm import html_text


@pytest.fixture(scope="module")
def tree(spark):
    return html_text.train_tree(spark)


def both(tree, page):
    text = html_text.extract(page.replace("GOOD", "good words " * 15).replace("OTHER", "other words " * 15), tree)
    return "good words" in text, "other words" in text


@pytest.mark.parametrize("page", [
    '<main><p>GOOD</p><section id="comments" class="comments-area"><p>OTHER</p></section></main>',
    '<article><p>GOOD</p><section class="comments"><p>OTHER</p></section></article>',
    '<main><p>GOOD</p><article class="comment"><p>OTHER</p></article></main>',
    '<main><p>GOOD</p><section class="related"><p>OTHER</p></section></main>',
    '<article><p>GOOD</p><section class="advert"><p>OTHER</p></section></article>',
    '<article><p>GOOD</p><div class="relatedPosts"><p>OTHER</p></div></article>',
    '<main><article><p>GOOD</p></article><div id="post-comments"><p>OTHER</p></div></main>',
    '<div class="content"><p>GOOD</p><div class="newsletter-signup box"><p>OTHER</p></div></div>',
    '<main><p>GOOD</p><ol class="commentlist"><li>OTHER</li></ol></main>',
    '<p>GOOD</p><div class="global-nav"><p>OTHER</p></div>',
    '<p>GOOD</p><div class="footer-2024-legal"><p>OTHER</p></div>',
])
def test_furniture_goes(tree, page):
    assert both(tree, page) == (True, False)


@pytest.mark.parametrize("page", [
    '<article><p>GOOD</p><div class="market-share"><p>OTHER</p></div></article>',
    '<article><p>GOOD</p><div id="discussion"><p>OTHER</p></div></article>',
    '<article><p>GOOD</p><div id="related-work"><p>OTHER</p></div></article>',
    '<main class="site-main has-sidebar"><p>GOOD</p><p>OTHER</p></main>',
    '<article class="post category-social"><p>GOOD</p><section id="discussion"><p>OTHER</p></section></article>',
    '<main><article class="post comments-open"><p>GOOD</p><section id="menu-of-the-day"><p>OTHER</p></section></article></main>',
    '<article data-title="the hidden cost"><h2 id="search">GOOD</h2><p>OTHER</p></article>',
    '<p>GOOD</p><div class="market-share"><p>OTHER</p></div>',
])
def test_text_stays(tree, page):
    assert both(tree, page) == (True, True)


def test_short_paragraphs_without_a_main_element(tree):
    sizes = (5, 7, 6, 9, 4, 8)
    page = "<html><body>" + "".join(f"<p>{'word ' * n}</p>" for n in sizes) + "</body></html>"
    assert html_text.extract(page, tree) == "\n".join(" ".join(["word"] * n) for n in sizes)


def test_generated_pages(tree):
    """Pages put together from known text and known furniture, in any order and markup: the text comes back whole."""
    rng = random.Random(8)
    words = lambda n, w: " ".join(f"{w}{rng.randrange(99)}" for _ in range(n))
    wraps = ["<div>{}</div>", "<section>{}</section>", '<div class="row">{}</div>', "<blockquote>{}</blockquote>", "{}"]
    junk = ['<nav><a href="/">{}</a></nav>', "<footer><p>{}</p></footer>", '<div class="comments-area"><p>{}</p></div>',
            '<section class="related"><p>{}</p></section>', '<aside><p>{}</p></aside>', '<div class="ad-slot">{}</div>',
            "<script>var x = '{}';</script>", "<style>{}</style>", "<form><label>{}</label></form>", '<p hidden>{}</p>', "<!-- {} -->"]
    for k in range(120):
        holder = rng.choice(["article", "main", 'div class="entry-content"'])
        body, want = [], []
        for _ in range(rng.randint(1, 9)):
            if rng.random() < 0.35:
                body.append(rng.choice(junk).format(words(rng.randint(2, 40), "junk")))
            else:
                text = words(rng.choice([1, 3, 12, 40, 90]), "text")
                want.append(text.replace("text7 ", "text7 & "))
                tag = rng.choice(["p", "h2", "li", "div"])
                inner = text.replace("text7 ", "text7 &amp; ").replace(" ", rng.choice([" ", "\n  ", " <b>", "&#32;"]), 1)
                inner += "</b>" if "<b>" in inner else ""
                body.append(rng.choice(wraps).format(f"<{tag}>{inner}</{tag}>"))
        around = rng.choice(junk).format(words(20, "junk")), rng.choice(junk).format(words(30, "junk"))
        page = f"<html><head><title>junk</title></head><body>{around[0]}<{holder}>{''.join(body)}</{holder.split(' ')[0]}>{around[1]}</body></html>"
        assert html_text.extract(page, tree) == "\n".join(want), page
