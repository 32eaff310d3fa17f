import random

import pytest

from newsflow.llm.html_text import _kinds, _unseen, count_tokens, extract, extract_text, learn_weights, region, set_apart, tokens
from newsflow.llm.queries import labelled_pages

WORDS = "word " * 60


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("<nav>a b c", ""),
        ("plain &lt;text&gt; &amp; more", "plain <text> & more"),
        ("<p>one<b>two</b>\n three&nbsp;four<br>five</p>", "onetwo three four five"),
        ('<p>only</p><script>var x = "</p><p>no";</script><style>p{}</style><p>end</p>', "only end"),
        ('<body><nav>menu here</nav><article><h1>T</h1><p>a b</p><ul><li>c</li></ul><div class="ad">buy</div><p>d</p></article><footer>f</footer>', "T a b c d"),
        ('<article><header><h2>Head</h2></header><p>a</p><form>f</form><section id="comments"><p>nice</p></section></article>', "Head a"),
        ('<div class="cookie-notice">n</div><header>site</header><main><p>a</p><aside>s</aside></main>', "a"),
        ('<article class="comment"><p>c</p></article><article><p>a b</p></article>', "a b"),
        ('<p class="ad">bad<p>good words', "good words"),
        ('<div class="content with-sidebar"><p>a b</p><div class="sponsored-content">s</div><p>c d</p></div>', "a b c d"),
        ("<article><p>a</p><!-- hidden <p>x</p> --><p>b</p></article>", "a b"),
        ("<article><p>a &#x41; &unknown; &copy 1</p>", "a A &unknown; © 1"),
        ('<article><p title="x > y">a</p><p>b <', "a b <"),
        ("<nav><a>m</a><article><p>a b c</p></article>", "a b c"),
    ],
)
def test_pages(page, text):
    assert extract(page, {}) == text


def test_region_leaves_link_lists_out():
    menu = "".join(f"<div><a href='/{k}'>link {k}</a></div>" for k in range(30))
    assert extract(f"<body>{menu}<div><p>{WORDS}</p><p>{WORDS}</p></div>{menu}", {}) == " ".join((WORDS * 2).split())


def test_weights_have_their_signs(spark):
    pages = spark.createDataFrame([(f"<html><body><div>x y</div><p>{WORDS}{k}</p><p>{k}{WORDS}</p></body></html>", f"{WORDS}{k} {k}{WORDS}") for k in range(5)] + [(None, None), ("<p>a", "b")], "html string, text string")
    weights = learn_weights(pages)
    assert weights[""] > 0 and all(w < 0 for kind, w in weights.items() if kind) and weights["div"] < weights.get("p", 0)


def test_kinds_are_of_two_pages_and_not_cut(spark):
    """A kind that one page shows in both places is a kind of one page; more than a thousand kinds stay."""
    many = "".join(f"<x{k}>" for k in range(1100))
    twice = "<once></once>"
    rows = [(f"{many}{twice if k == 0 else ''}<p>{WORDS}{k}</p>{twice if k == 0 else ''}{many}<p>{k}{WORDS}</p>", f"{WORDS}{k} {k}{WORDS}") for k in range(2)]
    weights = learn_weights(spark.createDataFrame(rows, "html string, text string"))
    assert all(f"x{k}" in weights for k in range(1100)) and "once" not in weights


@pytest.mark.parametrize("seed", range(30))
def test_region_has_the_greatest_sum(seed):
    """Against all pairs of borders."""
    draw = random.Random(seed)
    names = ["p", "div", "li", "a", "b", "nav", "article", "br"]
    pieces = [f"<{draw.choice(('', '/'))}{draw.choice(names)}>" if draw.random() < 0.6 else "word " * draw.randint(1, 6) for _ in range(draw.randint(0, 60))]
    weights = {"": draw.uniform(0.1, 2)} | {name: -draw.uniform(0.05, 4) for name in draw.sample(names, 4)}
    page = tokens("".join(pieces))
    set_apart(page)
    worth = []
    for token, (place, tag) in zip(page, _kinds(page), strict=True):
        one = weights.get(place + tag, _unseen(place, tag))
        worth.append(0.0 if token.apart else one if tag else one * len(token.text.split()))
    best = max((sum(worth[i:j]) for i in range(len(worth)) for j in range(i + 1, len(worth) + 1)), default=0.0)
    start, end = region(page, weights)
    assert sum(worth[start:end]) == pytest.approx(max(best, 0.0))


def test_labels_need_text():
    assert not count_tokens("<p>short</p>", "short") and count_tokens(f"<p>{WORDS}</p>", WORDS)


def test_awkward_rows(spark):
    rows = [(1, "u", "<p>a</p>", "c"), (1, "u", "<p>a</p>", "c"), (None, None, None, None), (2, None, "<p>" + "word " * 300_000, "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((str(r.page_id), r.n_chars) for r in extract_text(pages).collect())
    assert got == [("1", 1), ("1", 1), ("2", 5 * 300_000 - 1), ("None", 0)]
    assert extract_text(pages.filter("false")).collect() == []


def test_pages_hold_their_documents(spark):
    """Held-out check: text learned from some pages is the article of the others."""
    folder = "/root/testdata/sf0.001"
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    got = {r.page_id: r.text for r in extract_text(pages, labelled_pages(spark, folder, 20)).collect()}
    for row in pages.collect():
        article = row.html.split("<article>")[1].split("</article>")[0]
        assert extract(f"<article>{article}</article>", {}) == got[row.page_id]


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<article class='post tag-social'><p>a b</p></article>", "a b"),
        ("<main class='content comments-open'><p>a b</p></main>", "a b"),
        ("<div id='page' class='has-ads'><p>a b</p></div>", "a b"),
        ("<div id='page' class='has-ads'><nav>m</nav><article><p>a b</p><div class='ad-box'>buy</div></article></div>", "a b"),
        ("<header>site</header><div class='has-ads'><h1>T U V W X Y</h1><p>a b c d</p></div><p>e f g h</p>", "T U V W X Y a b c d e f g h"),
        ("<main id='main'><h1>T</h1><article class='post category-newsletter'><p>a b</p></article></main>", "T a b"),
        ("<article class='post social'><p>a b</p></article>", "a b"),
        ("<article class='post tag-social'><p>a b c d e f g h</p></article><article class='post'><p>i j k l m n o</p></article>", "a b c d e f g h"),
        # these are still set apart
        ("<article><p>a b</p></article><article class='comment-item'><p>c</p></article>", "a b"),
        ("<article class='post'><p>a b</p><div class='comments-area'><article class='comment-body'><p>c d e f</p></article></div></article>", "a b"),
        ("<div class='ad-box'>buy</div><p>a b</p>", "a b"),
        ("<article class='post comment'><p>c</p></article><p>a b</p>", "a b"),
        ("<div class='content'><p>a b</p><div class='sponsored-content'>s t u v w</div></div>", "a b"),
    ],
)
def test_words_in_classes_do_not_set_the_article_apart(page, text):
    assert extract(page, {}) == text
