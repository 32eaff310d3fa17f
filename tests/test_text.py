from pyspark.sql import functions as F

from newsflow.functions import prompts
from newsflow.functions import text as tx


def applied(spark, build, values):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, x string")
    return [r.y for r in df.select("i", build(F.col("x")).alias("y")).orderBy("i").collect()]


CLEANED = [
    ("<p>Hello <b>world</b>!</p>", "Hello world!"),
    ("<p>First para</p><p>Second para</p>", "First para\n\nSecond para"),
    (None, ""),
    ("", ""),
    ("<P>a</P> <p>b<br/>c", "a\n\nb\nc"),
    ("<p>a</p> \x1c<p>b", "a\n\nb"),
    ('<p>a</p><p class="x">b</p>', "ab"),
    ("<div>a</div>\n<DIV>b</div>", "a\n\nb"),
    ("<ul><li>q</li><li>r</li></ul>", "• q\n• r"),
    ("<Lİ>q</lı>r<dıv>", "• q\nr"),
    ("a < b and c > d <>", "a d <>"),
    ("x<!-- a\nb -->y<script>var t=1;</script>", "xyvar t=1;"),
    ("&amp;lt;p&gt;", "&lt;p>"),
    ("&lt;p&gt;", "<p>"),
    ("&copy 1 a&ampb &#8364;&#x20AC; &nosuch; &", "© 1 a&b €€ &nosuch; &"),
    (" x y \n\tz\t　", "x y\nz"),
    ("x\n \n \n y", "x\n\n\ny"),
    ("x\n\n\n\n\ny   z", "x\n\ny z"),
    ("a\r\nb\x85", "a\nb"),
    ("a<br \n/>b<br/ >c", "a\nbc"),
    ("<" * 500_000 + "a", "<" * 500_000 + "a"),
    ("<" * 500_000 + "a>b", "b"),
    ("<>" * 100_000 + "<i", "<>" * 100_000 + "<i"),
    ("x > y <b>z</b> w < 1", "x > y z w < 1"),
    ("a" + " " * 5000 + "b", "a b"),
]


def test_clean_html(spark):
    assert applied(spark, tx.clean_html, [x for x, _ in CLEANED]) == [y for _, y in CLEANED]


def test_word_count(spark):
    values = [None, "", "  ", "one", " a b\tc\nd\x1ce f ", "é ü"]
    assert applied(spark, tx.word_count, values) == [0, 0, 0, 1, 6, 2]


def test_fallback_cuts_the_body_only_and_counts_code_points(spark):
    rows = [
        ("\U0001f600" * 1001, "t", "h"),
        ("", "t" * 1500, "h"),
        ("", "", "h"),
        ("", "", None),
        ("", "", ""),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, b string, t string, h string")
    found = [r.c for r in df.select("i", tx.fallback_content("b", "t", "h").alias("c")).orderBy("i").collect()]
    assert found == ["\U0001f600" * 1000, "t" * 1500, "h", "No content available", "No content available"]


def test_preview(spark):
    assert applied(spark, tx.preview, ["é" * 150, "ab", None]) == ["é" * 100, "ab", None]


def test_max_tokens():
    assert [prompts.max_tokens(w) for w in (200, 150, 10, 0, 33)] == [360, 295, 113, 100, 142]


def test_article_prompt(spark):
    def build(teaser):
        return lambda body: prompts.article_prompt(F.lit("TSLA"), F.lit("Title here"), body, F.lit(teaser), 50)

    with_teaser, blank = applied(spark, build("Short"), ["Body text", " \n"])
    lines = with_teaser.split("\n")
    assert lines[:7] == [
        "Summarize this financial news article about TSLA.", "", "Title: Title here", "Teaser: Short", "", "Article:", "Body text",
    ]
    assert lines[7:10] == ["", "Requirements:", "- Maximum 50 words (shorter is fine if content is brief)"]
    assert len(lines) == 15 and blank is None
    (without,) = applied(spark, build("  "), ["Body text"])
    assert without.split("\n")[2:5] == ["Title: Title here", "", "Article:"]


def test_html_prompt(spark):
    build = lambda html: prompts.html_prompt(F.lit("A"), F.lit(None).cast("string"), html, 200)
    found, blank = applied(spark, build, ["<p>x</p>", "  "])
    lines = found.split("\n")
    assert lines[0].endswith("about A that is provided in raw HTML format.")
    assert lines[2:6] == ["Title: ", "", "HTML Content:", "<p>x</p>"] and len(lines) == 16 and blank is None
