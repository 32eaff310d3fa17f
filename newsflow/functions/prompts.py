"""Summary prompts and token limits, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import is_blank

# --- fixed values -----------------------------------------------------------------------------
DEFAULT_MAX_WORDS = 200
ARTICLE_OPENING = "Summarize this financial news article about {ticker}."
ARTICLE_REQUIREMENTS = (
    "Requirements:",
    "- Maximum {max_words} words (shorter is fine if content is brief)",
    "- Focus on key facts, financial impact, and stock implications",
    "- Include specific numbers, percentages, and dates when relevant",
    "- Write in clear, professional financial journalism style",
    "- Start directly with the news content (no meta-commentary)",
    "- Prioritize actionable information for investors",
)
HTML_OPENING = "Summarize this financial news article about {ticker} that is provided in raw HTML format."
HTML_REQUIREMENTS = (
    "Requirements:",
    "- Maximum {max_words} words (shorter is fine if content is brief)",
    "- Extract and summarize the main article content from the HTML",
    "- Focus on key facts, financial impact, and stock implications",
    "- Include specific numbers, percentages, and dates when relevant",
    "- Write in clear, professional financial journalism style",
    "- Start directly with the news content (no meta-commentary)",
    "- Prioritize actionable information for investors",
    "- Ignore any HTML tags, formatting, or navigation elements",
)
# ----------------------------------------------------------------------------------------------


def max_tokens(max_words: int) -> int:
    """Token limit of a call: 1.3 tokens per word, cut to an integer, plus 100."""
    return int(max_words * 1.3) + 100


def _opening(template: str, ticker: Column) -> Column:
    before, after = template.split("{ticker}")
    return F.concat(F.lit(before), F.coalesce(ticker, F.lit("")), F.lit(after))


def _title(title: Column) -> Column:
    return F.concat(F.lit("Title: "), F.coalesce(title, F.lit("")))


def _closing(lines: tuple[str, ...], max_words: int) -> Column:
    return F.lit("\n".join(lines).format(max_words=max_words))


def article_prompt(
    ticker: Column, title: Column, body: Column, teaser: Column, max_words: int = DEFAULT_MAX_WORDS
) -> Column:
    """Prompt for a cleaned article; NULL (no call) when the body is blank."""
    teaser_line = F.when(~is_blank(teaser), F.concat(F.lit("Teaser: "), teaser))
    # concat_ws skips the NULL teaser line.
    text = F.concat_ws(
        "\n",
        _opening(ARTICLE_OPENING, ticker),
        F.lit(""),
        _title(title),
        teaser_line,
        F.lit("\nArticle:"),
        body,
        F.lit(""),
        _closing(ARTICLE_REQUIREMENTS, max_words),
    )
    return F.when(~is_blank(body), text)


def html_prompt(ticker: Column, title: Column, html: Column, max_words: int = DEFAULT_MAX_WORDS) -> Column:
    """Prompt for a raw HTML article; NULL (no call) when it is blank."""
    text = F.concat_ws(
        "\n",
        _opening(HTML_OPENING, ticker),
        F.lit(""),
        _title(title),
        F.lit("\nHTML Content:"),
        html,
        F.lit(""),
        _closing(HTML_REQUIREMENTS, max_words),
    )
    return F.when(~is_blank(html), text)
