"""HTML to plain text, word counts and the content fallback, as column expressions.

Everything is a JVM expression except looking up HTML character references, which is one Arrow
batch call per column. Measured alternatives were slower: sending only the reference strings costs a
split and a join of every text in the JVM, and holding back texts without ``&`` makes the optimizer
evaluate the steps before the call twice.
"""

from __future__ import annotations

import html

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------------------------
# Characters Python's str.strip/str.split/re \s treat as white space (Java's \s is narrower).
SPACE_CHARS = (
    r"\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0"
    r"\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
)
# Markup rewritten before tags are dropped, in order. The letter i also matches its two Turkish
# forms, as a case-insensitive Unicode pattern does.
MARKUP_RULES = (
    (rf"(?i)</p>[{SPACE_CHARS}]*+<p>", "\n\n"),
    (rf"(?i)<br[{SPACE_CHARS}]*+/?>", "\n"),
    (rf"(?i)</d[iİı]v>[{SPACE_CHARS}]*+<d[iİı]v>", "\n\n"),
    (r"(?i)<l[iİı]>", "• "),
    (r"(?i)</l[iİı]>", "\n"),
    (r"<[^>]++>", ""),
)
FALLBACK_CHARS = 1000
PREVIEW_CHARS = 100
NO_CONTENT = "No content available"
# ----------------------------------------------------------------------------------------------

# The same characters unescaped, for trimming without a regular expression.
_TRIM_CHARS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


# Not a length but the rule for it, see ``fallback_limit``.
WHERE_SUMMARY_FAILED = "where-summary-failed"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove white space at both ends (all Unicode white space, not just U+0020)."""
    return F.btrim(_col(c), F.lit(_TRIM_CHARS))


def is_blank(c: Column | str) -> Column:
    """True for NULL, empty and white-space-only text."""
    return F.coalesce(strip(c), F.lit("")) == ""


def drop_markup(c: Column | str) -> Column:
    """Turn paragraph, line, block and list markup into line breaks, then drop all other tags."""
    text = F.coalesce(_col(c), F.lit(""))
    # No tag reaches beyond the last ">". Without that tail every "<" finds its ">", so that even a text
    # of nothing but "<" takes linear time.
    tail = F.substring_index(text, ">", -1)
    head = F.substring(text, F.lit(1), F.length(text) - F.length(tail))
    for pattern, replacement in MARKUP_RULES:
        head = F.regexp_replace(head, pattern, replacement)
    has_tags = F.contains(text, F.lit("<")) & F.contains(text, F.lit(">"))
    return F.when(has_tags, F.concat(head, tail)).otherwise(text)


@F.arrow_udf(T.StringType())
def _unescape(texts: pa.Array) -> pa.Array:
    # Only texts with a reference become Python strings, one at a time: a batch may be large.
    found = pc.fill_null(pc.match_substring(texts, "&"), False)
    if not pc.any(found).as_py():
        return texts
    changed = pa.array((html.unescape(t.as_py()) for t in texts.filter(found)), texts.type)
    return pc.replace_with_mask(texts, found, changed)


def unescape(c: Column | str) -> Column:
    """Replace HTML character references once (``&amp;lt;`` becomes ``&lt;``)."""
    return _unescape(_col(c))


def tidy_space(c: Column | str) -> Column:
    """Collapse spaces, cap blank lines, trim every line and the whole text - in that order."""
    text = F.regexp_replace(_col(c), " {2,}", " ")
    text = F.regexp_replace(text, r"\n{3,}", "\n\n")
    lines = F.transform(F.split(text, "\n", -1), strip)
    return strip(F.array_join(lines, "\n"))


def clean_html(c: Column | str) -> Column:
    """Plain text of an HTML fragment; never NULL."""
    return tidy_space(unescape(drop_markup(c)))


def words(c: Column | str) -> Column:
    """White-space-separated words as an array; empty for NULL."""
    other = _TRIM_CHARS.replace(" ", "")
    spaced = F.translate(F.coalesce(_col(c), F.lit("")), other, " " * len(other))
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def word_count(c: Column | str) -> Column:
    """Number of white-space-separated words; 0 for NULL."""
    return F.size(words(c)).cast("bigint")


def fallback_limit(chars: int | str | None, called: bool) -> int | None:
    """Characters that a fallback may have: where no service was called no summary failed, and bodies stay whole."""
    return (FALLBACK_CHARS if called else None) if chars == WHERE_SUMMARY_FAILED else chars


def fallback_content(
    body: Column | str, teaser: Column | str, title: Column | str, chars: int | None = FALLBACK_CHARS
) -> Column:
    """Content when there is no summary: the body, else teaser, else title, else a constant.

    Of the body the first ``chars`` characters stay, which is the rule for a failed summary; all of it with None.
    """
    start = _col(body) if chars is None else F.substring(_col(body), 1, chars)
    return F.coalesce(
        F.nullif(start, F.lit("")),
        F.nullif(_col(teaser), F.lit("")),
        F.nullif(_col(title), F.lit("")),
        F.lit(NO_CONTENT),
    )


def preview(c: Column | str, chars: int = PREVIEW_CHARS) -> Column:
    return F.substring(_col(c), 1, chars)
