"""Text expressions: page text, citation snippets, tokens.  All built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the page-text and citation rules.
HTML_TAG_PATTERN = r"<[^>]+>"
SNIPPET_CONTEXT_CHARACTERS = 120
# Word tokens of two or more letters, digits or underscores (a Unicode \w\w+ run).
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def page_text(html) -> Column:
    """Tags become a space, whitespace runs collapse to one space, then lower-case.

    Scripts, styles and entities are kept, as in the rule being matched.
    """
    stripped = F.regexp_replace(_c(html), HTML_TAG_PATTERN, " ")
    return F.lower(F.regexp_replace(stripped, r"(?U)\s+", " "))


def citation_snippet(text, term: str, context: int = SNIPPET_CONTEXT_CHARACTERS) -> Column:
    """Text around the first occurrence of ``term``: up to ``context`` characters each side.

    Null when the term is absent.  Positions are characters, 1-based in SQL.
    """
    t = _c(text)
    pos = F.instr(t, term)                      # 0 when absent
    start = F.greatest(pos - context, F.lit(1))
    end_exclusive = pos + len(term) + context   # 1-based, exclusive
    return F.when(pos > 0, t.substr(start, end_exclusive - start))


def first_citation(text, variants: list[str], context: int = SNIPPET_CONTEXT_CHARACTERS) -> Column:
    """Citation for the first variant (in order) that occurs; null if none does."""
    return F.coalesce(*[citation_snippet(text, v, context) for v in variants])


def tokens(text) -> Column:
    """Lower-cased word tokens (runs of two or more word characters)."""
    return F.regexp_extract_all(F.lower(_c(text)), F.lit(TOKEN_PATTERN), 0)


def first_sentence(text) -> Column:
    """Text up to the first '.', '!', '?' or line break."""
    return F.regexp_extract(_c(text), r"^[^.!?\n]*", 0)


def is_abstained(brief) -> Column:
    """A brief the screen declined to score starts with the marker word."""
    return _c(brief).startswith("ABSTAINED")
