"""Headline expressions, all inside JVM code generation."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from riskspark import constants as K

# U makes \s and \b follow Unicode on every Java version.
_FLAGS = "(?iU)"


def clean_headline(text: Column, brands: list[str] | None = None) -> Column:
    """Decode three entities, cut a branding suffix after | or a dash, collapse spaces."""
    names = "|".join(brands or K.BRANDING["financial"])
    out = F.coalesce(text, F.lit(""))
    for entity, char in (("&amp;", "&"), ("&quot;", '"'), ("&#39;", "'")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    out = F.regexp_replace(out, rf"{_FLAGS}\s*[|—–]\s*({names}).*$", "")
    return F.trim(F.regexp_replace(out, r"(?U)\s+", " "))


def is_junk(text: Column, patterns: list[str] | None = None) -> Column:
    """True for a junk headline; a missing one is junk too."""
    return F.coalesce(text.rlike(_FLAGS + "|".join(patterns or K.JUNK_PATTERNS)), F.lit(True))


def is_junk_short(text: Column, min_length: int = 30) -> Column:
    return F.coalesce((F.length(text) < min_length) | text.rlike(f"{_FLAGS}({K.JUNK_SHORT})"),
                      F.lit(True))


def is_relevant(text: Column, words: list[str], whole_word: bool = True) -> Column:
    body = "|".join(re.escape(w) for w in words)
    pattern = rf"\b({body})\b" if whole_word else f"({body})"
    return F.coalesce(text.rlike(_FLAGS + pattern), F.lit(False))


def normal_headline(text: Column) -> Column:
    """Trimmed, unquoted, lower-case form used as the identity of a headline."""
    bare = F.trim(text)
    for quote in ("\"", "'"):
        bare = F.btrim(bare, F.lit(quote))
    return F.lower(bare)


def short_md5(text: Column) -> Column:
    return F.left(F.md5(text), F.lit(12))


def absolute_url(href: Column, page_url: Column) -> Column:
    """Prefix a relative link with the page's host and repair '.com./' hosts."""
    host = F.split_part(page_url, F.lit("/"), F.lit(3))
    full = F.when(href.startswith("http"), href).otherwise(F.concat(F.lit("https://"), host, href))
    return F.replace(F.replace(full, F.lit(".com./"), F.lit(".com/")), F.lit(".co./"), F.lit(".co/"))


def strip_tags(html: Column) -> Column:
    """Inner text of a fragment."""
    return F.trim(F.regexp_replace(F.regexp_replace(html, r"<[^>]*>", ""), r"(?U)\s+", " "))
