"""Plain-Python text normalisation for Arrow-batched functions."""

from __future__ import annotations

import html
import unicodedata

import regex

COMMENT = regex.compile(r"<!--.*?(?:-->|$)", regex.S)
HIDDEN = regex.compile(r"<(script|style)\b[^>]*>.*?(?:</\1\s*>|$)", regex.S | regex.I)
INLINE_TAG = regex.compile(r"</?(?:a|abbr|b|big|cite|code|del|em|font|i|ins|kbd|mark|q|s|samp|small|span|strike|strong|sub|sup|tt|u|var|wbr)(?=[\s/>])[^<>]*>", regex.I)
TAG = regex.compile(r"</?[a-zA-Z][^<>]*>|<![a-zA-Z][^<>]*>|<\?[^<>]*>")
INVISIBLE = regex.compile(r"[\p{Cf}\u034f\ufe00-\ufe0f]+")
WORD = regex.compile(r"[\p{L}\p{N}\p{M}]+")
WORD_CHAR = regex.compile(r"[^\p{L}\p{N}\p{M}]+")
MARKS = regex.compile(r"\p{M}+")


def unmark(text: str) -> str:
    """``text`` without tags, references, link targets and invisible characters."""
    if "&" in text:
        text = html.unescape(html.unescape(text))
    if "<" in text:
        text = HIDDEN.sub(" ", COMMENT.sub("", text))
        text = TAG.sub(" ", INLINE_TAG.sub("", text))
    if "[" in text:
        text = regex.sub(r"\]\([^()\s]*\)", "]", text)
        text = regex.sub(r"\[\[[^|\[\]]*\|", "[[", text)
    if "\\" in text:
        text = regex.sub(r"\\[a-zA-Z]+\*?", "", text)
    if not text.isascii():
        text = INVISIBLE.sub("", text)
    return text


def fold(text: str) -> str:
    """Compatibility form in one case."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())


def words(text: str) -> list[str]:
    """Runs of letters or digits of a folded, unmarked text."""
    return WORD.findall(text)
