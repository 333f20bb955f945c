"""Pages of keywords, links and tags instead of sentences, by the shapes of their lines."""

from __future__ import annotations

import html
from collections import Counter
from collections.abc import Iterator
from itertools import pairwise

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

_COMMENT = regex.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\Z)", regex.S | regex.I)
_ANCHOR = regex.compile(r"<a\b[^<>]*>(.*?)(?:</a\s*>|(?=<a\b)|\Z)", regex.S | regex.I)
_WIKI_LINK = regex.compile(r"\[\[(?:[^|\[\]\n]*\|)?([^\[\]\n]*)\]\]")
_LINE_TAG = regex.compile(r"</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|footer|form|h[1-6]|header|hr|li|main|nav|ol|option|p|pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul)(?=[\s/>])[^<>]*>", regex.I)
_TAG = regex.compile(r"</?[a-zA-Z][^<>]*>|<[a-zA-Z][a-zA-Z0-9]*\s[^<>]*\Z")
_MD_LINK = regex.compile(r"!?\[([^\[\]\n]*)\](?:\([^()\s]*\)|\[\w+\])|\[\[([^\[\]\n]*)\]\]|\[https?://\S+ ([^\[\]\n]*)\]")
_URL = regex.compile(r"https?://\S+|www\.\S+")
_HASHTAG = regex.compile(r"(?<![\w&])#(?=[^\s#\d])[^\s#]+")
_HEAD = regex.compile(r"^\s*(?:#{1,6}\s+\S.*|(={2,6})[^=\n]+\1|\*\*[^*\n]+\*\*|'''[^'\n]+'''|\\(?:sub)*section\*?\{.*)\s*$")
_MARKS = regex.compile(r"\\(?:begin|end)\{[^{}\n]*\}|\\[a-zA-Z]+\*?|[*_`{}'\\$|=~]{2,}|^\s*(?:[-*+>]|\d+[.)])\s+|^\s*\|[-:| ]*$", regex.M)
#: A number and a unit of it, of at most three letters or one character of an unspaced script, begin a line of measures.
_MEASURE = regex.compile(r"^\s*[-*•]?\s*\d+(?:[.,/]\d+)?\s*(?:[\p{Latin}\p{Cyrillic}\p{Greek}]{1,3}\b|[\p{Han}\p{Katakana}])", regex.I)
_END = regex.compile(r"[^.!?。！？]+[.!?。！？]*")
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}'’-]*")
_UNSPACED = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}ー]")
_KANA = regex.compile(r"[\p{Hiragana}\p{Katakana}]")
_SEPARATOR = regex.compile(r"[,，、/|;；·•»›>→~＞｜]|\s-\s")

_STOPS = tuple(".!?。！？")
Shape = tuple[str, bool, int, bool, bool, int, bool]
#: If a shape is none of sentences.
Classes = dict[Shape, bool]
#: What a link counts in characters besides its text.
LINK_CHARS = 12
#: The least size of a sentence: words, or characters in scripts without blanks (with kana in them, without).
LEAST_WORDS, LEAST_KANA, LEAST_HAN = 6, 16, 9
#: The least average of words, or characters, between separators.
LEAST_PER_PART, LEAST_CHARS_PER_PART = 2.6, 4.5
#: From so many words, or characters, on a piece's repetition counts.
REPEAT_WORDS, REPEAT_CHARS = 12, 24
#: From so many parts on a sentence's parts are longer: words, characters with kana among them, without.
MANY_PARTS, LONG_WORDS, LONG_KANA, LONG_HAN = 5, 4.6, 14.0, 8.5


#: Bounds of the scales on which a piece is measured: ``long`` from the least size of a sentence on; per part short, middling, or as long as a sentence's parts.
_LEAST = {"words": LEAST_WORDS, "kana": LEAST_KANA, "han": LEAST_HAN}
_PER_PART = {"words": (LEAST_PER_PART, LONG_WORDS), "kana": (LEAST_CHARS_PER_PART, LONG_KANA), "han": (LEAST_CHARS_PER_PART, LONG_HAN)}
#: Sample for the classes of shapes: pages, and characters of each. A shape counts for a page from this share of it on.
SAMPLE_PAGES, SAMPLE_CHARS, NOTABLE = 2000, 20_000, 0.1


def _repeated(units: list[str], least: int) -> int:
    return min(2, int(4 * (1 - len(set(units)) / len(units)))) if len(units) >= least else 0


def shape(piece: str) -> Shape:
    """(script, long, size per part between separators in three classes, many parts, all capitals, how repeated in three classes, ends as a sentence).

    The scale is coarse and bounded: each script has 144 shapes, whatever the page. ``how repeated`` tells of a long
    piece how much of it are words, or pairs of characters, it had before.
    """
    unspaced = len(_UNSPACED.findall(piece)) if not piece.isascii() else 0
    words = _WORD.findall(piece) if unspaced < 4 else []
    parts = len(_SEPARATOR.findall(piece.strip(" ,，、/|;；·•»›"))) + 1
    ends = piece.rstrip()[-1:] in _STOPS
    if words:
        kind, size = "words", len(words)
        capitals = sum(w[0].isupper() for w in words) >= 0.875 * size
        repeated = _repeated([w.lower() for w in words], REPEAT_WORDS)
    else:
        kind, size, capitals = "kana" if len(_KANA.findall(piece)) * 5 >= unspaced > 0 else "han", unspaced, False
        repeated = _repeated([a + b for a, b in pairwise(_UNSPACED.findall(piece))], REPEAT_CHARS)
    low, high = _PER_PART[kind]
    each = round(size / parts, 1)
    return kind, size >= _LEAST[kind], (each >= low) + (each >= high), parts >= MANY_PARTS, capitals, repeated, ends


def fault(s: Shape) -> str | None:
    """What keeps a shape from being one of sentences, before any page is seen; None if nothing does."""
    _, long, each, many, capitals, repeated, ends = s
    if repeated >= (2 if ends else 1):
        return "repeated"
    if (many and each < 2) or each < 1:
        return "listed"
    if not long:
        return "short"
    return "capitals" if capitals else None


def _weight(piece: str) -> int:
    return len("".join(piece.split()))


def shapes(text: str) -> Counter:
    """Characters by shape. Links and tags have shapes of their own; headings, measures and code count as ``other``."""
    t = html.unescape(html.unescape(text)) if "&" in text else text
    found: Counter = Counter()

    def link(m: regex.Match) -> str:
        inner = next((g for g in m.groups() if g), "") if m.re.groups else ""
        found[("link",)] += _weight(_TAG.sub("", inner)) + LINK_CHARS
        return "\n" if m.re is not _MD_LINK or "](" in m.group(0) else " "

    if "<" in t:
        t = _ANCHOR.sub(link, _COMMENT.sub("", t))
        t = _TAG.sub("", _LINE_TAG.sub("\n", t))
    if "[" in t:
        t = _MD_LINK.sub(link, _WIKI_LINK.sub(r"\1", t))
    for line in t.split("\n"):
        if not line.strip():
            continue
        if line.lstrip()[:1] in "#=*'\\" and _HEAD.match(line):
            found[("other",)] += _weight(line)
            continue
        rest = line
        if "://" in line or "www." in line:
            found[("link",)] += len(_URL.findall(line)) * LINK_CHARS
            rest = _URL.sub(" ", line)
        if "#" in rest:
            found[("tag",)] += sum(map(len, _HASHTAG.findall(rest)))
            rest = _HASHTAG.sub(" ", rest)
        rest = _MARKS.sub(" ", rest)
        if _MEASURE.match(rest):
            found[("other",)] += _weight(rest)
            continue
        for piece in _END.findall(rest):
            if _WORD.search(piece):
                found[shape(piece)] += _weight(piece)
            else:
                found[("other",)] += _weight(piece)
    return found + Counter()


def _kind(s: tuple, classes: Classes) -> str:
    """``link``, ``tag``, ``other``, ``sentence``, or what keeps the shape from being one of sentences."""
    if len(s) == 1:
        return s[0]
    by_form = fault(s)
    return (by_form or "unlike" if classes[s] else "sentence") if s in classes else by_form or "sentence"


def _shares(found: Counter, classes: Classes) -> tuple[int, Counter]:
    by_kind: Counter = Counter()
    for s, n in found.items():
        by_kind[_kind(s, classes)] += n
    return sum(by_kind.values()), by_kind


def judge(text: str | None, classes: Classes | None = None) -> tuple[int, float, int, float, str | None]:
    """(characters, share that is not sentences, non-sentence groups of shapes, share of the commonest of them, its kind)."""
    size, by_kind = _shares(shapes(text or ""), classes or {})
    bad = {k: n for k, n in by_kind.items() if k not in ("other", "sentence")}
    off = sum(bad.values())
    if not off:
        return size, 0.0, 0, 0.0, None
    words = sum(n for k, n in bad.items() if k not in ("link", "tag"))
    kind = max(("link", "tag", "keywords"), key=lambda k: (bad.get(k, 0) if k != "keywords" else words, k))
    return size, off / size, len(bad), max(bad.values()) / off, kind


def fit_classes(rows: list[tuple[str, bool]], weight: float = 20.0, rounds: int = 3) -> Classes:
    """Which shapes are none of sentences, from pages and their authors' labels of spam.

    A page is stuffed if over half of it is, by the classes so far (at first by ``fault``); pages labelled as spam that
    aren't found to be stuffed teach nothing, for the label is no truth about the page. A shape belongs to stuffed pages
    if it is notable in a greater share of them than of the others; ``fault`` counts as ``weight`` pages for its side, so
    few pages change little.
    """
    seen = [(shapes(t), spam) for t, spam in rows]
    pages = [(sum(f.values()), {s for s, n in f.items() if len(s) > 1 and n >= NOTABLE * sum(f.values())}, f, spam) for f, spam in seen if f]
    classes: Classes = {}
    for _ in range(rounds):
        stuffed, plain = Counter(), Counter()
        n = [0, 0]
        for size, notable, found, spam in pages:
            by_kind = _shares(found, classes)[1]
            bad = size - by_kind["sentence"] - by_kind["other"] > 0.5 * size
            if bad or not spam:
                n[bad] += 1
                (stuffed if bad else plain).update(notable)
        whole = sum(n) + weight
        new = {}
        for s in stuffed.keys() | plain.keys():
            before = 0.9 if fault(s) else 0.1
            in_stuffed = (stuffed[s] + weight * before * (n[1] + weight / 2) / whole) / (n[1] + weight / 2)
            in_plain = (plain[s] + weight * (1 - before) * (n[0] + weight / 2) / whole) / (n[0] + weight / 2)
            new[s] = in_stuffed > in_plain
        if new == classes:
            break
        classes = new
    return classes


def sample_pages(pages: DataFrame, page_id: str, text: str, spam: str, size: int = SAMPLE_PAGES, chars: int = SAMPLE_CHARS) -> list[tuple[str, bool]]:
    """At most ``size`` labelled pages for the fit, those with the least hashes of their ids, so the same ones wherever it runs; of long ones the first ``chars`` characters."""
    rows = pages.where(F.col(spam).isNotNull() & (F.length(F.trim(text)) > 0)).select(F.xxhash64(page_id).alias("h"), F.substring(text, 1, chars).alias("t"), (F.col(spam) == 1).alias("spam"))
    return [(r["t"], r["spam"]) for r in rows.orderBy("h", "t").limit(size).collect()]


def _rows(batches: Iterator[pa.RecordBatch], classes: Classes, names: list[str]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = [judge(t, classes) for t in b.column(1).to_pylist()]
        cols = list(zip(*got, strict=True)) if got else [[]] * 5
        types = [pa.int64(), pa.float64(), pa.int64(), pa.float64(), pa.string()]
        yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, t) for c, t in zip(cols, types, strict=True)]], names=names)


def judge_pages(pages: DataFrame, page_id: str, text: str, classes: Classes | None = None) -> DataFrame:
    """``page_id, n_chars, stuffed_share, n_shapes, top_share, kind`` of every page.

    Lines and sentences become shapes (script, number of words or characters, the same between separators, capitals,
    repetition, ending; links and tags apart) on a coarse scale, which are counted by characters. Shapes that no sentence
    has, by ``classes`` (``fit_classes``) or else by their form, fall into at most seven groups: short, listed, repeated,
    in capitals, unlike sentences, links, tags. ``stuffed_share`` is the share of these groups, ``n_shapes`` how many of
    them there are, ``top_share`` how much of them the commonest has, ``kind`` what most of them is (``keywords``,
    ``link``, ``tag``). Hidden text counts, markup doesn't; headings and lines of measures are neither. Null, empty and
    blank pages have a share of 0. Every row gives a row, in one pass without a shuffle.
    """
    d = pages.select(F.col(page_id).alias("page_id"), F.col(text).alias("text"))
    names = ["page_id", "n_chars", "stuffed_share", "n_shapes", "top_share", "kind"]
    return d.mapInArrow(lambda b: _rows(b, classes or {}, names), f"page_id {d.dtypes[0][1]}, n_chars bigint, stuffed_share double, n_shapes bigint, top_share double, kind string")


def stuffed_pages(pages: DataFrame, page_id: str, text: str, share: float = 0.5, classes: Classes | None = None) -> DataFrame:
    """The pages dominated by few shapes that no sentence has: their groups, at most seven on any page, hold more than ``share`` of it."""
    return judge_pages(pages, page_id, text, classes).where(F.col("stuffed_share") > share)
