"""Clean text from HTML, Markdown, wiki and LaTeX markup, with minimum cuts deciding what is markup and what is content."""

from __future__ import annotations

import html
import math
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from millrace.llm.mincut import min_cut

KINDS = ("html", "markdown", "wiki", "latex")

#: Element names of HTML.
_NAMES = "a abbr address article aside audio b blockquote body br button caption center cite code col dd del details div dl dt em embed fieldset figcaption figure font footer form h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label li link main map mark meta nav noscript object ol option p param picture pre q s samp script section select small source span strike strong style sub summary sup svg table tbody td textarea tfoot th thead time title tr tt u ul var video wbr"
_TAG_SOURCE = rf"</?(?:{'|'.join(_NAMES.split())})(?=[\s/>])(?:[^<>\"']|\"[^\"]*\"|'[^']*')*>"
_TAG = regex.compile(_TAG_SOURCE, regex.I)
_BLOCK_NAMES = set("address article aside blockquote body br caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main nav ol option p pre section table tbody td tfoot th thead title tr ul".split())
_BOILER_NAMES = set("nav footer header aside form button select option script style head".split())

#: (kind, name, pattern, evidence that it is this kind's markup before any text is seen, texts of which it needs one to
#: match at all). Marks of the evidence ``_STRONG`` are what a notation is known by; they label the texts from which the
#: evidence of the others is fitted. A pattern in two kinds is a mark they share: the marks around it decide.
_STRONG, _GOOD, _SHARED, _WEAK = 6.0, 2.5, -0.5, -1.5
_RULES = [
    ("html", "tag", _TAG_SOURCE, _STRONG, ("<",)),
    ("html", "open tag", rf"<(?:{'|'.join(_NAMES.split())})(?=[\s])\s+[a-z-]+=(?:\"[^\"<>]*|'[^'<>]*)$", _STRONG, ("<",)),
    ("html", "doctype", r"<!doctype[^<>]*>", _STRONG, ("<!",)),
    ("html", "reference", r"&(?:nbsp|amp|lt|gt|quot|apos|copy|reg|hellip|mdash|ndash|middot|laquo|raquo|ldquo|rdquo|lsquo|rsquo|times|euro|yen|bull|deg|trade|ensp|emsp|zwnj|zwj|shy|[aeioucnAEIOUCN](?:acute|grave|circ|uml|tilde|cedil|ring)|szlig|oslash|aelig|#\d{1,7}|#[xX][0-9a-fA-F]{1,6});", _STRONG, ("&",)),
    ("markdown", "fence", r"^ {0,3}(?:```|~~~)[\w+-]*\s*$", _STRONG, ("```", "~~~",)),
    ("markdown", "heading", r"^#{2,6} +\S", _STRONG, ("##",)),
    ("markdown", "bold", r"(?<![*\w])\*\*(?=\S)[^*\n]+?(?<=\S)\*\*(?![*\w])|(?<!\*)\*\*(?=[^\s*])[^*\n]*?[^\s*]\*\*(?!\*)", _STRONG, ("**",)),
    ("markdown", "link", r"!?\[[^\[\]\n]*\]\([^()\s]+(?:\s+\"[^\"\n]*\")?\)", _STRONG, ("](",)),
    ("markdown", "reference link", r"^\[[^\[\]\n]+\]: +\S+|\[[^\[\]\n]+\]\[[\w-]+\]", _STRONG, ("][", "]: ",)),
    ("markdown", "table rule", r"^[ \t]*\|?(?:[ \t]*:?-{3,}:?[ \t]*\|)+(?:[ \t]*:?-{3,}:?)?[ \t]*$", _STRONG, ("---",)),
    ("markdown", "code", r"(?<!`)`[^`\n]+`(?!`)", _GOOD, ("`",)),
    ("markdown", "strong underline", r"(?<![\w_])__(?!(?:TOC|NOTOC|NOEDITSECTION|FORCETOC)__)(?=[^\s_])[^_\n]*[^\s_]__(?![\w_])", _GOOD, ("__",)),
    ("markdown", "strike", r"~~(?=\S)[^~\n]+~~", _GOOD, ("~~",)),
    ("markdown", "quote", r"^> +\S", _GOOD, ("> ",)),
    ("markdown", "underlined heading", r"^\S[^\n]*\n(?:={3,}|-{3,})[ \t]*$", _GOOD, ("===", "---",)),
    ("markdown", "emphasis", r"(?<![*\w])\*(?=[^\s*])[^*\n]*[^\s*]\*(?![*\w])", _GOOD, ("*",)),
    ("markdown", "dash item", r"^ {0,6}- +\S", 0.4, ("- ",)),
    ("markdown", "plus item", r"^ {0,6}\+ +\S", _WEAK, ("+ ",)),
    ("markdown", "underline", r"(?<![\w_])_(?=[^\s_])[^_\n]*[^\s_]_(?![\w_])", _WEAK, ("_",)),
    ("markdown", "star item", r"^ {0,6}\* +\S", _SHARED, ("* ",)),
    ("markdown", "hash line", r"^# +\S", 0.4, ("# ",)),
    ("markdown", "row", r"^\|[^|\n][^\n]*\|[ \t]*$", _SHARED, ("|",)),
    ("markdown", "numbered", r"^ {0,3}\d+\. +\S", _WEAK, (". ",)),
    ("wiki", "heading", r"^(={2,6})(?!=)[ \t]*\S[^\n]*?(?<!=)\1[ \t]*$", _STRONG, ("==",)),
    ("wiki", "link", r"\[\[[^\[\]\n]+\]\]", _STRONG, ("[[",)),
    ("wiki", "template", r"\{\{[^{}\n]+\}\}", _STRONG, ("{{",)),
    ("wiki", "table", r"^[ \t]*(?:\{\||\|\}|\|-+[ \t]*$)", _STRONG, ("{|", "|}", "|-",)),
    ("wiki", "quotes", r"'{3}(?=[^'\s])[^\n]*?'{3}|(?<!')''(?=[^'\s])[^'\n]+''(?!')", _STRONG, ("''",)),
    ("wiki", "outer link", r"\[https?://[^\s\[\]]+ [^\[\]\n]+\]", _STRONG, ("[http",)),
    ("wiki", "switch", r"__(?:TOC|NOTOC|NOEDITSECTION|FORCETOC)__", _STRONG, ("__",)),
    ("wiki", "reference", r"<ref[^<>]*>|</ref>|<nowiki>|</nowiki>", _STRONG, ("ref", "nowiki",)),
    ("wiki", "star item", r"^\*+ *\S", _SHARED, ("*",)),
    ("wiki", "hash line", r"^# *\S", _WEAK, ("#",)),
    ("wiki", "cell", r"^\|[^|\n}-][^\n]*(?:\|\|[^\n]*)?$", _SHARED, ("|",)),
    ("wiki", "definition", r"^[;:] +\S", _WEAK, ("; ", ": ",)),
    ("latex", "structure", r"\\(?:begin|end|(?:sub)*section|chapter|paragraph|title|author|label|ref|cite|caption|footnote|text[a-z]{2}|emph|underline|item|documentclass|usepackage|maketitle|includegraphics|href|url|centering|hline|newline|par)(?![a-zA-Z])\*?(?:\[[^\[\]\n]*\])?(?:\{[^{}\n]*\}?)?", _STRONG, ("\\",)),
    ("latex", "command", r"(?<![\w:\\])\\[a-zA-Z]{2,}\*?(?:\[[^\[\]\n]*\])?\{[^{}\n]*\}", _STRONG, ("\\",)),
    ("latex", "symbol", r"(?<![\w:\\])\\(?:frac|sqrt|sum|int|prod|lim|infty|alpha|beta|gamma|delta|epsilon|theta|lambda|mu|pi|sigma|phi|omega|cdot|times|leq|geq|neq|approx|partial|nabla|in|to|left|right|bar|hat|vec|ldots|dots)(?![a-zA-Z])", _STRONG, ("\\",)),
    ("latex", "inline formula", r"(?<![\\$\w])\$(?=[^\s$])(?=[^$\n]*[\\^_=+<>{}]|[a-zA-Z](?:\([a-zA-Z]\))?\$)[^$\n]{1,200}?(?<=[^\s\\$])\$(?![\d$])", _GOOD, ("$",)),
]
_PATTERNS = [(kind, name, regex.compile(p, regex.M | regex.I | regex.S if kind == "html" else regex.M), e, needs) for kind, name, p, e, needs in _RULES]
#: Capacities of ties: of neighbours in one line and block; of a mark to the text as a whole.
_NEAR, _TEXT = 0.3, 2.0
#: Sample for the costs: texts, and characters of each.
SAMPLE_TEXTS, SAMPLE_CHARS = 2000, 20_000
_MAKE_CODE = {"tag", "fence", "structure"}
_BREAK = regex.compile(r"\n")
_OPEN_FORMULA = regex.compile(r"\\[(\[]|\$\$")
_FENCE = regex.compile(r"^ {0,3}(```|~~~)")
_FENCED = regex.compile(r"^ {0,3}(```|~~~)[^\n]*\n.*?(?:^ {0,3}\1[ \t]*$|\Z)", regex.M | regex.S)
_HEADING = regex.compile(r"^(#{1,6}) +(\S.*)$")
_HEADS = {f"h{i}": True for i in range(1, 7)}
_ENDS = tuple(".!?。！？…」』）)\"”:：")
_ELEMENT = regex.compile(rf"</?(?:{'|'.join(sorted(_BLOCK_NAMES - {'br', 'hr'}))})(?=[\s/>])", regex.I)
Costs = dict[tuple[str, str], float]
_CODE = regex.compile(r"^ {0,3}(```|~~~)[^\n]*\n.*?(?:^ {0,3}\1[ \t]*$|\Z)|<pre\b[^>]*>.*?(?:</pre\s*>|\Z)|<code\b[^>]*>.*?(?:</code\s*>|\Z)|\\begin\{(verbatim|lstlisting)\}.*?(?:\\end\{\2\}|\Z)", regex.M | regex.S | regex.I)
_ESCAPED = regex.compile(r"&lt;(/?(?:" + "|".join(_NAMES.split()) + r")(?=[\s/&])(?:(?!&[lg]t;).)*?)&gt;", regex.I | regex.S)


@dataclass
class Mark:
    start: int
    end: int
    kind: str
    name: str
    evidence: float
    line: int = 0
    block: int = 0


@cache
def _compiled(pattern: str, flags: str) -> regex.Pattern:
    return regex.compile(f"(?{flags}){pattern}" if flags else pattern)


def _sub(pattern: str, by, text: str, flags: str = "") -> str:
    return _compiled(pattern, flags).sub(by, text)


def _comments(text: str) -> Iterator[tuple[int, int]]:
    start = text.find("<!--")
    while start >= 0 and (end := text.find("-->", start + 4)) >= 0:
        yield start, end + 3
        start = text.find("<!--", end + 3)


def _formulas(text: str) -> Iterator[tuple[int, int]]:
    """Openings of formulas that are closed: within their line, anywhere behind, and the double sign in pairs."""
    last = text.rfind("\\]")
    ends: dict[int, int] = {}
    for m in _OPEN_FORMULA.finditer(text):
        if m.group(0) == "\\[":
            closed = m.end() <= last
        elif m.group(0) == "$$":
            closed = text.find("$$", m.end() + 1) >= 0
        else:
            line = text.find("\n", m.end())
            line = len(text) if line < 0 else line
            if line not in ends:
                ends[line] = text.rfind("\\)", 0, line)
            closed = m.end() <= ends[line]
        if closed:
            yield m.start(), m.end()


def find_marks(text: str, costs: Costs | None = None) -> list[Mark]:
    """Everything that may be a mark of some notation, by position, with its line and block. Within code only the marks that make it code count."""
    code: list[tuple[int, int]] = []
    for m in _CODE.finditer(text) if "`" in text or "~~~" in text or "<" in text or "\\begin{" in text else ():
        code.append((m.start(), m.end()))
    heads = [a for a, _ in code]

    def inside(at: int) -> bool:
        k = bisect_left(heads, at) - 1
        return k >= 0 and at < code[k][1]

    costs = costs or {}
    out = [Mark(a, b, "html", "comment", _STRONG) for a, b in _comments(text)]
    if "\\" in text or "$$" in text:
        out += [Mark(a, b, "latex", "math", _STRONG) for a, b in _formulas(text) if not inside(a)]
    for kind, name, pattern, evidence, needs in _PATTERNS:
        if any(t in text for t in needs):
            for m in pattern.finditer(text):
                if code and name not in _MAKE_CODE and inside(m.start()):
                    continue
                out.append(Mark(m.start(), m.end(), kind, name, costs.get((kind, name), evidence)))
    out.sort(key=lambda m: (m.start, m.end, m.kind))
    breaks = [m.start() for m in _BREAK.finditer(text)]
    elements = [m.start for m in out if m.name == "tag" and _ELEMENT.match(text, m.start)]
    line = element = 0
    for m in out:
        while line < len(breaks) and breaks[line] < m.start:
            line += 1
        while element < len(elements) and elements[element] <= m.start:
            element += 1
        m.line, m.block = line, element
    return out


def _edges(marks: list[Mark], own: list[int]) -> list[tuple[int, int, float]]:
    """Smoothness: each mark holds to the next three by their distance in lines, more so within one block of the document."""
    edges = []
    for a in range(len(own)):
        for b in range(a + 1, min(a + 4, len(own))):
            x, y = marks[own[a]], marks[own[b]]
            edges.append((a, b, (_NEAR if x.block == y.block else _NEAR / 3) / (1 + y.line - x.line)))
    return edges


def label_marks(marks: list[Mark], edges: bool = True) -> list[bool]:
    """Which marks are markup of their kind: one cut for each kind.

    A mark's evidence is its link to source (markup) or sink (an everyday sign, or another kind's mark). Marks that
    follow each other hold together by their distance, in lines and in blocks of the document (``_edges``). Markdown and
    wiki text share marks: the sure marks of the one stand on the sink's side in the other's cut, each next to the marks
    around it and all of them behind one node for the text, to which the doubtful marks are tied; so these go to the
    notation that the text otherwise uses. ``edges=False`` leaves out all ties (each mark is judged by itself).
    """
    labels = [False] * len(marks)
    by_kind: dict[str, list[int]] = {}
    for i, m in enumerate(marks):
        by_kind.setdefault(m.kind, []).append(i)
    for kind, own in by_kind.items():
        other = {"markdown": "wiki", "wiki": "markdown"}.get(kind)
        rivals = [i for i in by_kind.get(other, ()) if marks[i].evidence >= _STRONG]
        if all(marks[i].evidence > 0 for i in own) and (not rivals or all(marks[i].evidence >= _STRONG for i in own)):
            for i in own:  # nothing pulls to the sink: the least cut costs nothing
                labels[i] = True
            continue
        nodes = sorted([*own, *rivals])
        sign = [-1.0 if marks[i].kind == other else 1.0 for i in nodes]
        source = [max(s * marks[i].evidence, 0.0) for i, s in zip(nodes, sign, strict=True)]
        sink = [max(-s * marks[i].evidence, 0.0) for i, s in zip(nodes, sign, strict=True)]
        ties = []
        if edges:
            ties = _edges(marks, nodes)
            sure = sum(marks[i].evidence >= _STRONG for i in own)
            pull = min(_TEXT, sure) - min(_TEXT, len(rivals))
            if pull:
                source.append(max(pull, 0.0))
                sink.append(max(-pull, 0.0))
                ties += [(k, len(nodes), _TEXT) for k, i in enumerate(nodes) if marks[i].evidence < _STRONG]
        for i, side in zip(nodes, min_cut(source, sink, ties), strict=False):
            if marks[i].kind == kind:
                labels[i] = side
    return labels


def notations(text: str, costs: Costs | None = None) -> list[str]:
    """The notations a text holds."""
    marks = find_marks(text, costs)
    plain = _ESCAPED.sub(lambda m: f"<{html.unescape(m.group(1))}>", text) if "&lt;" in text else text
    found = {m.kind for m, is_mark in zip(marks, label_marks(marks), strict=True) if is_mark}
    if plain != text:
        found |= {"html"} | set(notations(plain, costs))
    return [k for k in KINDS if k in found]


def fit_costs(texts: list[str], weight: float = 20.0) -> Costs:
    """The evidence of each mark that a notation isn't known by, as log odds from ``texts``.

    Texts are labelled by the marks that a notation is known by. Of the texts that hold a mark the ones with its kind's
    label stand against those without; the evidence before any text is seen counts as ``weight`` texts.
    """
    before = {(kind, name): e for kind, name, _, e, _ in _PATTERNS if e < _STRONG}
    with_, without = dict.fromkeys(before, 0), dict.fromkeys(before, 0)
    for text in texts:
        marks = find_marks(text)
        known = {m.kind for m in marks if m.evidence >= _STRONG}
        for k in {(m.kind, m.name) for m in marks} & before.keys():
            (with_ if k[0] in known else without)[k] += 1
    odds = lambda e: 1 / (1 + math.exp(-e))
    return {k: math.log((with_[k] + weight * odds(e)) / (without[k] + weight * (1 - odds(e)))) for k, e in before.items()}


def sample_texts(docs: DataFrame, doc_id: str, text: str, size: int = SAMPLE_TEXTS, chars: int = SAMPLE_CHARS) -> list[str]:
    """At most ``size`` texts for the fit, those with the least hashes of their ids, so the same ones wherever it runs; of long ones the first ``chars`` characters."""
    h = F.xxhash64(doc_id)
    rows = docs.where(F.length(F.trim(text)) > 0).select(h.alias("h"), F.substring(text, 1, chars).alias("t")).orderBy("h", "t").limit(size)
    return [r["t"] for r in rows.collect()]


@dataclass
class Block:
    text: str
    role: str = "text"
    parent: tuple = ()
    linked: int = 0
    boiler: bool = False
    extra: dict = field(default_factory=dict)


_CELL = regex.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>")
_ALT = regex.compile(r"\balt\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", regex.I)


def html_blocks(text: str) -> list[Block]:
    """The blocks of a text with HTML in it, in order, with the path of the elements around them."""
    text = _sub(r"<!--.*?(?:-->|\Z)", "", text, flags="s")
    text = _sub(r"<(script|style)\b[^>]*>.*?(?:</\1\s*>|\Z)", "", text, flags="si")
    text = _sub(r"<[a-zA-Z]+\s+[a-z-]+=(?:\"[^\"<>]*|'[^'<>]*)\Z", "", text)
    blocks: list[Block] = []
    path: list[tuple[str, int]] = []
    buf: list[str] = []
    serial, linked, in_link, role, row = 0, 0, False, "text", None

    def flush() -> None:
        nonlocal linked
        raw = "".join(buf)
        body = raw.strip("\n") if role == "code" else raw
        if body.strip():
            if row is not None and role == "cell" and blocks and blocks[-1].extra.get("row") == row:
                blocks[-1].text += " | " + body.strip()
            else:
                b = Block(html.unescape(body) if role == "code" else body.strip(), role, tuple(path[-3:]), linked, any(n in _BOILER_NAMES for n, _ in path))
                b.extra["row"] = row if role == "cell" else None
                blocks.append(b)
        buf.clear()
        linked = 0

    at = 0
    for m in _CELL.finditer(text):
        name = m.group(2).lower()
        if name not in _NAMES_SET:
            continue
        piece = text[at : m.start()]
        at = m.end()
        buf.append(piece)
        if in_link:
            linked += len(piece.strip())
        closing = bool(m.group(1))
        if name == "a":
            in_link = not closing
        elif name == "img" and (alt := _ALT.search(m.group(3))):
            buf.append(next(g for g in alt.groups() if g is not None))
        if name == "br":
            if role == "code":
                buf.append("\n")
            else:
                flush()
            continue
        if name not in _BLOCK_NAMES and not (name == "code" and role == "code"):
            continue
        if name == "code":
            continue
        flush()
        if closing:
            while path and any(n == name for n, _ in path):
                if path.pop()[0] == name:
                    break
            names = [n for n, _ in path]
            role = "code" if "pre" in names else "item" if "li" in names else "text"
        elif name != "hr":
            if name in ("p", "li", "tr", "td", "th") and path and path[-1][0] == name:
                path.pop()
            serial += 1
            path.append((name, serial))
            role = {"pre": "code", "li": "item", "td": "cell", "th": "cell"}.get(name, f"h{name[1]}" if _HEADS.get(name) else "text")
            if name == "tr":
                row = serial
    rest = text[at:]
    buf.append(rest)
    if in_link:
        linked += len(rest.strip())
    flush()
    return blocks


_NAMES_SET = set(_NAMES.split())


def _unlatex(t: str) -> str:
    keep: list[str] = []

    def hold(m: regex.Match) -> str:
        keep.append(m.group(0))
        return f"\ue000{len(keep) - 1}\ue001"

    t = _sub(r"\\\(.*?\\\)|\\\[.*?\\\]|\$\$.+?\$\$|(?<![\\$\w])\$(?=[^\s$])[^$\n]*[\\^_=+<>{}][^$\n]*\$(?!\d)", hold, t, flags="s")
    t = _sub(r"\\(?:sub)*section\*?\{([^{}]*)\}|\\(?:title|chapter|paragraph)\*?\{([^{}]*)\}", lambda m: f"\n# {m.group(1) or m.group(2) or ''}\n", t)
    t = _sub(r"\\begin\{(?:verbatim|lstlisting)\}", "\n```\n", t)
    t = _sub(r"\\end\{(?:verbatim|lstlisting)\}", "\n```\n", t)
    t = _sub(r"\\(?:begin|end)\{[^{}]*\}(?:\[[^\[\]]*\])?", "", t)
    t = _sub(r"\\item(?:\[[^\[\]]*\])?\s*", "\n- ", t)
    for _ in range(3):
        t = _sub(r"\\(?:text[a-z]+|emph|underline|footnote|caption|mbox|href\{[^{}]*\}|url)\*?\{([^{}]*)\}", r"\1", t)
    t = _sub(r"\\(?:label|ref|cite|documentclass|usepackage|includegraphics)(?:\[[^\[\]]*\])?\{[^{}]*\}|\\(?:maketitle|centering|hline|par|newline)(?![a-zA-Z])|\\\\", " ", t)
    return _sub("\ue000(\\d+)\ue001", lambda m: keep[int(m.group(1))], t)


def _unwiki(t: str) -> str:
    t = _sub(r"\[\[(?:[^|\[\]\n]*\|)?([^\[\]\n]+)\]\]", r"\1", t)
    t = _sub(r"\[https?://[^\s\[\]]+ ([^\[\]\n]+)\]", r"\1", t)
    for _ in range(2):
        t = _sub(r"\{\{[^{}\n]*\}\}", "", t)
    t = _sub(r"'{2,5}", "", t)
    t = _sub(r"^(={2,6})[ \t]*(\S[^\n]*?)[ \t]*\1[ \t]*$", lambda m: "#" * min(6, len(m.group(1))) + " " + m.group(2), t, flags="m")
    t = _sub(r"^\s*(?:\{\|[^\n]*|\|\}|\|-+)\s*$\n?", "", t, flags="m")
    t = _sub(r"^[|!][ \t]*([^|\n][^\n]*)$", lambda m: m.group(1).replace("||", "|").replace("!!", "|"), t, flags="m")
    t = _sub(r"^[*]+[ \t]*(?=\S)", "- ", t, flags="m")
    return _sub(r"__(?:TOC|NOTOC|NOEDITSECTION|FORCETOC)__|</?(?:ref|nowiki)[^<>]*>", "", t)


def _unmarkdown(t: str) -> str:
    t = _sub(r"!?\[([^\[\]\n]*)\]\([^()\s]+(?:\s+\"[^\"\n]*\")?\)", r"\1", t)
    t = _sub(r"^\[[^\[\]\n]+\]: +\S+[^\n]*$\n?", "", t, flags="m")
    t = _sub(r"\[([^\[\]\n]+)\]\[[\w-]+\]", r"\1", t)
    t = _sub(r"^(\S[^\n]*)\n(={3,}|-{3,})[ \t]*$", r"# \1", t, flags="m")
    t = _sub(r"^\s*\|?(?:\s*:?-{3,}:?\s*\|)+(?:\s*:?-{3,}:?)?\s*$\n?", "", t, flags="m")
    t = _sub(r"^\|[ \t]*([^\n]*?)[ \t]*\|[ \t]*$", r"\1", t, flags="m")
    t = _sub(r"(?<!\*)\*\*(?=[^\s*])([^*\n]*?[^\s*])\*\*(?!\*)", r"\1", t)
    t = _sub(r"(?<![\w_])__(?=[^\s_])([^_\n]*[^\s_])__(?![\w_])", r"\1", t)
    t = _sub(r"(?<![*\w])\*(?=[^\s*])([^*\n]*[^\s*])\*(?![*\w])", r"\1", t)
    t = _sub(r"~~(?=\S)([^~\n]+)~~", r"\1", t)
    return _sub(r"^ {0,6}[*+] +(?=\S)", "- ", t, flags="m")


def _convert(text: str, kinds: list[str]) -> str:
    """Marks other than HTML's taken away, code left as it is."""
    parts, at = [], 0
    for m in [*(_FENCED.finditer(text) if "```" in text or "~~~" in text else ()), None]:
        t = text[at : m.start() if m else len(text)]
        if "latex" in kinds:
            t = _unlatex(t)
        if "wiki" in kinds:
            t = _unwiki(t)
        if "markdown" in kinds:
            t = _unmarkdown(t)
        parts.append(t)
        if m:
            parts.append(m.group(0))
            at = m.end()
    return "".join(parts)


_URL = regex.compile(r"https?://\S+")


def _costs(b: Block) -> tuple[float, float]:
    """(cost as boilerplate, cost as content) of a block, from its length, links, end and place."""
    size = len(b.text)
    linked = min(1.0, (b.linked + sum(len(x) for x in _URL.findall(b.text))) / max(1, size))
    ends = b.text.rstrip()[-1:] in _ENDS
    boiler = 2.5 * linked + (2.0 if b.boiler else 0.0) + (0.4 if size < 15 and b.role == "text" else 0.0)
    content = min(2.0, size / 60) + (0.8 if ends else 0.0) + (2.5 if b.role == "code" or b.role[0] == "h" else 0.6 if b.role in ("item", "cell") else 0.0)
    return content * (1 - 0.8 * linked), boiler


def label_blocks(blocks: list[Block]) -> list[bool]:
    """Which blocks are content: a cut with the classifier's costs at source and sink, and edges between blocks that follow each other or share an element."""
    costs = [_costs(b) for b in blocks]
    edges = [(i, i + 1, 0.3 + (0.4 if blocks[i].parent == blocks[i + 1].parent else 0.0)) for i in range(len(blocks) - 1)]
    last: dict[tuple, int] = {}
    for i, b in enumerate(blocks):
        up = b.parent[:-1]
        if up and up in last and last[up] < i - 1:
            edges.append((last[up], i, 0.2))
        last[up] = i
    return min_cut([c for c, _ in costs], [b for _, b in costs], edges)


def clean(text: str, costs: Costs | None = None) -> tuple[str, list[str], str, int]:
    """(clean text, notations, what was cut off as boilerplate, number of blocks)."""
    kinds = notations(text, costs)
    if "html" in kinds:
        t = _ESCAPED.sub(lambda m: f"<{html.unescape(m.group(1))}>", text)
        blocks = html_blocks(t)
        for b in blocks:
            if b.role != "code":
                b.text = html.unescape(b.text)
    else:
        blocks = [Block(text)]
    out: list[Block] = []
    for b in blocks:
        if b.role == "code":
            out.append(b)
            continue
        t = _convert(b.text, [k for k in kinds if k != "html"])
        if b.role in ("text", "item") and "\n" in t.strip():
            fenced = False
            for line in t.split("\n"):
                fence = _FENCE.match(line)
                if fence or fenced:
                    if fence and not fenced:
                        out.append(Block("", "code", b.parent))
                    elif not fence:
                        out[-1].text += ("\n" if out[-1].text else "") + line
                    fenced = not fenced if fence else fenced
                elif line.strip():
                    h = _HEADING.match(line) if "markdown" in kinds or "wiki" in kinds or "latex" in kinds else None
                    out.append(Block(h.group(2).strip(), f"h{len(h.group(1))}", b.parent) if h else Block(line.strip(), b.role, b.parent, b.linked if len(t) == len(line) else 0, b.boiler))
        elif t.strip():
            t = t.strip()
            h = _HEADING.match(t) if set(kinds) - {"html"} else None
            out.append(Block(h.group(2), f"h{len(h.group(1))}", b.parent) if h else Block(t, b.role, b.parent, b.linked, b.boiler))
    out = [b for b in out if b.text.strip()]
    keep = label_blocks(out)
    show = lambda b: f"```\n{b.text}\n```" if b.role == "code" else f"- {b.text}" if b.role == "item" and not b.text.startswith("- ") else f"{'#' * int(b.role[1])} {b.text}" if b.role[0] == "h" else b.text
    lines = [_sub(r"[ \t\u00a0]+", " ", show(b)) if b.role != "code" else show(b) for b, k in zip(out, keep, strict=True) if k]
    return "\n".join(lines), kinds, "\n".join(b.text for b, k in zip(out, keep, strict=True) if not k), len(out)


def _rows(batches: Iterator[pa.RecordBatch], costs: Costs | None, names: list[str]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts, kinds, cut, size = [], [], [], []
        for t in b.column(1).to_pylist():
            got = clean(t, costs) if t and t.strip() else (t, [], "", 0)
            texts.append(got[0])
            kinds.append(got[1])
            cut.append(got[2])
            size.append(got[3])
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), pa.array(kinds, pa.list_(pa.string())), pa.array(cut, pa.string()), pa.array(size, pa.int64())], names=names)


def clean_markup(docs: DataFrame, doc_id: str, text: str, costs: Costs | None = None) -> DataFrame:
    """``doc_id, clean_text, kinds, boilerplate, n_blocks``: each text without its marks, and the notations it held.

    Headings stay as ``# `` lines, list items as ``- `` lines, code between fences, formulas in their own notation,
    cells of a table row with `` | `` between them. ``boilerplate`` has the blocks that the cut took for navigation
    and the like. ``costs`` are the fitted evidence of marks (``fit_costs``), else that from before any text. Broken markup is read as far as it goes. Null, empty and blank texts come back as they are, with no
    kinds. Every input row gives a row, without a shuffle; other columns don't matter.
    """
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    names = ["doc_id", "clean_text", "kinds", "boilerplate", "n_blocks"]
    return d.mapInArrow(lambda b: _rows(b, costs, names), f"doc_id {d.dtypes[0][1]}, clean_text string, kinds array<string>, boilerplate string, n_blocks bigint")
