"""Languages of texts and their parts by compression with a dictionary for each language."""

from __future__ import annotations

import sys
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.text import TAG, unmark

#: The spellings of each language's label.
LABELS = {
    "en": "en eng english",
    "zh": "zh chi zho cmn chinese mandarin 中文 漢語 汉语",
    "ja": "ja jpn jp japanese 日本語",
    "ko": "ko kor kr korean 한국어",
    "de": "de ger deu german deutsch",
    "fr": "fr fre fra french français francais",
    "es": "es spa spanish español espanol castellano",
    "pt": "pt por portuguese português portugues",
}
LANGUAGES = tuple(LABELS)
_LETTER = regex.compile(r"\p{L}")
_NO_LETTER = regex.compile(r"\P{L}+")
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}'’]*")
_UNSPACED = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}]")
_SCRIPTS = (("hangul", regex.compile(r"\p{Hangul}")), ("kana", regex.compile(r"[\p{Hiragana}\p{Katakana}]")), ("han", regex.compile(r"\p{Han}")))
_SENTENCE = regex.compile(r"[^.!?。！？\n]+[.!?。！？]*[\"'”’»)）」』]*")
_ADDRESS = regex.compile(r"(?:https?://|www\.)\S+|\S+@\S+")
#: Sample for the dictionaries: documents per language, and characters of each.
SAMPLE_DOCS, SAMPLE_CHARS = 400, 4000
#: Size of a dictionary.
DICT_BYTES = 96_000
#: A part needs so many words, or characters in scripts without blanks, to be a sentence.
MIN_WORDS, MIN_CHARS = 4, 8
#: The smallest share by which the best language's code must be shorter than the next one's.
MARGIN = 0.08
#: The same for a language other than the document's main one.
SECOND_MARGIN = 0.15


def label_language(c: Column) -> Column:
    """A label's language code, null if it is missing, unknown or names none of the languages."""
    base = F.regexp_extract(F.lower(F.trim(c)), r"^([^-_]+)", 1)
    out = None
    for code, spellings in LABELS.items():
        out = (F.when if out is None else out.when)(base.isin(*spellings.split()), F.lit(code))
    return out


def label_missing(c: Column) -> Column:
    """If a label is missing or says unknown."""
    return c.isNull() | F.lower(F.trim(c)).isin("", "-", "und", "unk", "unknown", "xx", "xxx", "null", "none", "n/a", "na", "zxx", "mis", "mul", "?")


def letters(text: str) -> str:
    """A sentence's letters alone, by which copies with other figures are the same."""
    return _NO_LETTER.sub("", text.lower())


def script(text: str) -> str:
    """The kind of writing: ``hangul``, ``kana`` (any kana), ``han`` or ``other``, whichever holds a quarter of the letters first."""
    size = max(1, len(_LETTER.findall(text)))
    for name, pattern in _SCRIPTS:
        if len(pattern.findall(text)) >= 0.25 * size:
            return name
    return "other"


_WORDS_ENOUGH = regex.compile(rf"\P{{L}}*+(?:\p{{L}}[\p{{L}}\p{{M}}'’]*+\P{{L}}*+){{{MIN_WORDS}}}")
_CHARS_ENOUGH = regex.compile(rf"(?:[^\p{{Han}}\p{{Hiragana}}\p{{Katakana}}]*+[\p{{Han}}\p{{Hiragana}}\p{{Katakana}}]){{{MIN_CHARS}}}")


def _long_enough(part: str) -> bool:
    return bool(_WORDS_ENOUGH.match(part)) or (not part.isascii() and bool(_CHARS_ENOUGH.match(part)))


def sentences(text: str) -> list[str]:
    """The parts of a text that are long enough to be sentences, markup and addresses aside."""
    out = []
    for m in _SENTENCE.findall(_ADDRESS.sub(" ", unmark(text))):
        s = m.strip()
        if _long_enough(s):
            out.append(s)
    return out


_WRITINGS = ("other", *(name for name, _ in _SCRIPTS))


def _writing_table() -> np.ndarray:
    """For each code point the place of its writing in ``_WRITINGS``, beyond them for no letter."""
    kept = sys.__dict__.setdefault("_millrace_writings", {})
    if not kept:
        every = "".join(map(chr, [*range(0xD800), *[0x20] * 0x800, *range(0xE000, 0x110000)]))
        table = np.full(len(every), len(_WRITINGS), np.uint8)
        for k, pattern in enumerate((r"\p{L}+", *(f"{p.pattern}+" for _, p in _SCRIPTS))):
            for m in regex.finditer(pattern, every):
                table[m.start() : m.end()] = k
        kept["table"] = table
    return kept["table"]


def scripts(texts: list[str], least: float) -> list[frozenset[str]]:
    """The kinds of writing that have at least the share ``least`` of each text's letters; ``other`` for a text without letters."""
    plain = frozenset(["other"])
    out = [plain] * len(texts)
    at = [i for i, t in enumerate(texts) if not t.isascii()]
    if not at:
        return out
    kinds = _writing_table()[np.frombuffer("".join(texts[i] for i in at).encode("utf-32-le", "replace"), np.uint32)]
    starts = np.cumsum([0, *(len(texts[i]) for i in at[:-1])])
    counts = np.stack([np.add.reduceat(kinds == k, starts, dtype=np.int64) for k in range(len(_WRITINGS))])
    held = (counts > 0) & (counts >= least * counts.sum(axis=0))
    made = {0: plain}
    for i, code in zip(at, (held * (1 << np.arange(len(_WRITINGS)))[:, None]).sum(axis=0).tolist(), strict=True):
        if code not in made:
            made[code] = frozenset(name for k, name in enumerate(_WRITINGS) if code >> k & 1)
        out[i] = made[code]
    return out


class Languages:
    """Raw-content dictionaries of all languages; the language of a text is the one whose dictionary codes it shortest.

    A text is coded with the dictionaries that hold its kinds of writing (a tenth of their letters at least).
    """

    def __init__(self, samples: dict[str, bytes], level: int = 1) -> None:
        self.samples, self.level = samples, level
        self.held = dict(zip(samples, scripts([x.decode(errors="ignore") for x in samples.values()], 0.1), strict=True))

    def __reduce__(self):
        return Languages, (self.samples, self.level)

    def _coders(self) -> dict[str, zstandard.ZstdCompressor]:
        kept = sys.__dict__.setdefault("_millrace_coders", {})
        key = (self.level, tuple((k, len(v), hash(v)) for k, v in self.samples.items()))
        if key not in kept:
            params = zstandard.ZstdCompressionParameters.from_level(self.level, write_content_size=0, write_checksum=0, write_dict_id=0)
            made = {"": zstandard.ZstdCompressor(compression_params=params)}
            for code, sample in self.samples.items():
                d = zstandard.ZstdCompressionDict(sample, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(compression_params=params)
                made[code] = zstandard.ZstdCompressor(dict_data=d, compression_params=params)
            kept[key] = made
        return kept[key]

    def rank_all(self, texts: list[str], writing: list[frozenset] | None = None) -> list[tuple[str, float]]:
        """Each text's language and the share by which its code is shorter than the next one's (than that without a dictionary, if only one language has its writing)."""
        if not self.samples:
            return [("", 0.0)] * len(texts)
        raw = [t.lower().encode() for t in texts]
        asked: dict[str, list[int]] = {}
        fits: dict[frozenset, list[str]] = {}
        for i, held in enumerate(writing or scripts(texts, 0.25)):
            if held not in fits:
                own = [c for c in self.samples if self.held[c] & held] or list(self.samples)
                fits[held] = own if len(own) > 1 else [*own, ""]
            for code in fits[held]:
                asked.setdefault(code, []).append(i)
        best, least, second = [""] * len(raw), [1 << 60] * len(raw), [1 << 60] * len(raw)
        coders = self._coders()
        for code in sorted(asked):
            at = [i for i in asked[code] if raw[i]]
            if not at:
                continue
            for i, got in zip(at, coders[code].multi_compress_to_buffer([raw[i] for i in at]), strict=True):
                n = len(got)
                if code and n < least[i]:
                    best[i], least[i], second[i] = code, n, min(least[i], second[i])
                elif n < second[i]:
                    second[i] = n
        return [(b, max(0.0, 1 - n / m) if m < 1 << 60 else 0.0) for b, n, m in zip(best, least, second, strict=True)]

    def classify_all(self, texts: list[str], margin: float = MARGIN) -> list[tuple[str | None, float]]:
        return [(code if code and far >= margin else None, far) for code, far in self.rank_all(texts)]

    def classify(self, text: str, margin: float = MARGIN) -> tuple[str | None, float]:
        return self.classify_all([text], margin)[0]


def fit_languages(rows: list[tuple[str, str]], dict_bytes: int = DICT_BYTES, n_chunks: int = 8, chunk_bytes: int = 16_000, rounds: int = 2, max_sentences: int = 1200) -> Languages:
    """Dictionaries from labelled texts, some of them wrongly labelled or mixed.

    Sentences in a script that is rare for their label are left out. Sentences that come again and again (the same
    letters in at least six texts) go to the label that most of them have, each label's texts weighing the same, if it
    has over 0.6 of the weight, and to none that has under 0.3. The rest, at most ``max_sentences`` a label, is cut into
    ``n_chunks`` by the hash of its letters, each with small dictionaries of its own, and a sentence stays if most of
    the other chunks find it in the language of its label: a wrong label would have to be common in most of them.
    After ``rounds`` of that what is left makes the dictionaries. A label of which nothing is left is left out.
    """
    by_label: dict[str, dict[str, list[str]]] = {}
    weight: dict[str, Counter] = {}
    seen: Counter = Counter()
    size = Counter(code for code, _ in rows)
    for code, text in sorted(rows):
        for key, s in {letters(s): s for s in sentences(text)}.items():
            by_label.setdefault(code, {}).setdefault(key, []).append(s)
            weight.setdefault(key, Counter())[code] += 1 / size[code]
            seen[key] += 1
    sure: dict[str, list[str]] = {}
    rest: dict[str, list[tuple[int, str]]] = {}
    for code, keys in by_label.items():
        usual = Counter(script(s) for parts in keys.values() for s in parts)
        spread = sorted((zlib.crc32(key.encode()), key) for key in keys)
        for h, key in spread:
            parts = keys[key]
            if usual[script(parts[0])] < 0.2 * usual.total():
                continue
            if seen[key] >= 6 and (share := weight[key][code] / weight[key].total()) > 0.6:
                sure.setdefault(code, []).extend(list(dict.fromkeys(parts))[:2])
            elif seen[key] >= 6 and share < 0.3:
                continue
            elif len(own := rest.setdefault(code, [])) < max_sentences:
                own.append((h % n_chunks, parts[0]))

    def fitted(most: int, used: dict[str, list[str]]) -> Languages:
        made = {}
        for code in sorted({*sure, *used}):
            own = "\n".join(sure.get(code, [])).lower().encode()[-most // 2 :]
            more = "\n".join(used.get(code, [])).lower().encode()
            if own or more:
                made[code] = more[-(most - len(own)) :] + b"\n" + own
        return Languages(made)

    for _ in range(rounds):
        models = [fitted(chunk_bytes, {code: [s for c, s in parts if c == chunk] for code, parts in rest.items()}) for chunk in range(n_chunks)]
        flat = [(code, c, s) for code, parts in rest.items() for c, s in parts]
        writing = scripts([s for _, _, s in flat], 0.25)
        votes = [0] * len(flat)
        for chunk, m in enumerate(models):
            others = [k for k, x in enumerate(flat) if x[1] != chunk]
            for k, (found, _) in zip(others, m.rank_all([flat[k][2] for k in others], [writing[k] for k in others]), strict=True):
                votes[k] += found == flat[k][0]
        rest = {code: [(c, s) for (own, c, s), n in zip(flat, votes, strict=True) if own == code and 2 * n > n_chunks - 1] for code in rest}
    return fitted(dict_bytes, {code: [s for _, s in parts] for code, parts in rest.items()})


def sample_labelled(docs: DataFrame, label: Column, text: str, doc_id: str, per_language: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS) -> list[tuple[str, str]]:
    """About ``per_language`` labelled texts of each language, at most twice as many in all, chosen and ordered by the hash of their id; of long ones the first ``chars`` characters."""
    rows = docs.select(label.alias("code"), F.pmod(F.xxhash64(doc_id), F.lit(1 << 30)).alias("h"), F.substring(text, 1, chars).alias("t")).where(F.col("code").isNotNull() & F.col("t").isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy("code").count().collect()}  # one row a language
    if not counts:
        return []
    wanted = None
    for code, n in counts.items():
        part = (F.col("code") == code) & (F.col("h") < int(min(1.0, per_language / n) * (1 << 30)))
        wanted = part if wanted is None else wanted | part
    return [(r["code"], r["t"]) for r in rows.where(wanted).orderBy("h", "code", "t").limit(2 * per_language * len(LANGUAGES)).collect()]


_HIDE = (regex.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\Z)", regex.S | regex.I), TAG, _ADDRESS, regex.compile(r"(?<=\])\([^()\s]*\)"), regex.compile(r"&#?\w{1,31};"), regex.compile(r"\\[a-zA-Z]+\*?"))


def spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, what of it is language) of the parts of a text, without gaps: sentences, with anything too short for one put to the part before, or the next if it is the first."""
    bare = text
    for p in _HIDE:
        bare = p.sub(lambda m: " " * len(m.group(0)), bare)
    out: list[list] = []
    start = 0
    for m in [*_SENTENCE.finditer(bare), None]:
        if m is None:
            if out:
                out[-1][1] = len(text)
            elif text:
                out.append([0, len(text), bare.strip()])
            break
        s = m.group(0).strip()
        if _long_enough(s):
            if out:
                out[-1][1] = start = m.start()
            out.append([start if out else 0, m.end(), s])
    return [tuple(x) for x in out]


_PER_CALL = 500


def _segments(batches: Iterator[pa.RecordBatch], model: Languages, margin: float, names: list[str]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for lo in range(0, whole.num_rows, _PER_CALL):
            b = whole.slice(lo, _PER_CALL)
            doc, no, begin, end, parts = [], [], [], [], []
            for i, text in enumerate(b.column(1).to_pylist()):
                for k, (x, y, s) in enumerate(spans(text or "")):
                    doc.append(i)
                    no.append(k)
                    begin.append(x)
                    end.append(y)
                    parts.append(s)
            if doc:
                got = [(code, far) if _LETTER.search(s) else (None, 0.0) for s, (code, far) in zip(parts, model.classify_all(parts, margin), strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(doc)), pa.array(no, pa.int64()), pa.array([c for c, _ in got], pa.string()), pa.array([f for _, f in got], pa.float64()), pa.array(begin, pa.int64()), pa.array(end, pa.int64())], names=names)


def _languages(parts: list[str], found: list[tuple[str | None, float]], margin: float) -> dict[str, list]:
    """Characters, weighted and best confidence of the languages of a text's sentences."""
    got: dict[str, list] = {}
    for s, (code, confidence) in zip(parts, found, strict=True):
        if code:
            x = got.setdefault(code, [0, 0.0, 0.0])
            x[0] += len(s)
            x[1] += confidence * len(s)
            x[2] = max(x[2], confidence)
    main = max(got, key=lambda c: (got[c][0], c), default=None)
    return {c: x for c, x in got.items() if c == main or x[2] >= max(margin, SECOND_MARGIN)}


def _documents(batches: Iterator[pa.RecordBatch], model: Languages, margin: float, names: list[str]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for lo in range(0, whole.num_rows, _PER_CALL):
            b = whole.slice(lo, _PER_CALL)
            texts = b.column(1).to_pylist()
            parts = [sentences(t) if t and _LETTER.search(t) else [] for t in texts]
            found = iter(model.classify_all([s for p in parts for s in p], margin))
            got = [_languages(p, [next(found) for _ in p], margin) for p in parts]
            rest = [i for i, t in enumerate(texts) if t and not got[i] and _LETTER.search(t)]
            joined = [" ".join(_WORD.findall(_ADDRESS.sub(" ", unmark(texts[i])))) for i in rest]
            for i, (code, confidence), s in zip(rest, model.classify_all(joined, margin), joined, strict=True):
                if code and s:
                    got[i] = {code: [len(texts[i]), confidence * len(texts[i]), confidence]}
            order = [sorted(g, key=lambda c: (-g[c][0], c)) for g in got]  # noqa: B023
            sizes = [[g[c][0] for c in o] for g, o in zip(got, order, strict=True)]
            far = [[g[c][1] / g[c][0] for c in o] for g, o in zip(got, order, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(order, pa.list_(pa.string())), pa.array(sizes, pa.list_(pa.int64())), pa.array(far, pa.list_(pa.float64()))], names=names)


def segment_languages(docs: DataFrame, doc_id: str, text: str, model: Languages, margin: float = MARGIN) -> DataFrame:
    """The language of each part of a text: ``doc_id, segment, lang, confidence, start, end``.

    Parts are sentences with what stands around them; ``start`` and ``end`` (not included) are positions in the text, in
    code points, and the parts of a text follow each other without gaps, so nothing of it is in no part. ``confidence``
    is the share by which the best language's code is shorter than the next one's; below ``margin`` the language is
    null, as for parts without letters. Null and empty texts have no parts.
    """
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    names = ["doc_id", "segment", "lang", "confidence", "start", "end"]
    return d.mapInArrow(lambda b: _segments(b, model, margin, names), f"doc_id {d.dtypes[0][1]}, segment bigint, lang string, confidence double, start bigint, end bigint")


def document_languages(docs: DataFrame, doc_id: str, text: str, model: Languages, margin: float = MARGIN) -> DataFrame:
    """The languages of each document, the one with most characters first: ``doc_id, langs, sizes, confidences``.

    A language counts if a whole sentence is in it beyond ``margin``, one that isn't the main language only beyond
    ``SECOND_MARGIN`` too; a text without any such sentence is classed as
    a whole. Texts that are null, empty, without words or too near to several languages have an empty list.
    Every input row gives a row; other columns don't matter.
    """
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    names = ["doc_id", "langs", "sizes", "confidences"]
    return d.mapInArrow(lambda b: _documents(b, model, margin, names), f"doc_id {d.dtypes[0][1]}, langs array<string>, sizes array<bigint>, confidences array<double>")
