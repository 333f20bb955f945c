"""Passages of test items in a corpus: Wu-Manber search for many patterns at once."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from millrace.functions.text import WORD_CHAR, fold, unmark, words

#: Languages written without blanks, whose passages are counted in characters.
UNSPACED = ("zh", "ja")


class WuManber:
    """Finds patterns of one length in sequences of symbols (a list of words, or a string).

    ``shift`` tells for each block of two symbols how far the window may move without missing a pattern (blocks in
    no pattern: over all but one of the window's symbols). Where it is 0 the block is some pattern's end: the
    patterns of that bucket with the window's first symbol are compared with the window symbol by symbol.
    """

    def __init__(self, length: int, patterns: dict[Sequence, tuple]) -> None:
        self.length = length
        self.shift: dict = {}
        self.bucket: dict = {}
        for p, found in patterns.items():
            for end in range(2, length + 1):
                block = p[end - 2 : end]
                if self.shift.get(block, length) > length - end:
                    self.shift[block] = length - end
            self.bucket.setdefault(p[-2:], {}).setdefault(p[0], []).append((p, found))

    def search(self, text: Sequence) -> Iterator[tuple[int, tuple]]:
        """(position of the first symbol, what was given with the pattern) of every occurrence; ``text`` is of the patterns' type."""
        length, shift, skip, size = self.length, self.shift, self.length - 1, len(text)
        at = length
        while at <= size:
            block = text[at - 2 : at]
            far = shift.get(block, skip)
            if far:
                at += far
                continue
            for p, found in self.bucket[block].get(text[at - length], ()):
                if text[at - length : at] == p:
                    yield at - length, found
            at += 1


def passages(items: list[tuple], n_words: int, n_chars: int) -> tuple[WuManber, WuManber]:
    """Every window of each item (id, language, text): ``n_words`` words, or ``n_chars`` letters and digits where the language has no blanks."""
    by_word: dict[tuple, set] = {}
    by_char: dict[str, set] = {}
    for item, lang, text in items:
        plain = fold(unmark(text or ""))
        if lang in UNSPACED:
            s = WORD_CHAR.sub("", plain)
            for i in range(len(s) - n_chars + 1):
                by_char.setdefault(s[i : i + n_chars], set()).add(item)
        else:
            w = tuple(words(plain))
            for i in range(len(w) - n_words + 1):
                by_word.setdefault(w[i : i + n_words], set()).add(item)
    freeze = lambda d: {p: tuple(sorted(x)) for p, x in d.items()}
    return WuManber(n_words, freeze(by_word)), WuManber(n_chars, freeze(by_char))


def _scan(batches: Iterator[pa.RecordBatch], by_word: WuManber, by_char: WuManber, names: list[str], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    for b in batches:
        doc, item, hits = [], [], []
        for i, text in enumerate(b.column(1).to_pylist()):
            if not text:
                continue
            plain = fold(unmark(text))
            count: dict = {}
            if by_word.bucket:
                for _, found in by_word.search(tuple(words(plain))):
                    for x in found:
                        count[x] = count.get(x, 0) + 1
            if by_char.bucket and not plain.isascii():
                for _, found in by_char.search(WORD_CHAR.sub("", plain)):
                    for x in found:
                        count[x] = count.get(x, 0) + 1
            doc += [i] * len(count)
            item += count.keys()
            hits += count.values()
        if doc:
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(doc)), pa.array(item, kind), pa.array(hits, pa.int64())], names=names)


def _hashes(symbols: np.ndarray, length: int) -> np.ndarray:
    """A hash of each window of ``length`` symbols, given theirs."""
    if len(symbols) < length:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(symbols) - length + 1, np.uint64)
    for k in range(length):
        out = out * np.uint64(0x9E3779B97F4A7C15) + symbols[k : k + len(out)]
    return out ^ (out >> np.uint64(29))


def _symbols(words_or_text: Sequence) -> np.ndarray:
    if isinstance(words_or_text, str):
        return np.frombuffer(words_or_text.encode("utf-32-le"), np.uint32).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words_or_text), np.uint64, len(words_or_text))


def _windows(text: str | None, unspaced: bool, n_words: int, n_chars: int) -> tuple[Sequence, np.ndarray, int]:
    """A text's symbols, the hashes of its windows, and their length."""
    plain = fold(unmark(text or ""))
    own = WORD_CHAR.sub("", plain) if unspaced else words(plain)
    length = n_chars if unspaced else n_words
    return own, _hashes(_symbols(own), length), length


def _item_windows(batches: Iterator[pa.RecordBatch], n_words: int, n_chars: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        at, found, passage = [], [], []
        for i, (lang, text) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)):
            own, h, length = _windows(text, lang in UNSPACED, n_words, n_chars)
            at += [i] * len(h)
            found.append(h)
            passage += [own[k : k + length] if isinstance(own, str) else " ".join(own[k : k + length]) for k in range(len(h))]
        if at:
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), pa.array(np.concatenate(found).view(np.int64)), pa.array(passage)], names=names)


def _likely(batches: Iterator[pa.RecordBatch], bits: Broadcast, n_words: int, n_chars: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """The windows of each document that the bitmap of the items' hashes lets through."""
    table = bits.value
    mask = np.uint64(len(table) * 64 - 1)
    for b in batches:
        at, found, passage = [], [], []
        for i, text in enumerate(b.column(1).to_pylist()):
            for unspaced in (False, True):
                if not text or (unspaced and text.isascii()):
                    continue
                own, h, length = _windows(text, unspaced, n_words, n_chars)
                slot = h & mask
                hits = np.flatnonzero((table[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1))
                at += [i] * len(hits)
                found.append(h[hits])
                passage += [own[k : k + length] if unspaced else " ".join(own[k : k + length]) for k in hits]
        if at:
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), pa.array(np.concatenate(found).view(np.int64)), pa.array(passage)], names=names)


def _many_leaks(d: DataFrame, items: DataFrame, n_words: int, n_chars: int, log_bits: int) -> DataFrame:
    """As ``find_leaks`` for items of any number and size: one pass over the documents, which the items never leave their executors for.

    The items' window hashes set the bits of one bitmap of 2 ** ``log_bits`` bits, the only thing that goes to every
    task. Windows of documents whose bit is set are shuffled by their hash, after copies of an item's window are put
    together, and compared with the items' windows symbol by symbol.
    """
    spark = d.sparkSession
    kind = items.schema[0].dataType.simpleString()
    windows = items.mapInArrow(lambda b: _item_windows(b, n_words, n_chars, ["item_id", "h", "passage"]), f"item_id {kind}, h bigint, passage string").distinct()
    slot = F.col("h").bitwiseAND(F.lit((1 << log_bits) - 1))
    words_ = windows.select(F.shiftright(slot, 6).alias("word"), F.expr(f"shiftleft(1L, cast((h & {(1 << log_bits) - 1}) % 64 as int))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    table = np.zeros(max(1, (1 << log_bits) // 64), np.uint64)
    for b in words_.toArrow().to_batches():  # at most 2 ** (log_bits - 6) rows of 16 bytes
        table[b.column(0).to_numpy()] = b.column(1).to_numpy().view(np.uint64)
    bits = spark.sparkContext.broadcast(table)
    likely = d.mapInArrow(lambda b: _likely(b, bits, n_words, n_chars, ["doc_id", "h", "passage"]), f"doc_id {dict(d.dtypes)['doc_id']}, h bigint, passage string")
    return likely.join(windows, ["h", "passage"]).groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("n_windows"))


def find_leaks(docs: DataFrame, items: DataFrame, doc_id: str, text: str, item_id: str, item_lang: str, item_text: str, n_words: int = 10, n_chars: int = 20, max_chars: int = 20_000_000, log_bits: int = 28) -> DataFrame:
    """Every document with the items of which it holds a passage: ``doc_id, item_id, n_windows``.

    A passage is ``n_words`` consecutive words of an item (runs of letters or digits), or ``n_chars`` consecutive
    letters or digits of an item in a language without blanks; case, punctuation, blanks, markup, invisible
    characters, width and Unicode form don't matter, on either side. ``n_windows`` counts the matching windows, so a
    passage of 14 words counts 5. Null and empty texts and items shorter than a passage match nothing; repeated
    documents each get rows (with their windows added up where the items are too large for one task); a repeated item
    counts once; empty tables give none; other columns don't matter.

    The documents are read once, whole texts in Arrow batches, without a shuffle: the items' tables of block shifts
    and buckets go to every task. Where the items have more than ``max_chars`` characters together, a bitmap of
    2 ** ``log_bits`` bits of them goes instead, and just the windows it lets through are shuffled; still in one pass.
    """
    own = items.select(F.col(item_id).alias("item_id"), F.col(item_lang).alias("lang"), F.col(item_text).alias("text")).where("item_id is not null")
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    if (own.agg(F.sum(F.length("text"))).first()[0] or 0) > max_chars:
        return _many_leaks(d, own, n_words, n_chars, log_bits)
    by_word, by_char = passages([tuple(r) for r in own.collect()], n_words, n_chars)
    names = ["doc_id", "item_id", "n_windows"]
    arrow = to_arrow_type(own.schema["item_id"].dataType)
    return d.mapInArrow(lambda b: _scan(b, by_word, by_char, names, arrow), f"doc_id {dict(d.dtypes)['doc_id']}, item_id {own.schema['item_id'].dataType.simpleString()}, n_windows bigint")
