"""Text retrieval and entity resolution: tokens, term weights, similarity joins, evaluation."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions.scalar import remove_punctuation, tokens

#: Words left out of term weights by default.
STOP_WORDS = tuple("a about after all also an and any are as at be been but by can did do for from had has have he her his how i if in into is it its me more most my no not of on or our out she so some such than that the their them then there these they this to up us was we were what when where which who will with would you your".split())


def word_counts(df: DataFrame, text: str) -> DataFrame:
    """``word, n`` of a text's words after lower-casing and removing punctuation."""
    return df.select(F.explode(F.split(remove_punctuation(F.col(text)), r"\s+")).alias("word")).where("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def top_words(df: DataFrame, text: str, n: int) -> DataFrame:
    return word_counts(df, text).orderBy(F.desc("n"), "word").limit(n)


def term_frequencies(df: DataFrame, doc: str, text: str, stop: tuple[str, ...] = ()) -> DataFrame:
    """``doc, token, tf``: a token's share of its document's tokens, stop words aside."""
    t = F.filter(tokens(F.col(text)), lambda x: ~x.isin(*stop)) if stop else tokens(F.col(text))
    d = df.select(F.col(doc).alias("doc"), t.alias("t")).withColumn("size", F.size("t"))
    return d.select("doc", "size", F.explode("t").alias("token")).groupBy("doc", "token", "size").agg((F.count(F.lit(1)) / F.col("size")).alias("tf")).drop("size")


def inverse_frequencies(tf: DataFrame, n_docs: int) -> DataFrame:
    """``token, idf`` with ``idf = N / df``, no logarithm."""
    return tf.groupBy("token").agg((F.lit(float(n_docs)) / F.count(F.lit(1))).alias("idf"))


def tf_idf(tf: DataFrame, idf: DataFrame) -> DataFrame:
    return tf.join(idf, "token").select("doc", "token", (F.col("tf") * F.col("idf")).alias("weight"))


def _norms(w: DataFrame) -> DataFrame:
    return w.groupBy("doc").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))


def cosine_join(a: DataFrame, b: DataFrame, max_df: int | None = None) -> DataFrame:
    """``doc_a, doc_b, similarity`` of all pairs with a token in common, over an inverted index.

    Weights travel with the index; tokens are joined, never documents with documents. ``max_df`` leaves out tokens of
    more than so many documents on either side (an approximation that bounds the candidates; None is exact).
    """
    if max_df is not None:
        few = a.unionByName(b).groupBy("token").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") <= 2 * max_df).select("token")
        a_index, b_index = a.join(few, "token"), b.join(few, "token")
    else:
        a_index, b_index = a, b
    hits = a_index.select("token", F.col("doc").alias("doc_a"), F.col("weight").alias("wa")).join(b_index.select("token", F.col("doc").alias("doc_b"), F.col("weight").alias("wb")), "token")
    dots = hits.groupBy("doc_a", "doc_b").agg(F.sum(F.col("wa") * F.col("wb")).alias("dot"))
    na, nb = _norms(a).toDF("doc_a", "na"), _norms(b).toDF("doc_b", "nb")
    return dots.join(na, "doc_a").join(nb, "doc_b").select("doc_a", "doc_b", (F.col("dot") / (F.col("na") * F.col("nb"))).alias("similarity"))


def copy_classes(df: DataFrame, doc: str, text: str) -> DataFrame:
    """``doc, rep``: every document with a text and the first one that has the same tokens or, where there are none, the same text.

    Documents of one class have the same weights, so a similarity join over one of each stands for all of them.
    """
    t = tokens(F.col(text))
    key = F.when(F.size(t) > 0, F.array_join(F.array_sort(t), " ")).otherwise(F.concat(F.lit("="), F.col(text)))
    d = df.where(F.trim(F.col(text)) != "").select(F.col(doc).alias("doc"), key.alias("_key"))
    return d.join(d.groupBy("_key").agg(F.min("doc").alias("rep")), "_key").select("doc", "rep")


def class_sizes(classes: DataFrame) -> DataFrame:
    return classes.groupBy("rep").agg(F.count(F.lit(1)).alias("size"))


def class_weights(df: DataFrame, doc: str, text: str, classes: DataFrame, n_docs: int) -> DataFrame:
    """``doc, token, weight`` of each class's first document, with the weights it has among all documents."""
    sizes = class_sizes(classes)
    tf = term_frequencies(df.join(sizes, F.col(doc) == F.col("rep"), "left_semi"), doc, text)
    idf = tf.join(sizes, F.col("doc") == F.col("rep")).groupBy("token").agg((F.lit(float(n_docs)) / F.sum("size")).alias("idf"))
    return tf_idf(tf, idf)


def class_pairs(weights: DataFrame) -> DataFrame:
    """``doc_a, doc_b, similarity`` of all pairs of classes with a token in common, once each (``doc_a < doc_b``)."""
    return cosine_join(weights, weights).where("doc_a < doc_b")


def similar_classes(weights: DataFrame, threshold: float) -> DataFrame:
    """``doc_a, doc_b, similarity`` of all pairs of classes whose similarity is at least ``threshold`` (above 0), once each.

    Exact, without making the pairs of common tokens: a document's tokens are ordered from rare to common and only the
    first ones are joined, up to where the weight of the rest is too small to reach the threshold with any document.
    Two documents over the threshold have such a token in common, for the rarest one they share is among them.
    """
    df = weights.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    unit = weights.join(df, "token").join(_norms(weights), "doc").select("doc", "token", "df", F.try_divide("weight", "norm").alias("u"))
    rest = Window.partitionBy("doc").orderBy(F.desc("df"), F.desc("token")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = unit.withColumn("rest", F.sum(F.col("u") * F.col("u")).over(rest)).where(F.col("rest") >= threshold * threshold - 1e-9).select("doc", "token")
    pairs = first.toDF("doc_a", "token").join(first.toDF("doc_b", "token"), "token").where("doc_a < doc_b").select("doc_a", "doc_b").distinct()
    vectors = unit.groupBy("doc").agg(F.map_from_entries(F.collect_list(F.struct("token", "u"))).alias("v"))
    both = pairs.join(vectors.toDF("doc_a", "va"), "doc_a").join(vectors.toDF("doc_b", "vb"), "doc_b")
    dot = F.aggregate(F.map_entries("va"), F.lit(0.0), lambda x, e: x + e["value"] * F.coalesce(F.try_element_at("vb", e["key"]), F.lit(0.0)))
    return both.select("doc_a", "doc_b", dot.alias("similarity")).where(F.col("similarity") >= threshold)


def link_counts(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """``doc, rep, links``: every document with its class and to how many other documents it is linked, those of its class and of the classes paired with it."""
    sizes = class_sizes(classes)
    ends = pairs.select(F.col("doc_a").alias("rep"), F.col("doc_b").alias("other")).unionByName(pairs.select(F.col("doc_b").alias("rep"), F.col("doc_a").alias("other")))
    across = ends.join(sizes.toDF("other", "n"), "other").groupBy("rep").agg(F.sum("n").alias("n"))
    return classes.join(sizes, "rep").join(across, "rep", "left").select("doc", "rep", (F.col("size") - 1 + F.coalesce("n", F.lit(0))).alias("links"))


def expand_pairs(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """All pairs of documents (``doc_a < doc_b``) that pairs of classes stand for, and those within a class, of similarity 1."""
    a, b = classes.toDF("_a", "doc_a"), classes.toDF("_b", "doc_b")
    across = pairs.join(a, "doc_a").join(b, "doc_b").select(F.least("_a", "_b").alias("doc_a"), F.greatest("_a", "_b").alias("doc_b"), "similarity")
    within = classes.toDF("doc_a", "rep").join(classes.toDF("doc_b", "rep"), "rep").where("doc_a < doc_b").select("doc_a", "doc_b", F.lit(1.0).alias("similarity"))
    return across.unionByName(within)


def pair_counts(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """``doc_a, doc_b, similarity, n``: pairs of classes with the number of document pairs they stand for; a class with itself has similarity 1."""
    sizes = class_sizes(classes)
    across = pairs.join(sizes.toDF("doc_a", "_na"), "doc_a").join(sizes.toDF("doc_b", "_nb"), "doc_b").select("doc_a", "doc_b", "similarity", (F.col("_na") * F.col("_nb")).alias("n"))
    within = sizes.where("size > 1").select(F.col("rep").alias("doc_a"), F.col("rep").alias("doc_b"), F.lit(1.0).alias("similarity"), (F.col("size") * (F.col("size") - 1) / 2).cast("bigint").alias("n"))
    return across.unionByName(within)


def same_counts(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """``pairs`` with ``m``, how many of each row's document pairs share their label; ``labels`` is ``rep, label, size``, without nulls."""
    a, b = labels.toDF("doc_a", "_label", "_a"), labels.toDF("doc_b", "_label", "_b")
    both = F.when(F.col("doc_a") == F.col("doc_b"), F.col("_a") * (F.col("_a") - 1) / 2).otherwise(F.col("_a") * F.col("_b")).cast("bigint")
    m = pairs.select("doc_a", "doc_b").join(a, "doc_a").join(b, ["doc_b", "_label"]).groupBy("doc_a", "doc_b").agg(F.sum(both).alias("m"))
    return pairs.join(m, ["doc_a", "doc_b"], "left").na.fill(0, ["m"])


def threshold_curve(pairs: DataFrame, similarity: str, is_match: str, n_true: int, bins: int = 100, weight: str | None = None) -> DataFrame:
    """Precision, recall and F at each of ``bins`` thresholds, from one histogram and reverse cumulative sums.

    With ``weight`` a row stands for so many pairs, and ``is_match`` is how many of them match.
    """
    g = pairs.groupBy(F.least(F.floor(F.col(similarity) * bins), F.lit(bins - 1)).cast("bigint").alias("bin")).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("n"), F.sum(F.col(is_match).cast("bigint")).alias("m"))
    w = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, Window.currentRow)  # at most `bins` rows
    c = g.withColumns({"tp": F.sum("m").over(w), "all": F.sum("n").over(w)})
    precision, recall = F.col("tp") / F.col("all"), F.col("tp") / F.lit(float(max(n_true, 1)))
    return c.select((F.col("bin") / bins).alias("threshold"), precision.alias("precision"), recall.alias("recall"), F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0)).alias("f"))


def similarity_histogram(pairs: DataFrame, similarity: str, bins: int = 100, weight: str | None = None) -> DataFrame:
    return pairs.groupBy(F.floor(F.col(similarity) * bins).cast("bigint").alias("bin")).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("n"))


def html_to_text(c: Column) -> Column:
    """Tags become commas between the trimmed pieces of text; references of the common five are resolved."""
    t = F.regexp_replace(F.regexp_replace(c, r"(?is)<(script|style)[^>]*>.*?</\1>|<!--.*?-->", ""), r"<[^>]+>", "\u0001")
    parts = F.filter(F.transform(F.split(t, "\u0001"), lambda x: F.trim(x)), lambda x: x != "")
    out = F.array_join(parts, ",")
    for name, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        out = F.replace(out, F.lit(name), F.lit(sign))
    return out


def element_texts(c: Column, name: str) -> Column:
    """The texts of all elements ``name``, in order, inner tags taken away."""
    found = F.regexp_extract_all(c, F.lit(rf"(?is)<{name}(?:\s[^>]*)?>(.*?)</{name}>"), F.lit(1))
    return F.transform(found, lambda x: F.trim(F.regexp_replace(x, "<[^>]+>", "")))


def normalise_mail(c: Column) -> Column:
    """Lower case; tags, numbers, addresses and ``$`` become marker words."""
    t = F.lower(c)
    for pattern, word in ((r"<[^<>]+>", " "), (r"[0-9]+", "number"), (r"(http|https)://[^\s]*", "httpaddr"), (r"[^\s]+@[^\s]+", "emailaddr"), (r"[$]+", "dollar")):
        t = F.regexp_replace(t, pattern, word)
    return t


_VOWEL = "aeiou"


def stem(word: str) -> str:
    """Stem of an English word by the rules Porter published in 1980."""
    if len(word) < 3:
        return word

    def consonant(w: str, i: int) -> bool:
        return w[i] not in _VOWEL and (w[i] != "y" or i == 0 or not consonant(w, i - 1))

    def measure(w: str) -> int:
        s = "".join("c" if consonant(w, i) else "v" for i in range(len(w)))
        return sum(s[i : i + 2] == "vc" for i in range(len(s) - 1))

    def vowel(w: str) -> bool:
        return any(not consonant(w, i) for i in range(len(w)))

    def double(w: str) -> bool:
        return len(w) > 1 and w[-1] == w[-2] and consonant(w, len(w) - 1)

    def cvc(w: str) -> bool:
        n = len(w)
        return n > 2 and consonant(w, n - 1) and not consonant(w, n - 2) and consonant(w, n - 3) and w[-1] not in "wxy"

    w = word
    for end, new in (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")):
        if w.endswith(end):
            w = w[: len(w) - len(end)] + new
            break
    if w.endswith("eed"):
        w = w[:-1] if measure(w[:-3]) > 0 else w
    else:
        for end in ("ed", "ing"):
            if w.endswith(end) and vowel(w[: -len(end)]):
                w = w[: -len(end)]
                if w.endswith(("at", "bl", "iz")):
                    w += "e"
                elif double(w) and w[-1] not in "lsz":
                    w = w[:-1]
                elif measure(w) == 1 and cvc(w):
                    w += "e"
                break
    if w.endswith("y") and vowel(w[:-1]):
        w = w[:-1] + "i"
    for least, rules in ((0, _STEP2), (0, _STEP3), (1, _STEP4)):
        for end, new in rules:
            if w.endswith(end):
                root = w[: len(w) - len(end)]
                if measure(root) > least and (end != "ion" or root.endswith(("s", "t"))):
                    w = root + new
                break
    if w.endswith("e") and (measure(w[:-1]) > 1 or (measure(w[:-1]) == 1 and not cvc(w[:-1]))):
        w = w[:-1]
    return w[:-1] if w.endswith("ll") and measure(w) > 1 else w


#: The suffixes of the published algorithm's steps 2, 3 and 4.
_STEP2 = (("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"))
_STEP3 = (("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""))
_STEP4 = tuple((x, "") for x in ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize"))


def stems(df: DataFrame, word: str) -> DataFrame:
    """``df`` with the column ``stem``; each distinct word is stemmed once."""
    words = df.select(F.col(word).alias("_w")).where("_w is not null").distinct()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(stem=[stem(w) for w in b["_w"]])

    return df.join(words.mapInPandas(run, "_w string, stem string"), F.col(word) == F.col("_w"), "left").drop("_w")


def bigrams(c: Column) -> Column:
    """Character pairs of the CJK runs of a text, the fallback where no word segmentation is at hand; tokens with digits and single characters are left out."""
    runs = F.regexp_extract_all(c, F.lit(r"([\x{4E00}-\x{9FFF}]{2,})"), F.lit(1))
    return F.flatten(F.transform(runs, lambda r: F.transform(F.sequence(F.lit(1), F.length(r) - 1), lambda i: F.substr(r, i, F.lit(2)))))


def indicator_rows(df: DataFrame, doc: str, text: str, vocabulary: DataFrame) -> DataFrame:
    """``doc, index`` for each vocabulary word (``word, index``) that occurs in the normalised, stemmed text."""
    t = df.select(F.col(doc).alias("doc"), F.explode(F.array_distinct(tokens(normalise_mail(F.col(text))))).alias("token"))
    return stems(t, "token").join(vocabulary, F.col("stem") == F.col("word")).select("doc", "index").distinct()
