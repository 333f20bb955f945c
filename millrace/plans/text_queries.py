"""Queries over texts, and their SQL. Tokens and words are of ASCII letters and digits; documents of every language and label count."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions import scalar as fn
from millrace.operators import textir as ir
from millrace.plans.tables import table
from millrace.session import ensure_checkpoint_dir


#: From which similarity on titles are linked.
SIMILAR = 0.9


def _docs(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").select("doc_id", "text")


def word_count_top(s, d):
    return ir.top_words(_docs(s, d), "text", 15)


def words_per_unique(s, d):
    return ir.word_counts(_docs(s, d), "text").agg(F.count(F.lit(1)).alias("unique_words"), F.round(F.avg("n"), 4).alias("mean"))


def token_df(s, d):
    return ir.term_frequencies(_docs(s, d), "doc_id", "text", ir.STOP_WORDS).groupBy("token").agg(F.count(F.lit(1)).alias("df"))


def term_frequency(s, d):
    return ir.term_frequencies(_docs(s, d), "doc_id", "text").withColumn("tf", F.round("tf", 8))


def _weights(s, d) -> DataFrame:
    docs = _docs(s, d)
    tf = ir.term_frequencies(docs, "doc_id", "text", ir.STOP_WORDS)
    return ir.tf_idf(tf, ir.inverse_frequencies(tf, docs.count()))


def tf_idf(s, d):
    return _weights(s, d).withColumn("weight", F.round("weight", 6))


def _titles(s, d) -> tuple[DataFrame, DataFrame]:
    """Weights of classes of equal titles, and each article's class."""
    titles = table(s, d, "articles_half_a").where("title is not null").select(F.col("article_id").alias("id"), F.col("title").alias("t"))
    ensure_checkpoint_dir(s)
    classes = ir.copy_classes(titles, "id", "t").checkpoint()  # both are read several times
    return ir.class_weights(titles, "id", "t", classes, titles.count()).checkpoint(), classes


def _title_pairs(s, d) -> tuple[DataFrame, DataFrame]:
    """Pairs of classes of equal titles over the inverted index, and each article's class."""
    weights, classes = _titles(s, d)
    return ir.class_pairs(weights), classes


def cosine_pairs(s, d):
    """Pairs of classes of similar article titles, each class by its first article (``cosine_links`` has their members)."""
    return ir.similar_classes(_titles(s, d)[0], SIMILAR).withColumn("similarity", F.round("similarity", 6))


def cosine_links(s, d):
    """Every article with a title: its class of equal titles, and how many other articles have an equal or similar one."""
    weights, classes = _titles(s, d)
    return ir.link_counts(ir.similar_classes(weights, SIMILAR), classes)


def pair_means(s, d):
    """Mean similarity of article titles with a token in common: of one author (the gold standard) and of different ones."""
    pairs, classes = _title_pairs(s, d)
    art = table(s, d, "articles_half_a").where("author is not null").select(F.col("article_id").alias("doc"), "author")
    labels = classes.join(art, "doc").groupBy("rep", "author").agg(F.count(F.lit(1)).alias("size"))
    p = ir.same_counts(ir.pair_counts(pairs, classes), labels)
    part = lambda n: F.round(F.try_divide(F.sum(F.col("similarity") * n), F.sum(n)), 6)
    return p.agg(part(F.col("m")).alias("mean_true"), part(F.col("n") - F.col("m")).alias("mean_other"), F.sum("m").cast("bigint").alias("n_true"), F.sum(F.col("n") - F.col("m")).cast("bigint").alias("n_other"))


def precision_recall_curve(s, d):
    """Titles' similarity as evidence that two articles share their author, by threshold."""
    pairs, classes = _title_pairs(s, d)
    art = table(s, d, "articles_half_a").where("author is not null").select(F.col("article_id").alias("doc"), "author")
    labels = classes.join(art, "doc").groupBy("rep", "author").agg(F.count(F.lit(1)).alias("size"))
    p = ir.same_counts(ir.pair_counts(pairs.withColumn("similarity", F.round("similarity", 6)), classes), labels)
    n_true = art.groupBy("author").agg(F.count(F.lit(1)).alias("n")).agg(F.sum(F.col("n") * (F.col("n") - 1) / 2)).first()[0]
    c = ir.threshold_curve(p, "similarity", "m", int(n_true or 0), weight="n")
    return c.select("threshold", *[F.round(x, 6).alias(x) for x in ("precision", "recall", "f")])


def similarity_histogram(s, d):
    p = ir.pair_counts(*_title_pairs(s, d)).withColumn("similarity", F.round("similarity", 6))
    return ir.similarity_histogram(p, "similarity", weight="n")


def biggest_record(s, d):
    n = _docs(s, d).select("doc_id", F.size(fn.tokens(F.col("text"))).cast("bigint").alias("n_tokens"))
    return n.orderBy(F.desc("n_tokens"), "doc_id").limit(1)


def html_to_text(s, d):
    return table(s, d, "articles_half_a").where("content is not null").select("article_id", ir.html_to_text(F.col("content")).alias("text"))


def xpath_headings(s, d):
    return table(s, d, "articles_half_a").select("article_id", F.explode(ir.element_texts(F.col("content"), "h1")).alias("heading"))


def tag_rows(s, d):
    """Comma lists of tags as rows, with each tag's count."""
    t = table(s, d, "articles_half_a").select(F.explode(F.split("tags", ",")).alias("tag"), "article_id")
    return t.groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


def mail_normalised(s, d):
    return _docs(s, d).select("doc_id", ir.normalise_mail(F.col("text")).alias("text"))


def stem_counts(s, d):
    w = ir.word_counts(_docs(s, d), "text").where(F.col("word").rlike("^[a-z]+$"))
    return ir.stems(w, "word").groupBy("stem").agg(F.sum("n").alias("n"))


def cjk_bigrams(s, d):
    """The commonest character pairs of article titles."""
    t = table(s, d, "articles_half_a").where("title is not null").select(F.explode(ir.bigrams(F.col("title"))).alias("pair"))
    return t.groupBy("pair").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "pair").limit(50)


def vocabulary_rows(s, d):
    v = ir.stems(ir.top_words(_docs(s, d), "text", 200), "word").select("stem").distinct()
    from pyspark.sql import Window

    v = v.select(F.col("stem").alias("word"), F.row_number().over(Window.orderBy("stem")).cast("bigint").alias("index"))  # at most 200 rows
    return ir.indicator_rows(_docs(s, d), "doc_id", "text", v).groupBy("index").agg(F.count(F.lit(1)).alias("docs"))


def title_term_matrix(s, d):
    """0/1 columns for the ten commonest title words."""
    top = [r[0] for r in ir.top_words(table(s, d, "articles_half_a").where("title is not null"), "title", 10).collect()]
    t = table(s, d, "articles_half_a").where("title is not null").select("article_id", fn.tokens(F.col("title")).alias("t"))
    return t.select("article_id", *[F.array_contains("t", w).cast("bigint").alias(f"w{i}") for i, w in enumerate(top)])


def array_features(s, d):
    """Norm, spread, rescaled head, tile and block sums of embeddings."""
    e = table(s, d, "embeddings").withColumn("e", F.transform("embedding", lambda x: x.cast("double")))
    return e.select("vec_id", F.round(fn.norm(F.col("e")), 5).alias("norm"), F.round(fn.array_std(F.col("e")), 5).alias("sd"), F.round(F.element_at(fn.tile_sums(F.col("e"), 4), 2), 5).alias("tile2"), F.round(F.element_at(fn.block_sums(F.col("e"), 4), 1), 5).alias("block1"), F.size(fn.two_way_interactions(F.slice("e", 1, 3))).cast("bigint").alias("n_inter"))


def rotations(s, d):
    return table(s, d, "nation").select("n_name", fn.rotate_span(F.col("n_name"), 1, 4, 3).alias("turned"), fn.zero_padded(F.col("n_nationkey")).alias("padded"))


def congruential_numbers(s, d):
    return table(s, d, "region").select(F.col("r_regionkey").cast("bigint").alias("k"), F.explode(fn.congruential(F.col("r_regionkey"), 5, 3, 16, 6)).alias("x")).groupBy("k").agg(F.sum("x").alias("total"))


def power_buckets(s, d):
    c = table(s, d, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("c"))
    return c.groupBy(fn.power_bucket(F.col("c")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


QUERIES = {f.__name__: f for f in (word_count_top, words_per_unique, token_df, term_frequency, tf_idf, cosine_pairs, cosine_links, pair_means, precision_recall_curve, similarity_histogram, biggest_record, html_to_text, xpath_headings, tag_rows, mail_normalised, stem_counts, cjk_bigrams, vocabulary_rows, title_term_matrix, array_features, rotations, congruential_numbers, power_buckets)}

_TOK = "list_filter(string_split_regex(lower({c}), '[^A-Za-z0-9_]+'), lambda x: x <> '')"
_TITLE_TOKENS = _TOK.format(c="title")
_DOCS = "d as (select doc_id, text from documents)"
_WORDS = f"with {_DOCS}, w as (select unnest(string_split_regex(trim(lower(regexp_replace(text, '[^\\sa-zA-Z0-9]', '', 'g'))), '\\s+')) as word from d), c as (select word, count(*)::bigint as n from w where word <> '' group by 1)"
_STOP = "(" + ", ".join(f"'{w}'" for w in ir.STOP_WORDS) + ")"


def _tf(source: str, key: str, text: str, stop: bool) -> str:
    drop = f"list_filter({_TOK.format(c=text)}, lambda x: x not in {_STOP})" if stop else _TOK.format(c=text)
    return f"k as (select {key} as doc, {drop} as t from {source}), u as (select doc, len(t) as size, unnest(t) as token from k), tf as (select doc, token, count(*) / any_value(size)::double as tf from u group by 1, 2)"


_SIDES = f"""with a0 as (select article_id, title, author from articles_half_a where title is not null),
 {_tf('a0', 'article_id', 'title', False)}, idf as (select token, (select count(*) from a0) / count(*)::double as idf from tf group by 1), w as (select doc, token, tf * idf as weight from tf join idf using (token)),
 n as (select doc, sqrt(sum(weight * weight)) as norm from w group by 1),
 own as (select article_id as doc, author, title, {_TOK.format(c='title')} as t from a0 where trim(title) <> ''),
 cls as (select doc, author, t, min(doc) over (partition by case when len(t) > 0 then array_to_string(list_sort(t), ' ') else concat('=', title) end) as rep from own),
 dots as (select x.doc as doc_a, y.doc as doc_b, sum(x.weight * y.weight) / (any_value(nx.norm) * any_value(ny.norm)) as similarity from w x join w y using (token) join n nx on nx.doc = x.doc join n ny on ny.doc = y.doc where x.doc < y.doc group by 1, 2),
 p as (select doc_a, doc_b, case when a.rep = b.rep then 1.0 else similarity end as similarity, a.rep as rep_a, b.rep as rep_b, coalesce(a.author = b.author, false) as same from dots join cls a on a.doc = doc_a join cls b on b.doc = doc_b
  union all select a.doc, b.doc, 1.0, a.rep, b.rep, coalesce(a.author = b.author, false) from cls a join cls b on a.rep = b.rep and a.doc < b.doc where len(a.t) = 0)"""
SQL = {
    "word_count_top": f"{_WORDS} select * from c order by n desc, word limit 15",
    "words_per_unique": f"{_WORDS} select count(*)::bigint as unique_words, round(avg(n), 4) as mean from c",
    "token_df": f"with {_DOCS}, {_tf('d', 'doc_id', 'text', True)} select token, count(*)::bigint as df from tf group by 1",
    "term_frequency": f"with {_DOCS}, {_tf('d', 'doc_id', 'text', False)} select doc, token, round(tf, 8) as tf from tf",
    "tf_idf": f"with {_DOCS}, {_tf('d', 'doc_id', 'text', True)}, idf as (select token, (select count(*) from d) / count(*)::double as idf from tf group by 1) select doc, token, round(tf * idf, 6) as weight from tf join idf using (token)",
    "cosine_pairs": f"{_SIDES} select distinct least(rep_a, rep_b) as doc_a, greatest(rep_a, rep_b) as doc_b, round(similarity, 6) as similarity from p where rep_a <> rep_b and similarity >= {SIMILAR}",
    "cosine_links": f"{_SIDES}, l as (select doc_a as doc from p where similarity >= {SIMILAR} union all select doc_b from p where similarity >= {SIMILAR}), c as (select doc, count(*) as links from l group by 1) select cls.doc, rep, coalesce(links, 0)::bigint as links from cls left join c using (doc)",
    "pair_means": f"{_SIDES} select round(avg(similarity) filter (same), 6) as mean_true, round(avg(similarity) filter (not same), 6) as mean_other, (count(*) filter (same))::bigint as n_true, (count(*) filter (not same))::bigint as n_other from p",
    "similarity_histogram": f"{_SIDES} select floor(round(similarity, 6) * 100)::bigint as bin, count(*)::bigint as n from p group by 1",
    "precision_recall_curve": f"{_SIDES}, q as (select least(floor(round(similarity, 6) * 100), 99)::bigint as bin, same from p), g as (select bin, count(*) as n, count(*) filter (same) as m from q group by 1), c as (select bin, (sum(m) over w)::double as tp, (sum(n) over w)::double as al from g window w as (order by bin desc)), a1 as (select author, count(*) as n from articles_half_a where author is not null group by 1), y as (select sum(n * (n - 1) / 2) as every from a1) select bin / 100.0::double as threshold, round(tp / al, 6) as precision, round(tp / every, 6) as recall, round(coalesce(2 * (tp / al) * (tp / every) / nullif(tp / al + tp / every, 0), 0), 6) as f from c, y",
    "biggest_record": f"with {_DOCS} select doc_id, len({_TOK.format(c='text')})::bigint as n_tokens from d order by n_tokens desc, doc_id limit 1",
    "title_term_matrix": f"with d as (select title as text from articles_half_a where title is not null), w as (select unnest(string_split_regex(trim(lower(regexp_replace(text, '[^\\sa-zA-Z0-9]', '', 'g'))), '\\s+')) as word from d), c as (select word, count(*) as n from w where word <> '' group by 1 order by n desc, word limit 10), top as (select list(word order by n desc, word) as l from c) select article_id, {', '.join(f'list_contains({_TITLE_TOKENS}, l[{i + 1}])::bigint as w{i}' for i in range(10))} from articles_half_a, top where title is not null",
    "tag_rows": "select tag, count(*)::bigint as n from (select unnest(string_split(tags, ',')) as tag from articles_half_a) group by 1",
    "html_to_text": "select article_id, replace(replace(replace(replace(replace(array_to_string(list_filter(list_transform(string_split(regexp_replace(regexp_replace(regexp_replace(regexp_replace(content, '(?is)<script[^>]*>.*?</script>', '', 'g'), '(?is)<style[^>]*>.*?</style>', '', 'g'), '(?s)<!--.*?-->', '', 'g'), '<[^>]+>', chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> ''), ','), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&') as text from articles_half_a where content is not null",
    "xpath_headings": "select article_id, trim(regexp_replace(unnest(regexp_extract_all(content, '(?is)<h1(?:\\s[^>]*)?>(.*?)</h1>', 1)), '<[^>]+>', '', 'g')) as heading from articles_half_a",
    "mail_normalised": f"with {_DOCS} select doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(text), '<[^<>]+>', ' ', 'g'), '[0-9]+', 'number', 'g'), '(http|https)://[^\\s]*', 'httpaddr', 'g'), '[^\\s]+@[^\\s]+', 'emailaddr', 'g'), '[$]+', 'dollar', 'g') as text from d",
    "array_features": "with e as (select vec_id, embedding::double[] as e from embeddings), m as (select *, list_avg(e) as m from e) select vec_id, round(sqrt(list_sum(list_transform(e, lambda x: x * x))), 5) as norm, round(sqrt(list_sum(list_transform(e, lambda x: (x - m) * (x - m))) / len(e)), 5) as sd, round(list_sum(list_transform(range(0, len(e) // 4), lambda k: e[k * 4 + 2])), 5) as tile2, round(e[1] + e[2] + e[3] + e[4], 5) as block1, 12::bigint as n_inter from m",
    "rotations": "select n_name, concat(n_name[2:4], n_name[1], n_name[5:]) as turned, printf('%020.4f', n_nationkey::double) as padded from nation",
    "congruential_numbers": "with recursive g(k, i, x) as (select r_regionkey::bigint, 0, r_regionkey::bigint from region union all select k, i + 1, (5 * x + 3) % 16 from g where i < 6) select k, sum(x)::bigint as total from g where i > 0 group by 1",
    "power_buckets": "with c as (select l_partkey, count(*) as c from lineitem group by 1) select case when c > 1024 then -1 else pow(2, ceil(log2(c)))::bigint end as bucket, count(*)::bigint as n from c group by 1",
}
