"""Queries over all of their tables, by brute force on small ones."""

import datetime as dt
import math
import re
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from millrace.operators import dtree, textir as ir
from millrace.plans import registry

ARTICLES = [
    (2, "ann", "red tea from hills"), (4, "ann", "red tea from hills"), (6, "bob", "Red tea, from hills!"), (7, "ann", "green tea"), (9, None, "green tea cups"), (11, None, "green tea cups"),
    (12, "bob", "旅行"), (14, "bob", "旅行"), (15, "cat", "旅"), (16, "ann", None), (18, "cat", ""), (20, "cat", ""), (21, "bob", "blue cups"), (23, "cat", "one two one"), (25, "cat", "one one two"), (27, "ann", "one two two"),
]
DOCUMENTS = [
    (1, "The cats ran, the dogs ran home.", "en"), (2, "Running cats at a@b.example cost $5", "English"), (3, "cats http://c.example/x <b>jump</b> 12 times", None), (4, "Le chat noir et les CATS", "fr"),
    (5, "旅行 tokyo 2024 旅行", "zh"), (6, "", "und"), (7, "Über cafés, naïve cats; İzmir", "de"), (8, None, "en"), (9, "cats\tcats\ncats_1 cats-2 it's the the the the the the end of it all", "EN"),
]
EVENTS = [
    (1, 7, "view", dt.datetime(2024, 1, 10, 8)), (2, 7, "click", dt.datetime(2024, 1, 10, 9)), (3, 7, "login", dt.datetime(2024, 1, 20, 9)),
    (4, 8, "error", dt.datetime(2024, 1, 25, 0, 5)), (5, 8, "view", dt.datetime(2024, 2, 2, 23)), (6, 9, "view", dt.datetime(2024, 1, 3)),
]
CUSTOMERS = [(1, "X"), (2, "X"), (3, "Y"), (4, "Y")]
ORDERS = [
    (1, 1, dt.date(1997, 12, 20), 5.0, "F", "1-URGENT"), (2, 1, dt.date(1998, 1, 2), 2.5, "F", "2-HIGH"), (3, 1, dt.date(1998, 1, 2), 1.0, "O", "2-HIGH"), (4, 1, dt.date(1998, 7, 3), 4.0, "O", "3-LOW"),
    (5, 2, dt.date(1998, 6, 29), 8.0, "P", "1-URGENT"), (6, 2, dt.date(1998, 8, 1), 3.0, "O", "1-URGENT"), (7, 3, dt.date(1998, 3, 1), -6.0, "F", "3-LOW"), (8, 3, dt.date(1998, 3, 5), 1.0, "F", "2-HIGH"),
]
LINES = [(997 * (i % 3) + user, 1 + (user * 7 + i) % 9, float(1 + (user * i) % 50)) for user in range(60) for i in range(6)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(ARTICLES, "article_id bigint, author string, title string").write.parquet(f"{d}/articles_half_a.parquet")
    spark.createDataFrame(DOCUMENTS, "doc_id bigint, text string, lang string").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(EVENTS, "event_id bigint, user_id bigint, event_type string, ts timestamp").write.parquet(f"{d}/events.parquet")
    spark.createDataFrame(CUSTOMERS, "c_custkey bigint, c_mktsegment string").write.parquet(f"{d}/customer.parquet")
    spark.createDataFrame(ORDERS, "o_orderkey bigint, o_custkey bigint, o_orderdate date, o_totalprice double, o_orderstatus string, o_orderpriority string").write.parquet(f"{d}/orders.parquet")
    spark.createDataFrame(LINES, "l_orderkey bigint, l_suppkey bigint, l_quantity double").write.parquet(f"{d}/lineitem.parquet")
    return str(d)


def run(spark, folder, name):
    return registry.queries()[name](spark, folder).collect()


def title_similarities():
    titles = {i: t for i, _, t in ARTICLES if t is not None}
    bags = {i: Counter(re.findall("[a-z0-9_]+", t.lower())) for i, t in titles.items()}
    df = Counter(w for b in bags.values() for w in b)
    vec = {i: {w: n / sum(b.values()) * len(titles) / df[w] for w, n in b.items()} for i, b in bags.items()}
    out = {}
    for a, b in combinations(sorted(titles), 2):
        dot = sum(x * vec[b].get(w, 0) for w, x in vec[a].items())
        if dot:
            out[a, b] = round(dot / math.sqrt(sum(x * x for x in vec[a].values()) * sum(x * x for x in vec[b].values())), 6)
        elif titles[a] == titles[b] != "":
            out[a, b] = 1.0
    return out


def test_all_similar_titles_are_linked(spark, folder):
    rows = {r["doc"]: r for r in run(spark, folder, "cosine_links")}
    pairs = {(r["doc_a"], r["doc_b"]): r["similarity"] for r in run(spark, folder, "cosine_pairs")}
    want = {k: x for k, x in title_similarities().items() if x >= 0.9}
    assert rows.keys() == {i for i, _, t in ARTICLES if t}
    assert {i: r["links"] for i, r in rows.items()} == {i: sum(i in k for k in want) for i in rows}
    for (a, b), x in want.items():  # copies by their class, the others by their classes' pair
        one, two = sorted((rows[a]["rep"], rows[b]["rep"]))
        assert x == 1.0 if one == two else pairs[one, two] == x
    assert all(a in rows and rows[a]["rep"] == a for k in pairs for a in k)
    assert rows[4]["rep"] == 2 and rows[14]["rep"] == 12 and rows[25]["rep"] == 23


@pytest.mark.parametrize("threshold", [0.1, 0.5, 0.8, 0.95])
def test_rare_tokens_find_every_pair(spark, threshold):
    import random

    random.seed(int(threshold * 100))
    docs = [(i, " ".join(random.choices("abcdefgh", weights=(40, 20, 10, 8, 5, 3, 2, 1), k=random.randint(1, 9)))) for i in range(80)]
    w = ir.tf_idf(tf := ir.term_frequencies(spark.createDataFrame(docs, "id int, t string"), "id", "t"), ir.inverse_frequencies(tf, 80)).checkpoint()
    full = {(r[0], r[1]): round(r[2], 9) for r in ir.class_pairs(w).where(F.col("similarity") >= threshold + 1e-9).collect()}
    got = {(r[0], r[1]): round(r[2], 9) for r in ir.similar_classes(w, threshold + 1e-9).collect()}
    assert got == full and got


def test_the_similarity_histogram_counts_all_pairs(spark, folder):
    assert {r["bin"]: r["n"] for r in run(spark, folder, "similarity_histogram")} == Counter(math.floor(x * 100) for x in title_similarities().values())


def test_the_curve_counts_all_pairs(spark, folder):
    author, sim = {i: a for i, a, _ in ARTICLES}, title_similarities()
    got = {round(r["threshold"] * 100): r["precision"] for r in run(spark, folder, "precision_recall_curve")}
    assert got.keys() == {min(math.floor(x * 100), 99) for x in sim.values()}
    for t, precision in got.items():
        over = [k for k, x in sim.items() if min(math.floor(x * 100), 99) >= t]
        assert precision == round(sum(author[a] == author[b] is not None for a, b in over) / len(over), 6)


TEXTS = {i: t for i, t, _ in DOCUMENTS if t is not None}


def lower(t):
    """As Java does: a dotted capital I becomes i and a combining dot, in Python too."""
    return t.lower()


def doc_tokens(t):
    return re.findall("[a-z0-9_]+", lower(t))


def doc_words():
    return Counter(w for t in TEXTS.values() for w in re.sub(r"[^\sa-zA-Z0-9]", "", t, flags=re.ASCII).lower().split())


def frequencies(stop=()):
    out = {}
    for i, t in TEXTS.items():
        c = Counter(w for w in doc_tokens(t) if w not in stop)
        out |= {(i, w): n / sum(c.values()) for w, n in c.items()}
    return out


def mail(t):
    t = lower(t)
    for pattern, word in ((r"<[^<>]+>", " "), (r"[0-9]+", "number"), (r"(http|https)://[^\s]*", "httpaddr"), (r"[^\s]+@[^\s]+", "emailaddr"), (r"[$]+", "dollar")):
        t = re.sub(pattern, word, t, flags=re.ASCII)
    return t


def test_words_of_all_documents(spark, folder):
    words = doc_words()
    assert [(r["word"], r["n"]) for r in run(spark, folder, "word_count_top")] == sorted(words.items(), key=lambda x: (-x[1], x[0]))[:15]
    assert [tuple(r) for r in run(spark, folder, "words_per_unique")] == [(len(words), round(sum(words.values()) / len(words), 4))]
    want = Counter()
    for w, n in words.items():
        if re.fullmatch("[a-z]+", w):
            want[ir.stem(w)] += n
    assert {r["stem"]: r["n"] for r in run(spark, folder, "stem_counts")} == want


def test_weights_of_all_documents(spark, folder):
    tf, kept = frequencies(), frequencies(ir.STOP_WORDS)
    df = Counter(w for _, w in kept)
    assert {(r["doc"], r["token"]): r["tf"] for r in run(spark, folder, "term_frequency")} == {k: pytest.approx(x, abs=1e-8) for k, x in tf.items()}
    assert {r["token"]: r["df"] for r in run(spark, folder, "token_df")} == df
    assert {(r["doc"], r["token"]): r["weight"] for r in run(spark, folder, "tf_idf")} == {(i, w): pytest.approx(x * len(DOCUMENTS) / df[w], abs=1e-6) for (i, w), x in kept.items()}


def test_records_of_all_documents(spark, folder):
    assert [tuple(r) for r in run(spark, folder, "biggest_record")] == [min(((i, len(doc_tokens(t))) for i, t in TEXTS.items()), key=lambda x: (-x[1], x[0]))]
    assert {r["doc_id"]: r["text"] for r in run(spark, folder, "mail_normalised")} == {i: t if t is None else mail(t) for i, t, _ in DOCUMENTS}


def test_vocabulary_rows_of_all_documents(spark, folder):
    top = [w for w, _ in sorted(doc_words().items(), key=lambda x: (-x[1], x[0]))[:200]]
    index = {w: i for i, w in enumerate(sorted({ir.stem(w) for w in top}), 1)}
    want = Counter(index[w] for t in TEXTS.values() for w in {ir.stem(x) for x in doc_tokens(mail(t))} if w in index)
    assert {r["index"]: r["docs"] for r in run(spark, folder, "vocabulary_rows")} == want


def days(first, last):
    return [first + dt.timedelta(n) for n in range((last - first).days + 1)]


def test_every_day_of_the_events_is_filled(spark, folder):
    end, want = max(ts for *_, ts in EVENTS).date(), {}
    for user in {u for _, u, *_ in EVENTS}:
        own = sorted((ts, i, kind) for i, u, kind, ts in EVENTS if u == user)
        want |= {(user, day): [k for ts, _, k in own if ts.date() <= day][-1] for day in days(own[0][0].date(), end)}
    got = run(spark, folder, "forward_fill_days")
    assert len(got) == len(want) and {(r["user_id"], r["cal_date"]): r["event_type"] for r in got} == want


SHOP = {c: f"seg^{m}" for c, m in CUSTOMERS}
MEMBERS = {c: sorted((day, amount) for _, c2, day, amount, *_ in ORDERS if c2 == c) for c in (1, 2, 3)}
FIRST, LAST = min(o[2] for o in ORDERS), max(o[2] for o in ORDERS)


def gaps(own):
    return [(b[0] - a[0]).days for a, b in zip(own, own[1:], strict=False)]


def rows_by(spark, folder, name, *keys):
    rows = run(spark, folder, name)
    out = {tuple(r[k] for k in keys): tuple(r[c] for c in r.asDict() if c not in keys) for r in rows}
    assert len(out) == len(rows)
    return out


def test_members_have_a_row_for_every_day(spark, folder):
    lrfm, interval = {}, {}
    for c, own in MEMBERS.items():
        for day in days(own[0][0], LAST):
            known = [o for o in own if o[0] <= day]
            g, last = gaps(known), known[-1][0]
            lrfm[day, SHOP[c], c] = ((last - own[0][0]).days, (day - last).days, len(known), round(sum(a for _, a in known), 2))
            interval[day, SHOP[c], c] = (round(sum(g) / len(g), 4) if g else -999.0, len(g) or -999, own[0][0], last)
    assert rows_by(spark, folder, "lrfm_daily", "cal_date", "shop_id", "member_id") == lrfm
    assert rows_by(spark, folder, "individual_interval_daily", "cal_date", "shop_id", "member_id") == interval


def test_shops_have_a_row_for_every_day(spark, folder):
    want = {}
    for shop in {SHOP[c] for c in MEMBERS}:
        for day in days(FIRST, LAST):
            g = [x for c, own in MEMBERS.items() if SHOP[c] == shop for x in gaps([o for o in own if o[0] <= day])]
            mean = sum(g) / len(g) if g else 0
            want[shop, day] = (len(g), round(mean, 4), round(math.sqrt(sum((x - mean) ** 2 for x in g) / len(g)), 4)) if g else (0, -999.0, -999.0)
    assert rows_by(spark, folder, "mu2_interval_daily", "shop_id", "cal_date") == want


def test_all_days_without_an_order_are_missing(spark, folder):
    want = sorted((SHOP[c], c, day) for c, own in MEMBERS.items() for day in days(own[0][0], own[-1][0]) if day not in {o[0] for o in own})
    assert sorted(tuple(r) for r in run(spark, folder, "missing_days")) == want


def test_all_users_get_recommendations(spark, folder):
    assert Counter(r["user"] for r in run(spark, folder, "als_recommend")) == {user: 3 for user in range(60)}


def test_recall_is_of_all_true_pairs(spark, folder):
    author, sim = {i: a for i, a, _ in ARTICLES}, title_similarities()
    true = [k for k in combinations(sorted(author), 2) if author[k[0]] == author[k[1]] is not None]
    for r in run(spark, folder, "precision_recall_curve"):
        over = [k for k, x in sim.items() if min(math.floor(x * 100), 99) >= round(r["threshold"] * 100)]
        p, q = sum(k in true for k in over) / len(over), sum(k in true for k in over) / len(true)
        assert (r["recall"], r["f"]) == (round(q, 6), round(2 * p * q / (p + q), 6) if p + q else 0)


def grown(rows, features, level=0, node="root"):
    """Nodes of the tree of ``rows`` (dicts with ``label``): the best gain ratio splits, of ties the first name."""

    def entropy(values):
        return -sum(n / len(values) * math.log2(n / len(values)) for n in Counter(values).values())

    def ratio(c):
        parts = [[r["label"] for r in rows if r[c] == v] for v in {r[c] for r in rows}]
        split = entropy([r[c] for r in rows])
        return (entropy([r["label"] for r in rows]) - sum(len(p) / len(rows) * entropy(p) for p in parts)) / split if split > 0 else 0.0

    var = min(features, key=lambda c: (-round(ratio(c), 12), c))
    g, values = ratio(var), sorted({r[var] for r in rows})
    out = {(level, node): (var, pytest.approx(g, abs=1e-9), len(rows), ",".join(values))}
    if g > 1e-12 and abs(g - 1) > 1e-12 and level < 4:
        for v in values:
            out |= grown([r for r in rows if r[var] == v], features, level + 1, f"{node}/{var}={v}")
    return out


def test_the_tree_is_of_all_orders(spark, folder):
    rows = [{"label": o[4], "o_orderpriority": o[5], "year": str(o[2].year), "month": str(o[2].month)} for o in ORDERS]
    assert rows_by(spark, folder, "c45_tree", "level", "node") == grown(rows, ["o_orderpriority", "year", "month"])


def test_no_branch_of_a_wide_level_is_left_out(spark):
    rows = [{"a": str(i // 4), "b": str(i // 2 % 2), "label": str((i + i // 8) % 3)} for i in range(120)]
    want = grown(rows, ["a", "b"])
    assert max(Counter(level for level, _ in want).values()) > 20
    d = spark.createDataFrame(rows)
    nodes = dtree.grow(d, ["a", "b"], "label")
    assert {(n["level"], n["node"]): (n["var"], n["gain_ratio"], n["n"], ",".join(n["rules"])) for n in nodes} == want
    with pytest.raises(ValueError, match="more than 20 nodes"):
        dtree.grow(d, ["a", "b"], "label", max_nodes=20)
