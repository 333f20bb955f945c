import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from millrace.functions.text import WORD_CHAR, fold, unmark, words
from millrace.llm.language import Languages, document_languages, fit_languages, label_language, label_missing, sample_labelled, segment_languages, sentences, spans
from millrace.llm.leak import WuManber, find_leaks
from millrace.llm.mixture import NotSolved, Source, balance, draw, set_goals, shares
from millrace.llm.tokens import VOCABULARY, count_tokens, encoder


@settings(max_examples=150, deadline=None)
@given(st.text("ab", max_size=60), st.lists(st.text("ab", min_size=4, max_size=4), min_size=1, max_size=6))
def test_wu_manber_finds_every_occurrence(text, patterns):
    found = sorted(WuManber(4, {p: (p,) for p in patterns}).search(text))
    assert found == sorted((i, (text[i : i + 4],)) for i in range(len(text) - 3) if text[i : i + 4] in set(patterns))


def brute_leaks(docs, items, n_words, n_chars):
    out = set()
    for d, t in docs:
        if not t:
            continue
        w, c = words(fold(unmark(t))), WORD_CHAR.sub("", fold(unmark(t)))
        for i, lang, x in items:
            p = fold(unmark(x or ""))
            if lang in ("zh", "ja"):
                s = WORD_CHAR.sub("", p)
                hit = any(s[k : k + n_chars] in c for k in range(len(s) - n_chars + 1))
            else:
                v = words(p)
                hit = any(v[k : k + n_words] == w[j : j + n_words] for k in range(len(v) - n_words + 1) for j in range(len(w) - n_words + 1))
            if hit:
                out.add((d, i))
    return out


def test_leaks_match_brute_force(spark):
    random.seed(4)
    vocab = ["the", "cat", "sat", "on", "mat", "with", "hat"]
    items = [(i, "en", " ".join(random.choices(vocab, k=12))) for i in range(8)] + [(100, "zh", "假設圖書館員端著五盤栗子飯經過碼頭"), (101, "en", "short"), (102, "en", None)]
    docs = [(i, " ".join(random.choices(vocab, k=40))) for i in range(60)] + [(900, ""), (901, None), (902, "我說：假設圖書館員端著5盤。假設 圖書<b>館</b>員端著五盤栗子飯！")]
    docs += [(1000 + i, "x " + it[2].upper().replace(" ", " <i>", 1).replace(" ", "</i>,\n\u200b", 2)) for i, it in enumerate(items[:8])]
    d, t = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, lang string, text string")
    want = brute_leaks(docs, items, 5, 10)
    got = [{tuple(r) for r in find_leaks(d, t, "doc_id", "text", "item_id", "lang", "text", 5, 10, *bound).collect()} for bound in ((), (30, 6), (30, 20))]
    assert {r[:2] for r in got[0]} == want and got[0] == got[1] == got[2]
    assert (902, 100) in want and all((1000 + i, i) in want for i in range(8))
    assert find_leaks(d.where("false"), t, "doc_id", "text", "item_id", "lang", "text").count() == 0
    assert find_leaks(d, t.where("false"), "doc_id", "text", "item_id", "lang", "text").count() == 0


def test_leak_ignores_form_width_and_markup(spark):
    item = "Über zehn Wörter sollen hier in einer Reihe stehen und gefunden werden"
    forms = [item.upper(), "ｕ\u0308ber " + item[5:], item.replace(" ", "\u00a0\n"), item.replace("zehn", "ze\u00adhn"), "&Uuml;" + item[1:], item.replace("Reihe", "**Reihe**"), item.replace("Reihe", "[Reihe](http://a.example/b)")]
    d = spark.createDataFrame(list(enumerate(forms)), "doc_id int, text string")
    t = spark.createDataFrame([(1, "de", item)], "item_id int, lang string, text string")
    assert sorted(r[0] for r in find_leaks(d, t, "doc_id", "text", "item_id", "lang", "text").collect()) == list(range(len(forms)))


SENTENCES = {
    "en": ["The {} was painted last summer by two neighbours.", "We walked along the {} until it started to rain.", "Nobody remembers who built the {} near the river."],
    "de": ["Der {} wurde im letzten Sommer von zwei Nachbarn gestrichen.", "Wir gingen am {} entlang, bis es zu regnen anfing.", "Niemand weiß mehr, wer den {} am Fluss gebaut hat."],
    "fr": ["Le {} a été repeint l'été dernier par deux voisins.", "Nous avons marché le long du {} jusqu'à la pluie.", "Personne ne sait plus qui a construit le {} près du fleuve."],
    "zh": ["去年夏天兩位鄰居把{}重新粉刷了一遍。", "我們沿著{}散步，直到開始下雨。", "沒有人記得河邊的{}是誰蓋的。"],
}
NAMES = ["Maravik", "Tolund", "Seradal", "Quenost", "Briamora", "Hesaltim", "Oruvik", "Pelazed"]


def labelled(n=60, seed=5):
    random.seed(seed)
    rows = []
    for code, forms in SENTENCES.items():
        for _ in range(n):
            real = code if random.random() > 0.1 else random.choice(list(SENTENCES))
            rows.append((code, " ".join(f.format(random.choice(NAMES) + str(random.randint(1, 99))) for f in random.sample(SENTENCES[real], 3))))
    return rows


@pytest.fixture(scope="module")
def model() -> Languages:
    return fit_languages(labelled())


def test_languages_on_held_out_texts(model):
    random.seed(99)
    hits = [model.classify(f.format(random.choice(NAMES) + "x"))[0] == code for code, forms in SENTENCES.items() for f in forms for _ in range(5)]
    assert sum(hits) / len(hits) >= 0.95


def test_documents_and_segments(spark, model):
    f = {c: [x.format("Tolund") for x in forms] for c, forms in SENTENCES.items()}
    rows = [(1, f["en"][0] + " " + f["en"][1]), (2, f["de"][0] + " " + f["fr"][1] + "\n" + f["de"][2]), (3, f["zh"][0]), (4, None), (5, ""), (6, "12 34 http://a.example/b"), (7, "(Maravik) " + f["fr"][0])]
    d = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id int, text string, langs string")
    got = {r["doc_id"]: r["langs"] for r in document_languages(d, "doc_id", "text", model).collect()}
    assert got == {1: ["en"], 2: ["de", "fr"], 3: ["zh"], 4: [], 5: [], 6: [], 7: ["fr"]}
    seg = [(r["segment"], r["lang"]) for r in segment_languages(d.where("doc_id = 2"), "doc_id", "text", model).orderBy("segment").collect()]
    assert seg == [(0, "de"), (1, "fr"), (2, "de")]
    assert document_languages(d.where("false"), "doc_id", "text", model).count() == 0


def test_sample_is_the_same_whatever_the_order(spark):
    rows = [(i, "x" * 9000 if i % 2 else None, "en" if i % 3 else "de") for i in range(200)]
    got = [sample_labelled(spark.createDataFrame(r, "id int, t string, l string"), F.col("l"), "t", "id", per_language=20, chars=50) for r in (rows, rows[::-1])]
    assert got[0] == got[1] and {c for c, _ in got[0]} == {"en", "de"} and all(t == "x" * 50 for _, t in got[0]) and 10 < len(got[0]) < 90


def test_parts_tile_the_text(model):
    f = {c: [x.format("Tolund") for x in forms] for c, forms in SENTENCES.items()}
    texts = ["", "x", "12. 34", "<p>Hi.</p> " + f["en"][0] + " Ok! <a href='http://a.b/c.d'>" + f["de"][1] + "</a> &amp; so\n" + f["zh"][0] + " 短い。", "a. " * 5000, "…\n\n"]
    for t in texts:
        got = spans(t)
        assert [x for x, _, _ in got] + [len(t)] == [0] * bool(t) + [y for _, y, _ in got] if t else not got
    assert [model.classify(s)[0] for _, _, s in spans(texts[3])] == ["en", "de", "zh"]
    assert "Ok!" in texts[3][spans(texts[3])[0][0] : spans(texts[3])[0][1]]


def test_a_writing_that_one_language_has(model):
    samples = {"en": ("the rain in spain falls mainly " * 40).encode(), "ko": ("우리는 비가 내리기 시작할 때까지 강을 따라 걸었다 " * 40).encode()}
    assert Languages(samples).classify("비가 내리기 시작할 때까지 걸었다")[0] == "ko"
    assert Languages({}).classify("some words")[0] is None


def test_labels(spark):
    from pyspark.sql import functions as F

    rows = [("en-US", "en", False), ("ZH_Hant", "zh", False), ("German", "de", False), ("xx", None, True), (None, None, True), ("", None, True), ("it", None, False)]
    got = [tuple(r) for r in spark.createDataFrame([(i, x[0]) for i, x in enumerate(rows)], "i int, l string").orderBy("i").select("l", label_language(F.col("l")), label_missing(F.col("l"))).collect()]
    assert got == rows


def test_sentences_leave_out_what_is_too_short():
    assert sentences("Hello there. This one is long enough. 短い。") == ["This one is long enough."]


def mixture_tables(spark):
    random.seed(6)
    docs = [(i, random.choice(["a"] * 6 + ["b", "b", "c", "zz", None]), random.randint(0, 400)) for i in range(4000)]
    targets = [("a", 0.3, 1), ("b", 0.35, 4), ("c", 0.3, 2), ("gone", 0.05, 3)]
    return docs, spark.createDataFrame(docs, "id bigint, source string, n_tokens bigint"), spark.createDataFrame(targets, "source string, target_share double, max_repeat int")


def test_mixture_meets_its_goals(spark):
    docs, d, t = mixture_tables(spark)
    drawn, solved = draw(d, t)
    rows = {r["id"]: r for r in drawn.collect()}
    caps = {"a": 1, "b": 4, "c": 2}
    assert all(1 <= r["copies"] <= caps[r["source"]] and r["n_tokens"] > 0 for r in rows.values())
    for name in caps:
        got = sum(r["copies"] * r["n_tokens"] for r in rows.values() if r["source"] == name)
        assert got == pytest.approx(solved[name].goal, abs=400)
    total = sum(n for _, s, n in docs if s in ("a", "b", "c"))
    assert sum(s.goal for s in solved.values()) == pytest.approx(total)
    out = {r["source"]: r for r in shares(drawn, t).collect()}
    assert out["gone"]["actual_share"] == 0 and sum(r["actual_share"] for r in out.values()) == pytest.approx(1)
    assert out["c"]["most_copies"] == 2 and solved["c"].full  # cannot reach its share


def test_mixture_edges(spark):
    _, d, t = mixture_tables(spark)
    assert draw(d.where("false"), t)[0].count() == 0
    assert draw(d, t.where("false"))[0].count() == 0
    same = spark.createDataFrame([(i, "a", 10) for i in range(100)], "id bigint, source string, n_tokens bigint")
    drawn, _ = draw(same, spark.createDataFrame([("a", 1.0, 3)], "source string, target_share double, max_repeat int"), total=1500)
    assert sum(r["copies"] for r in drawn.collect()) == pytest.approx(150, abs=1)


@pytest.mark.parametrize("times", [0.2, 0.9, 1.7, 2.9999])
def test_dual_is_solved_and_tilts(spark, times):
    import math

    docs = [("a", n, n % 5 + 1) for n in range(1, 80)] + [("b", n, 1) for n in range(1, 40)]
    s = {k: Source(share, 3, sum(c for x, _, c in docs if x == k), sum(n * c for x, n, c in docs if x == k)) for k, share in (("a", 0.9), ("b", 0.1))}
    for x in s.values():
        x.goal = times * x.tokens
    balance(spark.createDataFrame(docs, "source string, n_tokens bigint, n bigint"), s)
    for k, x in s.items():
        assert abs(x.b) > 0.05 and (x.b > 0) == (times > 1)
        assert sum(c * n * min(3, math.exp(min(9, x.b * n / x.mean))) for y, n, c in docs if y == k) == pytest.approx(x.goal, rel=1e-6)


def test_a_goal_out_of_reach_is_an_error(spark):
    s = {"a": Source(1.0, 2, 10, 100, goal=201.0)}
    with pytest.raises(NotSolved):
        balance(spark.createDataFrame([("a", 10, 10)], "source string, n_tokens bigint, n bigint"), s, max_steps=30)


def test_shares_come_within_half_a_percent(spark):
    random.seed(8)
    docs = [(i, random.choice("aaabc"), random.randint(1, 400)) for i in range(6000)]
    targets = spark.createDataFrame([("a", 0.4, 2), ("b", 0.35, 3), ("c", 0.25, 2)], "source string, target_share double, max_repeat int")
    drawn, solved = draw(spark.createDataFrame(docs, "id bigint, source string, n_tokens bigint"), targets)
    out = {r["source"]: r for r in shares(drawn, targets).collect()}
    assert all(abs(r["actual_share"] - r["target_share"]) <= 0.005 for r in out.values())
    assert all(r["most_copies"] <= solved[k].cap and solved[k].b != 0 for k, r in out.items())


def test_token_counts_round_trip(spark):
    texts = ["hello world", "", None, "日本語 and ünïcode", "a" * 5000]
    got = [r["n_tokens"] for r in count_tokens(spark.createDataFrame(list(enumerate(texts)), "i int, text string"), ["i"], "text").orderBy("i").collect()]
    enc = encoder(VOCABULARY)
    assert got == [len(enc.encode_ordinary(t or "")) for t in texts] and enc.decode(enc.encode_ordinary(texts[3])) == texts[3]
