import random

from pyspark.sql import functions as F

from millrace.llm.queries_articles import p3_found
from millrace.llm.stuffing import fit_classes, judge, shape, shapes


def keyword_page(sizes, seed=3):
    """Lines of keywords between separators, of so many characters each, all different."""
    random.seed(seed)
    return "\n".join("、".join("".join(chr(random.randrange(0x4E00, 0x9000)) for _ in range(min(2, n - i))) for i in range(0, n, 2)) for n in sizes)


def test_long_pages_of_keywords_of_many_sizes_are_found(spark, tmp_path):
    short, long = keyword_page(range(2, 12)), keyword_page([*range(2, 61)] * 3)
    assert judge(long)[1] > 0.5 and judge(long)[2] <= 7
    text = "今天我們去了山上看花然後回家吃飯。\n" * 200
    spark.createDataFrame([(1, short), (2, long), (3, text), (4, text + short), (5, ""), (6, None)], "article_id bigint, content string").selectExpr("*", "0 as is_spam").write.parquet(f"{tmp_path}/articles_half_a.parquet")
    assert sorted(r[0] for r in p3_found(spark, str(tmp_path)).collect()) == [1, 2]
    assert p3_found(spark, str(tmp_path)).select(F.count("*")).first()[0] == 2


def test_groups_stay_few_whatever_the_lines():
    random.seed(4)
    words = ["tea", "LAMP", "sale", "Cups", "檯燈", "推薦", "しょうが", "통판"]
    lines = [random.choice([" | ", ", ", "、", " ", "。", " / ", "\n"]).join(random.choices(words, k=random.randint(1, 30))) for _ in range(200)] + ["#tag1 #tag2", "http://a.example/x"] * 20
    size, share, groups, top, _ = judge("\n".join(lines))
    assert share > 0.9 and 3 <= groups <= 7 and top >= 1 / 7
    assert len({s for s in shapes("\n".join(lines))}) > groups


def test_lines_of_measures_are_no_keywords():
    assert judge("\n".join(f"{k} {u} grilled mackerel" for k in range(1, 40) for u in ("g", "ml", "oz")))[1] == 0
    assert judge("\n".join(f"{k}公 麥茶" for k in range(1, 40)))[1] == 0
    assert judge(", ".join(f"cork coaster {k}" for k in range(40)))[1] > 0.9


def test_classes_come_from_pages():
    sentence = "The baker told us a long story about the flood, and we listened to it."
    odd = "cheap lamps for every home and every garden in town"  # long, no end: a sentence by its form
    assert judge(odd)[1] == 0
    pages = [(("tea cups, lamps, " * 20 + "\n" + "\n".join([odd] * 3)), False)] * 60 + [("\n".join([sentence] * 5), False)] * 300 + [(sentence * 9, True)] * 40
    classes = fit_classes(pages)
    assert classes[shape(odd)] and not classes[shape(sentence)]
    assert judge(odd, classes)[1] == 1 and judge(sentence, classes)[1] == 0
    assert fit_classes([]) == {} and fit_classes([("", True), (sentence, True)]) == {}
