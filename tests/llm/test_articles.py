import random
from itertools import product

import pytest

from millrace.llm.markup import Mark, clean, clean_markup, find_marks, fit_costs, label_marks, notations
from millrace.llm.mincut import min_cut
from millrace.llm.stuffing import judge, judge_pages, stuffed_pages


def cut_cost(side, source, sink, edges):
    return sum(sink[i] if s else source[i] for i, s in enumerate(side)) + sum(w for i, j, w in edges if side[i] != side[j])


def test_min_cut_is_the_least_of_all_labellings():
    random.seed(7)
    for _ in range(60):
        n = random.randint(1, 8)
        source, sink = ([random.choice([0, 0.5, 1, 2, 3]) for _ in range(n)] for _ in range(2))
        edges = [(random.randrange(n), random.randrange(n), random.choice([0.3, 1.0])) for _ in range(n * 2)]
        best = min(cut_cost(s, source, sink, edges) for s in product([True, False], repeat=n))
        assert cut_cost(min_cut(source, sink, edges), source, sink, edges) == pytest.approx(best)
    assert min_cut([], [], []) == []


def test_min_cut_of_a_long_chain():
    n = 20_000
    side = min_cut([2.0 if i % 7 else 0 for i in range(n)], [0 if i % 7 else 0.5 for i in range(n)], [(i, i + 1, 0.4) for i in range(n - 1)])
    assert all(side[1:-1]) and not side[0]


@pytest.mark.parametrize(
    ("text", "kinds"),
    [
        ("<p>Hello <b>you</b></p>", ["html"]), ("&lt;p&gt;Hello&lt;/p&gt;", ["html"]), ("tea &amp; cake", ["html"]), ("cut <a href=\"http://a.example/", ["html"]), ("x <!-- 3 --> y", ["html"]),
        ("# Title\n\n**bold** and [a](http://b.example)", ["markdown"]), ("```\nx = 1\n```", ["markdown"]), ("| a | b |\n|---|---|\n| 1 | 2 |", ["markdown"]), ("Title\n-----\ntext", ["markdown"]), ("~~no~~", ["markdown"]),
        ("== Title ==\n'''bold''' [[a|b]]", ["wiki"]), ("{|\n|-\n| a || b\n|}", ["wiki"]), ("{{box|n=1}}", ["wiki"]), ("__TOC__", ["wiki"]),
        ("== T ==\n* one\n* two", ["wiki"]), ("**T**\n\n* one\n* two", ["markdown"]),
        ("\\section{T}\n\\textbf{x}", ["latex"]), ("with $R^2 = 1 - \\frac{a}{b}$ here", ["latex"]), ("\\(x_i\\)", ["latex"]), ("<p>a</p>\\[ x \\]", ["html", "latex"]),
        ("I <3 it, 5 < 6 > 4, R&D, $5 and $20, 5 * 3 * 2", []), ("#tag1 #tag2, no. #1, a_b_c, x == y, C:\\work\\notes", []), ("[sic] {a, b} a|b|c 100^2 ~5 km 1) 2) 3)", []), ("", []), ("plain words.", []),
    ],
)
def test_notations(text, kinds):
    assert notations(text) == kinds


def test_clean_keeps_structure():
    t, kinds, _, _ = clean("<h2>A title</h2><p>Some words &amp; more of them.</p><ul><li>one thing</li><li>other</li></ul><pre><code>x = [1]\ny = 2</code></pre><table><tr><td>a1</td><td>b1</td></tr></table>")
    assert kinds == ["html"]
    assert t.split("\n") == ["## A title", "Some words & more of them.", "- one thing", "- other", "```", "x = [1]", "y = 2", "```", "a1 | b1"]
    assert clean("\\section{One}\nIt is $a^2$ here.\n\\begin{itemize}\n\\item x y z\n\\end{itemize}")[0].split("\n") == ["# One", "It is $a^2$ here.", "- x y z"]
    assert clean("== One ==\nSee [[page|the text]] and '''this'''.\n* item one")[0].split("\n") == ["## One", "See the text and this.", "- item one"]
    assert clean("# One\nSee [the text](http://a.example/) and **this**.\n```\n**kept** = 1\n```")[0].split("\n") == ["# One", "See the text and this.", "```", "**kept** = 1", "```"]


def test_boilerplate_is_cut_off():
    links = "".join(f"<li><a href='http://a.example/{i}'>link {i}</a></li>" for i in range(8))
    t, _, cut, _ = clean(f"<nav><ul>{links}</ul></nav><p>This is the sentence that the page was written for.</p><p>And another one follows it here.</p><footer><a href='/x'>about us</a></footer>")
    assert "link 3" in cut and "about us" in cut and t.startswith("This is the sentence") and "another" in t


def test_markup_operator_edges(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, "  \n", "c"), (4, "<p>x" * 3000, "d"), (5, "<p>broken <b attr='", "e"), (5, "<p>x</p>", "f")]
    d = spark.createDataFrame(rows, "doc_id int, content string, kinds string")
    got = clean_markup(d, "doc_id", "content").collect()
    assert len(got) == 6 and {r["doc_id"]: r["kinds"] for r in got if r["doc_id"] != 5} == {1: [], 2: [], 3: [], 4: ["html"]}
    assert clean_markup(d.where("false"), "doc_id", "content").count() == 0


GOOD = "We walked from the harbour to the old mill before lunch. The baker told us a long story about the flood, and we listened."
STUFFED = [
    ", ".join(f"{a} {b}" for a in ("tea cups", "desk lamp", "rain coat") for b in ("cheap", "sale", "buy online", "review")),
    "\n".join(f"desk lamp http://shop{i}.example/lamp/{i}" for i in range(12)),
    " ".join(f"#tag{i} #deskLamp" for i in range(20)),
    "<div style='display:none'>" + "。".join(["檯燈推薦", "檯燈便宜", "翠杉村檯燈", "檯燈"] * 6) + "</div>",
    "".join(f"<a href='http://a.example/{i}'>desk lamp {i}</a><br>" for i in range(12)),
    "bento box buy online Torutima bento box BENTO BOX bento box best price bento box review bento box cheap " * 3,
    "藍杉溪蛋塔蛋塔哪裡買芒果冰桐螢溪芒果冰藍帆溪芒果冰芒果冰銀雁村芒果冰芒果冰優惠蛋塔推薦藍笛小徑野餐墊芒果冰優惠野餐墊蛋塔" * 4,
    "手鏡口コミ / 手鏡通販 / 梅ゼリー激安 / " * 8,
]
FINE = [GOOD, f"<p>{GOOD}</p><a href='http://a.example'>more</a>", "# Soup\n\n" + GOOD + "\n\n- 200 g rice\n- 3 kg salt", "我們日出時分走到穗鹿村，發現玻璃涼亭還是一樣狹窄。房間正對著碼頭售票口，離樓梯8步。", "", "   ", None, "<p></p>"]


@pytest.mark.parametrize("text", STUFFED)
def test_stuffed(text):
    assert judge(text)[1] > 0.5 and judge(GOOD + "\n" + text)[1] > 0.5


@pytest.mark.parametrize("text", FINE)
def test_not_stuffed(text):
    assert judge(text)[1] <= 0.5


def test_stuffed_pages(spark):
    rows = [(i, t) for i, t in enumerate(STUFFED + FINE)]
    d = spark.createDataFrame(rows, "page_id int, n_chars string")
    assert sorted(r["page_id"] for r in stuffed_pages(d, "page_id", "n_chars").collect()) == list(range(len(STUFFED)))
    assert judge_pages(d, "page_id", "n_chars").count() == len(rows)
    assert stuffed_pages(d.where("false"), "page_id", "n_chars").count() == 0


def test_ties_decide_what_doubtful_marks_are():
    text = "== Places ==\nThe [[Harbour]] is old.\n- boats\n- nets\n== Food ==\nSee [[Fish]]."
    marks = find_marks(text)
    kinds = lambda edges: {m.kind for m, is_mark in zip(marks, label_marks(marks, edges), strict=True) if is_mark}
    assert kinds(True) == {"wiki"} and kinds(False) == {"wiki", "markdown"}
    assert notations("- boats\n- nets") == ["markdown"]
    near = [Mark(0, 1, "markdown", "a", -0.2, 0, 0), Mark(2, 3, "markdown", "b", 0.3, 0, 0)]
    far = [Mark(0, 1, "markdown", "a", -0.2, 0, 0), Mark(2, 3, "markdown", "b", 0.3, 9, 4)]
    assert label_marks(near)[0] and not label_marks(near, edges=False)[0] and not label_marks(far)[0]


def test_costs_are_fitted_from_texts_known_by_other_marks():
    wiki = ["== A ==\n* one\n* two"] * 300
    plain = ["* one\n* two"] * 10
    costs = fit_costs(wiki + plain)
    assert costs["wiki", "star item"] > 1 > -1 > costs["markdown", "star item"]
    assert notations("* one", costs) == ["wiki"] and notations("* one") == []
    assert all(abs(fit_costs([])[k] - e) < 1e-9 for k, e in {("markdown", "code"): 2.5, ("wiki", "star item"): -0.5}.items())


def test_broken_markup_is_read_in_time():
    import time

    began = time.process_time()
    for piece in ("<!-- x ", "\\[ a ", "\\( b ", "$$", "\n", "` ", "[[", "{{", "&lt;a ", "** ", "<pre>"):
        clean(piece * 20_000)
    assert time.process_time() - began < 60
