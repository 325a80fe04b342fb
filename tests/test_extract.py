import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom.functions import html as hx
from textloom.operators import extract as ex


def text_of(spark, html):
    return hx.html_to_text(spark.createDataFrame([(html,)], "t string"), "t").first().t


@pytest.mark.parametrize(
    "html, text",
    [
        ("<p>a<b>b</b>c</p>", "a b c"),
        ("<!DOCTYPE html><p>a</p><!-- <p>no</p> -->b", "a b"),
        ('<script>var t="</p>"; x<y</script>keep<style>p{}</style>', "keep"),
        ("<SCRIPT type='a'>x</SCRIPT >y", "y"),
        ("a<script>never closed", "a"),
        ("<nav>out<nav>in</nav>out</nav>keep", "keep"),
        ("<header><nav>x</nav>y</header>keep<aside>z</aside>", "keep"),
        ("keep<nav>never closed <p>x</p>", "keep"),
        ("<nav/>keep", "keep"),
        ("<div><nav>menu</div><p>keep this</p>", "keep this"),
        ("<div><nav>menu<ul><li>a<li>b</div>keep", "keep"),
        ("a<nav>" * 7 + "x" + "</nav>" * 7 + "keep", "a keep"),
        ("<nav><aside>x</nav>keep</aside> too", "keep too"),
        ("<p>a<p>b<nav>x</nav><p>c", "a b c"),
        ("<nav>x<br>y<img src='>'>z</nav>keep</p></nav> on", "keep on"),
        ("x < 3 <nav>n</nav> y > 2", "x < 3 y > 2"),
        ("<navigation>keep</navigation><header-x>too</header-x>", "keep too"),
        ('<a title="x > y">keep</a>', "keep"),
        ("<p don't>keep</p>", "keep"),
        ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
        ("<p>&lt;b&gt; &amp;amp; &#233;&#xE9;&eacute;&nbsp;x&hellip;</p>", "<b> &amp; ééé x…"),
        ("", ""),
        ("<footer>x</footer>", ""),
    ],
)
def test_page_text(spark, html, text):
    assert text_of(spark, html) == text


def test_extraction_drops_empty_results_and_keeps_columns(spark):
    rows = [
        (1, "<div>hello <b>world</b></div>", "s"),
        (2, "<div><script>x</script></div>", "s"),
        (3, "  a \r\n\n b c ", "s"),
        (4, " \n ", "s"),
        (5, None, "s"),
        (6, "x" * 200 + "<div>late</div>", "s"),
    ]
    df = spark.createDataFrame(rows, "id int, text string, source string")
    out = ex.extract_text(df)
    assert out.columns == df.columns
    got = {r.id: r.text for r in out.collect()}
    assert got == {1: "hello world", 3: "a\nb\nc", 6: "x" * 200 + " late"}


def test_long_pages_do_not_overflow(spark):
    html = "<div>" + "<nav>" + "x " * 50_000 + "</nav>" + "<p class='a'>word</p>" * 20_000 + "</div>"
    assert text_of(spark, html) == " ".join(["word"] * 20_000)


def model_spans(page):
    """Furniture by its definition, a list searched at every end tag."""
    cuts = [m.start() for m in re.finditer("</?[a-zA-Z]", page)] + [len(page)]
    stack, spans, since, depth = [], [], None, None
    for begin, end in zip(cuts, cuts[1:]):
        piece = page[begin:end]
        name = re.match(r"(?a)</?([a-zA-Z][^\s/>]*)", piece)[1].lower()
        if name in hx.VOID:
            continue
        if piece.startswith("</"):
            if name in stack:
                keep = len(stack) - 1 - stack[::-1].index(name)
                stack = stack[:keep]
                if depth is not None and depth >= keep:
                    spans.append((since, begin))
                    depth = None
        elif name in hx.FURNITURE and re.match(r"(?s)<[^>]*/>", piece):
            continue
        else:
            if name in hx.FURNITURE and depth is None:
                depth, since = len(stack), begin
            if not (name in hx.IMPLIED and stack[-1:] == [name]):
                stack.append(name)
    return spans + ([(since, len(page))] if depth is not None else [])


@settings(max_examples=500, deadline=None)
@given(
    st.lists(
        st.sampled_from(
            ["<nav>", "</nav>", "<NAV a='>'>", "<nav/>", "<nav", "<p>", "</p>", "<li>", "<div>", "</div>", "<br>", "</ p>"]
            + ["<aside x>", "</aside\n>", "<a<b>", "text", " ", "<", ">", "</", "é"]
        ),
        max_size=40,
    )
)
def test_furniture_equals_its_definition(parts):
    page = "".join(parts)
    assert hx.furniture_spans(page) == model_spans(page)


@pytest.mark.parametrize("kind", ["nested", "unclosed", "pairs", "ends", "never a tag"])
def test_time_goes_with_the_length_of_a_page(kind):
    """Four times the tags take about four times as long, where a walk that
    copies or searches its stack takes sixteen."""

    def page(n):
        return {
            "nested": "<nav>" + "<div>" * n + "x" + "</div>" * n + "</nav>keep",
            "unclosed": "<nav>x</nav>" + "<b>" * n + "</i>" * n + "keep",
            "pairs": "<nav>x</nav><p>keep</p>" * n,
            "ends": "<b>" * n + "<nav>" + "</u></b><b>" * n,
            "never a tag": "<nav>x</nav>" + "<a " * n,
        }[kind]

    def seconds(n):
        best = []
        for _ in range(3):
            start = time.process_time()
            hx._visible(page(n))
            best.append(time.process_time() - start)
        return min(best)

    assert seconds(50_000) < 8 * seconds(12_500) + 0.05


def test_fifty_thousand_tags_through_spark(spark):
    page = "<div>" + "<nav><b>x</b></nav><p>word &amp; <i>more" * 12_500 + "<a " * 50_000
    assert text_of(spark, page).startswith(" ".join(["word & more"] * 12_500))
    assert text_of(spark, "<p>" + "word<b>x" * 50_000 + "<a " * 50_000).count("word") == 50_000


def test_only_untidy_texts_are_tidied_and_in_one_step(spark, monkeypatch):
    from textloom.functions import repair as rp

    monkeypatch.setattr(rp, "SLICE_BYTES", 20)
    texts = {
        "one\ntwo words": None,
        " one": "one",
        "one　": "one",
        "one\n\ntwo": "one\ntwo",
        "one \ntwo": "one\ntwo",
        "one\r\ntwo\x85three\x0b\x1c ": "one\ntwo\nthree",
        " \n\t": "",
        "": None,
        "naïve\n漢字": None,
    }
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = [r.t for r in df.select("i", rp.changes(F.col("text"), ex.TIDY).alias("t")).orderBy("i").collect()]
    assert got == list(texts.values())
    tidy = [r.text for r in ex.extract_text(df).orderBy("i").collect()]
    assert tidy == [t for old, new in texts.items() if (t := old if new is None else new)]
    plan = df.select(ex.tidy_lines(F.col("text")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "split(" not in plan
