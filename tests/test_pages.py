import pytest

from vacancylens.sources import pages

HTML = """<html><body><button class="btn">Outside</button>
<section id="posting-requirements"><h2>Must</h2>
 <div class="btn btn-small"> Python </div><br><span class='btn'>C++ &amp; <b>Go</b></span>
 <div class="button">no</div><div class="btn">Outer <i class="btn">Inner</i></div>
</section><div class="btn">After</div></body></html>"""


def frame(spark, *rows):
    return spark.createDataFrame(list(enumerate(rows)), "page_id long, html string")


def test_nested_keywords(spark):
    df = frame(spark, HTML, "<p>nothing</p>", '<p class="btn">no container</p>')
    assert [tuple(r) for r in pages.page_keywords(df).collect()] == [
        (0, "python"),
        (0, "c++ & go"),
        (0, "outer inner"),
        (0, "inner"),
    ]


def test_whole_page(spark):
    found = [r.keyword for r in pages.page_keywords(frame(spark, HTML), container_id=None).collect()]
    assert found == ["outside", "python", "c++ & go", "outer inner", "inner", "after"]


def test_flat_and_nested_agree_on_flat_markup(spark):
    df = frame(spark, '<div class="ad x">One</div><div id="a" class="ad">\n Two </div><div class="bad">no</div>')
    flat = sorted(map(tuple, pages.flat_keywords(df, "ad").collect()))
    assert flat == sorted(map(tuple, pages.page_keywords(df, "ad", None).collect())) == [(0, "one"), (0, "two")]


def test_flat_form_takes_all_quotings_and_refuses_markup(spark):
    df = frame(spark, "<DIV class='x c.'>a</DIV><div class=c.>b</div><div class=\"cx\">no</div><divx class='c.'>no</divx>")
    assert [r.keyword for r in pages.flat_keywords(df, "c.").collect()] == ["a", "b"]
    for html in ('<div class="ad">x <b>y</b></div>', '<div class="ad">a &amp; b</div>'):
        with pytest.raises(Exception, match="not plain text"):
            pages.flat_keywords(frame(spark, html), "ad").collect()


def test_unclosed_elements(spark):
    df = frame(spark, '<div id="posting-requirements"><p><span class="btn">A</div><span class="btn">B</span>')
    assert [r.keyword for r in pages.page_keywords(df).collect()] == ["a"]
