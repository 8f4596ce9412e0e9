from pyspark.sql import functions as F

from tidewell.functions import urls
from tidewell.operators import linking

BASE = "http://a/b/c/d;p?q"
# The examples of RFC 3986, 5.4 (fragments left out).
EXAMPLES = {
    "g:h": "g:h", "g": "http://a/b/c/g", "./g": "http://a/b/c/g", "g/": "http://a/b/c/g/", "/g": "http://a/g", "//g": "http://g",
    "?y": "http://a/b/c/d;p?y", "g?y": "http://a/b/c/g?y", "#s": "http://a/b/c/d;p?q", "g#s": "http://a/b/c/g", "g?y#s": "http://a/b/c/g?y",
    ";x": "http://a/b/c/;x", "g;x": "http://a/b/c/g;x", "g;x?y#s": "http://a/b/c/g;x?y", "": "http://a/b/c/d;p?q", ".": "http://a/b/c/",
    "./": "http://a/b/c/", "..": "http://a/b/", "../": "http://a/b/", "../g": "http://a/b/g", "../..": "http://a/", "../../": "http://a/",
    "../../g": "http://a/g", "../../../g": "http://a/g", "../../../../g": "http://a/g", "/./g": "http://a/g", "/../g": "http://a/g",
    "g.": "http://a/b/c/g.", ".g": "http://a/b/c/.g", "g..": "http://a/b/c/g..", "..g": "http://a/b/c/..g", "./../g": "http://a/b/g",
    "./g/.": "http://a/b/c/g/", "g/./h": "http://a/b/c/g/h", "g/../h": "http://a/b/c/h", "g;x=1/./y": "http://a/b/c/g;x=1/y",
    "g;x=1/../y": "http://a/b/c/y", "g?y/./x": "http://a/b/c/g?y/./x", "g?y/../x": "http://a/b/c/g?y/../x",
}


def test_references_resolve_as_in_the_standard(spark):
    rows = spark.createDataFrame(list(EXAMPLES.items()), "ref string, want string")
    got = rows.select("ref", "want", urls.resolve(F.col("ref"), F.lit(BASE)).alias("got")).collect()
    assert [(r.ref, r.got) for r in got if r.got != r.want] == []
    one = spark.createDataFrame([("g", "http://h"), (None, "http://h"), ("g", None)], "ref string, base string")
    assert [r.got for r in one.select(urls.resolve(F.col("ref"), F.col("base")).alias("got")).collect()] == ["http://h/g", None, None]


def test_equal_urls_have_one_form(spark):
    forms = {
        "HTTP://User@WWW.Example.COM:80": "http://User@www.example.com/", "https://h:443/a/./b/../c?x=%c3%9f#f": "https://h/a/c?x=%C3%9F",
        "https://h:80/": "https://h:80/", "http://h:/a": "http://h/a", "http://h/%7ea//b/": "http://h/%7Ea//b/", "mailto:A@b": "mailto:A@b",
    }
    rows = spark.createDataFrame(list(forms.items()), "url string, want string")
    assert [(r.url, r.got) for r in rows.select("url", "want", urls.canonical(F.col("url")).alias("got")).collect() if r.got != r.want] == []


def test_pages_are_targets_of_other_pages(spark):
    links = spark.createDataFrame([
        ("http://h/a/", "b#top"), ("http://h/a/", "mailto:x@y"), ("http://h/a/b?q", "../a/"), ("http://H:80/a/b", "/a/"), ("http://H/a/b", "http://h/a/./")],
        "url string, href string")
    graph = linking.url_graph(links)
    assert {(r.page, r.target) for r in graph.collect()} == {
        ("http://h/a/", "http://h/a/b"), ("http://h/a/b?q", "http://h/a/"), ("http://h/a/b", "http://h/a/")}
    degrees = {(r.node, r.direction): r.degree for r in linking.link_degrees(graph).collect()}
    assert degrees["http://h/a/", "in"] == 2 and degrees["http://h/a/", "out"] == 1 and degrees["http://h/a/b", "in"] == 1
