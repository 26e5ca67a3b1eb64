"""The page parse: its two readers agree, and pages are dealt over tasks."""

import random

from sparkmart.operators import html as H

BITS = ['<div class="a b">', "</div>", "<p>", "</p>", "x &amp; y", "&lt", "<br>", "<img src='a'>", "<title>", "</title>", "<!-- c -->",
        '<span id="q" bdTime="1">', "</span>", '<a href="x&amp;y">', "<!DOCTYPE html>", "<script>", "</script>", "<li/>", "  ", "<", "<td nowrap>"]


def test_plain_pages_read_as_the_standard_parser_does():
    pick, plain = random.Random(1), 0
    for _ in range(3000):
        html = "".join(pick.choice(BITS) for _ in range(pick.randint(0, 9)))
        nodes = H._Nodes(["div.a", "span#q"], None)
        parser = H._NodeParser(nodes)
        parser.feed(html)
        parser.close()
        assert H.page_nodes(html, ["div.a", "span#q"], None) == nodes.finish()
        plain += H._plain_tokens(html) is not None
    assert plain > 300


def test_pages_of_one_file_are_parsed_in_several_tasks(spark):
    pages = spark.range(0, 1000, 1, 1).selectExpr("id AS page_id", "concat('<p class=\"c\">', id, '</p>') AS html")
    nodes = H.parse_nodes(pages, keep_tags=["p"], materialize=False)
    assert nodes.rdd.getNumPartitions() > 1
    assert sorted((r.page_id, r.text) for r in nodes.collect()) == [(i, str(i)) for i in range(1000)]


def test_attributes_and_missing_scopes(spark):
    pages = spark.createDataFrame([("x", '<li class="k"><b A="1" c="">t</b></li><i>u</i>'), ("y", None)], "page_id string, html string")
    got = [(r.page_id, r.pos, r.tag, r.attrs, r.text, r.scope, r.scope_pos, r.parent_cls) for r in H.parse_nodes(pages, scopes=["li.k"]).collect()]
    assert sorted(got, key=lambda r: r[1]) == [("x", 1, "li", {"class": "k"}, "t", None, None, None),
                                               ("x", 2, "b", {"a": "1", "c": ""}, "t", "li.k", 1, "k"), ("x", 3, "i", {}, "u", None, None, None)]
