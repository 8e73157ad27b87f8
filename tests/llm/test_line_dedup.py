"""Line dedup against a direct count of lines by host."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from padron.llm import line_dedup

PAGES = "page_id long, url string, html string, host string, lines string, common string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], PAGES)


def found(spark, rows, **options):
    return sorted((tuple(r) for r in line_dedup.drop_boilerplate(
        pages(spark, rows), **options).collect()), key=str)


@pytest.mark.parametrize("html, lines", [
    (None, []), ("", []), ("<p> a </p><p>b<br>c", ["a", "b", "c"]),
    ("<script>var t='</p>'</script>x<!-- no --> y", ["x y"]),
    ("a &lt;b&gt; &amp;amp; &nbsp; c", ["a <b> &amp; c"]),
    ("<STYLE>p{}</STYLE><a href='/'>home</a> <i>now</i>\r\n", ["home now"])])
def test_lines(spark, html, lines):
    df = pages(spark, [(1, None, html)])
    assert df.select(line_dedup.text_lines(F.col("html")).alias("l")).first().l == lines


@pytest.mark.parametrize("url, host", [
    ("http://A.example.com/x?y", "a.example.com"), ("https://u:p@h.org:8080", "h.org"),
    ("no url", ""), (None, "")])
def test_host(spark, url, host):
    assert pages(spark, [(1, url, "")]).select(line_dedup.host(F.col("url")).alias("h")).first().h == host


def test_against_counts(spark):
    rows = []
    for i in range(60):
        site = "big" if i < 40 else f"s{i % 4}"
        lines = ["menu", f"text {i}", "menu"] + ["often"] * (i % 3 == 0) + ["rare"] * (i % 9 == 0)
        rows.append((i % 50, f"http://{site}/p", "".join(f"<p>{x}</p>" for x in lines)))
    rows += [(None, None, "<p>menu</p>"), (None, None, None), (7, "http://big/", "")]
    text = [[x for x in (r[2] or "").replace("<p>", "").split("</p>") if x] for r in rows]
    host = [(r[1] or "").removeprefix("http://").partition("/")[0] for r in rows]
    holding, total = defaultdict(Counter), Counter(host)
    for h, t in zip(host, text):
        holding[h].update(set(t))
    expected = []
    for r, h, t in zip(rows, host, text):
        kept = [x for x in t if total[h] < 5 or holding[h][x] <= 0.25 * total[h]
                or holding[h][x] == 1]
        expected.append((r[0], h, len(t), len(t) - len(kept), "\n".join(kept)))
    assert found(spark, rows) == sorted(expected, key=str)


def test_empty_table(spark):
    assert found(spark, []) == []
