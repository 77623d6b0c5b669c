"""Edge tables for the scalar functions, checked against the standard library."""

import html
import json
import random
import re
import time
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from coursegrain.functions import classify, keys, numbers, paths, text


def run(spark, values, fn):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.o for r in rows.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def test_unescape(spark):
    values = ["a &amp;lt; b", "&notit; &not; &notin;", "&#65;&#x41;&#128;&#0;&#xD800;", "&copy&middot;&nbsp;x", "AT&T & b &", "&NotEqualTilde;", "&#9999999999999;", "&ampfoo; &#x;", "plain", "&#x1F600;"]
    assert run(spark, values, text.unescape) == [html.unescape(v) for v in values]


BLANK = "\t\n\x0b\x0c\r \x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def test_blank_space(spark):
    random.seed(3)
    signs = BLANK + "  a!~\x7f\x00\u200b\u180eé😀"
    values = ["", " ", "\r\n", "a", "😀", *("".join(random.choices(signs, k=n % 9)) for n in range(400))]
    assert run(spark, values, text.strip) == [v.strip(BLANK) for v in values]
    assert run(spark, values, text.collapse) == [re.sub(f"[{BLANK}]+", " ", v).strip(" ") for v in values]


def test_long_blank_space_is_read_once(spark):
    wide = "a" + " " * 400_000 + "b"
    started = time.time()
    assert run(spark, [wide], text.strip) == [wide] and run(spark, [wide], text.collapse) == ["a b"]
    assert time.time() - started < 20


def test_rich_text_lines(spark):
    values = ["<p>a  b</p><p>c</P >d<br/>e<li\nx='1'>f</td>", "<pre>a</pre> <b>\r\nb</b>\x0b \x1e&amp;lt;\u2028c", "  a < b  ", "", "x > y", "&lt;p&gt;q&lt;/p&gt;"]
    assert run(spark, values, text.rich_text) == ["a b\nc\nd\ne\nf", "a\nb\n<\nc", "a < b", "", "x > y", "q"]


def test_format_points(spark):
    values = ["10.000000000", "7.50", "", "abc", " 3 ", "12345.65", "68423.45", "100000.5", "999999.5", "0.00001", "-2.25", "1234567.5", "0.125"]

    def expected(v):
        v = v.strip()
        try:
            x = float(v)
        except ValueError:
            return v
        return str(int(x)) if x.is_integer() else f"{x:g}"

    assert run(spark, values, numbers.format_points) == [expected(v) for v in values]


def test_labels(spark):
    assert run(spark, ["BUMG 660: Org Behavior!", "", "!!!"], text.safe_label) == ["BUMG_660_Org_Behavior", "export", "export"]
    assert run(spark, [" Label :: ", "a  b:"], text.clean_label) == ["Label", "a b"]
    assert run(spark, ["bad\x00char\x0b"], text.xml_safe) == ["bad char "]
    assert run(spark, ["<p>a<script>x</p></script> b&nbsp;c</p>"], text.html_to_text) == ["a b c"]


def test_href(spark):
    values = ["/a%20b\\c.html?x=1#t", "a+b%2B.pdf", "bad%zz.doc", "%E9x", "http://a/b.c", ""]
    assert run(spark, values, paths.href_path_part) == [html.unescape(unquote(v)).replace("\\", "/").split("?")[0].split("#")[0].lstrip("/") for v in values]


def test_json_and_buckets(spark):
    values = ['a"b\\c/é\n\t\x0b\x1f', "日本😀", "\x7f"]
    assert run(spark, values, keys.json_string) == [json.dumps(v, ensure_ascii=False) for v in values]
    assert run(spark, values, lambda c: keys.json_string(c, True)) == [json.dumps(v) for v in values]
    titles = ["Self-Assessment", "Learning Objectives", "Midterm", "Week 1 Overview and Learning Materials", "Example", "exams"]
    assert run(spark, titles, classify.heading_bucket) == ["practice", "objectives", "assessments", "resources", None, "assessments"]
    assert run(spark, titles[3:4], lambda c: classify.heading_bucket(c, page_title=True)) == ["overview"]


@pytest.mark.parametrize("raw,day", [("2024-05-01T10:00:00Z", "2024-05-01"), ("2024-05-01", "2024-05-01"), ("soon", None), ("2024-13-01", None)])
def test_dates(spark, raw, day):
    got = run(spark, [raw], text.try_date)[0]
    assert (str(got) if got else None) == day
