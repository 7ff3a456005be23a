import hashlib
import html
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from tillage.functions import relevance, text, urls


def apply(spark, f, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


STRINGS = ["  Straße\tCẢI  Xanh\n", "ΑΣ  ς", "a\u00a0b\u2003c", "", " “Hỏi” `gì`, (đó)? ", "x-y_z/w"]


def test_normal_forms_equal_python(spark):
    fold = lambda s: " ".join(s.casefold().split())
    assert apply(spark, text.normalize, STRINGS) == [fold(s) for s in STRINGS]
    public = lambda s: fold("".join(" " if c in text.PUBLIC_PUNCTUATION else c for c in s))
    assert apply(spark, text.normalize_public, STRINGS) == [public(s) for s in STRINGS]
    sig = lambda s: " ".join("".join(" " if c in text.SIGNATURE_PUNCTUATION else c for c in fold(s)).split())
    assert apply(spark, text.signature, STRINGS) == [sig(s) for s in STRINGS]


def test_ids(spark):
    want = ["DQ-" + hashlib.sha256(s.encode()).hexdigest()[:12].upper() for s in STRINGS]
    assert apply(spark, lambda c: text.stable_id("DQ-", c), STRINGS) == want


def test_cleaning(spark):
    values = ["a &amp; b", "&lt;p&gt;x&lt;/p&gt; <b>y</b>", None, "&amp;lt;", "&quot;q&quot;&nbsp;z"]
    assert apply(spark, text.clean_web_text, values) == [" ".join(html.unescape(v or "").split()) for v in values]
    strip = lambda v: " ".join(re.sub("<[^>]+>", " ", html.unescape(v or "")).split())
    assert apply(spark, text.clean_markup_text, values) == [strip(v) for v in values]
    odd = ["&eacute;&#64;&#x27;&#39;", "&notit; &not;in &noti", "&#128;&#x81;&#150;", "&#0;&#13;x&#55296;&#1114112;&#99999999999999;", "&#x1;&#xB;&#xFFFE;y", "& &; &# &#; &#x; &x", "&amp;amp; &AMP &ampx; &lt&gt", "&CounterClockwiseContourIntegral;&fjlig;", "a &unknown; b &copy2 &frac12x", "\U0001f600 &#128512; &#x1F600", ""]
    assert apply(spark, text.unescape, [*odd, None]) == [*map(html.unescape, odd), None]


def test_case_folding_of_every_character(spark):
    # Of characters that Python's Unicode version doesn't have yet the JVM may know more.
    every = [chr(i) for i in range(1, 0x20000) if unicodedata.category(chr(i)) not in ("Cn", "Cs")]
    blocks = ["".join(every[i : i + 400]) for i in range(0, len(every), 400)]
    assert apply(spark, text.casefold, blocks) == [b.casefold() for b in blocks]
    odd = [c for c in every if c.casefold() not in (c, c.lower())]
    assert len(odd) > 200 and apply(spark, text.casefold, odd) == [c.casefold() for c in odd]
    mixed = ["", "plain", "Straße ẞ ﬃ", "ΑΣ", "ΟΔΟΣ ς", "İstanbul", "ᾈͅ ΐ", "ŉ ǰ և", "Ꭰ ꭰ", "CẢI Đậu"]
    assert apply(spark, text.casefold, [*mixed, None]) == [*[s.casefold() for s in mixed], None]


def test_available_terms(spark):
    lists = [["", "a", "a", "b"], ["x"], [], [""]]
    assert apply(spark, text.first_available, lists, "array<string>") == ["a", "x", "", ""]
    assert apply(spark, text.second_available, lists, "array<string>") == ["b", "x", "", ""]


CASES = {
    "HTTPS://Example.COM:443/A/?utm_source=x&b=2&a=1#f": "https://example.com/A?a=1&b=2",
    "http://h.com/": "http://h.com",
    "http://h.com:80/x.html/": "http://h.com/x.html",
    "https://h.com:80/x": "https://h.com:80/x",
    "https://h.com/p?page=2&ref=x": "https://h.com/p?page=2&ref=x",
    "https://h.com/p?FBCLID=1&k=": "https://h.com/p?k=",
    "//h.com/x": "",
    "h.com/x": "",
    "": "",
    "ftp://h.com/x": "ftp://h.com/x",
    "https://h.com/p?a=1&&b=%C3%A9+z*~&c": "https://h.com/p?a=1&b=%C3%A9+z%2A~&c=",
}


def test_canonical_urls(spark):
    got = apply(spark, urls.canonicalize, list(CASES))
    assert got == list(CASES.values())
    valid = [u for u in got if u.startswith("http")]
    assert apply(spark, urls.canonicalize, valid) == valid
    assert apply(spark, urls.canonicalize, [None]) == [""]
    assert apply(spark, urls.is_valid, ["ftp://h.com/x", "http://h", "http:///x", None, "HTTP://H"]) == [False, True, False, False, True]
    assert apply(spark, urls.domain, ["https://u@h.com:81/x"]) == ["u@h.com:81"]


def test_matching_has_ascii_borders(spark):
    values = ["bị đúng rồi", "chúng ta", "heat-stress and heat", "Ngập  ÚNG", "pre-úng2"]
    got = apply(spark, lambda c: relevance.matched_terms(relevance.match_form(c), ["úng", "heat", "heat stress", "ngập úng"]), values)
    assert got == [["úng"], [], ["heat stress", "heat"], ["ngập úng", "úng"], []]
    own = ["úng", "Heat-Stress", "", "ngập úng"]
    terms = spark.createDataFrame([(v, own, [relevance.folded_term(t) for t in own]) for v in values], "v string, t array<string>, f array<string>")
    hits = relevance.term_hits(relevance.match_form(F.col("v")), ["úng", "heat", "heat stress", "ngập úng"])
    assert [r.x for r in terms.select(relevance.picked_of(hits, F.col("t"), F.col("f")).alias("x")).collect()] == [["úng"], [], ["Heat-Stress"], ["ngập úng", "úng"], []]


def test_one_pass_finds_what_a_regex_for_each_term_finds(spark):
    """Nested, overlapping and odd terms over random texts."""
    rng = random.Random(2)
    letters = "ab1 ứ.+-"
    terms = ["a", "ab", "a b", "ab a", "b a", "ứ", "ứa", "a.b", "a+b", "1", "1 a b", "ab-ứ", "(a", "a*b", "\\", "x y z", "aa", "A B", " ", ""]
    values = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 40))) for _ in range(400)] + ["(a", "\\ a", ""]
    form = lambda v: " ".join(re.sub("[-_/]+", " ", v).casefold().split())
    slow = lambda v: sorted({t for t in terms if form(t) and re.search(f"(?<![a-z0-9]){re.escape(form(t))}(?![a-z0-9])", form(v))}, key=lambda t: (len(t), t), reverse=True)
    assert apply(spark, lambda c: relevance.matched_terms(relevance.match_form(c), terms), values) == [slow(v) for v in values]


@pytest.mark.parametrize(
    ("sizes", "want"),
    [((0, 3, 0, 3, 1, 0), ("rejected_irrelevant", 0)), ((1, 0, 0, 0, 0, 0), ("rejected_irrelevant", 0)), ((1, 0, 1, 0, 0, 0), ("supporting_match", 5)), ((2, 9, 9, 9, 1, 0), ("direct_match", 19)), ((1, 1, 0, 0, 0, 2), ("rejected_irrelevant", 0)), ((1, 1, 0, 0, 1, 5), ("direct_match", 6)), ((0, 0, 0, 0, 0, 2), ("rejected_irrelevant", -2))],
)
def test_scores(spark, sizes, want):
    lists = [F.array(*[F.lit(f"t{i}") for i in range(n)]).cast("array<string>") for n in sizes]
    r = spark.range(1).select(relevance.assess(*lists).alias("r")).first().r
    assert (r.status, r.score) == want
