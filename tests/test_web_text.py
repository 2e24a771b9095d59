import hashlib
import html

from pyspark.sql import functions as F

from tests.test_responses import ev
from tidemark.functions import text as tx
from tidemark.functions import web

PAGE = """<html><head><title>Model A &amp; B</title><script type="application/ld+json">{"@graph": [{"@type": "Thing"}, {"@type": "Product", "brand": {"name": "Acme"},
"description": "d", "offers": {"price": "1.5", "priceCurrency": "USD", "availability": "https://schema.org/InStock"}}]}</script></head>
<span class="tag">Video</span><div class="vendor"> Acme <b>Co</b></div><p class="desc">short</p><span class="badge new">New</span><span class="badge">Fast</span>
<div class="price-cell"> <div class="num">$$0.5</div> <div class="label">Input / 1M</div></div><div class="price-cell"><div class="num">$2</div><div class="label">Output / 1M</div></div>
<h2>Model overview</h2><p>Some <i>text</i>.</p><h2>Best use cases</h2><ul><li>one</li><li> </li><li>two</li></ul>
<h2>Technical specifications</h2><table><tr><th>Property</th><th>Value</th></tr><tr><td>Context</td><td>8k</td></tr></table>
<div class="spec-item"><div class="spec-label">Token Price</div> <div class="spec-value">$9</div></div>
<h3>cURL</h3><pre><code>curl &amp; x</code></pre><h3>Python</h3><div class="code-block">import requests</div><h3>Other</h3><pre><code> </code></pre></html>"""

DOCS = """<h2 id="a">First</h2><p>Text <b>one</b></p><span class="method method-post">POST</span> <span class="endpoint">/v1/x</span>
<table><thead><tr><th>Name</th><th>Type</th></tr></thead><tbody><tr><td>a</td><td>int</td></tr><tr></tr></tbody></table><div class="alert warn">Careful</div>
<h3>Second</h3><pre><code>x = 1</code></pre>"""


def test_page(spark):
    page = ev(spark, PAGE)
    assert page(web.title) == "Model A & B" and page(web.vendor) == "Acme Co" and page(web.subtitle) == "short"
    assert page(web.badges) == ["New", "Fast"] and tuple(page(web.prices)) == ("$0.5", "$2")
    assert page(web.overview) == "Some text ." and page(web.use_cases) == ["one", "two"]
    assert page(web.specs) == {"Context": "8k", "Token Price": "$9"}
    assert [tuple(b) for b in page(web.code_blocks)] == [("cURL", "curl & x", "curl"), ("Python", "import requests", "python")]
    assert tuple(page(web.json_ld_product)) == ("Acme", "d", "1.5", "USD", "InStock", None)
    empty = ev(spark, "<p>nothing</p>")
    assert empty(web.title) is None and empty(web.overview) is None and empty(web.use_cases) == [] and empty(web.specs) == {}
    assert tuple(empty(web.prices)) == (None, None) and empty(web.code_blocks) == []
    assert tuple(ev(spark, '<span class="price-label">Input</span> <span class="price-value">$3</span>')(web.prices)) == ("$3", None)


def test_entities_as_the_standard_library_reads_them(spark):
    texts = ["caf&eacute; &#8217;s &#x1F600; &amp;lt;", "&notit; &not &nosuch; &nosuchthing &copyx &amp", "&#0; &#xD800; &#1114112; &#128; &#x80; &#13;", "a && b & c&", "&NotEqualTilde; &ngE; &lt&gt", "", "&#;&#x;&;"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", tx.unescape("t").alias("u")).collect()
    assert {r.i: r.u for r in rows} == {i: html.unescape(t) for i, t in enumerate(texts)}
    assert ev(spark, "<p>a&nbsp;&nbsp;b</p>&Auml;")(tx.strip_tags) == "a b Ä"


def test_an_own_page(spark):
    page = ev(spark, """<h2 class="x">best use cases</h2><h4>Small one</h4><h5>smaller</h5><h3>Run</h3>Use <code>fetch(&quot;a&quot;)</code> or
<pre><code class="py">import requests
  x = 1 &lt; 2</code></pre><h3>Shell</h3><div class="code-block">  curl -X POST</div><span class="tag">chat</span>
<script>{"size": "1024x1024", "n": 2, "size": "other", "seed": "", "image": "https://x/og-cover.png"}</script>""")
    assert page(web.use_cases) == ["Small one", "smaller"] and page(web.vendor) is None and page(web.headings) == ["best use cases", "Run", "Shell"]
    assert [tuple(b) for b in page(web.code_blocks)] == [("Run", 'fetch("a")', "node"), ("Run", "import requests\n  x = 1 < 2", "python"), ("Shell", "curl -X POST", "curl")]
    assert page(lambda c: web.parameters(c, ("size", "n", "seed", "image"))) == {"size": "1024x1024", "n": "2"}


def test_docs(spark):
    first, second = ev(spark, DOCS)(web.doc_sections)
    assert (first.level, first.title, first.anchor, first.endpoint, first.method, first.text) == (2, "First", "a", "/v1/x", "POST", "Text one")
    assert first.tables[0].headers == ["Name", "Type"] and first.tables[0].rows == [["a", "int"]] and first.alerts == ["Careful"]
    assert (second.level, second.title, second.anchor, second.codes) == (3, "Second", None, ["x = 1"])


def test_available(spark):
    assert ev(spark, '{"detail": "no such. Available: a, b ,c"}')(web.available_list) == ["a", "b", "c"] and ev(spark, "none")(web.available_list) == []


def test_redaction(spark):
    one = ev(spark, "key sk-abcdef and SK_LIVE_12345 and Bearer abc.def-1 end")(tx.redact)
    assert one == "key sk-***REDACTED*** and SK_LIVE_***REDACTED*** and Bearer ***REDACTED*** end"
    assert ev(spark, one)(tx.redact) == one
    signed = ev(spark, 'a https://h/p?X-Amz-Signature=1&b=2 "https://h/q?plain=1" https://h/r?Signature=z')(tx.redact_signed_urls)
    odd = "x https://h/a?next=https://i/b?token=1&c=2, http:// https://?sig https://h/q?mytoken=z\\n https://h/AKID12345678?a=1 https://h?k=AKID12345678"
    more = ev(spark, odd)(tx.redact_signed_urls)
    assert more.n == 3 and more.text == "x https://h/a?__REDACTED_SIGNED_URL__, http:// https://?sig https://h/q?__REDACTED_SIGNED_URL__\\n https://h/AKID12345678?a=1 https://h?__REDACTED_SIGNED_URL__"
    assert signed.text == 'a https://h/p?__REDACTED_SIGNED_URL__ "https://h/q?plain=1" https://h/r?__REDACTED_SIGNED_URL__' and signed.n == 2


def test_paths(spark):
    kinds = {"a/b.py": ("code", "python"), "README": ("doc", None), "x/Dockerfile": ("code", None), "c.YML": ("config", "yaml"), "d.tsx": ("code", "tsx"), "d.bin": None,
             "vendor/a.py": None, "a/poetry.lock": None, "requirements.txt": None, "build.md": ("doc", "markdown"), ".json": None}
    for path, want in kinds.items():
        got = ev(spark, path)(tx.classify_path)
        assert (tuple(got) if got else None) == want, path


def test_small_functions(spark):
    assert ev(spark, b"hello")(tx.git_blob_sha) == hashlib.sha1(b"blob 5\0hello").hexdigest()
    assert ev(spark, b"a\0b")(tx.looks_binary) is True and ev(spark, b"a\x10\x0fb")(tx.looks_binary) is False and ev(spark, b"x" * 8192 + b"\0")(tx.looks_binary) is False
    assert ev(spark, b"a\xffb")(tx.read_text) == "a�b"
    assert ev(spark, "x.y/z")(tx.safe_file_name) == "x.y-z" and ev(spark, "-A.b-")(tx.safe_table_name) == "a_b" and ev(spark, "abc-def-9")(tx.family) == "abc-def"
    assert [ev(spark, v)(tx.tolerant_int) for v in ("3.9", "x", None)] == [3, 0, 0] and [ev(spark, v)(tx.tri_state) for v in (" T ", "0", None)] == [True, False, None]
    assert [ev(spark, n, h)(tx.retry_delay) for n, h in ((1, None), (5, None), (9, None), (1, "7"), (2, "-1"), (2, "x"))] == [2.0, 30.0, 30.0, 7.0, 4.0, 4.0]
    assert ev(spark, "abc")(tx.est_tokens) == 1 and ev(spark, "abc")(tx.approx_tokens) == 0
    assert ev(spark, "one\ntwo three")(lambda c: tx.compact_content(c, F.lit("p"), 8)) == "one\n[... 10 chars omitted: p]"
    assert ev(spark, "a" * 10)(lambda c: tx.compact_content(c, F.lit("p"), 8)) == "a" * 8 + "\n[... 2 chars omitted: p]"
    assert ev(spark, "x")(lambda c: tx.needle_context("N", 20, 0.5, "0123456789")) == "0123456789\nN\n0123456789"
    assert ev(spark, "a|b\n c")(tx.markdown_cell) == "a\\|b c" and ev(spark, "q")(lambda c: tx.apply_prefix(c, "retrieval", "query")) == "task: code retrieval | query: q"


def test_a_section_is_looked_for_once(spark):
    html = spark.createDataFrame([("<h2>Technical specifications</h2><table><tr><td>a</td><td>1</td></tr><tr><td>a</td><td>2</td></tr></table>",)], "html string")
    found = html.select(web.specs("html").alias("specs"))
    assert found.first().specs == {"a": "2"}
    for column in (web.specs, web.use_cases, web.overview):
        plan = html.select(column("html").alias("x"))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("(?i)(?=<h[23]") == 1
