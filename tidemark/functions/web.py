"""Column expressions over HTML: titles, badges, sections, tables, code blocks, structured data.

A page's fields are rules, each an element's tag and class; sections are what stands between two headings.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, let, strip_tags, strip_tags_only, unescape

# The pages' names. Of a field's (tag, class) rules the first that finds text counts; a class with * is a prefix.
RULES = {
    "title": [("title", "")],
    "vendor": [("div", "vendor")],
    "tag": [("span", "tag")],
    "subtitle": [("p", "subtitle"), ("p", "desc")],
    "badges": [("span", "badge*")],
    "price input": [("span", "price-value")],
    "method": [("span", "method*")],
    "endpoint": [("span", "endpoint")],
    "alerts": [("div", "alert*")],
}
# Headings of sections, tags that name a kind of model instead of a vendor, heads of two-column tables, labels of
# prices, and what says which tool an example is for: words of its heading, the code's beginning, parts of the code.
OVERVIEW, USE_CASES, SPECIFICATIONS = "Model overview", "Best use cases", "Technical specifications"
CATEGORY_TAGS = ("video", "image", "3d", "audio", "chat", "embedding")
TABLE_HEADS = ("property", "value")
TOKEN_PRICE, PRICE_UNIT = "Token Price", "1m"
TOOLS = {
    "curl": (("curl",), "curl", ()),
    "python": (("python",), None, ("import requests", "openai", "OpenAI")),
    "node": (("node", "typescript", "javascript"), None, ("fetch(",)),
}
PREVIEW_IMAGE = "og-cover"


def element(tag: str, css: str = "") -> str:
    """A pattern of an element whose first group is its inner HTML."""
    token = css.removesuffix("*") + ('[^" ]*' if css.endswith("*") else "")
    named = f'(?=[^>]*\\sclass="(?:[^"]* )?{token}(?: [^"]*)?")' if css else ""
    return f"(?s)<{tag}(?=[\\s>]){named}[^>]*>(.*?)</{tag}>"


def inner(html: Column | str, tag: str, css: str = "") -> Column:
    """The inner HTML of every such element."""
    return F.regexp_extract_all(col(html), F.lit(element(tag, css)), F.lit(1))


def texts(html: Column | str, tag: str, css: str = "", references: tuple[str, ...] | None = None) -> Column:
    """The texts of every such element, without empty ones."""
    return F.filter(F.transform(inner(html, tag, css), strip_tags if references is None else lambda x: strip_tags_only(x, references)), lambda x: x != "")


def field(html: Column | str, name: str, references: tuple[str, ...] | None = None) -> Column:
    """The first text that a field's rules find; null for none."""
    return F.coalesce(*[F.try_element_at(texts(html, tag, css, references), F.lit(1)) for tag, css in RULES[name]])


def title(html: Column | str, references: tuple[str, ...] | None = None) -> Column:
    return field(html, "title", references)


def vendor(html: Column | str) -> Column:
    tag = field(html, "tag")
    return F.coalesce(field(html, "vendor"), F.when(~F.lower(tag).isin(*CATEGORY_TAGS), tag))


def subtitle(html: Column | str) -> Column:
    return field(html, "subtitle")


def badges(html: Column | str) -> Column:
    return texts(html, *RULES["badges"][0])


def parts(html: Column | str, levels: str = "23") -> Column:
    """array<struct<heading, body>>: a page cut before each heading of the levels; what stands first has a null heading."""
    cut = F.split(col(html), f"(?i)(?=<h[{levels}][\\s>])")
    head = f"(?is)^<h[{levels}](?:\\s[^>]*)?>(.*?)</h[{levels}]>"
    return F.transform(
        cut, lambda p: F.struct(F.when(p.rlike(head), strip_tags(F.regexp_extract(p, head, 1))).alias("heading"), F.regexp_replace(p, head, "").alias("body"))
    )


def headings(html: Column | str) -> Column:
    named = F.transform(parts(html), lambda p: p["heading"])
    return F.filter(named, lambda x: x.isNotNull() & (x != ""))


def section(html: Column | str, name: str) -> Column:
    """The HTML below a heading of that name, up to the next heading; null where there is none."""
    return F.try_element_at(F.filter(parts(html), lambda p: F.lower(p["heading"]) == name.lower()), F.lit(1))["body"]


def overview(html: Column | str, cap: int = 1200) -> Column:
    return let(F.substring(strip_tags(section(html, OVERVIEW)), 1, cap), lambda text: F.nullif(text, F.lit("")))


def use_cases(html: Column | str) -> Column:
    """The items of the section, or where it has none its small headings."""

    def of(part: Column) -> Column:
        small = F.concat(texts(part, "h4"), texts(part, "h5"))
        return let(texts(part, "li"), lambda items: F.coalesce(F.when(F.size(items) > 0, items), small, F.array().cast("array<string>")))

    return let(section(html, USE_CASES), of)


def last_of_each(entries: Column) -> Column:
    """Of entries (k, v) with one key, the last."""
    return let(entries, lambda all: F.filter(all, lambda e, i: ~F.exists(F.slice(all, i + 2, F.size(all)), lambda other: other["k"] == e["k"])))


def specs(html: Column | str) -> Column:
    """map of a page's specification table and cards; of a repeated label the last value."""
    rows = let(F.coalesce(section(html, SPECIFICATIONS), F.lit("")), lambda part: html_table(part)["rows"])
    table = F.transform(F.filter(rows, lambda r: F.size(r) > 1), lambda r: F.struct(r[0].alias("k"), r[1].alias("v")))
    cards = F.transform(
        F.arrays_zip(inner(html, "div", "spec-label").alias("k"), inner(html, "div", "spec-value").alias("v")),
        lambda e: F.struct(strip_tags(e["k"]).alias("k"), strip_tags(e["v"]).alias("v")),
    )
    said = F.filter(F.concat(table, cards), lambda e: (e["k"] != "") & (e["v"] != "") & ~F.lower(e["k"]).isin(*TABLE_HEADS))
    return F.map_from_entries(last_of_each(said))


def prices(html: Column | str) -> Column:
    """struct<input, output>: from price cells by the million, else from labelled values, the input also from the specifications."""
    cells = F.transform(
        F.arrays_zip(inner(html, "div", "num").alias("v"), inner(html, "div", "label").alias("k")),
        lambda e: F.struct(F.lower(strip_tags(e["k"])).alias("k"), strip_tags(e["v"]).alias("v")),
    )
    labelled = F.arrays_zip(inner(html, "span", "price-label").alias("k"), inner(html, "span", "price-value").alias("v"))

    def of(kind: str, *others: str) -> Column:
        def mine(e: Column) -> Column:
            unlike = [~F.contains(e["k"], F.lit(o)) for o in others]
            return F.contains(e["k"], F.lit(kind)) & F.contains(e["k"], F.lit(PRICE_UNIT)) & (unlike[0] if unlike else F.lit(True))

        by_cell = F.try_element_at(F.filter(cells, mine), F.lit(-1))["v"]
        by_label = F.try_element_at(F.filter(labelled, lambda e: F.lower(strip_tags(e["k"])) == kind), F.lit(1))["v"]
        said = F.coalesce(by_cell, let(strip_tags(by_label), lambda text: F.nullif(text, F.lit(""))))
        return let(said, lambda found: F.when(found.startswith("$$"), F.substring(found, 2, 1 << 20)).otherwise(found))

    return F.struct(F.coalesce(of("input"), F.try_element_at(specs(html), F.lit(TOKEN_PRICE))).alias("input"), of("output", "input").alias("output"))


def plain(html: Column) -> Column:
    """The text of code: its white space stays as it is."""
    return F.trim(unescape(F.regexp_replace(html, "<[^>]+>", "")))


def code_blocks(html: Column | str) -> Column:
    """array<struct<lang, code, kind>>: code in order (blocks, cards and inline code), with the third-level heading before it and
    the tool it is for."""
    blocks = "(?s)(?:<pre>\\s*<code[^>]*>|<div class=\"code-block\">|<code>)(.*?)(?:</code>|</div>)"

    def of(part: Column) -> Column:
        codes = F.filter(F.transform(F.regexp_extract_all(part["body"], F.lit(blocks), F.lit(1)), plain), lambda c: c != "")
        return F.transform(codes, lambda c: F.struct(part["heading"].alias("lang"), c.alias("code"), code_kind(c, part["heading"]).alias("kind")))

    return F.flatten(F.transform(parts(html, "3"), of))


def code_kind(code: Column, lang: Column) -> Column:
    """The first tool of TOOLS whose words are in the heading, or whose marks are in the code."""
    heading, kind = F.lower(F.coalesce(lang, F.lit(""))), F.lit("other")
    for tool, (words, begin, marks) in reversed(TOOLS.items()):
        signs = [F.contains(heading, F.lit(w)) for w in words] + [F.contains(code, F.lit(m)) for m in marks]
        signs += [F.ltrim(code).startswith(begin)] if begin else []
        kind = F.when(F.exists(F.array(*signs), lambda x: x), tool).otherwise(kind)
    return kind


def json_ld_product(html: Column | str) -> Column:
    """struct<brand, description, price, currency, availability, price_valid_until> of the last Product in a page's JSON-LD."""
    raw = F.regexp_extract(col(html), '(?s)<script type="application/ld\\+json">(.*?)</script>', 1)
    graph = let(raw, lambda r: F.coalesce(F.get_json_object(r, "$.@graph"), F.get_json_object(r, "$['@graph']"), r))
    listed = let(graph, lambda g: F.when(F.ltrim(g).startswith("["), g).otherwise(F.concat(F.lit("["), g, F.lit("]"))))
    product = F.try_element_at(F.filter(F.from_json(listed, "array<string>"), lambda n: F.get_json_object(n, "$['@type']") == "Product"), F.lit(-1))

    def fields(product: Column) -> Column:
        get = lambda p: let(F.get_json_object(product, p), lambda text: F.nullif(text, F.lit("")))
        brand = let(get("$.brand"), lambda text: F.when(F.ltrim(text).startswith("{"), get("$.brand.name")).otherwise(text))
        return F.struct(
            brand.alias("brand"), get("$.description").alias("description"), get("$.offers.price").alias("price"), get("$.offers.priceCurrency").alias("currency"),
            F.substring_index(get("$.offers.availability"), "/", -1).alias("availability"), get("$.offers.priceValidUntil").alias("price_valid_until"),
        )

    return let(product, fields)


def available_list(text: Column | str) -> Column:
    """The names behind ``Available:`` in an error message."""
    raw = F.rtrim(F.regexp_extract(col(text), "Available:\\s*(.+)", 1), F.lit('"}'))
    return F.filter(F.transform(F.split(raw, ","), lambda x: F.trim(x)), lambda x: x != "")


def doc_sections(html: Column | str) -> Column:
    """array<struct<level, title, anchor, endpoint, method, text, tables, codes, alerts>> of a documentation page's h2 and h3."""
    whole = F.filter(F.split(col(html), "(?=<h[23][ >])"), lambda p: p.rlike("(?s)^<h[23][^>]*>.*?</h[23]>"))

    def one(p: Column) -> Column:
        body = F.regexp_replace(p, "(?s)^<h[23][^>]*>.*?</h[23]>", "")
        tables = F.transform(inner(body, "table"), html_table)
        codes = F.transform(F.flatten(F.transform(inner(body, "pre"), lambda c: inner(c, "code"))), plain)
        method, endpoint = field(body, "method"), field(body, "endpoint")
        both = method.isNotNull() & endpoint.isNotNull()
        return F.struct(
            F.regexp_extract(p, "^<h([23])", 1).cast("int").alias("level"), F.nullif(strip_tags(F.regexp_extract(p, "(?s)^<h[23][^>]*>(.*?)</h[23]>", 1)), F.lit("")).alias("title"),
            F.nullif(F.regexp_extract(p, '^<h[23]\\s+id="([^"]*)"', 1), F.lit("")).alias("anchor"), F.when(both, endpoint).alias("endpoint"), F.when(both, method).alias("method"),
            F.array_join(texts(body, "p"), " ").alias("text"), tables.alias("tables"), F.filter(codes, lambda c: c != "").alias("codes"),
            texts(body, *RULES["alerts"][0]).alias("alerts"),
        )

    return F.transform(whole, one)


def html_table(table: Column) -> Column:
    """struct<headers, rows> of a table's inner HTML; rows are the texts of td cells."""
    body = F.coalesce(F.try_element_at(inner(table, "tbody"), F.lit(1)), table)
    rows = F.transform(inner(body, "tr"), lambda r: F.transform(inner(r, "td"), strip_tags))
    head = F.coalesce(F.try_element_at(inner(table, "thead"), F.lit(1)), F.lit(""))
    return F.struct(F.transform(inner(head, "th"), strip_tags).alias("headers"), F.filter(rows, lambda r: F.size(r) > 0).alias("rows"))


def parameters(html: Column | str, keys: tuple[str, ...]) -> Column:
    """map of the request parameters that a page's examples show: the first value of each key, without the preview image's."""
    members = F.regexp_extract_all(col(html), F.lit('"([A-Za-z_]\\w*)"\\s*:\\s*("[^"\\n]*"|[^,}\\n]+)'), F.lit(0))
    entries = F.transform(
        members,
        lambda m: F.struct(
            F.substring_index(F.substring(m, 2, 1 << 20), '"', 1).alias("k"), F.trim(F.regexp_extract(m, '^"[^"]*"\\s*:\\s*"?([^"]*)', 1)).alias("v")
        ),
    )
    wanted = F.filter(entries, lambda e: e["k"].isin(*keys) & (e["v"] != "") & ~F.contains(e["v"], F.lit(PREVIEW_IMAGE)))
    return F.map_from_entries(F.reverse(last_of_each(F.reverse(wanted))))
