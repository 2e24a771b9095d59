"""Column expressions over text: tokens, estimates, redaction, paths, names, windows, contexts."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import cache, reduce
from html import unescape as html_unescape

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

CHARS_PER_TOKEN = 4


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, however often ``then`` names it: inside lambdas nothing else keeps it from being
    computed once a name, and once an element."""
    return F.transform(F.array(value), then)[0]


def tokens(text: Column | str) -> Column:
    """Lower-case runs of letters, digits and underscores, in order."""
    return F.filter(F.split(F.lower(col(text)), "[^\\p{L}\\p{N}_]+"), lambda t: t != "")


def approx_tokens(text: Column | str) -> Column:
    return F.floor(F.length(col(text)) / CHARS_PER_TOKEN).cast("long")


def est_tokens(text: Column | str) -> Column:
    """As :func:`approx_tokens`, but 1 at least."""
    return F.greatest(F.lit(1).cast("long"), approx_tokens(text))


def content_hash(text: Column | str) -> Column:
    return F.sha2(F.encode(col(text), "UTF-8"), 256)


def git_blob_sha(data: Column | str) -> Column:
    """The object id that git gives a file of these bytes."""
    head = F.encode(F.concat(F.lit("blob "), F.octet_length(col(data)).cast("string")), "UTF-8")
    return F.sha1(F.concat(head, F.to_binary(F.lit("00"), F.lit("hex")), col(data)))


def read_text(data: Column | str) -> Column:
    """Bytes as UTF-8, with U+FFFD for what isn't."""
    return F.make_valid_utf8(col(data).cast("string"))


def looks_binary(data: Column | str) -> Column:
    """A zero byte among the first 8,192."""
    return F.hex(F.substring(col(data), 1, 8192)).rlike("^(..)*?00")


def apply_prefix(text: Column | str, policy: str, use: str) -> Column:
    """The task prefix of asymmetric embedders; policy ``none`` leaves the text as it is."""
    if policy == "none":
        return col(text)
    return F.concat(F.lit("task: code retrieval | " + ("query: " if use == "query" else "doc: ")), col(text))


@cache
def entity_tables() -> tuple[str, str, str]:
    """JSON of the standard library's HTML entities: names with ;, the old ones without, and misused code points."""
    from html import entities

    named = [{n: t for n, t in entities.html5.items() if n.endswith(";") is semicolon} for semicolon in (True, False)]
    points = {str(c): bytes([c]).decode("cp1252", "ignore") or chr(c) for c in range(0x80, 0xA0)} | {"0": "\ufffd", "13": "\r"}
    return json.dumps(named[0]), json.dumps(named[1]), json.dumps(points)


def unescape(text: Column | str) -> Column:
    """Character references become characters: numbers, names with a semicolon, and the old names without, the longest that
    fits. What isn't one stays."""
    whole_names, old_names, points = (F.from_json(F.lit(t), "map<string,string>") for t in entity_tables())
    reference = "^&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;?)"

    def number(name: Column) -> Column:
        digits = F.rtrim(F.substring(name, 2, 1 << 20), F.lit(";"))
        point = F.when(F.lower(F.substring(digits, 1, 1)) == "x", F.conv(F.substring(digits, 2, 1 << 20), 16, 10)).otherwise(digits).cast("decimal(38,0)")
        valid = (point < 0xD800) | point.between(0xE000, 0x10FFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, point).otherwise(0xFFFD).cast("long")), 8, "0")), "UTF-32")
        return F.coalesce(F.try_element_at(points, point.cast("string")), char)

    def one(piece: Column) -> Column:
        return let(F.regexp_extract(piece, reference, 1), lambda name: decoded(piece, name))

    def decoded(piece: Column, name: Column) -> Column:
        behind = F.substring(piece, F.length(name) + 2, F.length(piece))
        shorter = F.transform(F.sequence(F.length(name), F.lit(1), F.lit(-1)), lambda n: F.substring(name, F.lit(1), n))
        found = F.try_element_at(F.filter(shorter, lambda n: F.map_contains_key(old_names, n)), F.lit(1))
        by_old = let(found, lambda old: F.concat(F.try_element_at(old_names, old), F.substring(piece, F.length(old) + 2, F.length(piece))))
        named = F.coalesce(F.concat(F.try_element_at(whole_names, name), behind), by_old)
        return F.when(name == "", piece).when(name.startswith("#"), F.concat(number(name), behind)).otherwise(F.coalesce(named, piece))

    def all_of(whole: Column) -> Column:
        return F.when(F.contains(whole, F.lit("&")), F.array_join(F.transform(F.split(whole, "(?=&)"), one), "")).otherwise(whole)

    return let(col(text), all_of)


#: The references that the pages' SQL decodes, in its order.
PAGE_REFERENCES = ("&lt;", "&gt;", "&quot;", "&#39;", "&nbsp;", "&copy;", "&middot;", "&amp;")


def unescape_only(text: Column | str, references: tuple[str, ...]) -> Column:
    """Just these references become characters, one after the other; all others stay, cut ones and those without a semicolon too."""
    return reduce(lambda t, r: F.replace(t, F.lit(r), F.lit(html_unescape(r))), references, col(text))


def strip_tags(html: Column | str) -> Column:
    """Tags become blanks, entities characters, runs of white space one blank."""
    return F.trim(F.regexp_replace(unescape(F.regexp_replace(col(html), "<[^>]+>", " ")), "(?U)\\s+", " "))


def strip_tags_only(html: Column | str, references: tuple[str, ...]) -> Column:
    """As :func:`strip_tags`, with :func:`unescape_only`."""
    return F.trim(F.regexp_replace(unescape_only(F.regexp_replace(col(html), "<[^>]+>", " "), references), "(?U)\\s+", " "))


#: Prefixes behind which a run of token characters is a secret.
SECRET_PREFIXES = ("sk_live_", "sk_test_", "sk-")
REDACTED = "***REDACTED***"


def redact(text: Column | str, prefixes: tuple[str, ...] = SECRET_PREFIXES) -> Column:
    """Prefixed keys and bearer tokens become ``***REDACTED***`` behind their prefix; again changes nothing."""
    keyed = F.regexp_replace(col(text), f"(?i)\\b({'|'.join(prefixes)})[A-Za-z0-9_\\-]{{4,}}", f"$1{REDACTED}")
    return F.regexp_replace(keyed, "(?i)\\b(Bearer\\s+)[A-Za-z0-9_\\-.]{4,}", f"$1{REDACTED}")


# What the names of parameters with credentials end with, in lower case; what shows credentials in any value; and
# the replacement.
CREDENTIAL_NAMES = (
    "signature", "credential", "accesskeyid", "publickey", "signedheaders", "sign-algorithm", "q-ak", "token",
)
CREDENTIAL_VALUE = "AKID[A-Za-z0-9]{6,}|(?i)pre-?signed"
SIGNED_URL = "__REDACTED_SIGNED_URL__"


def parameters(query: Column) -> Column:
    """The (name, value) pairs of a query string, with those of an address within a value, encoded or not. A parameter without = has a
    null value."""
    pieces = F.split(query, "[?&]|(?i)%3F|%26")

    def pair(piece: Column) -> Column:
        sides = F.split(piece, "=|(?i)%3D", 2)
        return F.struct(F.lower(sides[0]).alias("name"), F.try_element_at(sides, F.lit(2)).alias("value"))

    return F.transform(pieces, pair)


def carries_credentials(query: Column) -> Column:
    """Whether a query string has a parameter that signs it, or a value that shows a key."""

    def signs(pair: Column) -> Column:
        return pair["value"].isNotNull() & F.exists(F.array(*map(F.lit, CREDENTIAL_NAMES)), lambda end: F.endswith(pair["name"], end))

    return F.exists(parameters(query), signs) | query.rlike(CREDENTIAL_VALUE)


def redact_signed_urls(text: Column | str) -> Column:
    """struct<text, n>: addresses whose query carries credentials lose it; n counts them.

    The text is cut into addresses and what stands between them; an address ends at white space, a quote, a backslash or a comma.
    """
    address = "https?://[^\\s\"'\\\\,]+"
    pieces = F.regexp_extract_all(col(text), F.lit(f"(?s){address}|.+?(?={address}|\\z)"), F.lit(0))

    def one(piece: Column) -> Column:
        base = F.substring_index(piece, "?", 1)
        query = F.substring(piece, F.length(base) + 2, F.length(piece))
        signed = piece.rlike(f"^{address}$") & base.rlike("^https?://.") & carries_credentials(query)
        return F.struct(signed.alias("signed"), F.when(signed, F.concat(base, F.lit(f"?{SIGNED_URL}"))).otherwise(piece).alias("text"))

    done = F.transform(pieces, one)
    return F.struct(F.array_join(F.transform(done, lambda x: x["text"]), "").alias("text"), F.size(F.filter(done, lambda x: x["signed"])).alias("n"))


def safe_file_name(name: Column | str) -> Column:
    return F.regexp_replace(col(name), "[^A-Za-z0-9_.-]+", "-")


def safe_table_name(name: Column | str) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(col(name)), "[^a-z0-9_]", "_"), "^_+|_+$", "")


def family(slug: Column | str) -> Column:
    """The leading letters of a slug, with one more part if that has letters too."""
    return F.regexp_extract(col(slug), "^([a-z]+(?:-[a-z]+)?)", 1)


def tolerant_int(value: Column | str) -> Column:
    """An integer read by way of a double; 0 where it isn't a number."""
    return F.coalesce(col(value).try_cast("double").try_cast("long"), F.lit(0).cast("long"))


def tri_state(value: Column | str) -> Column:
    """true for true, t and 1; null stays null; else false."""
    return F.when(col(value).isNotNull(), F.lower(F.trim(col(value))).isin("true", "t", "1"))


def retry_delay(attempt: Column | str, retry_after: Column | str) -> Column:
    """Seconds to wait: a numeric header that isn't negative wins, else 2, 4, 8 .. 30."""
    header = col(retry_after).try_cast("double")
    return F.coalesce(F.when(header >= 0, header), F.least(F.lit(30.0), 2.0 * F.pow(F.lit(2.0), col(attempt) - 1)))


def compact_content(content: Column | str, location: Column | str, cap: int = 4000) -> Column:
    """Content of up to ``cap`` characters; longer is cut at the last line end within, or at ``cap``, and marked."""
    c = col(content)
    head = F.substring(c, 1, cap)
    newline = F.length(head) - F.instr(F.reverse(head), "\n")
    cut = F.when(F.instr(head, "\n") > 1, F.substring(head, F.lit(1), newline)).otherwise(head)
    mark = F.concat(F.lit("\n[... "), (F.length(c) - F.length(cut)).cast("string"), F.lit(" chars omitted: "), col(location), F.lit("]"))
    return F.when(F.length(c) <= cap, c).otherwise(F.concat(cut, mark))


def needle_context(needle: str, filler_tokens: int, position: float, filler: str) -> Column:
    """A filler text with the needle on a line of its own at a relative position."""
    if not 0.0 <= position <= 1.0:
        raise ValueError(f"position is outside of 0 to 1: {position}")
    body = filler * max(1, filler_tokens // 10)
    at = int(len(body) * position)
    return F.concat(F.lit(body[:at]), F.lit(f"\n{needle}\n"), F.lit(body[at:]))


def markdown_cell(value: Column | str, width: int = 120) -> Column:
    """One line, pipes escaped, cut to ``width`` with an ellipsis."""
    line = F.replace(F.regexp_replace(col(value), "\\s*\n\\s*", " "), F.lit("|"), F.lit("\\|"))
    return F.when(F.length(line) > width, F.concat(F.substring(line, 1, width - 1), F.lit("…"))).otherwise(line)


#: What a file's extension says of it, and names without one (fixed values).
EXTENSION_KIND = {
    ".py": ("code", "python"), ".js": ("code", "javascript"), ".ts": ("code", "typescript"), ".tsx": ("code", "tsx"),
    ".go": ("code", "go"), ".cs": ("code", "csharp"), ".sh": ("code", "bash"), ".bash": ("code", "bash"),
    ".md": ("doc", "markdown"), ".markdown": ("doc", "markdown"), ".yaml": ("config", "yaml"), ".yml": ("config", "yaml"),
    ".toml": ("config", "toml"), ".json": ("config", "json"),
}
NAME_KIND = {"dockerfile": "code", "makefile": "code", "readme": "doc"}
EXCLUDED_NAMES = (
    "package-lock.json", "yarn.lock", "pnpm-lock.yaml", "poetry.lock", "uv.lock", "cargo.lock", "composer.lock", "requirements.txt",
)
EXCLUDED_FOLDERS = ("vendor", "node_modules", ".venv", "dist", "build")
MAX_FILE_BYTES = 512 * 1024


def classify_path(path: Column | str) -> Column:
    """struct<kind, lang> of a path, null where the file isn't indexed."""
    p = col(path)
    name = F.lower(F.regexp_extract(p, "([^/]*)$", 1))
    extension = F.regexp_extract(name, "[^.](\\.[^.]+)$", 1)
    kinds = F.create_map(*[F.lit(x) for e, (k, _) in EXTENSION_KIND.items() for x in (e, k)])
    langs = F.create_map(*[F.lit(x) for e, (_, g) in EXTENSION_KIND.items() for x in (e, g)])
    names = F.create_map(*[F.lit(x) for pair in NAME_KIND.items() for x in pair])
    folders = F.filter(F.split(F.regexp_extract(p, "^(.*)/[^/]*$", 1), "/"), lambda f: f.isin(*EXCLUDED_FOLDERS))
    kind = F.when(extension != "", F.try_element_at(kinds, extension)).otherwise(F.try_element_at(names, name))
    skip = name.isin(*EXCLUDED_NAMES) | (F.size(folders) > 0) | kind.isNull()
    return F.when(~skip, F.struct(kind.alias("kind"), F.try_element_at(langs, extension).alias("lang")))


def redact_map(values: Column | str) -> Column:
    """Headers and other maps of strings with redacted values."""
    return F.transform_values(col(values), lambda _, v: redact(v))


def redact_array(values: Column | str) -> Column:
    return F.transform(col(values), lambda v: redact(v))


def redact_nested(value: Column | str, schema: DataType) -> Column:
    """A value of any nested type with each string in it redacted; keys of maps, nulls and other types stay."""
    c = col(value)
    if isinstance(schema, StringType):
        return redact(c)
    if isinstance(schema, ArrayType):
        return F.transform(c, lambda v: redact_nested(v, schema.elementType))
    if isinstance(schema, MapType):
        return F.transform_values(c, lambda _, v: redact_nested(v, schema.valueType))
    if isinstance(schema, StructType):
        fields = [redact_nested(c[f.name], f.dataType).alias(f.name) for f in schema.fields]
        return F.when(c.isNotNull(), F.struct(*fields)) if fields else c
    return c


def redact_columns(rows: DataFrame, *columns: str) -> DataFrame:
    """``rows`` with columns (all, if none is named) redacted by :func:`redact_nested`."""
    return rows.withColumns({c: redact_nested(F.col(f"`{c}`"), rows.schema[c].dataType) for c in columns or rows.columns})


def redact_json(text: Column | str) -> Column:
    """A JSON text with each string value redacted, at any depth; names stay. What isn't JSON is redacted as plain text.

    Strings are unescaped before they are looked at and escaped again, so no escape hides a key or its beginning.
    """
    whole = col(text)
    pieces = F.regexp_extract_all(whole, F.lit('"[^"\\\\]*+(?:\\\\.[^"\\\\]*+)*+"(?:\\s*+:)?+|[^"]++'), F.lit(0))

    def one(piece: Column) -> Column:
        plain = F.get_json_object(F.concat(F.lit('{"v":'), piece, F.lit("}")), "$.v")
        shown = F.to_json(F.struct(redact(plain).alias("v")))
        return F.when(piece.startswith('"') & piece.endswith('"'), F.substring(shown, F.lit(6), F.length(shown) - 6)).otherwise(piece)

    return F.when(F.try_parse_json(whole).isNotNull(), F.array_join(F.transform(pieces, one), "")).otherwise(redact(whole))


def is_reasoning_model(group: Column | str, without: tuple[str, ...]) -> Column:
    """Not one of the groups that never reason, with or without ``-fast``."""
    return ~F.regexp_replace(col(group), "-fast$", "").isin(*without)


def can_switch_off(group: Column | str, prefixes: tuple[str, ...]) -> Column:
    """Not of a family that rejects switching its reasoning off."""
    can = F.lit(True)
    for p in prefixes:
        can = can & ~col(group).startswith(p)
    return can


def with_default(key: Column | str, values: dict[str, str], default: str) -> Column:
    """A setting by name, or the default."""
    table = F.create_map(*[F.lit(x) for pair in values.items() for x in pair]) if values else F.create_map().cast("map<string,string>")
    return F.coalesce(F.try_element_at(table, col(key)), F.lit(default))
