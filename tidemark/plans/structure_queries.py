"""Queries of definitions in sources made of the tables' texts, of redaction in nested values, and of percentiles of large groups."""

from __future__ import annotations

import hashlib
import struct
import uuid

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import telemetry
from ..operators.chunking import file_definitions
from ..sources.generations import Profile
from ..sources.registry import NotReady, Registry
from ..sources.versioned import versioned_files
from ..staging import new_path
from .fixtures import table
from .maintenance_queries import letters

LANGUAGES = ("javascript", "go", "csharp", "bash", "typescript")


def sources(spark, d):
    """A source for each document, whose text stands in a comment, a raw string, a here-document, always beside brackets that are
    no code."""
    docs = table(spark, d, "documents")
    text, k = F.translate(F.coalesce("text", F.lit("")), "\r", " "), F.col("doc_id").cast("string")

    def put(*parts: Column | str) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    javascript = put('const a = "{ not }"; // }\nfunction f', k, "(x) {\n/* ", F.replace(text, F.lit("*/"), F.lit("* /")),
                     ' */\n  const r = /[{]/.test(x) ? `{${x + "}"}` : "}";\n}\nclass C', k, " {\n}\n")
    go = put("package p\n\nfunc (t *T) F", k, "(v interface{}) error {\n\ts := `", F.translate(text, "`", "'"), "`\n\tr := '}'\n\treturn nil\n}\ntype K", k, " int\n")
    csharp = put("namespace N;\n\npublic sealed class A", k, '\n{\n    string S = @"', F.replace(text, F.lit('"'), F.lit('""')), '";\n    string U = $"{{{S}}} }}";\n    // }\n}\n')
    bash = put("f", k, "() {\n  cat <<'END'\n", F.replace(text, F.lit("END"), F.lit("end")), '\nEND\n  echo "$(echo "}")" # }\n}\n')
    typescript = put("export interface I", k, " {\n  // ", F.translate(text, "\n", " "), '\n}\nexport type U', k, ' =\n  | "{"\n  | "b"\nexport function g', k, "() {\n  return /}/\n}\n")
    lang = F.element_at(F.array(*map(F.lit, LANGUAGES)), (F.pmod("doc_id", F.lit(5)) + 1).cast("int"))
    source = F.when(lang == "javascript", javascript).when(lang == "go", go).when(lang == "csharp", csharp).when(lang == "bash", bash).otherwise(typescript)
    return docs.select(k.alias("path"), lang.alias("lang"), source.alias("content"))


def code_definitions(spark, d):
    """The top-level definitions of the sources."""
    return file_definitions(sources(spark, d))


def nested_redaction(spark, d):
    """Whole texts with keys in front, three levels deep in arrays of maps of structs, and in JSON."""
    docs = table(spark, d, "documents").withColumn("text", F.coalesce("text", F.lit("")))
    key = F.when(F.col("doc_id") % 2 == 0, F.lit('sk-abcd1234 "Bearer  x.y-z_1"\n')).otherwise(F.lit(""))
    secret = F.struct(F.concat(key, F.col("text")).alias("said"), F.col("doc_id").alias("n"))
    held = docs.select("doc_id", F.array(F.create_map(F.lit("sk-names-stay"), F.struct(F.array(secret).alias("list"))), F.map_from_arrays(F.array(), F.array())).alias("calls"))
    done = tx.redact_columns(held.withColumn("json", tx.redact_json(F.to_json("calls"))), "calls")

    def inner(calls: Column) -> Column:
        return calls[0]["sk-names-stay"]["list"][0]

    again = inner(F.from_json("json", held.schema["calls"].dataType))
    digest = lambda c: F.md5(F.encode(c, "UTF-8"))
    return done.select("doc_id", digest(inner(F.col("calls"))["said"]).alias("nested"), digest(again["said"]).alias("json"), again["n"].alias("n"))


def large_percentiles(spark, d):
    """Percentiles of prices by flag and over all rows, by selection in ranges of values."""
    lines = table(spark, d, "lineitem").select("l_returnflag", F.col("l_extendedprice").cast("double").alias("price"))
    one = telemetry.large_percentiles(lines, "price", (50, 90, 95), "l_returnflag")
    return one.unionByName(telemetry.large_percentiles(lines, "price", (50, 90, 95), floor=True).withColumn("l_returnflag", F.lit("all")))


def profile_status(spark, d):
    """Three profiles over whole texts: one of the head, in use; one of a commit before that; one that was never synced. Putting the
    last two to use is refused, which ``refused`` says."""
    files = table(spark, d, "documents").select(
        F.concat(F.lit("docs/"), F.col("doc_id").cast("string")).alias("path"), F.lit("code").alias("kind"), F.lit(None).cast("string").alias("lang"),
        tx.git_blob_sha(F.encode("text", "UTF-8")).alias("blob_sha"), F.regexp_replace("text", "\n", " ").alias("content"), "doc_id",
    )
    registry = Registry(spark, new_path(spark, "profiles"))
    for slug in ("first", "second", "third"):
        registry.register(Profile(slug, 4))
    registry.store("first").sync(files.drop("doc_id"), "r", head="h2", gate=False, call=letters)
    registry.store("second").sync(files.where("doc_id % 3 > 0").drop("doc_id"), "r", head="h1", gate=False, call=letters)
    registry.use("first", "h2", seen=registry.version())
    refused = {}
    for slug in ("second", "third"):
        try:
            registry.use(slug, "h2")
        except NotReady as e:
            refused[slug] = e.state
    said = F.create_map(*[F.lit(x) for pair in refused.items() for x in pair])
    return registry.status("h2").withColumn("refused", F.try_element_at(said, "profile"))


TREE_IDS = 2048


def _write_index(files: pd.DataFrame, folder: str) -> pd.DataFrame:
    """An index file (format 2) of a tree of its own; a task that is run again writes the same bytes."""
    tree, body = files["tree"].iloc[0], struct.pack(">4sII", b"DIRC", 2, len(files))
    for path, blob in sorted(zip(map(str.encode, files["path"]), files["blob_sha"])):
        entry = bytes(24) + struct.pack(">I", 0o100644) + bytes(12) + bytes.fromhex(blob) + struct.pack(">H", min(len(path), 0xFFF)) + path
        body += entry + bytes(8 - len(entry) % 8)
    system, top = fs.FileSystem.from_uri(folder)
    place = f"{top}/{tree}/.git"
    system.create_dir(place)
    attempt = f"{place}/{uuid.uuid4().hex}"
    with system.open_output_stream(attempt) as f:
        f.write(body + hashlib.sha1(body).digest())
    system.move(attempt, f"{place}/index")
    return pd.DataFrame({"tree": [tree], "files": [len(files)]})


def versioned_listing(spark, d):
    """Trees of 2,048 ids each, with a file for each text, written as index files and listed again; what the tree before hadn't got
    (ids that 7 divides weren't there, ids that 5 divides had another text) would be opened."""
    docs, folder = table(spark, d, "documents"), new_path(spark, "trees")
    text, name = F.coalesce("text", F.lit("")), F.element_at(F.array(*map(F.lit, ("md", "py", "bin", "cs"))), (F.pmod("doc_id", F.lit(4)) + 1).cast("int"))
    files = docs.select(
        F.floor(F.col("doc_id") / TREE_IDS).cast("string").alias("tree"), "doc_id",
        F.concat(F.lit("docs/"), F.col("doc_id").cast("string"), F.lit("-"), F.md5(F.encode(text, "UTF-8")), F.lit("."), name).alias("path"),
        tx.git_blob_sha(F.encode(text, "UTF-8")).alias("blob_sha"),
    ).distinct()
    files.groupBy("tree").applyInPandas(lambda pdf: _write_index(pdf, folder), "tree string, files long").count()
    listed = versioned_files(spark, folder).withColumn("tree", F.substring_index("root", "/", -1))
    before = files.where("doc_id % 7 <> 0").select("tree", "path", F.when(F.col("doc_id") % 5 == 0, F.lit("0" * 40)).otherwise(F.col("blob_sha")).alias("blob_sha"))
    found = listed.join(before.withColumn("known", F.lit(True)), ["tree", "path", "blob_sha"], "left")
    kind = tx.classify_path("path")["kind"]
    return found.select("tree", "path", "mode", "blob_sha", "stage", kind.alias("kind"), (kind.isNotNull() & F.col("known").isNull()).alias("opened"))


QUERIES = {f.__name__: f for f in (code_definitions, nested_redaction, large_percentiles, profile_status, versioned_listing)}

_SAID = "regexp_replace(regexp_replace(t, '\\b(sk_live_|sk_test_|sk-)[A-Za-z0-9_\\-]{4,}', '\\1***REDACTED***', 'gi'), '\\b(Bearer\\s+)[A-Za-z0-9_\\-.]{4,}', '\\1***REDACTED***', 'gi')"
ORACLE_SQL = {
    "code_definitions": """WITH t AS (SELECT doc_id::VARCHAR AS path, doc_id % 5 AS m, coalesce(text, '') AS x FROM documents), n AS (SELECT path, m, (length(x) - length(replace(x, chr(10), '')))::INT AS n FROM t),
        d(m, lang, name, named, a, b, grows, moves) AS (VALUES (0, 'javascript', 'f', true, 2, 5, 1, 0), (0, 'javascript', 'C', true, 6, 7, 1, 1), (1, 'go', 'F', true, 3, 7, 1, 0), (1, 'go', 'K', true, 8, 8, 1, 1),
          (2, 'csharp', 'N', false, 1, 1, 0, 0), (2, 'csharp', 'A', true, 3, 8, 1, 0), (3, 'bash', 'f', true, 1, 6, 1, 0), (4, 'typescript', 'I', true, 1, 3, 0, 0), (4, 'typescript', 'U', true, 4, 6, 0, 0), (4, 'typescript', 'g', true, 7, 9, 0, 0))
        SELECT path, lang, name || CASE WHEN named THEN path ELSE '' END AS name, a + moves * n AS first_line, b + grows * n AS last_line FROM n JOIN d USING (m)""",
    "nested_redaction": f"""WITH s AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'sk-abcd1234 "Bearer  x.y-z_1"' || chr(10) ELSE '' END || coalesce(text, '') AS t FROM documents)
        SELECT doc_id, md5({_SAID}) AS nested, nested AS json, doc_id AS n FROM s""",
    "large_percentiles": """WITH g AS (SELECT l_returnflag, list(l_extendedprice::DOUBLE ORDER BY l_extendedprice) AS v FROM lineitem GROUP BY 1), a AS (SELECT list(l_extendedprice::DOUBLE ORDER BY l_extendedprice) AS v FROM lineitem)
        SELECT l_returnflag, len(v)::BIGINT AS n, v[ceil(len(v) * 0.5::DOUBLE)::BIGINT] AS p50, v[ceil(len(v) * 0.9::DOUBLE)::BIGINT] AS p90, v[ceil(len(v) * 0.95::DOUBLE)::BIGINT] AS p95 FROM g
        UNION ALL SELECT 'all', len(v)::BIGINT, v[floor(len(v) * 0.5::DOUBLE)::BIGINT + 1], v[floor(len(v) * 0.9::DOUBLE)::BIGINT + 1], v[floor(len(v) * 0.95::DOUBLE)::BIGINT + 1] FROM a""",
    "versioned_listing": """WITH f AS (SELECT DISTINCT doc_id, coalesce(text, '') AS t FROM documents), k(m, ext, kind) AS (VALUES (0, 'md', 'doc'), (1, 'py', 'code'), (2, 'bin', NULL), (3, 'cs', 'code'))
        SELECT floor(doc_id / 2048)::BIGINT::VARCHAR AS tree, 'docs/' || doc_id || '-' || md5(t) || '.' || ext AS path, '100644' AS mode, sha1(encode('blob ' || strlen(t)) || '\\x00'::BLOB || encode(t)) AS blob_sha,
          0 AS stage, kind, kind IS NOT NULL AND (doc_id % 7 = 0 OR doc_id % 5 = 0) AS opened FROM f JOIN k ON doc_id % 4 = m""",
    "profile_status": """WITH w AS (SELECT doc_id, replace(text, chr(10), ' ') AS t FROM documents), c AS (SELECT DISTINCT doc_id, substr(t, i * 1600 + 1, 1600) FROM (SELECT doc_id, t, unnest(range(ceil(length(t) / 1600)::INT)) AS i FROM w WHERE trim(t) <> '')),
        n AS (SELECT count(DISTINCT doc_id) AS f1, count(*) AS c1, count(DISTINCT doc_id) FILTER (doc_id % 3 > 0) AS f2, count(*) FILTER (doc_id % 3 > 0) AS c2 FROM c)
        SELECT v.* FROM n, LATERAL (VALUES ('first', true, 1, 'h2', f1, c1, 0::BIGINT, 'ready', NULL), ('second', false, 1, 'h1', f2, c2, 0, 'stale', 'stale'), ('third', false, 0, NULL, 0, 0, 0, 'missing', 'missing'))
          v(profile, in_use, generation, head, files, chunks, unusable, state, refused)""",
}
