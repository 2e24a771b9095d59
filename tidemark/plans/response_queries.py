"""Queries of verdicts over recorded responses, whose bodies are made of the tables' own texts and vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import responses as rs
from ..functions import text as tx
from ..functions import web
from .fixtures import table


def js(**fields: Column) -> Column:
    """A JSON object; null fields are left out."""
    return F.to_json(obj(**fields))


def obj(**fields: Column) -> Column:
    return F.struct(*[v.alias(k) for k, v in fields.items()])


def of(k: Column, *values) -> Column:
    """One of the values, by a number."""
    return F.element_at(F.array(*[v if isinstance(v, Column) else F.lit(v) for v in values]), (k % len(values) + 1).cast("int"))


def message(content: Column, finish="stop", **rest: Column) -> Column:
    return F.array(obj(finish_reason=finish if isinstance(finish, Column) else F.lit(finish), message=obj(content=content, **rest)))


def num() -> Column:
    return F.col("doc_id")


def txt() -> Column:
    return F.col("text")


def documents(spark, d):
    return table(spark, d, "documents").withColumn("text", F.coalesce("text", F.lit("")))


def verdicts(spark, d, **found: Column):
    """doc_id, and ok and evidence of each verdict."""
    both = [part for name, v in found.items() for part in (v["ok"].alias(f"{name}_ok"), v["evidence"].alias(name))]
    return documents(spark, d).select("doc_id", *both)


def thinking_senses(spark, d):
    on = js(choices=message(F.lit("a"), reasoning_content=F.when(num() % 2 == 0, txt())))
    off = F.when(num() % 7 == 0, "{}").otherwise(js(choices=message(F.lit("a"), reasoning_content=F.when(num() % 3 == 0, txt()))))
    return documents(spark, d).select("doc_id", rs.thinking_sense(on, off).alias("sense"))


def tool_call_verdicts(spark, d):
    args = F.when(num() % 4 == 1, F.concat(F.lit("{"), txt())).otherwise(js(t=txt()))
    calls = F.when(num() % 4 != 2, F.array(obj(id=F.lit("x"), type=F.lit("function"), function=obj(name=F.col("source"), arguments=args))))
    return verdicts(spark, d, call=rs.tool_calls(js(choices=message(F.lit(""), of(num(), "tool_calls", "tool_calls", "tool_calls", "stop"), tool_calls=calls))))


def nonstream_codes(spark, d):
    call = obj(id=F.when(num() % 7 == 0, "").otherwise("x"), type=F.lit("function"), function=obj(name=F.lit("f"), arguments=js(t=txt())))
    body = js(choices=message(F.when(num() % 2 == 0, txt()).otherwise(""), tool_calls=F.when(num() % 3 > 0, F.array(call))))
    code = rs.tool_nonstream(F.when(num() % 5 == 0, 500).otherwise(200), body)
    return documents(spark, d).select("doc_id", code.alias("code")).withColumn("irregular", rs.is_irregular("code", F.lit("tools_only")))


def embedding_verdicts(spark, d):
    body = js(object=F.lit("list"), data=F.array(obj(embedding=F.when(F.col("vec_id") % 5 > 0, F.col("embedding")).otherwise(F.slice("embedding", 1, (F.col("vec_id") % 3).cast("int"))))))
    any_size, sized = rs.embeddings(body), rs.embeddings(body, 64)
    return table(spark, d, "embeddings").select("vec_id", any_size["ok"].alias("some"), sized["ok"].alias("whole"), sized["evidence"].alias("evidence"))


def media_verdicts(spark, d):
    raw = F.when(num() % 3 == 0, F.base64(F.encode(txt(), "UTF-8")))
    url = of(num(), F.lit(None).cast("string"), F.concat(F.lit("https://h/"), F.col("source")), F.concat(F.lit("ftp://h/"), F.col("source")))
    head = of(num(), "RIFF", "ID3", "OggS", "", "abcdftyp")
    return verdicts(spark, d, image=rs.image(js(data=F.array(obj(b64_json=raw, url=url)))), audio=rs.audio(F.encode(F.concat(head, txt()), "UTF-8")))


def content_verdicts(spark, d):
    strict = of(num(), js(t=txt()), "[1]", F.concat(F.lit("x"), txt()), '"x"')
    return verdicts(
        spark, d, said=rs.transcription(js(text=txt())), seen=rs.vision(js(choices=message(txt())), "an"), object=rs.json_strict(js(choices=message(strict))),
        task=rs.passthrough(js(id=F.when(num() % 3 == 0, ""), task_id=F.when(num() % 2 == 0, F.col("source")), status=F.col("lang"))),
    )


def first_token_verdicts(spark, d):
    e, k = table(spark, d, "events"), F.col("event_id")
    v = rs.first_token(F.when(k % 5 > 0, (k % 7 - 1) * 100), F.when(k % 3 > 0, k % 11 * 50))
    return e.select("event_id", v["ok"].alias("ok"), v["evidence"].alias("evidence"))


def error_verdicts(spark, d):
    """The contract of errors by status, and by shape."""
    body = F.when(num() % 2 == 0, js(error=obj(message=txt(), type=F.col("source")))).otherwise(js(detail=txt()))
    headers = F.create_map(F.when(num() % 3 == 0, "Retry-After").when(num() % 3 == 1, "retry-after").otherwise("x"), F.when(num() % 5 == 0, F.col("source")).otherwise("3"))
    v, shape = rs.error_contract(of(num(), 400, 404, 429, 500), headers, body), rs.contract_error(body, of(num(), "proxy", "gateway", "gateway", "proxy"))
    return documents(spark, d).select("doc_id", v["ok"].alias("ok"), v["evidence"].alias("evidence"), shape.alias("shape"))


def parameter_verdicts(spark, d):
    body = js(choices=message(txt()), usage=obj(completion_tokens=F.col("n_chars")))
    v = rs.parameters_forwarded(F.array(F.col("source"), F.lit("the "), F.lit("")), F.lit(500), body)
    return documents(spark, d).select("doc_id", v["ok"].alias("ok"), v["evidence"].alias("evidence"))


def video_tasks(spark, d):
    url = F.concat(F.lit("https://v/"), F.col("source"), F.lit(".mp4"))
    body = js(task_id=F.concat(F.lit("t"), num().cast("string")), status=of(num(), "completed", "FAILED", " succeeded ", "running"),
              output=F.when(num() % 3 == 0, obj(video_url=url)), url=F.when(num() % 3 == 1, url), prompt=txt())
    return documents(spark, d).select(
        "doc_id", rs.video_task(body)["ok"].alias("ok"), rs.task_status(body).alias("status"), rs.task_id(body).alias("task"), rs.artifact_url(body).alias("url")
    )


def needle_verdicts(spark, d):
    return verdicts(spark, d, whole=rs.needle("text", "THE "), near=rs.needle("text", "the ", 40))


def list_violations(spark, d):
    """Bodies whose second and third elements may be malformed."""
    row = lambda i, wrong: obj(id=F.when(~(wrong & F.lit(i == 1)), txt()), object=F.when(wrong & F.lit(i == 2), F.col("source")).otherwise("model"))
    body = js(object=F.when(num() % 5 > 0, "list"), data=F.array(*[row(i, num() % (i + 1) == 0) for i in range(3)]))
    part = F.when(num() % 4 == 0, js(t=txt())).otherwise("0.5")
    vectors = F.concat(F.lit('{"object": "list", "model": "m", "usage": {"prompt_tokens": 1, "total_tokens": 1}, "data": [{"index": 0, "object": "embedding", "embedding": [1, 2]}, '
                             '{"index": 1, "object": "embedding", "embedding": [1, 2.5, '), part, F.lit("]}]}"))  # fmt: skip
    listed = rs.violations(body, "models.list")
    return documents(spark, d).select("doc_id", F.array_join(listed, ";").alias("listed"), F.array_join(rs.violations(vectors, "embeddings"), ";").alias("vectors"), rs.contract(body, "models.list")["ok"].alias("ok"))


def tool_streams(spark, d):
    """A conversation as a stream: turns of the assistant are fragments of a call's arguments, others are said."""
    c = table(spark, d, "conversations")
    part = F.when(F.col("conv_id") % 4 == 0, F.lit("{")).otherwise(F.lit("1"))
    call = F.when(F.col("role") == "assistant", F.array(obj(index=F.lit(0), function=obj(name=F.col("role"), arguments=part))))
    chunk = js(choices=F.array(obj(delta=obj(content=F.when(F.col("role") != "assistant", F.col("text")), tool_calls=call))))
    return c.groupBy("conv_id").agg(
        F.concat(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", F.concat(F.lit("data: "), chunk).alias("c")))), lambda x: x["c"]), "\n\n"), F.lit("\n\ndata: [DONE]\n\n")).alias("stream")
    )


def tool_stream_codes(spark, d):
    calls = F.array_join(F.transform(rs.merged_calls("stream"), lambda c: F.concat_ws(":", c["index"].cast("string"), c["name"], c["arguments"])), ";")
    return tool_streams(spark, d).select("conv_id", rs.tool_stream("stream").alias("code"), rs.agent("stream")["ok"].alias("agent"), rs.stream("stream")["ok"].alias("whole"), calls.alias("calls"))


def text_files(spark, d):
    """Texts as files; one in five with a zero byte at its end."""
    data = F.concat(F.encode(txt(), "UTF-8"), F.when(num() % 5 == 0, F.to_binary(F.lit("00"), F.lit("hex"))).otherwise(F.to_binary(F.lit(""), F.lit("hex"))))
    kept = F.encode(txt(), "UTF-8")
    return documents(spark, d).select("doc_id", tx.git_blob_sha(kept).alias("blob"), tx.looks_binary(data).alias("zero"), F.md5(F.encode(tx.read_text(kept), "UTF-8")).alias("digest"))


def document_redaction(spark, d):
    """Whole texts, with a key put before every second one, as a value, in a map and in an array."""
    t = F.concat(F.when(num() % 2 == 0, F.lit("SK-abcd1234 bearer  x.y-z_1 ")).otherwise(""), txt())
    digest = lambda c: F.md5(F.encode(c, "UTF-8"))
    return documents(spark, d).select("doc_id", digest(tx.redact(t)).alias("plain"), digest(tx.redact_map(F.create_map(F.lit("h"), t))["h"]).alias("held"), digest(tx.redact_array(F.array(t))[0]).alias("listed"))


def report_cells(spark, d):
    return documents(spark, d).select("doc_id", tx.markdown_cell("text").alias("cell"))


def escaped(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def product_pages(spark, d):
    """Pages of a product around the documents' texts: overview, uses, specifications, prices, examples, structured data."""
    data = js(**{"@graph": F.array(obj(**{"@type": F.lit("Product"), "description": txt(), "brand": obj(name=F.col("source")), "offers": obj(price=F.col("n_chars").cast("string"), availability=F.lit("https://schema.org/InStock"))}))})
    page = F.concat(
        F.lit('<script type="application/ld+json">'), F.replace(data, F.lit("</"), F.lit("<\\/")), F.lit("</script><h2>Model overview</h2><p>"), escaped(txt()), F.lit("</p><h2>Best use cases</h2><ul><li>"), F.col("lang"),
        F.lit("</li><li> </li><li>"), F.col("source"), F.lit("</li></ul><h2>Technical specifications</h2><table><tr><td>Property</td><td>Value</td></tr><tr><td>Context</td><td>"), F.col("n_chars").cast("string"),
        F.lit('</td></tr><tr><td>Token Price</td><td>$$7</td></tr></table><div class="num">$$0.5</div><div class="label">Output / 1M</div><h3>'), of(num(), "cURL", "Python", "Other"), F.lit("</h3><pre><code>"),
        F.col("source"), F.lit(" &lt;x&gt;</code></pre>"),
    )
    return documents(spark, d).select("doc_id", page.alias("html"))


def product_fields(spark, d):
    product, price, code = web.json_ld_product("html"), web.prices("html"), web.code_blocks("html")[0]
    return product_pages(spark, d).select(
        "doc_id", F.md5(F.encode(web.overview("html"), "UTF-8")).alias("overview"), F.array_join(web.use_cases("html"), "|").alias("uses"), F.to_json(web.specs("html")).alias("specs"),
        price["input"].alias("input"), price["output"].alias("output"), F.concat_ws("|", code["lang"], code["code"], code["kind"]).alias("code"),
        F.concat_ws("|", product["brand"], product["price"], product["availability"]).alias("product"), F.md5(F.encode(F.coalesce(product["description"], F.lit("")), "UTF-8")).alias("description"),
    )


_NAMES = """thinking_senses tool_call_verdicts nonstream_codes embedding_verdicts media_verdicts content_verdicts first_token_verdicts error_verdicts parameter_verdicts video_tasks
needle_verdicts list_violations tool_stream_codes text_files document_redaction report_cells product_fields""".split()
QUERIES = {n: globals()[n] for n in _NAMES}

_D = "d AS (SELECT * REPLACE (coalesce(text, '') AS text), doc_id AS k FROM documents)"
_REDACTED = "md5(regexp_replace(regexp_replace(t, '\\b(sk_live_|sk_test_|sk-)[A-Za-z0-9_\\-]{4,}', '\\1***REDACTED***', 'gi'), '\\b(Bearer\\s+)[A-Za-z0-9_\\-.]{4,}', '\\1***REDACTED***', 'gi'))"

ORACLE_SQL = {
    "thinking_senses": f"""WITH {_D}, s AS (SELECT *, k % 2 = 0 AND trim(text) <> '' AS a, k % 3 = 0 AND trim(text) <> '' AS b FROM d)
        SELECT doc_id, CASE WHEN k % 7 = 0 THEN 'error' WHEN a AND NOT b THEN 'works' WHEN NOT a AND NOT b THEN 'unsupported' WHEN a THEN 'on_only' ELSE 'off_only' END AS sense FROM s""",
    "tool_call_verdicts": f"""WITH {_D} SELECT doc_id, k % 4 = 0 AS call_ok, CASE k % 4 WHEN 2 THEN 'finish=tool_calls n=0' WHEN 3 THEN 'finish=stop n=1' ELSE 'finish=tool_calls n=1' END AS call FROM d""",
    "nonstream_codes": f"""WITH {_D} SELECT doc_id, CASE WHEN k % 5 = 0 THEN 'error' WHEN k % 3 = 0 THEN 'no_call' WHEN k % 7 = 0 THEN 'error' WHEN k % 2 = 0 AND trim(text) <> '' THEN 'irregular' ELSE 'conform' END AS code,
        code <> 'conform' AS irregular FROM d""",
    "embedding_verdicts": """WITH s AS (SELECT vec_id, CASE WHEN vec_id % 5 > 0 THEN len(embedding) ELSE vec_id % 3 END AS n FROM embeddings) SELECT vec_id, n > 0 AS some, n = 64 AS whole, 'dim=' || n AS evidence FROM s""",
    "media_verdicts": f"""WITH {_D}, s AS (SELECT *, strlen(text) AS b, strlen(['RIFF', 'ID3', 'OggS', '', 'abcdftyp'][k % 5 + 1] || text) AS n FROM d)
        SELECT doc_id, CASE WHEN k % 3 = 0 THEN b > 0 ELSE k % 3 = 1 END AS image_ok, CASE WHEN k % 3 = 0 AND b > 0 THEN 'bytes=' || b ELSE 'url=' || left(['', 'https://h/' || source, 'ftp://h/' || source][k % 3 + 1], 80) END AS image,
        n > 0 AND (k % 5 <> 3 OR n > 1000) AS audio_ok, ['wav', 'mp3', 'ogg', 'unknown', 'mp4'][k % 5 + 1] || ' bytes=' || n AS audio FROM s""",
    "content_verdicts": f"""WITH {_D} SELECT doc_id, trim(text) <> '' AS said_ok, 'text_len=' || length(trim(text)) AS said, contains(lower(text), 'an') AS seen_ok, 'colour=an match=' || CASE WHEN contains(lower(text), 'an') THEN 'an' ELSE 'null' END AS seen,
        k % 4 = 0 AS object_ok, 'kind=' || ['object', 'array', 'null', 'string'][k % 4 + 1] AS object, k % 2 = 0 AND source <> '' AS task_ok, 'id=' || CASE WHEN k % 2 = 0 THEN source ELSE 'null' END || ' status=' || lang AS task FROM d""",
    "first_token_verdicts": """WITH s AS (SELECT event_id, CASE WHEN event_id % 5 > 0 THEN (event_id % 7 - 1) * 100 END AS a, CASE WHEN event_id % 3 > 0 THEN event_id % 11 * 50 END AS b FROM events)
        SELECT event_id, coalesce(a >= 0 AND (b IS NULL OR a <= b), false) AS ok, 'ttft_ms=' || coalesce(a::VARCHAR, 'null') || ' total_ms=' || coalesce(b::VARCHAR, 'null') AS evidence FROM s""",
    "error_verdicts": f"""WITH {_D}, s AS (SELECT *, [400, 404, 429, 500][k % 4 + 1] AS status, trim(text) <> '' AS readable FROM d)
        SELECT doc_id, readable AND (status IN (400, 404) OR status = 429 AND k % 3 < 2 AND k % 5 > 0) AS ok, 'status=' || status || ' message=' || left(text, 60) AS evidence,
        CASE WHEN k % 2 = 0 THEN 'pass' WHEN k % 4 IN (1, 2) THEN 'diverged' ELSE 'fail' END AS shape FROM s""",
    "parameter_verdicts": f"""WITH {_D}, s AS (SELECT *, contains(text, source)::INT + contains(text, 'the ')::INT AS hit FROM d)
        SELECT doc_id, trim(text) <> '' AND hit = 0 AND NOT n_chars > 500 AS ok, 'stops=' || hit || ' tokens=' || n_chars AS evidence FROM s""",
    "video_tasks": f"""WITH {_D}, s AS (SELECT *, ['COMPLETED', 'FAILED', 'SUCCEEDED', 'RUNNING'][k % 4 + 1] AS status, CASE WHEN k % 3 < 2 THEN 'https://v/' || source || '.mp4' END AS url FROM d)
        SELECT doc_id, k % 2 = 0 AND url IS NOT NULL AS ok, status, 't' || k AS task, url FROM s""",
    "needle_verdicts": f"""WITH {_D}, s AS (SELECT doc_id, instr(lower(text), 'the ') - 1 AS a, instr(lower(left(text, 40)), 'the ') - 1 AS b FROM d)
        SELECT doc_id, a >= 0 AS whole_ok, 'pos=' || a AS whole, b >= 0 AS near_ok, 'pos=' || b AS near FROM s""",
    "list_violations": f"""WITH {_D}, s AS (SELECT *, concat_ws(';', CASE WHEN k % 2 = 0 THEN '$.data[1].id' END, CASE WHEN k % 3 = 0 THEN '$.data[2].object' END, CASE WHEN k % 5 = 0 THEN '$.object' END) AS listed FROM d)
        SELECT doc_id, listed, CASE WHEN k % 4 = 0 THEN '$.data[1].embedding[2]' ELSE '' END AS vectors, listed = '' AS ok FROM s""",
    "tool_stream_codes": """WITH s AS (SELECT conv_id, min(turn) FILTER (role <> 'assistant' AND text <> '') AS first_said, max(turn) FILTER (role <> 'assistant' AND text <> '') AS last_said,
        min(turn) FILTER (role = 'assistant') AS called, count_if(role = 'assistant') AS n, coalesce(string_agg(text, '' ORDER BY turn) FILTER (role <> 'assistant'), '') AS said FROM conversations GROUP BY conv_id)
        SELECT conv_id, CASE WHEN n = 0 THEN 'no_call' WHEN conv_id % 4 = 0 THEN 'error' WHEN first_said IS NULL THEN 'tools_only' WHEN first_said >= called THEN 'speech_after' WHEN last_said > called THEN 'both' ELSE 'speech_before' END AS code,
        n > 0 AND (trim(said) = '' OR regexp_matches(said, '[\\p{L}\\p{N}]')) AS agent, true AS whole, CASE WHEN n = 0 THEN '' ELSE '0:assistant:' || repeat(CASE WHEN conv_id % 4 = 0 THEN '{' ELSE '1' END, n::INT) END AS calls FROM s""",
    "text_files": f"""WITH {_D} SELECT doc_id, sha1(encode('blob ' || strlen(text)) || '\\x00'::BLOB || encode(text)) AS blob, k % 5 = 0 AND strlen(text) < 8192 AS zero, md5(text) AS digest FROM d""",
    "document_redaction": f"""WITH {_D}, s AS (SELECT doc_id, CASE WHEN k % 2 = 0 THEN 'SK-abcd1234 bearer  x.y-z_1 ' ELSE '' END || text AS t FROM d) SELECT doc_id, {_REDACTED} AS plain, plain AS held, plain AS listed FROM s""",
    "report_cells": f"""WITH {_D}, s AS (SELECT doc_id, replace(regexp_replace(text, '\\s*\\n\\s*', ' ', 'g'), '|', '\\|') AS c FROM d) SELECT doc_id, CASE WHEN length(c) > 120 THEN left(c, 119) || '…' ELSE c END AS cell FROM s""",
    "product_fields": f"""WITH {_D} SELECT doc_id, md5(nullif(left(trim(regexp_replace(text, '\\s+', ' ', 'g')), 1200), '')) AS overview, lang || '|' || source AS uses, '{{"Context":"' || n_chars || '","Token Price":"$$7"}}' AS specs,
        '$$7' AS input, '$0.5' AS output, ['cURL', 'Python', 'Other'][k % 3 + 1] || '|' || source || ' <x>|' || ['curl', 'python', 'other'][k % 3 + 1] AS code, source || '|' || n_chars || '|InStock' AS product, md5(text) AS description FROM d""",
}
