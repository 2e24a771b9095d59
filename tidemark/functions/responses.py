"""Verdicts over recorded model responses: JSON bodies, event streams, audio bytes. Each is a struct<ok, evidence>.

Bodies are JSON strings; what is missing or has another type counts as missing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

CHUNK_SCHEMA = (
    "choices array<struct<finish_reason:string, delta:struct<content:string, tool_calls:array<struct<index:int, id:string, type:string, "
    "function:struct<name:string, arguments:string>>>>, message:struct<content:string>>>"
)


def verdict(ok: Column, *evidence: Column | str) -> Column:
    parts = [F.coalesce(e.cast("string"), F.lit("null")) if isinstance(e, Column) else F.lit(e) for e in evidence]
    return F.struct(F.coalesce(ok, F.lit(False)).alias("ok"), F.concat(*parts).alias("evidence"))


def get(body: Column | str, path: str) -> Column:
    return F.get_json_object(col(body), path)


def text_at(body: Column | str, path: str) -> Column:
    return F.trim(F.coalesce(get(body, path), F.lit("")))


def int_at(body: Column | str, path: str) -> Column:
    return F.coalesce(get(body, path).try_cast("double").try_cast("long"), F.lit(0).cast("long"))


CONTENT, REASONING = "$.choices[0].message.content", "$.choices[0].message.reasoning_content"


def is_json(text: Column) -> Column:
    return F.try_parse_json(text).isNotNull()


def json_kind(text: Column) -> Column:
    """OBJECT, ARRAY, STRING, BIGINT, BOOLEAN, .. of a JSON text; null where it isn't one."""
    return F.regexp_extract(F.schema_of_variant(F.try_parse_json(text)), "^([A-Z]+)", 1)


def chat(body) -> Column:
    content = text_at(body, CONTENT)
    return verdict(F.length(content) > 0, "finish=", get(body, "$.choices[0].finish_reason"), " len=", F.length(content))


def reasoning(body) -> tuple[Column, Column]:
    """(characters of reasoning, reasoning tokens of both places that report them)"""
    tokens = int_at(body, "$.usage.completion_tokens_details.reasoning_tokens") + int_at(body, "$.usage.output_tokens_details.reasoning_tokens")
    return F.length(text_at(body, REASONING)), tokens


def thinking_on(body) -> Column:
    chars, tokens = F.length(text_at(body, REASONING)), int_at(body, "$.usage.completion_tokens_details.reasoning_tokens")
    return verdict((chars > 0) | (tokens > 0), "reasoning_chars=", chars, " reasoning_tokens=", tokens)


def thinking_off(body) -> Column:
    chars, tokens = F.length(text_at(body, REASONING)), int_at(body, "$.usage.completion_tokens_details.reasoning_tokens")
    return verdict((F.length(text_at(body, CONTENT)) > 0) & (chars == 0) & (tokens == 0), "reasoning_chars=", chars, " reasoning_tokens=", tokens)


def thinking_sense(on, off) -> Column:
    """works, unsupported, on_only, off_only or error: whether switching reasoning on and off makes a difference."""
    (on_chars, on_tokens), (off_chars, off_tokens) = reasoning(on), reasoning(off)
    valid = get(on, "$.choices[0].message").isNotNull() & get(off, "$.choices[0].message").isNotNull()
    has_on, has_off = (on_chars > 0) | (on_tokens > 0), (off_chars > 0) | (off_tokens > 0)
    return (
        F.when(~valid, "error").when(has_on & ~has_off, "works").when(~has_on & ~has_off, "unsupported").when(has_on & has_off, "on_only").otherwise("off_only")
    )


def tool_calls(body) -> Column:
    n = F.coalesce(F.json_array_length(get(body, "$.choices[0].message.tool_calls")), F.lit(0))
    finish, args = get(body, "$.choices[0].finish_reason"), get(body, "$.choices[0].message.tool_calls[0].function.arguments")
    return verdict((finish == "tool_calls") & (n > 0) & is_json(args), "finish=", finish, " n=", n)


def payloads(stream: Column | str) -> Column:
    """What stands behind ``data:`` in each line of an event stream, whether blank lines part the events or not."""
    lines = F.transform(F.split(col(stream), "\r?\n"), lambda x: F.trim(x))
    return F.transform(F.filter(lines, lambda x: x.startswith("data:")), lambda x: F.trim(F.substring(x, F.lit(6), F.length(x))))


def events(stream: Column | str) -> Column:
    """The parts of a stream between blank lines that aren't blank."""
    return F.filter(F.split(col(stream), "\n\n"), lambda e: F.trim(F.regexp_replace(e, "\\s+", " ")) != "")


def stream_info(stream: Column | str) -> Column:
    """struct<n, json_ok, json_bad, done, sep_blank, sep_single, text>"""
    p = payloads(stream)
    data = F.filter(p, lambda x: x != "[DONE]")
    ok = F.size(F.filter(data, is_json))
    blank = F.size(F.split(col(stream), "\n\n")) - 1
    chunks = F.transform(data, lambda x: F.from_json(x, CHUNK_SCHEMA))
    texts = F.transform(chunks, lambda c: F.coalesce(F.array_join(F.transform(c["choices"], lambda h: h["delta"]["content"]), ""), F.lit("")))
    return F.struct(
        F.size(p).alias("n"), ok.alias("json_ok"), (F.size(data) - ok).alias("json_bad"), F.array_contains(p, "[DONE]").alias("done"), blank.alias("sep_blank"),
        F.when(F.size(p) > 1, F.greatest(F.lit(0), F.size(p) - 1 - blank)).otherwise(0).alias("sep_single"), F.array_join(texts, "").alias("text"),
    )


def stream(stream_text) -> Column:
    i = stream_info(stream_text)
    return verdict((i["json_ok"] >= 1) & i["done"] & (i["json_bad"] == 0), "parsed=", i["json_ok"], " bad=", i["json_bad"], " done=", i["done"])


def stream_strong(stream_text, expect: str | None = None) -> Column:
    """The first reason that fails: bad_json, no_json, no_done, no_text, not_expected, single_breaks, no_breaks; else ok."""
    i = stream_info(stream_text)
    missing = F.lit(False) if expect is None else ~F.contains(F.lower(i["text"]), F.lit(expect.lower()))
    reason = (
        F.when(i["json_bad"] > 0, "bad_json").when(i["json_ok"] < 1, "no_json").when(~i["done"], "no_done").when(F.trim(i["text"]) == "", "no_text")
        .when(missing, "not_expected").when((i["sep_single"] > 0) & (i["sep_blank"] == 0), "single_breaks").when((i["sep_blank"] == 0) & (i["n"] > 1), "no_breaks").otherwise("ok")
    )
    return verdict(reason == "ok", reason)


def embeddings(body, dim: int | None = None) -> Column:
    n = F.json_array_length(get(body, "$.data[0].embedding"))
    return verdict((n > 0) if dim is None else (n == dim), "dim=", n)


def image(body) -> Column:
    raw, url = F.nullif(get(body, "$.data[0].b64_json"), F.lit("")), F.coalesce(get(body, "$.data[0].url"), F.lit(""))
    size = F.octet_length(F.try_to_binary(raw, F.lit("base64")))
    return F.when(raw.isNotNull(), verdict(size > 0, "bytes=", size)).otherwise(verdict(url.rlike("^https?://"), "url=", F.substring(url, 1, 80)))


def audio(data) -> Column:
    """Known by its first bytes, else plausible from 1,001 bytes."""
    head = F.hex(F.substring(col(data), 1, 12))
    magic = (
        F.when(head.startswith("52494646"), "wav").when(head.startswith("494433"), "mp3").when(head.startswith("FFFB"), "mp3")
        .when(head.startswith("4F676753"), "ogg").when(F.substring(head, 9, 8) == "66747970", "mp4")
    )
    size = F.coalesce(F.octet_length(col(data)), F.lit(0))
    return verdict((size > 0) & (magic.isNotNull() | (size > 1000)), F.coalesce(magic, F.lit("unknown")), " bytes=", size)


def transcription(body) -> Column:
    return verdict(F.length(text_at(body, "$.text")) > 0, "text_len=", F.length(text_at(body, "$.text")))


#: Words for the colours that vision tests show (fixed values).
VISION_COLOURS = {"red": ("vermelh", "red", "红"), "blue": ("azul", "blue", "蓝")}


def vision(body, colour: str) -> Column:
    text = F.lower(text_at(body, CONTENT))
    hit = F.coalesce(*[F.when(F.contains(text, F.lit(w)), F.lit(w)) for w in VISION_COLOURS.get(colour, (colour,))])
    return verdict(hit.isNotNull(), f"colour={colour} match=", hit)


def passthrough(body) -> Column:
    task = F.coalesce(*[F.nullif(get(body, f"$.{k}"), F.lit("")) for k in ("id", "task_id", "request_id")])
    return verdict(task.isNotNull(), "id=", task, " status=", get(body, "$.status"))


def first_token(ttft_ms, total_ms) -> Column:
    first, total = col(ttft_ms), col(total_ms)
    return verdict(first.isNotNull() & (first >= 0) & (total.isNull() | (first <= total)), "ttft_ms=", first, " total_ms=", total)


def json_strict(body) -> Column:
    kind = json_kind(F.nullif(text_at(body, CONTENT), F.lit("")))
    return verdict(kind == "OBJECT", "kind=", F.lower(kind))


def error_contract(status, headers, body) -> Column:
    """A status of 400, 404 or 429 with a readable message; 429 also says when to come back."""
    code, error = col(status), get(body, "$.error")
    message = F.coalesce(get(body, "$.error.message"), F.when(~F.ltrim(error).startswith("{"), error), F.get_json_object(get(body, "$.detail"), "$.message"), get(body, "$.detail"))
    again = F.coalesce(F.try_element_at(col(headers), F.lit("Retry-After")), F.try_element_at(col(headers), F.lit("retry-after")), get(body, "$.error.retry_after")).try_cast("double")
    readable = F.length(F.trim(F.coalesce(message, F.lit("")))) > 0
    ok = code.isin(400, 404) & readable | ((code == 429) & readable & (again >= 0))
    return verdict(ok, "status=", code, " message=", F.substring(message, 1, 60))


def parameters_forwarded(stops, max_tokens, body) -> Column:
    """The text isn't empty, holds no stop string, and is no longer than asked for."""
    content = F.coalesce(get(body, CONTENT), F.lit(""))
    hit = F.filter(F.coalesce(col(stops), F.array().cast("array<string>")), lambda s: (s != "") & F.contains(content, s))
    used = get(body, "$.usage.completion_tokens").try_cast("long")
    long = F.coalesce(used > col(max_tokens), F.lit(False))
    return verdict((F.trim(content) != "") & (F.size(hit) == 0) & ~long, "stops=", F.size(hit), " tokens=", used)


def needle(text, needle_text: str, window: int | None = None) -> Column:
    """Whether a needle stands in a text, or within its first ``window`` characters; case doesn't count."""
    hay = col(text) if window is None else F.substring(col(text), 1, window)
    at = F.locate(needle_text.lower(), F.lower(hay)) - 1
    return verdict((at >= 0) & F.lit(needle_text != ""), "pos=", at)


# Fixed values of the video tasks' format: final states, address keys, and the containers that a result may lie in.
TASK_DONE = ("SUCCESS", "SUCCEEDED", "COMPLETED", "DONE")
TASK_FAILED = ("FAILED", "FAILURE", "ERROR", "CANCELLED", "CANCELED", "TIMEOUT")
ADDRESS_KEYS = ("url", "video_url", "file_url", "output_url", "download_url")
CONTAINERS = ("output", "result", "data", "results", "videos", "artifacts")
#: How deep containers and lists may be nested.
NESTING = 8


def _first_text(body, keys: tuple[str, ...]) -> Column:
    return F.coalesce(*[F.nullif(F.trim(text_at(body, f"$.{k}")), F.lit("")) for k in keys])


def task_status(body) -> Column:
    return F.upper(F.coalesce(_first_text(body, ("task_status", "status", "state")), F.lit("")))


def task_state(body) -> Column:
    """``done``, ``failed``, or ``running`` for any other state."""
    status = task_status(body)
    return F.when(status.isin(*TASK_DONE), "done").when(status.isin(*TASK_FAILED), "failed").otherwise("running")


def task_id(body) -> Column:
    return _first_text(body, ("id", "task_id", "taskId"))


def artifact_url(body) -> Column:
    """The http(s) address of a result: under an address key of the body or of what its containers lead to, or a bare string there.

    Only containers and lists are entered. A node's own address comes before its containers', later containers before
    earlier ones, and later elements of a list before earlier ones.
    """
    kind = F.schema_of_variant
    http = lambda text: F.when(text.rlike("^https?://"), text)

    def text_under(v: Column, key: str) -> Column:
        under = F.try_variant_get(v, f"$.{key}", "variant")
        return F.when(kind(under) == "STRING", http(F.try_variant_get(v, f"$.{key}", "string")))

    def own(v: Column) -> Column:
        named = F.coalesce(*[text_under(v, k) for k in ADDRESS_KEYS])
        return F.when(kind(v) == "STRING", http(v.cast("string"))).when(kind(v).startswith("OBJECT"), named)

    def below(node: Column) -> Column:
        v, at = node["v"], node["at"]
        inner = [F.struct(F.concat(at, F.lit(str(i))).alias("at"), F.try_variant_get(v, f"$.{k}", "variant").alias("v")) for i, k in enumerate(reversed(CONTAINERS))]
        items = F.try_variant_get(v, "$", "array<variant>")
        last_first = F.transform(items, lambda x, i: F.struct(F.concat(at, F.lpad((F.size(items) - i).cast("string"), 9, "0")).alias("at"), x.alias("v")))
        found = F.when(kind(v).startswith("OBJECT"), F.array(*inner)).when(kind(v).startswith("ARRAY"), last_first)
        return F.filter(F.coalesce(found, F.array().cast(NODES)), lambda n: n["v"].isNotNull())

    NODES = "array<struct<at:string,v:variant>>"
    whole = F.try_parse_json(col(body))
    level = F.when(kind(whole).startswith("OBJECT"), F.array(F.struct(F.lit("").alias("at"), whole.alias("v"))))

    def search(nodes: Column, depth: int) -> Column:
        here = F.filter(F.transform(nodes, lambda n: F.struct(n["at"].alias("at"), own(n["v"]).alias("url"))), lambda n: n["url"].isNotNull())
        if not depth:
            return here
        deeper = F.transform(F.array(F.flatten(F.transform(nodes, below))), lambda next_level: search(next_level, depth - 1))
        return F.concat(here, F.flatten(deeper))

    # Places are numbered so that their order as text is the order of the visit.
    return F.array_min(search(level, NESTING))["url"]


def video_task(body) -> Column:
    status, url = task_status(body), artifact_url(body)
    return verdict(status.isin(*TASK_DONE) & url.isNotNull(), "status=", status, " url=", F.substring(url, 1, 80))


def merged_calls(stream_text) -> Column:
    """array<struct<index, name, arguments>> of a stream: fragments joined by index, the last name that isn't empty."""
    chunks = F.transform(F.filter(payloads(stream_text), lambda p: p != "[DONE]"), lambda p: F.from_json(p, CHUNK_SCHEMA))
    firsts = F.transform(chunks, lambda c: F.try_element_at(c["choices"], F.lit(1))["delta"]["tool_calls"])
    calls = F.flatten(F.filter(firsts, lambda x: x.isNotNull()))
    numbers = F.array_sort(F.array_distinct(F.transform(calls, lambda c: c["index"])))

    def one(i: Column) -> Column:
        mine = F.filter(calls, lambda c: c["index"] == i)
        names = F.filter(F.transform(mine, lambda c: c["function"]["name"]), lambda n: n != "")
        return F.struct(i.alias("index"), F.coalesce(F.try_element_at(names, F.lit(-1)), F.lit("")).alias("name"),
                        F.array_join(F.transform(mine, lambda c: c["function"]["arguments"]), "").alias("arguments"))

    return F.transform(numbers, one)


def agent(stream_text, expect_tools: bool = True) -> Column:
    i, calls = stream_info(stream_text), merged_calls(stream_text)
    spoken, called = F.trim(i["text"]) != "", F.size(calls) > 0
    ok = (i["json_ok"] > 0) & (spoken | called) & (called | F.lit(not expect_tools)) & (~spoken | i["text"].rlike("[\\p{L}\\p{N}]"))
    return verdict(ok, "chunks=", i["json_ok"], " chars=", F.length(i["text"]), " tools=", F.size(calls))


CALLS_SCHEMA = "array<struct<id:string, type:string, function:struct<name:string, arguments:string>>>"


def tool_nonstream(status, body) -> Column:
    """conform, irregular (text beside the calls), no_call or error."""
    calls = F.from_json(get(body, "$.choices[0].message.tool_calls"), CALLS_SCHEMA)
    shaped = F.forall(calls, lambda c: (F.coalesce(c["id"], F.lit("")) != "") & (F.coalesce(c["type"], F.lit("")) == "function")
                      & (F.trim(F.coalesce(c["function"]["arguments"], F.lit(""))) != "") & is_json(c["function"]["arguments"]))
    return (
        F.when((col(status) != 200) | get(body, "$.choices").isNull(), "error").when(F.coalesce(F.size(calls), F.lit(0)) < 1, "no_call")
        .when(~shaped, "error").when(text_at(body, CONTENT) != "", "irregular").otherwise("conform")
    )


def tool_stream(stream_text) -> Column:
    """tools_only, speech_before, speech_after, both, no_call or error: how text and tool calls follow each other."""
    data = F.filter(payloads(stream_text), lambda p: p != "[DONE]")
    chunks = F.transform(data, lambda p: F.try_element_at(F.from_json(p, CHUNK_SCHEMA)["choices"], F.lit(1)))
    places = F.sequence(F.lit(1), F.size(chunks))
    said = F.filter(places, lambda i: F.coalesce(F.try_element_at(chunks, i)["delta"]["content"], F.lit("")) != "")
    called = F.filter(places, lambda i: F.coalesce(F.size(F.try_element_at(chunks, i)["delta"]["tool_calls"]), F.lit(0)) > 0)
    info = stream_info(stream_text)
    arguments = F.try_element_at(F.filter(merged_calls(stream_text), lambda c: c["index"] == 0), F.lit(1))["arguments"]
    order = (
        F.when(F.array_min(said) >= F.array_min(called), "speech_after")
        .when(F.array_max(said) > F.array_min(called), "both")
        .otherwise("speech_before")
    )
    return (
        F.when((info["json_bad"] > 0) | (info["json_ok"] == 0) | ~info["done"], "error").when(F.size(called) == 0, "no_call")
        .when(~F.coalesce(is_json(F.nullif(F.trim(arguments), F.lit(""))), F.lit(False)), "error").when(F.size(said) == 0, "tools_only").otherwise(order)
    )


def is_irregular(nonstream, streamed) -> Column:
    return col(nonstream).isin("irregular", "no_call", "error") | col(streamed).isin("speech_before", "speech_after", "both", "no_call", "error")


def envelope(body) -> Column:
    """openai, fastapi, both, other or empty: the shape of an error body."""
    raw = F.coalesce(col(body), F.lit(""))
    error = F.coalesce(F.try_variant_get(F.try_parse_json(raw), "$.error", "string"), get(raw, "$.error"))
    has_error = error.isNotNull() & (F.ltrim(error).startswith("{") | ~error.rlike("^(-?[0-9.]+|true|false|\\[.*)$"))
    has_detail = F.array_contains(F.coalesce(F.json_object_keys(F.when(is_json(raw), raw)), F.array().cast("array<string>")), "detail")
    return (
        F.when(F.trim(raw) == "", "empty").when(json_kind(raw) != "OBJECT", "other").when(~is_json(raw), "other")
        .when(has_error & has_detail, "both").when(has_error, "openai").when(has_detail, "fastapi").otherwise("other")
    )


#: What a conforming body has: path -> kind, [*] for each element; a kind may be a constant in quotes, MANY is an array that
#: isn't empty, and | parts paths of which one is enough (fixed values).
CONTRACTS = {
    "chat.completion": {
        "$.id": "STRING", "$.object": "'chat.completion'", "$.created": "BIGINT", "$.model": "STRING", "$.choices": "MANY", "$.choices[*].index": "BIGINT",
        "$.choices[*].finish_reason": "STRING", "$.choices[*].message.role": "'assistant'", "$.choices[*].message.content": "STRING",
        "$.usage.prompt_tokens": "BIGINT", "$.usage.completion_tokens": "BIGINT", "$.usage.total_tokens": "BIGINT",
    },
    "chunk": {"$.id": "STRING", "$.object": "'chat.completion.chunk'", "$.created": "BIGINT", "$.model": "STRING", "$.choices": "MANY", "$.choices[*].index": "BIGINT", "$.choices[*].delta": "OBJECT"},
    "embeddings": {
        "$.object": "'list'", "$.model": "STRING", "$.data": "MANY", "$.data[*].index": "BIGINT", "$.data[*].object": "'embedding'", "$.data[*].embedding": "MANY",
        "$.data[*].embedding[*]": "NUMBER", "$.usage.prompt_tokens": "BIGINT", "$.usage.total_tokens": "BIGINT",
    },
    "images.generation": {"$.created": "BIGINT", "$.data": "MANY", "$.data[*].url|$.data[*].b64_json": "STRING"},
    "models.list": {"$.object": "'list'", "$.data": "MANY", "$.data[*].id": "STRING", "$.data[*].object": "'model'"},
    "error.openai": {"$.error": "OBJECT", "$.error.message": "STRING", "$.error.type": "STRING"},
    "error.fastapi": {"$.detail": "ANY"},
}
KINDS = {"NUMBER": ("BIGINT", "DOUBLE", "DECIMAL"), "ANY": ("STRING", "OBJECT", "ARRAY")}


def meets(value: Column, path: str, wanted: str) -> Column:
    """Whether a variant has what is wanted at a path; false where it has nothing there."""
    if wanted.startswith("'"):
        return F.coalesce(F.try_variant_get(value, path, "string") == wanted.strip("'"), F.lit(False))
    at = F.try_variant_get(value, path, "variant")
    if wanted == "MANY":
        return F.coalesce(F.size(F.try_variant_get(at, "$", "array<variant>")) > 0, F.lit(False))
    kind = F.regexp_extract(F.schema_of_variant(at), "^([A-Z]+)", 1)
    return F.coalesce(kind.isin(*KINDS.get(wanted, (wanted,))), F.lit(False))


def misses(value: Column, paths: list[str], wanted: str, at: Column) -> Column:
    """The places below ``at`` where none of the paths is met, each as it is written for the element that it's in."""
    if "[*]" not in paths[0]:
        said = F.concat_ws("|", *[F.concat(at, F.lit(p[1:])) for p in paths])
        good = meets(value, paths[0], wanted)
        for p in paths[1:]:
            good = good | meets(value, p, wanted)
        return F.when(good, F.array().cast("array<string>")).otherwise(F.array(said))
    stem, rest = paths[0].partition("[*]")[0], ["$" + p.partition("[*]")[2] for p in paths]
    elements = F.coalesce(F.try_variant_get(value, stem, "array<variant>"), F.array().cast("array<variant>"))
    here = lambda i: F.concat(at, F.lit(stem[1:] + "["), i.cast("string"), F.lit("]"))
    return F.flatten(F.transform(elements, lambda x, i: misses(x, rest, wanted, here(i))))


def violations(body, contract: str) -> Column:
    """The places at which a body lacks what its contract asks for, sorted by the contract's paths; every element of an array is
    looked at. An array that must have elements and has none is one place."""
    variant = F.try_parse_json(col(body))
    return F.flatten(F.array(*[misses(variant, paths.split("|"), wanted, F.lit("$")) for paths, wanted in sorted(CONTRACTS[contract].items())]))


def contract(body, name: str) -> Column:
    """No violations; else the first three."""
    v = violations(body, name)
    return verdict(F.size(v) == 0, F.array_join(F.slice(v, 1, 3), "; "))


def contract_error(body, target) -> Column:
    """pass, diverged or fail: the one error shape passes, the other is a known divergence of the gateway."""
    return (
        F.when(F.size(violations(body, "error.openai")) == 0, "pass")
        .when((F.size(violations(body, "error.fastapi")) == 0) & (col(target) == "gateway"), "diverged")
        .otherwise("fail")
    )
