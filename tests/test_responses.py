import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions import responses as rs


def ev(spark, *values):
    """Evaluate functions of columns over one row of literals."""

    def run(make):
        df = spark.createDataFrame([tuple(values)], ", ".join(f"c{i} {'int' if isinstance(v, int) else 'binary' if isinstance(v, bytes) else 'string'}" for i, v in enumerate(values)))
        return df.select(make(*[F.col(f"c{i}") for i in range(len(values))]).alias("x")).first()[0]

    return run


def chat(content="hi", finish="stop", **message):
    return json.dumps({"choices": [{"finish_reason": finish, "message": {"content": content, **message}}], "usage": {"completion_tokens": 3}})


def sse(*chunks, sep="\n\n", done=True):
    return sep.join([*(f"data: {c if isinstance(c, str) else json.dumps(c)}" for c in chunks), *(["data: [DONE]"] if done else [])]) + sep


def delta(content=None, calls=None, finish=None):
    d = {k: v for k, v in (("content", content), ("tool_calls", calls)) if v is not None}
    return {"choices": [{"delta": d, "finish_reason": finish}]}


def call(index=0, name="f", args="{}"):
    return {"index": index, "id": "x", "type": "function", "function": {"name": name, "arguments": args}}


@pytest.mark.parametrize(("body", "ok"), [(chat(), True), (chat("  "), False), ("{}", False), ("no json", False), (None, False)])
def test_chat(spark, body, ok):
    assert ev(spark, body)(rs.chat).ok is ok


def test_thinking(spark):
    on = json.dumps({"choices": [{"message": {"content": "a", "reasoning_content": "hm"}}]})
    tokens = json.dumps({"choices": [{"message": {"content": "a"}}], "usage": {"output_tokens_details": {"reasoning_tokens": 4}}})
    off = chat("a")
    assert ev(spark, on)(rs.thinking_on).ok and not ev(spark, off)(rs.thinking_on).ok
    assert ev(spark, off)(rs.thinking_off).ok and not ev(spark, on)(rs.thinking_off).ok
    sense = {(a, b): ev(spark, x, y)(rs.thinking_sense) for a, x in (("on", on), ("off", off), ("tok", tokens), ("bad", "{}")) for b, y in (("on", on), ("off", off))}
    assert [sense[k] for k in (("on", "off"), ("off", "off"), ("on", "on"), ("off", "on"), ("tok", "off"), ("bad", "off"))] == [
        "works", "unsupported", "on_only", "off_only", "works", "error"]


def test_tool_calls(spark):
    good = chat("", "tool_calls", tool_calls=[call(args='{"a": 1}')])
    assert ev(spark, good)(rs.tool_calls).ok
    assert not ev(spark, chat("", "tool_calls", tool_calls=[call(args="{a")]))(rs.tool_calls).ok
    assert not ev(spark, chat("", "stop", tool_calls=[call()]))(rs.tool_calls).ok
    assert ev(spark, 200, good)(rs.tool_nonstream) == "conform"
    assert ev(spark, 200, chat("text", "tool_calls", tool_calls=[call()]))(rs.tool_nonstream) == "irregular"
    assert ev(spark, 200, chat("text"))(rs.tool_nonstream) == "no_call"
    assert ev(spark, 500, good)(rs.tool_nonstream) == "error"
    assert ev(spark, 200, chat("", "tool_calls", tool_calls=[{"id": "", "type": "function", "function": {"arguments": "{}"}}]))(rs.tool_nonstream) == "error"


def test_streams(spark):
    good = sse(delta("he"), delta("llo"))
    info = ev(spark, good)(rs.stream_info)
    assert (info.n, info.json_ok, info.json_bad, info.done, info.sep_blank, info.sep_single, info.text) == (3, 2, 0, True, 3, 0, "hello")
    assert ev(spark, good)(rs.stream).ok and not ev(spark, sse(delta("a"), done=False))(rs.stream).ok
    reasons = {
        "ok": good, "bad_json": sse("{x"), "no_json": sse(), "no_done": sse(delta("a"), done=False), "no_text": sse(delta(" ")), "single_breaks": sse(delta("a"), delta("b"), sep="\n"),
    }
    assert {k: ev(spark, v)(rs.stream_strong).evidence for k, v in reasons.items()} == {k: k for k in reasons}
    assert ev(spark, good)(lambda c: rs.stream_strong(c, "HELL")).ok and not ev(spark, good)(lambda c: rs.stream_strong(c, "bye")).ok
    assert len(ev(spark, "a\n\n \n\nb")(rs.events)) == 2


def test_tool_streams(spark):
    parts = [call(args='{"a"'), {"index": 0, "function": {"arguments": ": 1}"}}]
    calls = [delta(calls=[parts[0]]), delta(calls=[parts[1]], finish="tool_calls")]
    assert [tuple(c) for c in ev(spark, sse(*calls))(rs.merged_calls)] == [(0, "f", '{"a": 1}')]
    code = lambda *c, **k: ev(spark, sse(*c, **k))(rs.tool_stream)
    assert code(*calls) == "tools_only" and code(delta("x"), *calls) == "speech_before" and code(*calls, delta("x")) == "speech_after"
    assert code(delta("x"), calls[0], delta("y"), calls[1]) == "both" and code(delta("x")) == "no_call"
    assert code(calls[0]) == "error" and code(*calls, done=False) == "error"
    assert ev(spark, sse(delta("hi"), *calls))(rs.agent).ok and not ev(spark, sse(delta("hi")))(rs.agent).ok
    assert ev(spark, sse(delta("hi")))(lambda c: rs.agent(c, expect_tools=False)).ok and not ev(spark, sse(delta("?!")))(lambda c: rs.agent(c, expect_tools=False)).ok
    assert ev(spark, "conform", "tools_only")(rs.is_irregular) is False and ev(spark, "conform", "both")(rs.is_irregular) is True


def test_media(spark):
    assert ev(spark, json.dumps({"data": [{"embedding": [1, 2]}]}))(rs.embeddings).ok
    assert not ev(spark, json.dumps({"data": [{"embedding": [1, 2]}]}))(lambda c: rs.embeddings(c, 3)).ok
    assert ev(spark, json.dumps({"data": [{"b64_json": "aGk="}]}))(rs.image).ok and not ev(spark, json.dumps({"data": [{"b64_json": "%%%"}]}))(rs.image).ok
    assert ev(spark, json.dumps({"data": [{"url": "https://x/y"}]}))(rs.image).ok and not ev(spark, json.dumps({"data": []}))(rs.image).ok
    for data, ok in ((b"RIFFxxxx", True), (b"ID3\x03rest", True), (b"\xff\xfb\x90", True), (b"OggS", True), (b"\0\0\0\0ftyp", True), (b"junk", False), (b"j" * 1001, True), (b"", False)):
        assert ev(spark, data)(rs.audio).ok is ok, data
    assert ev(spark, '{"text": " a "}')(rs.transcription).ok and not ev(spark, '{"text": " "}')(rs.transcription).ok
    assert ev(spark, chat("Uma imagem VERMELHA"))(lambda c: rs.vision(c, "red")).ok and not ev(spark, chat("green"))(lambda c: rs.vision(c, "red")).ok
    assert ev(spark, '{"task_id": "t", "status": "queued"}')(rs.passthrough).ok and not ev(spark, '{"id": ""}')(rs.passthrough).ok
    assert ev(spark, '{"status": "completed", "output": {"videos": [{"video_url": "https://v/1.mp4"}]}}')(rs.video_task).ok
    assert not ev(spark, '{"status": "completed"}')(rs.video_task).ok and not ev(spark, '{"status": "failed", "url": "https://v"}')(rs.video_task).ok
    assert ev(spark, '{"taskId": " z "}')(rs.task_id) == "z"


def test_text_rules(spark):
    assert ev(spark, chat('{"a": 1}'))(rs.json_strict).ok and not ev(spark, chat("[1]"))(rs.json_strict).ok and not ev(spark, chat("```"))(rs.json_strict).ok
    assert ev(spark, "The Needle is")(lambda c: rs.needle(c, "needle")).ok and not ev(spark, "The Needle")(lambda c: rs.needle(c, "needle", 5)).ok
    assert ev(spark, 5, 9)(rs.first_token).ok and not ev(spark, 9, 5)(rs.first_token).ok
    stops = F.array(F.lit("END"))
    assert ev(spark, chat("text"))(lambda c: rs.parameters_forwarded(stops, F.lit(3), c)).ok
    assert not ev(spark, chat("an END"))(lambda c: rs.parameters_forwarded(stops, F.lit(3), c)).ok
    assert not ev(spark, chat("text"))(lambda c: rs.parameters_forwarded(stops, F.lit(2), c)).ok


def test_errors(spark):
    none = F.lit(None).cast("map<string,string>")
    after = F.create_map(F.lit("Retry-After"), F.lit("3"))
    check = lambda status, body, headers=none: ev(spark, body)(lambda c: rs.error_contract(F.lit(status), headers, c)).ok
    message, detail = '{"error": {"message": "no"}}', '{"detail": "no"}'
    assert check(404, message) and check(400, detail) and check(400, '{"error": "text"}') and not check(500, message) and not check(404, "{}")
    assert not check(429, message) and check(429, message, after) and check(429, '{"error": {"message": "no", "retry_after": 2}}')
    shapes = {"openai": message, "fastapi": detail, "both": '{"error": "x", "detail": 1}', "other": "[1]", "empty": " "}
    assert {k: ev(spark, v)(rs.envelope) for k, v in shapes.items()} == {k: k for k in shapes}
    assert ev(spark, "{bad")(rs.envelope) == "other" and ev(spark, '{"a": 1}')(rs.envelope) == "other" and ev(spark, '{"detail": null}')(rs.envelope) == "fastapi"
    typed = '{"error": {"message": "m", "type": "t", "code": null}}'
    assert ev(spark, typed, "proxy")(rs.contract_error) == "pass" and ev(spark, detail, "gateway")(rs.contract_error) == "diverged" and ev(spark, detail, "proxy")(rs.contract_error) == "fail"


def test_contracts(spark):
    models = {"object": "list", "data": [{"id": "a", "object": "model", "extra": 1}]}
    assert ev(spark, json.dumps(models))(lambda c: rs.contract(c, "models.list")).ok
    models["data"][0]["id"] = 3
    assert ev(spark, json.dumps(models))(lambda c: rs.violations(c, "models.list")) == ["$.data[0].id"]
    image = {"created": 1, "data": [{"url": "u"}]}
    assert ev(spark, json.dumps(image))(lambda c: rs.contract(c, "images.generation")).ok
    assert ev(spark, json.dumps({"created": True, "data": [{}]}))(lambda c: rs.violations(c, "images.generation")) == ["$.created", "$.data[0].url|$.data[0].b64_json"]
    models["data"] = [{"id": "a", "object": "model"}, {"nope": 1}, 7]
    assert ev(spark, json.dumps(models))(lambda c: rs.violations(c, "models.list")) == ["$.data[1].id", "$.data[2].id", "$.data[1].object", "$.data[2].object"]
    models["data"] = []
    assert ev(spark, json.dumps(models))(lambda c: rs.violations(c, "models.list")) == ["$.data"]
    vectors = {"object": "list", "model": "m", "data": [{"index": 0, "object": "embedding", "embedding": [0.5, "x", 1]}, {"index": 1, "object": "embedding", "embedding": []}], "usage": {"prompt_tokens": 1, "total_tokens": 1}}
    assert ev(spark, json.dumps(vectors))(lambda c: rs.violations(c, "embeddings")) == ["$.data[1].embedding", "$.data[0].embedding[1]"]
    assert ev(spark, json.dumps({"object": "list", "model": "m", "data": [{"index": 0, "object": "embedding", "embedding": [0.5]}], "usage": {"prompt_tokens": 1, "total_tokens": 1}}))(lambda c: rs.contract(c, "embeddings")).ok


@pytest.mark.parametrize(("body", "url"), [
    ('{"output": {"thumbnail": "http://h/x.png"}}', None), ('{"prompt": "http://h/p"}', None), ('{"url": 5, "video_url": "https://h/v"}', "https://h/v"),
    ('{"output": ["http://h/1", "http://h/2"]}', "http://h/2"), ('{"output": {"url": "http://h/o"}, "artifacts": {"file_url": "http://h/a"}}', "http://h/a"),
    ('{"data": {"results": [{"x": 1}, {"videos": [[{"download_url": "https://h/deep"}]]}]}}', "https://h/deep"), ('{"result": "http://h/bare", "url": "ftp://h"}', "http://h/bare"),
    ('["http://h/list"]', None), ('"http://h/text"', None), ("no json", None), (None, None), ('{"output": null, "data": {"url": "http://h/d"}}', "http://h/d"),
    ('{"output": [' + ", ".join(f'"http://h/{i}"' for i in range(12)) + "]}", "http://h/11"),
])
def test_addresses_of_results(spark, body, url):
    assert ev(spark, body)(rs.artifact_url) == url


def test_states_of_tasks(spark):
    states = {"Success": "done", " done ": "done", "FINISHED": "running", "queued": "running", "timeout": "failed", "Failure": "failed", "expired": "running"}
    for state, expected in states.items():
        assert ev(spark, '{"state": "%s"}' % state)(rs.task_state) == expected
    assert not ev(spark, '{"status": "finished", "url": "https://v"}')(rs.video_task).ok
    assert not ev(spark, '{"status": "done", "output": {"thumbnail": "http://h/x.png"}}')(rs.video_task).ok
