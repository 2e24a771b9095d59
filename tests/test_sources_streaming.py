import json
import subprocess

import pytest
from pyspark.sql import functions as F

from tidemark.operators import maintenance
from tidemark.sources import corpus, generations
from tidemark.streaming import latency


def tree(root, files):
    for name, data in files.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data if isinstance(data, bytes) else data.encode())


FILES = {"hello.py": "def f():\n    return 1\n", "docs/notes.md": "# A\nx\n# B\ny\n", "bin.py": b"a\0b", "big.md": "x" * 600_000, "vendor/v.py": "x", "data.bin": "x", "bad.md": b"caf\xe9"}


def test_corpus(spark, tmp_path):
    tree(tmp_path / "r", FILES)
    got = corpus.load_corpus(spark, f"{tmp_path}/r").collect()
    assert [r.path for r in got] == ["bad.md", "docs/notes.md", "hello.py"] and got[0].content == "caf�"
    sha = subprocess.run(["git", "hash-object", str(tmp_path / "r/hello.py")], capture_output=True, text=True).stdout.strip()
    assert got[2].blob_sha == sha and (got[2].kind, got[2].lang) == ("code", "python")


def test_matrix_and_lines(spark, tmp_path):
    df = spark.createDataFrame([("g", "t", "ok")], "group string, test string, status string")
    corpus.write_matrix(df, f"{tmp_path}/m")
    assert corpus.read_matrix(spark, f"{tmp_path}/m", ["group", "status", "notes"]).collect() == [("g", "ok", None)]
    for _ in range(2):
        corpus.write_json_lines(df, f"{tmp_path}/j")
    assert corpus.read_lines(spark, f"{tmp_path}/j").count() == 2
    assert corpus.markdown_table(df) == "| group | test | status |\n| --- | --- | --- |\n| g | t | ok |\n"


def live(spark, files):
    rows = [(p, "doc", "markdown", maintenance_hash(c), c) for p, c in files.items()]
    return spark.createDataFrame(rows, "path string, kind string, lang string, blob_sha string, content string")


def maintenance_hash(text):
    return str(hash(text))


def contents(store, gen=None):
    return sorted((r.path, r.content) for r in store.rows(gen).collect())


def test_generations(spark, tmp_path):
    store = generations.Store(spark, f"file://{tmp_path}/s")
    assert store.staleness("h") == "nothing is indexed"
    with pytest.raises(ValueError):
        store.set_profile(generations.Profile("space", 64))
    first = store.sync(live(spark, {"a.md": "one", "b.md": "two"}), "r", "h1")
    assert first == {"new": 2, "generation": 1, "chunks": 2} and store.staleness("h1") is None and store.staleness("h2")
    again = store.sync(live(spark, {"a.md": "one", "b.md": "two"}), "r", "h1")
    assert again == {"unchanged": 2, "generation": 2, "chunks": 2}
    store.sync(live(spark, {"a.md": "changed", "c.md": "three"}), "r", "h2")
    assert contents(store) == [("a.md", "changed"), ("c.md", "three")] and store.generations() == [3]
    store.set_profile(generations.Profile("space", 64))
    assert store.manifest()["profile"] == "space" and all(ok for ok, _ in generations.verify(store))


def test_files_without_chunks_are_known_to_be_stored(spark, tmp_path):
    store = generations.Store(spark, f"file://{tmp_path}/s")
    assert store.sync(live(spark, {"a.md": "one", "b.md": "", "c.md": " \n", "d.md": " "}), "r") == {"new": 4, "generation": 1, "chunks": 1}
    again = store.sync(live(spark, {"a.md": "one", "b.md": "", "c.md": "now", "e.md": ""}), "r")
    assert again == {"unchanged": 2, "changed": 1, "removed": 1, "new": 1, "generation": 2, "chunks": 2}
    assert len(list((tmp_path / "s/chunks-files").iterdir())) == 1
    # A list of another generation (an earlier version published since) doesn't count: the files with chunks do.
    store._write_manifest(files=store.manifest()["files"] | {"gen": 1})
    assert sorted(r.path for r in store.files().collect()) == ["a.md", "c.md"]


def test_a_path_that_is_named_twice_counts_twice(spark, tmp_path):
    store, one = generations.Store(spark, f"file://{tmp_path}/s"), live(spark, {"a.md": "one"})
    assert store.sync(one.unionByName(one).unionByName(live(spark, {"b.md": "two"})), "r") == {"new": 3, "generation": 1, "chunks": 2}
    assert store.sync(one.unionByName(one), "r") == {"unchanged": 2, "removed": 1, "generation": 2, "chunks": 1}
    assert store.sync(one, "r") == {"unchanged": 1, "removed": 1, "generation": 3, "chunks": 1}
    assert store.sync(live(spark, {"b.md": "two"}), "r") == {"new": 1, "removed": 1, "generation": 4, "chunks": 1}


def test_a_broken_run_goes_on_and_leaves_nothing_dead(spark, tmp_path):
    store = generations.Store(spark, f"file://{tmp_path}/s")
    store.sync(live(spark, {"a.md": "one"}), "r")

    def breaks(todo):
        yield todo.where("path = 'b.md'")
        raise RuntimeError("429")

    with pytest.raises(RuntimeError):
        store.sync(live(spark, {"a.md": "one", "b.md": "half", "c.md": "x"}), "r", batch=breaks)
    assert contents(store) == [("a.md", "one")] and store.manifest()["in_progress"] == 2
    seen = []
    store.sync(live(spark, {"a.md": "one", "b.md": "half", "c.md": "x"}), "r", batch=lambda t: seen.append([r.path for r in t.collect()]) or [t])
    assert seen == [["c.md"]] and contents(store) == [("a.md", "one"), ("b.md", "half"), ("c.md", "x")]
    with pytest.raises(RuntimeError):
        store.sync(live(spark, {"a.md": "one", "b.md": "edited", "c.md": "x"}), "r", batch=breaks)
    store.sync(live(spark, {"a.md": "one", "b.md": "half", "c.md": "x"}), "r")
    assert contents(store) == [("a.md", "one"), ("b.md", "half"), ("c.md", "x")]


def test_gates(spark, tmp_path):
    store = generations.Store(spark, f"file://{tmp_path}/s")
    with pytest.raises(generations.SecretFound):
        store.sync(live(spark, {"a.md": 'token = "0123456789abcdef0123"'}), "r")
    with store.lock(), pytest.raises(generations.Locked), store.lock():
        pass
    with pytest.raises(ValueError):
        generations.Profile("Bad-Name", 3)
    assert generations.run_migrations(store, {1: lambda s: None, 2: lambda s: None}) == [2] and store.manifest()["schema_version"] == 2
    with pytest.raises(ValueError):
        generations.run_migrations(store, {1: None, 3: None})


def test_parity_stops_publication(spark, tmp_path, monkeypatch):
    store = generations.Store(spark, f"file://{tmp_path}/s")
    store.sync(live(spark, {"a.md": "one", "b.md": "two"}), "r")
    monkeypatch.setattr(maintenance, "copy_forward", lambda target, *a: target.limit(0))
    with pytest.raises(generations.ParityError):
        store.sync(live(spark, {"a.md": "one", "b.md": "two"}), "r")
    assert store.manifest()["published"] == 1 and len(contents(store)) == 2


def test_streams(spark, tmp_path):
    line = lambda ts, ms: json.dumps({"event": "rag_search", "ts": ts, "profile": "p", "latency_ms": ms, "slo_breach": ms > 200})
    (tmp_path / "log").mkdir()
    (tmp_path / "log/1.jsonl").write_text("\n".join([line(10, 100), line(20, 300), line(4000, 50), "noise", line(90_000, 1)]))
    query = latency.windowed_latency(latency.read_log(spark, f"{tmp_path}/log")).writeStream.outputMode("append").format("memory").queryName("lat").trigger(availableNow=True).start()
    query.awaitTermination()
    got = sorted((r.calls, r.mean_ms, r.max_ms, r.breaches) for r in spark.table("lat").collect())
    assert got == [(1, 50.0, 50.0, 0), (2, 200.0, 300.0, 1)]
    batches = []
    files = spark.readStream.text(f"{tmp_path}/log")
    latency.ingest_available(files, f"{tmp_path}/ck", lambda df, i: batches.append(df.where(F.length("value") > 0).count()))
    assert batches == [5]


def count_letters(texts):
    assert not any("nothing new" in t for t in texts)
    return [[1.0 + t.count("a"), 1.0 + t.count("e")] for t in texts]


def test_vectors_of_a_profile(spark, tmp_path):
    store = generations.Store(spark, f"file://{tmp_path}/s", generations.Profile("letters", 2, gate=0.5))
    files = {"a.md": "banana and arena", "b.md": "tree where the bee", "c.md": "one more text"}
    store.sync(live(spark, files), "r", "h1", call=count_letters)
    vectors = {r.path: list(r.embedding) for r in store.rows().collect()}
    assert vectors["a.md"][0] > vectors["a.md"][1] and all(len(v) == 2 for v in vectors.values())
    # The second time only the changed file is embedded: the others' vectors are copied, or found by their contents.
    store.sync(live(spark, files | {"c.md": "another text", "d.md": files["a.md"]}), "r", "h2", call=count_letters)
    again = {r.path: list(r.embedding) for r in store.rows().collect()}
    assert again["a.md"] == vectors["a.md"] and again["d.md"] is not None and len(again) == 4
    with pytest.raises(Exception):  # a vector too short: the task fails, and nothing is published
        store.sync(live(spark, {"x.md": "other"}), "r", "h3", call=lambda texts: [[1.0]] * len(texts))
    assert store.manifest()["published"] == 2
    queries = spark.createDataFrame([(1, [1.0, 9.0], ["bee"]), (2, [9.0, 1.0], ["banana"])], "qid int, qvec array<float>, terms array<string>")
    hits = {(r.qid, r.pos): r.path for r in store.search(queries).collect()}
    assert hits[1, 1] == "b.md" and {hits[2, 1], hits[2, 2]} == {"a.md", "d.md"}  # copies of one text
    with pytest.raises(ValueError):
        generations.Store(spark, f"file://{tmp_path}/t").sync(live(spark, files), "r", call=count_letters)
    # Another profile has a table of its own; the first one's stays.
    other = generations.Store(spark, f"file://{tmp_path}/s", generations.Profile("other", 2))
    assert other.manifest()["published"] == 0 and other.rows().count() == 0 and store.rows().count() == 4


def test_sections(spark):
    from tidemark.operators import sections

    rows = spark.createDataFrame([(1, 1, "x"), (1, 2, "# a"), (1, 3, "y"), (1, 4, "# b"), (2, 1, None), (2, 2, "z")], "doc int, line int, t string")
    mark = F.coalesce(F.col("t").startswith("#"), F.lit(False))
    carried = sections.carry_forward(rows, "doc", "line", mark, F.col("t"), "heading").orderBy("doc", "line")
    assert [r.heading for r in carried.collect()] == [None, "# a", "# a", "# b", None, None]
    assert [r.fenced for r in sections.inside_fence(rows, "doc", "line", mark).orderBy("doc", "line").collect()] == [False, True, True, False, False, False]
    assert sorted(map(tuple, sections.slices(rows, "doc", "line", mark).collect())) == [(1, 2, 4), (1, 4, 5)]


def test_a_sync_hashes_each_text_twice_at_most(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def hashed(text):
        read.add(1)
        return str(len(text)) + text[:9]

    for head, n in (("h1", 40), ("h2", 50)):  # the second time ten files are new
        before = read.value
        files = live(spark, {f"{i}.md": f"{i} text of a file" for i in range(n)}).withColumn("blob_sha", hashed("content"))
        assert generations.Store(spark, f"file://{tmp_path}/s").sync(files, "r", head)["chunks"] == n
        assert read.value - before <= 2 * n


def test_files_are_cut_without_a_shuffle_where_nothing_is_stored(spark, tmp_path, monkeypatch):
    plans, staged = [], generations.stage
    seen = lambda df, name: (name == "chunks" and plans.append(df._jdf.queryExecution().executedPlan().toString())) or staged(df, name)
    monkeypatch.setattr(generations, "stage", seen)
    files = live(spark, {f"{i}.md": f"# A\n{'one ' * 500}\n# A\n{'one ' * 500}\n# {i}\n" for i in range(12)})
    many, one = (generations.Store(spark, f"file://{tmp_path}/{s}", generations.Profile("letters", 2)) for s in "ab")
    many.sync(files.repartition(8).where("path <> ''").withColumn("lang", F.lower("lang")), "r", call=count_letters)
    one.sync(files.coalesce(1), "r", call=count_letters)
    assert sum("ENSURE_REQUIREMENTS" in p for p in plans[1::2]) == 0 and "RoundRobin" in plans[-1]
    rows = lambda store: sorted((r.path, r.ordinal, r.content, r.file_hash, list(r.embedding)) for r in store.rows().collect())
    assert rows(many) == rows(one) and len(rows(one)) >= 12
    assert all(ok for store in (many, one) for ok, _ in generations.verify(store))


def test_a_path_that_is_there_twice_has_its_rows_once(spark, tmp_path):
    store = generations.Store(spark, f"file://{tmp_path}/s")
    files = live(spark, {"a.md": "one", "b.md": "two"})
    assert store.sync(files.unionByName(files), "r", "h1")["chunks"] == 2 and all(ok for ok, _ in generations.verify(store))
