"""Listing of versioned files against the version-control tool, and syncs that open only what has changed."""

import os
import subprocess

import pytest

from tidemark.sources.generations import Store
from tidemark.sources.versioned import versioned_corpus, versioned_files


def git(root, *words, **kw):
    who = ["-c", "user.name=t", "-c", "user.email=t@t", "-c", "init.defaultBranch=main"]
    return subprocess.run(["git", *who, "-C", str(root), *words], capture_output=True, text=True, check=kw.pop("check", True), **kw).stdout


def make(root, files):
    root.mkdir(parents=True, exist_ok=True)
    if not (root / ".git").exists():
        git(root, "init", "-q")
    for name, data in files.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(data if isinstance(data, bytes) else data.encode())
    git(root, "add", "-A")


def by_tool(root):
    """{path: (mode, id, stage)} as the tool lists them; of a path in conflict the last."""
    out = {}
    for record in git(root, "ls-files", "-s", "-z").split("\0")[:-1]:
        meta, path = record.split("\t", 1)
        mode, blob, stage = meta.split()
        out[path] = mode, blob, int(stage)
    return out


FILES = {"hello.py": "def f():\n    return 1\n", "docs/notes.md": "# A\nx\n", "a/" + "long" * 60 + "/" + "n" * 200 + ".md": "deep", "bin.py": b"a\0b",
         "big.md": "x" * 600_000, "data.bin": "x", "é ü.md": "names", "x\ty.md": "tab", "bad.md": b"caf\xe9"}


@pytest.mark.parametrize("version", [2, 3, 4])
def test_listing(spark, tmp_path, version):
    make(tmp_path, FILES | {f"many/{i}.md": str(i) for i in range(5000)})
    if version == 3:
        (tmp_path / "later.md").write_text("later")
        git(tmp_path, "add", "-N", "later.md")
    else:
        git(tmp_path, "update-index", "--index-version", str(version))
    assert (tmp_path / ".git/index").read_bytes()[7] == version
    got = {r.path: (r.mode, r.blob_sha, r.stage) for r in versioned_files(spark, str(tmp_path)).collect()}
    assert got == by_tool(tmp_path)


def test_conflicts_trees_and_links(spark, tmp_path):
    one, two = tmp_path / "all/one", tmp_path / "all/two"
    make(one, {"f.md": "base"})
    git(one, "commit", "-qm", "1")
    git(one, "checkout", "-qb", "side")
    make(one, {"f.md": "side"})
    git(one, "commit", "-qm", "2")
    git(one, "worktree", "add", "-q", str(tmp_path / "linked"), "main")
    git(one, "checkout", "-q", "--detach", "main")
    make(one, {"f.md": "other"})
    git(one, "commit", "-qm", "3")
    git(one, "merge", "side", check=False)
    make(two, {"g.md": "g"})
    (tmp_path / "all/none").mkdir()
    got = {(r.root, r.path): (r.mode, r.blob_sha, r.stage) for r in versioned_files(spark, f"file://{tmp_path}/all").collect()}
    assert got == {(str(root), path): v for root in (one, two) for path, v in by_tool(root).items()}
    assert got[str(one), "f.md"][2] == 3
    assert {r.path: (r.mode, r.blob_sha, r.stage) for r in versioned_files(spark, f"{tmp_path}/linked").collect()} == by_tool(tmp_path / "linked")
    assert {(r.path, r.content) for r in versioned_corpus(spark, f"{tmp_path}/all").where("path LIKE 'two%'").collect()} == {("two/g.md", "g")}
    assert versioned_files(spark, f"{tmp_path}/all/none").count() == 0


def test_damage_is_an_error(spark, tmp_path):
    make(tmp_path, FILES)
    index = tmp_path / ".git/index"
    whole = index.read_bytes()
    for bad in (whole[:-30], whole[:40], b"XXXX" + whole[4:], whole[:60] + bytes([whole[60] ^ 1]) + whole[61:]):
        index.write_bytes(bad)
        with pytest.raises(Exception, match="index"):
            versioned_files(spark, str(tmp_path)).collect()


def test_a_sync_opens_only_what_has_changed(spark, tmp_path):
    root = tmp_path / "tree"
    make(root, FILES)
    store = Store(spark, f"{tmp_path}/store")
    first = versioned_corpus(spark, str(root))
    assert {r.path: r.content for r in first.collect()} == {
        "hello.py": FILES["hello.py"], "docs/notes.md": FILES["docs/notes.md"], "bad.md": "caf�", "é ü.md": "names", "x\ty.md": "tab",
        "a/" + "long" * 60 + "/" + "n" * 200 + ".md": "deep"}
    store.sync(first, "r")
    known = store.rows().selectExpr("path", "file_hash AS blob_sha")
    make(root, {"docs/notes.md": "# B\ny\n", "new.md": "new"})
    git(root, "rm", "-q", "--cached", "bad.md")
    for path in root.rglob("*.*"):
        if path.is_file() and ".git/" not in str(path):
            os.utime(path, (1000, 2000))
    second = versioned_corpus(spark, str(root), known)
    assert {r.path for r in second.collect() if r.content is not None} == {"docs/notes.md", "new.md"}
    counts = store.sync(second, "r")
    assert (counts["new"], counts["changed"], counts["removed"], counts["unchanged"]) == (1, 1, 1, 4)
    assert os.stat(root / "hello.py").st_atime == 1000
    assert {r.path for r in store.rows().select("path").collect()} == {r.path for r in second.collect()}
