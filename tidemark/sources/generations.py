"""A chunk table on disk in generations, with a small manifest that publishes one of them.

``<root>/chunks/gen=<n>/`` holds the rows of a generation, ``<root>/manifest.json`` what is published; a profile (a vector
space) has a table and a manifest of its own, named after it, and its rows have vectors. Files are reached by
Hadoop's file system, so the root may lie wherever Spark reads. The manifest is written beside and renamed into place;
readers see the published generation until then. Nothing that a manifest names is deleted or renamed: a generation that is
written anew gets another folder (``gen=<n>-<attempt>``), which the manifest then names, and folders that no manifest names are
collected after the next publication. A table ``chunks-files`` beside them lists the files of the published generation, so that one
without chunks is known to be stored.

One writer at a time holds ``<root>/lock``, a lease with an owner and an expiry. Whoever takes it raises the manifest's fencing
number, and publishes only while that number is its own, so a writer whose lease ran out can't overwrite its successor. An
indexed store keeps a positional index (:mod:`.postings`) of the published rows; manifest and index change together.
"""

from __future__ import annotations

import contextlib
import json
import re
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import apply_prefix, content_hash
from ..operators import maintenance
from ..operators.chunking import chunk_files
from ..operators.embedding import embed, only_new
from ..operators.search import search
from ..operators.toplists import spread
from ..staging import stage
from .postings import Postings, refreshed

SLUG = re.compile(r"^[a-z][a-z0-9_]{1,31}$")
ROW_SCHEMA = "repo string, path string, kind string, lang string, ordinal int, symbol string, content string, content_hash string, file_hash string, embedding array<float>"


@dataclass(frozen=True)
class Profile:
    """A vector space: its table, dimensions, distance gate and prefix policy belong together."""

    slug: str
    dim: int
    gate: float | None = None
    prefix_policy: str = "none"
    batch_size: int = 16

    def __post_init__(self):
        if not SLUG.match(self.slug):
            raise ValueError(f"not a profile name: {self.slug!r}")


class Locked(RuntimeError):
    """Another writer holds the lock, or took it over when this one's lease ran out."""


class ParityError(RuntimeError):
    """The new generation lacks unchanged files; nothing was published."""


class SecretFound(RuntimeError):
    """The corpus holds what looks like a secret; nothing was written."""


class Store:
    def __init__(self, spark: SparkSession, root: str, profile: Profile | None = None, indexed: bool = False, lease: float = 3600.0):
        self.spark, self.root, self.profile, self.indexed, self.lease = spark, root.rstrip("/"), profile, indexed, lease
        self._fence: int | None = None
        suffix = f"_{profile.slug}" if profile else ""
        self.table, self.manifest_at = f"{self.root}/chunks{suffix}", f"{self.root}/manifest{suffix}.json"
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self.fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    # ---- manifest ----

    def manifest(self) -> dict:
        at = self._path(self.manifest_at)
        if not self.fs.exists(at):
            return {"published": 0, "in_progress": None, "head": None, "dirty": False, "schema_version": 1, "profile": None}
        return json.loads(self._text(at))

    def _text(self, at) -> str:
        stream = self.fs.open(at)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _write_manifest(self, **changes) -> None:
        """Change the manifest in one step; refused where another writer has taken the lock since."""
        if self._fence is not None and self.manifest().get("fence", 0) != self._fence:
            raise Locked("the lease ran out and another writer took over")
        new = self._path(f"{self.root}/.manifest-{uuid.uuid4().hex}")
        out = self.fs.create(new, True)
        out.write(bytearray(json.dumps(self.manifest() | changes).encode()))
        out.close()
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri())
        rename = getattr(self.spark._jvm, "org.apache.hadoop.fs.Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        context.rename(new, self._path(self.manifest_at), options)

    def set_profile(self, profile: Profile) -> None:
        """Make a profile the published one; refused while nothing is published."""
        if not self.count(self.manifest()["published"]):
            raise ValueError("nothing is published yet")
        self._write_manifest(profile=profile.slug)

    @contextlib.contextmanager
    def lock(self) -> Iterator[None]:
        """Hold the lease. One that has expired is moved away (one taker can do that) and replaced."""
        at, owner = self._path(f"{self.root}/lock"), uuid.uuid4().hex
        self.fs.mkdirs(self._path(self.root))
        try:
            if self.fs.exists(at) and self._expired(at) and not self.fs.rename(at, self._path(f"{self.root}/.lock-{owner}")):
                raise Locked(f"{at} was taken over")
            created = self.fs.createNewFile(at)
            if created:
                out = self.fs.create(at, True)
                out.write(bytearray(json.dumps({"owner": owner, "until": time.time() + self.lease}).encode()))
                out.close()
        except Locked:
            raise
        except Exception as e:
            raise Locked(str(e)) from e
        if not created:
            raise Locked(f"{at} exists")
        fence = self.manifest().get("fence", 0) + 1
        self._write_manifest(fence=fence)
        self._fence = fence
        try:
            yield
        finally:
            self._fence = None
            with contextlib.suppress(Exception):  # what is left of a lease expires
                if json.loads(self._text(at)).get("owner") == owner:
                    self.fs.delete(at, False)

    def _expired(self, at) -> bool:
        """Whether a lease's time is over; a lock that says nothing is held until it is taken away by hand."""
        try:
            return json.loads(self._text(at))["until"] < time.time()
        except (ValueError, KeyError, TypeError):
            return False

    # ---- rows ----

    def _folder(self, gen: int) -> str:
        return f"{self.table}/{self.manifest().get('folders', {}).get(str(gen), f'gen={gen}')}"

    def rows(self, gen: int | None = None) -> DataFrame:
        """The rows of a generation (the published one by default), with its number."""
        gen = self.manifest()["published"] if gen is None else gen
        if not self.fs.exists(self._path(self._folder(gen))):
            return self.spark.createDataFrame([], ROW_SCHEMA).withColumn("gen", F.lit(gen))
        return self.spark.read.schema(ROW_SCHEMA).parquet(self._folder(gen)).withColumn("gen", F.lit(gen))

    def count(self, gen: int) -> int:
        return self.rows(gen).count()

    def _listed(self) -> list[tuple[int, str]]:
        """(generation, folder's name) of all folders of the table."""
        at = self._path(self.table)
        names = [s.getPath().getName() for s in self.fs.listStatus(at)] if self.fs.exists(at) else []
        return sorted((int(n.removeprefix("gen=").split("-")[0]), n) for n in names if n.startswith("gen="))

    def generations(self) -> list[int]:
        return [gen for gen, name in self._listed() if self._folder(gen).endswith(f"/{name}")]

    def collect_old(self) -> int:
        """Drop generations below the published one, and folders that the manifest doesn't name; how many generations went."""
        published, old = self.manifest()["published"], 0
        for gen, name in self._listed():
            named = self._folder(gen).endswith(f"/{name}")
            if gen < published or not named:
                self.fs.delete(self._path(f"{self.table}/{name}"), True)
                old += named
        kept = {*self.manifest().get("segments", []), self.manifest().get("dead"), self.manifest().get("files", {}).get("at")}
        for at in (self._path(f"{self.table}-postings"), self._path(f"{self.table}-files")):
            for status in self.fs.listStatus(at) if self.fs.exists(at) else []:
                name = status.getPath().getName()
                if not any(k and k.endswith(f"/{name}") for k in kept):
                    self.fs.delete(status.getPath(), True)
        return old

    # ---- sync ----

    def staleness(self, head: str | None, dirty: bool = False) -> str | None:
        """Why the index doesn't show ``head``; None where it does."""
        known = self.manifest()
        if not known["published"]:
            return "nothing is indexed"
        if head is None or known["head"] is None:
            return "the state is unknown"
        if known["head"] != head:
            return "the index is of another commit"
        return "the tree has changes that aren't indexed" if dirty or known["dirty"] else None

    def _known_files(self) -> dict:
        """What the manifest says of the list of the published generation's files; nothing where an earlier version wrote that."""
        known = self.manifest()
        return listed if (listed := known.get("files", {})).get("gen") == known["published"] else {}

    def files(self) -> DataFrame:
        """path, file_hash of the files that the published generation was made of; those with chunks where they weren't listed."""
        known = self._known_files()
        if not known:
            return self.rows().select("path", "file_hash").distinct()
        return self.spark.read.schema("path string, file_hash string").parquet(known["at"])

    def _write_files(self, live: DataFrame, gen: int, repeated: bool) -> dict:
        """List the files of a generation; what the manifest is to say of that."""
        at = f"{self.table}-files/{uuid.uuid4().hex}"
        live.where("path IS NOT NULL").select("path", F.col("blob_sha").alias("file_hash")).write.parquet(at)
        return {"gen": gen, "at": at, "repeated": repeated}

    def plan(self, corpus: DataFrame, repeated: bool = False) -> DataFrame:
        """path, action of the files of ``corpus`` and of the store; ``repeated`` says that ``corpus`` may name a path twice."""
        return maintenance.sync_plan(corpus, self.files(), repeated or self._known_files().get("repeated", False))

    def sync(self, corpus: DataFrame, repo: str, head: str | None = None, dirty: bool = False, batch: Callable[[DataFrame], list[DataFrame]] | None = None,
             gate: bool = True, call: Callable[[list[str]], list[list[float]]] | None = None) -> dict:
        """Bring the index to ``corpus`` (path, kind, lang, blob_sha, content): a new generation, published when it is whole.

        Unchanged files are copied forward, others chunked in the batches that ``batch`` deals them to. Each batch is one
        append, so a run that was broken off goes on behind the last; what an older attempt left of files that have changed
        since is not published. ``call`` embeds texts for the store's profile, which can't be synced without it; a content is
        embedded once, and not again where the published generation has its vector. Unchanged rows without a vector get one.
        """
        if (call is None) != (self.profile is None):
            raise ValueError("vectors need a profile" if self.profile is None else "a store with a profile needs a callable that embeds")
        if gate:
            found = maintenance.secret_findings(corpus, "content").select("path", "rule").limit(20).collect()
            if found:
                raise SecretFound(", ".join(f"{r.path}: {r.rule}" for r in found))
        with self.lock():
            old = self.manifest()["published"]
            new = old + 1
            self._write_manifest(in_progress=new)
            # Both are read several times; a corpus may hash whole texts for them.
            live = stage(corpus.select("path", "blob_sha"), "live")
            repeated = not live.where("path IS NOT NULL").groupBy("path").count().where("count > 1").isEmpty()
            plan = stage(self.plan(live, repeated), "sync-plan")
            bare_table = not any(self.fs.exists(self._path(self._folder(gen))) for gen in (old, new))
            unchanged = plan.where("action = 'unchanged'").select("path")
            both = self.rows(old).unionByName(self.rows(new))
            copied = maintenance.copy_forward(both, old, new, unchanged)
            self._append(copied if call is None else copied.where("embedding IS NOT NULL"), new)
            if call is not None:
                bare = maintenance.copy_forward(both, old, new, unchanged).where("embedding IS NULL")
                self._append(self._embedded(bare.drop("embedding"), old, call), new)
            todo = self._all_new(corpus, live) if bare_table else maintenance.remaining(plan, corpus, self.rows(new).select("path", "file_hash"))
            for part in batch(todo) if batch else [todo]:
                self._append(self._embedded(self._chunked(part, repo, new, repeated), old, call), new)
            self._drop_dead(new, live)
            gaps = maintenance.parity_gaps(self.rows(old).unionByName(self.rows(new)), old, new, unchanged)
            if not gaps.isEmpty():
                raise ParityError(f"generation {new} lacks {gaps.count()} unchanged files")
            counts = {r.action: r.files for r in maintenance.plan_counts(plan).collect()}
            listed = self._write_files(live, new, repeated)
            self._write_manifest(published=new, in_progress=None, head=head, dirty=dirty, files=listed, **self._reindexed(new))
            self.collect_old()
            return counts | {"generation": new, "chunks": self.count(new)}

    def _all_new(self, corpus: DataFrame, live: DataFrame) -> DataFrame:
        """What is to be done where nothing is stored: all files, without a join. They are dealt out where fewer tasks than cores read them
        (``live`` has a file of each)."""
        files = corpus.where("path IS NOT NULL").withColumn("action", F.lit("new"))
        return files if len(live.inputFiles()) >= self.spark.sparkContext.defaultParallelism else spread(files)

    def _chunked(self, files: DataFrame, repo: str, gen: int, repeated: bool) -> DataFrame:
        """The chunks of ``files``. A file is cut by one task, which leaves out its equal contents; only a corpus with ``repeated`` paths is shuffled for that."""
        rows = chunk_files(files.withColumnRenamed("blob_sha", "file_hash"), "file_hash", once=True)
        rows = rows.withColumns({"repo": F.lit(repo), "content_hash": content_hash("content"), "gen": F.lit(gen)})
        return maintenance.first_rows(rows) if repeated else rows

    def _embedded(self, rows: DataFrame, old: int, call: Callable[[list[str]], list[list[float]]] | None) -> DataFrame:
        """``rows`` with their vectors: those of equal contents in the generation ``old``, else what ``call`` gives; null without it."""
        if call is None:
            return rows.withColumn("embedding", F.lit(None).cast("array<float>"))
        rows = stage(rows, "chunks")
        known = self.rows(old).where("embedding IS NOT NULL").select("content_hash", "embedding").dropDuplicates(["content_hash"])
        new = only_new(rows.select("content_hash", "content").dropDuplicates(["content_hash"]), known)
        asked = new.withColumn("__asked", apply_prefix("content", self.profile.prefix_policy, "doc"))
        made = stage(embed(asked, call, self.profile.dim, "__asked", self.profile.batch_size).select("content_hash", "embedding"), "vectors")
        return rows.join(known.unionByName(made), "content_hash")

    def postings(self) -> Postings | None:
        """The index of the published rows; None where none is kept."""
        known = self.manifest()
        return Postings(self.spark, known["segments"], known.get("dead")) if known.get("segments") else None

    def _with_id(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("id", F.xxhash64("repo", "path", "content_hash"))

    def _reindexed(self, gen: int) -> dict:
        """What the manifest says of the index once it shows the generation ``gen``."""
        if not self.indexed:
            return {"segments": [], "dead": None}
        at = f"{self.table}-postings"
        index = refreshed(self.postings() or Postings(self.spark), self._with_id(self.rows(gen)), f"{at}/segment-{uuid.uuid4().hex}", f"{at}/dead-{uuid.uuid4().hex}")
        return {"segments": index.segments, "dead": index.dead}

    def search(self, queries: DataFrame, **options) -> DataFrame:
        """Hybrid search (:func:`tidemark.operators.search.search`) of the published generation, with the profile's gate."""
        chunks, index = self._with_id(self.rows()), self.postings()
        if index is not None:
            options.setdefault("lexical", index.topk)
        return search(chunks, queries, **({"gate": self.profile.gate if self.profile else None} | options))

    def _append(self, rows: DataFrame, gen: int) -> None:
        names = [f.split()[0] for f in ROW_SCHEMA.split(", ")]
        rows.select(*names).write.mode("append").parquet(self._folder(gen))

    def _drop_dead(self, gen: int, live: DataFrame) -> None:
        """Rewrite a generation without rows of contents that aren't live (path, blob_sha), if there are any."""
        rows = self.rows(gen)
        kept = maintenance.only_live(rows, live)
        if rows.count() == kept.count():
            return
        name = f"gen={gen}-{uuid.uuid4().hex[:8]}"
        kept.drop("gen").write.parquet(f"{self.table}/{name}")
        self._write_manifest(folders={str(gen): name})


def run_migrations(store: Store, migrations: dict[int, Callable[[Store], None]]) -> list[int]:
    """Apply the migrations above the manifest's version, in order, each recorded when it is done; numbers have no gaps."""
    if sorted(migrations) != list(range(1, len(migrations) + 1)):
        raise ValueError("migrations must be numbered from 1 without gaps")
    done = []
    for version in sorted(migrations):
        if version > store.manifest()["schema_version"]:
            migrations[version](store)
            store._write_manifest(schema_version=version)
            done.append(version)
    return done


def verify(store: Store) -> list[tuple[bool, str]]:
    """Structural checks of a store: (passed, what was checked)."""
    manifest, generations = store.manifest(), store.generations()
    rows = store.rows()
    wanted = {f.split()[0] for f in ROW_SCHEMA.split(", ")}
    return [
        (not manifest["published"] or manifest["published"] in generations, "the published generation is there"),
        (wanted <= set(rows.columns), "its rows have all columns"),
        (rows.where("kind NOT IN ('code', 'doc', 'config') OR content IS NULL OR length(content_hash) <> 64").isEmpty(), "kinds and hashes are well formed"),
        (rows.groupBy(*maintenance.ROW_KEY).count().where("count > 1").isEmpty(), "keys are unique"),
        (manifest["in_progress"] is None, "no run was broken off"),
    ]
