"""The profiles of one root: which there are, what each of them shows, and which one readers use.

The root's own manifest is the registry: it holds the parameters of each profile and the name of the one in use. A profile can be
put to use only when its table is whole and shows the state that is asked for; in doubt nothing changes.
"""

from __future__ import annotations

from dataclasses import asdict
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .generations import Profile, Store

STATUS_SCHEMA = "profile string, in_use boolean, generation int, head string, files long, chunks long, unusable long, state string"


class NotReady(RuntimeError):
    """A profile can't be put to use; ``state`` says why, as in :meth:`Registry.status`."""

    def __init__(self, slug: str, state: str):
        super().__init__(f"profile {slug}: {state}")
        self.state = state


class Changed(RuntimeError):
    """The registry isn't in the version that the caller saw."""


class Registry:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.base = spark, root, Store(spark, root)

    def profiles(self) -> dict[str, Profile]:
        return {slug: Profile(**known) for slug, known in sorted(self.base.manifest().get("profiles", {}).items())}

    def version(self) -> int:
        """How often profiles were registered or put to use; :meth:`use` compares it."""
        return self.base.manifest().get("registry", 0)

    def in_use(self) -> Profile | None:
        return self.profiles().get(self.base.manifest()["profile"])

    def register(self, profile: Profile) -> None:
        """Add a profile. The same one again changes nothing; other parameters under its name are refused, as its vectors would
        no longer be of one space."""
        with self.base.lock():
            known = self.base.manifest().get("profiles", {})
            if known.get(profile.slug, asdict(profile)) != asdict(profile):
                raise ValueError(f"profile {profile.slug} is registered with other parameters")
            if profile.slug not in known:
                self.base._write_manifest(profiles=known | {profile.slug: asdict(profile)}, registry=self.version() + 1)

    def store(self, slug: str, **options) -> Store:
        known = self.profiles()
        if slug not in known:
            raise ValueError(f"no profile {slug}; there are: {', '.join(known) or 'none'}")
        return Store(self.spark, self.root, known[slug], **options)

    def status(self, head: str | None, dirty: bool = False) -> DataFrame:
        """A row for each profile: whether it is in use, what it shows, its files and chunks, chunks without a vector of its
        dimensions, and its state: ``missing`` (nothing published, or its table is gone), ``empty``, ``incomplete`` (unusable
        chunks), ``stale`` (not of ``head``, changes that aren't indexed, or unknown) or ``ready``."""
        parts = [self._status(self.store(slug), head, dirty) for slug in self.profiles()]
        return reduce(DataFrame.unionAll, parts) if parts else self.spark.createDataFrame([], STATUS_SCHEMA)

    def _status(self, store: Store, head: str | None, dirty: bool) -> DataFrame:
        known, used = store.manifest(), self.base.manifest()["profile"]
        there = known["published"] and store.fs.exists(store._path(store._folder(known["published"])))
        usable = F.coalesce((F.size("embedding") == store.profile.dim) & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x)), F.lit(False))
        sums = store.rows().agg(F.countDistinct("path").alias("files"), F.count(F.lit(1)).alias("chunks"), F.count_if(~usable).alias("unusable"))
        state = F.when(F.lit(not there), "missing").when(F.col("chunks") == 0, "empty").when(F.col("unusable") > 0, "incomplete")
        return sums.select(
            F.lit(store.profile.slug).alias("profile"), F.lit(used == store.profile.slug).alias("in_use"), F.lit(known["published"]).cast("int").alias("generation"),
            F.lit(known["head"]).cast("string").alias("head"), "files", "chunks", "unusable",
            state.when(F.lit(store.staleness(head, dirty) is not None), "stale").otherwise("ready").alias("state"),
        )

    def use(self, slug: str, head: str | None, dirty: bool = False, seen: int | None = None) -> Profile:
        """Put a profile to use, in one step under the lock: refused with :class:`NotReady` unless it is ``ready``, and with
        :class:`Changed` where the registry has moved on from the version ``seen``. What was in use stays so then."""
        with self.base.lock():
            version = self.version()
            if seen is not None and seen != version:
                raise Changed(f"the registry is in version {version}, not {seen}")
            store = self.store(slug)
            state = self._status(store, head, dirty).first()["state"]
            if state != "ready":
                raise NotReady(slug, state)
            self.base._write_manifest(profile=slug, registry=version + 1)
            return store.profile
