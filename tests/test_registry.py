import pytest

from tidemark.plans.maintenance_queries import letters
from tidemark.sources.generations import Profile, Store
from tidemark.sources.registry import Changed, NotReady, Registry


def corpus(spark, *rows):
    return spark.createDataFrame([(p, "code", None, f"sha-{t}", t) for p, t in rows], "path string, kind string, lang string, blob_sha string, content string")


def states(registry, head, dirty=False):
    return {r.profile: r.state for r in registry.status(head, dirty).collect()}


def test_only_a_whole_profile_of_the_head_is_put_to_use(spark, tmp_path):
    registry = Registry(spark, f"file://{tmp_path}/s")
    assert registry.profiles() == {} and registry.status("h").count() == 0 and registry.in_use() is None
    one, two = Profile("one", 4, 0.5), Profile("two", 4)
    for profile in (one, two, one):
        registry.register(profile)
    assert list(registry.profiles().values()) == [one, two] and registry.version() == 2
    with pytest.raises(ValueError):
        registry.register(Profile("one", 8))
    with pytest.raises(ValueError):
        registry.use("three", "h")

    registry.store("one").sync(corpus(spark, ("a", "alpha"), ("b", "beta")), "r", head="h", call=letters)
    assert states(registry, "h") == {"one": "ready", "two": "missing"} and states(registry, "g")["one"] == "stale"
    assert states(registry, "h", dirty=True)["one"] == "stale" and states(registry, None)["one"] == "stale"
    seen = registry.version()
    assert registry.use("one", "h", seen=seen) == one and registry.in_use() == one
    for slug, head, state in (("two", "h", "missing"), ("one", "g", "stale"), ("one", None, "stale")):
        with pytest.raises(NotReady) as refused:
            registry.use(slug, head)
        assert refused.value.state == state and registry.in_use() == one
    with pytest.raises(Changed):
        registry.use("one", "h", seen=seen)

    registry.store("two").sync(corpus(spark), "r", head="h", call=letters)
    assert states(registry, "h")["two"] in ("empty", "missing")
    with pytest.raises(NotReady):
        registry.use("two", "h")
    row = registry.status("h").where("profile = 'one'").first()
    assert (row.in_use, row.generation, row.files, row.chunks, row.unusable) == (True, 1, 2, 2, 0)


def test_vectors_of_other_dimensions_are_unusable(spark, tmp_path):
    registry = Registry(spark, f"file://{tmp_path}/s")
    registry.register(Profile("one", 5))
    Store(spark, registry.root, Profile("one", 4)).sync(corpus(spark, ("a", "alpha")), "r", head="h", call=letters)
    assert registry.status("h").first().state == "incomplete"
    with pytest.raises(NotReady):
        registry.use("one", "h")
