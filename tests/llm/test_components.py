from pyspark.sql import functions as F

from clickspark.llm.components import linked_places


def test_large_group_behind_an_unrelated_centre_makes_few_pairs(spark):
    """A bucket whose centre is unlike the 60 alike nodes: they join without all pairs."""
    hashed = spark.range(61).select("id", F.xxhash64("id").alias("h")).collect()
    centre = min(hashed, key=lambda r: r.h).id
    rows = [(1, r.id, 0 if r.id == centre else 100) for r in hashed]
    postings = spark.createDataFrame(rows, "key long, node long, mark long")
    made = []

    def verified(pairs):
        made.append(pairs.count())
        return pairs

    places = linked_places(postings, lambda a, b: a == b, verified).collect()
    roots = {r.node: r.root for r in places}
    alike = [r.id for r in hashed if r.id != centre]
    assert sorted(roots) == sorted(alike)
    assert len({roots[n] for n in alike}) == 1
    assert sum(made) < 4 * len(alike), made


def test_every_pair_is_verified_once(spark):
    """Also if it meets in several buckets and rounds; settled buckets take no part."""
    rows = [(k, n, 0) for k in (1, 2) for n in range(12)] + [(3, n, 0) for n in (0, 1, 20)]
    postings = spark.createDataFrame(rows, "key long, node long, mark long")
    seen = []

    def verified(pairs):
        seen.extend(tuple(r) for r in pairs.select("a", "b").collect())
        return pairs.where("b = 20")

    roots = {r.node: r.root for r in linked_places(postings, lambda a, b: a == b, verified).collect()}
    pairs = {(a, b) for a in range(12) for b in range(a + 1, 12)} | {(0, 20)}
    assert len(seen) == len({*seen}) and pairs <= {*seen} <= pairs | {(1, 20)}
    assert {0, 20} <= {*roots} and roots[0] == roots[20]
