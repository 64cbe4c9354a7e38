import random

from leafmill.operators import dedup


def test_long_chains_are_one_group(spark):
    """Chains in random order, one with its second least id in the middle; and a self-link."""
    rng = random.Random(5)
    one = rng.sample(range(1000), 400)
    two = list(range(2001, 2201))
    two[0], two[100] = 2001, 2002
    two[1:100], two[101:] = range(2003, 2102), range(2102, 2201)
    links = list(zip(one, one[1:])) + list(zip(two, two[1:])) + [(5000, 5000)]
    got = {r.node: r.group for r in dedup.linked_groups(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == dict.fromkeys(one, min(one)) | dict.fromkeys(two, 2001) | {5000: 5000}
