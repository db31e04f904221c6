import math
import zlib
from collections import Counter

import xxhash

from gatewise.llm import sharding
from gatewise.llm.queries import QUERIES

from .conftest import SF, docs_df, table


def draw(key, level, node, weight):
    """The draw in plain Python: chained XXH64 over the key, the level and the node."""
    h = 42 if key is None else xxhash.xxh64_intdigest(key.to_bytes(8, "little", signed=True), 42)
    h = xxhash.xxh64_intdigest(level.encode(), h)
    h = xxhash.xxh64_intdigest(node.to_bytes(4, "little"), h)
    return -math.log(((h >> 11) + 0.5) / (1 << 53)) / weight


def brute(key, tree):
    live = [leaf for leaf in tree if leaf.weight > 0]
    at = {}
    for level in ("region", "rack", "shard"):
        nodes = Counter()
        for leaf in live:
            if all(getattr(leaf, k) == v for k, v in at.items()):
                nodes[getattr(leaf, level)] += leaf.weight
        at[level] = min(nodes, key=lambda n: (draw(key, level, n, nodes[n]), n))
    return at["region"], at["rack"], at["shard"]


def test_matches_brute_force_on_the_documents(spark):
    got = {r["doc_id"]: r for r in QUERIES["op1_hash_tree_shards"](spark, SF).collect()}
    docs = table(spark, "documents").collect()
    assert len(got) == len(docs)
    tree, grown = sharding.layout(24), sharding.layout(25)
    for d in docs:
        r, data = got[d["doc_id"]], (d["text"] or "").encode()
        assert (r["region"], r["rack"], r["shard"]) == brute(d["doc_id"], tree)
        assert r["grown_shard"] == brute(d["doc_id"], grown)[2]
        assert (r["size"], r["text_crc32"], r["law"]) == (len(data) + 8, zlib.crc32(data), "key")
        assert r["grown_shard"] in (r["shard"], 24)


def test_slots_have_no_gaps_and_every_row_counts(awkward, awkward_rows):
    rows = sharding.assign(awkward, sharding.layout(24), sharding.layout(25)).collect()
    assert len(rows) == len(awkward_rows)
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert all(r["size"] == 8 for r in rows if r["doc_id"] in (1, 2, 3))
    assert len({r["shard"] for r in rows if r["doc_id"] is None}) == 1
    assert len({r["shard"] for r in rows if r["doc_id"] == 8}) == 1


def test_empty_table(nothing):
    assert sharding.assign(nothing, sharding.layout(24), sharding.layout(25)).collect() == []


def test_movement_stays_in_subtrees_whose_weights_change(spark):
    tree = sharding.layout(24)
    heavy = [leaf._replace(weight=3.0) if leaf.shard == 5 else leaf for leaf in tree]
    docs = docs_df(spark, [(i, "t") for i in range(4000)])
    rows = sharding.assign(docs, tree, heavy).collect()
    moved = [r for r in rows if r["shard"] != r["grown_shard"]]
    assert moved
    place = {leaf.shard: leaf for leaf in tree}
    for r in moved:
        old, new = place[r["shard"]], place[r["grown_shard"]]
        assert new.region == 0  # the region of shard 5 gains, no other does
        if old.region == 0:
            assert new.rack == 1
            if old.rack == 1:
                assert new.shard == 5
    counts = Counter(r["grown_shard"] for r in rows)
    assert 2.0 < counts[5] / (sum(counts[s] for s in (4, 6, 7)) / 3) < 4.5


def test_one_more_shard_takes_rows_only_into_itself_again_and_again(spark):
    docs = docs_df(spark, [(i, "t") for i in range(1500)])
    for n in (24, 25, 31, 40):
        rows = sharding.assign(docs, sharding.layout(n), sharding.layout(n + 1)).collect()
        assert {r["grown_shard"] for r in rows if r["grown_shard"] != r["shard"]} == {n}
        assert max(Counter(r["shard"] for r in rows).values()) < 3 * 1500 / n


def test_weight_zero_takes_nothing(spark):
    tree = [leaf._replace(weight=0.0) if leaf.region == 1 else leaf for leaf in sharding.layout(24)]
    rows = sharding.assign(docs_df(spark, [(i, "t") for i in range(300)]), tree, tree).collect()
    assert {r["region"] for r in rows} == {0, 2}
