import collections
import zlib

from pyspark.sql import functions as F

from tickloom.llm import sharding as sh


def shards(df, tree):
    key = F.col("id").cast("string")
    return {r["id"]: r["shard"] for r in df.select("id", sh.descend(key, tree).alias("shard")).collect()}


def test_shares_follow_weights(spark):
    tree = [("r0", "a", 0, 1.0), ("r0", "a", 1, 2.0), ("r0", "b", 2, 1.0), ("r1", "c", 3, 4.0), ("r1", "c", 4, 0.0)]
    found = collections.Counter(shards(spark.range(40_000), tree).values())
    assert set(found) == {0, 1, 2, 3}
    for shard, weight in ((0, 1), (1, 2), (2, 1), (3, 4)):
        assert abs(found[shard] / 40_000 - weight / 8) < 0.01


def test_changed_weights_move_rows_of_their_subtree_only(spark):
    tree = sh.balanced_tree(16)
    heavier = [(*leaf[:3], 3.0 if leaf[2] == 5 else 1.0) for leaf in tree]
    before, after = shards(spark.range(20_000), tree), shards(spark.range(20_000), heavier)
    region = {leaf[2]: leaf[0] for leaf in tree}
    moved = [(before[i], after[i]) for i in before if before[i] != after[i]]
    # Rows come into shard 5's region, or move inside it; other regions exchange nothing.
    assert moved and all(region[b] == region[5] for _, b in moved)
    same_rack = [m for m in moved if region[m[0]] == region[5]]
    assert all(b in (4, 5) for a, b in same_rack if a in (6, 7)) and all(b == 5 for a, b in same_rack if a == 4)


def test_growing_takes_rows_into_the_new_shard_only(spark):
    for n in (1, 16, 17):
        tree = sh.balanced_tree(min(n, 16))
        while len(tree) < n:
            tree = sh.grown_tree(tree)
        before, after = shards(spark.range(5000), tree), shards(spark.range(5000), sh.grown_tree(tree))
        moved = [after[i] for i in before if before[i] != after[i]]
        assert set(moved) == {n} and abs(len(moved) / 5000 - 1 / (n + 1)) < 0.02


def test_columns_and_slots(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(sh, "CELL_ROWS", 3)         # many cells
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = sh.assign(docs, sh.balanced_tree(16)).collect()
    slots = collections.defaultdict(list)
    for r in rows:
        data = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(data) + 1, zlib.crc32(data), "key")
        assert r["grown_shard"] in (r["shard"], 16)
        slots[r["shard"]].append(r["slot"])
    assert len(rows) == len(texts)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_odd_rows(odd, nothing):
    rows = sh.assign(odd, sh.balanced_tree(4)).collect()
    assert len(rows) == odd.count()
    assert {(r["size"], r["text_crc32"]) for r in rows if r["doc_id"] in (3, 4)} == {(1, 0)}
    twice = [r for r in rows if r["doc_id"] == 1]
    assert twice[0]["shard"] == twice[1]["shard"] and twice[0]["slot"] != twice[1]["slot"]
    assert sh.assign(nothing, sh.balanced_tree(4)).collect() == []
