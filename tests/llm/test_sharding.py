from __future__ import annotations

import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from pullgrid.llm import sharding


def test_every_shard_is_numbered_without_gaps(odd, odd_rows, nothing):
    rows = sharding.shard(odd, [1.0] * 5).collect()
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        text = (r.row.text or "").encode()
        assert (r.size, r.text_crc32) == (len(text) + 1, zlib.crc32(text))
    assert Counter((r.row.doc_id, r.row.text) for r in rows) == Counter((d, t) for d, t, _ in odd_rows)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard(nothing, [1.0] * 5).count() == 0


def test_one_more_shard_takes_rows_only_into_itself(spark):
    keys = spark.range(20_000).select(
        sharding.rendezvous(F.col("id"), [1.0] * 8).alias("old"),
        sharding.rendezvous(F.col("id"), [1.0] * 9).alias("new"),
    )
    moved = keys.where("old <> new").groupBy("new").count().collect()
    assert [r.new for r in moved] == [8]
    assert abs(moved[0]["count"] - 20_000 / 9) < 200


def test_shares_follow_weights_and_a_changed_weight_moves_little(spark):
    weights, heavier = [1.0, 2.0, 3.0, 2.0], [1.0, 2.0, 4.0, 2.0]
    keys = spark.range(40_000).select(
        sharding.rendezvous(F.col("id"), weights).alias("old"),
        sharding.rendezvous(F.col("id"), heavier).alias("new"),
    )
    shares = dict(keys.groupBy("old").count().collect())
    for shard, weight in enumerate(weights):
        assert abs(shares[shard] - 40_000 * weight / 8) < 400
    assert {r.new for r in keys.where("old <> new").select("new").distinct().collect()} == {2}


def test_one_shard(spark):
    assert spark.range(10).where(sharding.rendezvous(F.col("id"), [1.0]) == 0).count() == 10
