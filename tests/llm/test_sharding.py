from __future__ import annotations

import zlib

from ordersight.llm import sharding
from tests.llm.conftest import odd_rows, prose, table


def check(rows, placed, shards):
    assert len(placed) == len(rows)
    wanted = sorted(((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows), key=repr)
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in placed), key=repr) == wanted
    by_shard = {}
    for r in placed:
        assert 0 <= r.shard < shards
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    sizes = [0] * shards
    for r in placed:
        sizes[r.shard] += r["size"]
    return sizes


def test_odd_rows(odd, empty):
    check(odd_rows(), sharding.shard_documents(odd, 4).collect(), 4)
    assert sharding.shard_documents(empty, 4).count() == 0


def test_even_sizes_and_whole_groups(spark):
    rows = [(k, prose(k, 20 + k % 90)) for k in range(900)]
    rows += [(1000 + k, rows[k // 3][1]) for k in range(240)]
    placed = sharding.shard_documents(table(spark, rows), 5).collect()
    sizes = check(rows, placed, 5)
    assert max(sizes) - min(sizes) <= 0.01 * sum(sizes) / 5
    at = {}
    for r in placed:
        at.setdefault(r.text_crc32, set()).add(r.shard)
    assert sum(len(s) > 1 for s in at.values()) <= 2


def test_a_group_larger_than_a_shard(spark):
    """A third of all rows are one text: it fills whole shards, and sizes stay even."""
    rows = [(k, prose(k, 60)) for k in range(600)] + [(1000 + k, "same " * 90) for k in range(300)]
    placed = sharding.shard_documents(table(spark, rows), 8).collect()
    sizes = check(rows, placed, 8)
    assert max(sizes) - min(sizes) <= 0.03 * sum(sizes) / 8
    copies = [0] * 8
    for r in placed:
        copies[r.shard] += r.doc_id >= 1000
    assert sum(sorted(copies)[-4:]) >= 0.9 * 300
