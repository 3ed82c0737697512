"""Shards as files."""

from marketvane.llm import sharding
from tests.llm.test_operators import SCHEMA, corpus


def test_shards_are_files(spark, tmp_path):
    given = [*corpus(), corpus()[8], (None, "text without id", *corpus()[8][2:])]
    docs = spark.createDataFrame(given, SCHEMA)
    sharding.write_shards(docs, f"{tmp_path}/shards", limit=3000)
    folders = [p for p in (tmp_path / "shards").iterdir() if p.is_dir()]
    assert len(folders) > 2 and all(len(list(p.glob("*.parquet"))) == 1 for p in folders)
    back = spark.read.parquet(f"{tmp_path}/shards").collect()
    assert sorted(map(repr, (tuple(r)[:-1] for r in back))) == sorted(map(repr, given))
    held = {}
    for r in back:
        held.setdefault(r["shard"], []).append(len((r["text"] or "").encode()))
    want = {"s" + r["shard"] for r in sharding.assign_shards(docs, limit=3000).collect()}
    assert set(held) == want and all(sum(x) <= 3000 or len(x) == 1 for x in held.values())
