"""Shards against sums in plain Python."""

import zlib

from tabloom.llm.sharding import balanced_shards, write_shards


def plain(rows, shards):
    made = sorted(((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))
    total, before, slots, out = sum(r[1] for r in made), 0, {}, []
    for d, size, crc in made:
        shard = min(shards - 1, (2 * before + size) * shards // (2 * total))
        out.append((d, size, crc, "bytes", shard, slots.setdefault(shard, 0), None))
        slots[shard] += 1
        before += size
    return out


def test_shards_match_plain_sums(spark, docs_of):
    rows = [(k * 7 % 101, "é" * (k % 13) + "x" * (k * k % 57)) for k in range(101)] + [(None, None), (3, "dup"), (3, "dup"), (50, "y" * 3000), (51, "")]
    for shards in (8, 3, 1):
        got = balanced_shards(docs_of(rows), shards)
        assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
        assert sorted(map(tuple, got.collect()), key=lambda r: (r[4], r[5])) == plain(rows, shards)


def test_shards_are_near_equal(spark, docs_of):
    rows = [(k, "word " * (k % 29)) for k in range(4000)]
    sizes = {}
    for r in balanced_shards(docs_of(rows), 8).collect():
        sizes[r.shard] = sizes.get(r.shard, 0) + r.size
    assert len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) <= 2 * max(len(t) + 1 for _, t in rows)


def test_empty_few_and_files(spark, docs_of, tmp_path):
    assert balanced_shards(docs_of([])).count() == 0
    assert [r.slot for r in balanced_shards(docs_of([(1, "a")])).collect()] == [0]
    write_shards(docs_of([(k, f"text {k}") for k in range(64)]), str(tmp_path / "s"), 4)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted((r.doc_id, r.text) for r in back.collect()) == sorted((k, f"text {k}") for k in range(64))
    assert {r.shard for r in back.select("shard").distinct().collect()} == {0, 1, 2, 3}
