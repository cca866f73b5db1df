"""The stages in a row, each against a plain version of its decision."""

import zlib

import corpus_pipeline
from tabloom.llm import queries


def test_stages_and_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mix", "token_ids"]
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))


def test_planted_cases_on_the_small_tables(spark, tmp_path):
    from tests.llm.test_mix import size_of
    from tests.llm.test_simhash import plain_components

    source = "/root/testdata/sf0.001"
    item = spark.read.parquet(f"{source}/benchmark.parquet").first()
    docs = spark.read.parquet(f"{source}/documents.parquet")
    words = " ".join(f"w{k * k % 97}" for k in range(80))
    planted = spark.createDataFrame(
        [(10**6, words + " one", "en", "p", 1), (10**6 + 1, words + " one", "en", "q", 1), (10**6 + 2, "before " + item.text + " after", "en", "p", 1), (10**6 + 3, None, "en", None, 0)], docs.schema)
    folder = str(tmp_path / "t")
    docs.union(planted).write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{source}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    # names that stages use themselves must pass through unchanged
    frame, seen = spark.read.parquet(f"{folder}/documents.parquet").selectExpr("*", "n_chars AS _toxicity", "source AS _k", "n_chars AS _h", "lang AS fp"), {}
    names = frame.columns
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in frame.collect()]
        out = stage(spark, frame, folder)
        if name == "token_ids":
            got = out.collect()
            assert len(got) == len(before) and sum(r.n_tokens for r in got) == max(r.start + r.n_tokens for r in got)
            break
        assert out.columns == names
        path = str(tmp_path / name)
        out.write.parquet(path)
        frame = spark.read.parquet(path)
        seen[name] = [r.doc_id for r in frame.collect()]
        if name == "near_duplicates":
            assert sorted(seen[name]) == sorted(d for d, _, c in plain_components(before) if d == c)
        if name == "mix":
            assert set(seen[name]) <= {d for d, _ in before} and max(seen[name].count(d) for d in set(seen[name])) <= 2
            total = sum(size_of(t) for _, t in before)
            assert abs(sum(size_of(r.text) for r in frame.collect()) - 1.5 * total) < 0.1 * total
    assert 10**6 in seen["near_duplicates"] and 10**6 + 1 not in seen["near_duplicates"]
    assert 10**6 + 2 in seen["near_duplicates"] and 10**6 + 2 not in seen["decontamination"]
    crc = {r.doc_id: r.ids_crc32 for r in got}
    assert 10**6 + 3 not in crc or crc[10**6 + 3] == zlib.crc32(b"\x02\0\0\0")
    assert corpus_pipeline.run(spark, folder).count() == len(got)
