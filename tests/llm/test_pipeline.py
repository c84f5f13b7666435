import corpus_pipeline
from test_llm import docs_of, edited, prose


def test_each_stage_acts_and_columns_stay(spark, tmp_path):
    base = prose(1, 150)
    rows = [(i, prose(100 + i, 80, 3000) + (" venomous wretch" if i % 4 == 0 else ""), f"s{i % 3}") for i in range(120)]
    rows += [(200, base, "s0"), (201, base.replace(" ", "\n"), "s0"), (202, edited(base, 3, 2), "s1"), (203, None, None)]
    docs_of(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, int(i % 4 == 0)) for i in range(120)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = [{r[0] for r in rows}]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept.append({r["doc_id"] for r in docs.select("doc_id").collect()})
    toxic = {i for i in range(0, 120, 4)}
    assert len(kept[0] - kept[1] - toxic) <= 3 and len(toxic & kept[1]) <= 3
    assert kept[1] - kept[2] == {201} and kept[2] - kept[3] == {202} and kept[3] == kept[4] == kept[5]
    run = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(tuple, run.select("doc_id", "start", "length", "ids_crc32").collect())) == sorted(map(tuple, docs.select("doc_id", "start", "length", "ids_crc32").collect()))


def test_packing_stage_goes_by_the_mix(spark, tmp_path):
    rows = [(i, f"{'ab'[i % 2]} " * 40, "ab"[i % 2]) for i in range(8000)]
    pieces = corpus_pipeline.packing_stage(spark, docs_of(spark, rows), str(tmp_path)).collect()
    half = max(p["sequence_id"] for p in pieces) / 2
    held = [sum(p["length"] for p in pieces if p["sequence_id"] < half and p["doc_id"] % 2 == k) for k in (0, 1)]
    assert 0.4 < held[0] / sum(held) < 0.6


def test_near_dedup_stage_goes_by_five_words(spark, tmp_path):
    base = [f"w{i}" for i in range(91)]
    other = list(base)
    other[20] = other[50] = "new"  # 80 of 96 shingles of 4 words are shared, 77 of 97 of 5 words
    docs = docs_of(spark, [(1, " ".join(base)), (2, " ".join(other)), (3, " ".join(base[:-1]))])
    assert {r["doc_id"] for r in corpus_pipeline.near_dedup_stage(spark, docs, str(tmp_path)).collect()} == {1, 2}


def test_the_mixing_stage_reaches_the_sequences(spark, tmp_path):
    import random

    texts = ["one two three four", "rot blau gelb", "uno dos tres cuatro"]  # a source's texts are neighbours on the curve
    rows = [(i, texts[i % 3] * 9, "abc"[i % 3]) for i in range(6000)]
    random.Random(1).shuffle(rows)
    docs_of(spark, rows).sort("source").coalesce(3).write.parquet(f"{tmp_path}/documents")
    plain = spark.read.parquet(f"{tmp_path}/documents")
    corpus_pipeline.mixing_stage(spark, plain, str(tmp_path)).write.parquet(f"{tmp_path}/mixed")
    source = {r[0]: r[2] for r in rows}

    def first_sequences(docs):
        pieces = corpus_pipeline.packing_stage(spark, docs, str(tmp_path)).collect()
        some = [p for p in pieces if p["sequence_id"] < max(q["sequence_id"] for q in pieces) / 4]
        held = {k: sum(p["length"] for p in some if source[p["doc_id"]] == k) for k in "abc"}
        return {k: v / sum(held.values()) for k, v in held.items()}, sorted((p["doc_id"], p["sequence_id"], p["offset"]) for p in pieces)

    without, before = first_sequences(plain)
    mixed, after = first_sequences(spark.read.parquet(f"{tmp_path}/mixed"))
    assert max(without.values()) > 0.9 and all(0.2 < v < 0.5 for v in mixed.values()) and before != after
