import corpus_pipeline as P
from seqloom.llm import crf_toxicity, mixing
from tests.llm.conftest import EDGE_ROWS, make_docs, prose
from tests.llm.test_shingle_copies import slow_components

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = docs
    for name, stage in P.STAGES[:3]:
        before, kept = kept, stage(spark, kept, SF).cache()
        assert kept.columns == docs.columns, name
        if name == "toxicity":
            score = crf_toxicity.scorer(crf_toxicity.fit(before, labels), spark)
            want = {r["doc_id"] for r in before.select("doc_id", score("text").alias("t")).filter("t.score < 0.5").collect()}
            assert {r["doc_id"] for r in kept.collect()} == want and len(want) < before.count()
        elif name == "simhash_near_dedup":
            rows = before.select("doc_id", "text").orderBy("doc_id").collect()
            roots = slow_components([r["text"] for r in rows])
            assert sorted(r["doc_id"] for r in kept.collect()) == [rows[k]["doc_id"] for k in sorted(set(roots))]
        else:
            want = {r["doc_id"]: r["copies"] for r in mixing.mixed(before).collect() if r["copies"]}
            assert {r["doc_id"]: r["count"] for r in kept.groupBy("doc_id").count().collect()} == want
    packed = P.STAGES[3][1](spark, kept, SF).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in kept.collect()}
    fill = {}
    for r in packed:
        fill[r["sequence_id"]] = fill.get(r["sequence_id"], 0) + r["length"]
    assert max(fill.values()) <= 2048 and len(fill) <= sum(fill.values()) / 2048 * 1.02 + 1


def test_run_gives_the_last_stage(spark):
    out = P.run(spark, SF)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 0


def test_stages_on_an_empty_table(spark, no_docs):
    docs = no_docs
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
    assert make_docs(spark, []).count() == 0


def test_odd_rows_go_through_all_stages(spark):
    """Nulls, empty, long, tied and repeated rows and clashing columns, from end to end."""
    rows = [*EDGE_ROWS, (20, prose(5, 300), "en", "s1"), (21, prose(5, 300) + " end", "en", "s1"), (22, prose(6, 40), None, None), (22, prose(7, 40), "en", "s9")]
    docs = make_docs(spark, rows)
    kept = docs
    for _, stage in P.STAGES[:2]:
        kept = stage(spark, kept, SF).cache()
        assert kept.columns == docs.columns
    left = [r["doc_id"] for r in kept.collect()]
    assert sorted(x for x in left if x is not None) == [1, 4, 5, 6, 8, 20, 22] and left.count(None) == 2
    mixed = P.mix_sources(spark, kept, SF).cache()
    assert mixed.columns == docs.columns and {r["doc_id"] for r in mixed.collect()} <= set(left)
    packed = P.pack_sequences(spark, mixed, SF).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in mixed.collect()}
    places = {}
    for r in packed:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in places.values():
        assert [a for a, _ in sorted(own)] == [sum(n for _, n in sorted(own)[:k]) for k in range(len(own))]
