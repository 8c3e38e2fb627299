"""The corpus pipeline's stages, each against what it must do to its own input."""

import hashlib

import corpus_pipeline as cp

from barkline.llm import ngram_join, secrets


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, [docs]
    for k, (name, stage) in enumerate(cp.STAGES):
        stage(spark, seen[-1], sf_dir).write.parquet(f"{tmp_path}/{k}")
        seen.append(spark.read.parquet(f"{tmp_path}/{k}"))
        if k < len(cp.STAGES) - 1:
            assert seen[-1].columns == columns, name
    plain, single, clean, mixed, coded = [x.collect() for x in seen[1:]]
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in plain}
    assert sum(labels[i] == 0 for i in kept if i in labels) > 0.9 * sum(v == 0 for v in labels.values())
    comp = {r["doc_id"]: r["component_id"] for r in ngram_join.jaccard_components(seen[1]).collect()}
    assert {r["doc_id"] for r in single} == set(comp.values()) and len(single) == len(set(comp.values()))
    assert {r["doc_id"] for r in clean} == {r["doc_id"] for r in single}
    assert all(not [s for s in secrets.scan(r["text"]) if s[2] == "access"] for r in clean)
    by_id = {r["doc_id"]: r["text"] for r in mixed}
    assert len(coded) == len(mixed) and len(mixed) > 0
    assert all(r["decoded_sha256"] == hashlib.sha256(by_id[r["doc_id"]].encode()).hexdigest() for r in coded)


def test_null_and_repeated_ids(spark):
    rows = [(None, "a b c d e"), (None, "a b c d e"), (4, "p q r s t u"), (4, "p q r s t u"), (5, "P q r s t u"), (6, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = cp.jaccard_stage(spark, docs, "").collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in got) == [(0, "a b c d e"), (4, "p q r s t u"), (6, "")]


def test_near_copies_without_ids(spark):
    words = [f"w{k}" for k in range(120)]
    one, two = " ".join(words[:60]), " ".join(words[60:])
    rows = [(None, one + " x"), (None, one + " y"), (3, two), (None, two + " x"), (None, None), (None, None), (None, " \t"), (7, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = cp.jaccard_stage(spark, docs, "")
    assert got.schema == docs.schema
    left = sorted((r["doc_id"] or 0, r["text"] or "") for r in got.collect())
    assert left in ([(0, ""), (0, ""), (0, " \t"), (0, one + end), (3, two), (7, "")] for end in (" x", " y"))


def test_extra_columns_stay(spark):
    """Columns named like an operator's own and map columns go through each stage but the last."""
    row = (5, "word " * 30, "en", "s", 150, 7, 8.0, 9, {"a": 1})
    schema = "doc_id long, text string, lang string, source string, n_chars long, size long, target double, copies long, `m.x` map<string, int>"
    docs = spark.createDataFrame([row, row, (6, "other " * 30, "en", "t", 180, 1, 2.0, 3, None), (None, None, None, None, None, None, None, None, {"b": 2})], schema)
    single = cp.jaccard_stage(spark, docs, "")
    assert single.schema == docs.schema
    assert sorted((r["doc_id"] or 0, r["size"] or 0, r["copies"] or 0, r["m.x"] or {}) for r in single.collect()) == [(0, 0, 0, {"b": 2}), (5, 7, 9, {"a": 1}), (6, 1, 3, {})]
    clean = cp.secrets_stage(spark, docs, "")
    assert clean.columns == docs.columns and clean.count() == 4
    mixed = cp.mixing_stage(spark, docs, "")
    assert mixed.schema == docs.schema
    assert {(r["doc_id"], r["size"], r["target"], r["copies"]) for r in mixed.collect()} <= {(5, 7, 8.0, 9), (6, 1, 2.0, 3), (None, None, None, None)} and mixed.count() >= 2


def test_empty_table_and_a_long_text(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    none = spark.createDataFrame([], schema)
    long = spark.createDataFrame([(1, "p q r s t u " * 100_000, "en", "s", 5), (2, "", "en", "s", 0)], schema)
    for name, stage in cp.STAGES[1:]:
        assert stage(spark, none, "").count() == 0, name
        assert {r["doc_id"] for r in stage(spark, long, "").collect()} <= {1, 2}, name
    assert cp.secrets_stage(spark, long, "").where("doc_id = 1").first()["text"] == "p q r s t u " * 100_000


def test_pipelines_side_by_side(spark):
    """Threads drop what their own stages have staged, not each other's."""
    from concurrent.futures import ThreadPoolExecutor

    schema = "doc_id long, text string, lang string, source string, n_chars long"

    def one(k):
        docs = spark.createDataFrame([(k * 100 + i, f"text number {i} of run {k} has words of its own {i * k}", "en", "s", 5) for i in range(8)], schema)
        for _, stage in cp.STAGES[1:3]:
            docs = stage(spark, docs, "")
        return {r["doc_id"] for r in docs.collect()}

    with ThreadPoolExecutor(2) as pool:
        assert list(pool.map(one, (1, 2))) == [{k * 100 + i for i in range(8)} for k in (1, 2)]
