"""The registered queries on whole small tables, against their SQL or brute force."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from reportflow.llm.queries import ORACLES, QUERIES
from tests.llm import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in ("documents", "labels", "embeddings", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def docs(con):
    return con.sql("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


def result(spark, name, key="doc_id"):
    rows = QUERIES[name](spark, SF).collect()
    return {r[key]: r for r in rows}, rows


def test_every_operator_is_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) <= set(names) and "pipeline" in names
    assert set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, con, name):
    want = con.sql(ORACLES[name]).df()
    got = QUERIES[name](spark, SF).toPandas()[list(want.columns)]
    keys = list(want.columns)
    def plain(v):           # pandas has several nulls, and makes longs with nulls doubles
        if pd.isna(v):
            return ""
        return str(int(v)) if isinstance(v, float) and v.is_integer() else str(v)

    got, want = (x.map(plain).sort_values(keys, ignore_index=True) for x in (got, want))
    assert got.equals(want)


def test_language_id_and_toxicity(spark, con, docs):
    by_id, rows = result(spark, "op1_language_id")
    lang = dict(con.sql("SELECT doc_id, lang FROM documents").fetchall())
    assert len(rows) == len(docs)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.9 * len(held)
    _, rows = result(spark, "op2_toxicity")
    assert len(rows) == len(docs)
    assert all(r["predicted"] == int(r["score"] >= 0.5) for r in rows)


def test_repeated_passages(spark, docs):
    by_id, _ = result(spark, "op4_repeated_passages")
    want = brute.removed(docs)
    assert {i: tuple(r)[1:] for i, r in by_id.items()} == want


def test_ngram_join(spark, docs):
    by_id, _ = result(spark, "op5_ngram_join")
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in by_id.items()} == brute.near_components(docs)


def test_packing(spark, docs):
    by_id, rows = result(spark, "op6_packing")
    assert len(rows) == len(docs)
    assert {i: r["n_tokens"] for i, r in by_id.items()} == {i: len(brute.WORD.findall(t or "")) for i, t in docs}


def test_embeddings(spark, con):
    rows = con.sql("SELECT vec_id, embedding, label FROM embeddings").fetchall()
    by_id, _ = result(spark, "op7_embedding_dedup", "vec_id")
    assert {i: (r["n_links"], r["component_id"]) for i, r in by_id.items()} == brute.cosine_links(
        [(i, list(v), label) for i, v, label in rows])


def test_language_model(spark, docs):
    by_id, _ = result(spark, "op9_lm_scoring")
    for i, (held, n, known, total, base, score) in brute.lm_scores(docs).items():
        r = by_id[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n, known, total)
        assert abs(r["base_score"] - base) < 1e-6 and abs(r["score"] - score) <= 0.00051 * n


def test_personal_data(spark, docs):
    import hashlib
    by_id, _ = result(spark, "op10_personal_data")
    for i, t in docs:
        want = brute.base_spans(t)
        assert by_id[i]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert by_id[i]["spans"] == want or by_id[i]["spans"].startswith(want + "," if want else "term:")


def test_pipeline_stages(spark, docs, tmp_path):
    import corpus_pipeline
    table = spark.read.parquet(f"{SF}/documents.parquet")
    columns, texts = table.columns, dict(docs)
    seen = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, table, SF).write.parquet(str(tmp_path / str(k)))
        table = spark.read.parquet(str(tmp_path / str(k)))
        seen.append([r["doc_id"] for r in table.collect()])
        if k < len(corpus_pipeline.STAGES) - 1:
            assert table.columns == columns
    language, exact, near, mixed, packed = seen
    assert set(language) == {i for i, t in texts.items() if any(c.isalpha() for c in t or "")}
    first = {}
    for i in sorted(language):
        first.setdefault(brute.normalised(texts[i]), i)
    assert sorted(exact) == sorted(first.values())
    groups = brute.near_components([(i, texts[i]) for i in exact])
    assert sorted(near) == sorted({g for _, g in groups.values()})
    assert set(mixed) <= set(near) and max(mixed.count(i) for i in set(mixed)) <= 2
    size = {i: len(brute.WORD.findall(texts[i])) for i in near}
    assert abs(sum(size[i] for i in mixed) - 1.5 * sum(size.values())) <= 2 * max(size.values())
    assert sorted(packed) == sorted(mixed)
