"""Pipeline stages on tables with clashing columns, no rows, null ids, repeated rows and a very long text."""

import random

import pytest

import corpus_pipeline
from tests.llm import brute

ODD = ["_key", "_kid", "_copy", "_pcopies", "_psize0", "row", "id", "key", "kept_id", "kept_key", "size", "copies",
       "plan_id", "a.b", "_id", "text_hash"]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(
    f"`{c}` string" for c in ODD)
LATIN = {"en": "the and of to with that this from have not are for", "de": "der und das mit nicht ein ist auf dem sich"}


def sentence(rng, lang, n):
    return " ".join(rng.choice(LATIN[lang].split()) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    out = [(i, sentence(rng, lang, rng.randrange(20, 60)), lang, f"s{i % 3}")
           for i, lang in enumerate(["en", "de"] * 60)]
    out += [(200, out[0][1], "en", "s1"), (201, out[2][1] + " the", "en", "s2"), (None, out[4][1], "en", None),
            (None, sentence(rng, "de", 30), "de", "s1"), (3, out[3][1], "de", out[3][3]), (202, None, "en", "s1"),
            (203, "", "de", "s1"), (204, " 12 34 ", None, "s1"), (205, sentence(rng, "en", 600_000), "en", "s1")]
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t), *[f"{c} {k}" for c in ODD])
                                  for k, (i, t, lang, s) in enumerate(rows)], SCHEMA).repartition(3)


def reread(spark, tmp_path, name, df):
    df.write.parquet(str(tmp_path / name))
    return spark.read.parquet(str(tmp_path / name))


def test_stages_keep_odd_columns(spark, rows, tmp_path):
    docs = table(spark, rows)
    given = {tuple(r) for r in docs.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before = docs.collect()
        docs = reread(spark, tmp_path, str(k), stage(spark, docs, ""))
        assert docs.columns == table(spark, rows[:1]).columns, name
        after = [tuple(r) for r in docs.collect()]
        assert set(after) <= given, name
        if name == "exact dedup":
            assert len({brute.normalised(r["text"]) for r in before}) == len({brute.normalised(r[1]) for r in after})
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    assert len(packed) == docs.count() and any(r["n_tokens"] == 600_000 for r in packed)


def test_stages_on_an_empty_table(spark, rows, tmp_path):
    docs = table(spark, rows).limit(0)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = reread(spark, tmp_path, str(k), stage(spark, docs, ""))
        assert docs.count() == 0
