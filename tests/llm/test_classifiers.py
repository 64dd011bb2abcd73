"""Language and toxicity predictions against plain Python over the same model; long texts; samples."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reportflow.llm import language_id, linear, toxicity
from reportflow.llm.bytetext import buffers

WORDS = {"en": "the and of to with that this have not are for", "de": "der und das mit nicht ein ist auf dem sich",
         "fr": "le et les des avec une pour dans est sur", "es": "el los y con una para por como más del"}


def text_of(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang].split()) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    rows = [(i, text_of(rng, lang, rng.randrange(5, 40)), lang) for i, lang in enumerate(list(WORDS) * 40)]
    rows += [(900, None, "en"), (901, "12 34", None), (902, "", "de"), (903, "É", "fr"), (904, "Ω ω", None)]
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)


# ---- language ID ---------------------------------------------------------------------------------

def mapped(text):
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    return [b if 97 <= b <= 122 or b >= 128 else 32 for b in low]


def columns_of(text):
    x = mapped(text)
    out = []
    for i, c in enumerate(x):
        a, b = x[i - 1] if i else 32, x[i - 2] if i > 1 else 32
        two = ((c | a << 8) * 0x9E3779B1) & 0xFFFFFFFF
        three = ((c | a << 8 | b << 16) * 0x85EBCA6B) & 0xFFFFFFFF
        out += [c, language_id.ONE + (two >> 19), language_id.ONE + language_id.TWO + (three >> 18)]
    return out


def plain_language(model, text):
    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0
    columns = columns_of(text)
    margin = {t: sum(float(w[c]) for c in columns) / (len(columns) / 3) + b for t, (w, b) in model["tasks"].items()}
    families = sorted(model["families"])
    each = [margin[f"family:{f}"] for f in families]
    strong = [math.exp(2 * max(-8.0, min(8.0, m))) for m in each]
    family = families[each.index(max(each))]
    members = model["families"][family]
    votes, sums = [0.0] * len(members), [0.0] * len(members)
    for i in range(len(members)):
        for j in range(i + 1, len(members)):
            m = margin[f"pair:{members[i]}:{members[j]}"]
            votes[i if m >= 0 else j] += 1
            p = 1 / (1 + math.exp(-3 * m))
            sums[i] += p
            sums[j] += 1 - p
    ranks = [v + s / (len(members) + 1) for v, s in zip(votes, sums, strict=True)]
    best = ranks.index(max(ranks))
    inside = sums[best] / (len(members) - 1) if len(members) > 1 else 1.0
    return members[best], max(strong) / sum(strong) * inside


def test_language_of_every_text_in_plain_python(docs):
    rows, df = docs
    model = language_id.train(df.filter(~linear.held_out(F.col("doc_id"), 5, 0)), "doc_id", "text", "lang")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.apply_model(df, model).collect()}
    for i, text, _ in rows:
        want = plain_language(model, text)
        assert got[i][0] == want[0] and abs(got[i][1] - want[1]) < 1e-4, (i, text)


def test_features_of_long_texts_in_pieces(monkeypatch):
    rng = np.random.default_rng(1)
    texts = ["".join(map(chr, rng.integers(32, 300, int(n)))) for n in [0, 5, 700, 0, 3, 1, 250, 64, 128, 0]]
    data, off = buffers(pa.array(texts))
    whole = language_id.ngram_columns(data, off)
    want = [np.bincount(whole[:, off[i]:off[i + 1]].ravel(), minlength=language_id.WIDTH) for i in range(len(texts))]
    for size in (1, 2, 3, 64, 100, 1 << 20):
        monkeypatch.setattr(language_id, "PIECE", size)
        got = np.zeros((len(texts), language_id.WIDTH), np.int64)
        for of, starts, columns in language_id.pieces(data, off):
            for i, s, e in zip(of, starts, [*starts[1:], columns.shape[1]], strict=True):
                got[i] += np.bincount(columns[:, s:e].ravel(), minlength=language_id.WIDTH)
        assert (got == np.array(want)).all(), size


def test_a_very_long_text_is_identified(spark, docs):
    rng = random.Random(5)
    _, df = docs
    model = language_id.train(df, "doc_id", "text", "lang")
    long = text_of(rng, "de", 3_000_000)
    assert len(long) > 10 << 20
    out = language_id.apply_model(spark.createDataFrame([(1, long)], "doc_id bigint, text string"), model).first()
    assert out["lang_pred"] == "de" and out["score"] > 0.5


# ---- samples -----------------------------------------------------------------------------------------

def test_sample_bounds_rank_only_what_is_needed(spark):
    df = spark.range(60000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("l"), F.col("id") % 100)).alias("lang"), F.xxhash64("id").alias("key"))
    keys: dict = {}
    for r in df.collect():
        keys.setdefault(r["lang"], []).append(r["key"])
    got = linear.sample_bounds(df, "lang", "key", 50)
    assert got == {x: sorted(v)[min(50, len(v)) - 1] for x, v in keys.items()}
    same = spark.range(5000).select(F.lit("x").alias("lang"), F.lit(2 ** 62).alias("key"))      # equal keys
    assert linear.sample_bounds(same, "lang", "key", 50) == {"x": 2 ** 62}
    assert linear.sample_bounds(df.limit(0), "lang", "key", 50) == {}


# ---- toxicity ----------------------------------------------------------------------------------------

def grams(text):
    x = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    out = set()
    for i in range(len(x)):
        h = 0x9E37
        for n in range(1, 6):
            if i + n > len(x):
                break
            h = ((h ^ x[i + n - 1]) * 0x9E3779B1) & 0xFFFFFFFF
            h ^= h >> 15
            if n >= 3:
                out.add(((h * 0x85EBCA6B) & 0xFFFFFFFF) >> (32 - toxicity.WIDTH_BITS))
    return out


def test_toxicity_in_plain_python(spark):
    rng = random.Random(7)
    rows, marks = [], []
    for i in range(400):
        bad = i % 4 == 0
        rows.append((i, text_of(rng, "en", 20) + (" horrid vile " if bad else " kind ") + text_of(rng, "en", 5)))
        marks.append((i, int(bad)))
    rows += [(900, None), (901, ""), (902, "ab"), (903, "Horrid VILE horrid")]
    texts = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    labels = spark.createDataFrame(marks, "doc_id bigint, toxic int")
    got = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(texts, labels).collect()}
    # the same model, applied n-gram by n-gram
    keyed = texts.filter(~linear.held_out(F.col("doc_id"), 5, 0)).select(
        F.col("doc_id").alias("_id"), F.xxhash64(F.col("doc_id").cast("string"), F.lit(3)).alias("key"),
        F.coalesce("text", F.lit("")).alias("text"))
    learnt = labels.filter(~linear.held_out(F.col("doc_id"), 5, 0)).select(
        F.col("doc_id").alias("_lid"), "toxic", F.xxhash64(F.col("doc_id").cast("string"), F.lit(3)).alias("key"))
    model = toxicity.train(keyed, learnt)
    weight = dict(zip(model["kept"].tolist(), model["weights"].tolist(), strict=True))
    for i, text in rows:
        margin = model["bias"] + sum(weight.get(c, 0.0) for c in grams(text))
        assert abs(got[i] - 1 / (1 + math.exp(-(model["a"] * margin + model["b"])))) < 1e-9, (i, text)
    # every n-gram whose counts support its ratio is kept, no other
    training = [(t, m) for (i, t), (_, m) in zip(rows, marks, strict=False)
                if i in {r["_id"] for r in keyed.select("_id").collect()}]
    count = [{}, {}]
    for t, m in training:
        for c in grams(t):
            count[m][c] = count[m].get(c, 0) + 1
    n = [sum(m == k for _, m in training) for k in (0, 1)]
    kept = set()
    for c in count[0].keys() | count[1].keys():
        clean, bad = count[0].get(c, 0), count[1].get(c, 0)
        both = (clean + bad) / sum(n)
        error = math.sqrt(max(both * (1 - both), 1e-12) * (1 / n[0] + 1 / n[1]))
        if clean + bad >= 5 and abs(bad / n[1] - clean / n[0]) / error >= 4:
            kept.add(c)
    assert kept == set(model["kept"].tolist()) and len(kept) > 20


def test_columns_of_a_long_text_in_pieces(monkeypatch):
    rng = np.random.default_rng(4)
    data, off = buffers(pa.array(["".join(map(chr, rng.integers(97, 123, 5000)))]))
    whole = toxicity._distinct(data, off, None)[1]
    keep = np.full(toxicity.WIDTH, -1, np.int32)
    keep[whole[::3]] = np.arange(len(whole[::3]))
    some = toxicity._distinct(data, off, keep)[1]
    monkeypatch.setattr(toxicity, "PIECE", 700)
    doc, col = toxicity._distinct(data, off, None)
    assert (col == whole).all() and not doc.any()
    assert (toxicity._distinct(data, off, keep)[1] == some).all()


def test_toxicity_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id bigint, toxic int")
    assert toxicity.score_toxicity(empty, labels).collect() == []
