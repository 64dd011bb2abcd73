"""Operators against brute force, with nulls, empty and long texts, ties, repeats and odd columns."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reportflow.llm import embedding_dedup, exact_dedup, language_id, language_model, mixing
from reportflow.llm import ngram_join, packing, personal_data, repeated_passages, toxicity
from tests.llm import brute

# Extra columns with names that operators use inside.
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, _id string, size int, "
          "kind string, n int, doc int, tie int, sid int, name string, rep int, _key string, key int")


def frame(spark, rows):
    full = [(i, t, lang, src, None if t is None else len(t), "x", 1, "k", 2, 3, 4, 5, "n", 6, "y", 7)
            for i, t, lang, src in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    passage, line = words(rng, 60), words(rng, 14)
    rows = []
    for i in range(60):
        rows.append((i, words(rng, rng.choice([1, 3, 4, 5, 6, 12, 30, 120])), "en", f"s{i % 4}"))
    for i in range(60, 90):
        text = rows[i - 40][1].split(" ")
        if len(text) > 20:
            text[rng.randrange(len(text))] = "Changed"
        rows.append((i, "  ".join(text), "de", "s9"))
    for i in range(90, 110):
        rows.append((i, f"{words(rng, 20)} {passage} {words(rng, 25)}\n{line}", None, None))
    rows += [(110, None, "en", "s1"), (111, "", "en", None), (112, " \t\n", "fr", "s1"), (113, "a", "en", "s1"),
             (114, "é" * 150, "fr", "s2"), (115, "A" * 400, "en", "s2"), (116, "a" * 300, "en", "s2"),
             (117, words(rng, 6000), "en", "s3"), (118, rows[20][1].upper(), "en", "s3")]
    return rows


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_exact_duplicates(spark, corpus):
    got = by_id(exact_dedup.exact_duplicates(frame(spark, corpus), average=64), "keep_id", "group_size", "text_sha256")
    import hashlib
    first, size = {}, {}
    for i, t, *_ in corpus:
        x = brute.normalised(t)
        first[x] = min(first.get(x, i), i)
        size[x] = size.get(x, 0) + 1
    for i, t, *_ in corpus:
        x = brute.normalised(t)
        assert got[i] == (first[x], size[x], hashlib.sha256(x.encode()).hexdigest())


def test_exact_duplicates_with_clashing_fingerprints(spark, corpus):
    full = by_id(exact_dedup.exact_duplicates(frame(spark, corpus), average=64), "keep_id", "group_size")
    short = by_id(exact_dedup.exact_duplicates(frame(spark, corpus), average=64, fingerprint_bytes=1),
                  "keep_id", "group_size")
    assert short == full


def test_chunk_ends_follow_content():
    from reportflow.llm.bytetext import buffers
    import pyarrow as pa
    rng = random.Random(1)
    common = words(rng, 900)
    data, off = buffers(pa.array(["x " + common, words(rng, 50) + common]))
    ends = exact_dedup.chunk_ends(data, off, 64)
    raw = data.tobytes()
    starts = [0, *ends[:-1]]
    chunks = [[raw[a:b] for a, b in zip(starts, ends, strict=True) if off[i] <= a < off[i + 1]] for i in (0, 1)]
    assert len(set(chunks[0]) & set(chunks[1])) > 0.8 * len(chunks[0])
    assert all(b"".join(c) == raw[off[i]:off[i + 1]] for i, c in enumerate(chunks))


def test_near_duplicates(spark, corpus):
    want = brute.near_components([(i, t) for i, t, *_ in corpus])
    got = by_id(ngram_join.near_duplicates(frame(spark, corpus)), "n_shingles", "component_id")
    assert got == want


@pytest.mark.parametrize("limit", [2, 64])
def test_near_duplicates_long_lists_and_light_sets(spark, monkeypatch, limit):
    monkeypatch.setattr(ngram_join, "LONG", limit)
    rng = random.Random(limit)
    base = [words(rng, n, 60).split(" ") for n in (7, 8, 9, 12, 30, 60, 60)]
    rows = []
    for i in range(140):
        text = list(base[i % len(base)])
        for _ in range(rng.randrange(3)):
            text[rng.randrange(len(text))] = f"z{rng.randrange(5)}"
        rows.append((i, " ".join(text), "en", "s"))
    got = by_id(ngram_join.near_duplicates(frame(spark, rows)), "n_shingles", "component_id")
    assert got == brute.near_components([(i, t) for i, t, *_ in rows])


def test_near_duplicates_list_long_in_one_chunk_only(spark):
    """Every key that the two parts share is long in the first, where its smallest set links with none of them."""
    shared = [f"w{k}" for k in range(99)]

    def own(name):
        return [f"{name}x{k}" for k in range(5)]

    many = [(i, " ".join(shared + own(f"a{i}")), "en", "s") for i in range(100)]
    for i in range(20):                 # the middle of the shared words is less rare than both ends
        many += [(200 + i, " ".join(shared[:74] + own(f"d{i}")), "en", "s"),
                 (250 + i, " ".join(shared[25:] + own(f"e{i}")), "en", "s")]
    few = [(300 + i, " ".join(shared + own(f"b{i}")), "en", "s") for i in range(3)]
    docs = frame(spark, many).coalesce(1).union(frame(spark, few))
    got = by_id(ngram_join.near_duplicates(docs), "n_shingles", "component_id")
    assert got == brute.near_components([(i, t) for i, t, *_ in many + few])
    assert got[300][1] == 0 and got[200][1] == 200


def test_light_boundary_prefers_subsets_when_lists_are_long():
    histogram = {s: 10 for s in range(1, 65)}
    short = ngram_join.light_boundary(histogram, np.full(1000, 6, np.uint8), 75)
    uneven = np.full(1000, 6, np.uint8)
    uneven[:400] = 60
    assert ngram_join.light_boundary(histogram, uneven, 75) >= short
    assert ngram_join.light_boundary({}, np.zeros(1000, np.uint8), 75) == 0


def test_repeated_passages(spark, corpus):
    want = brute.removed([(i, t) for i, t, *_ in corpus])
    out = repeated_passages.repeated_passages(frame(spark, corpus)).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").alias("n_spans"), "kept_sha256")
    assert by_id(out, "n_bytes", "n_removed", "n_spans", "kept_sha256") == want


def test_repeated_passages_common_anchors_and_pieces(spark, corpus, monkeypatch):
    monkeypatch.setattr(repeated_passages, "MANY_LOCAL", 1)
    monkeypatch.setattr(repeated_passages, "PIECE", 700)
    want = brute.removed([(i, t) for i, t, *_ in corpus])
    out = repeated_passages.repeated_passages(frame(spark, corpus)).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").alias("n_spans"), "kept_sha256")
    assert by_id(out, "n_bytes", "n_removed", "n_spans", "kept_sha256") == want


def test_longest_previous_factors_match_definition():
    rng = np.random.default_rng(3)
    text = rng.integers(97, 99, 300).astype(np.uint8)
    depth = 12
    strings = np.lib.stride_tricks.sliding_window_view(text, depth)
    order, common = repeated_passages.suffix_order(strings)
    got = np.empty(len(order), int)
    got[order] = repeated_passages.longest_previous_factors(order, common)
    raw = text.tobytes()
    for i in range(len(strings)):
        longest = max((k for k in range(depth + 1) for j in range(i) if raw[j:j + k] == raw[i:i + k]), default=0)
        assert got[i] == longest


def test_mixing_targets_and_copies(spark, corpus):
    rows = [*corpus, corpus[5], corpus[5]]               # equal rows are documents of their own
    out = mixing.mix_sources(frame(spark, rows)).collect()
    assert len(out) == len(rows)
    sizes = {i: len(brute.WORD.findall(t or "")) for i, t, *_ in rows}
    total, targets, taken = sum(sizes[r[0]] for r in rows), {}, {}
    for r in out:
        assert r["size"] == sizes[r["doc_id"]] and r["taken"] in (0, r["size"], 2 * r["size"])
        targets[r["source"]] = (r["target"], r["source_size"])
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    assert abs(sum(t for t, _ in targets.values()) - 1.5 * total) < 1e-6 * total
    for source, (target, size) in targets.items():
        assert target <= 2 * size + 1e-9
        biggest = max(sizes[r["doc_id"]] for r in out if r["source"] == source)
        assert abs(taken[source] - target) <= 2 * biggest
    again = mixing.mix_sources(frame(spark, rows)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    mixed = mixing.mixed_documents(frame(spark, corpus))
    assert mixed.columns == frame(spark, corpus).columns
    assert mixed.count() == sum(r["copies"] for r in mixing.mix_sources(frame(spark, corpus)).collect())


def test_packing_is_optimal_and_complete(spark, corpus):
    out = packing.pack_documents(frame(spark, corpus), buckets=4, budget=500).collect()
    assert len(out) == len(corpus)
    lengths = sorted(len(brute.WORD.findall(t or "")) for _, t, *_ in corpus)
    assert sum(r["padding"] for r in out) == _least_padding(lengths, 4)
    batches = {}
    for r in out:
        assert r["padding"] == r["bucket_len"] - r["n_tokens"] >= 0
        batches.setdefault((r["bucket"], r["batch"]), []).append(r)
    for rows in batches.values():
        assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
        assert len(rows) == 1 or len(rows) * rows[0]["bucket_len"] <= 500
    last = {}
    for (bucket, batch), rows in batches.items():
        last.setdefault(bucket, {})[batch] = len(rows)
    for sizes in last.values():                           # all batches but the last are full
        full = [sizes[b] for b in sorted(sizes)[:-1]]
        assert sorted(sizes) == list(range(len(sizes))) and len(set(full)) <= 1


def _least_padding(lengths, buckets):
    edges = sorted(set(lengths))
    cost = {(i, j): sum(edges[j] - x for x in lengths if (edges[i - 1] if i else -1) < x <= edges[j])
            for i in range(len(edges)) for j in range(i, len(edges))}
    best = [cost[0, j] for j in range(len(edges))]
    for _ in range(buckets - 1):
        best = [min([best[j], *(best[i - 1] + cost[i, j] for i in range(1, j + 1))]) for j in range(len(edges))]
    return best[-1]


@pytest.mark.parametrize("seed", range(6))
def test_boundaries_equal_plain_dynamic_programming(seed):
    rng = random.Random(seed)
    lengths = sorted(rng.randrange(1, 60) ** 2 % 97 for _ in range(80))
    edges = np.array(sorted(set(lengths)))
    counts = np.array([lengths.count(e) for e in edges])
    for buckets in (1, 2, 3, 7, 200):
        cuts = packing.choose_boundaries(edges, counts, buckets)
        got = sum(min(c for c in cuts if c >= x) - x for x in lengths)
        assert len(cuts) <= buckets and got == _least_padding(lengths, buckets)


def test_language_model(spark, corpus):
    want = brute.lm_scores([(i, t) for i, t, *_ in corpus])
    out = by_id(language_model.score_texts(frame(spark, corpus)), "held_out", "n_tokens", "n_known",
                "train_tokens", "base_score", "score")
    for i, (held, n, known, total, base, score) in want.items():
        assert out[i][:4] == (held, n, known, total)
        assert abs(out[i][4] - base) < 1e-6
        assert abs(out[i][5] - score) <= 0.00051 * n


def test_elias_fano_and_trie():
    from reportflow.llm.eliasfano import EliasFano, Trie, mapped
    rng = np.random.default_rng(5)
    for n, universe in ((0, 10), (1, 1), (500, 3000), (500, 1 << 60), (300, 20)):
        values = np.sort(rng.integers(0, universe, n, dtype=np.uint64)) if n else np.zeros(0, np.uint64)
        ef = EliasFano(mapped(EliasFano.encode(values, universe)))
        assert (ef.access(np.arange(n)) == values).all()
        probe = rng.integers(0, universe, 200, dtype=np.uint64)
        assert (ef.successor(probe) == np.searchsorted(values, probe)).all()
    keys = np.unique(rng.integers(0, 40, 900, dtype=np.uint64) << np.uint64(32)
                     | rng.integers(0, 1 << 32, 900, dtype=np.uint64))
    codes = rng.integers(1, 999, len(keys)).astype(np.uint16)
    trie = Trie(mapped(Trie.build(keys, codes)))
    assert (trie.look_up(keys) == codes).all()
    other = np.setdiff1d(keys ^ np.uint64(1), keys)
    assert not trie.look_up(other).any()
    assert not Trie(mapped(Trie.build(keys[:0], codes[:0]))).look_up(keys).any()


def test_embeddings(spark):
    rng = np.random.default_rng(8)
    rows, centre = [], rng.normal(size=(6, 16))
    for i in range(150):
        v = centre[i % 6] + rng.normal(size=16) * rng.choice([0.05, 0.2, 0.4])
        rows.append((i, [float(np.float32(x)) for x in v], int(i % 6 % 2)))
    rows += [(200 + k, rows[3][1], 1) for k in range(20)]
    rows += [(300, None, 1), (301, [0.0] * 16, 1), (302, [float("nan")] * 16, 1), (303, [float("inf")] * 16, 1),
             (304, [None] * 16, 1), (305, rows[3][1], None), (306, [], 1), (307, rows[3][1][:8], 1),
             (308, [2 * x for x in rows[3][1]], 1)]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows],
                               "vec_id bigint, embedding array<float>, label int, rep string, home int, cell int")
    want = brute.cosine_links(rows)
    for cell_rows in (1024, 8):
        out = embedding_dedup.near_duplicates(df, cell_rows=cell_rows).collect()
        got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in out}
        assert got == want
        assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in out)


def test_wide_vectors_of_low_rank_lose_no_link_at_cell_borders(spark):
    rng = np.random.default_rng(12)
    basis = rng.normal(size=(6, 768))
    rows = [(i, [float(x) for x in rng.normal(size=6) @ basis], 1) for i in range(1500)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    unit = np.array([r[1] for r in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    want = ((unit @ unit.T) >= 0.93).sum(1) - 1
    got = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_duplicates(df, cell_rows=8).collect()}
    assert [got[i] for i in range(1500)] == want.tolist() and want.sum() > 1000


def test_estimates_hold_their_bounds():
    rng = np.random.default_rng(2)
    a = rng.normal(size=(400, 64))
    b = a + rng.normal(size=a.shape) * 0.3
    a, b = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (a, b))
    turned, codes, factor = embedding_dedup.encode(a, embedding_dedup.rotation(64))
    query = (b @ embedding_dedup.rotation(64)).astype(np.float32)
    exact = (a * b).sum(1)
    estimate = (codes * query).sum(1) / 8 / factor
    error = np.sqrt(1 - factor ** 2) / factor / np.sqrt(63)
    assert abs((estimate - exact).mean()) < 0.01                       # unbiased
    assert (np.abs(estimate - exact) <= 4 * error).mean() > 0.995
    i, j = embedding_dedup.likely_pairs(codes, factor, query, 0.9, 4.0)
    found = set(zip(i.tolist(), j.tolist(), strict=True))
    wanted = [(int(x), int(y)) for x, y in zip(*np.nonzero(a @ b.T >= 0.9), strict=True)]
    assert wanted and sum(p in found for p in wanted) >= 0.99 * len(wanted)


LATIN = {"en": "the and of to with that", "de": "der und das mit nicht ein", "fr": "le et les des avec une",
         "es": "el los y con una para"}


def language_rows(n=400):
    rng = random.Random(6)
    rows = []
    for i in range(n):
        lang = sorted(LATIN)[i % 4]
        stem = {"en": "tion", "de": "ung", "fr": "eux", "es": "ción"}[lang]
        text = " ".join(rng.choice(LATIN[lang].split() + [f"{rng.choice('bcdfglmnprst')}a{stem}"])
                        for _ in range(rng.randrange(8, 60)))
        rows.append((i, text, lang, "s"))
    return rows


def test_language_id(spark):
    rows = [*language_rows(), (900, None, "en", "s"), (901, "", "en", "s"), (902, "123 !? €", "fr", "s"),
            (903, "ÉÉÉ", None, "s"), (904, "the and of", None, "s")]
    out = {r["doc_id"]: r for r in language_id.identify(frame(spark, rows)).collect()}
    assert len(out) == len(rows)
    held = [r for r in rows[:400] if brute.fold(r[0], 5) == 0]
    assert all(out[r[0]]["held_out"] == (brute.fold(r[0], 5) == 0) for r in rows)
    right = sum(out[i]["lang_pred"] == lang for i, _, lang, _ in held)
    assert right >= 0.97 * len(held)
    assert [out[i]["lang_pred"] for i in (900, 901, 902)] == ["und"] * 3
    assert out[903]["lang_pred"] != "und" and out[904]["lang_pred"] == "en"
    assert all(0 <= r["score"] <= 1 for r in out.values())
    kept = {r["doc_id"] for r in language_id.accept(frame(spark, rows)).collect()}
    assert not kept & {900, 901, 902} and len(kept) >= 0.98 * 400


def test_accept_rejects_foreign_texts_and_noise(spark):
    rng = random.Random(13)
    clean = language_rows()
    planted = ["Dzisiaj rano poszliśmy na targ kupić świeże owoce a potem zjedliśmy razem obiad",
               "Tänä aamuna menimme torille ostamaan tuoreita hedelmiä ja sitten söimme yhdessä",
               "Сегодня утром мы пошли на рынок купить свежие фрукты", "今天早上我们去市场买新鲜水果",
               "for (int i = 0; i < n; ++i) { buf[i] ^= key[i % klen]; return ptr->next; }"]
    planted += ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz     ") for _ in range(200)) for _ in range(20)]
    rows = clean + [(1000 + i, t, None, "s") for i, t in enumerate(planted)]
    kept = {r["doc_id"] for r in language_id.accept(frame(spark, rows)).collect()}
    assert kept == {i for i, *_ in clean}


def test_language_id_with_few_languages(spark):
    one = language_id.identify(frame(spark, [(1, "the", "en", "s"), (2, "und", None, "s"), (3, "", "en", "s")]))
    assert {r["doc_id"]: r["lang_pred"] for r in one.collect()} in (
        {1: "en", 2: "en", 3: "und"}, {1: "und", 2: "und", 3: "und"})
    none = language_id.identify(frame(spark, [(1, "the", None, "s")])).collect()
    assert none[0]["lang_pred"] == "und" and none[0]["score"] == 0


def test_toxicity(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 5 == 0
        text = words(rng, rng.randrange(10, 80)).split(" ")
        if toxic:
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(["Scumbag", "wretched!!", "pathetic"]))
        rows.append((i, " ".join(text), "en", "s"))
        labels.append((i, int(toxic)))
    rows += [(700, None, "en", "s"), (701, "", "en", "s")]
    labels += [(5, None), (6, 0), (700, 0), (999, 1)]
    marks = spark.createDataFrame([(*x, "a", 1) for x in labels], "doc_id bigint, toxic int, text string, key int")
    out = {r["doc_id"]: r for r in toxicity.score_toxicity(frame(spark, rows), marks).collect()}
    held = [i for i in range(600) if brute.fold(i, 5) == 0]
    assert sum(out[i]["predicted"] == (i % 5 == 0) for i in held) >= 0.97 * len(held)
    assert all((r["predicted"] == 1) == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in out.values())
    assert out[700]["score"] == out[701]["score"] and out[700]["predicted"] == 0


def test_toxicity_without_labels(spark):
    marks = spark.createDataFrame([], "doc_id bigint, toxic int")
    out = toxicity.score_toxicity(frame(spark, [(1, "a b c", "en", "s")]), marks).collect()
    assert out[0]["predicted"] == 0


PII = ["mail a.b+c@x-y.example.org, now", "a@b@c.d e@f", "x@y..z 1.2.3.4.5.6.7.8 999.1.1.1 01.002.3.255",
       "4111 1111-1111 1111 and 4111111111111112", "4111  1111 1111 1111", "+1 (234) 555-0199. +49(0)30-1234567",
       "+1234567 +1 2", "é𝄞 q@r.st 🙂 10.0.0.1", "@@@ ... +++ ---", "1" * 300, "a." * 300, "", None]


def test_personal_data_base(spark):
    rows = [(i, t, "en", "s") for i, t in enumerate(PII)]
    out = personal_data.find_personal_data(frame(spark, rows)).collect()
    for r in out:
        assert r["base"] == brute.base_spans(PII[r["doc_id"]])
        assert sum(r[f"n_{k}"] for k in brute.PATTERNS) == len([x for x in r["base"].split(",") if x])


def test_personal_data_random_strings():
    rng = random.Random(12)
    for _ in range(3000):
        s = "".join(rng.choice("ab1234567890..@@+-- ()é") for _ in range(rng.randrange(60)))
        got = ",".join(f"{personal_data.KINDS[k]}:{a}:{b}" for k, a, b in personal_data.base_spans(s))
        assert got == brute.base_spans(s), s


def test_personal_data_terms_disclose(spark):
    rng = random.Random(9)
    rows = [(i, words(rng, 30), "en", "s") for i in range(80)]
    rows += [(100 + i, f"{words(rng, 12)} contact Quillfeather at quill@example.org w1 w2", "en", "s") for i in range(3)]
    out = {r["doc_id"]: r for r in personal_data.find_personal_data(frame(spark, rows)).collect()}
    for i in range(3):
        text = rows[80 + i][1]
        named = {text[t["start"]:t["end"]]: t for t in out[100 + i]["terms"]}
        assert named["Quillfeather"]["action"] == "remove" and "w1" not in named
        assert abs(named["Quillfeather"]["disclosure"] - 1) < 1e-9
        clean = personal_data.sanitise(text, out[100 + i]["base"], out[100 + i]["terms"])
        assert "quill" not in clean.lower() and "[EMAIL]" in clean
    assert not any(out[i]["terms"] for i in range(80))


def test_personal_data_terms_far_from_the_entity(spark):
    rng = random.Random(10)
    rows = [(i, words(rng, 30), "en", "s") for i in range(80)]
    rows += [(100 + i, f"Farquharson {words(rng, 40)} é write to far@example.org. {words(rng, 25)} Farquharson", "en", "s")
             for i in range(10)]
    rows.append((200, f"{words(rng, 20)} FARQUHARSON was here", "en", "s"))
    out = {r["doc_id"]: r for r in personal_data.find_personal_data(frame(spark, rows)).collect()}
    for i, text, *_ in rows[80:]:
        named = [t for t in out[i]["terms"] if text[t["start"]:t["end"]].lower() == "farquharson"]
        assert len(named) == (1 if i == 200 else 2) and all(t["action"] == "remove" for t in named)
        want = 1 + math.log2(10 / 11) / -math.log2(10 / 91)
        assert all(abs(t["disclosure"] - want) < 1e-9 for t in named)
        assert "farq" not in personal_data.sanitise(text, out[i]["base"], out[i]["terms"]).lower()


OPERATORS = [
    lambda d: exact_dedup.exact_duplicates(d), lambda d: ngram_join.near_duplicates(d),
    lambda d: repeated_passages.repeated_passages(d), lambda d: mixing.mix_sources(d),
    lambda d: packing.pack_documents(d), lambda d: language_model.score_texts(d),
    lambda d: language_id.identify(d), lambda d: personal_data.find_personal_data(d),
]


@pytest.mark.parametrize("op", range(len(OPERATORS)))
def test_empty_table_and_nulls_everywhere(spark, op):
    assert OPERATORS[op](frame(spark, [])).count() == 0
    rows = [(None, None, None, None), (None, "some text", None, None), (1, "same", "en", "s"), (1, "same", "en", "s"),
            (1, "other", "de", None)]
    out = OPERATORS[op](frame(spark, rows))
    assert out.count() == len(rows)


def test_empty_embeddings(spark):
    df = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert embedding_dedup.near_duplicates(df).count() == 0
