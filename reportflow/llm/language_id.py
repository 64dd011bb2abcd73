"""Language ID in two steps: family first, then language within the family.

Features are relative frequencies of character n-grams (one to three bytes of the
lower-cased letters and the gaps between them), hashed into fixed tables.  One
linear SVM per family, against the rest, chooses the family; inside it one linear
SVM for each pair of languages votes.  A prediction is a table look-up per byte,
summed per document.

``accept`` also asks whether a text looks like its language at all, which SVMs
that only tell the given languages apart cannot say: its evidence is the mean log
of how much more often its trigrams occur in the language than in even bytes.  A
text goes where that is below two fifths of the median of the language's training texts,
each judged by the others; some texts half in another language, and some short ones
that are mostly addresses or keys, go too.  The number of languages sets no floor to it.

Training sees at most ``per_language`` whole texts of each language (those with
the smallest hashed ids); this bound is the only sampling.  Every SVM is fitted
in a Spark task of its own, from rows bounded by ``per_language`` as well.

Defined cases: a text that is null, empty or without a letter is ``und`` with
score 0; languages without a training text are never predicted; with one
language only, all other texts get it with score 1; without any training text,
all get ``und``; repeated rows get equal predictions; an empty table gives an
empty result; a text of any length is taken whole, a megabyte at a time.  Only the named columns are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportflow.llm.bytetext import buffers, chunks, lower
from reportflow.llm.linear import fit_svm, held_out, sample_bounds, sigmoid

# Families of common languages; any other code is a family "other".
FAMILIES = {
    "germanic": ["en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af"],
    "romance": ["fr", "es", "it", "pt", "ro", "ca", "gl"],
    "slavic": ["ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "sl", "mk"],
    "uralic": ["fi", "et", "hu"],
    "turkic": ["tr", "az", "kk", "uz"],
    "indo-aryan": ["hi", "bn", "ur", "mr", "ne", "gu", "pa"],
    "semitic": ["ar", "he"],
    "cjk": ["zh", "ja", "ko"],
}
UND = "und"
ONE, TWO, THREE = 256, 1 << 13, 1 << 14
WIDTH = ONE + TWO + THREE
ENOUGH = 0.4

_KEEP = np.full(256, 32, np.uint8)
_KEEP[97:123] = np.arange(97, 123)
_KEEP[128:] = np.arange(128, 256)


def family_of(language: str) -> str:
    return next((f for f, codes in FAMILIES.items() if language in codes), "other")


def ngram_columns(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Feature column of the 1-, 2- and 3-gram that ends at every byte: (3, bytes)."""
    x = _KEEP[lower(data)].astype(np.uint32)
    a, b = np.full_like(x, 32), np.full_like(x, 32)
    a[1:], b[2:] = x[:-1], x[:-2]
    first = off[:-1][off[:-1] < len(x)]
    a[first], b[first] = 32, 32
    second = (off[:-1] + 1)[np.diff(off) > 1]
    b[second] = 32
    two = (x | a << np.uint32(8)) * np.uint32(0x9E3779B1)
    three = (x | a << np.uint32(8) | b << np.uint32(16)) * np.uint32(0x85EBCA6B)
    return np.stack([x.astype(np.int64), (ONE + (two >> np.uint32(19))).astype(np.int64),
                     (ONE + TWO + (three >> np.uint32(18))).astype(np.int64)])


PIECE = 1 << 20


def pieces(data: np.ndarray, off: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(documents, their starts, columns) of a megabyte of the bytes after the other.

    Every n-gram comes once, whatever document it lies in, so that features can be
    added up per document in bounded memory, however long a document is.
    """
    for s in range(0, len(data), PIECE):
        e, lo = min(s + PIECE, len(data)), max(s - 2, 0)        # an n-gram reaches two bytes back
        columns = ngram_columns(data[lo:e], np.unique(np.clip(off, lo, e)) - lo)[:, s - lo:]
        last = int(np.searchsorted(off, e, side="left"))
        docs = np.arange(int(np.searchsorted(off, s, side="right")) - 1, last)
        docs = docs[np.minimum(off[docs + 1], e) > np.maximum(off[docs], s)]
        yield docs, np.maximum(off[docs], s) - s, columns


def has_letter(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Whether each document has a letter in the sense of Unicode."""
    out = np.zeros(len(off) - 1, bool)
    some = np.flatnonzero(np.diff(off) > 0)
    if not len(some):
        return out
    low = data | np.uint8(32)
    out[some] = np.maximum.reduceat(((low >= 97) & (low <= 122)).view(np.uint8), off[:-1][some]) > 0
    wide = np.zeros(len(out), bool)
    wide[some] = np.maximum.reduceat((data >= 128).view(np.uint8), off[:-1][some]) > 0
    for i in np.flatnonzero(~out & wide):
        out[i] = any(c.isalpha() for c in data[off[i]:off[i + 1]].tobytes().decode("utf-8", "ignore"))
    return out


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, off = buffers(batch.column(1))
        languages = batch.column(0).to_pylist()
        out: list[list] = [[], [], [], []]
        for a, _, d, o in chunks(data, off):
            letters = has_letter(d, o)
            open_doc, counts = -1, np.zeros(WIDTH, np.int64)

            def close(i: int, counts: np.ndarray, a=a, o=o) -> None:
                at = np.flatnonzero(counts)
                share = (counts[at] / (o[i + 1] - o[i])).astype(np.float32)
                out[0].append(languages[a + i])
                out[1].append(at.astype(np.int32).tobytes())
                out[2].append(share.tobytes())
                out[3].append(int(o[i + 1] - o[i]))

            for docs, starts, columns in pieces(d, o):
                ends = np.append(starts[1:], columns.shape[1])
                for i, s, e in zip(docs.tolist(), starts.tolist(), ends.tolist(), strict=True):
                    if not letters[i]:
                        continue
                    if i != open_doc:
                        if open_doc >= 0:
                            close(open_doc, counts)
                        open_doc, counts = i, np.zeros(WIDTH, np.int64)
                    counts += np.bincount(columns[:, s:e].ravel(), minlength=WIDTH)
            if open_doc >= 0:
                close(open_doc, counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.string()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary()),
             pa.array(out[3], pa.int64())], ["lang", "cols", "vals", "size"])


def _fit(pdf: pd.DataFrame) -> pd.DataFrame:
    """One SVM; scales (inverse roots of mean frequencies) are folded into its weights."""
    pdf = pdf.sort_values(["sign", "cols", "vals"])     # the same model whatever the order
    cols = [np.frombuffer(x, np.int32) for x in pdf["cols"]]
    vals = [np.frombuffer(x, np.float32).astype(np.float64) for x in pdf["vals"]]
    offsets = np.concatenate([[0], np.cumsum([len(c) for c in cols])])
    cols, vals = np.concatenate(cols), np.concatenate(vals)
    mean = np.bincount(cols, vals, WIDTH) / len(pdf)
    scale = 1 / np.sqrt(mean + 1e-4)
    vals = vals * scale[cols]
    norm = np.sqrt((vals * vals).sum() / len(pdf)) or 1.0
    w, b = fit_svm(vals / norm, cols, offsets, pdf["sign"].to_numpy(np.float64), WIDTH)
    return pd.DataFrame({"task": [pdf["task"].iloc[0]],
                         "weights": [(w * scale / norm).astype(np.float32).tobytes()], "bias": [float(b)]})


_BLANK = int(ngram_columns(np.array([32], np.uint8), np.array([0, 1]))[2, 0]) - ONE - TWO


def _profile(pdf: pd.DataFrame) -> pd.DataFrame:
    """Log ratios of a language's trigrams, and the limit from texts left out one by one."""
    texts = []
    for cols, vals, size in zip(pdf["cols"], pdf["vals"], pdf["size"], strict=True):
        at = np.frombuffer(cols, np.int32) - ONE - TWO
        n = np.round(np.frombuffer(vals, np.float32).astype(np.float64) * size)
        mine = (at >= 0) & (at != _BLANK)
        texts.append((at[mine], n[mine]))
    counts = np.zeros(THREE)
    for at, n in texts:
        counts[at] += n
    total = counts.sum()
    ratios = np.log((counts + 0.5) / (total + 0.5 * THREE) * THREE)
    ratios[_BLANK] = 0
    left_out = [(n * np.log((counts[at] - n + 0.5) / (total - n.sum() + 0.5 * THREE) * THREE)).sum() / n.sum()
                for at, n in texts if len(at)]
    return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "ratios": [ratios.astype(np.float32).tobytes()],
                         "least": [ENOUGH * float(np.median(left_out)) if left_out else 0.0]})


def is_language(model: dict, names: np.ndarray, data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Whether each document has the evidence that its predicted language asks for."""
    known = sorted(model["profiles"])
    out = np.zeros(len(off) - 1, bool)
    of = np.array([known.index(x) if x in model["profiles"] else -1 for x in names], np.int64)
    size = np.diff(off)
    some = np.flatnonzero((size > 0) & (of >= 0))
    if not len(some):
        return out
    table = np.stack([model["profiles"][x][0] for x in known])
    least = np.array([model["profiles"][x][1] for x in known])
    total, letters = np.zeros(len(size)), np.zeros(len(size), np.int64)
    for docs, starts, columns in pieces(data, off):
        columns = columns[2] - ONE - TWO
        lengths = np.diff(np.append(starts, len(columns)))
        total[docs] += np.add.reduceat(table[np.repeat(of[docs], lengths), columns], starts, dtype=np.float64)
        letters[docs] += np.add.reduceat((columns != _BLANK).astype(np.int64), starts)
    out[some] = total[some] / np.maximum(letters[some], 1) >= least[of[some]]
    return out


def train(labelled: DataFrame, id_col: str, text_col: str, lang_col: str,
          per_language: int = 400, profiles: bool = False) -> dict:
    """Model of the languages in ``labelled`` (rows with a language and a text); ``profiles`` for ``is_language``."""
    rows = (labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
            .select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"),
                    F.xxhash64(F.col(id_col).cast("string"), F.lit(3)).alias("key")))
    bounds = sample_bounds(rows, "lang", "key", per_language)
    languages = sorted(bounds)
    model: dict = {"languages": languages, "families": {}, "tasks": {}}
    for x in languages:
        model["families"].setdefault(family_of(x), []).append(x)
    if len(languages) < 2 and not (languages and profiles):
        return model
    within = F.lit(False)
    for x, bound in bounds.items():
        within = within | ((F.col("lang") == x) & (F.col("key") <= bound))
    sample = rows.filter(within).select("lang", "text").mapInArrow(
        _training_rows, "lang string, cols binary, vals binary, size bigint")
    if profiles:
        fitted = sample.groupBy("lang").applyInPandas(_profile, "lang string, ratios binary, least double")
        model["profiles"] = {r["lang"]: (np.frombuffer(r["ratios"], np.float32), r["least"])
                             for r in fitted.collect()}    # one row per language
        if len(languages) < 2:
            return model
    tasks = []                                             # (task, positive, negative languages)
    families = model["families"]
    if len(families) > 1:
        tasks += [(f"family:{f}", families[f], [x for x in languages if x not in families[f]])
                  for f in sorted(families)]
    for f in sorted(families):
        tasks += [(f"pair:{a}:{b}", [a], [b]) for a, b in combinations(families[f], 2)]
    of = {x: [(t, 1 if x in p else -1) for t, p, n in tasks if x in p or x in n] for x in languages}
    plan = F.create_map(*[y for x in languages for y in (F.lit(x), F.array(*[
        F.struct(F.lit(t).alias("task"), F.lit(s).alias("sign")) for t, s in of[x]]))])
    fitted = (sample.withColumn("t", F.explode(plan[F.col("lang")]))
              .select("t.task", "t.sign", "cols", "vals").groupBy("task")
              .applyInPandas(_fit, "task string, weights binary, bias double"))
    for r in fitted.collect():                             # one row per SVM
        model["tasks"][r["task"]] = (np.frombuffer(r["weights"], np.float32), r["bias"])
    return model


def predict(model: dict, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Language and score of each document of a chunk."""
    n = len(off) - 1
    letters = has_letter(data, off)
    languages = model["languages"]
    if not languages:
        return np.full(n, UND, object), np.zeros(n)
    if len(languages) == 1:
        return np.where(letters, languages[0], UND).astype(object), letters.astype(float)
    names = sorted(model["tasks"])
    table = np.stack([model["tasks"][t][0] for t in names], axis=1)
    bias = np.array([model["tasks"][t][1] for t in names])
    margin = np.zeros((n, len(names)))
    size = np.diff(off)
    for docs, starts, columns in pieces(data, off):
        total = table[columns[0]] + table[columns[1]] + table[columns[2]]
        margin[docs] += np.add.reduceat(total, starts, axis=0, dtype=np.float64)
    margin = margin / np.maximum(size, 1)[:, None] + bias
    at = {t: margin[:, i] for i, t in enumerate(names)}
    families = sorted(model["families"])
    if len(families) > 1:
        each = np.stack([at[f"family:{f}"] for f in families], axis=1)
        family = each.argmax(1)
        strong = np.exp(2 * np.clip(each, -8, 8))
        sure = strong.max(1) / strong.sum(1)
    else:
        family, sure = np.zeros(n, int), np.ones(n)
    out, score = np.full(n, UND, object), np.zeros(n)
    for k, f in enumerate(families):
        mine = np.flatnonzero(letters & (family == k))
        members = model["families"][f]
        votes, sums = np.zeros((len(mine), len(members))), np.zeros((len(mine), len(members)))
        for i, j in combinations(range(len(members)), 2):
            m = at[f"pair:{members[i]}:{members[j]}"][mine]
            votes[:, i] += m >= 0
            votes[:, j] += m < 0
            p = sigmoid(3 * m)
            sums[:, i] += p
            sums[:, j] += 1 - p
        best = (votes + sums / (len(members) + 1)).argmax(1)
        out[mine] = np.array(members, object)[best]
        inside = sums[np.arange(len(mine)), best] / max(len(members) - 1, 1) if len(members) > 1 else 1.0
        score[mine] = sure[mine] * inside
    return out, score


def identify(docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id",
             text_col: str = "text", lang_col: str = "lang", per_language: int = 400,
             folds: int = 5) -> DataFrame:
    """One row per document: (id, held_out, lang_pred, score).

    Without ``labelled`` the model learns from the rows of ``docs`` that are not
    held out (crc32 of the id modulo ``folds`` is not 0).
    """
    source = docs if labelled is None else labelled
    model = train(source.filter(~held_out(F.col(id_col), folds, 0)), id_col, text_col, lang_col,
                  per_language)
    return apply_model(docs, model, id_col, text_col, folds)


def apply_model(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text",
                folds: int = 5) -> DataFrame:
    """One row per document: (id, held_out, lang_pred, score)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = buffers(batch.column(2))
            for a, b, d, o in chunks(data, off, 2 << 20):
                names, score = predict(model, d, o)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a),
                     pa.array(names, pa.string()), pa.array(score, pa.float64())],
                    [id_col, "held_out", "lang_pred", "score"])

    return docs.select(F.col(id_col), held_out(F.col(id_col), folds, 0).alias("held_out"),
                       F.col(text_col).cast("string")).mapInArrow(
        run, f"`{id_col}` {kind}, held_out boolean, lang_pred string, score double")


def accept(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
           per_language: int = 400, folds: int = 5) -> DataFrame:
    """The documents, all columns, whose language is known.

    The model is that of ``identify``; ``und`` and texts that do not look like the
    predicted language (``is_language``) are rejected.
    """
    model = train(docs.filter(~held_out(F.col(id_col), folds, 0)), id_col, text_col, lang_col, per_language,
                  profiles=True)
    if not model["languages"]:
        model["profiles"] = {}
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = buffers(batch.column(at))
            for a, b, d, o in chunks(data, off, 2 << 20):
                names, _ = predict(model, d, o)
                yield batch.slice(a, b - a).filter(
                    pa.array((names != UND) & is_language(model, names, d, o)))

    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])       # whatever the columns are called
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
