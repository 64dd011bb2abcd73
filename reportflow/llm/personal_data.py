"""Personal data: base patterns plus information-theoretic sanitisation.

Base spans are e-mail addresses, IP addresses, card and phone numbers.  Each
distinct value found is a protected entity.  A term (a word of at least
``min_term`` letters or digits outside base spans) in a document of the entity,
however far from it, may reveal it.  Counts over the whole corpus estimate how
strongly: with n(t) documents that hold the term, n(e, t) that hold the entity
too, and n(e) of N that hold the entity, the pointwise mutual information log2 of
(n(e,t) / n(t)) / (n(e) / N), as a share of the entity's own information
-log2(n(e) / N), is the part of the entity that the term discloses (1 if the term
never occurs without it).  A term that discloses at least ``generalise_at`` of an
entity is generalised, from ``remove_at`` on removed, wherever it stands in any
document.  One shared document is coincidence: n(e, t) must be 2 or more.

Texts are never shuffled.  One pass finds base spans and entities, a second
counts terms with the entities of their documents, a third the documents of terms
that may reveal, a fourth finds the places of those that do; terms are compared
by 64-bit hashes and counts are added up per task.

Defined cases: a null text counts as empty and has no span; spans are code point
offsets, end exclusive; repeated rows count as documents of their own; an empty
table gives an empty result.  Only the id and text columns are read, so other
columns may have any name.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportflow.llm import bitmap
from reportflow.llm.bytetext import buffers, chunks, lower, spans_hash
from reportflow.session import ensure_checkpoint_dir

KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match that starts inside a run of digits would also start at the run's first.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def emails(s: str) -> list[tuple[int, int]]:
    """Found from the @ signs, so that long runs without one cost nothing extra."""
    out, end = [], 0
    for m in _DOMAIN.finditer(s):
        start = m.start()
        while start > end and s[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            out.append((start, m.end()))
            end = m.end()
    return out


def _ips(s: str) -> list[tuple[int, int]]:
    return [m.span() for m in _IP.finditer(s)
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(s: str) -> str:
    return s.translate(_ONLY_DIGITS)


_ONLY_DIGITS = {ord(c): None for c in " -().+"}


def _cards(s: str) -> list[tuple[int, int]]:
    return [m.span() for m in _CARD.finditer(s)
            if 16 <= m.end() - m.start() and 16 <= len(d := _digits(m.group())) <= 19 and luhn(d)]


def _phones(s: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(s) if 8 <= len(_digits(m.group())) <= 15]


def base_spans(s: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end), by kind and start."""
    found = [emails(s) if "@" in s else [], _ips(s) if "." in s else [], _cards(s),
             _phones(s) if "+" in s else []]
    return [(k, a, b) for k, spans in enumerate(found) for a, b in spans]


def _entity(kind: int, value: str) -> int:
    """Hash of a value in its normal form: lower case, or digits alone."""
    value = value.lower() if kind < 2 else _digits(value)
    return int.from_bytes(hashlib.blake2b(f"{kind}:{value}".encode(), digest_size=8).digest(), "big",
                          signed=True)


def terms(data: np.ndarray, off: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts, ends and hashes of the terms: runs of letters, digits and bytes of 128 or more."""
    x = lower(data)
    inside = (x >= 128) | ((x >= 97) & (x <= 122)) | ((x >= 48) & (x <= 57))
    if not len(x):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(len(x) + 1, bool)
    cut[off] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | cut[1:-1]
    ends[:-1] &= ~inside[1:] | cut[1:-1]
    a, b = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    long = b - a >= least
    a, b = a[long], b[long]
    return a, b, spans_hash(x, a, b, seed=10).view(np.int64)


_FOUND = "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base string, print bigint, ents array<bigint>"
MOST_PAIRS = 1 << 20


def _spans_of(d: np.ndarray, o: np.ndarray, documents: np.ndarray) -> dict[int, tuple[str, list]]:
    """Text and base spans of those of the documents that have spans."""
    sign = np.concatenate([[0], np.cumsum(((d >= 48) & (d <= 57)) | (d == 64))])[o]
    found = {}
    for i in documents[np.diff(sign)[documents] > 0]:
        text = d[o[i]:o[i + 1]].tobytes().decode("utf-8", "replace")
        spans = base_spans(text)
        if spans:
            found[i] = text, spans
    return found


def _free(a: np.ndarray, b: np.ndarray, spans: list) -> np.ndarray:
    """Which of the terms a:b, in order, touch no span."""
    free = np.ones(len(a), bool)
    for _, s, e in spans:
        free[np.searchsorted(b, s, side="right"):np.searchsorted(a, e)] = False
    return free


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map pass: base spans and entities of every document."""
    for batch in batches:
        data, off = buffers(batch.column(1))
        for first, last, d, o in chunks(data, off):
            n = last - first
            counts = np.zeros((4, n), np.int64)
            base, ents = [""] * n, [[]] * n
            for i, (text, spans) in _spans_of(d, o, np.arange(n)).items():
                base[i] = ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)
                ents[i] = sorted({_entity(k, text[a:b]) for k, a, b in spans})
                for k, _, _ in spans:
                    counts[k, i] += 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, n), *[pa.array(c) for c in counts], pa.array(base, pa.string()),
                 batch.column(2).slice(first, n), pa.array(ents, pa.list_(pa.int64()))],
                ["_id", "n_email", "n_ip", "n_card", "n_phone", "base", "print", "ents"])


def _added(e: np.ndarray, t: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of equal (e, t) added up."""
    order = np.lexsort((t, e))
    e, t, n = e[order], t[order], n[order]
    fresh = np.ones(len(e), bool)
    fresh[1:] = (e[1:] != e[:-1]) | (t[1:] != t[:-1])
    return e[fresh], t[fresh], np.add.reduceat(n, np.flatnonzero(fresh)) if len(n) else n


def _count_pairs(repeated: np.ndarray, least: int):
    """Map pass: documents of the task by entity and term, and by term alone (no entity)."""

    def rows(e, t, n, alone: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.nulls(len(t), pa.int64()) if alone else pa.array(e), pa.array(t), pa.array(n)], ["e", "t", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        held = {alone: (none, none, none) for alone in (False, True)}
        fresh: dict[bool, list] = {False: [], True: []}
        waiting = 0

        def merge(alone: bool) -> bool:
            """Adds what is fresh to what is held; whether that became much."""
            parts = [held[alone], *fresh[alone]]
            held[alone], fresh[alone] = _added(*[np.concatenate(x) for x in zip(*parts, strict=True)]), []
            return len(held[alone][0]) > MOST_PAIRS

        for batch in batches:
            data, off = buffers(batch.column(0))
            for _, _, d, o in chunks(data, off):
                found = _spans_of(d, o, np.arange(len(o) - 1))
                if not found:
                    continue
                starts, ends, hashes = terms(d, o, least)
                points = np.concatenate([[0], np.cumsum((d & 0xC0) != 0x80)])
                for i, (text, spans) in found.items():
                    ents = np.array(sorted({_entity(k, text[a:b]) for k, a, b in spans}), np.int64)
                    ents = ents[bitmap.contains(repeated, ents)]
                    if not len(ents):
                        continue
                    x, y = np.searchsorted(starts, [o[i], o[i + 1]])
                    free = _free(points[starts[x:y]] - points[o[i]], points[ends[x:y]] - points[o[i]], spans)
                    t = np.unique(hashes[x:y][free])
                    if not len(t):
                        continue
                    fresh[True].append((np.zeros(len(t), np.int64), t, np.ones(len(t), np.int64)))
                    step = max(1, MOST_PAIRS // len(t))
                    for k in range(0, len(ents), step):
                        e = np.repeat(ents[k:k + step], len(t))
                        fresh[False].append((e, np.tile(t, len(e) // len(t)), np.ones(len(e), np.int64)))
                        waiting += len(e)
                        if waiting > MOST_PAIRS:
                            waiting = 0
                            for alone in (False, True):
                                if merge(alone):
                                    yield rows(*held[alone], alone)
                                    held[alone] = (none, none, none)
        for alone in (False, True):
            merge(alone)
            yield rows(*held[alone], alone)
    return run


def _places(wanted: np.ndarray, least: int):
    """Map pass: places, outside base spans, of terms that may be in the bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = buffers(batch.column(1))
            for first, last, d, o in chunks(data, off):
                starts, ends, h = terms(d, o, least)
                hit = np.flatnonzero(bitmap.contains(wanted, h))
                if not len(hit):
                    continue
                doc = np.searchsorted(o, starts[hit], side="right") - 1
                points = np.concatenate([[0], np.cumsum((d & 0xC0) != 0x80)])
                a, b = points[starts[hit]] - points[o[doc]], points[ends[hit]] - points[o[doc]]
                free = np.ones(len(hit), bool)
                for i, (_, spans) in _spans_of(d, o, np.unique(doc)).items():
                    x, y = np.searchsorted(doc, [i, i + 1])
                    free[x:y] = _free(a[x:y], b[x:y], spans)
                at = pa.array(first + doc[free])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(2).take(at), pa.array(h[hit][free]),
                     pa.array(a[free].astype(np.int32)), pa.array(b[free].astype(np.int32))],
                    ["_id", "print", "t", "a", "b"])
    return run


def _count_terms(wanted: np.ndarray, least: int):
    """Map pass: in how many documents of the task each wanted term occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, seen = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            data, off = buffers(batch.column(0))
            for _, _, d, o in chunks(data, off):
                starts, _, h = terms(d, o, least)
                hit = np.flatnonzero(bitmap.contains(wanted, h))
                doc = np.searchsorted(o, starts[hit], side="right") - 1
                order = np.lexsort((doc, h[hit]))
                doc, h = doc[order], h[hit][order]
                fresh = np.ones(len(h), bool)
                fresh[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
                t, n = np.unique(h[fresh], return_counts=True)
                found, at = np.unique(np.concatenate([found, t]), return_inverse=True)
                seen = np.bincount(at, np.concatenate([seen, n]), len(found)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(seen)], ["t", "n"])
    return run


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_term: int = 3,
                       generalise_at: float = 0.75, remove_at: float = 0.95) -> DataFrame:
    """One row per document: (id, n_email, n_ip, n_card, n_phone, base, terms).

    ``base`` lists the base spans as kind:start:end; ``terms`` is an array of
    (start, end, action, disclosure), action being ``remove`` or ``generalise``.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text"), F.xxhash64(text).alias("print"))
    found = rows.mapInArrow(_find, f"_id {kind}, {_FOUND}").checkpoint()
    total = max(found.count(), 1)
    entities = (found.select(F.explode("ents").alias("e")).groupBy("e").agg(F.count(F.lit(1)).alias("n_e"))
                .filter((F.col("n_e") > 1) & (F.col("n_e") < total)).checkpoint())
    pairs = (rows.select("_text").mapInArrow(_count_pairs(bitmap.build(entities, "e"), min_term),
                                             "e bigint, t bigint, n bigint")
             .groupBy("e", "t").agg(F.sum("n").alias("n_both")).filter("n_both > 1").checkpoint())

    def disclosing(together: DataFrame, counts: DataFrame) -> DataFrame:
        information = -F.log2(F.col("n_e") / F.lit(float(total)))
        disclosed = F.lit(1.0) + F.log2(F.col("n_both") / F.col("n_t")) / information
        return (together.join(counts, "t").withColumn("disclosure", disclosed)
                .filter(F.col("disclosure") >= generalise_at).drop("n_t"))

    # Documents with entities alone hold a term at most as often as all: what discloses too little there is out.
    least = pairs.filter("e is null").select("t", F.col("n_both").alias("n_t"))
    together = disclosing(pairs.filter("e is not null").join(entities, "e"), least).drop("disclosure").checkpoint()
    counts = (rows.select("_text").mapInArrow(_count_terms(bitmap.build(together, "t"), min_term), "t bigint, n bigint")
              .groupBy("t").agg(F.sum("n").alias("n_t")))
    revealing = disclosing(together, counts).groupBy("t").agg(F.max("disclosure").alias("disclosure")).checkpoint()
    places = rows.mapInArrow(_places(bitmap.build(revealing, "t"), min_term),
                             f"_id {kind}, print bigint, t bigint, a int, b int")
    spans = places.join(revealing, "t").select("_id", "print", "a", "b", "disclosure").distinct()
    action = F.when(F.col("disclosure") >= remove_at, "remove").otherwise("generalise")
    lists = (spans.groupBy(F.col("_id").alias("_sid"), F.col("print").alias("_sprint"))
             .agg(F.sort_array(F.collect_list(F.struct(
                 F.col("a").alias("start"), F.col("b").alias("end"), action.alias("action"),
                 "disclosure"))).alias("terms")))
    none = F.array().cast("array<struct<start:int,end:int,action:string,disclosure:double>>")
    return (found.join(lists, F.col("_id").eqNullSafe(F.col("_sid")) & (F.col("print") == F.col("_sprint")), "left")
            .select(F.col("_id").alias(id_col), "n_email", "n_ip", "n_card", "n_phone", "base",
                    F.coalesce("terms", none).alias("terms")))


def sanitise(text: str, base: str, found_terms: list) -> str:
    """The text with base spans replaced by their kind, terms generalised or removed."""
    marks = [(int(a), int(b), f"[{k.upper()}]") for k, a, b in (x.split(":") for x in base.split(",") if x)]
    marks += [(t["start"], t["end"], "" if t["action"] == "remove" else "[TERM]") for t in found_terms]
    out, at = [], 0
    for a, b, new in sorted(marks, key=lambda m: (m[0], -m[1])):
        if b <= at:
            continue
        out += [text[at:max(a, at)], new]
        at = b
    return "".join(out) + text[at:]
