"""Brute-force versions of the training-data operators, for small fixtures."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def fold(doc_id, folds):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % folds


class Groups:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def shingles(text, width=5):
    words = WORD.findall(low(text))
    if len(words) < width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def near_components(rows, percent=75):
    """{id: (set size, component)} by comparing all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    groups, ids = Groups(sets), sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                groups.join(a, b)
    return {i: (len(sets[i]), groups.find(i)) for i in ids}


def removed(rows, length=100):
    """{id: (bytes, removed, spans, digest)}; rows in order of id."""
    seen, out = set(), {}
    for i, t in sorted(rows):
        raw = (t or "").encode()
        marks = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            part = raw[s:s + length]
            if part in seen:
                marks[s:s + length] = b"\1" * length
            seen.add(part)
        kept = bytes(b for b, m in zip(raw, marks, strict=True) if not m)
        out[i] = (len(raw), sum(marks), len(re.findall(b"\1+", bytes(marks))), hashlib.sha256(kept).hexdigest())
    return out


def lm_scores(rows, mu=4.0):
    """{id: (held out, tokens, known, N, base, score)}."""
    tokens = {i: [*WORD.findall(low(t)), None] for i, t in rows}
    one, two = Counter(), Counter()
    for i, w in tokens.items():
        if fold(i, 7) != 2:
            one.update(w)
            two.update(zip([0, *w], w, strict=False))
    n, v, ends, out = sum(one.values()), len(one), one[None], {}
    for i, w in tokens.items():
        p1 = [(one[x] + 1) / (n + v + 1) for x in w]
        p2 = [(two[a, b] + mu * p) / ((ends if a == 0 else one[a]) + mu)
              for a, b, p in zip([0, *w], w, p1, strict=False)]
        out[i] = (fold(i, 7) == 2, len(w), sum(one[x] > 0 for x in w), n,
                  sum(map(math.log10, p1)), sum(map(math.log10, p2)))
    return out


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d // 10 + d % 10
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def cosine_links(rows, threshold=0.93):
    """{id: (links, component)} of (id, vector, label) rows."""
    def sound(v, label):
        return (label is not None and v and all(x is not None and math.isfinite(x) for x in v)
                and any(x != 0 for x in v))
    groups, links = Groups([r[0] for r in rows]), defaultdict(int)
    for x, (a, va, la) in enumerate(rows):
        for b, vb, lb in rows[x + 1:]:
            if sound(va, la) and sound(vb, lb) and la == lb and len(va) == len(vb):
                dot = sum(p * q for p, q in zip(va, vb, strict=True))
                if dot / math.sqrt(sum(p * p for p in va) * sum(q * q for q in vb)) >= threshold:
                    groups.join(a, b)
                    links[a] += 1
                    links[b] += 1
    return {r[0]: (links[r[0]], groups.find(r[0])) for r in rows}


def normalised(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


ASSIGN = re.compile("(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                    re.ASCII)


def secrets(text):
    """Base spans of secrets, by start and then kind, as text."""
    text = text or ""
    out = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    out += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", text)
            if len(m.group()) >= 16]
    out += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", text)
            if len(m.group()) >= 32]
    return ",".join(x for *_, x in sorted(out))


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def spelling(docs, every=199, least_length=6, least_count=5, ratio=5):
    """{word: (form, root, n, n_near, form_n)} by comparing all pairs."""
    n = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = low(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if every and h % every == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            n[run] += 1
    words = [w for w in n if len(w) >= least_length and n[w] >= least_count]
    form, out = {}, {}
    for w in words:
        near = [x for x in words if one_edit(w, x)]
        best = min(near, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
        out[w] = len(near)
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = form[w], root, n[w], out[w], n[form[w]] if form[w] else None
    return out


SPACE = " \t\n\x0b\x0c\r"
GRAMMAR = re.compile("(s?(ua)+)?")


def damage(rows):
    """The damaged (conv, turn, role, text) rows of the contract."""
    out = []
    for conv, turn, role, text in rows:
        text = " " if text is None else text
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if code == 1:
            text = ""
        elif code == 2:
            text = re.sub("[.!?]", "", text)
        role = "user" if code == 4 else " " if role is None else role
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(code, 1)
    return out


def repaired(rows):
    """The contract's facts of one conversation, by all edit sequences (merged by the roles they give)."""
    def spot(r):
        key = f"{len(r[2])}:{r[2]}{r[3]}"
        return r[1] is not None, r[1] or 0, hashlib.sha256(key.encode()).digest()
    rows = sorted(rows, key=spot)
    facts, seen = Counter(), set()
    ways = {"": (0, "", ())}
    for k, (_, _, role, text) in enumerate(rows):
        bare = text.strip(SPACE)
        fault = ("blank" if not bare else "duplicate" if (role, text) in seen
                 else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
        facts[fault] += 1
        if k:
            facts["illegal"] += rows[k - 1][2][:1] + role[:1] not in ("su", "ua", "au")
        new = {}

        def offer(roles, way, new=new):
            if re.fullmatch("s?(ua)*u?", roles) and (roles not in new or way[:2] < new[roles][:2]):
                new[roles] = way
        for roles, (cost, audit, lines) in inserted(ways).items():
            offer(roles, (cost + 4, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more = cost + 3 * (fault == "truncated")
            offer(roles + (role[:1] if role[:1] in ("s", "u", "a") else "x"), (more, audit + "K", (*lines, (role, text))))
            for name in ("user", "assistant"):
                offer(roles + name[0], (more + 3, audit + "R", (*lines, (name, text))))
        ways = new
    cost, audit, lines = min(w for roles, w in inserted(ways).items() if GRAMMAR.fullmatch(roles))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
    return (gaps, facts["blank"], facts["duplicate"], facts["truncated"], facts["illegal"], cost, audit, digest)


def inserted(ways):
    out = dict(ways)
    for _ in range(2):
        for roles, (cost, audit, lines) in list(out.items()):
            for name in ("user", "assistant"):
                way = cost + 3, audit + "I", (*lines, (name, ""))
                grown = roles + name[0]
                if re.fullmatch("s?(ua)*u?", grown) and (grown not in out or way[:2] < out[grown][:2]):
                    out[grown] = way
    return out
