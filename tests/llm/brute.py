"""Plain Python versions of what the operators compute, and small tricky tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use themselves.
CLASH = ("words", "size", "rid", "spans", "kept", "n", "block", "shard", "text_key", "quality_struct", "copy_sha256",
         "mix_size", "sid", "pass", "once", "tokens", "g", "length", "pool")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(text or "")


def prose(seed, n):
    r = random.Random(seed)
    pool = ["the", "of", "and", "to", "in", "is", "it", "that"] + [f"w{r.randrange(400)}x" for _ in range(200)]
    return " ".join(r.choice(pool) + r.choice(["", "", "", ".", ",", "\n"]) for _ in range(n))


def tricky_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    base, long = prose(1, 120), prose(2, 40_000)
    near = base.replace(" the ", " a ", 1)
    return [
        (1, base, "en", "a", 1), (2, base, "en", "a", 1), (2, base, "en", "a", 1), (3, near, None, "b", None),
        (4, None, "en", "b", None), (5, "", None, None, 0), (6, " \t\n\x0b\r ", "de", "c", 5), (None, base, "en", None, 3),
        (None, None, None, None, None), (7, long, "en", "c", 9), (8, long + " end", "en", "c", 9), (9, "one", "fr", "c", 3),
        (10, "one two three four", "fr", "a", 3), (11, "é ü 漢字 😀 word", "fr", "a", 3), (12, prose(3, 300), "de", "a", 3),
        (13, "x" * 30_000, "de", "b", 3), (14, "12345", "de", "b", 3), (2**60, prose(4, 80), "de", "b", 3),
        (15, prose(5, 60) + "\n\n" + prose(5, 60), "es", "b", 3), (16, "\x1c\x85\xa0", "es", "b", 3),
    ]


def tricky(spark):
    return spark.createDataFrame(tricky_rows(), DOCS)


def clashing(df):
    """``df`` with extra columns whose names clash with the operators' own."""
    return df.withColumns({c: F.lit(f"kept {c}") for c in CLASH})


def empty(spark, schema=DOCS):
    return spark.createDataFrame([], schema)


# --- quality -----------------------------------------------------------------------------------

def quality(text):
    w = words(text)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    often = Counter(windows)
    covered = {j for i, x in enumerate(windows) if often[x] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


# --- spans -------------------------------------------------------------------------------------

SECRETS = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
     lambda m: len(m[2]) >= 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
)


def secrets(text):
    found = [(m.start(), i, m.end()) for i, (_, p, ok) in enumerate(SECRETS) for m in p.finditer(text or "") if ok(m)]
    return [(SECRETS[i][0], s, e) for s, i, e in sorted(found)]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        total += sum(map(int, str(int(c) * 2))) if i % 2 else int(c)
    return total % 10 == 0


PRIVATE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda t, d: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda t, d: all(int(x) <= 255 for x in t.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda t, d: 16 <= len(d) <= 19 and luhn(d)),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda t, d: 8 <= len(d) <= 15),
)


def private(text):
    return [(k, m.start(), m.end()) for k, p, ok in PRIVATE for m in re.finditer(p, text or "")
            if ok(m[0], re.sub("[^0-9]", "", m[0]))]


def joined(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- Jaccard -----------------------------------------------------------------------------------

def shingles(text):
    w = words(lower(text))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def jaccard_components(rows):
    """(doc_id, n_shingles, component) of each row, by comparing rows that share a shingle."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for t in s:
            holders[t].append(i)
    for i, s in enumerate(sets):
        for j, n in Counter(j for t in s for j in holders[t] if j > i).items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                parent[find(j)] = find(i)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None and sets[i]:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return [(d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]


# --- language model ------------------------------------------------------------------------------

def unigram(rows):
    """doc_id, held out, tokens, known tokens, training tokens, base score."""
    mod = lambda d: zlib.crc32(str("" if d is None else d).encode()) % 7
    docs = [(d, [*words(lower(t)), "\n"]) for d, t in rows]
    counts = Counter(x for d, w in docs if mod(d) != 2 for x in w)
    n, v = sum(counts.values()), len(counts)
    return [(d, mod(d) == 2, len(w), sum(counts[x] > 0 for x in w), n,
             sum(math.log10((counts[x] + 1) / (n + 1 * (v + 1))) for x in w)) for d, w in docs]


def targets(sizes):
    """Target per source, in source order: weights 3, 1, 2; 150 %; stop at twice the size."""
    names = sorted([s for s in sizes if s is not None], key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total = 1.5 * sum(sizes.values())
    out = {s: total * weight[s] / sum(weight.values()) for s in names}
    done = set()
    while over := [s for s in names if s not in done and out[s] > 2 * sizes[s]]:
        done |= set(over)
        out |= {s: 2.0 * sizes[s] for s in over}
        left = total - sum(out[s] for s in done)
        free = [s for s in names if s not in done]
        out |= {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
    return out
