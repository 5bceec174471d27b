"""Plain Python versions of what the operators compute, and small frames to try them on."""

import hashlib
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"
SPACE = "\x20\x09-\x0D"
WORD = re.compile(f"[^{SPACE}]+")
LONG = " ".join(f"w{i % 977}" for i in range(30_000)) + "."
DOCS = [(1, "A short text."), (2, None), (3, ""), (4, " \t\n\x0b\x0c\r "), (5, LONG), (6, "A short text."), (6, "A short text."),
        (7, "É" * 300 + " <|endoftext|> </s> 中文 😀 \x1c\x85  x"), (None, "No id here, but words."), (None, None)]


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def docs_frame(spark, rows=DOCS):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame(
        [(i, t, "en", "s", 0, -1, 1, "x", True) for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long, n_words long, slot int, stats string, kept boolean")


def empty_docs(spark):
    return docs_frame(spark).limit(0)


def words(text):
    return WORD.findall(text or "")


def shingles(text):
    w = [x.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for x in words(text)]
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def components(rows):
    """id -> smallest id of its near-duplicate group, all pairs compared."""
    sets = {}
    for i, t in rows:
        if i is not None:
            sets.setdefault(i, shingles(t))
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                p, q = top(a), top(b)
                up[max(p, q)] = min(p, q)
    return {i: top(i) for i in ids}


def base_rule(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    where = {}
    for i in range(len(w) - 2):
        where.setdefault(tuple(w[i:i + 3]), []).append(i)
    covered = {p for at in where.values() if len(at) > 1 for i in at for p in (i, i + 1, i + 2)}
    n, repeated = len(w), len(covered)
    return (n, sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), repeated,
            n < 50 or 100 * repeated > 50 * n)


def line_fails(line):
    from tillroll.llm import quality_rules as Q
    body = line.strip(" \t\n\x0b\x0c\r")
    w = words(body)
    n = len(w)
    if not n:
        return False
    symbols, seps, bangs = (sum(body.count(c) for c in set(x)) for x in (Q.SYMBOLS, Q.SEPARATORS, "!"))
    return bool((body[-1] not in Q.CLOSING and n < 5) or (bangs > 3 and bangs >= n) or (symbols and 2 * symbols >= n)
                or (seps and 5 * seps >= n) or (n <= 40 and any(p in body.lower() for p in Q.BOILERPLATE)))


def cleaned(text):
    """(kept, text without failing lines) by the rules."""
    *_, base_failed = base_rule(text)
    lines = (text or "").split("\n")
    lost = sum(len("".join(words(x))) for x in lines if line_fails(x))
    kept = not base_failed and 100 * lost <= 50 * len("".join(words(text)))
    return kept, "\n".join(x for x in lines if not line_fails(x))


def sha256(data):
    return hashlib.sha256(data).hexdigest()
