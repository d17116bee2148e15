"""Shared lines, periodic runs and spelling variants against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import connect, difference
from conftest import rows

from pipekit.llm import line_dedup, periodic_runs, queries, spelling

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, row string, n long, kept string, key string, word string, cell string, start long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def table(spark, texts):
    """(id, text) pairs with extra columns named like the operators' own."""
    return spark.createDataFrame([(i, t, "r", 1, None, "k", "w", "c", 2) for i, t in texts], DOCS).repartition(3)


# ---------------------------------------------------------------- lines

SHARED = ["A line that many documents share", "  another line, \tshared \r", "0123456789", "ÄÖÜ ÄÖÜ ÄÖÜ", "short one"]


def line_texts():
    rng = random.Random(11)
    texts = [(i, "\n".join(rng.choice([*SHARED, *(s.upper() for s in SHARED), "", f"own line of document {i}"])
                           for _ in range(rng.randint(0, 12)))) for i in range(40, 0, -1)]
    texts += [(50, None), (51, ""), (52, "\n"), (53, "\n\n012345678\n"), (54, "012345678"), (None, SHARED[0] + "\nnull id line"),
              (None, "null id line"), (7, "twice the same id"), (7, "twice the same id\n" + SHARED[0]), (90, "last one\r\n" * 2000),
              (91, "LAST ONE\nx")]
    return texts


def brute_lines(texts, min_chars=10, min_docs=2):
    def key(line):
        return lower(line.strip("\x20\x09\x0a\x0b\x0c\x0d"))
    held = defaultdict(set)
    for i, t in texts:
        for line in (t or "").split("\n"):
            held[key(line)].add((i is None, i or 0))
    out = []
    for i, t in texts:
        lines = (t or "").split("\n")
        keep = [x for x in lines if len(key(x)) < min_chars or len(held[key(x)]) < min_docs
                or min(held[key(x)]) == (i is None, i or 0)]
        out.append((str(i), len(lines), len(lines) - len(keep), sha("\n".join(keep))))
    return sorted(out)


@pytest.mark.parametrize("hot_share", [1000, 20])
@pytest.mark.parametrize("chars,docs", [(10, 2), (9, 3)])
def test_shared_lines(spark, monkeypatch, hot_share, chars, docs):
    monkeypatch.setattr(line_dedup, "HOT_SHARE", hot_share)
    got = line_dedup.drop_repeated_lines(table(spark, line_texts()), min_chars=chars, min_docs=docs)
    have = sorted((str(r.row.doc_id), r.n_lines, r.n_dropped, sha(r.kept)) for r in got.collect())
    assert have == brute_lines(line_texts(), chars, docs)


def test_documents_keep_their_columns(spark):
    docs = table(spark, [(1, "a shared line\nx"), (2, "A SHARED LINE\ny"), (3, None)])
    out = line_dedup.without_repeated_lines(docs)
    assert out.columns == docs.columns
    assert rows(out, "doc_id", "text") == [(1, "a shared line\nx"), (2, "y"), (3, None)]
    assert line_dedup.without_repeated_lines(docs.limit(0)).isEmpty()


def test_shared_lines_equal_sql(spark):
    assert difference(queries.op11_line_dedup(spark, SF), connect(SF), queries.ORACLES["op11_line_dedup"]) is None


# ---------------------------------------------------------------- runs

def brute_runs(words):
    """Runs by trying each period from the shortest and each maximal stretch."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            stretch = words[i:j + q]
            if length >= max(6, 4 * q) and not any(stretch[p:] == stretch[:-p] for p in range(1, q)):
                found.append((i, length, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def run_texts():
    rng = random.Random(12)
    texts = []
    for i in range(150):
        words = []
        while len(words) < rng.randint(1, 120):
            unit = [rng.choice("abAc") for _ in range(rng.randint(1, 9))]
            words += unit * rng.choice([1, 1, 4, 5, 6, 9]) + unit[:rng.randint(0, len(unit))]
        texts.append((i, " ".join(words)))
    texts += [(200 + i, rng.choice(["", "\n", " x"]) + "a " * i) for i in range(30)]
    texts += [(300, None), (301, ""), (302, " \t\r\n"), (303, "one"), (304, "é é " * 7), (305, "a\x1fb " * 6 + "\x0bA" * 5),
              (None, "x y z " * 9), (7, "p q " * 8), (7, "p q " * 8), (400, "u v w x y " * 5000)]
    texts += [(500 + i, " ".join(rng.choice("abcdefgh") for _ in range(300))) for i in range(40)]
    return texts


def brute_report(doc_id, text, plant):
    words = re.findall("[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if plant and n and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = [(0, 25000, 5)] if n == 25000 and doc_id == 400 and not (plant and h % 10 == 0) else brute_runs(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (str(doc_id), len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


@pytest.mark.parametrize("plant", [False, True])
def test_periodic_runs(spark, plant):
    got = periodic_runs.run_report(table(spark, run_texts()), plant=plant)
    have = sorted(((str(r[0]), *tuple(r)[1:]) for r in got.collect()), key=repr)
    assert have == sorted((brute_report(i, t, plant) for i, t in run_texts()), key=repr)


def test_runs_are_listed(spark):
    docs = table(spark, [(1, "a b a b a b a b c c c c c c"), (2, None), (3, "a a a a a")])
    assert rows(periodic_runs.word_runs(docs)) == [(1, 0, 8, 2), (1, 8, 6, 1)]
    assert periodic_runs.run_report(docs.limit(0)).isEmpty()


def test_wavelet_tree_gives_successors():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 64, 200):
        values = rng.permutation(n)
        tree = periodic_runs.WaveletTree(values)
        at = rng.integers(0, n, 100)
        lo = np.array([rng.integers(0, a + 1) for a in at])
        hi = np.array([rng.integers(a + 1, n + 1) for a in at])
        want = [min((v for v in values[a:b] if v > x), default=-1) for a, b, x in zip(lo, hi, values[at], strict=True)]
        assert tree.successor(lo, hi, values[at]).tolist() == want


# ---------------------------------------------------------------- spelling

def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute_groups(counts):
    near_of = {w: [v for v in counts if v != w and near(w, v)] for w in counts}
    form = {}
    for w, others in near_of.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 2 * counts[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return sorted((w, form[w] or "", root(w), counts[w], len(near_of[w]), counts[form[w]] if form[w] else 0) for w in counts)


def flat(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in df.collect())


def variants(rng, n):
    """Words of few letters, so that anagrams and chains abound."""
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(5, 8))) for _ in range(n)}
    words |= {"letter", "lettre", "leter", "letters", "lettes", "ÀBCDE".replace("BCDE", "bcde"), "àbcde", "x" * 300, "x" * 301, "x" * 299 + "y"}
    return {w: rng.choice([3, 4, 6, 9, 13, 30, 64, 200]) for w in sorted(words)}


@pytest.mark.parametrize("cell,sample", [(2048, 1 << 15), (16, 64), (7, 1 << 15)])
def test_spelling_groups(spark, monkeypatch, cell, sample):
    monkeypatch.setattr(spelling, "CELL", cell)
    monkeypatch.setattr(spelling, "SAMPLE", sample)
    monkeypatch.setattr(spelling, "LEAF", 4)
    counts = variants(random.Random(cell), 500)
    got = spelling.variant_groups(spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3))
    assert flat(got) == brute_groups(counts)


def spelling_texts():
    rng = random.Random(5)
    texts = [(i, " ".join(rng.choice(["storm", "Storm,", "storms", "garden", "GARDEN's", "garten", "gardén", "ÉTÉÉÉ", "été×é", "word1word"])
                          for _ in range(rng.randint(0, 40)))) for i in range(300)]
    return texts + [(None, "storm garden null"), (None, None), (7, ""), (7, "storm"), (8, "y" * 5000), (9, "y" * 5000 + " " + "y" * 5000)]


def test_spelling_variants(spark):
    counts = Counter()
    for i, t in spelling_texts():
        for w in re.findall("[a-zÀ-ÿ]+", lower(t or "")):
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            counts[w] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    docs = table(spark, spelling_texts())
    assert flat(spelling.spelling_variants(docs, delete_every=97)) == brute_groups(counts)
    assert spelling.spelling_variants(docs.limit(0)).isEmpty()


def test_reached_cells_hold_every_near_word():
    rng = random.Random(9)
    words = sorted({"".join(rng.choice("abcé") for _ in range(rng.randint(5, 9))) for _ in range(1500)})
    points = spelling.letter_counts(words)
    cells = spelling.Cells(points[::5], 60)
    own, (who, cell) = cells.own(points), cells.reached(points)
    reach = defaultdict(set)
    for i, c in zip(who.tolist(), cell.tolist(), strict=True):
        assert c not in reach[i]
        reach[i].add(c)
    step = points[None] - points[:, None]
    more, less = np.clip(step[..., :-1], 0, None).sum(2), np.clip(-step[..., :-1], 0, None).sum(2)
    for i, j in np.argwhere((more <= 1) & (less <= 1) & (step[..., -1] >= 0)):
        assert own[j] in reach[i]
    assert cells.count > 20 and len(who) < len(words) * cells.count / 2
