"""The operators over training data against brute force, on small tables with nulls, ties, repeats and odd texts."""

import hashlib
import math
import random
import re
import tempfile
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows

from pipekit.llm import (common, language_id, near_dedup, ngram_lm, packing, queries, range_coder, source_mixing, stages, suffix_array,
                         suffix_dedup, tally, token_files, tokens, toxicity, vector_dedup, vp_search)

PATH = queries.tokenizer_path()
DOCS = "doc_id long, text string, source string, lang string, score string, row string, chunk string, node string"
WORDS = "the of and storm river cloud lamp chair window garden silver copper paper letter winter summer".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "ing", "ed", "s"]) for _ in range(n))


def corpus():
    """Copies, near copies, a shared passage, odd texts, a repeated id and a null id."""
    rng = random.Random(4)
    base = [prose(rng, 120) for _ in range(12)]
    shared = prose(rng, 110)
    texts = base + [base[0], base[0] + " tail", "x " + base[1], base[2].replace("river", "lake", 1)]
    texts += [prose(rng, 60) + " " + shared + " " + prose(rng, 50) for _ in range(3)]
    texts += [None, "", "   \n\t", "one", "One", "two words", "é" * 300 + " ÄÖ ﬁ 中文 <|endoftext|>", "Z" * 5000, base[3] * 20]
    out = [(i, t, "abc"[i % 3] if i % 7 else None, "en", "s", "r", "c", "n") for i, t in enumerate(texts)]
    return [*out, (3, base[5], "a", "en", "s", "r", "c", "n"), (None, base[6], "b", "en", "s", "r", "c", "n"),
            (None, None, "b", None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def lowered(text):
    return re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ids_of(text, end):
    return [*tokens.load(PATH)[0].encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


# Range coder and token files


@pytest.mark.parametrize("block", [[], [7], [5] * 4096, list(range(4096)), [1, 2, 3] * 100, [49407, 0] * 9])
def test_blocks_come_back(block):
    others = [np.random.default_rng(2).zipf(1.3, 900) % 49408, np.array(block)]
    for got, want in zip(range_coder.decode_blocks(range_coder.encode_blocks(others, 49408)), others, strict=True):
        assert got.tolist() == want.tolist()


def test_a_damaged_block_is_found():
    coded = bytearray(range_coder.encode_blocks([np.arange(500) % 60], 49408)[0])
    coded[60] ^= 4
    with pytest.raises(ValueError):
        range_coder.decode_blocks([bytes(coded)])
    with pytest.raises(ValueError):
        range_coder.encode_blocks([np.zeros(4097, dtype=int)], 49408)


def test_repetition_is_coded_short():
    assert len(range_coder.encode_blocks([np.tile(np.arange(40), 100)], 49408)[0]) < 400


def test_words_encode_as_whole_texts():
    texts = ["<|endoftext|>a b", "É é 'S don't ̈x a\x85b　c\xa0d", "", None, "\x1c a\x00b", " \n", "日本語 ﬁ ǅ İ ΑΣ ΣΣ."]
    got, counts = tokens.encode(pa.array(texts), PATH, 2)
    assert got.tolist() == [i for t in texts for i in ids_of(t, 2)] and counts.tolist() == [len(ids_of(t, 2)) for t in texts]


def test_token_files(spark, docs, tmp_path):
    path = str(tmp_path / "files")
    token_files.write(docs, path, PATH, 49408, 2)
    got = sorted(token_files.read_documents(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got][:2] == [None, None] and [r["doc_id"] for r in got][2:] == sorted(
        r[0] for r in corpus() if r[0] is not None)
    at = 0
    want = {(r[0], crc(ids_of(r[1], 2)), len(ids_of(r[1], 2))) for r in corpus()}
    for r in got:
        assert r["start"] == at and (r["doc_id"], r["ids_crc32"], r["n_tokens"]) in want
        at += r["n_tokens"]
    pieces = token_files.read_pieces(spark, path, with_ids=True).where("doc_id = 27").orderBy("start").collect()
    assert len(pieces) > 1 and [i for p in pieces for i in p["ids"]] == ids_of(corpus()[27][1], 2)


def test_crc_of_joined_parts():
    data = bytes(range(256)) * 50
    parts = [data[:1], data[1:1], data[1:5000], data[5000:]]
    assert token_files.joined_crc([(len(p), zlib.crc32(p)) for p in parts]) == zlib.crc32(data)


# Vectors


def vectors(spark, n=400):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((n, 16)).astype(np.float32)
    x[50:60] = x[0]
    x[60:70] = x[1] + 0.1 * rng.standard_normal((10, 16)).astype(np.float32)
    data = [(i, [float(v) for v in r], i % 3 if i % 11 else None) for i, r in enumerate(x)]
    bad = [(n, None, 1), (n + 1, [0.0] * 16, 1), (n + 2, [float("nan")] + [1.0] * 15, 1), (n + 3, [None] + [1.0] * 15, 1),
           (n + 4, [1.0, 2.0], 1), (None, [1.0] * 16, 1), (n + 5, [], 1), (n + 20, [float("inf")] * 16, 1)]
    return spark.createDataFrame(data + bad, "vec_id long, embedding array<float>, label int"), x


@pytest.mark.parametrize("factor", [1.0, vp_search.FACTOR])
def test_vp_search(spark, monkeypatch, factor):
    monkeypatch.setattr(vp_search, "LEAF", 8)
    table, x = vectors(spark)
    got = vp_search.nearest(table, table.where("vec_id % 20 = 0"), 5, factor).collect()
    x, found, exact = x.astype(float), {}, 0
    for r in got:
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for q in range(0, 400, 20):
        s = [(-float((x[q] * x[i]).sum()), i) for i in range(400) if i != q]
        want = [(k, i, -v) for k, (v, i) in enumerate(sorted(s)[:5], 1)]
        exact += len({w[1] for w in want} & {f[1] for f in found[q]})
        assert [f[0] for f in sorted(found[q])] == [1, 2, 3, 4, 5]
        if factor == 1:
            assert sorted(found[q]) == want
    assert exact >= 90
    assert vp_search.nearest(table.where("false"), table, 5).count() == 0


def test_rows_with_one_vec_id_search_on_their_own(spark, monkeypatch):
    monkeypatch.setattr(vp_search, "LEAF", 8)
    x = np.random.default_rng(6).standard_normal((120, 8))
    ids = [*range(100), *[0] * 10, *[20] * 10]  # 0: equal rows, 20: different ones
    x[100:110] = x[0]
    schema = "vec_id long, embedding array<double>"
    table = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x, strict=True)], schema)
    got = Counter(tuple(r) for r in vp_search.nearest(table, table.where("vec_id % 20 = 0"), 5, 1.0).collect())
    want = Counter()
    for i, q in zip(ids, x, strict=True):
        if i % 20 == 0:
            near = sorted((-float((q * v).sum()), j) for j, v in zip(ids, x, strict=True) if j != i)[:5]
            want.update((i, k, j, -s) for k, (s, j) in enumerate(near, 1))
    assert got == want


def test_a_task_holds_one_shard_and_one_block(spark, monkeypatch, tmp_path):
    for name, n in (("SHARD_ROWS", 100), ("BLOCK_ROWS", 32), ("QUERY_ROWS", 8)):
        monkeypatch.setattr(vp_search, name, n, raising=False)
    table, _ = vectors(spark)
    matrix, seen = vp_search.matrix, str(tmp_path)

    def noted(column):
        tempfile.mkstemp(f"-{len(column)}", dir=seen)
        return matrix(column)

    monkeypatch.setattr(vp_search, "matrix", noted)
    got = vp_search.nearest(table, table, 5, 1.0).collect()
    sizes = sorted(int(p.name.rsplit("-")[-1]) for p in tmp_path.iterdir())
    # 5 shards of about 80 rows, each with each of 13 blocks of about 31.
    assert len(got) == 400 * 5 and sizes[-1] < 130 and sizes[len(sizes) // 2 - 1] < 60


def test_near_vectors(spark):
    table, x = vectors(spark)
    got = {r["vec_id"]: r for r in vector_dedup.near_vectors(table).where("vec_id is not null").collect()}
    x = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    label = [i % 3 if i % 11 else None for i in range(400)]
    near = [[j for j in range(400) if j != i and label[i] is not None and label[i] == label[j] and x[i] @ x[j] >= 0.93]
            for i in range(400)]
    comp = list(range(400))
    for _ in range(400):
        new = [min([comp[i], *[comp[j] for j in near[i]]]) for i in range(400)]
        if new == comp:
            break
        comp = new
    assert [got[i]["n_links"] for i in range(400)] == [len(n) for n in near] and sum(map(len, near)) > 20
    assert [got[i]["component_id"] for i in range(400)] == comp
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in (400, 401, 402, 403, 405, 420))
    assert vector_dedup.near_vectors(table.where("false")).count() == 0


# Texts


def test_near_duplicates(spark, docs, empty):
    got = Counter(tuple(r) for r in near_dedup.near_duplicates(docs).collect())
    sets = []
    for r in corpus():
        w = lowered(r[1])
        sets.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    comp = list(range(len(sets)))
    for _ in comp:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 75 * len(a | b):
                    comp[i] = comp[j] = min(comp[i], comp[j])
    ids = [r[0] for r in corpus()]
    want = Counter()
    for i, a in enumerate(sets):
        known = [ids[j] for j in range(len(ids)) if comp[j] == comp[i] and ids[j] is not None]
        least = min(known) if known and a else ids[i]
        want[(ids[i], len(a), least, ids[i] == least)] += 1
    assert got == want
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns and {0, 1, 2}.issubset({r[0] for r in rows(kept.where("doc_id is not null"), "doc_id")})
    assert near_dedup.near_duplicates(empty).count() == 0


def test_one_row_of_each_group_is_kept(spark):
    rng = random.Random(8)
    a, b, c, d = (prose(rng, 120) for _ in range(4))
    # A repeated row, an id whose other row is a near copy of a smaller id, copies without an id, rows without words.
    data = [(5, a, "s"), (5, a, "s"), (6, b, "s"), (7, b + " tail", "s"), (7, c, "s"), (None, d, "s"), (None, d, "t"),
            (None, d, "s"), (8, "", "s"), (8, None, "s"), (None, " ", "s"), (None, None, "s")]
    kept = near_dedup.keep_one(spark.createDataFrame(data, "doc_id long, text string, source string").repartition(3))
    got = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    wordless = [(8, ""), (8, None), (None, " "), (None, None)]
    assert got == Counter([(5, a), (6, b), (7, c), (None, d), *wordless])
    left = suffix_dedup.without_repeats(kept)
    assert Counter((r["doc_id"], r["text"]) for r in left.collect() if (r["text"] or "").strip()) == Counter(
        [(5, a), (6, b), (7, c), (None, d)])


def test_totals_go_beyond_32_bits(spark):
    keys = np.array([3, 5, 1 << 63], dtype=np.uint64)
    parts = [tally.requests(chunk, 0, keys, np.array([[3_000_000_000, 1], [7, 0], [1, 4_294_967_295]], dtype=np.uint32), 4)
             for chunk in (1, 2)]
    asked = spark.createDataFrame(pa.Table.from_batches(parts).to_pandas(), tally.REQUEST)
    got = tally.tally(asked).toArrow()
    for chunk in (1, 2):
        mine = got.filter(pa.compute.equal(got.column("chunk"), chunk))
        assert tally.totals_of(mine, 0, 2).tolist() == [[6_000_000_000, 2], [14, 0], [2, 8_589_934_590]]


def test_near_copies_just_under_and_over_the_threshold(spark):
    """Families whose copies share a template: which pairs link depends on a few words each; some links are met only
    outside the least pivot's bucket."""
    rng = random.Random(21)
    texts = []
    for family in range(4):
        base = prose(rng, 90).split()
        for _ in range(22):
            words = list(base)
            for k in rng.sample(range(len(words) - 12), rng.choice([0, 1, 2, 3, 4])):
                words[k] = f"w{rng.randrange(6)}f{family}"
            texts.append(" ".join(words + [f"t{rng.randrange(5)}"] * rng.choice([0, 1, 9])))
    data = list(enumerate(texts))
    got = dict(near_dedup.near_duplicates(spark.createDataFrame(data, "doc_id long, text string").repartition(4)).select(
        "doc_id", "component_id").collect())
    sets = [{tuple(w[k:k + 5]) for k in range(len(w) - 4)} for w in (lowered(t) for t in texts)]
    comp = list(range(len(sets)))
    for _ in range(12):
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if 100 * len(a & b) >= 75 * len(a | b):
                    comp[i] = comp[j] = min(comp[i], comp[j])
    assert [got[i] for i in range(len(sets))] == comp
    assert 4 < len(set(comp)) < 80


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(1)
    a = rng.integers(1, 1 << 62, 300).astype(np.uint64)
    b = np.concatenate([a[:240], rng.integers(1, 1 << 62, 60).astype(np.uint64)])
    table = near_dedup.sketch(np.concatenate([a, b, a[:1]]), np.array([300, 300, 1, 0]))
    assert (table[:3] != near_dedup.EMPTY).all() and (table[3] == near_dedup.EMPTY).all()
    assert abs((table[0] == table[1]).mean() - 240 / 360) < 0.17


def cut_by_hand(data):
    """(id, bytes, removed, runs, digest) of each text, by counting every window."""
    seen = Counter(hash(t[i:i + 400]) for _, t in data for i in range(len(t) - 399))
    out = Counter()
    for doc_id, t in data:
        edge = np.zeros(len(t) + 1, dtype=int)
        for i in range(len(t) - 399):
            if seen[hash(t[i:i + 400])] > 1:
                edge[i] += 1
                edge[i + 400] -= 1
        gone = np.cumsum(edge[:-1]) > 0
        kept = np.frombuffer(t, dtype=np.uint8)[~gone].tobytes()
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[(doc_id, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())] += 1
    return out


def test_remove_repeats(spark, docs, empty):
    found = suffix_dedup.remove_repeats(docs).collect()
    got = Counter(tuple(r)[:5] for r in found)
    assert got == cut_by_hand([(r[0], (r[1] or "").encode()) for r in corpus()])
    assert all(r.n_shared > 0 for r in found if r.n_removed > 800) and all(r.n_shared == 0 for r in found if r.n_bytes < 400)
    assert suffix_dedup.without_repeats(docs).columns == docs.columns
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_passages_of_over_fifty_words_are_cut(spark):
    """The pipeline's stage cuts passages that are longer than 50 words and shorter than the 400 bytes of the query."""
    rng = random.Random(51)
    passages = [prose(rng, 51) for _ in range(4)]
    assert all(len(p.encode()) < 400 for p in passages)
    clean = [(k, prose(rng, 120)) for k in range(8)]
    data = clean + [(10 + 4 * copy + k, f"{prose(rng, 60)} {p} {prose(rng, 60)}") for k, p in enumerate(passages) for copy in range(2)]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    left = dict(stages.cut_repeats(spark, docs, "").collect())
    assert all(left[k] == t for k, t in clean)
    for k, text in data[len(clean):]:
        assert 0 < len(text) - len(left[k]) < 420 and not any(p in left[k] for p in passages)
    # Every byte, counted by hand.
    texts = [t.encode() for _, t in data]
    seen = Counter(t[i:i + 200] for t in texts for i in range(len(t) - 199))
    for k, t in zip([k for k, _ in data], texts, strict=True):
        gone = {j for i in range(len(t) - 199) if seen[t[i:i + 200]] > 1 for j in range(i, i + 200)}
        assert left[k] == bytes(b for j, b in enumerate(t) if j not in gone).decode()


def test_repeats_across_segments(spark):
    """A text of more than a segment, with passages over and beside the border that start elsewhere too."""
    rng = random.Random(31)
    long = "".join(rng.choices("abcdefgh ", k=suffix_dedup.SEGMENT + 60_000))
    border = suffix_dedup.SEGMENT
    parts = [long[border - 700:border + 500], long[border - 399:border + 1], long[border - 400:border], long[border:border + 400],
             long[border + 3000:border + 3399], long[20:420]]
    data = [(1, long), *[(2 + k, "x" * k + p + "y" * (7 * k + 1)) for k, p in enumerate(parts)], (9, long[border - 2000:border + 2000])]
    got = Counter(tuple(r)[:5] for r in suffix_dedup.remove_repeats(spark.createDataFrame(data, "doc_id long, text string")).collect())
    assert got == cut_by_hand([(i, t.encode()) for i, t in data])


def test_recursion_takes_names_that_go_on(spark, monkeypatch):
    """Two copies of a short run among names that occur once; suffixes are in order, and few go into the recursion."""
    names = [*range(100, 130), 7, 7, 8, 9, 7, 8, *range(200, 230), 7, 7, 8, 9, 7, 8, *range(300, 330), 1]
    deeper, whole = [], suffix_array.suffix_ranks

    def seen(strings, enough):
        deeper.append(strings.count())
        return whole(strings, enough)
    monkeypatch.setattr(suffix_array, "suffix_ranks", seen)
    data = [(0, i, n, 1) for i, n in enumerate(names)]
    got = whole(spark.createDataFrame(data, "chunk long, i long, name long, cover long"), 400).orderBy("rank").collect()
    assert [r.i for r in got] == sorted(range(len(names)), key=lambda i: names[i:])
    assert deeper and max(deeper) <= 20  # of 103, two thirds before


def test_texts_are_made_only_where_asked(docs):
    assert "text" not in suffix_dedup.cut_repeats(docs, with_text=False).columns


def test_stages_give_heap_back(spark, docs, monkeypatch):
    common.free_heaps(spark)
    calls = []
    monkeypatch.setattr(stages, "free_heaps", lambda s: calls.append(s))
    stages.stage(lambda s, d, sf: d)(spark, docs, "")
    assert calls == [spark]


def test_small_segments_see_the_same_windows(monkeypatch):
    rng = np.random.default_rng(7)
    data = rng.integers(97, 101, 30_000).astype(np.uint8)
    ends = np.array([5000, 5100, 17_000, 30_000])
    places = np.sort(rng.choice(29_000, 500, replace=False))

    def seen():
        return [*suffix_dedup.anchor_windows(data, ends), suffix_dedup.range_hashes(data, places, np.full(500, 400))]
    want = seen()
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 4096)
    got = seen()
    assert (got[3] == want[3]).all() and got[2].sum() == want[2].sum()
    for g, w in zip(got[:3], want[:3], strict=True):
        assert len(g) == len(w) and (g == w).all()


def test_language_model(spark, docs, empty):
    got = {r["doc_id"]: r for r in ngram_lm.score(docs).collect() if r["doc_id"] not in (None, 3)}
    texts = [(r[0], [*lowered(r[1]), None]) for r in corpus()]
    train = [t for i, t in texts if zlib.crc32(b"" if i is None else str(i).encode()) % 5 != 1]
    count = Counter(w for t in train for w in t)
    n, v = sum(count.values()), len(count)
    for i, t in texts:
        if i in got:
            base = sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
            assert got[i]["base_score"] == pytest.approx(base, abs=1e-9) and got[i]["n_tokens"] == len(t)
            assert got[i]["n_known"] == sum(count[w] > 0 for w in t) and got[i]["train_tokens"] == n
            assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 1) and math.isfinite(got[i]["score"])
    assert sum(r["score"] for r in got.values()) > sum(r["base_score"] for r in got.values())
    assert ngram_lm.score(empty).count() == 0


def test_interpolated_score_against_single_tokens(spark, docs):
    """The whole model by hand, token by token; the operator sums held-out tokens in cells, so weights differ a little."""
    texts = [(r[0], ["<s>", *lowered(r[1]), None]) for r in corpus()]

    def fold_of(i):
        return zlib.crc32(b"" if i is None else str(i).encode()) % 5

    def counted(folds):
        some = [t for i, t in texts if fold_of(i) in folds]
        return Counter(w for t in some for w in t), Counter(p for t in some for p in zip(t, t[1:]))

    def estimates(t, uni, bi, total):
        return [(min(uni[a].bit_length(), 31), bi[a, b] / uni[a] if uni[a] else 0.0, uni[b] / total) for a, b in zip(t, t[1:])]

    uni, bi = counted({0, 2, 3, 4})
    total, uniform = sum(uni.values()) - uni["<s>"], 1 / len(uni)
    less, less_bi = counted({0, 3, 4})
    held = [e for i, t in texts if fold_of(i) == 2 for e in estimates(t, less, less_bi, sum(less.values()) - less["<s>"])]
    assert held
    weights = {}
    for bucket in {e[0] for e in held}:
        mine, w = [e[1:] for e in held if e[0] == bucket], (1 / 3,) * 3
        for _ in range(60):
            sums = [1.0] * 3
            for two, one in mine:
                share = [w[0] * two, w[1] * one, w[2] * uniform]
                sums = [a + b / sum(share) for a, b in zip(sums, share)]
            w = [x / (len(mine) + 3) for x in sums]
        weights[bucket] = w
    got = {r["doc_id"]: r["score"] for r in ngram_lm.score(docs).collect() if r["doc_id"] not in (None, 3)}
    for i, t in texts:
        if i in got:
            want = 0.0
            for bucket, two, one in estimates(t, uni, bi, total):
                w = weights[min(weights, key=lambda k: (abs(k - bucket), k))]
                want += math.log10(w[0] * two + w[1] * one + w[2] * uniform)
            assert got[i] == pytest.approx(want, rel=0.02), i


def test_mixture_weights_are_expected():
    cells = pa.table({"bucket": [4, 4], "n": [90, 10], "two": [45.0, 0.0], "one": [0.9, 0.1]})
    weights = ngram_lm.learn_weights(cells, 1e-4)
    assert weights.sum(axis=1) == pytest.approx(1) and weights[4, 0] > 0.85 and (weights[9] == weights[4]).all()


def test_language_id(spark, empty):
    syllables = {"aa": "da ru mi ko", "ab": "da ru mi po", "ba": "strk vlt gnz mrk", "bb": "strk vlt gnz plk"}
    rng = random.Random(5)
    data = []
    for i in range(400):
        lang = sorted(syllables)[i % 4]
        words = ["".join(rng.choice(syllables[lang].split()) for _ in range(rng.randint(1, 3))) for _ in range(60)]
        data.append((i, " ".join(words), lang, "x"))
    odd = [(900, None, "aa", "x"), (901, "12 345 !!", "ba", "x"), (902, "", None, "x"), (None, data[0][1], None, "x")]
    table = spark.createDataFrame(data + odd, "doc_id long, text string, lang string, lang_pred string")
    model = language_id.train(table.where("doc_id is null or doc_id % 5 <> 3 or doc_id >= 900"))
    assert sorted(map(sorted, model.families)) == [[0, 1], [2, 3]]
    got = language_id.predict(table, model).collect()
    assert sum(r["lang_pred"] == r["lang"] for r in got if r["doc_id"] is not None and r["doc_id"] < 400) >= 396
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in got if (r["doc_id"] or 0) >= 900)
    assert language_id.keep_identified(table, model).count() == 401
    nothing = language_id.train(table.where("false"))
    assert {r["lang_pred"] for r in language_id.predict(table, nothing).collect()} == {"und"}
    assert language_id.predict(empty, model).count() == 0


def test_every_language_is_learned(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MOST_LANGUAGES", 2, raising=False)
    words = {"aa": "kama", "bb": "torve", "cc": "ulmi", "dd": "sexto"}
    data = [(i, " ".join([words[lang]] * (i % 5 + 3)), lang) for i, lang in enumerate([*words] * 6)]
    table = spark.createDataFrame(data, "doc_id long, text string, lang string")
    model = language_id.train(table)
    assert model.languages == [*words]
    assert all(r["lang_pred"] == r["lang"] for r in language_id.predict(table, model).collect())


def test_an_id_on_many_rows_sends_a_bounded_sample(spark):
    table = spark.createDataFrame([(1, "same words again", "aa")] * 300 + [(1, f"other words {i}", "bb") for i in range(300)],
                                  "doc_id long, text string, lang string").repartition(5)
    got = language_id.sample_rows(table, 10)
    assert sorted(r.lang for r in got.select("lang").collect()) == ["aa"] * 10 + ["bb"] * 10
    assert len({r.text for r in got.where("lang = 'bb'").collect()}) == 10


def test_toxicity(spark, empty):
    rng = random.Random(6)
    data, labels = [], []
    for i in range(900):
        bad = i % 5 == 0
        words = prose(rng, 40).split()
        for _ in range(3 * bad):
            words.insert(rng.randrange(len(words)), rng.choice(["zorgle", "kwibbex"]) + rng.choice(["", "s", "an"]))
        data.append((i, " ".join(words), "x"))
        labels.append((i, int(bad)))
    table = spark.createDataFrame([*data, (2000, None, "x"), (2001, "", "x"), (None, "z o r g l e, you zorgxle kwibbex", "x")],
                                  "doc_id long, text string, predicted string")
    marks = spark.createDataFrame([*labels, (5000, 1), (None, 1), (7, None), (5, 1)], "doc_id long, toxic int")
    model = toxicity.train(table.where("doc_id % 3 <> 1"), marks)
    got = {r["doc_id"]: r for r in toxicity.score(table, model).collect()}
    held = [i for i in range(900) if i % 3 == 1]
    assert all(got[i]["predicted"] == (i % 5 == 0) for i in held)
    assert got[None]["predicted"] == 1 and got[2000]["predicted"] == got[2001]["predicted"] == 0
    assert all(0 <= r["score"] <= 1 for r in got.values())
    silent = toxicity.train(table, marks.where("false"))
    assert {r["predicted"] for r in toxicity.score(table, silent).collect()} == {0}
    assert toxicity.score(empty, model).count() == 0


def test_toxicity_samples_rows_not_ids(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(400)] + [(2, "other")], "doc_id long, text string").repartition(4)
    marks = spark.createDataFrame([(1, 1), (2, 0), (1, 1)], "doc_id long, toxic int")
    assert toxicity.sample_rows(docs, marks, 10).groupBy("toxic").count().orderBy("toxic").collect() == [(0, 1), (1, 10)]


@pytest.mark.parametrize("word", ["cat", "gatta", "insult", "abcabcab"])
def test_subsequence_weights_against_direct_count(word):
    """Three-letter subsequences of a word with their decayed spans, counted one by one."""
    from itertools import combinations
    direct = Counter()
    n = toxicity.LETTERS
    codes = toxicity.letters([word]).flat.tolist()
    for places in combinations(range(len(codes)), 3):
        if places[2] - places[0] + 1 <= toxicity.SPAN:
            a, b, c = (codes[k] for k in places)
            direct[(a * n + b) * n + c] += toxicity.DECAY ** (places[2] - places[0] + 1)
    have = toxicity.explicit(toxicity.letters([word]))[:, 0]
    want = np.zeros(n ** 3)
    for k, v in direct.items():
        want[k] += v
    assert np.allclose(have, want / toxicity.NORMS[len(codes)], atol=1e-5) and (have > 0).sum() == len(direct)
    # The same product through the table of the scorer.
    table = np.random.default_rng(1).random(n ** 3).astype(np.float32)
    assert toxicity.weigh(toxicity.letters([word]), table)[0] == pytest.approx(float(have @ table), rel=1e-4)


# Packing and mixing


def test_packing(spark, docs, empty):
    got = packing.pack_documents(docs, PATH, 1, 256, with_ids=True).collect()
    want = Counter()
    for r in corpus():
        ids = ids_of(r[1], 1)
        want.update((r[0], k, k * 256, min(256, len(ids) - k * 256), crc(ids[k * 256:(k + 1) * 256]))
                    for k in range(-(-len(ids) // 256)))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(r["length"] for r in got)
    sizes = sorted((r["length"] for r in got), reverse=True)
    assert len(bins) <= len(packing.best_fit(list(range(len(sizes))), sizes, 256, []))
    laid = packing.sequences(spark.createDataFrame(got)).collect()
    assert len(laid) == len(bins) and sum(len(r["ids"]) for r in laid) == total
    assert packing.pack_documents(empty, PATH).count() == 0


def test_several_shards_share_their_remainders(spark):
    rng = random.Random(8)
    sizes = [rng.randint(1, 60) for _ in range(900)]
    pieces = spark.createDataFrame(list(enumerate(sizes)), "uid long, n long")
    got = packing.pack_pieces(pieces, 100, 120).collect()
    loads = Counter()
    for r in got:
        loads[r["sequence_id"]] += sizes[r["uid"]]
    assert len(got) == 900 and max(loads.values()) <= 100 and len(loads) <= -(-sum(sizes) // 100) + 4


def test_mixture(spark, docs, empty, monkeypatch):
    monkeypatch.setattr(source_mixing, "LEAST_BLOCK", 40)
    size = {r[1]: len(lowered(r[1])) + 1 for r in corpus()}
    sums = Counter()
    for r in corpus():
        sums[r[2]] += size[r[1]]
    drawn = source_mixing.mixture(docs, max_epochs=1.3).collect()
    got = Counter()
    for r in drawn:
        got[r["source"]] += r["n_tokens"]
        assert r["n_tokens"] == size[r["row"]["text"]]
    weight = {r["source"]: r["weight"] for r in drawn}
    assert sum(weight.values()) == pytest.approx(1) and set(weight) == set(sums)
    budget = max(sums[s] / weight[s] for s in sums)
    longest = max(size.values())
    for s in sums:
        quota = budget * weight[s]
        assert quota / sums[s] <= 1.3 + 1e-3 and quota - longest - 1 <= got[s] <= quota + 1
    rows_of = Counter((r["row"]["doc_id"], r["row"]["text"]) for r in drawn if r["epoch"] == 0)
    assert rows_of == Counter((r[0], r[1]) for r in corpus())
    assert source_mixing.mixed_documents(docs).columns == docs.columns
    assert source_mixing.mixture(empty).count() == 0


def test_exponent_meets_an_entropy(spark):
    share = {"a": 0.7, "b": 0.2, "c": 0.1}
    sources = spark.createDataFrame([(int(1000 * v), v) for v in share.values()], "tokens long, share double")
    exponent = source_mixing.find_exponent(sources, target_entropy=1.0)
    p = np.array(list(share.values())) ** exponent
    p /= p.sum()
    assert -(p * np.log(p)).sum() == pytest.approx(1.0, abs=1e-6)
    assert source_mixing.find_exponent(sources, target_entropy=2.0) == 0.0


def test_ids_are_laid_out_without_an_index_of_each():
    """Ids of texts, also of a slice of them, equal the tokenizer's; laying them out takes few bytes an id beside them."""
    import tracemalloc
    path, (tokenizer, _) = PATH, tokens.load(PATH)
    plain = ["xqzvkj wwpqxz " * 3, None, "", " a,b  C! "]
    ids, counts = tokens.encode(pa.array(["zz", *plain]).slice(1), path, end=1)
    want = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for t in plain]
    assert ids.tolist() == [i for w in want for i in w] and counts.tolist() == [len(w) for w in want]
    long = pa.array(["xqzvkjwwpqxzjjqvxkzq " * 20000])
    tokens.encode(long, path, end=1)
    tracemalloc.start()
    ids, _ = tokens.encode(long, path, end=1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(ids) > 5 * 20000 and peak < 8 * len(ids)


def test_chunks_are_read_one_at_a_time_and_memory_is_given_back(monkeypatch):
    batch = pa.RecordBatch.from_pylist([{"chunk": k, "texts": b"x" * k} for k in range(5)]).slice(1)
    given_back = []
    monkeypatch.setattr(common.ctypes, "CDLL", lambda _: type("C", (), {"malloc_trim": given_back.append}))
    whole = batch.to_pylist()
    assert list(common.one_by_one(batch)) == whole
    assert list(common.lean(lambda batches: (b for b in batches))(iter([batch]))) == [batch] and given_back == [0]
