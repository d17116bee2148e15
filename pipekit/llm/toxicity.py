"""Toxicity by a support vector machine over a gap-weighted subsequence kernel (Lodhi and others, 2002) with Nystrom
landmarks.

The kernel compares words by the three-letter subsequences they share, each weighted by DECAY to the length it spans
(at most SPAN places), so an insult with letters put between its own, or spread over single letters, stays close to
itself, and so do the words built on one stem. Landmarks are insults and look-alikes from the labelled sample; the
machine is trained on Nystrom features, the kernel values against the landmarks whitened by their own kernel matrix. A
sum over landmarks is linear in the subsequences, so the trained machine is one weight for each three-letter
subsequence, and a word costs a few look-ups.

Labels belong to documents. Words that occur in toxic documents and hardly in others start as positives, words of
clean documents are negatives. A document's score is a logistic function of its strongest word, of the sum of its
positive margins and of its length, fitted on the half of the sample that the word machine has not seen.

The sample is bounded: ``SAMPLE`` toxic and twice as many clean rows with the smallest hashes of id and text; the word
machine takes the ``TOXIC_WORDS`` most frequent words of the first, the ``CLEAN_WORDS`` most frequent of the second and
``RARE_WORDS`` of those that occur once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pipekit.llm.common import filled, hash_words, mix, ship, spans, text_slices
from pipekit.session import durable

# Bounds of what the models are fitted on; every document is scored whole, whatever they are.
SAMPLE = 3000
TOXIC_WORDS, CLEAN_WORDS, RARE_WORDS = 1500, 12_000, 18_000
RATE = 20  # a toxic word is this many times as frequent in toxic documents as in clean ones
LETTERS = 48
SPAN = 7
DECAY = 0.6
POSITIVE_MARKS, NEGATIVE_MARKS = 80, 64
PART, STEP = 28, 14
COMMON = 0.03  # share of the toxic documents that hold a common insult
INSERTED = 0.3  # weight of a word with a letter put in, against the word itself
SHORT = 2


def _codes() -> np.ndarray:
    """A number for each character of the basic plane: a-z 1 to 26, other letters share the numbers above, the rest 0."""
    table = np.zeros(1 << 16, dtype=np.int32)
    for c in range(1 << 16):
        if 0xD800 <= c < 0xE000:
            continue
        low = chr(c).lower()
        if low.isalpha():
            table[c] = ord(low[0]) - 96 if "a" <= low[0] <= "z" else 27 + ord(low[0]) % (LETTERS - 27)
    return table


CODES = _codes()


@dataclass
class Words:
    """Letters of many words, one after another, with the place and length of each."""
    flat: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray

    def parts(self) -> tuple[Words, np.ndarray]:
        """Long words as overlapping parts that cover them whole, and how many parts each word has."""
        each = np.where(self.sizes > PART, -(-(self.sizes - PART) // STEP) + 1, 1)
        of = np.repeat(np.arange(len(self.sizes)), each)
        within = (np.arange(len(of)) - np.repeat(np.cumsum(each) - each, each)) * STEP
        return Words(self.flat, self.starts[of] + within, np.minimum(self.sizes[of] - within, PART)), each

    def join(self, of: np.ndarray, groups: np.ndarray) -> Words:
        """Words ``of`` run together, ``groups`` of them at a time, appended to these words."""
        sizes = self.sizes[of]
        at = spans(sizes)
        more = self.flat[np.repeat(self.starts[of] - at[:-1], sizes) + np.arange(at[-1])]
        ends = at[spans(groups)]
        return Words(np.concatenate([self.flat, more]), np.concatenate([self.starts, len(self.flat) + ends[:-1]]),
                     np.concatenate([self.sizes, np.diff(ends)]))


def letters(words: list[str]) -> Words:
    """The letters of each word alone; what else stands between them is no gap."""
    points = np.frombuffer("".join(words).encode("utf-32-le", "replace"), dtype=np.uint32)
    codes = np.where(points < (1 << 16), CODES[np.minimum(points, 0xFFFF)], 27 + points % (LETTERS - 27)).astype(np.int32)
    kept = np.concatenate([[0], np.cumsum(codes > 0)])[spans([len(w) for w in words])]
    return Words(codes[codes > 0], kept[:-1], np.diff(kept))


def _triples(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    t = [(i, j, k) for i in range(n) for j in range(i + 1, min(n, i + SPAN)) for k in range(j + 1, min(n, i + SPAN))]
    a = np.array(t, dtype=np.int64).reshape(-1, 3)
    return a[:, 0], a[:, 1], a[:, 2], (DECAY ** (a[:, 2] - a[:, 0] + 1)).astype(np.float32)


TRIPLES = [_triples(n) for n in range(PART + 1)]
#: Norm of a word of n different letters.
NORMS = np.array([max(1e-6, float(np.sqrt((t[3] ** 2).sum()))) for t in TRIPLES], dtype=np.float32)


def weigh(words: Words, table: np.ndarray) -> np.ndarray:
    """Product of each word's normed subsequence vector with ``table`` (subsequences, or subsequences by columns)."""
    out = np.zeros((len(words.sizes), *table.shape[1:]), dtype=np.float32)
    columns = [table] if table.ndim == 1 else [np.ascontiguousarray(table[:, c]) for c in range(table.shape[1])]
    for n in np.unique(words.sizes):
        if n < 3:
            continue
        i, j, k, weight = TRIPLES[n]
        every = np.flatnonzero(words.sizes == n)
        for first in range(0, len(every), 4096):
            of = every[first:first + 4096]
            x = words.flat[words.starts[of][:, None] + np.arange(n)]
            code = (x[:, i] * LETTERS + x[:, j]) * LETTERS + x[:, k]
            for c, column in enumerate(columns):
                got = (column[code] @ weight) / NORMS[n]
                if table.ndim == 1:
                    out[of] = got
                else:
                    out[of, c] = got
    return out


def explicit(words: Words) -> np.ndarray:
    """The normed subsequence vectors of a few words, as columns."""
    out = np.zeros((LETTERS ** 3, len(words.sizes)), dtype=np.float32)
    for c, (start, n) in enumerate(zip(words.starts, words.sizes, strict=True)):
        i, j, k, weight = TRIPLES[n]
        x = words.flat[start:start + n]
        np.add.at(out[:, c], (x[i] * LETTERS + x[j]) * LETTERS + x[k], weight / NORMS[n])
    return out


@dataclass
class ToxicityModel:
    table: np.ndarray
    bias: float
    logistic: np.ndarray

    def margins(self, words: Words) -> np.ndarray:
        """Margin of each word; a long word has its strongest part's, a word of fewer than three letters the bias."""
        parts, each = words.parts()
        if not len(each):
            return np.zeros(0, dtype=np.float32)
        return np.maximum.reduceat(weigh(parts, self.table) + self.bias, spans(each)[:-1])


def units(texts: pa.Array) -> tuple[Words, np.ndarray, np.ndarray]:
    """(units, number of the text each stands in, number of its unit): the words, and each run of three or more words
    of one or two letters as one more unit, since it may spell another word."""
    parts = pc.ascii_split_whitespace(filled(texts))
    offsets = parts.offsets.to_numpy().astype(np.int64)
    coded = parts.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    offsets = offsets - offsets[0]
    words = letters(coded.dictionary.to_pylist())
    codes = coded.indices.to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    if not len(codes):
        return words, doc, codes
    small = words.sizes[codes] <= SHORT
    fresh = np.ones(len(codes), dtype=bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | ~small[:-1]
    begin = np.flatnonzero(small & fresh)
    run = np.cumsum(small & fresh) - 1
    length = np.bincount(run[small], minlength=len(begin))
    long = length >= 3
    member = np.flatnonzero(small)
    member = member[long[run[member]]]
    joined = words.join(codes[member], length[long])
    return joined, np.concatenate([doc, doc[begin[long]]]), np.concatenate(
        [codes, len(words.sizes) + np.arange(int(long.sum()))])


def document_features(model: ToxicityModel, texts: pa.Array) -> np.ndarray:
    """Strongest margin, logarithm of the sum of positive margins, and of the number of different units."""
    words, doc, codes = units(texts)
    out = np.zeros((len(texts), 3))
    out[:, 0] = -1.5
    # A unit counts once for a text, however often it stands there.
    pairs = np.unique(doc << 32 | codes)
    of, codes = pairs >> 32, pairs & 0xFFFFFFFF
    margins = model.margins(words)[codes] if len(codes) else np.zeros(0)
    some, at, different = np.unique(of, return_index=True, return_counts=True)
    if len(some):
        out[some, 0] = np.clip(np.maximum.reduceat(margins, at), -1.5, 2)
        out[some, 1] = np.log1p(np.add.reduceat(np.maximum(margins, 0), at))
        out[some, 2] = np.log1p(different) / 10
    return out


def fit_machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.02) -> np.ndarray:
    """Linear SVM with squared hinge loss, by Newton steps over the active rows; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    keep = ridge * np.eye(x.shape[1])
    keep[-1, -1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(50):
        active = y * (x @ w) < 1
        a = x[active] * weight[active, None]
        new = np.linalg.solve(a.T @ x[active] + keep, a.T @ y[active])
        if np.allclose(new, w, atol=1e-7):
            break
        # Half a step keeps the active set from flipping to and fro.
        w = new if not w.any() else 0.5 * w + 0.5 * new
    return w


def word_lists(learned: DataFrame) -> tuple[list[tuple[str, int]], list[str], int]:
    """(toxic words with their documents, clean words, toxic documents) from rows (toxic, words). Words are counted in
    tasks; no more than TOXIC_WORDS, CLEAN_WORDS and RARE_WORDS reach the driver."""
    n = learned.agg(F.count_if(F.col("toxic") == 1).alias("t"), F.count_if(F.col("toxic") == 0).alias("c")).first()
    n_toxic, n_clean = n["t"] + 1, n["c"] + 1
    counts = learned.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(
        F.count_if(F.col("toxic") == 1).alias("t"), F.count_if(F.col("toxic") == 0).alias("c"))
    rate = F.when(F.col("t") >= 3, (F.col("t") + 0.1) / n_toxic / ((F.col("c") + 0.1) / n_clean))
    counts = durable(counts.withColumn("rate", rate), "toxicity-words")
    ranked = counts.where((F.col("rate") >= RATE) & (F.length("word") >= 3)).orderBy(F.desc("t"), "word").limit(TOXIC_WORDS)
    common = counts.where((F.col("c") >= 2) & (F.coalesce("rate", F.lit(0)) < 2)).orderBy(F.desc("c"), "word").limit(CLEAN_WORDS)
    rare = counts.where("c = 1 and t = 0").orderBy(F.xxhash64("word"), "word").limit(RARE_WORDS)
    return ([(r["word"], r["t"]) for r in ranked.collect()],
            [r["word"] for r in common.collect()] + [r["word"] for r in rare.collect()], n_toxic)


def fit_words(counted: list[tuple[str, int]], negative: list[str], n_toxic: int) -> tuple[np.ndarray, float]:
    """The word machine from :func:`word_lists`: subsequence weights and bias."""
    toxic, ranked = dict(counted), [w for w, _ in counted]
    # The common ones also with a letter put in, at a place and with a letter that their hash deals.
    often = [w for w in ranked if toxic[w] >= COMMON * n_toxic]
    gapped = []
    for w, h in zip(often, [int(h) for h in hash_words(pa.array(often, pa.string()))], strict=True):
        place = 1 + h % (len(w) - 1)
        gapped.append(w[:place] + chr(97 + (h >> 20) % 26) + w[place:])
    positive, parts_each = letters(ranked + gapped).parts()
    negative, _ = letters(negative).parts()
    if not len(positive.sizes) or not len(negative.sizes):
        return np.zeros(LETTERS ** 3, dtype=np.float32), -1.0
    heavy = np.repeat(np.array([toxic[w] for w in ranked] + [toxic[w] * INSERTED for w in often], dtype=np.float32),
                      parts_each)

    def some(of: Words, rows: list[int]) -> Words:
        return Words(of.flat, of.starts[rows], of.sizes[rows])

    # Landmarks: frequent positives that are not yet well covered, then the negatives most like them.
    marks: list[int] = []
    covered = np.zeros(len(positive.sizes), dtype=np.float32)
    for _ in range(min(POSITIVE_MARKS, len(covered))):
        k = int((heavy * np.maximum(0, 1 - covered)).argmax())
        marks.append(k)
        covered = np.maximum(covered, weigh(positive, explicit(some(positive, [k]))[:, 0]))
        covered[k] = 1
    table = explicit(some(positive, marks))
    like = weigh(negative, table).max(axis=1)
    table = np.hstack([table, explicit(some(negative, np.argsort(-like, kind="stable")[:NEGATIVE_MARKS].tolist()))])
    own = (table.T @ table).astype(np.float64)
    values, vectors = np.linalg.eigh(own + 1e-3 * np.eye(len(own)))
    root = vectors @ np.diag(values ** -0.5) @ vectors.T
    x = np.concatenate([weigh(positive, table), weigh(negative, table)]) @ root
    y = np.concatenate([np.ones(len(positive.sizes)), -np.ones(len(negative.sizes))])
    w = fit_machine(x.astype(np.float64), y, np.concatenate([heavy ** 0.8, np.ones(len(negative.sizes))]))
    weights = (table @ (root @ w[:-1])).astype(np.float32)
    return weights, float(w[-1])


def fit_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(len(w))
        w += np.clip(np.linalg.solve(h, x.T @ (y - p) - 0.05 * w), -2, 2)
    return w


SAMPLED = "toxic int, h long, key long, words array<string>, text string"


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words of each text, and the least hash of its four-word strings, which near copies mostly share."""
    for batch in text_slices(batches):
        keys, lists = [], []
        for text in batch.column("text").to_pylist():
            words = [w.strip(".,;:!?\"'()[]").lower() for w in (text or "").split()]
            # Four words of the text as they follow each other.
            h = hash_words(pa.array(words, pa.string())) if words else np.zeros(1, dtype=np.uint64)
            with np.errstate(over="ignore"):
                if len(h) > 3:
                    h = mix(h[:-3] * np.uint64(3) + h[1:-2] * np.uint64(5) + h[2:-1] * np.uint64(7) + h[3:] * np.uint64(11))
            keys.append(int(h.min() >> np.uint64(1)))
            lists.append(sorted({w for w in words if w}))
        yield pa.RecordBatch.from_arrays(
            [batch.column("toxic"), batch.column("h"), pa.array(keys, pa.int64()), pa.array(lists, pa.list_(pa.string())),
             batch.column("text")], names=["toxic", "h", "key", "words", "text"])


def sample_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(toxic, h, text): ``sample`` toxic rows and twice as many clean ones at most, with the least hash of id and text.
    Rows are picked by their own number, so an id on many rows brings no more of them."""
    marked = labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("n", F.monotonically_increasing_id())
    keyed = rows.select("doc_id", "n", F.xxhash64("doc_id", "text", F.lit(41)).alias("h")).join(marked, "doc_id")
    picked = keyed.where("toxic = 1").orderBy("h", "n").limit(sample).union(
        keyed.where("toxic = 0").orderBy("h", "n").limit(2 * sample)).select("n", "h", "toxic")
    return rows.join(F.broadcast(durable(picked, "toxicity-picked")), "n").select("toxic", "h", "text")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> ToxicityModel:
    """Fit on the rows of ``docs`` (doc_id, text) that ``labels`` (doc_id, toxic 0 or 1) marks. Rows without a label
    are not used; without toxic rows or without clean ones every document scores 0. Texts stay in the tasks: the driver
    gets word lists of bounded length and three numbers for each row of the logistic fit."""
    ship(docs.sparkSession)
    rows = sample_rows(docs, labels, sample).mapInArrow(_sampled, SAMPLED)
    # Of near copies one is enough; of the rest, two thirds fit the word machine and a third the logistic function.
    one = Window.partitionBy("key", "toxic").orderBy("h", "text")
    rows = durable(rows.withColumn("r", F.row_number().over(one)).where("r = 1").withColumn("learn", F.col("key") % 3 != 0),
                   "toxicity-sample")
    if rows.select("toxic").distinct().count() < 2:
        return ToxicityModel(np.zeros(LETTERS ** 3, dtype=np.float32), -1.0, np.array([0, 0, 0, -30.0]))
    weights, bias = fit_words(*word_lists(rows.where("learn").select("toxic", "words")))
    model = ToxicityModel(weights, bias, np.zeros(4))
    held = docs.sparkSession.sparkContext.broadcast(model)  # one weight for each subsequence of LETTERS letters

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            x = document_features(held.value, batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), batch.column("h"), *[pa.array(c, pa.float64()) for c in x.T]],
                                             names=["toxic", "h", "a", "b", "c"])

    rest = rows.where("not learn").select("toxic", "h", "text").mapInArrow(
        features, "toxic int, h long, a double, b double, c double").toArrow().sort_by([("h", "ascending"), ("a", "ascending")])
    if rest.num_rows:
        model.logistic = fit_logistic(np.stack([rest.column(c).to_numpy() for c in "abc"], axis=1), rest.column("toxic").to_numpy())
    return model


def score(docs: DataFrame, model: ToxicityModel, threshold: float = 0.7) -> DataFrame:
    """``docs`` with score (0 to 1, higher: toxic is likelier) and predicted (1 from ``threshold`` on); columns of
    these names are replaced. Whole texts are read; a null text counts as empty."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # one weight for each subsequence of LETTERS letters
    others = [c for c in docs.columns if c not in ("score", "predicted")]
    schema = docs.select(others).schema.add("score", "double").add("predicted", "integer")
    text = others.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = held.value
        for batch in text_slices(batches, others[text]):
            x = np.hstack([document_features(fitted, batch.column(text)), np.ones((batch.num_rows, 1))])
            p = 1 / (1 + np.exp(-np.clip(x @ fitted.logistic, -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                                             names=schema.names)

    return docs.select(others).mapInArrow(run, schema)
