"""Language identification by hierarchical discrimination.

Families are learned, not listed: languages whose mean profiles of hashed byte n-grams lie close together are merged
bottom-up until the gap between groups is wider than inside them. A linear support vector machine for each pair of
families decides the family; inside it, a linear support vector machine for each pair of languages votes.

Features are relative frequencies of byte n-grams (1 to 4) of the lower-cased words, hashed and square-root scaled. Training uses a
bounded sample: ``per_language`` labelled rows of each language, the ones with the smallest hash of id and text.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pipekit.llm.common import filled, lean, ship, spans, text_slices
from pipekit.operators.joins import broadcast_if_small
from pipekit.session import durable

DIM = 1 << 14
PER_LANGUAGE = 400
PER_FAMILY = 1600
UNDETERMINED = "und"
LETTER = r"\p{L}"


def _fold_table() -> np.ndarray:
    """Bytes to symbols: A-Z lower-cased, ASCII other than letters to one separator."""
    table = np.arange(256, dtype=np.uint32)
    table[:128] = 32
    table[97:123] = np.arange(97, 123)
    table[65:91] = np.arange(97, 123)
    return table


FOLD = _fold_table()


def ngram_codes(data: np.ndarray) -> list[np.ndarray]:
    """Hashed codes of the 1-, 2-, 3- and 4-byte strings that start at each byte, each order in its own quarter."""
    c = FOLD[data]
    quarter = DIM // 4
    codes, key = [], np.zeros(len(c), dtype=np.uint32)
    for n in range(1, 5):
        shifted = np.full(len(c), 32, dtype=np.uint32)
        shifted[:max(0, len(c) - n + 1)] = c[n - 1:]
        key = key * np.uint32(0x01000193) + shifted + np.uint32(1)
        mixed = (key ^ (key >> np.uint32(15))) * np.uint32(0x9E3779B1)
        codes.append((mixed >> np.uint32(20)).astype(np.int64) % quarter + (n - 1) * quarter)
    return codes


def profiles(texts: pa.Array) -> np.ndarray:
    """One feature row for each text: square roots of the frequencies within each order, unit length."""
    texts = filled(texts).cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0]:offsets[-1]]
    out = np.zeros((len(texts), DIM), dtype=np.float32)
    at = offsets - offsets[0]
    for k in range(len(texts)):
        data = raw[at[k]:at[k + 1]]
        if not len(data):
            continue
        counts = np.zeros(DIM, dtype=np.float64)
        for first in range(0, len(data), 1 << 20):  # a long text is counted part by part, with the overlap of an n-gram
            piece = data[first:first + (1 << 20) + 3]
            n = min(len(piece), 1 << 20)
            for codes in ngram_codes(piece):
                counts += np.bincount(codes[:n], minlength=DIM)
        row = np.sqrt(counts)
        out[k] = row / np.linalg.norm(row)
    return out


def fit_svm(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, epochs: int = 30, ridge: float = 1e-4) -> np.ndarray:
    """Linear SVM (hinge loss, stochastic subgradient with averaging) over sparse rows (codes, values); y in -1, 1.
    Last weight: the bias."""
    rng = np.random.default_rng(3)
    weight = np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y < 0).sum())))
    w, mean, t = np.zeros(DIM + 1), np.zeros(DIM + 1), 0
    batch = 16
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for first in range(0, len(y), batch):
            some = order[first:first + batch]
            t += 1
            margins = [y[k] * (w[rows[k][0]] @ rows[k][1] + w[-1]) for k in some]
            step = 1 / (ridge * (t + 1000))
            w *= 1 - step * ridge
            for k, margin in zip(some, margins, strict=True):
                if margin < 1:
                    move = step * ridge * 100 * weight[k] * y[k] / len(some)
                    w[rows[k][0]] += move * rows[k][1]
                    w[-1] += move
            if epoch >= epochs // 2:
                mean += w
    return (mean / max(1, t - t * (epochs // 2) // epochs)).astype(np.float32)


def merge_families(means: np.ndarray) -> list[list[int]]:
    """Average-linkage merging of language profiles, cut at the widest gap between successive merges."""
    groups: list[list[int]] = [[i] for i in range(len(means))]
    if len(groups) < 3:
        return groups
    far = 1 - means @ means.T
    steps = []
    while len(groups) > 1:
        cost, a, b = min((float(far[np.ix_(p, q)].mean()), i, j)
                         for (i, p), (j, q) in itertools.combinations(enumerate(groups), 2))
        steps.append((cost, [list(g) for g in groups]))
        groups = [g for k, g in enumerate(groups) if k not in (a, b)] + [groups[a] + groups[b]]
    costs = [c for c, _ in steps]
    # steps[k] holds the groups before merge k; the cut comes before the merge that costs most more than the last one.
    jump = max(range(1, len(costs)), key=lambda k: costs[k] - costs[k - 1])
    return [sorted(g) for g in steps[jump][1]]


@dataclass
class LanguageModel:
    """Families of language numbers; the machines of family pairs and of language pairs within a family."""
    languages: list[str]
    families: list[list[int]]
    family_pairs: list[tuple[int, int]]
    language_pairs: list[tuple[int, int]]
    weights: np.ndarray

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return [UNDETERMINED] * len(x), np.zeros(len(x))
        margins = x @ self.weights[:, :-1].T + self.weights[:, -1]
        sure = 1 / (1 + np.exp(-2 * np.clip(margins, -30, 30)))
        family = np.zeros((len(x), len(self.families)))
        for k, (a, b) in enumerate(self.family_pairs):
            family[:, a] += sure[:, k]
            family[:, b] += 1 - sure[:, k]
        family /= max(1, len(self.families) - 1)
        if len(self.families) == 1:
            family[:] = 1
        best = family.argmax(axis=1)
        share = np.zeros((len(x), len(self.languages)))
        for k, (a, b) in enumerate(self.language_pairs, start=len(self.family_pairs)):
            share[:, a] += sure[:, k]
            share[:, b] += 1 - sure[:, k]
        for members in self.families:
            share[:, members] = share[:, members] / (len(members) - 1) if len(members) > 1 else 1.0
        outside = np.ones((len(x), len(self.languages)), dtype=bool)
        for f, members in enumerate(self.families):
            outside[np.ix_(best == f, members)] = False
        share[outside] = -1
        pick = share.argmax(axis=1)
        rows = np.arange(len(x))
        return [self.languages[i] for i in pick], np.clip(family[rows, best] * share[rows, pick], 0, 1)


FEATURES = "lang string, h long, codes array<int>, weights array<float>"
MACHINE = "pair int, weights array<float>"


def sample_rows(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """(lang, text, h): ``per_language`` rows of each language at most, those with the least hash of id and text. Rows
    with a null language or without a letter are left out. Rows are picked by their own number, so rows of one id or
    equal rows come no more often than that."""
    rows = labelled.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(LETTER)).withColumn("n", F.monotonically_increasing_id())
    # Keys only, no text, go to the windows; the first spreads a language over 64 tasks.
    salted = rows.select("lang", "n", F.xxhash64("doc_id", "text", F.lit(17)).alias("h")).withColumn(
        "salt", F.pmod("n", F.lit(64)))
    first = Window.partitionBy("lang", "salt").orderBy("h", "n")
    last = Window.partitionBy("lang").orderBy("h", "n")
    picked = salted.withColumn("r", F.row_number().over(first)).where(f"r <= {per_language}").withColumn(
        "r", F.row_number().over(last)).where(f"r <= {per_language}").select("n", "h")
    return rows.join(broadcast_if_small(durable(picked, "language-sample")), "n").select("lang", "text", "h")


def _fit_pairs(features: DataFrame, side: dict[str, int], pairs: list[tuple[int, int]], share: dict[str, int]) -> np.ndarray:
    """Weights of the machines that tell numbers ``a`` and ``b`` of ``side`` (number of each language) apart. Each pair
    is a task of its own, with no more than ``share`` rows of a language."""
    if not pairs:
        return np.zeros((0, DIM + 1), dtype=np.float32)
    spark = features.sparkSession
    plan = [(lang, k, 1 if side[lang] == a else -1, share[lang]) for k, (a, b) in enumerate(pairs)
            for lang in sorted(side) if side[lang] in (a, b)]
    plan = spark.createDataFrame(plan, "lang string, pair int, y int, share int")
    rows = features.join(F.broadcast(plan), "lang").where("r <= share").select("pair", "y", "lang", "r", "codes", "weights")

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by([("lang", "ascending"), ("r", "ascending")])
        held = [(c.values.to_numpy(), w.values.to_numpy()) for c, w in
                zip(table.column("codes"), table.column("weights"), strict=True)]
        w = fit_svm(held, table.column("y").to_numpy())
        return pa.table({"pair": pa.array([table.column("pair")[0].as_py()], pa.int32()),
                         "weights": pa.array([w], pa.list_(pa.float32()))})

    got = rows.groupBy("pair").applyInArrow(fit, MACHINE).toArrow().sort_by("pair")
    return np.stack([w.values.to_numpy() for w in got.column("weights")])


def train(labelled: DataFrame, per_language: int = PER_LANGUAGE, per_family: int = PER_FAMILY) -> LanguageModel:
    """Fit on ``labelled`` (doc_id, text, lang): ``per_language`` rows of each language, and ``per_family`` of each
    family where families are told apart (shared out among its languages). No usable rows give a model that answers
    ``und``. Machines are fitted in tasks from sparse rows; the driver gets one mean profile for each language and one
    row of weights for each pair."""
    ship(labelled.sparkSession)
    got = sample_rows(labelled, per_language).mapInArrow(lean(_featurise), FEATURES)
    ranked = Window.partitionBy("lang").orderBy("h", F.xxhash64("codes", "weights"))
    features = durable(got.withColumn("r", F.row_number().over(ranked)), "language-features")
    cells = features.select("lang", F.explode(F.arrays_zip("codes", "weights")).alias("c"))
    sums = (cells.groupBy("lang", F.col("c.codes").alias("code")).agg(F.sum(F.col("c.weights").cast("decimal(20,9)")).alias("w"))
            .groupBy("lang").agg(F.collect_list(F.struct("code", F.col("w").cast("float").alias("w"))).alias("mean"))
            .orderBy("lang").select("lang", "mean.code", "mean.w").toArrow())
    languages = sums.column("lang").to_pylist()
    if not languages:
        return LanguageModel([], [], [], [], np.zeros((0, DIM + 1), dtype=np.float32))
    means = np.zeros((len(languages), DIM))
    for k, (codes, weights) in enumerate(zip(sums.column("code"), sums.column("w"), strict=True)):
        means[k, codes.values.to_numpy()] = weights.values.to_numpy()
    means /= np.linalg.norm(means, axis=1, keepdims=True)
    families = merge_families(means)
    of = {languages[i]: f for f, members in enumerate(families) for i in members}
    own = {name: i for i, name in enumerate(languages)}
    family_pairs = list(itertools.combinations(range(len(families)), 2))
    language_pairs = [p for members in families for p in itertools.combinations(members, 2)]
    shared = {name: max(1, per_family // len(families[of[name]])) for name in languages}
    weights = np.concatenate([_fit_pairs(features, of, family_pairs, shared),
                              _fit_pairs(features, own, language_pairs, dict.fromkeys(languages, per_language))])
    return LanguageModel(languages, families, family_pairs, language_pairs, weights)


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        for first in range(0, batch.num_rows, 64):
            part = batch.slice(first, 64)
            x = profiles(part.column("text"))
            held = [np.flatnonzero(row) for row in x]
            at = spans([len(h) for h in held]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column("lang"), part.column("h"),
                 pa.ListArray.from_arrays(at, pa.array(np.concatenate(held).astype(np.int32))),
                 pa.ListArray.from_arrays(at, pa.array(np.concatenate([r[h] for r, h in zip(x, held, strict=True)])))],
                names=["lang", "h", "codes", "weights"])


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with lang_pred and score; both columns are replaced if present. Null texts and texts without a letter
    get ``und`` and 0. Only the text is read for the prediction."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of weights for each pair of languages
    others = [c for c in docs.columns if c not in ("lang_pred", "score")]
    schema = docs.select(others).schema.add("lang_pred", "string").add("score", "double")
    text = others.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = held.value
        for batch in text_slices(batches):
            texts = batch.column(text)
            letters = pc.fill_null(pc.match_substring_regex(texts, LETTER), False)
            names, scores = [], []
            for first in range(0, batch.num_rows, 256):
                got = fitted.predict(profiles(texts.slice(first, 256)))
                names += got[0]
                scores.append(got[1])
            yes = letters.to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([n if ok else UNDETERMINED for n, ok in zip(names, yes, strict=True)]),
                 pa.array(np.where(yes, np.concatenate(scores), 0.0))], names=schema.names)

    return docs.select(others).mapInArrow(lean(run), schema)


def keep_identified(docs: DataFrame, model: LanguageModel, least: float = 0.0) -> DataFrame:
    """``docs`` without the rows whose language is undetermined or whose score lies below ``least``."""
    columns = docs.columns
    both = docs.select(F.struct(*[docs[c] for c in columns]).alias("row"), F.col("text").cast("string").alias("text"))
    kept = predict(both, model).where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least))
    return kept.select("row.*")
