"""Toxicity by a classifier chain.

Categories are predicted one after the other. Each is a logistic regression over the presence of
words and word beginnings, and over the probabilities of the categories before it. While a later
model is trained it sees earlier probabilities as they come out for texts the earlier model was
not trained on: each fold's are predicted by a model fitted on the other folds. Models are fitted
on a bounded sample of labelled rows; every row is scored.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.columns import add_columns
from barloom.llm.decontaminate import words_of
from barloom.llm.storage import stored

#: Labelled rows that models are fitted on, at most about.
TRAIN_ROWS = 8000
FOLDS = 3
#: Words and beginnings of words that a model may use: those that tell its category best on its
#: training rows.
FEATURES = 256
#: Characters of a beginning, which stands for all inflected forms.
STEMS = (4, 5, 7)
#: A beginning is one feature more for each of these numbers that it reaches in a text.
REPEATS = (2, 4)
#: Rows that a word must speak for, and how clearly; and how many are taken at a time.
LEAST_ROWS, LEAST_CHI_SQUARE, AT_ONCE = 4, 16.0, 4
RIDGE, NEWTON_STEPS = 0.3, 20

# Words that mark a labelled toxic text as one of a category. The last category is
# the label itself and needs none.
CATEGORIES: dict[str, frozenset[bytes]] = {
    "insult": frozenset(b"idiot moron stupid dumb clown loser fool".split()),
    "contempt": frozenset(b"pathetic disgusting ridiculous vile".split()),
    "demeaning": frozenset(b"trash scum worthless garbage vermin".split()),
    "toxic": frozenset(),
}


@dataclass
class Model:
    """Weights of one category: of words, of earlier categories, and the constant."""

    constant: float
    words: dict[bytes, float] = field(default_factory=dict)
    earlier: list[float] = field(default_factory=list)


@dataclass
class Chain:
    """One model per category, and the probability of the last above which a text is toxic."""

    models: list[Model]
    threshold: float


def features(text: str | None) -> set[bytes]:
    """The words of a text, their beginnings with a star, and how often these repeat."""
    words = words_of(text)
    found = set(words)
    whole = b" ".join(words).decode().split(" ")
    for n in STEMS:
        for stem, times in Counter(w[:n] for w in whole if len(w) >= n).items():
            mark = stem.encode() + b"*"
            found.add(mark)
            found.update(mark + b"%d" % r for r in REPEATS if times >= r)
    return found


def probabilities(models: list[Model], words: set[bytes]) -> list[float]:
    """One probability per category, each from the words and those before it."""
    out: list[float] = []
    for m in models:
        z = m.constant + sum(map(m.words.__getitem__, words & m.words.keys()))
        z += sum(w * p for w, p in zip(m.earlier, out))
        out.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
    return out


class _Rows:
    """Training rows: which words each has, as one long list of (row, word) pairs."""

    def __init__(self, words: pa.ListArray):
        coded = words.values.dictionary_encode()
        self.names = coded.dictionary.to_pylist()
        self.word = coded.indices.to_numpy()
        self.row = np.repeat(np.arange(len(words)), np.diff(words.offsets.to_numpy()))
        self.n = len(words)
        self.by_name = np.array(sorted(range(len(self.names)), key=self.names.__getitem__), dtype=np.int64)

    def telling(self, used: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The words that speak for ``y`` over the rows ``used``.

        The best by chi-square are taken, a few at a time, and each time only the rows that have
        none of those before are looked at: what merely stands beside them tells nothing more.
        """
        left, share = used.copy(), y[used].mean()
        taken: list[int] = []
        while len(taken) < FEATURES:
            seen = left[self.row]
            with_word = np.bincount(self.word[seen], minlength=len(self.names))
            hits = np.bincount(self.word[seen], y[self.row[seen]], len(self.names))
            telling = (hits >= LEAST_ROWS) & (2 * hits > with_word)
            score = np.where(telling, (hits - with_word * share) ** 2
                             / np.maximum(with_word * share * (1 - share), 1e-12), 0)
            best = [k for k in self.by_name[np.argsort(-score[self.by_name], kind="stable")][:AT_ONCE]
                    if score[k] >= LEAST_CHI_SQUARE]
            if not best:
                break
            taken += best
            left[self.row[np.isin(self.word, best)]] = False
        return np.array(taken[:FEATURES], dtype=np.int64)

    def having(self, lexicon: frozenset[bytes]) -> np.ndarray:
        """1 for rows with a word of the lexicon."""
        codes = [k for k, name in enumerate(self.names) if name in lexicon]
        out = np.zeros(self.n)
        out[self.row[np.isin(self.word, codes)]] = 1
        return out

    def matrix(self, chosen: np.ndarray) -> np.ndarray:
        column = np.full(len(self.names), -1)
        column[chosen] = np.arange(len(chosen))
        at = column[self.word]
        out = np.zeros((self.n, len(chosen)))
        out[self.row[at >= 0], at[at >= 0]] = 1
        return out


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the first column is the constant."""
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], RIDGE)
    ridge[0] = 1e-6
    for _ in range(NEWTON_STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _fit(rows: _Rows, earlier: np.ndarray, y: np.ndarray, used: np.ndarray) -> tuple[Model, np.ndarray]:
    """A model from the rows ``used``, and its probabilities for all rows."""
    n, pos = int(used.sum()), float(y[used].sum())
    if pos == 0 or pos == n:  # one class only: its smoothed share
        p = (pos + 0.5) / (n + 1)
        return Model(math.log(p / (1 - p)), {}, [0.0] * earlier.shape[1]), np.full(rows.n, p)
    chosen = rows.telling(used, y)
    x = np.hstack([np.ones((rows.n, 1)), earlier, rows.matrix(chosen)])
    w = _logistic(x[used], y[used])
    k = 1 + earlier.shape[1]
    model = Model(float(w[0]), {rows.names[c]: float(v) for c, v in zip(chosen, w[k:])}, w[1:k].tolist())
    return model, 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))


def fit_chain(words: pa.ListArray, toxic: np.ndarray, fold: np.ndarray) -> tuple[Chain, np.ndarray]:
    """The chain, and for each row the out-of-fold probability of each category."""
    rows = _Rows(words)
    models: list[Model] = []
    held = np.zeros((rows.n, 0))
    for lexicon in CATEGORIES.values():
        y = (toxic * (rows.having(lexicon) if lexicon else 1)).astype(float)
        column = np.zeros(rows.n)
        for f in range(FOLDS):
            column[fold == f] = _fit(rows, held, y, fold != f)[1][fold == f]
        models.append(_fit(rows, held, y, np.ones(rows.n, dtype=bool))[0])
        held = np.hstack([held, column[:, None]])
    # A text in which nothing speaks for a category is not toxic.
    plain = probabilities(models, set())[-1]
    return Chain(models, max(plain, best_threshold(held[:, -1], toxic))), held


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The probability that parts the rows with the fewest errors; of several such cuts the
    middle, on the logit scale, of the widest gap. A half where one class is missing."""
    if not 0 < y.sum() < len(y):
        return 0.5
    z = np.log(np.clip(p, 1e-12, 1) / np.clip(1 - p, 1e-12, 1))
    order = np.argsort(z, kind="stable")
    z, y = z[order], y[order]
    errors = np.cumsum(y) + (len(y) - y.sum()) - np.cumsum(1 - y)  # of a cut behind each row
    gap = np.append(np.diff(z), 0.0)
    k = np.lexsort((-gap, np.where(gap > 0, errors, len(y) + 1)))[0]
    return float(1 / (1 + np.exp(-(z[k] + gap[k] / 2))))


def training_rows(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text",
                  label: str = "toxic", rows: int = TRAIN_ROWS) -> DataFrame:
    """(words, toxic, fold) of at most ``rows`` labelled documents, chosen by a hash of the id;
    of the words those that a model may come to use.

    Rows without an id or label are left out, and of texts that repeat one is taken, so that no
    copy of a text is in another fold.
    """
    known = labels.where(F.col(id_column).isNotNull() & F.col(label).isNotNull()).select(
        F.col(id_column).alias("id"), (F.col(label) == 1).cast("int").alias("toxic"))
    share = min(1.0, rows / max(1, known.count()))
    h = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    sample = known.where(h < int(share * (1 << 30)))
    texts = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text")).join(sample, "id").select(
        "text", "toxic", F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int").alias("fold")).distinct()

    def make():
        return lambda found: ((sorted(features(t)),) for t in found)

    found = stored(add_columns(texts, "text", "words array<binary>", make, keep=["toxic", "fold"]).limit(
        rows).withColumn("row", F.monotonically_increasing_id()), "training")
    # Only what may be chosen is sent on: seen in enough toxic rows, and not mostly in others.
    one = found.select("row", "toxic", F.explode("words").alias("word"))
    useful = one.groupBy("word").agg(F.sum("toxic").alias("hits"), F.count("*").alias("n")).where(
        (F.col("hits") >= LEAST_ROWS) & (4 * F.col("hits") >= F.col("n"))).select("word")
    # A semi-join never broadcasts its left side, which Spark takes to be as small as before the explode.
    words = one.join(useful, "word", "left_semi").groupBy("row").agg(F.array_sort(F.collect_list("word")).alias("words"))
    return found.select("row", "toxic", "fold").join(words, "row", "left").select(
        F.coalesce("words", F.array().cast("array<binary>")).alias("words"), "toxic", "fold")


def learn_toxicity(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text",
                   label: str = "toxic", rows: int = TRAIN_ROWS) -> Chain:
    """The chain fitted on a bounded sample of the labelled documents."""
    sample = training_rows(docs, labels, id_column, text, label, rows).toArrow()  # at most ``rows``
    words = sample["words"].combine_chunks()
    return fit_chain(words, sample["toxic"].to_numpy(), sample["fold"].to_numpy())[0]


def score_toxicity(docs: DataFrame, chain: Chain, text: str = "text",
                   keep: list[str] | None = None) -> DataFrame:
    """Each row of ``docs`` with p_<category> for each category and is_toxic (p_toxic above
    the chain's threshold).

    Words are runs of letters and digits, A-Z lower-cased, from the whole text. A null text has
    no words and gets the probabilities of an empty one. Rows are independent: repeated rows
    repeat their results, an empty table gives an empty one, and columns named like results are
    replaced. Without a labelled row all probabilities are a half and nothing is toxic.
    """
    def make():
        def compute(texts):
            for t in texts:
                p = probabilities(chain.models, features(t))
                yield (*p, p[-1] > chain.threshold)
        return compute

    columns = ", ".join(f"p_{c} double" for c in CATEGORIES)
    return add_columns(docs, text, f"{columns}, is_toxic boolean", make, keep)
