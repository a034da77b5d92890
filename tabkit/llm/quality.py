"""Weak supervision over quality rules.

Each rule looks at counts of one text and votes good, votes bad or abstains.
How often a rule is right is estimated by expectation-maximisation over the
votes of all documents (no labels): given the chance that a document is good,
every rule's votes are counted by class; given those rates, the chance is the
posterior of its vote pattern.  A document is kept when that posterior reaches
``threshold`` and the base checks hold, instead of having to pass every rule.

Bad documents come in kinds, so the hidden class is "good" or one of the kinds
that the rules name; the posterior of "good" is the quality probability.

Spark counts the votes: one pass measures the texts in Arrow batches, one
aggregate counts equal vote patterns (at most ``3 ** rules`` of them, whatever
the input's size), and only these counts reach the driver for the iterations.
The fitted terms are then applied to each row.  No row is shuffled, so neither
a hot source nor a large group of copies matters.

Results for odd input: a null text is an empty one (all counts 0, base
failed); a long text is measured whole; equal texts get equal results; an
empty table fits the starting rates and returns no rows; other columns pass
through; an output name of ``counts_frame`` or ``judge`` that clashes with one of
them is an error, ``keep_good`` takes any columns.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.llm.common import Memo, check_free, col, holds, packed, slices, task_memory, unpacked

# Fixed values.
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\v\f\r"
LINE_ENDS = (".", "!", "?", '"', "'", ":", ";", "…", "»", ")")
MARKS = ".,;:!?\"'()«»„“”¿¡…-"
WINDOW = 8

#: Counts of one text, in this order.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_ended_lines", "n_distinct_words", "n_plain_words", "n_capital_words")


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a window of eight words found twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    distinct = set(words)
    number = dict(zip(distinct, range(len(distinct))))
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    # windows of 2, 4 and 8 words, each named exactly by its two halves
    step = 1
    while step < WINDOW:
        pairs = ids[:-step] * (int(ids.max()) + 1) + ids[step:]
        found, ids, seen = np.unique(pairs, return_inverse=True, return_counts=True)
        if len(found) == len(pairs):
            return 0  # no shorter window occurs twice, so none of eight words does
        step *= 2
    first = np.flatnonzero(seen[ids] > 1)
    if not len(first):
        return 0
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, first + WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(change)[:-1]))


def _kind(word: bytes) -> int:
    """1 for letters with at most one mark before and two after them, 2 for
    letters all in capitals; else 0."""
    chars = word.decode("utf-8", "surrogatepass")
    core = chars.strip(MARKS)
    if not core.isalpha() or len(chars) > len(core) + 3:
        return 0
    return 2 if core.isupper() and len(core) > 1 else 1


_KINDS = Memo(_kind)
holds("quality", _KINDS.forget)


def measure(text: str | None) -> tuple[int, ...]:
    """:data:`COUNTS` of one text."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    seen: set[str] = set()
    lines = ended = repeated = 0
    for line in text.split("\n"):
        body = line.strip(WHITE)
        if body:
            lines += 1
            ended += body.endswith(LINE_ENDS)
            if line in seen:
                repeated += 1
            else:
                seen.add(line)
    kinds = list(map(_KINDS.__getitem__, words))
    return (len(words), len(text) - sum(map(text.count, WHITE)), sum(map(text.count, SYMBOLS)), repeated,
            repeat_words(words), lines, ended, len(set(words)), len(kinds) - kinds.count(0), kinds.count(2))


def counts_frame(df: DataFrame, text: str = "text", names: tuple[str, ...] = COUNTS, keep_text: bool = True) -> DataFrame:
    """``df`` with the :data:`COUNTS` of its texts under ``names``."""
    check_free(df, *names)
    kept = [c for c in df.columns if keep_text or c != text]
    at, rest = df.columns.index(text), [df.columns.index(c) for c in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with task_memory("quality"):
            for batch in chain.from_iterable(map(slices, batches)):
                table = np.array([measure(t) for t in batch.column(at).to_pylist()], np.int64)
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in rest), *map(pa.array, table.T)],
                                                 names=[*kept, *names])
            _KINDS.forget()

    return df.mapInArrow(run, T.StructType([*(df.schema[i] for i in rest), *(T.StructField(c, T.LongType()) for c in names)]))


@dataclass(frozen=True)
class Rule:
    """``bad`` and ``good`` are conditions over the counts; a text that meets
    neither gets no vote, one that meets both counts as bad.  ``kind`` names
    the sort of bad document that the rule is after."""
    name: str
    kind: str
    bad: str
    good: str


#: Documented rules; a caller may pass its own.
RULES = (
    Rule("length", "shape", "n_words < 20", "n_words >= 60"),
    Rule("word_length", "shape", "word_chars < 3 * n_words or word_chars > 10 * n_words",
         "word_chars >= 4 * n_words and word_chars <= 8 * n_words"),
    Rule("line_ends", "shape", "n_lines >= 3 and 10 * n_ended_lines < 3 * n_lines",
         "n_lines >= 2 and 10 * n_ended_lines >= 7 * n_lines"),
    Rule("capitals", "shape", "10 * n_capital_words > 3 * n_words", "10 * n_capital_words <= n_words"),
    Rule("symbols_per_word", "symbols", "10 * n_symbols > n_words", "50 * n_symbols <= n_words"),
    Rule("symbol_share", "symbols", "50 * n_symbols > word_chars", "200 * n_symbols <= word_chars"),
    Rule("plain_words", "symbols", "10 * n_plain_words < 8 * n_words", "10 * n_plain_words >= 9 * n_words"),
    Rule("repeated_lines", "repeats", "n_lines >= 3 and 10 * n_dup_lines > 3 * n_lines",
         "n_lines >= 3 and n_dup_lines = 0"),
    Rule("repeated_words", "repeats", "100 * n_repeat_words > 25 * n_words",
         "n_words >= 20 and n_repeat_words = 0"),
    Rule("variety", "repeats", "n_words >= 50 and 10 * n_distinct_words < 2 * n_words",
         "n_words >= 20 and 10 * n_distinct_words >= 4 * n_words"),
)

#: Condition of a failed base check.
BASE_FAILED = "n_words < 20 or 100 * n_repeat_words > 30 * n_words"

BAD, GOOD, NONE = 0, 1, 2


def vote(rule: Rule, bad, good, none) -> Column:
    return F.when(F.expr(rule.bad), bad).when(F.expr(rule.good), good).otherwise(none)


@dataclass(frozen=True)
class VoteModel:
    """Class 0 holds the good documents, one more class each kind of bad
    ones.  ``priors``: the share of each class; ``rates``: per class and rule,
    how often the rule votes bad, good or not at all."""
    priors: np.ndarray
    rates: np.ndarray  # class x rule x vote

    def classes(self, votes: np.ndarray) -> np.ndarray:
        """Chance of each class for rows of votes (rows x rules)."""
        rules = np.arange(votes.shape[1])
        score = np.stack([np.log(r[rules, votes]).sum(axis=1) for r in self.rates], 1) + np.log(self.priors)
        score = np.exp(score - score.max(axis=1, keepdims=True))
        return score / score.sum(axis=1, keepdims=True)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Chance of a good document."""
        return self.classes(votes)[:, 0]

    def accuracies(self) -> np.ndarray:
        """Per rule: how often a vote is right, given that the rule votes."""
        by_class = self.priors[:, None, None] * self.rates
        right = by_class[0, :, GOOD] + by_class[1:, :, BAD].sum(axis=0)
        return right / by_class[:, :, [BAD, GOOD]].sum(axis=(0, 2))


def unpack(patterns: np.ndarray, n_rules: int) -> np.ndarray:
    return (patterns[:, None] // 3 ** np.arange(n_rules - 1, -1, -1)) % 3


def start_model(rules: tuple[Rule, ...], good: float = 0.9) -> VoteModel:
    """Rules start out silent or right on good documents, and voting bad on
    most documents of the kind that they are after."""
    kinds = list(dict.fromkeys(r.kind for r in rules))
    usual, caught = [0.05, 0.6, 0.35], [0.6, 0.2, 0.2]
    rates = [[usual] * len(rules)] + [[caught if r.kind == k else usual for r in rules] for k in kinds]
    return VoteModel(np.array([good] + [(1 - good) / len(kinds)] * len(kinds)), np.array(rates))


def fit_votes(patterns: np.ndarray, counts: np.ndarray, rules: tuple[Rule, ...] = RULES, rounds: int = 200,
              tolerance: float = 1e-9, smoothing: float = 1.0) -> VoteModel:
    """Expectation-maximisation over counted vote patterns.  ``smoothing`` is
    a number of pseudo-documents per class at the starting rates; it keeps
    rates above 0."""
    model = start = start_model(rules)
    if not len(patterns):
        return model
    votes = unpack(patterns, len(rules))
    one_hot = (votes[:, :, None] == np.arange(3)).astype(float)
    for _ in range(rounds):
        share = model.classes(votes) * counts[:, None]
        seen = np.einsum("pc,prv->crv", share, one_hot) + smoothing * start.rates
        new = VoteModel((share.sum(axis=0) + smoothing * start.priors) / (counts.sum() + smoothing),
                        seen / seen.sum(axis=2, keepdims=True))
        moved = max(np.abs(new.priors - model.priors).max(), np.abs(new.rates - model.rates).max())
        model = new
        if moved < tolerance:
            break
    return model


def fit(counts: DataFrame, rules: tuple[Rule, ...] = RULES) -> VoteModel:
    """Fit on every row of ``counts`` (see :func:`counts_frame`).  Only the
    distinct vote patterns, ``3 ** len(rules)`` at most, and their counts come
    to the driver."""
    pattern = F.lit(0)
    for rule in rules:
        pattern = pattern * 3 + vote(rule, BAD, GOOD, NONE)
    rows = counts.groupBy(pattern.alias("pattern")).agg(F.count("*").alias("n")).collect()
    rows.sort(key=lambda r: r.pattern)
    return fit_votes(np.array([r.pattern for r in rows], np.int64), np.array([r.n for r in rows], float), rules)


def judge(counts: DataFrame, model: VoteModel, rules: tuple[Rule, ...] = RULES, threshold: float = 0.5) -> DataFrame:
    """``counts`` with ``base_failed``, ``p_good`` (the posterior) and
    ``kept``.  Each vote adds a fitted term to the log odds of every bad kind
    against good ones."""
    check_free(counts, "base_failed", "p_good", "kept")
    against = np.log(model.rates[1:]) - np.log(model.rates[0])
    bad_odds = F.lit(0.0)
    for k, prior in enumerate(model.priors[1:]):
        odds = F.lit(float(np.log(prior) - np.log(model.priors[0])))
        for j, rule in enumerate(rules):
            odds = odds + vote(rule, *(float(against[k, j, v]) for v in (BAD, GOOD, NONE)))
        bad_odds = bad_odds + F.exp(odds)
    return (counts.withColumn("base_failed", F.expr(BASE_FAILED))
            .withColumn("p_good", 1.0 / (1.0 + bad_odds))
            .withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= threshold)))


def keep_good(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, threshold: float = 0.5) -> DataFrame:
    """The rows of ``df`` that are kept, with the columns of ``df``: one pass
    fits the rules on all texts, a second one judges each row."""
    # the counts go by fixed names, in which the rules are written
    texts = df.select(col(text).alias("_text"))
    model = fit(counts_frame(texts, "_text", keep_text=False), rules)
    rows = counts_frame(packed(df, _text=col(text)), "_text", keep_text=False)
    return unpacked(judge(rows, model, rules, threshold).where("kept"), df.columns)
