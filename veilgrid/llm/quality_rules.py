"""Quality rules as weak supervision.

Each rule votes for good (1) or bad (-1) or abstains (0). The votes of all documents, counted by pattern, go to an
expectation-maximisation fit of a two-class model in which rules vote independently given the class; its posterior
that a document is good decides, in place of a demand that every rule passes. There are at most 3 ** len(RULES)
patterns, so the fit, on the driver, is bounded whatever the corpus, and it sees every document. A document that one rule
votes against is kept if the rule proves fallible and the others speak for the document; no vote decides by itself.

Defined results: a null or empty text has no words, fails the base check and is not kept; repeated rows are counted and
returned once each; a null id stays null; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import stage_table
from .text_stats import beside_stats, text_stats

#: Pseudo-counts of the votes -1, 0 and 1 in a bad and in a good document: rules are right more often than wrong. They name
#: the classes, and weigh as much as six documents, whatever the corpus.
PRIOR = ((3.0, 2.0, 1.0), (1.0, 2.0, 3.0))
PRIOR_GOOD = (4.0, 1.0)
RULES = ("symbols", "repeats", "copied_lines", "capitals", "exclamations", "function_words", "word_length", "figures", "stops")


def votes() -> list[Column]:
    """In the order of ``RULES``: -1, 0 or 1. Texts of fewer than 20 words get no vote. Function words of the four known
    languages speak for a text; the lack of them says nothing, since the text may be in a fifth."""
    words, letters, lines, characters = (F.greatest(F.col(c), F.lit(1)) for c in ("n_words", "n_letters", "n_lines", "word_chars"))
    vote = lambda good, bad: F.when(F.col("n_words") < 20, 0).when(good, 1).when(bad, -1).otherwise(0)
    share = lambda c, of: F.col(c) / of
    never = F.lit(False)
    symbols, capitals, size, stops = share("n_symbols", words), share("n_upper", letters), share("word_chars", words), share("n_stops", words)
    each = [
        vote(symbols <= 0.02, symbols >= 0.1), vote(never, share("n_repeat_words", words) >= 0.15), vote(never, share("n_dup_lines", lines) >= 0.2), vote(capitals <= 0.15, capitals >= 0.5),
        vote(never, share("n_exclaims", words) >= 0.1), vote(share("n_function_words", words) >= 0.1, never), vote((size >= 4) & (size <= 6.5), (size <= 2.5) | (size >= 12)),
        vote(never, share("n_digits", characters) >= 0.3), vote((stops >= 0.05) & (stops <= 0.35), (stops <= 0.005) | (stops >= 0.6)),
    ]
    return [v.cast("int").alias(f"vote_{r}") for r, v in zip(RULES, each, strict=True)]


class LabelModel:
    """Class prior and, for each rule, the chance of each vote in either class."""

    def __init__(self, prior_good: float, chance: np.ndarray) -> None:
        self.prior_good, self.chance = prior_good, chance  # chance[class, rule, vote + 1]; class 1 is good

    @classmethod
    def fit(cls, votes: np.ndarray, weight: np.ndarray, rounds: int = 500) -> LabelModel:
        """Expectation-maximisation from the majority vote. votes: a row per pattern; weight: its documents."""
        onehot = (votes[:, :, None] == np.array([-1, 0, 1])).astype(float)
        good = 1 / (1 + np.exp(-votes.sum(axis=1, dtype=float)))
        model = cls(0.5, np.full((2, votes.shape[1], 3), 1 / 3))
        for _ in range(rounds):
            before = good
            for k, belief in enumerate((1 - good, good)):
                mass = np.einsum("p,prv->rv", weight * belief, onehot) + np.array(PRIOR[k])
                model.chance[k] = mass / mass.sum(axis=1, keepdims=True)
            model.prior_good = float((weight @ good + PRIOR_GOOD[0]) / (weight.sum() + sum(PRIOR_GOOD)))
            good = model.posterior(votes)
            if np.abs(good - before).max(initial=0) < 1e-9:
                break
        return model

    def weights(self) -> tuple[float, np.ndarray]:
        """Log odds: of the prior, and of each rule's votes -1, 0 and 1."""
        return float(np.log(self.prior_good / (1 - self.prior_good))), np.log(self.chance[1] / self.chance[0])

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        base, each = self.weights()
        odds = base + each[np.arange(votes.shape[1]), votes + 1].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(odds, -700, 700)))


def base_failed(min_words: int, repeat_percent: int) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))


def _judged(stats: DataFrame, min_words: int, repeat_percent: int, threshold: float) -> DataFrame:
    """A stage table of ``COUNTS`` with ``base_failed``, ``kept`` and ``posterior``. The votes of all its rows are counted
    first, which reads the counts alone, then every row is judged."""
    voted = stats.select("*", *votes())
    columns = [f"vote_{r}" for r in RULES]
    patterns = voted.groupBy(*columns).count().collect()  # at most 3 ** len(RULES) rows
    posterior: Column = F.lit(0.0)
    if patterns:
        model = LabelModel.fit(np.array([p[:-1] for p in patterns]), np.array([p[-1] for p in patterns], float))
        base, each = model.weights()
        odds = F.lit(base)
        for c, w in zip(columns, each, strict=True):
            odds = odds + F.when(F.col(c) == -1, float(w[0])).when(F.col(c) == 0, float(w[1])).otherwise(float(w[2]))
        posterior = 1 / (1 + F.exp(-odds))
    failed = base_failed(min_words, repeat_percent)
    return voted.select("*", failed.alias("base_failed"), (~failed & (posterior >= threshold)).alias("kept"), posterior.alias("posterior"))


def quality_rules(docs: DataFrame, min_words: int = 20, repeat_percent: int = 30, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, posterior."""
    stats = stage_table(text_stats(docs, id_col, text_col), "stats")
    return _judged(stats, min_words, repeat_percent, threshold).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")


def keep_good(docs: DataFrame, min_words: int = 20, repeat_percent: int = 30, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they are. The rows are written once, beside their counts, so
    that nothing has to be joined."""
    stats = stage_table(beside_stats(docs, text_col), "stats")
    kept = _judged(stats, min_words, repeat_percent, threshold).filter("kept")
    return kept.select(*(F.col(f"c{k}").alias(c) for k, c in enumerate(docs.columns)))
