"""Quality by weak supervision.

Rules look at a document and vote good, vote bad or abstain.  Nobody says how
good the rules are: expectation-maximisation estimates, from how the votes of
all documents agree, how often each rule is right about good and about bad
documents.  A document's quality is the posterior probability of being good.

Documents without text, or with an empty one, have all measures 0; every rule
but the one on length abstains.  Rows are judged one by one, so repeated rows
get equal answers and a null ``doc_id`` stays null.  Columns other than
``doc_id`` and ``text`` are not looked at and not returned.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import by_batch, raw
from millrace.session import pin

MEASURES = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_lines long, n_ended long, n_distinct long, n_bare long, n_capitals long"
)
_CAPITALS = bytes(range(65, 91))
_NO_LETTERS = bytes(x for x in range(128) if not chr(x).isalpha())
_SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"
_WINDOW = 5
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def _repeated_words(words: list[bytes]) -> int:
    """Words inside five-word windows that the text holds at least twice."""
    if len(words) <= _WINDOW:
        return 0
    codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    n = len(words) - _WINDOW + 1
    windows = np.zeros(n, np.uint64)
    for i in range(_WINDOW):
        part = codes[i : i + n] * _ODD[i]
        windows += part ^ (part >> np.uint64(29))
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    found = np.isin(windows, twice)
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:n] += found
    edges[_WINDOW : _WINDOW + n] -= found
    return int(np.count_nonzero(np.cumsum(edges)))


def _measure(data: bytes | None) -> tuple:
    if not data:
        return (0,) * 10
    words, text = data.split(), data.decode("utf-8", "replace")
    kinds = Counter(words)
    lines = [line for line in data.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text) - sum(map(text.count, _SPACES)),
        sum(map(text.count, _SYMBOLS)),
        len(lines) - len(set(lines)),
        _repeated_words(words),
        len(lines),
        sum(line.rstrip().endswith((b".", b"!", b"?", b'"', b":")) for line in lines),
        len(kinds),
        sum(n for word, n in kinds.items() if not word.strip(_NO_LETTERS)),
        len(data) - len(data.translate(None, _CAPITALS)),
    )


def measures(documents: DataFrame) -> DataFrame:
    """Counts over each whole text; the rules are expressions over these."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = list(zip(*map(_measure, raw(batch.column(1))), strict=True))
        names = [c.split()[0] for c in MEASURES.split(", ")]
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *(pa.array(x, pa.int64()) for x in found)], names)

    return by_batch(documents.select("doc_id", "text"), work, MEASURES)


def _vote(good: Column, bad: Column) -> Column:
    """1 good, -1 bad, 0 abstains."""
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    n, lines, chars = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1)), F.greatest("word_chars", F.lit(1))
    long_enough = F.col("n_words") >= 20
    some_words = F.col("n_words") > 0
    variety, mean = F.col("n_distinct") / n, chars / n
    return {
        "length": _vote(F.col("n_words") >= 50, F.col("n_words") < 4),
        "symbols": _vote(some_words & (F.col("n_symbols") / n <= 0.02), F.col("n_symbols") / n > 0.1),
        "letters": _vote(long_enough & (F.col("n_bare") / n <= 0.05), long_enough & (F.col("n_bare") / n > 0.2)),
        "repetition": _vote(long_enough & (F.col("n_repeat_words") / n <= 0.05), long_enough & (F.col("n_repeat_words") / n > 0.3)),
        "variety": _vote(long_enough & (variety >= 0.5), long_enough & (variety * F.log10(n + 10) < 0.6)),
        "word_length": _vote(long_enough & mean.between(3.5, 5.8), long_enough & ((mean < 2.5) | (mean > 7.0))),
        "lines": _vote((F.col("n_lines") >= 3) & (F.col("n_dup_lines") == 0), (F.col("n_lines") >= 3) & (F.col("n_dup_lines") / lines > 0.4)),
        "capitals": _vote(long_enough & (F.col("n_capitals") / chars < 0.1), long_enough & (F.col("n_capitals") / chars > 0.35)),
        "sentences": _vote(some_words & (F.col("n_ended") / lines >= 0.6), (F.col("n_lines") >= 3) & (F.col("n_ended") / lines < 0.2)),
    }


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100, weight: float = 20.0) -> tuple[float, np.ndarray]:
    """The share of good documents and each rule's log odds for its two votes.

    ``patterns`` holds one row of votes per pattern, ``counts`` how many
    documents vote so: all that the estimate needs, however many documents.
    Junk comes in kinds that different rules see, so the start takes a single
    vote against a document as a sign of junk; from there the rounds weigh the
    rules.  ``weight`` documents' worth of prior belief (a rule that votes is
    right about 98 % of good and 30 % of bad documents) keeps small or
    one-sided tables from swapping the classes.
    """
    good, bad = patterns == 1, patterns == -1
    prior, sure_good, sure_bad = 0.85, 0.98, 0.3
    post = np.where(bad.any(axis=1), 0.1, 0.97)
    for _ in range(rounds):
        yes, no = counts * post, counts * (1 - post)
        share = float((yes.sum() + weight * prior) / (counts.sum() + weight))
        right_good = (yes @ good + weight * sure_good) / (yes @ (good | bad) + weight)
        right_bad = (no @ bad + weight * sure_bad) / (no @ (good | bad) + weight)
        # a rule may be useless but not worse than chance
        right_bad = np.maximum(right_bad, 1 - right_good + 1e-6)
        for_good, for_bad = np.log(right_good / (1 - right_bad)), np.log((1 - right_good) / right_bad)
        odds = math.log(share / (1 - share)) + good @ for_good + bad @ for_bad
        post = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
    return share, np.stack([for_good, for_bad], axis=1)


def judged(documents: DataFrame, least: float = 0.5) -> DataFrame:
    """Measures, each rule's vote (``vote_*``), ``quality`` and ``good``.

    Runs two jobs: one writes the measures, one counts the vote patterns (at
    most three to the power of the number of rules, however many documents).
    """
    votes = rules()
    found = pin(measures(documents)).withColumns({f"vote_{k}": v for k, v in votes.items()})
    names = [f"vote_{k}" for k in votes]
    rows = found.groupBy(*names).count().orderBy(*names).collect()
    if not rows:
        return found.withColumns({"quality": F.lit(0.0), "good": F.lit(False)})
    share, odds = estimate(np.array([r[:-1] for r in rows]), np.array([r[-1] for r in rows], float))
    total = F.lit(math.log(share / (1 - share)))
    for name, (for_good, for_bad) in zip(names, odds.tolist(), strict=True):
        total = total + F.when(F.col(name) == 1, for_good).when(F.col(name) == -1, for_bad).otherwise(0.0)
    quality = F.round(1 / (1 + F.exp(-total)), 9)
    return found.withColumn("quality", quality).withColumn("good", F.col("quality") >= least)
