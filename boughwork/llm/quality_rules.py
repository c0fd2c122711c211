"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Everything that touches a row is a DataFrame expression. The driver sees only how many
documents cast each combination of votes, at most 3 to the number of rules.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boughwork.llm.common import settle


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """Words of ``[^\\x20\\x09-\\x0D]+``; none of a null text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def _covered(windows: Column, size: int) -> Column:
    """Words in windows (given as hashes, in order) that occur twice or more."""

    def positions(ranked: Column) -> Column:
        def repeats(j: Column) -> Column:
            own = F.get(ranked, j)["h"]
            before, after = F.get(ranked, j - 1)["h"], F.get(ranked, j + 1)["h"]
            return F.coalesce(own == before, F.lit(False)) | F.coalesce(own == after, F.lit(False))

        places = F.sequence(F.lit(0), F.size(ranked) - 1)
        return F.array_sort(F.transform(F.filter(places, repeats), lambda j: F.get(ranked, j)["i"]))

    def length(at: Column) -> Column:
        steps = F.transform(at, lambda x, j: F.least(F.lit(size), F.coalesce(F.get(at, j + 1) - x, F.lit(size))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    ranked = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return _bind(_bind(ranked, positions), length)


def _repeated(hashes: Column, size: int) -> Column:
    """Number of words within runs of ``size`` words found twice or more in the text."""
    count = F.size(hashes)

    def of(windows: Column) -> Column:
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(_covered(windows, size))

    windows = F.transform(F.sequence(F.lit(1), count - (size - 1)), lambda i: F.xxhash64(F.slice(hashes, i, size)))
    return F.when(count <= size, F.lit(0)).otherwise(_bind(windows, of))


def statistics(docs: DataFrame, window: int = 8) -> DataFrame:
    """``doc_id`` and the counts that the rules read, of each whole text.

    Runs of words are compared by 64-bit hashes of hashes; two different runs of one text
    share one with a chance of about n^2 / 2^65.
    """
    text = F.coalesce(F.col("text"), F.lit(""))

    def counts(words: Column) -> Column:
        def hashed(h: Column) -> Column:
            return F.struct(_repeated(h, window).cast("long").alias("n_repeat_words"), F.size(F.array_distinct(h)).cast("long").alias("n_distinct"))

        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            _bind(F.transform(words, lambda w: F.xxhash64(w)), hashed).alias("h"),
        )

    def line_counts(lines: Column) -> Column:
        return F.struct(
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            F.size(F.filter(lines, lambda x: x.rlike("[.!?…:;\"”»][\\x20\\x09-\\x0D]*$"))).cast("long").alias("n_closed_lines"),
        )

    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    rows = docs.select(
        "doc_id",
        _bind(words_of(F.col("text")), counts).alias("w"),
        _bind(lines, line_counts).alias("l"),
        F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(text, "[^\\p{Lu}]+", "")).cast("long").alias("n_upper"),
        F.length(F.regexp_replace(text, "[^\\p{L}]+", "")).cast("long").alias("n_letters"),
    )
    return rows.select("doc_id", "w.n_words", "w.word_chars", "n_symbols", "l.n_dup_lines", "w.h.n_repeat_words", "w.h.n_distinct", "l.n_lines", "l.n_closed_lines", "n_upper", "n_letters")


def _vote(keep: str, reject: str) -> Column:
    return F.expr(f"case when {reject} then 0 when {keep} then 1 end")


#: Each rule votes to keep (1), to reject (0) or abstains (null); rejection is tried first.
RULES: dict[str, tuple[str, str]] = {
    "symbols": ("n_words > 0 and 50 * n_symbols <= n_words", "10 * n_symbols > n_words"),
    "repetition": ("n_words >= 20 and 20 * n_repeat_words <= n_words", "5 * n_repeat_words > n_words"),
    "lines": ("n_lines >= 3 and n_dup_lines = 0", "n_lines >= 4 and 10 * n_dup_lines > 3 * n_lines"),
    "capitals": ("n_letters > 0 and 8 * n_upper <= n_letters", "n_letters > 0 and 4 * n_upper > n_letters"),
    "word_length": ("n_words > 0 and word_chars between 3 * n_words and 7 * n_words", "n_words > 0 and word_chars not between 2 * n_words and 12 * n_words"),
    "closed_lines": ("n_lines > 0 and 10 * n_closed_lines >= 9 * n_lines", "n_lines >= 3 and 2 * n_closed_lines < n_lines"),
    "letters": ("word_chars > 0 and 100 * n_letters >= 92 * word_chars", "word_chars > 0 and 8 * n_letters < 7 * word_chars"),
    "variety": ("n_words >= 50 and 10 * n_distinct >= 3 * n_words", "n_words >= 50 and 10 * n_distinct < n_words"),
}


def estimate(patterns: list[tuple[tuple[int | None, ...], int]], rounds: int = 50) -> tuple[float, list[tuple[float, float]]]:
    """(share of good documents, for each rule its chance to vote keep on a good and on a bad one).

    ``patterns`` are combinations of votes and how often each occurs. Abstentions say nothing.
    It starts from the belief that a document some rule rejects is likelier bad than good, and
    one that none rejects likelier good. No documents give the starting beliefs.
    """
    n_rules = len(patterns[0][0]) if patterns else len(RULES)
    belief = [0.2 if 0 in votes else 0.95 for votes, _ in patterns]
    share, rates = 0.9, [(0.95, 0.5)] * n_rules
    for _ in range(rounds if patterns else 0):
        total = sum(n for _, n in patterns)
        share = (sum(b * n for b, (_, n) in zip(belief, patterns)) + 9) / (total + 10)
        rates = []
        for j in range(n_rules):
            good = [sum(b * n for b, (v, n) in zip(belief, patterns) if v[j] == x) for x in (0, 1)]
            bad = [sum((1 - b) * n for b, (v, n) in zip(belief, patterns) if v[j] == x) for x in (0, 1)]
            rates.append(((good[1] + 19) / (sum(good) + 20), (bad[1] + 1) / (sum(bad) + 2)))
        weights = log_odds(share, rates)
        belief = [1 / (1 + math.exp(-max(-500.0, min(500.0, weights[0] + sum(w[v] for w, v in zip(weights[1], votes) if v is not None))))) for votes, _ in patterns]
    return share, rates


def log_odds(share: float, rates: list[tuple[float, float]]) -> tuple[float, list[tuple[float, float]]]:
    """The prior log odds of good, and for each rule what a vote to reject or to keep adds."""
    return math.log(share / (1 - share)), [(math.log((1 - g) / (1 - b)), math.log(g / b)) for g, b in rates]


def quality_rules(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The counts, ``base_failed``, ``posterior`` and ``kept`` of each row of ``docs`` (doc_id, text).

    base_failed: fewer than 20 words, or more than 30 % of them in runs of 8 words that occur
    twice. kept: not base_failed, and the posterior probability of a good document reaches
    ``threshold``. A null text has no words. Repeated rows, null ids and extra columns are
    fine; an empty table gives no rows.
    """
    stats = settle(statistics(docs), "statistics")
    votes = {name: _vote(*rule) for name, rule in RULES.items()}
    names = list(votes)
    counted = stats.select(*[v.alias(n) for n, v in votes.items()]).groupBy(*names).count().collect()
    patterns = sorted(((tuple(r[n] for n in names), r["count"]) for r in counted), key=str)
    prior, weights = log_odds(*estimate(patterns))
    odds = F.lit(prior)
    for name, (reject, keep) in zip(names, weights):
        odds = odds + F.when(votes[name] == 1, keep).when(votes[name] == 0, reject).otherwise(0.0)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    posterior = 1 / (1 + F.exp(-odds))
    return stats.select("*", failed.alias("base_failed"), posterior.alias("posterior")).withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))
