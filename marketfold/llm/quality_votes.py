"""Quality by weak supervision: rules vote or abstain, expectation-maximisation
estimates how accurate each rule is, and the posterior probability that a
document is good replaces "all rules must pass".

DataFrame functions only.  Three steps: features and votes per document (one
pass over the texts), counts of the distinct vote patterns (at most 3 to the
number of rules, whatever the corpus), and EM on those counts.

Defined results: null or empty text has no words, fails the base rules and is
not kept; repeated documents are judged one by one; an empty table gives an
empty result.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketfold.llm.common import SPACE_CLASS, text_or_empty, unpacked, words_of
from marketfold.session import cut_lineage

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _same(a: Column, b: Column) -> Column:
    return F.coalesce(a == b, F.lit(False))


def _alike(array: str, part) -> Column:
    """Elements of a sorted array column that equal a neighbour in ``part``."""
    whole = F.col(array)
    return F.filter(whole, lambda x, i: _same(part(F.get(whole, i - 1)), part(x)) | _same(part(F.get(whole, i + 1)), part(x)))


def with_repeat_words(df: DataFrame, words: str, into: str) -> DataFrame:
    """Count the words inside a 3-word window that is found twice or more.

    Window hashes with their positions are sorted as plain longs; neighbours
    of equal hash are candidates, which are then compared as text.  Each step
    is a column of its own, so that no lambda evaluates one again."""
    at = lambda p: F.get(F.col(words), p)
    place = lambda k: k.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")
    df = df.withColumn("_keys", F.when(F.size(words) >= 3, F.sort_array(F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda p: F.shiftleft(F.hash(at(p), at(p + 1), at(p + 2)).cast("long"), 32).bitwiseOR(p.cast("long"))))))
    df = df.withColumn("_cand", _alike("_keys", lambda k: F.shiftright(k, 32)))
    df = df.withColumn("_windows", F.sort_array(F.transform("_cand", lambda k: F.struct(
        F.concat_ws(" ", *[at(place(k) + j) for j in range(3)]).alias("t"), place(k).alias("p")))))
    spots = F.sort_array(F.transform(_alike("_windows", lambda x: x["t"]), lambda x: x["p"]))
    covered = F.aggregate(spots, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
                          lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")),
                          lambda a: a["n"])
    return df.withColumn(into, F.coalesce(covered, F.lit(0)).cast("long")).drop("_keys", "_cand", "_windows")


def with_features(rows: DataFrame, into: str = "_q") -> DataFrame:
    """``rows`` (``_row`` and ``_text``) with a struct of counts over the whole
    text in place of the text."""
    text = F.col("_text")
    first = rows.withColumn("_w", words_of(text)).withColumn("_n", F.size("_w"))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    second = with_repeat_words(first.withColumn("_lines", lines), "_w", "_rep")
    chars = F.length(F.array_join("_w", ""))
    return second.withColumn(into, F.struct(
        F.col("_n").cast("long").alias("n_words"), chars.cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.col("_rep").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.regexp_count(text, F.lit("[A-Z]")).cast("long").alias("n_upper"),
        F.regexp_count(text, F.lit("[0-9]")).cast("long").alias("n_digits"),
        F.regexp_count(text, F.lit("[.!?](?:" + SPACE_CLASS + "|$)")).cast("long").alias("n_ends"),
        F.regexp_count(text, F.lit("!!")).cast("long").alias("n_shouts"),
        F.regexp_count(text, F.lit(PLAIN_WORD)).cast("long").alias("n_plain"),
    )).drop("_text", "_w", "_n", "_lines", "_rep")


# Letters (with inner apostrophes or hyphens), at most one closing mark, then white space or the end.
PLAIN_WORD = r"(?<![^\x20\x09-\x0D])\p{L}[\p{L}'’-]*+[.,;:!?]?(?![^\x20\x09-\x0D])"


@dataclass(frozen=True)
class Rule:
    """Votes good (1) where ``good`` holds, bad (-1) where ``bad`` holds, else abstains (0)."""
    name: str
    good: str
    bad: str


# Conditions over the features (the struct's fields).  A rule abstains between its two conditions.
RULES = (
    Rule("length", "n_words >= 80", "n_words < 50"),
    Rule("symbols", "50 * n_symbols <= n_words", "10 * n_symbols > n_words"),
    Rule("plain_words", "10 * n_plain >= 9 * n_words", "10 * n_plain < 7 * n_words"),
    Rule("repeats", "20 * n_repeat_words <= n_words", "5 * n_repeat_words > n_words"),
    Rule("dup_lines", "n_lines >= 3 AND n_dup_lines = 0", "3 * n_dup_lines > n_lines"),
    Rule("word_length", "word_chars BETWEEN 3 * n_words AND 8 * n_words", "word_chars < 2 * n_words OR word_chars > 12 * n_words"),
    Rule("capitals", "10 * n_upper <= word_chars", "10 * n_upper > 3 * word_chars"),
    Rule("digits", "50 * n_digits <= word_chars", "5 * n_digits > word_chars"),
    Rule("sentences", "n_ends > 0 AND n_words <= 40 * n_ends", "n_words > 60 * (n_ends + 1)"),
    Rule("shouting", "n_shouts = 0 AND n_words >= 50", "20 * n_shouts > n_words"),
)


def votes(rules: tuple[Rule, ...] = RULES, at: str = "_q") -> Column:
    def on(condition: str) -> Column:
        return F.expr(re.sub(r"\b(n_\w+|word_chars)\b", rf"{at}.\1", condition))
    return F.array(*[F.when(on(r.bad), F.lit(-1)).when(on(r.good), F.lit(1)).otherwise(F.lit(0)) for r in rules])


@dataclass(frozen=True)
class VoteModel:
    """Share of good documents, and per rule the probabilities of the votes
    bad, none and good on a good and on a bad document."""
    prior: float
    on_good: tuple[tuple[float, float, float], ...]
    on_bad: tuple[tuple[float, float, float], ...]

    def accuracy(self) -> list[float]:
        """Per rule: how often a vote that is cast is right."""
        return [(self.prior * g[2] + (1 - self.prior) * b[0]) / (self.prior * (g[0] + g[2]) + (1 - self.prior) * (b[0] + b[2]))
                for g, b in zip(self.on_good, self.on_bad)]

    def posterior(self, vote: Column) -> Column:
        """P(good | votes): a plain expression of the vote array."""
        weights = F.lit([math.log(x / y) for g, b in zip(self.on_good, self.on_bad) for x, y in zip(g, b)])
        each = F.transform(vote, lambda v, j: F.get(weights, v + 1 + 3 * j))
        odds = F.aggregate(each, F.lit(math.log(self.prior / (1 - self.prior))), lambda sum_, x: sum_ + x)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


# What a rule is taken to do before any data is seen: on good documents it
# rarely says bad, on bad ones it says so now and then (junk fails in one way
# and passes the other rules).
PRIOR_GOOD, PRIOR_ON_GOOD, PRIOR_ON_BAD = 0.85, (0.01, 0.09, 0.90), (0.25, 0.15, 0.60)


def fit_votes(patterns: DataFrame, n_rules: int, rounds: int = 12, tolerance: float = 1e-4, strength: float = 0.02) -> VoteModel:
    """EM over the table (v array<int>, n long) of vote patterns.

    Each round is one aggregation of that small table, to three rows a rule:
    the posterior of every pattern, then the expected counts of each vote in
    both classes.  The Dirichlet prior above, worth ``strength`` of all rows,
    fixes which class is which and keeps rules that never vote in place."""
    model = VoteModel(PRIOR_GOOD, (PRIOR_ON_GOOD,) * n_rules, (PRIOR_ON_BAD,) * n_rules)
    for _ in range(rounds):
        n = F.col("n").cast("double")
        cast = patterns.select(n.alias("n"), model.posterior(F.col("v")).alias("p"), F.posexplode("v").alias("j", "vote"))
        sums = cast.groupBy("j", "vote").agg(F.sum(F.col("n") * F.col("p")).alias("good"), F.sum(F.col("n") * (1 - F.col("p"))).alias("bad")).collect()
        if not sums:
            return model
        good, bad = ({(r["j"], r["vote"] + 1): r[c] for r in sums} for c in ("good", "bad"))
        all_good, all_bad = (sum(x.get((0, k), 0.0) for k in range(3)) for x in (good, bad))
        extra = 1.0 + strength * (all_good + all_bad)

        def shares(counts: dict, prior: tuple[float, ...], size: float) -> tuple[tuple[float, ...], ...]:
            return tuple(tuple((counts.get((j, k), 0.0) + prior[k] * extra) / (size + extra) for k in range(3)) for j in range(n_rules))
        new = VoteModel((all_good + PRIOR_GOOD * extra) / (all_good + all_bad + extra),
                        shares(good, PRIOR_ON_GOOD, all_good), shares(bad, PRIOR_ON_BAD, all_bad))
        moved = max(abs(x - y) for a, b in zip(new.on_good + new.on_bad, model.on_good + model.on_bad) for x, y in zip(a, b))
        model = new
        if moved < tolerance:
            break
    return model


def base_failed(at: str = "_q") -> Column:
    n = F.col(f"{at}.n_words")
    return (n < MIN_WORDS) | (100 * F.col(f"{at}.n_repeat_words") > MAX_REPEAT_PERCENT * n)


def judge(docs: DataFrame, keep: list[str], rules: tuple[Rule, ...] = RULES, threshold: float = 0.5) -> DataFrame:
    """The columns ``keep`` of ``docs`` as ``_row`` plus ``_q`` (features),
    ``_votes``, ``_p_good``, ``_base_failed`` and ``_kept``.  Features are
    computed once and read again for the verdict."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"), text_or_empty().alias("_text"))
    voted = with_features(rows).withColumn("_votes", votes(rules)).select("_row", "_q", "_votes")
    voted = cut_lineage(voted, "quality-features")
    patterns = voted.groupBy(F.col("_votes").alias("v")).agg(F.count(F.lit(1)).alias("n")).orderBy("v").coalesce(1)
    model = fit_votes(cut_lineage(patterns, "quality-patterns"), len(rules))
    return voted.withColumn("_p_good", model.posterior(F.col("_votes"))).withColumn("_base_failed", base_failed()) \
                .withColumn("_kept", ~F.col("_base_failed") & (F.col("_p_good") >= threshold))


def report(docs: DataFrame) -> DataFrame:
    """One row per document: counts, base verdict, verdict, posterior, votes."""
    j = judge(docs.select("doc_id", "text"), ["doc_id"])
    return unpacked(j, ["doc_id"], *[F.col(f"_q.{c}").alias(c) for c in FEATURES], F.col("_base_failed").alias("base_failed"),
                    F.col("_kept").alias("kept"), F.col("_p_good").alias("p_good"), F.col("_votes").alias("votes"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that are kept, columns as in ``docs``."""
    return unpacked(judge(docs, docs.columns).filter("_kept"), docs.columns)
