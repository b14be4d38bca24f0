"""A sentiment provider that learns its lexicon from rated reviews.

Words are weighed by their log-odds between praise and complaint with an informative Dirichlet prior: each class is given
PRIOR of all words more, shared out as the words of all reviews are, so a rare word needs evidence before it counts. A word within
the scope of a negation (SCOPE words after it, up to the next stop) counts for the other side, in learning and in judging.
A review that repeats a word says it once: what counts is in how many reviews it stands, on each side of a negation. All
counts come from one aggregate over the words. The model is the at most MOST words whose log-odds are surest; as a
Column it is a table of hashed buckets in the plan, so that judging a text takes a lookup for each of its words, no join
and no Python.

Null texts have no words; reviews with no rating, or one that is neither praise nor complaint, count for the prior alone;
without praise or without complaints nothing is learned, and every text is neutral; texts are read whole, and repeated
rows count each.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import let

PRIOR, LEAST, MOST, SCOPE, SURE = 0.01, 5, 4096, 3, 15.0
SCALE = 1000  # weights are whole thousandths: sums are exact, in any order
#: What turns the words after it round, and what ends that. Fixed values.
NEGATIONS = ("not", "no", "never", "none", "nothing", "neither", "nor", "cannot", "without", "hardly")
STOPS = (".", ",", ";", ":", "!", "?")
CONTRACTED = "n't"
NEGATED = "!"  # in no word
#: A word: letters of any script, with an apostrophe within; or a stop.
TOKEN = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+(?:'[^\x00-\x40\x5B-\x60\x7B-\x7F]+)*|[.,;:!?]"


def words(text: Column) -> Column:
    """The text's distinct words, in lower case; one within a negation's scope has NEGATED before it."""
    tokens = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0))

    def kind(t):
        return F.when(t.isin(*STOPS), 2).when(t.isin(*NEGATIONS) | F.endswith(t, F.lit(CONTRACTED)), 1).otherwise(0)

    def scan(all_of):
        def told_by(kinds):
            def told(t, i):
                negated = F.lit(False)
                for back in range(SCOPE, 0, -1):
                    before = F.coalesce(F.get(kinds, i - back), F.lit(0))
                    negated = (before == 1) | ((before == 0) & negated)
                return F.when(F.get(kinds, i) == 2, F.lit(None)).when(negated, F.concat(F.lit(NEGATED), t)).otherwise(t)

            return F.array_distinct(F.array_compact(F.transform(all_of, told)))

        return let(F.transform(all_of, kind), told_by)

    return let(tokens, scan)


def _negated(word: Column) -> Column:
    return F.startswith(word, F.lit(NEGATED))


def _plain(word: Column) -> Column:
    return F.ltrim(word, F.lit(NEGATED))


def counts(reviews: DataFrame, text: str = "review_text", rating: str = "rating") -> DataFrame:
    """word, praise, complaint, n: how many reviews each word speaks for either side in, and in how many it occurs at all."""
    side = F.when(F.col(rating) >= 4, 1).when(F.col(rating) <= 2, -1).otherwise(0)
    told = reviews.select(side.alias("side"), F.explode(words(F.col(text))).alias("w"))
    own = F.when(_negated(F.col("w")), -F.col("side")).otherwise(F.col("side"))
    return told.groupBy(_plain(F.col("w")).alias("word")).agg(F.count_if(own == 1).alias("praise"), F.count_if(own == -1).alias("complaint"), F.count("*").alias("n"))


def log_odds(counted: DataFrame, prior: float = PRIOR, least: int = LEAST) -> DataFrame:
    """word, praise, complaint, n, log_odds, surety of words that occur `least` times: the log of the ratio of a word's odds
    in praise to those in complaints, smoothed by the prior; and the G statistic of the two shares being one, which holds
    for words that one side never uses, too."""
    totals = counted.agg(F.sum("praise").alias("_p"), F.sum("complaint").alias("_c"), F.sum("n").alias("_n"))
    both = counted.join(F.broadcast(totals)).where((F.col("n") >= least) & (F.col("_p") > 0) & (F.col("_c") > 0))  # totals: one row
    given, more = F.col("n") * prior, F.col("_n") * prior
    share = lambda c, total: F.log((F.col(c) + given) / (F.col(total) + more - F.col(c) - given))
    used, every = F.col("praise") + F.col("complaint"), F.col("_p") + F.col("_c")

    def part(seen, row, total):
        return F.when(seen > 0, seen * F.log(seen * every / (row * total))).otherwise(0.0)

    cells = [part(F.col(c), used, F.col(t)) + part(F.col(t) - F.col(c), every - used, F.col(t)) for c, t in (("praise", "_p"), ("complaint", "_c"))]
    return both.select("word", "praise", "complaint", "n", (share("praise", "_p") - share("complaint", "_c")).alias("log_odds"), (2 * (cells[0] + cells[1])).alias("surety"))


def surest(weighed: DataFrame, most: int = MOST) -> DataFrame:
    """The at most `most` words whose two shares surely differ, with weight, their log-odds in thousandths."""
    sure = weighed.where(F.round("surety", 6) >= SURE).withColumn("weight", F.round(F.col("log_odds") * SCALE).cast("int"))
    return sure.where("weight != 0").orderBy(F.desc(F.round("surety", 6)), "word").limit(most)


@dataclass(frozen=True)
class Lexicon:
    """Words and weights in thousandths: at most MOST of them, if `fit` made it."""

    weights: dict[str, int]
    buckets: int
    slots: tuple[tuple[tuple[str, ...], tuple[int, ...]], ...]  # for each slot, every bucket's word and weight

    @classmethod
    def of(cls, rows) -> Lexicon:
        """Of rows (word, hash, weight); words of one bucket lie in different slots."""
        rows, buckets = list(rows), 16
        while True:
            held: dict[int, list] = {}
            for row in rows:
                held.setdefault(row["hash"] & buckets - 1, []).append(row)
            if max(map(len, held.values()), default=0) <= 3:
                break
            buckets *= 2
        slots = []
        for k in range(max(map(len, held.values()), default=0)):
            own = [held[b][k] if len(held.get(b, ())) > k else None for b in range(buckets)]
            slots.append((tuple(r["word"] if r else "" for r in own), tuple(r["weight"] if r else 0 for r in own)))
        return cls({r["word"]: r["weight"] for r in rows}, buckets, tuple(slots))

    def weight(self, word: Column) -> Column:
        """The word's weight, or 0."""

        def found(bucket):
            total = F.lit(0)
            for names, weights in self.slots:
                own = F.get(F.split(F.lit(" ".join(names)), " "), bucket)
                value = F.get(F.split(F.lit(" ".join(map(str, weights))), " ").cast("array<int>"), bucket)
                total = total + F.when(own == word, value).otherwise(0)
            return total

        return let(F.xxhash64(word).bitwiseAND(F.lit(self.buckets - 1)).cast("int"), found)

    def evidence(self, text: Column) -> Column:
        """struct(good, bad): the weights, in thousandths, of what speaks for either side."""
        zero = F.struct(F.lit(0).cast("long").alias("good"), F.lit(0).cast("long").alias("bad"))

        def add(total, w):
            def told(weight):
                signed = F.when(_negated(w), -weight).otherwise(weight)
                return F.struct((total["good"] + F.greatest(signed, F.lit(0))).alias("good"), (total["bad"] - F.least(signed, F.lit(0))).alias("bad"))

            return let(self.weight(_plain(w)), told)

        return F.aggregate(words(text), zero, add)

    def sentiment(self, text: Column) -> Column:
        """struct(sentiment, scores), as any sentiment provider gives it."""
        return self.judged(self.evidence(text))

    def judged(self, evidence: Column) -> Column:
        """struct(sentiment, scores) of what `evidence` told. Evidence below a half (in log-odds) is neutral;
        evidence on both sides, the weaker at four fifths of the stronger or more, is mixed."""

        def told(e):
            good, bad = e["good"] / F.lit(float(SCALE)), e["bad"] / F.lit(float(SCALE))
            both, total = F.least(good, bad), good + bad + 1.0
            label = F.when(good + bad < 0.5, "NEUTRAL").when(both >= 0.8 * F.greatest(good, bad), "MIXED").when(good > bad, "POSITIVE").otherwise("NEGATIVE")
            scores = {"Positive": (good - both / 2) / total, "Negative": (bad - both / 2) / total, "Neutral": 1.0 / total, "Mixed": both / total}
            return F.struct(label.alias("sentiment"), F.create_map(*(x for k, v in scores.items() for x in (F.lit(k), v))).alias("scores"))

        return let(evidence, told)


def fit(reviews: DataFrame, text: str = "review_text", rating: str = "rating", most: int = MOST) -> Lexicon:
    """A lexicon of at most `most` words, learned from all reviews; only these words come to the driver."""
    chosen = surest(log_odds(counts(reviews, text, rating)), most)
    return Lexicon.of(chosen.select("word", F.xxhash64("word").alias("hash"), "weight").collect())
