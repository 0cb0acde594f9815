"""Quality rules as weak supervision.

Every rule reads a few counts of the whole text and votes good (1), bad (-1) or abstains (0). Expectation maximisation
over the vote patterns estimates how often each rule is right on good and on bad documents and how many documents are
good; the posterior of a document's votes decides, instead of a demand that all rules pass.

Only DataFrame expressions are used. The corpus is read once; its counts are written to the shared folder. An iteration
is one aggregation over the distinct vote patterns, of which there are at most 3 to the power of the number of rules,
whatever the size of the corpus; the driver holds the parameters only.

Null text counts as empty: no words, all counts 0, `base_failed`. Repeated rows and repeated or null ids each give a row.
An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuloom.llm.common import checkpointed, text_or_empty

WINDOW = 8
SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
ENDS = r"[.!?]"
CAPITALS = r"\p{Lu}"
ALNUM = r"[\p{L}\p{N}]"
MIN_WORDS = 20
KEEP_FROM = 0.5
#: Always as many; the estimates have settled long before.
ROUNDS = 30
#: The belief to start from: most documents are good, a rule seldom votes bad on a good one and finds a quarter of the bad
#: ones, since each looks for one kind of fault. It keeps this weight, as a share of the corpus, in every iteration.
PRIOR_GOOD, PRIOR_RIGHT, PRIOR_WEIGHT = 0.8, (0.995, 0.25), 0.02


def text_counts(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of the whole text that the rules read."""
    text = F.col("text")
    words = docs.select(
        F.col("doc_id"), text_or_empty().alias("text")
    ).select(
        "doc_id",
        F.array_remove(F.split(text, SPACE), "").alias("words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(NOT_SPACE)).alias("lines"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit(ENDS)).cast("long").alias("n_ends"),
        F.regexp_count("text", F.lit(CAPITALS)).cast("long").alias("n_capitals"),
        F.regexp_count("text", F.lit(ALNUM)).cast("long").alias("n_alnum"),
    )
    hashed = words.select(
        "doc_id", "n_symbols", "n_ends", "n_capitals", "n_alnum",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.array_distinct("lines")).cast("long").alias("n_distinct_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    # a start for every window of eight words; equal windows have equal hashes
    starts = F.sequence(F.lit(0), F.size("hashes") - WINDOW)
    windows = F.when(
        F.size("hashes") >= WINDOW,
        F.transform(starts, lambda i: F.xxhash64(*[F.get("hashes", i + k) for k in range(WINDOW)])),
    )
    gathered = hashed.withColumn("windows", windows).withColumn(
        "n_distinct_words", F.size(F.array_distinct("hashes")).cast("long")
    )
    again = F.size(F.array_distinct("windows")) < F.size("windows")
    ranked = gathered.withColumn(
        "ranked",
        F.when(again, F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("at"))))),
    )

    def repeated(x: Column, i: Column) -> Column:
        before, after = F.get("ranked", i - 1)["h"], F.get("ranked", i + 1)["h"]
        return F.coalesce(x["h"] == before, F.lit(False)) | F.coalesce(x["h"] == after, F.lit(False))

    placed = ranked.withColumn(
        "places", F.sort_array(F.transform(F.filter("ranked", repeated), lambda x: x["at"]))
    )
    # a window covers eight words, or as many as lie before the next repeated window
    covered = F.aggregate(
        F.transform("places", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("places", i + 1) - p, F.lit(WINDOW)))),
        F.lit(0), lambda a, b: a + b,
    )
    return placed.select(
        "doc_id", "n_words", "word_chars", "n_symbols",
        (F.col("n_lines") - F.col("n_distinct_lines")).alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        "n_lines", "n_distinct_words", "n_ends", "n_capitals", "n_alnum",
    )


def vote(good: Column, bad: Column) -> Column:
    return F.when(bad, F.lit(-1)).when(good, F.lit(1)).otherwise(F.lit(0))


def rules() -> dict[str, Column]:
    """The votes, by name."""
    n, chars = F.col("n_words"), F.col("word_chars")
    marks = chars - F.col("n_alnum")
    variety = F.col("n_distinct_words") / F.sqrt(F.greatest(n, F.lit(1)))
    return {
        "length": vote(n >= 50, n < MIN_WORDS),
        "word_length": vote((chars >= 3 * n) & (chars <= 12 * n), (chars < 2 * n) | (chars > 16 * n)),
        "symbols": vote(F.col("n_symbols") * 50 <= n, F.col("n_symbols") * 8 > n),
        "lines": vote(F.col("n_dup_lines") * 10 <= F.col("n_lines"), F.col("n_dup_lines") * 2 > F.col("n_lines")),
        "repeats": vote(F.col("n_repeat_words") * 50 <= n, F.col("n_repeat_words") * 10 > n * 3),
        "variety": vote(variety >= 4, variety < 2),
        "sentences": vote((F.col("n_ends") * 100 >= n) & (F.col("n_ends") * 3 <= n), (F.col("n_ends") == 0) | (F.col("n_ends") > n)),
        # marks: what is neither letter nor digit
        "marks": vote(marks * 16 <= chars, marks * 10 > chars),
        "capitals": vote(F.col("n_capitals") * 5 <= chars, F.col("n_capitals") * 5 > chars * 2),
    }


@dataclass(frozen=True)
class Model:
    """Share of good documents; per rule how often a vote is right on good and on bad documents."""

    good: float
    right: dict[str, tuple[float, float]]

    def posterior(self) -> Column:
        """Probability that a document with these votes is good."""

        def evidence(name: str) -> Column:
            on_good, on_bad = self.right[name]
            up, down = math.log(on_good / (1 - on_bad)), math.log((1 - on_good) / on_bad)
            return F.when(F.col(name) == 1, F.lit(up)).when(F.col(name) == -1, F.lit(down)).otherwise(F.lit(0.0))

        odds = reduce(lambda a, b: a + b, map(evidence, self.right), F.lit(math.log(self.good / (1 - self.good))))
        return 1 / (1 + F.exp(-odds))


def fit(patterns: DataFrame, names: list[str]) -> Model:
    """Expectation maximisation over vote patterns with their number `n`."""
    total = float(patterns.agg(F.sum("n")).first()[0] or 0)
    held = PRIOR_WEIGHT * total + 1
    model = Model(PRIOR_GOOD, {name: PRIOR_RIGHT for name in names})
    for _ in range(ROUNDS if total else 0):
        p = F.col("p")
        good, bad = F.col("n") * p, F.col("n") * (1 - p)
        sums = [F.sum(good).alias("good")]
        for i, name in enumerate(names):
            up, down = F.col(name) == 1, F.col(name) == -1
            sums += [
                F.sum(F.when(up, good)).alias(f"a{i}"), F.sum(F.when(down, good)).alias(f"b{i}"),
                F.sum(F.when(up, bad)).alias(f"c{i}"), F.sum(F.when(down, bad)).alias(f"d{i}"),
            ]
        row = patterns.withColumn("p", model.posterior()).agg(*sums).first().asDict()
        row = {k: v or 0.0 for k, v in row.items()}

        def share(right: float, wrong: float, belief: float) -> float:
            return (right + belief * held) / (right + wrong + held)

        model = Model(
            (row["good"] + PRIOR_GOOD * held) / (total + held),
            {
                name: tuple(map(share, (row[f"a{i}"], row[f"d{i}"]), (row[f"b{i}"], row[f"c{i}"]), PRIOR_RIGHT))
                for i, name in enumerate(names)
            },
        )
    return model


def quality_verdicts(docs: DataFrame) -> DataFrame:
    """The counts, every rule's vote (`vote_<rule>`), `posterior`, `base_failed` and `kept` of every row."""
    votes = rules()
    counts = checkpointed(text_counts(docs))
    voted = counts.withColumns(votes)
    patterns = checkpointed(voted.groupBy(*votes).agg(F.count(F.lit(1)).alias("n")).coalesce(1).sort(*votes))
    model = fit(patterns, list(votes))
    n = F.col("n_words")
    failed = (n < MIN_WORDS) | (F.col("n_repeat_words") * 100 > n * 30)
    judged = voted.withColumns({"base_failed": failed, "posterior": model.posterior()})
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= KEEP_FROM)).withColumnsRenamed(
        {name: f"vote_{name}" for name in votes}
    )
