"""Filter interaction audit: what five filters remove in every order in which they can be applied.

1. Every text gets a mask of the filters that it fails. Four look at the text alone (`CONDITIONS`); E compares whole texts:
   a row fails it if a row of a smaller doc_id holds the same text, whatever the other filters say. Rows are reduced to one
   per text digest, part and label before they meet, so a text that fills a third of the table costs no more than another.
2. The masks of a part, 32 at most, are counted by Spark, with the good and the toxic documents among them.
3. Each part becomes a decision diagram: a node tests one filter, its two edges lead to the documents that pass and that
   fail, equal subdiagrams are one node, and every node carries the counts of all documents below it.
   Swapping two neighbouring levels rebuilds only the nodes of these levels; plain changes lead through all orders of the
   filters by 119 swaps. In each order the path on which all filters pass gives the steps: the weight of its next
   node is kept, the weight of the edge that leaves the path is removed.

A null or empty text has no words: it fails A and passes B, C and D; all null and empty texts are equal. A null lang is the
part ''. A null doc_id comes after all others: its row fails E if the text occurs with any id, and rows with the same id, or
all without one, do not fail for each other's sake. Repeated rows count each. Of several labels of a document the
larger counts; labels without an id belong to nothing. An empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skuloom.llm.common import text_or_empty

FILTERS = "ABCDE"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")

Weight = tuple[int, ...]


def conditions(text: Column) -> list[Column]:
    """Failure of the filters A to D on a text that is not null."""
    words = F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "")
    n, capitals = F.size(words), F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return [
        n < 100,
        100 * F.size(F.array_distinct(words)) < 80 * n,
        100 * capitals > 10 * F.length(text),
        text.rlike("[#$%&*|]"),
    ]


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents per part and set of failed filters, bit i for filter i."""
    text = text_or_empty()
    mask = sum((fails.cast("int") * (1 << i) for i, fails in enumerate(conditions(F.col("text")))), F.lit(0))
    rows = docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    rows = rows.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask.alias("mask"))
    # one row per id, text and part
    rows = rows.groupBy("digest", "doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))

    def told(column: str) -> Column:
        return F.max(F.coalesce((F.col(column) == 1).cast("int"), F.lit(0)))

    known = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        told("quality").alias("good"), told("toxic").alias("toxic")
    )
    rows = rows.join(known, "doc_id", "left").fillna(0, ["good", "toxic"])
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "n")
    # per text a few rows, one per part and labels: how many documents, and how many of them have the least id
    texts = rows.groupBy("digest", "part", "mask", "good", "toxic").agg(F.sum("n").alias("n"), F.min(own).alias("least"))
    place = F.struct("least.none", "least.doc_id")
    texts = texts.withColumn("place", place).withColumn("first", F.min("place").over(Window.partitionBy("digest")))
    firsts = F.when(F.col("place").eqNullSafe(F.col("first")), F.col("least.n")).otherwise(0)
    both = F.array(
        F.struct(F.col("mask"), firsts.alias("n")),
        F.struct((F.col("mask") + (1 << 4)).alias("mask"), (F.col("n") - firsts).alias("n")),
    )
    split = texts.select("part", "good", "toxic", F.inline(both)).filter("n > 0")
    return split.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")
    )


def plain_changes(n: int) -> Iterator[int]:
    """Places at which to swap neighbours so that n things run through all their orders, each once."""
    if n < 2:
        return
    inner = plain_changes(n - 1)
    down = True
    while True:
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        step = next(inner, None)
        if step is None:
            return
        # the thing that travels stands before the others after its way down
        yield step + down
        down = not down


class Diagram:
    """Decision diagram over masks; `order` names the filter of each level."""

    def __init__(self, counts: Mapping[int, Weight], n: int, width: int) -> None:
        self.tests: list[tuple[int, int] | None] = []
        self.weights: list[Weight] = []
        self.known: dict[tuple, int] = {}
        self.order = list(range(n))
        zero = (0,) * width

        def build(level: int, mask: int) -> int:
            if level == n:
                return self.leaf(tuple(counts.get(mask, zero)))
            return self.node(level, build(level + 1, mask), build(level + 1, mask | 1 << level))

        self.root = build(0, 0)

    def _add(self, key: tuple, test: tuple[int, int] | None, weight: Weight) -> int:
        if key not in self.known:
            self.known[key] = len(self.tests)
            self.tests.append(test)
            self.weights.append(weight)
        return self.known[key]

    def leaf(self, weight: Weight) -> int:
        return self._add((weight,), None, weight)

    def node(self, test: int, passed: int, failed: int) -> int:
        weight = tuple(a + b for a, b in zip(self.weights[passed], self.weights[failed], strict=True))
        return self._add((test, passed, failed), (passed, failed), weight)

    def swap(self, at: int) -> None:
        """Exchange the levels `at` and `at + 1`; nodes above are rebuilt around the new ones, nodes below stay."""
        upper, lower = self.order[at : at + 2]
        done: dict[int, int] = {}

        def rebuilt(node: int, level: int) -> int:
            if node not in done:
                passed, failed = self.tests[node]
                if level < at:
                    done[node] = self.node(self.order[level], rebuilt(passed, level + 1), rebuilt(failed, level + 1))
                else:
                    (pp, pf), (fp, ff) = self.tests[passed], self.tests[failed]
                    done[node] = self.node(lower, self.node(upper, pp, fp), self.node(upper, pf, ff))
            return done[node]

        self.root = rebuilt(self.root, 0)
        self.order[at : at + 2] = lower, upper

    def steps(self) -> Iterator[tuple[int, Weight, Weight]]:
        """(filter, kept, removed) along the path on which all filters pass."""
        node = self.root
        for test in self.order:
            passed, failed = self.tests[node]
            yield test, self.weights[passed], self.weights[failed]
            node = passed


def audit(counts: Mapping[int, Weight], names: str = FILTERS) -> list[dict]:
    """A row per order and step from the weights (documents, good ones, toxic ones) of the masks."""
    diagram = Diagram(counts, len(names), 3)
    rows, shapley, fails, alone = [], dict.fromkeys(names, 0), {}, {}
    for at in (None, *plain_changes(len(names))):
        if at is not None:
            diagram.swap(at)
        order = "".join(names[i] for i in diagram.order)
        for step, (test, kept, removed) in enumerate(diagram.steps(), 1):
            name = names[test]
            shapley[name] += removed[0]
            # what a filter removes as the first it fails, what it removes as the last only it fails
            if step == 1:
                fails[name] = removed[0]
            if step == len(names):
                alone[name] = removed[0]
            rows.append(
                {"filter_order": order, "step": step, "kept": kept[0], "removed": removed[0], "good_lost": removed[1], "toxic_lost": removed[2]}
            )
    for row in rows:
        name = row["filter_order"][row["step"] - 1]
        row |= {"redundant": fails[name] - row["removed"], "unique_fails": alone[name], "shapley": shapley[name]}
    return rows


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per part, order of the filters and step, with the counts of `COUNTS`."""

    def run(masks: pa.Table) -> pa.Table:
        columns = (masks[c].to_pylist() for c in ("n", "good", "toxic"))
        rows = audit(dict(zip(masks["mask"].to_pylist(), zip(*columns, strict=True), strict=True)))
        part = masks["part"][0].as_py()
        found = {"part": [part] * len(rows), "filter_order": [r["filter_order"] for r in rows]}
        table = {k: pa.array(v, pa.string()) for k, v in found.items()}
        table["step"] = pa.array([r["step"] for r in rows], pa.int32())
        return pa.table(table | {c: pa.array([r[c] for r in rows], pa.int64()) for c in COUNTS})

    result = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)
    # a group has one row per mask, 32 at most
    return mask_counts(docs, labels).groupBy("part").applyInArrow(run, result)
