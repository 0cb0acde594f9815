"""Filter interaction audit against a plain count."""

import re
from itertools import permutations

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from .conftest import SCHEMA, odd_documents, prose
from checks.compare import difference
from skuloom.llm import filter_audit as FA
from skuloom.llm.oracle import ORACLE

LABELS = "doc_id long, quality int, toxic int"
COLUMNS = ("part", "filter_order", "step", *FA.COUNTS)


def fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
    }


def plain(rows, labels):
    """Every order applied to every document."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    docs = [(i, t or "", lang or "") for i, t, lang, *_ in rows]
    parts: dict[str, list] = {}
    for i, text, part in docs:
        smaller = any(t == text and j is not None and (i is None or j < i) for j, t, _ in docs)
        parts.setdefault(part, []).append((i, fails(text) | {"E": smaller}))
    found = []
    for part, members in parts.items():
        own = []
        for order in map("".join, permutations(FA.FILTERS)):
            left = members
            for step, name in enumerate(order, 1):
                lost, left = [m for m in left if m[1][name]], [m for m in left if not m[1][name]]
                failing = [m for m in members if m[1][name]]
                own.append(
                    [part, order, step, len(left), len(lost), len(failing) - len(lost), sum(sum(m[1].values()) == 1 for m in failing),
                     sum(i in good for i, _ in lost), sum(i in toxic for i, _ in lost)]
                )
        for row in own:
            total = sum(r[4] for r in own if r[1][r[2] - 1] == row[1][row[2] - 1])
            found.append((*row, total))
    return sorted(found)


def documents():
    rows = [(100 + i, prose(i, 80 + 10 * i, 300) + ("#" if i % 3 else "") + "ABC" * (i % 4) * 40, ["en", "de", None, ""][i % 4], "s", 1) for i in range(24)]
    rows += [(200 + i, rows[i % 5][1], "en", "s", 1) for i in range(40)]
    return rows + odd_documents()


LABELLED = [(i, int(i % 3 == 0), int(i % 5 == 0)) for i in range(90, 260)] + [(1, 1, 1), (1, 0, None), (4, 1, None), (None, 1, 1), (5, None, 1)]


@pytest.mark.parametrize("labels", [LABELLED, []])
def test_every_order_and_step(spark, labels):
    docs = spark.createDataFrame(documents(), SCHEMA).repartition(3)
    for name in ("mask", "n", "good", "toxic", "digest", "least", "place", "first", "part", "none", "quality"):
        docs = docs.selectExpr("*", f"'clash' AS `{name}`")
    told = spark.createDataFrame(labels, LABELS).selectExpr("*", "'clash' AS lang", "'clash' AS n", "'clash' AS good")
    got = sorted(tuple(r) for r in FA.filter_audit(docs, told).select(*COLUMNS).collect())
    assert got == plain(documents(), labels)


def test_nothing(spark, nothing):
    labels = spark.createDataFrame([], LABELS)
    assert FA.filter_audit(nothing, labels).columns == list(COLUMNS)
    assert FA.filter_audit(nothing, labels).count() == 0


def test_sql(spark):
    rows, con = documents(), duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR)")
    con.execute("CREATE TABLE labels (doc_id BIGINT, quality INTEGER, toxic INTEGER)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [r[:3] for r in rows])
    con.executemany("INSERT INTO labels VALUES (?, ?, ?)", LABELLED)
    got = FA.filter_audit(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(LABELLED, LABELS)).toPandas()
    assert difference(got, con.execute(ORACLE["op13_filter_audit"]).df()) is None


@pytest.mark.parametrize("n", range(1, 7))
def test_plain_changes_reach_every_order(n):
    order, seen = list(range(n)), {tuple(range(n))}
    for at in FA.plain_changes(n):
        order[at], order[at + 1] = order[at + 1], order[at]
        seen.add(tuple(order))
    assert len(seen) == len(list(permutations(range(n)))) == 1 + sum(1 for _ in FA.plain_changes(n))


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(0, 15), st.integers(1, 3), max_size=16), st.lists(st.integers(0, 2), max_size=8))
def test_swaps_keep_the_counts(counts, swaps):
    """After any swaps, the path of every mask leads to its count, and equal subdiagrams are one node."""
    diagram = FA.Diagram({m: (n,) for m, n in counts.items()}, 4, 1)
    for at in swaps:
        diagram.swap(at)
    for mask in range(16):
        node = diagram.root
        for test in diagram.order:
            node = diagram.tests[node][mask >> test & 1]
        assert diagram.weights[node] == (counts.get(mask, 0),)
    assert diagram.weights[diagram.root] == (sum(counts.values()),)
    assert len(set(diagram.known.values())) == len(diagram.tests)
