"""The pipeline, stage by stage, against plain versions; over the smallest tables and over odd documents."""

import hashlib

import pytest

import corpus_pipeline
from skuloom.llm import language_id, pii
from skuloom.llm.common import LAST, table

from .conftest import SCHEMA, odd_documents, prose
from .test_corpus import plain_leaks, plain_links
from .test_documents import library

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


def rows_of(df):
    return [tuple(r) for r in df.select(*[f.split()[0] for f in SCHEMA.split(", ")]).collect()]


def plain_first(rows):
    """One row of each group: the smallest id, of repeated rows the first."""
    links = plain_links([(k, r[1]) for k, r in enumerate(rows)])
    groups = {}
    for k, group, _ in links:
        groups.setdefault(group, []).append(rows[k])
    for own in groups.values():
        yield min(own, key=lambda r: (LAST if r[0] is None else r[0]))


def ids(rows):
    return sorted((r[0] for r in rows), key=repr)


def test_run_is_the_stages(spark):
    docs = table(spark, SF, "documents")
    rows = rows_of(docs)
    known = language_id.trained(docs)
    rows = [r for r in rows if not language_id.identify(r[1], known)[2]]
    assert 0 < len(rows) < docs.count()
    rows = list(plain_first(rows))
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    leaking = {d for d, _ in plain_leaks([r[:2] for r in rows], items)}
    assert leaking
    rows = [r for r in rows if r[0] not in leaking]
    want = []
    for i, text, *_ in rows:
        base = pii.base_spans(text)
        masked = pii.masked(text, pii.model())
        assert not pii.base_spans(masked) and (base or masked == text)
        found, decoded = library(masked)
        want.append((i, len(found) // 4, hashlib.sha256(found).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(want)


@pytest.mark.parametrize("name", list(STAGES)[:-1])
def test_stages_return_documents(spark, nothing, name):
    docs = spark.createDataFrame(odd_documents(), SCHEMA).repartition(3)
    got = STAGES[name](spark, docs, SF)
    assert got.columns == docs.columns and got.schema.simpleString() == docs.schema.simpleString()
    assert got.count() <= docs.count()
    assert STAGES[name](spark, nothing, SF).count() == 0


def test_one_row_of_each_group_stays(spark):
    rows = odd_documents() + [(20, prose(1, 120), "fr", "x", 7), (4, prose(2, 90), "aa", "t", 4)]
    got = rows_of(STAGES["ngram_join"](spark, spark.createDataFrame(rows, SCHEMA).repartition(3), SF))
    # texts without a word are in no group; a repeated row counts once, with the first of its other columns
    assert ids(got) == ids([r for r in plain_first(rows)])
    assert [r[2] for r in got if r[0] == 4] == ["aa"]


@pytest.mark.parametrize("name", list(STAGES)[:-1])
def test_stages_keep_other_columns(spark, name):
    rows = [r for r in odd_documents() if r[0] not in (8, 9)]
    names = ("__r", "__h", "__nth", "__rank", "__hash", "__id", "rank", "hash", "nth", "id", "leak", "leak_hash", "row", "a.b")
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", *(f"concat('{c}', coalesce(doc_id, 0)) AS `{c}`" for c in names), "map('k', doc_id) AS pairs", "array(map('k', doc_id)) AS deep"
    )
    got = STAGES[name](spark, docs, SF)
    assert got.columns == docs.columns and got.schema.simpleString() == docs.schema.simpleString()
    for r in got.collect():
        i = r["doc_id"]
        assert all(r[c] == f"{c}{i or 0}" for c in names) and r["pairs"] == {"k": i} and r["deep"] == [{"k": i}]


def test_leaks_without_an_id_take_no_others_along(spark):
    item = table(spark, SF, "benchmark").first()["text"]
    rows = [(None, f"{prose(5, 40)} {item}", "en", "s", 1), (None, prose(6, 40), "en", "s", 1), (1, prose(7, 40), "en", "s", 1)]
    got = STAGES["decontamination"](spark, spark.createDataFrame(rows, SCHEMA), SF)
    assert sorted(r["text"] for r in got.collect()) == sorted([prose(6, 40), prose(7, 40)])


def test_redaction_keeps_the_length_up_to_date(spark):
    rows = [(1, "a b@c.de d", "en", "s", 10), (2, None, "en", "s", None), (3, "plain", "en", "s", None)]
    got = STAGES["pii"](spark, spark.createDataFrame(rows, SCHEMA), SF)
    assert rows_of(got.orderBy("doc_id")) == [
        (1, "a [EMAIL] d", "en", "s", 11), (2, None, "en", "s", None), (3, "plain", "en", "s", None),
    ]
