"""The filter audit against a plain count over all orders."""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from fairlead.llm import filter_audit
from tests.llm.conftest import LONG

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LABELS = "doc_id bigint, quality int, toxic int, part string"


def brute_audit(rows, labels):
    """Rows of the audit from (doc_id, text, part) rows and (doc_id, quality, toxic) labels."""
    least = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            least[text or ""] = min(doc_id, least.get(text or "", doc_id))
    good = {d for d, quality, _ in labels if d is not None and quality == 1}
    bad = {d for d, _, toxic in labels if d is not None and toxic == 1}
    judged = []
    for doc_id, text, part in rows:
        text = text or ""
        found = WORD.findall(text)
        fails = {
            name
            for name, failed in (
                ("A", len(found) < 50),
                ("B", 100 * len(set(found)) < 65 * len(found)),
                ("C", 100 * len(re.findall("[A-Z]", text)) > 5 * len(text)),
                ("D", re.search(r"[#$%&*|]", text) is not None),
                ("E", doc_id is not None and doc_id > least[text]),
            )
            if failed
        }
        judged.append((part or "", fails, doc_id in good, doc_id in bad))
    out, shapley = {}, defaultdict(int)
    parts = {p for p, *_ in judged}
    for part in parts:
        mine = [j[1:] for j in judged if j[0] == part]
        for order in permutations("ABCDE"):
            left = mine
            for step, name in enumerate(order, 1):
                gone = [j for j in left if name in j[0]]
                left = [j for j in left if name not in j[0]]
                failing = [j for j in mine if name in j[0]]
                shapley[part, name] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), len(failing) - len(gone), sum(j[0] == {name} for j in failing),
                    sum(j[1] for j in gone), sum(j[2] for j in gone),
                ]
    for (part, order, step), row in out.items():
        row.append(shapley[part, order[step - 1]])
    return out


def audited(df):
    return {
        (r.part, r.filter_order, r.step): [
            r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley
        ]
        for r in df.collect()
    }


def test_edge_rows_match_brute_force(spark, store, edge_docs, edge_rows):
    labels = [(1, 1, 0, "x"), (7, 1, 1, "x"), (7, 1, 1, "x"), (9, 0, 1, None), (5, None, None, None), (None, 1, 1, "y"), (999, 1, 1, "y")]
    got = audited(filter_audit.audit_documents(edge_docs, spark.createDataFrame(labels, LABELS), store))
    want = brute_audit([(r[0], r[1], r[3]) for r in edge_rows], [l[:3] for l in labels])
    assert got == want and {p for p, _, _ in got} == {r[3] or "" for r in edge_rows}


def test_columns_and_types(spark, store, make_docs):
    rows = filter_audit.audit_documents(make_docs(["a b c", LONG]), spark.createDataFrame([], LABELS), store)
    assert rows.dtypes[:3] == [("part", "string"), ("filter_order", "string"), ("step", "int")]
    assert all(kind == "bigint" for _, kind in rows.dtypes[3:])
    assert rows.count() == 600


@pytest.mark.parametrize("label_rows", [[], [(1, 1, 1, "x")]])
def test_empty_tables_give_no_rows(spark, store, no_docs, label_rows):
    assert audited(filter_audit.audit_documents(no_docs, spark.createDataFrame(label_rows, LABELS), store)) == {}


def test_nothing_fails(spark, store):
    text = " ".join(f"word{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text + " one", "a"), (2, text, "a")], "doc_id bigint, text string, source string")
    rows = filter_audit.audit_documents(docs, spark.createDataFrame([], LABELS), store).collect()
    assert len(rows) == 600 and all((r.kept, r.removed, r.shapley) == (2, 0, 0) for r in rows)


def test_a_text_that_most_rows_share(spark, store):
    """One text under many ids: all but the smallest id fail E, whatever they fail besides."""
    docs = spark.range(5_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 > 0, F.lit("the same short text")).otherwise(F.concat(F.lit("text "), F.col("id").cast("string"))).alias("text"),
        F.when(F.col("id") % 2 == 0, F.lit("a")).alias("source"),
    )
    labels = spark.range(0, 5_000, 7).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    rows = [tuple(r) for r in docs.collect()]
    want = brute_audit(rows, [tuple(r) for r in labels.collect()])
    assert audited(filter_audit.audit_documents(docs, labels, store)) == want


def test_another_set_of_filters(spark, store, make_docs):
    """Any relations of failing ids can be audited, here two."""
    facts = filter_audit.document_facts(make_docs(["a", "b", "c", "d"]), store)
    fails = {
        "X": facts.where(F.col("doc_id") < 2).select("id"),
        "Y": facts.where(F.col("doc_id").isin(1, 2)).select("id"),
    }
    got = audited(filter_audit.audit(facts, fails, spark.createDataFrame([(1, 1, 0, "")], LABELS), store))
    assert got == {
        ("web", "XY", 1): [2, 2, 0, 1, 1, 0, 3],
        ("web", "XY", 2): [1, 1, 1, 1, 0, 0, 3],
        ("web", "YX", 1): [2, 2, 0, 1, 1, 0, 3],
        ("web", "YX", 2): [1, 1, 1, 1, 0, 0, 3],
    }
