"""The stages together, and what each of them does to its own input."""

import subprocess
import sys

import corpus_pipeline as P
from conftest import ROOT, SF_CHECK, SF_SMALL
from edge_tables import edge_docs, no_docs  # noqa: F401
from deskmetrics.llm import jaccard, langid, pii, quality
from deskmetrics.llm.common import table, written


def test_stages_keep_columns_and_take_effect(spark):
    docs = table(spark, SF_CHECK, "documents")
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF_CHECK, "labels").collect()}
    seen = {}
    for name, stage in P.STAGES:
        before = docs
        docs = written(stage(spark, before, SF_CHECK), name)
        seen[name] = (before, docs)
        if name != "packing":
            assert docs.columns == before.columns
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}

    before, after = seen["quality"]
    want = {r["doc_id"] for r in quality.classify(before, table(spark, SF_CHECK, "labels")).where("predicted = 1").collect()}
    assert ids(after) == want
    good = [i for i, q in labels.items() if q == 1]
    assert len(set(good) & want) >= 0.98 * len(good)

    before, after = seen["language"]
    assert ids(after) == {r["doc_id"] for r in langid.identify(before).where("accepted").collect()}

    before, after = seen["near_copies"]
    groups = jaccard.link_groups(before).collect()
    assert ids(after) == {r["doc_id"] for r in groups if r["n_shingles"] == 0 or r["doc_id"] == r["component_id"]}
    again = jaccard.link_groups(after).collect()
    assert all(r["component_id"] == r["doc_id"] for r in again)

    before, after = seen["pii"]
    judge = pii.fit(before)
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    for r in after.collect():
        spans = pii.spans_of(texts[r["doc_id"]], judge)[1]
        assert r["text"] == pii.redact(texts[r["doc_id"]], spans)
        assert not any(pii.base_spans(r["text"]).values())

    before, after = seen["packing"]
    assert ids(after) == ids(before)


def test_the_rest_imports_without_this_folder():
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("deskmetrics.llm"):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert e.queries() and not [q for q in e.queries() if q.startswith("op") or q == "pipeline"]
assert e.oracle_sql()
"""
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_every_operator_is_registered():
    import __spark_entry__ as e

    names = set(e.queries())
    assert "pipeline" in names
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()} == set(range(1, 14))


def test_stages_on_odd_and_empty_tables(spark, edge_docs, no_docs):  # noqa: F811
    """Nulls, repeated rows and ids, long texts and columns of any name go through every stage; so does nothing at all."""
    for docs in (edge_docs, no_docs):
        for name, stage in P.STAGES:
            columns = docs.columns
            docs = written(stage(spark, docs, SF_SMALL), name)
            assert name == "packing" or docs.columns == columns
        assert "sequence_id" in docs.columns
    assert docs.count() == 0


def test_a_run_leaves_only_what_its_result_reads(spark):
    import os

    from deskmetrics.session import scratch, shared_dir

    left = lambda: set(os.listdir(shared_dir(spark).removeprefix("file:")))
    before = left()
    with scratch(spark):
        assert P.run(spark, SF_SMALL).count() > 0
        stages = {name.rsplit("-", 1)[0] for name in left() - before if name.startswith("stage-")}
        assert {f"stage-{name}" for name, _ in P.STAGES[:-1]} <= stages
        assert not any(name.startswith(("sketches-", "verified-")) for name in left() - before)
    assert left() == before
