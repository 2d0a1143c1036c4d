"""The registered queries against their SQL, and the pipeline stage by stage."""

import pandas as pd
import pytest
from compare import check
from conftest import DATA

import corpus_pipeline
from hydroframe.llm import oracles, queries


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, name):
    found = queries.queries()[name](spark, DATA).toPandas()
    assert len(found) > 0
    if name in oracles.oracle_sql():
        check(found, oracles.oracle_sql()[name], DATA)


def test_held_out_quality(spark):
    scores = queries.op3_quality(spark, DATA).toPandas().set_index("doc_id")
    labels = pd.read_parquet(f"{DATA}/labels.parquet").set_index("doc_id").quality
    both = scores.join(labels, how="inner")
    both = both[both.held_out]
    assert len(both) > 10 and (both.predicted == both.quality).mean() > 0.9


def test_pipeline(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = corpus_pipeline.shared.written(stage(spark, docs, DATA), f"test-{name}")
        counts.append(docs.count())
        assert docs.columns == columns or name == "encode"
    assert counts == sorted(counts, reverse=True) and counts[-1] > 50
    assert {"n_tokens", "ids_sha256", "decoded_sha256", "source", "slot"} < set(docs.columns)
    slots = docs.groupBy("slot").agg({"source": "max", "*": "count"}).toPandas()
    assert docs.where("slot is null").count() == 0 and sorted(slots.slot) == list(range(len(slots)))


def test_quality_stage_keeps_the_columns_of_the_table(spark):
    """The rows are those that the classifier accepts; columns named like its own pass unchanged, in any case."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    plain = queries.op3_quality(spark, DATA).where("predicted = 1").toPandas()
    named = docs.selectExpr("*", "'mine' as score", "'own' as Predicted", "'x' as _score")
    found = dict(corpus_pipeline.STAGES)["quality"](spark, named, DATA)
    assert found.columns == named.columns
    rows = found.toPandas()
    assert set(rows.score) == {"mine"} and set(rows.Predicted) == {"own"} and set(rows._score) == {"x"}
    assert sorted(rows.doc_id) == sorted(plain.doc_id) and 0 < len(rows) < docs.count()


def test_stages_with_awkward_tables(spark):
    """Nulls, empty texts, repeated rows and columns that stages might use themselves pass; so does an empty table."""
    long, near = " ".join(f"w{i}" for i in range(60)), " ".join(f"w{i}" for i in range(58))
    rows = [(1, None), (2, ""), (3, long), (4, long), (4, long), (5, near), (None, "other words"), (None, "yet other words"), (6, near + " end"), (6, "a text of its own under a repeated id"), (7, "   ")]
    names = ["_id", "id", "_row", "row", "_slot", "slot", "_key", "key", "_digest", "digest", "kept_id", "kept_key", "planned_id", "_salt"]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{n} string" for n in names)
    docs = spark.createDataFrame([(i, t, "en", None if i == 3 else "s", None, *["x"] * len(names)) for i, t in rows], schema)
    stages = dict(corpus_pipeline.STAGES)

    def after(name, frame):
        return sorted(((r["doc_id"], r["text"]) for r in stages[name](spark, frame, DATA).collect()), key=repr)

    exact = [(None, "other words"), (None, "yet other words"), (1, None), (3, long), (5, near), (6, "a text of its own under a repeated id"), (6, near + " end"), (7, "   ")]
    assert after("exact", docs) == sorted(exact, key=repr)
    left = after("near", docs)
    assert sum(t is not None and t.startswith("w0 ") for _, t in left) == 1
    assert {(1, None), (2, ""), (7, "   "), (None, "other words"), (None, "yet other words"), (6, "a text of its own under a repeated id")} <= set(left)
    assert after("mixing", docs) == sorted(rows, key=repr)
    encoded = stages["encode"](spark, docs, DATA).collect()
    assert len(encoded) == len(rows) and all(len(r["ids"]) == r["n_tokens"] for r in encoded)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), DATA).count() == 0, name
    for name in ("quality", "exact", "near", "mixing"):
        assert stages[name](spark, docs, DATA).columns == docs.columns
