"""The pipeline's stages, each against brute force on what it was given."""

import brute
import corpus_pipeline as pipeline
import pytest
from pyspark.sql import functions as F

from precinct.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """name -> (rows before, rows after), every stage written and read again."""
    docs, out, base = spark.read.parquet(f"{SF}/documents.parquet"), {}, tmp_path_factory.mktemp("stages")
    for name, stage in pipeline.STAGES:
        path = str(base / name)
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        out[name] = (docs, after)
        docs = after
    return out


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_names():
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "pii", "bpe"]


def test_columns_stay(stages):
    for name, (before, after) in list(stages.items())[:-1]:
        assert before.columns == after.columns, name


def test_toxic_documents_go(spark, stages):
    before, after = stages["toxicity"]
    labels = spark.read.parquet(f"{SF}/labels.parquet").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    left = {r.doc_id for r in after.select("doc_id").collect()}
    known = [(r.doc_id, r.toxic) for r in before.join(labels, "doc_id").collect()]
    assert sum((d in left) != bool(t) for d, t in known) >= 0.9 * len(known)


def test_one_of_each_group(stages):
    before, after = stages["near_dedup"]
    want = {(r[0]) for r in brute.near_dups(pairs(before), 5, 80) if r[3]}
    assert {r.doc_id for r in after.collect()} == want and after.count() == len(want)


def test_contaminated_documents_go(spark, stages):
    before, after = stages["decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    given = pairs(before)
    want = sorted(p for p, r in zip(given, brute.decontamination(given, items)) if not r[5])
    assert sorted(pairs(after)) == want


def test_personal_data_is_gone(stages):
    before, after = stages["pii"]
    given, left = pairs(before), dict(pairs(after))
    assert len(left) == len(given)
    for (d, t), r in zip(given, brute.personal(given)):
        assert (left[d] == t) if not sum(r[1:5]) else left[d] != t
    assert not any(sum(r[1:5]) for r in brute.personal(list(left.items())))


def test_ids(stages):
    before, after = stages["bpe"]
    assert after.count() == before.count() and all(len(r.ids) == 4 * r.n_tokens for r in after.collect())


def test_run(spark, stages):
    assert pipeline.run(spark, SF).count() == stages["bpe"][1].count()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    from compare import canonical, duck

    df = QUERIES[name](spark, SF)
    cur = duck(SF).execute(ORACLE_SQL[name])
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical([c[0] for c in cur.description], cur.fetchall())
