import test_ngram_join as N
import test_packing as K
import test_quality_rules as Q
import test_secret_scan as S

import corpus_pipeline as P
from wapspark.llm import toxicity
from llm_fixtures import docs  # noqa: F401

DIR = "/root/testdata/sf0.001"


def pairs(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_each_stage_against_its_definition(spark, tmp_path):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    names = docs.columns

    def after(name, frame):
        path = str(tmp_path / name)
        frame.write.parquet(path)
        return spark.read.parquet(path)

    rows, stages = pairs(docs), dict(P.STAGES)
    docs = after("q", stages["quality_rules"](spark, docs, DIR))
    assert docs.columns == names
    assert pairs(docs) == [r for r in rows if Q.brute(r[1])["kept"]]

    rows = pairs(docs)
    labels = spark.read.parquet(f"{DIR}/labels.parquet")
    model = toxicity.fit(docs, labels)
    bad = {r.doc_id for r in toxicity.score(docs, model).collect() if r.predicted}
    docs = after("t", stages["toxicity"](spark, docs, DIR))
    assert docs.columns == names
    assert pairs(docs) == [r for r in rows if r[0] not in bad]

    rows = pairs(docs)
    docs = after("n", stages["near_copies"](spark, docs, DIR))
    first = {c for _, _, c, _ in N.brute(rows)}
    assert docs.columns == names and len(first) < len(rows)
    assert pairs(docs) == [r for r in rows if r[0] in first]

    rows = pairs(docs)
    docs = after("s", stages["secret_scan"](spark, docs, DIR))
    assert docs.columns == names
    assert [i for i, _ in pairs(docs)] == [i for i, _ in rows]
    for (_, old), (_, new) in zip(rows, pairs(docs)):
        assert not S.base(new) and (old == new or S.base(old) or "[SECRET]" in new)

    K.check(pairs(docs), stages["packing"](spark, docs, DIR).collect(), 2 * 2048)


def test_run_gives_the_pieces(spark):
    got = P.run(spark, DIR)
    assert got.columns[:4] == ["doc_id", "start", "length", "ids_crc32"]
    assert got.count() > 0
    assert P.ORACLE_SQL is None and len(P.STAGES) == 5


def test_near_copies_odd_rows(docs, spark):
    text = "a b c d e f g h i j"
    d = docs([(1, text), (1, text), (2, text.upper()), (None, text), (None, "alone in the world"),
              (None, None), (4, "")])
    got = P.drop_near_copies(spark, d, DIR)
    assert got.columns == d.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(
        [(1, text), (None, text), (None, "alone in the world"), (None, None), (4, "")], key=str)
