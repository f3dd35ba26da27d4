"""The corpus pipeline against brute-force versions of its stages."""

from collections import Counter

import corpus_pipeline
import __spark_entry__ as E
from hydroframe.llm import pfair_mix, toxicity
from hydroframe.llm.common import documents
from hydroframe.sources.tables import read_table
from tests.conftest import SF_CHECK
from tests.llm.helpers import EDGE_TEXTS, edge_docs, empty_docs
from tests.llm.test_jaccard import brute
from tests.llm.test_placing import check_packing, norm

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def brute_stages(docs, score):
    """(doc_id, text) after toxicity, exact and near copies."""
    clean = [(d, t) for d, t in docs if score(t) < 0.5]
    first = {}
    for d, t in clean:
        first.setdefault(norm(t), []).append((d, t))
    exact = [min(own, key=lambda x: (x[0] is None, x[0])) for own in first.values()]
    near = {(d, c) for d, _, c in brute(exact, 5, 80)}
    return clean, exact, [(d, t) for d, t in exact if d is None or (d, d) in near]


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact dedup", "n-gram Jaccard join", "mixing sources", "best-fit packing"]
    assert "pipeline" in E.queries() and "pipeline" not in E.oracle_sql()


def test_run_matches_brute_force(spark, tmp_path):
    sample = documents(spark, SF_CHECK).where("doc_id < 300")
    copies = sample.where("doc_id < 40").selectExpr("doc_id + 1000 as doc_id", "concat(text, ' \n') as text", "lang", "source", "n_chars")
    near = sample.where("doc_id between 40 and 80").selectExpr("doc_id + 2000 as doc_id", "concat(text, ' and so on') as text",
                                                               "lang", "source", "n_chars")
    sample.unionByName(copies).unionByName(near).write.parquet(str(tmp_path / "documents.parquet"))
    read_table(spark, SF_CHECK, "labels").write.parquet(str(tmp_path / "labels.parquet"))
    sf = str(tmp_path)
    docs = [(r["doc_id"], r["text"]) for r in documents(spark, sf).collect()]
    scorer = toxicity.learn(documents(spark, sf), read_table(spark, sf, "labels"))
    wanted = brute_stages(docs, scorer.score)
    assert len(wanted[0]) < len(docs) and len(wanted[2]) < len(wanted[1]) < len(wanted[0])
    now = documents(spark, sf)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, now, sf)
        assert out.columns == COLUMNS
        out.write.parquet(str(tmp_path / f"stage{k}"))
        now = spark.read.parquet(str(tmp_path / f"stage{k}"))
        want = wanted[min(k, 2)]
        assert Counter((r["doc_id"], r["text"]) for r in now.collect()) == Counter(want), name
    rows = corpus_pipeline.run(spark, sf).collect()
    check_packing(rows, wanted[2])


def test_stages_bear_edge_rows(spark):
    for docs, n in ((edge_docs(spark), len(EDGE_TEXTS)), (empty_docs(spark), 0)):
        now = docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, SF_CHECK)
            assert now.columns == docs.columns and now.count() <= n, name
        packed = corpus_pipeline.STAGES[-1][1](spark, now, SF_CHECK)
        assert (packed.count() > 0) == (n > 0)


def test_packed_sequences_follow_the_mixture(spark, tmp_path):
    docs = documents(spark, SF_CHECK)
    docs.write.parquet(str(tmp_path / "plain"))
    stages = dict(corpus_pipeline.STAGES)
    stages["mixing sources"](spark, docs, SF_CHECK).write.parquet(str(tmp_path / "mixed"))

    def packed(name):
        out = stages["best-fit packing"](spark, spark.read.parquet(str(tmp_path / name)), SF_CHECK)
        return sorted((r["sequence_id"], r["offset"], r["doc_id"]) for r in out.collect())
    place = {r["doc_id"]: r["mix_position"] for r in pfair_mix.pfair_mix(docs).collect()}
    mixed = packed("mixed")
    first = [place[d] for _, offset, d in mixed if offset == 0]
    assert first == sorted(first) and first[0] == 0
    assert mixed != packed("plain")
