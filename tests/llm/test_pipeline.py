"""The corpus pipeline, stage by stage."""

import numpy as np
import pandas as pd

import corpus_pipeline
from goldweave.llm import classifier, decontaminate, simhash
from goldweave.llm.common import table, written

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = table(spark, SF, "documents")
    seen = [docs.toPandas()]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF))
        seen.append(docs.toPandas())
        if name != "sharding":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    start, accepted, unique, clean, mix, final = seen
    scored = classifier.scored(table(spark, SF, "documents"), table(spark, SF, "labels")).toPandas()
    assert set(accepted.doc_id) == set(scored[scored.predicted == 1].doc_id)
    # near duplicates, against all pairs
    sets = {i: simhash.shingle_set(t.encode()) for i, t in zip(accepted.doc_id, accepted.text, strict=True)}
    ids = sorted(sets)
    link = {i: i for i in ids}

    def find(x):
        while link[x] != x:
            x = link[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and (c := len(np.intersect1d(sets[a], sets[b], assume_unique=True))) >= 0.8 * (len(sets[a]) + len(sets[b]) - c):
                link[max(find(a), find(b))] = min(find(a), find(b))
    assert set(unique.doc_id) == {find(i) for i in ids}
    bench = pd.read_parquet(f"{SF}/benchmark.parquet")
    flat = lambda t: " " + " ".join(x.decode() for x in decontaminate.plain(t.encode())) + " "
    leaks = {i for i, t in zip(unique.doc_id, unique.text, strict=True) if any(flat(q) in flat(t) for q in bench.text)}
    assert set(clean.doc_id) == set(unique.doc_id) - leaks
    words = lambda df: df.text.str.split().str.len().sum()
    assert set(mix.doc_id) <= set(clean.doc_id) and mix.doc_id.is_unique
    assert abs(words(mix) / words(clean) - 0.75) < 0.15
    assert sorted(final.doc_id) == sorted(mix.doc_id) and final.shard.between(0, 23).all()


def test_empty_documents(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        table(spark, SF, t).where("false").write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).isEmpty()
