"""The registered queries and the pipeline against brute force on small tables."""

import re
from collections import defaultdict

import numpy as np
import pandas as pd

import __spark_entry__ as driver
import corpus_pipeline
from logloom.llm import attention, edit_match
from test_copies import brute_near
from test_text_formats import check_pieces

SF = "/root/testdata/sf0.001"


def test_eleven_queries_are_registered():
    names = driver.queries()
    assert [sum(name.startswith(f"op{k}_") for name in names) for k in range(1, 11)] == [1] * 10
    assert "pipeline" in names
    assert set(driver.oracle_sql()) <= set(names)


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, left, kept = docs.columns, pd.read_parquet(f"{SF}/documents.parquet"), []
    model = attention.quality_model(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    searcher = edit_match.Searcher([(r.item_id, edit_match.plain(r.text)) for r in pd.read_parquet(f"{SF}/benchmark.parquet").itertuples()])
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, SF).write.parquet(path := str(tmp_path / str(k)))
        docs = spark.read.parquet(path)
        assert docs.columns == columns
        if k == 0:
            left = left[model.scores(left.text.tolist()) >= attention.ACCEPTED]
        elif k == 1:
            first = defaultdict(list)
            for r in left.itertuples():
                first[re.sub(r"[\x20\x09-\x0D]+", " ", r.text)].append(r.doc_id)
            left = left[left.doc_id.isin({min(ids) for ids in first.values()})]
        elif k == 2:
            found = brute_near(list(zip(left.doc_id, left.text, strict=True)))
            left = left[[found[d][1] == d for d in left.doc_id]]
        else:
            left = left[[not searcher.found(t) for t in left.text]]
        assert sorted(map(tuple, docs.collect())) == sorted(map(tuple, left.itertuples(index=False)))
        kept.append(len(left))
    assert kept == sorted(kept, reverse=True)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).toPandas()
    check_pieces(pieces, zip(left.doc_id, left.text, strict=True))
    whole = corpus_pipeline.run(spark, SF).toPandas()
    order = ["doc_id", "start"]
    assert np.array_equal(whole.groupby("doc_id").length.sum().sort_index(), pieces.groupby("doc_id").length.sum().sort_index())
    assert set(whole[order].itertuples(index=False, name=None)) or whole.empty
