"""The pipeline's near-duplicate stage on ids that several texts share."""

import corpus_pipeline
from util import docs_frame, prose


def test_unlike_texts_of_one_id_stay(spark):
    a, b, c, d = (prose(800 + k, 80, vocabulary=900) for k in range(4))
    rows = [(1, a), (1, b), (2, a), (3, b), (4, c), (4, c), (4, c + " more"), (5, d), (5, a), (None, a), (None, a), (6, ""), (6, " ")]
    df = docs_frame(spark, rows)
    left = corpus_pipeline.near_duplicates(spark, df, "")
    assert left.schema == df.schema
    got = sorted(((r.doc_id, r.text) for r in left.collect()), key=repr)
    fours = [r for r in got if r[0] == 4]
    assert len(fours) == 1
    assert got == sorted([(1, a), (1, b), (5, d), (None, a), (None, a), (6, ""), (6, " "), *fours], key=repr)
