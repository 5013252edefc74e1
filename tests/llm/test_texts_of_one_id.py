"""Near-duplicate removal decides for each text of an id."""

from __future__ import annotations

import corpus_pipeline as P

COPIED = "a text of twenty words that another row with a larger id repeats so that one of both has to go away now"
OWN = "nothing else in all of these rows is like this one which only shares the number of its document with a copy"


def test_texts_of_one_id(spark, make, sf):
    many = [(9, f"number {k} of the texts of an id that holds a third of all the rows {k * k} {k + 7}", None) for k in range(20)]
    rows = [(1, COPIED, None), (2, COPIED, None), (2, OWN, None), (2, OWN, None), (3, None, None), (3, "", None), (None, OWN, None), *many]
    left = P.keep_one_of_each(spark, make(rows), sf)
    got = sorted(((r["doc_id"] or 0, r["text"] or "") for r in left.collect()))
    assert [x for x in got if x[0] != 9] == sorted([(0, OWN), (1, COPIED), (2, OWN), (3, ""), (3, "")])
    assert [x for x in got if x[0] == 9] == sorted((9, t) for _, t, _ in many)
