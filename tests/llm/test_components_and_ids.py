"""Groups of near copies whose rows share ids, or have none."""

import random

from tests.llm.conftest import frame, prose
from tidewater.llm import jaccard_join


def test_equal_ids_join_no_groups_and_null_ids_have_groups(spark):
    rng = random.Random(6)
    a, b, c, d, e = (prose(rng, 90, 5000) for _ in range(5))
    near = c.split(" ")
    near[40] = "changed"
    rows = [(7, a), (7, b), (8, a), (8, b), (None, c), (None, c), (None, " ".join(near)), (None, d), (9, d), (None, e), (None, None)]
    got = jaccard_join.one_of_each(frame(spark, rows), 3, 80).collect()
    kept = sorted(((r.doc_id, r.text) for r in got), key=str)
    group = [x for x in kept if x[1] in (c, " ".join(near))]
    assert len(group) == 1
    kept.remove(group[0])
    assert kept == sorted([(7, a), (7, b), (9, d), (None, e), (None, None)], key=str)
