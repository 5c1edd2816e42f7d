"""Outliers in groups that are too small for an estimate."""

import numpy as np

from ledgerline.llm import outliers

PROSE = "the man and the dog of the town is in the house by the river and it was not for us to say that all is well with them"


def test_the_last_small_pool_is_judged(spark):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(420):
        text = " ".join(rng.choice(PROSE.split(), rng.integers(30, 400))).capitalize()
        junk = k % 60 == 0 or k in (401, 402, 411)
        rows.append((k, "".join(f"{w}### " for w in text.split()) if junk else text, "en" if k < 400 else ("xx" if k < 410 else None), "big" if k < 400 else "rare"))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in outliers.judge(outliers.statistics(frame)).collect()}
    assert len(got) == 420 and all(got[k].distance2 is not None for k in got)
    assert not any(got[k].kept for k in (401, 402, 411))
    assert all(got[k].kept for k in range(400, 420) if k not in (401, 402, 411) and not got[k].base_failed)
