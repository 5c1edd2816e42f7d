"""Language identification with many languages."""

import numpy as np

from ledgerline.llm import language


def test_paths_of_more_than_127_languages():
    rng = np.random.default_rng(2)
    want = np.repeat([3, 130, 199, 128], 25)
    scores = rng.random((100, 200)).astype(np.float32)
    scores[np.arange(100), want] += 20
    assert language.paths(scores, np.array([0, 50, 99, 100])).tolist() == want.tolist()
