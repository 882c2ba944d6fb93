"""Budgets of sources whose documents are longer than the fit by words reaches."""

import pandas as pd
import pytest

from wikiloom.llm.mixing import _fit_source, fit


@pytest.mark.parametrize(
    "lengths,goal,gap",
    [
        ({299000: 1, 300000: 1, 301000: 1}, 302000, 1000),
        ({200000: 1, 160000: 2}, 320000, 0),
        ({70000: 1, 100: 5}, 70400, 0),
        ({500000: 3}, 499999, 499999),
    ],
)
def test_long_documents_are_in_reach(lengths, goal, gap):
    took = fit(lengths, goal)
    assert all(0 <= k <= lengths[n] for n, k in took.items())
    assert goal - sum(n * k for n, k in took.items()) == gap


def test_copies_of_long_documents():
    # 900000 words once, then 302000 more.
    pdf = pd.DataFrame({"_si": 0, "size": [299000, 300000, 301000], "n": 1, "source_size": 900000, "target": 1202000.0})
    got = _fit_source(pdf)
    took = sum(n * (w * 1 + p) for n, w, p in zip(got["size"], got["_whole"], got["_pick"]))
    assert 1202000 - took == 1000
