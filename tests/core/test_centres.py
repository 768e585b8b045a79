"""Centres held against a row all at once, against one after the other."""

import numpy as np

from strandlake.operators import clustering as cl


def test_nearest_centre_is_the_first_of_the_least():
    """One after the other took a NumPy call for each pair of read and centre before."""
    r = np.random.default_rng(5)
    for required, most in ((3, 0.4), (8, 0.25), (0, 1.0)):
        at, plain = cl._Centres([], required, most), []
        for _ in range(150):
            row = r.choice(list("AC.-"), 20, p=[0.4, 0.3, 0.2, 0.1])
            best = None
            for k, c in enumerate(plain):
                both = (row != "-") & (c != "-")
                n, off = int(both.sum()), int((both & (row != c)).sum())
                if (c != "-").sum() >= required and n >= required and n and off / n <= most and (best is None or off < best[0]):
                    best = off, k
            assert at.nearest(row) == (best[1] if best else None)
            if len(plain) < 60 and (best is None or r.random() < 0.3):
                plain.append(row)
                at.add(row)
    assert at.held.shape[0] >= len(at.usable)
