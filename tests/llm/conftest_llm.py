"""Helpers of the tests."""

import random


def near(tokens, edits, seed):
    """A copy with some words replaced."""
    r = random.Random(seed)
    out = list(tokens)
    for _ in range(edits):
        out[r.randrange(len(out))] = f"edit{r.randrange(10**6)}"
    return out
