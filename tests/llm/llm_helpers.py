"""Shared by the tests of this folder."""

from __future__ import annotations

import os
import random

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def random_texts(seed, count, words, most):
    rng = random.Random(seed)
    return [" ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 3, 20, most])))
            for _ in range(count)]
