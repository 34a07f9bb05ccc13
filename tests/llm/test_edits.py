import random

import numpy as np

from skeinwork.llm import edits
from skeinwork.llm import spellings as S


def edited(rng, text):
    t, k, i = list(text), rng.randrange(4), rng.randrange(len(text)) if text else 0
    if k == 0 and t:
        del t[i]
    elif k == 1:
        t.insert(i, rng.choice("abcz"))
    elif k == 2 and t:
        t[i] = rng.choice("abcz")
    elif i + 1 < len(t):
        t[i], t[i + 1] = t[i + 1], t[i]
    return "".join(t)


def test_against_plain_distance():
    rng = random.Random(1)
    left = ["".join(rng.choice("abc") for _ in range(rng.randrange(45))) for _ in range(3000)]
    right = list(left)
    for k in range(4):
        right = [edited(rng, t) if rng.random() < 0.5 else t for t in right]
    for most in (1, 2, 3):
        exact = np.array([S.distance(a, b, most) for a, b in zip(left, right)])
        assert (edits.osa(left, right, most) == exact).all()
        a, b = (edits.edit_keys(x, np.full(len(x), most)) for x in (left, right))
        shared = {i for i, _ in set(zip(*map(np.ndarray.tolist, a))) & set(zip(*map(np.ndarray.tolist, b)))}
        assert not [i for i in np.flatnonzero(exact <= most) if i not in shared and min(len(left[i]), len(right[i])) > 2 * most]
    assert len(edits.osa([], [], 2)) == 0 and len(edits.edit_keys([], np.empty(0, np.int64))[0]) == 0


def test_long_texts_have_few_keys():
    owners, _ = edits.edit_keys(["ab" * 5000], np.array([2]))
    assert len(owners) < 1000
