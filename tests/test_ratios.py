import random
import time
from difflib import SequenceMatcher

import numpy as np

from siltworks.functions import ratios


def texts_of(seed, n, longest):
    rnd, texts = random.Random(seed), []
    for k in range(n):
        letters = rnd.choice(["ab", "abc ", "etaoin shrdlucmfwypvbgkjqxz0123456789", "a"])
        t = "".join(rnd.choices(letters, k=rnd.choice([0, 1, 2, 9, 60, 199, 200, longest])))
        if k and rnd.random() < 0.6:
            u = texts[rnd.randrange(k)]
            x, y = sorted((rnd.randint(0, len(u)), rnd.randint(0, len(u))))
            t = t[: len(t) // 3] + u[x:y] + t[len(t) // 3 :]
        texts.append(t)
    return texts


def test_ratios_are_those_of_difflib(monkeypatch):
    texts = texts_of(1, 60, 420)
    a, b = (x.ravel() for x in np.indices((60, 60)))
    want = np.asarray([SequenceMatcher(None, texts[x], texts[y]).ratio() for x, y in zip(a, b)])
    for longest, places in ((10_000, 100_000), (300, 500)):
        monkeypatch.setattr(ratios, "LONGEST", longest)
        monkeypatch.setattr(ratios, "PLACES", places)
        laid = ratios.Texts(texts)
        for least in (0.0, 0.4, 0.8, 1.0):
            assert np.array_equal(laid.ratios(a, b, least), np.where(want >= least, want, -1.0))
        assert (laid.bound(a, b) >= want).all()
    assert len(ratios.Texts([]).ratios([], [])) == 0


def test_many_ratios_cost_a_part_of_one_by_one():
    rnd = random.Random(2)
    words = ["".join(rnd.choices("etaoinshrdlucmfwypvbgkjqxz", weights=range(26, 0, -1), k=rnd.randint(2, 9))) for _ in range(300)]
    texts = [" ".join(rnd.choices(words, k=48)) for _ in range(60)]
    a, b = np.tril_indices(60, -1)
    began = time.process_time()
    got = ratios.Texts(texts).ratios(a, b, 0.4)
    many = time.process_time() - began
    one = [SequenceMatcher(None, texts[x], texts[y]).ratio() for x, y in zip(a, b)]
    assert many < (time.process_time() - began - many) / 4
    assert np.array_equal(got, [r if r >= 0.4 else -1.0 for r in one])
