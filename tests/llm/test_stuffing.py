import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltworks.llm import stuffing
from siltworks.llm.stuffing import CLASSES, _codes, _ID, balanced, stuffed_pages


LETTERS = "bdfgklmnprst"
WORDS = [a + v + b + w + c for a in LETTERS for v in "aeo" for b in "lmn" for w in "iu" for c in "kt"]


def prose(rnd, n):
    w = lambda: rnd.choice(WORDS)
    return " ".join(f"The {w()} {w()} {w()}s the {w()} of a {w()} {w()}, and the {w()} {w()}s it when the {w()} is {w()}." for _ in range(n))


def test_codes_restart_with_each_segment():
    e = _ID["edge"]
    f = lambda a, b, c, d: ((a * CLASSES + b) * CLASSES + c) * CLASSES + d
    got = _codes(np.asarray([5, 6, 7, 1], np.uint8), np.asarray([3, 1]))
    assert got.tolist() == [f(e, e, e, 5), f(e, e, 5, 6), f(e, 5, 6, 7), f(e, e, e, 1)]


def test_pages(spark):
    rnd = random.Random(4)
    docs = [(i, prose(rnd, 6)) for i in range(150)]
    spam = {
        1000: " ".join(rnd.choice("cheap buy lamp deal shop free".split()) for _ in range(120)),
        1001: "\n".join(f"https://x{k}.example/a/b?ref={k}" for k in range(40)),
        1002: " ".join(f"#lamp{k % 7} #shop" for k in range(60)),
        1003: prose(rnd, 1) + "\n\n" + "\n".join(f"KA-{1000 + 7 * k} lamp" for k in range(60)),
    }
    fine = {2000: "```\n" + "a = 1\n" * 80 + "```\n" + prose(rnd, 1), 2001: None, 2002: "", 2003: "   ", 2004: "梁漏斗橋한글" * 60, 2005: "These are covered:\n" + "\n".join(f"* old lamp {k}" for k in range(9)) + "\n\n" + prose(rnd, 2)}
    rows = docs + list(spam.items()) + list(fine.items()) + [(1000, spam[1000])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("share", F.lit(1))
    assert {r["doc_id"] for r in stuffed_pages(df).collect()} == set(spam)
    assert stuffed_pages(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        stuffed_pages(df, share=1.5)


def test_no_language_is_left_out(spark, monkeypatch):
    import pandas as pd

    counts = pd.DataFrame([(0, 7, 1_000_000), (1, 9, 5000)], columns=["lang", "code", "n"])
    m = balanced(counts)
    share = dict(zip(m.codes.tolist(), (m.counts / m.counts.sum()).tolist()))
    assert share[9] > 0.35 and abs(sum(share.values()) - 1) < 1e-9
    few = balanced(pd.concat([counts, pd.DataFrame([(2, 11, 3)], columns=counts.columns)]))
    assert 0 < few.counts[list(few.codes).index(11)] < 0.01 * few.counts.sum()
    monkeypatch.setattr(stuffing, "MOST_GRAMS", 3)
    df = spark.createDataFrame([(1, prose(random.Random(1), 5))], "doc_id long, text string")
    with pytest.raises(ValueError):
        stuffed_pages(df)
