import pytest
from pyspark.sql import functions as F

from siltworks.llm.leakage import folded_words, leaked_items, scan, without_leaks

ITEM = "Each clavier of the Dundale survey carries two brass plates, and crooked clerk will shield wool bales near the miller's second orchard gate"


def test_scan_matches_brute_force():
    import random

    rnd = random.Random(2)
    for _ in range(300):
        n = rnd.randrange(1, 5)
        ws = [rnd.choice("abcd") for _ in range(rnd.randrange(20))]
        item = [rnd.choice("abce") for _ in range(8)]
        wins = {tuple(item[k : k + n]): [7] for k in range(len(item) - n + 1)}
        got = {k for k, _ in scan(ws, wins, {w for x in wins for w in x}, n)}
        assert got == {k for k in range(len(ws) - n + 1) if tuple(ws[k : k + n]) in wins}


def test_documents(spark):
    w = ITEM.split()
    docs = [
        (1, "Intro. " + ITEM.upper() + " Outro."),
        (2, " ".join(w[:11])),
        (3, "x **" + "** <em>".join(w[2:15]) + "</em> y"),
        (4, "  \n ".join(w[3:16]).replace("a", "а").replace("e", "е")),
        (5, ITEM.replace("'", "’").replace(" ", " ")),
        (6, None), (7, ""), (8, " ".join(w[:6]) + " break " + " ".join(w[6:12])), (1, "Intro. " + ITEM.upper() + " Outro."),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(0))
    items = spark.createDataFrame([(10, ITEM), (11, "too short"), (12, None)], "item_id long, text string")
    got = leaked_items(df, items)
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == {(1, 10), (3, 10), (4, 10), (5, 10)}
    assert {r["doc_id"] for r in without_leaks(df, got).collect()} == {2, 6, 7, 8}
    assert leaked_items(df.limit(0), items).count() == 0 and leaked_items(df, items.limit(0)).count() == 0
    with pytest.raises(ValueError):
        leaked_items(df, items, max_windows=3)


def test_words():
    assert folded_words("The <b>miller&#39;s</b> Ｗord, naïve!") == ["the", "millers", "word", "naive"]
