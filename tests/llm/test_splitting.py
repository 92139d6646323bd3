import pytest

from siltworks.llm.splitting import cut_text, split_oversized


def check(text, limit, overlap):
    pieces, forced = cut_text(text, limit, overlap)
    assert all(b - a <= limit for a, b, _ in pieces)
    assert pieces[0][0] == 0 and pieces[-1][1] == len(text)
    for (_, end, _), (start, _, _) in zip(pieces, pieces[1:]):
        assert start == max(0, end - overlap)
    return pieces, forced


def test_prefers_strong_boundaries():
    text = "Alpha beta gamma. Delta one two.\n\nEpsilon zeta eta. Theta iota kappa.\n\nLambda mu nu."
    pieces, forced = check(text, 44, 4)
    assert not forced
    names = [s for *_, s in pieces[1:]]
    assert names.count(4) == 2  # both paragraph ends are cuts


def test_forced_and_unicode():
    text = "é" * 95 + " tail words " + "\U0001f600" * 50
    pieces, forced = check(text, 30, 5)
    assert forced and len(pieces) > 5
    assert not check("x" * 30 + " " + "y" * 30, 30, 5)[1]


@pytest.mark.parametrize("text", ["", " ", "short"])
def test_small(text):
    pieces, forced = cut_text(text, 10, 2)
    assert [(a, b) for a, b, _ in pieces] == ([(0, len(text))] if text else []) and not forced


def test_white_space_only_and_bad_parameters():
    check(" \n" * 60, 20, 3)
    with pytest.raises(ValueError):
        cut_text("abc", 5, 5)


def test_operator_odd_rows(spark):
    rows = [(1, "word " * 500, "x"), (1, "word " * 500, "x"), (2, None, "x"), (3, "", "x"), (4, "z" * 2100, "x"), (5, "ok", "x")]
    df = spark.createDataFrame(rows, "item_id long, parent_text string, piece string")
    got = split_oversized(df, "chunks", "item_id", "parent_text").collect()
    assert {r["item_id"] for r in got} == {1, 4}
    assert {r["cut"] for r in got if r["item_id"] == 4} == {"forced"} and {r["cut"] for r in got if r["item_id"] == 1} == {"natural"}
    one = sorted((r["piece_no"], r["piece"]) for r in got if r["item_id"] == 1)
    assert one[0][1] + "".join(p[200:] for _, p in one[1:]) == "word " * 500
    assert split_oversized(df.limit(0), "chunks", "item_id", "parent_text").count() == 0
