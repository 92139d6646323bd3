import base64
import os

import pytest

from siltworks.llm.encoding import WORD_PATTERN, encode_corpus, tokenizer_path

tiktoken = pytest.importorskip("tiktoken")
PATH = tokenizer_path("byte_bpe_50k.tiktoken")
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="no public vocabulary here")


def test_same_ids_as_the_public_encoder(spark):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    want = tiktoken.Encoding("own", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["Hello world's end", "", None, "aaaaaaa aaaaaaaa", "<|endoftext|> text", "naïve café \U0001f600\U0001f600 漢字かな", "  \n\n\t x  ", "x" * 3000, "a\r\nb c", "12345 6789.0", "​zero", " ", "abababababab" * 40]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate([*texts, texts[0]])], "doc_id long, text string, ids string")
    got = {r["doc_id"]: r["ids"] for r in encode_corpus(df, slice_chars=50).collect()}
    assert len(got) == len(texts) + 1
    for i, t in enumerate([*texts, texts[0]]):
        ids = want.encode_ordinary(t) if t else []
        assert got[i] == ids
        assert want.decode(got[i]) == (t or "")
    assert encode_corpus(df.limit(0)).count() == 0


def test_long_words_and_full_tables():
    import random

    from siltworks.llm.encoding import SOLID, Encoder

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    want = tiktoken.Encoding("own", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(1)
    english = "".join(rnd.choice(["the", "tion", "er", "ing", "st", "qu", "zz", "ab", "a", "e"]) for _ in range(9000))
    texts = ["a" * 5000, english, "漢字かな交じり文" * 300, "=" * 2000, " " * 3000 + "x", "".join(rnd.choice("abcdefgh") for _ in range(SOLID + 5))]
    e = Encoder(PATH, keep=3)
    for t in texts:
        for words in ([t], [t, "some other words"], ["one two three four five six", t]):
            ids, at = e.encode(words)
            assert [ids[x:y].tolist() for x, y in zip(at, at[1:])] == [want.encode_ordinary(w) for w in words]
    # the heap and the recursion agree below the bound
    for _ in range(60):
        w = "".join(rnd.choice(["in", "g", "th", "e", "a", "ab", "é", "s"]) for _ in range(rnd.randrange(1, 120)))
        assert e._by_heap(w.encode()) == e._contract([w])[w]
