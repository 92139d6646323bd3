"""Encoding of the whole corpus with a public byte-pair tokenizer.

Method: DuckDB recursive queries per partition. The merge table of the
vocabulary is loaded once per Python worker. The distinct words of a slice of
documents become token-position rows; a recursive query joins neighbours with
the merge table and contracts each word's leftmost pair of minimum rank until
no pair merges; an ordered aggregation gives each word's ids. Of one pair all
occurrences in a word that do not overlap are contracted in one step, from the
left, which gives the same result since a merge only makes pairs of larger
rank. Words once encoded are kept, up to a bound, so that frequent ones are
contracted once per worker. One step of the recursion costs what a word is long
and a word takes about as many steps, so words of more than ``SOLID`` bytes (texts
without spaces) are contracted by a heap of their pairs instead, in the same order.
"""

from __future__ import annotations

import base64
import heapq
import os
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZERS = "/opt/tokenizers"
"""Folder of the public vocabularies, if SILTWORKS_TOKENIZERS names no other."""

SOLID = 1024
"""Bytes from which on a word is contracted by a heap."""

#: Fixed value: the published pattern that cuts texts into words before merging.
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_CONTRACT = """
WITH RECURSIVE state(word, pos, tok, done) AS (
  SELECT word, pos, tok, false FROM start
  UNION ALL
  SELECT word, pos, CASE WHEN chosen THEN merged ELSE tok END, least_rank IS NULL
  FROM (
    SELECT *, coalesce(lag(chosen) OVER (PARTITION BY word ORDER BY pos), false) AS swallowed
    FROM (
      SELECT *, hit AND (row_number() OVER (PARTITION BY word, hit, i - nth ORDER BY i)) % 2 = 1 AS chosen
      FROM (
        SELECT *, row_number() OVER (PARTITION BY word, hit ORDER BY i) AS nth
        FROM (
          SELECT p.word, p.pos, p.tok, p.i, m.merged, min(m.rank) OVER (PARTITION BY p.word) AS least_rank,
            m.rank IS NOT NULL AND m.rank = min(m.rank) OVER (PARTITION BY p.word) AS hit
          FROM (
            SELECT word, pos, tok, lead(tok) OVER (PARTITION BY word ORDER BY pos) AS nxt, row_number() OVER (PARTITION BY word ORDER BY pos) AS i
            FROM state WHERE NOT done
          ) p LEFT JOIN merges m ON m.a = p.tok AND m.b = p.nxt
        )
      )
    )
  ) WHERE NOT swallowed
)
SELECT word, list(tok ORDER BY pos) AS ids FROM state WHERE done GROUP BY word ORDER BY word
"""


def tokenizer_path(name: str, folder: str | None = None) -> str:
    return os.path.join(folder or os.environ.get("SILTWORKS_TOKENIZERS", TOKENIZERS), name)


class Encoder:
    """A vocabulary of ranks in a DuckDB connection of this process."""

    def __init__(self, path: str, keep: int = 200_000):
        import duckdb
        import pandas as pd
        import regex

        with open(path, "rb") as f:
            ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}
        rows = [(ranks[t[:k]], ranks[t[k:]], r, r) for t, r in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        self.byte = np.asarray([ranks[bytes([b])] for b in range(256)], np.int32)
        self.cut = regex.compile(WORD_PATTERN).findall
        self.known: dict[str, list[int]] = {}
        self.keep = keep
        self.pairs = {(a, b): r for a, b, r, _ in rows}
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "300MB"})
        frame = pd.DataFrame(rows, columns=["a", "b", "rank", "merged"], dtype=np.int32)  # noqa: F841
        self.con.execute("CREATE TABLE merges AS SELECT * FROM frame")

    def learn(self, words: list[str], rows: int = 400_000) -> dict[str, list[int]]:
        """Ids of distinct words, contracted in slices of at most about ``rows`` bytes."""
        out: dict[str, list[int]] = {}
        part: list[str] = []
        size = 0
        for w in words:
            if 4 * len(w) > SOLID and len(raw := w.encode()) > SOLID:
                out[w] = self._by_heap(raw)
                continue
            part.append(w)
            size += 4 * len(w)
            if size > rows:
                out |= self._contract(part)
                part, size = [], 0
        return out | self._contract(part) if part else out

    def _contract(self, words: list[str]) -> dict[str, list[int]]:
        import pandas as pd

        raw = [w.encode() for w in words]
        n = np.asarray([len(r) for r in raw])
        start = pd.DataFrame({"word": np.repeat(np.arange(len(raw), dtype=np.int32), n), "pos": (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)).astype(np.int32), "tok": self.byte[np.frombuffer(b"".join(raw), np.uint8)]})
        self.con.register("start", start)
        got = self.con.sql(_CONTRACT).to_arrow_table()
        self.con.unregister("start")
        return dict(zip([words[k] for k in got["word"].to_pylist()], got["ids"].to_pylist()))

    def _by_heap(self, raw: bytes) -> list[int]:
        """Ids of one word: the leftmost pair of least rank is merged first, neighbours are a linked list."""
        tok = self.byte[np.frombuffer(raw, np.uint8)].tolist()
        n = len(tok)
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, tok[i], tok[i + 1]) for i in range(n - 1) if (r := self.pairs.get((tok[i], tok[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = right[i]
            if tok[i] != a or j >= n or tok[j] != b:
                continue
            tok[i], tok[j], right[i] = r, -1, right[j]
            if right[i] < n:
                left[right[i]] = i
            for x, y in ((left[i], i), (i, right[i])):
                if x >= 0 and y < n and (k := self.pairs.get((tok[x], tok[y]))) is not None:
                    heapq.heappush(heap, (k, x, tok[x], tok[y]))
        return [t for t in tok if t >= 0]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, offsets) of texts; null and empty ones have none."""
        cut = [self.cut(t) if t else [] for t in texts]
        fresh = set(chain.from_iterable(cut)).difference(self.known)
        if fresh:
            got = self.learn(sorted(fresh))
            if len(self.known) + len(got) > self.keep:
                # the words of this slice are kept, all others make room
                self.known = {w: self.known[w] for w in set(chain.from_iterable(cut)).difference(fresh)}
            self.known |= got
        table = self.known
        lists = [list(chain.from_iterable(map(table.__getitem__, ws))) for ws in cut]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
        return np.fromiter(chain.from_iterable(lists), np.int32, int(offsets[-1])), offsets


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of this process."""
    return Encoder(path)


def encode_corpus(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = "byte_bpe_50k.tiktoken", folder: str | None = None, slice_chars: int = 1_000_000) -> DataFrame:
    """(doc_id, ids ARRAY<INT>) of every row, whole texts, without special tokens.

    Strings that look like special tokens are ordinary text. Null and empty
    texts give the empty list; every row gives one, repeated rows too. Further
    columns are ignored. Only text travels to Python and only ids come back;
    nothing is shuffled.
    """
    path = tokenizer_path(vocabulary, folder)
    if os.path.exists(path):
        # executors without the folder read the copy that is sent along
        docs.sparkSession.sparkContext.addFile(path)

    def run(batches):
        e = encoder(path if os.path.exists(path) else SparkFiles.get(os.path.basename(path)))
        for b in batches:
            keys, texts = b.column(0), b.column(1).to_pylist()
            at = 0
            while at < len(texts):
                to, chars = at, 0
                while to < len(texts) and (to == at or chars + len(texts[to] or "") <= slice_chars):
                    chars += len(texts[to] or "")
                    to += 1
                ids, offsets = e.encode(texts[at:to])
                yield pa.RecordBatch.from_arrays([keys.slice(at, to - at), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))], names=["doc_id", "ids"])
                at = to

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("t")).mapInArrow(run, "doc_id long, ids array<int>")
