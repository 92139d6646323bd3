"""Keyword-stuffed and link-list pages.

Method: the tokens of a page become a sequence of function-word and word
classes; an interpolated 4-gram model of these classes, counted over the prose
sentences of all documents, gives every segment its perplexity. A segment whose
mean surprise lies too far from that of prose, above or below, is no prose. A page is reported when more than half of
its characters stand in such segments.

The model is a table of class 4-grams by language: at most ``CLASSES ** 4`` rows a language whatever the
corpus, in practice some ten thousands, so it goes to the driver behind a check of its size and is
broadcast. Code blocks and tables are structure, not segments.
"""

from __future__ import annotations

import re
from unicodedata import combining, normalize
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..checkpoints import cut
from .defects import _WORD_LANGS, FUNCTION_WORDS
from .leakage import LOOKALIKES

CLASSES = 48
MOST_GRAMS = 4_000_000
"""Rows of the model that may go to the driver."""
_FUNCTION = 24  # function words share this many classes
_NAMES = ["edge", "low", "cap", "upper", "num", "ident", "url", "link", "tag", "sku", "host", "other", ",", ".", ":", ";", "bullet", "bar", "dash", "quote", "mark", "mixed", "again", "run"]
_ID = {n: _FUNCTION + i for i, n in enumerate(_NAMES)}
_KINDS = {
    "link": r"!?\[[^\]\[\n]*\]\([^()\s]*(?:\s+\"[^\"\n]*\")?\)",
    "url": r"(?:https?://|www\.)\S+",
    "tag": r"#[^\W_]\w*",
    "ident": r"`[^`\n]*`|[^\W_]+(?:_\w+)+",
    "sku": r"\b[A-Z]{1,5}-?\d{2,}\b",
    "host": r"\b[a-z0-9-]+(?:\.[a-z0-9-]+)*\.[a-z]{2,}\b",
    "num": r"\d[\d.,:/]*",
    "word": r"[^\W\d_]+(?:['’][^\W\d_]+)*",
    "p": r"[^\w\s]",
}
_TOKEN = re.compile("|".join(_KINDS.values()))
_KIND = re.compile("|".join(f"(?P<{k}>{v})" for k, v in _KINDS.items()))
_PUNCT = {",": ",", ".": ".", "!": ".", "?": ".", ":": ":", ";": ";", "•": "bullet", "·": "bullet", "*": "bullet", "|": "bar", "/": "bar", ">": "bar", "»": "bar", "-": "dash", "–": "dash", "—": "dash", '"': "quote", "'": "quote", "`": "quote", "“": "quote", "”": "quote", "(": "quote", ")": "quote"}
_FENCE = re.compile(r"^\s*(?:```|~~~)")
_SENTENCE = re.compile(r"^\W*[^\W\d_].*[.!?][\"'”’)\]*_]*$")


def _bare(w: str) -> str:
    return w if w.isascii() else "".join(c for c in normalize("NFKD", w) if not combining(c))


# Function words beyond the few that tell languages apart.
_MORE = (
    "whenever whatever wherever although though unless whereas whether once again about above across against along among around behind below beneath beside between beyond despite down during except inside into like near off onto out outside over past per through throughout toward under up upon via within without"
    " i you he she we they me him her us them my your our their mine yours these those such each every either neither any some all both few many much more most less least other another same own no nor never always often still already even ever just also too very so then thus there here now today later next finally first last"
    " am is was were been being do did doing done had having will would shall could might must need ought provided ones one two three yet rather instead else however therefore else away back"
    " ich du er wir ihr uns euch mein dein unser kein keine keinen alle allen allem jeder jedes jeden dieser diese dieses dies solche man sehr schon immer nie hier dort dann danach zuerst weiter weitere so also doch ja nein ob seit gegen um durch bis ab sobald bevor nachdem während würde wäre war waren sein gewesen kann muss soll will darf mag haben"
    " je tu nous vous ils elles me te lui leur leurs mon ton notre votre mes tes nos vos aucun aucune tout toute tous toutes autre autres même mêmes très déjà toujours jamais ici là alors ainsi donc bien être été avait avoir fait faire doit peuvent sera serait rien plusieurs encore vers chez depuis pendant lors"
    " yo tú él ella nosotros ellos ellas me te nos le les mi tu nuestro este esta esto estos estas ese esa eso aquel otro otra otros otras todo toda todos todas mismo misma muy ya siempre nunca aquí allí entonces así bien ser sido era fue haber hace debe pueden será sería nada varios aún hacia desde hasta sobre ambos sigue"
).split()
_FUNCTION_WORDS = {_bare(w) for w in [*_WORD_LANGS, *_MORE]} - {"near", "like", "past", "need", "last", "me"}


#: Function words of one language only, to its number.
_TELLS = {_bare(w): k for k, ws in enumerate(FUNCTION_WORDS.values()) for w in ws if len(_WORD_LANGS[w]) == 1}


_HIDDEN = {c: None for c in [*range(0x200B, 0x2010), *range(0x2060, 0x2065), 0xFEFF, 0xAD]}
_ALIKE = {ord(k): v for k, v in LOOKALIKES.items()}


def _word_class(w: str) -> int:
    if not w.isascii() and any(c.isascii() for c in w):
        w = w.translate(_ALIKE)
    low = _bare(w.lower())
    if low in _FUNCTION_WORDS:
        return crc32(low.encode()) % _FUNCTION
    if ord(max(w)) >= 0x370:
        return _ID["other"]
    if w.islower() or (w.isupper() and len(w) > 3):
        return _ID["low"]
    if w.istitle():
        return _ID["cap"]
    return _ID["upper"] if w.isupper() else _ID["mixed"]


class Classer:
    """Class ids of a line's tokens.

    A content word among the last ``memory`` ones of its text is of class
    "again"; from the ``longest`` + 1st on, content words in unbroken row are of class
    "run", which a 4-gram could not tell by itself. Tokens are looked up once, up to a bound.
    """

    def __init__(self, bound: int = 200_000, memory: int = 30, longest: int = 7):
        self.known: dict[str, tuple[int, str | None, int]] = {}
        self.bound, self.memory, self.longest = bound, memory, longest
        self.begin()

    def begin(self) -> None:
        """A new text."""
        self.last: dict[str, int] = {}
        self.at = 0

    def _look(self, t: str) -> tuple[int, str | None, int]:
        """Class, lower form of a word, and the language that a word tells."""
        kind = _KIND.match(t).lastgroup
        if kind == "word":
            low = t.lower()
            got = (_word_class(t), low, _TELLS.get(_bare(low), -1))
        else:
            got = (_ID[_PUNCT.get(t, "mark")] if kind == "p" else _ID[kind], None, -1)
        if len(self.known) < self.bound:
            self.known[t] = got
        return got

    def __call__(self, line: str) -> list[int]:
        out = []
        known, last, at, memory, longest, row = self.known, self.last, self.at, self.memory, self.longest, 0
        again, run = _ID["again"], _ID["run"]
        votes = self.votes = [0] * len(FUNCTION_WORDS)
        for t in _TOKEN.findall(line):
            got = known.get(t)
            c, low, tells = got if got is not None else self._look(t)
            if tells >= 0:
                votes[tells] += 1
            if low is None or c < _FUNCTION:
                row = 0
            else:
                at += 1
                row += 1
                if row > longest:
                    c = run
                elif at - last.get(low, -memory) < memory:
                    c = again
                last[low] = at
            out.append(c)
        self.at = at
        return out


def _lines(text: str):
    """(line, is structure) of a text: fenced code, tables, and plain lists under a lead-in line are structure."""
    fence = lead = False
    for raw in re.split(r"\r\n|[\n\r\x0b\x0c\x85  ]", text):
        line = raw.strip() if raw.isascii() else raw.translate(_HIDDEN).strip()
        if not line:
            if not fence:
                yield "", False
            lead = False
            continue
        if _FENCE.match(line):
            fence = not fence
            yield line, True
            continue
        if fence or line.startswith("|"):
            yield line, True
            continue
        item = re.match(r"(?:[-*+]|\d+[.)])\s+[^\[#,]*$", line) is not None
        yield line, lead and item and "://" not in line
        lead = line.endswith(":") or (lead and item)


_MARKER = re.compile(r"^(?:(?:[-*+•>]|\d+[.)]|#{1,6})\s+)+(?:`[^`]*`:\s+)?")


def segments(text: str, classer: Classer, most: int = 60, short: int = 8):
    """(class ids, characters, language) of the segments of a text, and the characters of its structure.

    A segment is a line without its list or heading mark, longer lines in even
    pieces of at most ``most`` tokens. Adjacent lines of fewer than ``short`` tokens that
    end no sentence are read as one, since a list of keywords may stand in
    one line or in many. The language is -1 unless the line is a prose sentence.
    """
    segs, structure = [], 0
    held: list[str] = []
    classer.begin()

    def add(line: str, chars: int) -> None:
        got = classer(line)
        if not got:
            nonlocal structure
            structure += chars
            return
        lang = classer.votes.index(max(classer.votes)) if chars > 40 and is_prose(got) and _SENTENCE.search(line) else -1
        step = -(-len(got) // -(-len(got) // most))
        for k in range(0, len(got), step):
            part = got[k : k + step]
            segs.append((part, chars * len(part) / len(got), lang))

    def flush() -> None:
        if held:
            add(" ".join(_MARKER.sub("", h) for h in held), sum(map(len, held)))
            held.clear()

    for line, fixed in _lines(text):
        if fixed or not line:
            flush()
            structure += len(line)
        elif len(line) < 12 * short and line[-1] not in ".!?:;" and line[0] != "#" and line.count(" ") < short:
            held.append(line)
        else:
            flush()
            add(_MARKER.sub("", line), len(line))
    flush()
    return segs, structure


def _codes(ids: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """4-gram codes of sequences laid end to end, each begun by three edges."""
    starts = np.cumsum(lens) - lens
    place = np.arange(len(ids)) - np.repeat(starts, lens)
    code = ids.astype(np.int64)
    for back in (1, 2, 3):
        before = np.full(len(ids), _ID["edge"], np.int64)
        before[back:] = ids[:-back] if len(ids) > back else before[back:]
        before[place < back] = _ID["edge"]
        code += before * CLASSES**back
    return code


class ClassModel:
    """Interpolated 4-gram model with its mean surprise over the text it was counted on."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, trust: float = 1e-3):
        order = np.argsort(codes)
        self.codes, self.counts = codes[order].astype(np.int64), counts[order].astype(np.float64)
        self.tri = np.bincount(self.codes // CLASSES, self.counts, CLASSES**3)
        self.tri_end = np.bincount(self.codes % CLASSES**3, self.counts, CLASSES**3)
        self.bi = np.bincount(self.codes // CLASSES % CLASSES**2, self.counts, CLASSES**2)
        self.bi_end = np.bincount(self.codes % CLASSES**2, self.counts, CLASSES**2)
        self.uni = np.bincount(self.codes // CLASSES % CLASSES, self.counts, CLASSES)
        self.end = np.bincount(self.codes % CLASSES, self.counts, CLASSES)
        self.total = max(1.0, self.counts.sum())
        self.prior = trust * self.total
        self.mean = float((self.surprise(self.codes) * self.counts).sum() / self.total) if len(self.codes) else 0.0

    def surprise(self, codes: np.ndarray) -> np.ndarray:
        """Bits of the last class of each 4-gram given the first three."""
        w, three, two = codes % CLASSES, codes % CLASSES**3, codes % CLASSES**2
        if len(self.codes):
            at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
            four = np.where(self.codes[at] == codes, self.counts[at], 0.0)
        else:
            four = np.zeros(len(codes))
        p = (self.end[w] + 0.5) / (self.total + 0.5 * CLASSES)
        # a history counts by its own frequency: one that prose hardly knows leaves the word to shorter histories
        for seen, history in ((self.bi_end[two], self.uni[two // CLASSES]), (self.tri_end[three], self.bi[three // CLASSES]), (four, self.tri[codes // CLASSES])):
            p = (seen + self.prior * p) / (history + self.prior)
        return -np.log2(p)


def is_prose(ids: list[int]) -> bool:
    """Whether a sentence may teach the model: enough function words, not mostly words repeated."""
    return len(ids) > 7 and sum(i < _FUNCTION for i in ids) >= 0.18 * len(ids) and ids.count(_ID["again"]) <= 0.15 * len(ids)


_CLASSED = "doc_id long, structure int, ids binary, lens array<int>, chars array<float>, langs array<int>"


def classed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Of each text its class ids, one byte a token, and its segments."""

    def run(batches):
        classer = Classer()
        for b in batches:
            out = []
            for i, t in zip(b["i"], b["t"]):
                segs, structure = segments(t, classer)
                out.append((i, structure, bytes(x for s in segs for x in s[0]), [len(s[0]) for s in segs], [s[1] for s in segs], [s[2] for s in segs]))
            yield pd.DataFrame(out, columns=["doc_id", "structure", "ids", "lens", "chars", "langs"])

    rows = docs.select(F.col(doc_id).cast("long").alias("i"), F.col(text).alias("t")).where("t is not null and i is not null")
    return rows.mapInPandas(run, _CLASSED)


def class_counts(classes: DataFrame) -> pd.DataFrame:
    """Counts of class 4-grams by language over the prose sentences of all documents: lang, code, n."""
    size = CLASSES**4

    def count(batches):
        keys = counts = np.zeros(0, np.int64)
        for b in batches:
            ids = np.frombuffer(b"".join(b["ids"]), np.uint8)
            if not len(ids):
                continue
            lens, langs = np.concatenate([*b["lens"]]).astype(np.int64), np.concatenate([*b["langs"]]).astype(np.int64)
            lang = np.repeat(langs, lens)
            c, n = np.unique((_codes(ids, lens) + size * lang)[lang >= 0], return_counts=True)
            keys, at = np.unique(np.concatenate([keys, c]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([counts, n]), len(keys)).astype(np.int64)
        yield pd.DataFrame({"lang": keys // size, "code": keys % size, "n": counts})

    counts = cut(classes.select("ids", "lens", "langs").mapInPandas(count, "lang int, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n")))
    if counts.count() > MOST_GRAMS:
        raise ValueError(f"more than {MOST_GRAMS} class 4-grams: too many to send to all tasks")
    return counts.toPandas()


def balanced(counts: pd.DataFrame, enough: int = 2000) -> ClassModel:
    """One model in which languages weigh alike, however much of the prose each has.

    What a language weighs grows with its 4-grams and is half its full weight at ``enough`` of them, so
    that a few sentences taken for another language do not shape the model; none is left out.
    """
    if counts.empty:
        return ClassModel(np.zeros(0, np.int64), np.zeros(0))
    total = counts.groupby("lang")["n"].transform("sum")
    weight = counts["n"] / total * (total / (total + enough))
    merged = weight.groupby(counts["code"]).sum()
    merged *= counts["n"].sum() / merged.sum()
    return ClassModel(merged.index.to_numpy(np.int64), merged.to_numpy(np.float64))


def stuffed_pages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", share: float = 0.5, bound: float = 1.6, prior: int = 4, least: int = 40) -> DataFrame:
    """(doc_id, share, worst): pages of whose characters more than ``share`` stand in segments that are no prose.

    A segment's perplexity counts as abnormal if its mean surprise lies ``bound``
    bits or more off that of prose, after ``prior`` tokens of usual surprise are
    added, so that short segments do not count by chance. Null, empty and blank texts,
    and texts of fewer than ``least`` characters, are no pages: a sentence or two holds too few 4-grams to tell. Characters are counted without
    the white space around lines. Segments mostly in scripts that the model has
    no function words of are not judged, nor is anything where no document holds a prose sentence. A document delivered twice gives one row.
    """
    if not 0 <= share < 1 or bound <= 0:
        raise ValueError("share must be in [0, 1) and bound positive")
    classes = cut(classed(docs, doc_id, text))
    model = docs.sparkSession.sparkContext.broadcast(balanced(class_counts(classes)))

    def run(batches):
        m = model.value
        for b in batches:
            ids = np.frombuffer(b"".join(b["ids"]), np.uint8)
            if not len(ids):
                continue
            n = np.asarray([len(x) for x in b["lens"]])
            lens = np.concatenate([*b["lens"]]).astype(np.int64)
            at = np.cumsum(lens) - lens
            dev = np.add.reduceat(m.surprise(_codes(ids, lens)) - m.mean, at) / (lens + prior)
            foreign = np.add.reduceat((ids == _ID["other"]).astype(np.int64), at) > 0.5 * lens
            p = pd.DataFrame({"doc_id": np.repeat(b["doc_id"].to_numpy(), n), "chars": np.concatenate([*b["chars"]]), "dev": dev})
            # without any prose to learn from nothing is judged
            p["bad"] = np.where((np.abs(dev) >= bound) & ~foreign & (len(m.codes) > 0), p["chars"], 0.0)
            p["row"] = np.repeat(np.arange(len(b)), n)
            g = p.groupby("row").agg(doc_id=("doc_id", "first"), chars=("chars", "sum"), bad=("bad", "sum"), worst=("dev", "max"))
            g["total"] = g["chars"] + b["structure"].to_numpy()[g.index]
            g["share"] = g["bad"] / g["total"]
            yield g.loc[(g["share"] > share) & (g["total"] >= least), ["doc_id", "share", "worst"]]

    return classes.mapInPandas(run, "doc_id long, share double, worst double").groupBy("doc_id").agg(F.max("share").alias("share"), F.max("worst").alias("worst"))
