"""Broken prompt and response pairs.

Each pair gets its defect type or null. Copies are detected by compressing the
response with its prompt as zstandard dictionary: a response that the prompt
alone explains leaves almost nothing. Language and refusal dictionaries give
``language`` and ``refusal``; ``truncated`` comes from a terminal-context model:
how often a word, and a pair of words, ends a sentence and how often it stands
elsewhere, counted over all answers. Only the last words of answers that nothing
else decides are asked for, so the model is a relation that is counted for these words and
joined to them; it is exact whatever the size of the vocabulary.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from functools import lru_cache
from itertools import islice
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..checkpoints import cut
from .words import words

# Answers that hold nothing but a placeholder.
PLACEHOLDERS = frozenset("n/a na none null nil nan undefined tbd todo empty blank missing placeholder answer response unknown lorem".split()) | {"no answer", "not available", "not applicable", "to be done", "keine antwort", "sans réponse", "sin respuesta", "k. a", "k.a"}

# Frequent function words of the languages told apart.
FUNCTION_WORDS = {
    "en": "the of and to in is that for it with as on by at from or which this an be are was has have not but when if while its only one before after than because since what how who where does should can may keeps whoever both until".split(),
    "de": "der die das und ist nicht von zu den mit sich des auf für im dem ein eine einer eines als auch an es wird werden haben hat nach bei nur noch wenn dass damit danach oder aus wie was wann wo warum welcher sollte falls ohne alle solange denn unter jede jeder jedem vor einmal".split(),
    "fr": "le la les de des du et est un une que qui dans pour pas au aux sur se ce cette il elle par avec plus ne sont son sa ses ou où en lorsque dès puis avant après sans sous car quel quelle quand pourquoi comment une fois chaque peut faut vaut afin entre".split(),
    "es": "el la los las de del y es un una que en por para con no se su sus al lo como más pero o ya está están sin cuando tras porque después cada solo qué cuál cuándo cómo dónde puede hay conviene debajo mientras según entre si antes durante".split(),
}
_LANGS = tuple(FUNCTION_WORDS)
_WORD_LANGS: dict[str, tuple[str, ...]] = {}
for _lang, _words in FUNCTION_WORDS.items():
    for _w in _words:
        _WORD_LANGS[_w] = (*_WORD_LANGS.get(_w, ()), _lang)

# What an answer says that only declines, and what may follow it.
REFUSALS = (
    r"(?:i(?:'m| am)? )?(?:sorry|apologi[sz]e|afraid)\b|\bregrettably\b|\bunfortunately\b",
    r"\b(?:can(?:not|'t| not)|could not|couldn't|am unable|not able|unable|not possible|won't|will not|must not|not allowed)\b.{0,60}\b(?:answer|help|say|tell|comment|assist|respond|discuss|provide|determine|share|know)",
    r"\b(?:not possible|impossible)\b.{0,30}\bcomment",
    r"\b(?:does not|doesn't|do not|don't|never|nothing|no|not)\b.{0,50}\b(?:mention|mentions|mentioned|cover|covers|covered|state|states|stated|say|says|specif\w*|details?|information|describe[sd]?|contain[s]?|access|regarding|names?)\b",
    r"\b(?:passage|text|context|excerpt|section|source|document|page)\b.{0,40}\b(?:does not|doesn't|says nothing|gives no|has no|never|nothing|no)\b",
    r"\bmore context\b|\bbeyond the (?:given|provided)\b|\bcannot be answered\b",
    r"\b(?:leider|tut mir leid|entschuldigung|bedaure)\b|\bkann ich\b.{0,80}\bnicht\b|\bkeine (?:auskunft|angaben?|informationen?|antwort|aussage)\b|\bnicht (?:beantworten|erwähnt|enthalten|genannt|möglich)\b|\bdarf ich\b.{0,40}\bkeine\b",
    r"\b(?:désolée?|malheureusement|hélas|je regrette)\b|\bne (?:peux|puis|peut|dit|mentionne|figure|contient|précise|permet)\b.{0,60}\b(?:pas|rien|aucune?)?|\baucune? (?:information|indication|détail|réponse|mention)\b",
    r"\b(?:lo siento|lamentablemente|disculp\w*|perdón)\b|\bno (?:puedo|puede|hay|menciona|dice|contiene|es posible|figura|tengo|aparece)\b.{0,60}|\bninguna (?:información|mención|respuesta)\b",
)
FILLERS = (
    r"\blet me know\b|\bcould you\b|\bplease (?:share|provide|ask|give|contact)\b|\bcontact\b|\bno answer can be given\b|\banother question\b|\bask (?:me|again)\b|\bhappy to help\b|\bif you (?:share|have|need|like)\b|\btry\b.{0,30}\b(?:elsewhere|manual|vendor|support)\b",
    # where else to look, and what holds in general
    r"\b(?:please )?(?:consult|see|refer to|check|read|visit)\b.{0,40}\b(?:manuals?|documentation|docs|guide|vendors?|support|reference|website|release notes)\b",
    r"^\W*(?:in general|generally|usually|typically|normally|as a rule|im allgemeinen|allgemein|in der regel|normalerweise|en général|généralement|en règle générale|d'habitude|en general|generalmente|por lo general|normalmente)\b",
    r"\b(?:bitte|wenden sie|fragen sie|gern\w*)\b|\b(?:veuillez|n'hésitez|contactez|merci)\b|\b(?:por favor|contacte|consulte|pregunte|avíseme)\b|\bwithout (?:it|more)\b",
)
_refusal = re.compile("|".join(f"(?:{x})" for x in REFUSALS), re.I)
_filler = re.compile("|".join(f"(?:{x})" for x in FILLERS), re.I)

# Words that a sentence does not end on.
OPEN_WORDS = frozenset(
    "the a an of and or to in on at by for from with as that which who whose because since while whenever although though if unless until when where than its their his her our your this these those is are was were be been being has have had does do did will would can could may might must shall should not very more most such into onto about under over between among through during before after per via each every both either neither nor but so yet only first also".split()
    + "der die das den dem des ein eine einen einem einer und oder aber weil da dass damit wenn falls ob als wie von vom zu zum zur in im auf für mit bei nach aus an am über unter vor durch ohne um bis seit denn sondern jede jeder jedes sein ihre ist sind wird werden".split()
    + "le la les l un une des du de d et ou mais car que qui dont où dans sur sous avec sans pour par en au aux ce cet cette ces son sa ses leur est sont être lorsque puisque quand si dès chaque ne".split()
    + "el la los las un una unos unas y o u e pero porque que de del a al en con sin por para sobre tras entre su sus cuando si como donde cada es son ser está están lo".split()
)
# Words that do end sentences though they are on the list above.
_MAY_END = frozenset("on in off over under before after through about not so only first also more most very each both down up out".split())
_FENCE = re.compile(r"^\s*(```|~~~)", re.M)
_INVISIBLE = re.compile(r"[​-‏⁠-⁤﻿­᠎‪-‮]")
_TAGS = re.compile(r"<!--.*?-->|</?[A-Za-z][^<>]*>|<[A-Za-z/][^<>]*$", re.S)
_SENT = re.compile(r"(?<=[.!?…])[\"'”’»)\]]*\s+|\n+")
_END_MARK = re.compile(r"[.!?。！？…][\"'”’»)\]*_`>]*$")
_IDENT = re.compile(r"[`“”\"'‘’«»]*\b[a-z0-9]+(?:_[a-z0-9]+)+\b[`“”\"'‘’«»]*", re.I)

_QUOTED = re.compile(r"[\"“„«][^\"“”„«»]{12,}[\"”“»]")
_CODE = re.compile(r"```.*?(?:```|$)|`[^`\n]*`", re.S)

ASKED = 1 << 22
"""Bits of the filter that tells which words are asked for; a word let through by chance is only counted in vain."""
KNOWN, SHARE = 3, 0.08
"""A word or pair is known from so many occurrences on, and ends texts if this share of them ends a sentence."""


def visible(text: str | None) -> str:
    """Text without markup, invisible marks and outer white space."""
    if not text:
        return ""
    if "<" in text:
        text = _TAGS.sub(" ", text)
    if "&" in text:
        text = html.unescape(text)
    return (text if text.isascii() else _INVISIBLE.sub("", text)).strip()


def _hollow(v: str) -> bool:
    core = " ".join(m[0] for m in islice(_TOKEN.finditer(v), 5)).lower()
    return not core or core in PLACEHOLDERS or v.lower().strip(" .()[]{}<>*_`\"'-–—:") in PLACEHOLDERS


def is_empty(text: str | None) -> bool:
    v = visible(text)
    return _hollow(v) or not _TOKEN.search(v)


def language(ws: list[str]) -> tuple[str | None, float, int]:
    """The language whose function words are most frequent, its lead over the next, and its hits."""
    score = dict.fromkeys(_LANGS, 0.0)
    hits = dict.fromkeys(_LANGS, 0)
    for of in filter(None, map(_WORD_LANGS.get, ws)):
        share = 1 / len(of)
        for lang in of:
            score[lang] += share
            hits[lang] += 1
    (s1, a), (s2, _) = sorted(((v, k) for k, v in score.items()), reverse=True)[:2]
    return (a, s1 - s2, hits[a]) if s1 > 0 else (None, 0.0, 0)


def is_refusal(text: str) -> bool:
    """Whether every sentence declines or is filler after one that declines.

    What stands in quotation marks is reported, not said, and counts as a word.
    """
    t = _QUOTED.sub("quoted", text)
    if "_" in t:
        t = _IDENT.sub("it", t)
    declines = 0
    for p in _SENT.split(t.replace(";", ". ")):
        if not p or not _TOKEN.search(p):
            continue
        if _refusal.search(p):
            declines += 1
        elif not _filler.search(p):
            return False
    return declines > 0


@lru_cache(maxsize=1)
def _compressor():
    import zstandard

    return zstandard


def residue(prompt: str, response: str) -> float:
    """Compressed size of the response, with its prompt as dictionary, by its length."""
    z = _compressor()
    level = z.ZstdCompressionParameters.from_level(19, write_content_size=0, write_checksum=0, write_dict_id=0)
    d = z.ZstdCompressionDict(prompt.encode(), dict_type=z.DICT_TYPE_RAWCONTENT)
    return max(0, len(z.ZstdCompressor(dict_data=d, compression_params=level).compress(response.encode())) - 9) / max(1, len(response.encode()))


def is_copy(question: str, answer: str, said: list[str] | None = None) -> bool:
    """Whether an answer only repeats its question; ``said`` are the answer's words if it is known to hold no markup."""
    q, a = words(question), words(answer) if said is None else said
    if not q or not a or len(a) < 0.5 * len(q):
        return False
    if len(set(a).difference(q)) > 6:
        return False
    said = " ".join(a)
    # a few bytes for lead words weigh little against a long question, much against a short one
    if residue(" ".join(q), said) > 0.35 + 8 / len(said.encode()):
        return False
    # little is left: it must be lead words, nothing that answers
    left = list(q)
    extra = []
    for w in a:
        if w in left:
            left.remove(w)
        elif w not in q:
            extra.append(w)
    return len(extra) <= 6 and len(left) <= 0.34 * len(q)


def ends_open(text: str) -> bool | tuple[str | None, str]:
    """Whether a text breaks off, by its last context; (word before, last word) if the corpus must tell."""
    t = text.rstrip()
    if "`" not in t and "~" not in t and t[-1:] in ".!?" and not t.endswith("...") and not re.search(r"(?:^|\n)\s*(?:[-*+•]|\d+[.)])$", t[-12:]):
        return False
    fences = _FENCE.findall(t)
    if len(fences) % 2:
        return True
    if fences and re.search(r"(?:```|~~~)\s*$", t):
        return False
    last_line = t.rsplit("\n", 1)[-1].strip()
    if re.search(r"(?:…|\.\.\.)$", t):
        return True
    if re.match(r"(?:[-*+•]|\d+[.)])\s*$", last_line):
        return True
    if _END_MARK.search(t):
        # a full stop after a word that ends no sentence does not save it
        return False
    if re.search(r"[,;:(\[{=&+/–—-]$", t):
        return True
    if re.match(r"(?:[-*+•]|\d+[.)])\s+\S", last_line) and re.search(r"[`*_\"”’)]$", last_line):
        return False
    if t.count("`") % 2:
        return True
    m = re.search(r"([^\W_]+(?:_[^\W_]+)*)\W*$", last_line)
    if not m:
        return False
    w = m.group(1).lower()
    if last_line.endswith("`") or "_" in w or w.isdigit():
        # a setting or a number closes a sentence only where a verb could
        return False
    prev = re.search(r"([^\W_]+)\W+[^\W_]+\W*$", last_line)
    if re.search(r"…\s*\w+$", last_line):
        return True
    if w in OPEN_WORDS and w not in _MAY_END:
        return True
    return prev.group(1).lower() if prev else None, w


_TOKEN = re.compile(r"[^\W_]+")
_ENDING = re.compile(r"(?<![^\W_])([^\W_]+)[\W_]+([^\W_]+)[`\"'”’)\]*_]*[.!?;](?=\s|$)")


class _Counts:
    """Words and word pairs seen, and those that end a sentence or clause, of the words asked for."""

    def __init__(self, asked: np.ndarray, most: int = 200_000):
        self.asked, self.most = asked, most
        self.pairs: Counter = Counter()
        self.last: Counter = Counter()

    def add(self, text: str) -> bool:
        """Count a text; true if the counts should be taken."""
        low = text.lower()
        ws = _TOKEN.findall(low)
        self.pairs.update(zip(ws, ws[1:]))
        self.last.update(_ENDING.findall(low))
        return len(self.pairs) > self.most

    def take(self) -> pd.DataFrame:
        sums: dict[tuple, list[int]] = {}
        for k, counts in enumerate((self.last, self.pairs)):
            for (x, w), n in counts.items():
                if self.asked[crc32(w.encode()) % ASKED]:
                    for key in ((x, w), (None, w)):
                        sums.setdefault(key, [0, 0])[k] += n
            counts.clear()
        return pd.DataFrame([(*k, e, max(e, n)) for k, (e, n) in sums.items()], columns=["before", "word", "ends", "seen"])


def terminal_counts(answers: DataFrame, asked: DataFrame, answer: str = "answer") -> DataFrame:
    """(before, word, ends, seen) of the words of ``asked``: how often a pair, or a word (``before`` null), ends a sentence, and all its occurrences.

    Counted over all answers that end in a full stop. At most ``ASKED`` numbers of
    hashed words go to the driver and are broadcast as a filter.
    """
    got = asked.select(F.pmod(F.crc32(F.col("word").cast("binary")), F.lit(ASKED)).cast("int").alias("k")).distinct().toPandas()
    bits = np.zeros(ASKED, np.bool_)
    bits[got["k"]] = True
    shared = answers.sparkSession.sparkContext.broadcast(bits)

    def count(batches):
        c = _Counts(shared.value)
        for b in batches:
            for text in b["t"]:
                if c.add(text):
                    yield c.take()
        yield c.take()

    closed = answers.select(F.rtrim(F.col(answer)).alias("t")).where(F.col("t").rlike(r"[.!?]$"))
    return closed.mapInPandas(count, "before string, word string, ends long, seen long").groupBy("before", "word").agg(F.sum("ends").alias("ends"), F.sum("seen").alias("seen"))


def defect(question: str | None, answer: str | None) -> tuple[str | None, tuple[str | None, str] | None]:
    """(``empty``, ``copy``, ``refusal``, ``truncated``, ``language``, the first that holds, or null; None).

    If the corpus must tell whether the answer breaks off, the second is what :func:`ends_open` asks
    and the first is the defect in case it does not.
    """
    v, q = visible(answer), question or ""
    low = v.lower()
    said = _TOKEN.findall(low)
    if not said or (len(said) < 5 and _hollow(v)):
        return "empty", None
    if is_copy(q, v, None if "](" in v or "<" in v or "&" in v else said):
        return "copy", None
    if is_refusal(v):
        return "refusal", None
    open_ = ends_open(v)
    if open_ is True:
        return "truncated", None
    if "`" in v:
        said = _TOKEN.findall(_CODE.sub(" ", low))
    ql, qlead, qhits = language(_TOKEN.findall(_IDENT.sub(" ", q.lower())))
    al, alead, ahits = language(said)
    other = "language" if ql and al and ql != al and qlead >= 1 and alead >= 2 and ahits >= 3 else None
    return other, open_ or None


def flag_defects(df: DataFrame, record_id: str = "record_id", question: str = "question", answer: str = "answer") -> DataFrame:
    """(record_id, defect) of each defective pair.

    A null question is compared as empty; a null answer is ``empty``. Repeated
    rows of a record give one row (the smallest defect if they differ). An empty
    table gives no rows; further columns are ignored.
    """

    def run(batches):
        for b in batches:
            out = []
            for i, q, a in zip(b["record_id"], b["q"], b["a"]):
                d, ask = defect(q, a)
                if d or ask:
                    out.append((i, d, *(ask or (None, None))))
            yield pd.DataFrame(out, columns=["record_id", "defect", "before", "word"])

    rows = df.select(F.col(record_id).cast("long").alias("record_id"), F.col(question).alias("q"), F.col(answer).alias("a"))
    told = cut(rows.mapInPandas(run, "record_id long, defect string, before string, word string"))
    asked = told.where("word is not null")
    counts = cut(terminal_counts(df, asked, answer))
    pair = counts.where("before is not null").select("before", "word", F.col("ends").alias("pe"), F.col("seen").alias("pn"))
    word = counts.where("before is null").select("word", F.col("ends").alias("we"), F.col("seen").alias("wn"))
    # the pair decides if known, else the word; an unknown word is a cut one
    by_pair, by_word = F.col("pe") >= SHARE * F.col("pn"), (F.col("wn") >= KNOWN) & (F.col("we") >= SHARE * F.col("wn"))
    ends = F.when(F.col("pn") >= KNOWN, by_pair).otherwise(F.coalesce(by_word, F.lit(False)))
    decided = asked.join(pair, ["before", "word"], "left").join(word, "word", "left").select("record_id", F.when(ends, F.col("defect")).otherwise("truncated").alias("defect"))
    found = told.where("word is null").select("record_id", "defect").union(decided.where("defect is not null"))
    return found.groupBy("record_id").agg(F.min("defect").alias("defect"))
