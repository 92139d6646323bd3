"""Page boilerplate apart from main content.

Method: layout-aware rendering. A tree builder reads HTML with implied end
tags; visibility rules drop what a page does not show; the renderer emits all
visible text and keeps block spacing, lists and aligned table cells. Extracted
text (lines of Markdown) enters a block tree of elements, blocks and lines by its
own marks, and lines of HTML by their elements (:func:`page_tree`). Blocks of
the tree are then main content or furniture: by visibility, by the form of their lines
(links, labels, trails, pagers, sentences with buttons), and by repetition: a line
all of whose parts stand on many pages, and seldom beside prose, belongs to
the site and not to the article (:class:`Repeats`, counted over all texts).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- rendering of HTML -------------------------------------------------------

# Elements by their place in the layout.
BLOCKS = frozenset("address article aside blockquote body dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody tfoot thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = frozenset("head script style template noscript title iframe object svg canvas select button".split())
FURNITURE = frozenset("nav footer aside".split())
ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert toolbar".split())
#: A start tag on the left ends an open element on the right that stands nearest.
IMPLIED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}} | {t: {"p"} for t in BLOCKS - {"li", "dt", "dd", "tr", "tbody", "tfoot", "thead", "html", "body"}}
#: What a search for an open element does not leave.
SCOPES = frozenset("table ul ol dl html body div section article main aside nav".split())
#: Elements nested deeper are laid side by side, which changes no text and no order.
DEEPEST = 400


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict | None = None):
        self.tag, self.attrs, self.children = tag, attrs or {}, []


class TreeBuilder(HTMLParser):
    """A tree from HTML of any quality; never raises."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html")
        self.open = [self.root]
        self.flat: list[str] = []  # open elements too deep to nest, laid into the deepest one

    def handle_starttag(self, tag, attrs):
        ends = IMPLIED.get(tag, ())
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag in ends:
                del self.open[k:]
                if tag not in ("tbody", "tfoot", "tr"):
                    break
            elif self.open[k].tag in SCOPES:
                break
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag in VOID:
            return
        # one that hides its children is nested at any depth, since below it nothing matters
        if len(self.open) < DEEPEST or (not shown(node, True) and all(shown(x, True) for x in self.open[DEEPEST:])):
            self.open.append(node)
        else:
            self.flat.append(tag)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].children.append(Node(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag):
        for k in range(len(self.flat) - 1, -1, -1):
            if self.flat[k] == tag:
                del self.flat[k:]
                return
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


def tree(html: str) -> Node:
    b = TreeBuilder()
    b.feed(html)
    b.close()
    return b.root


def shown(node: Node, main_only: bool) -> bool:
    """Whether a page shows an element; with ``main_only``, whether it is also no landmark of page furniture."""
    a = node.attrs
    if node.tag in HIDDEN or "hidden" in a or a.get("aria-hidden", "").lower() == "true":
        return False
    if re.search(r"(?:display\s*:\s*none|visibility\s*:\s*hidden)", a.get("style", ""), re.I):
        return False
    return not main_only or (node.tag not in FURNITURE and a.get("role", "").lower() not in ROLES)


def render(node: Node, main_only: bool = True) -> str:
    """Visible text of a tree: blocks apart, list marks, table cells aligned in columns."""
    out: list[str] = []

    def text_of(n) -> str:
        if isinstance(n, str):
            return re.sub(r"\s+", " ", n)
        if n.tag == "br":
            return "\n"
        if n.tag == "img":
            return n.attrs.get("alt", "")
        return "".join(text_of(c) for c in n.children) if shown(n, main_only) else ""

    def rows_of(n) -> Iterator[Node]:
        for c in n.children:
            if isinstance(c, Node) and shown(c, main_only):
                if c.tag == "tr":
                    yield c
                elif c.tag in ("thead", "tbody", "tfoot"):
                    yield from rows_of(c)

    def block(lines: list[str]) -> None:
        if lines:
            if out:
                out.append("")
            out.extend(lines)

    def walk(n: Node, depth: int, item: str) -> None:
        inline: list[str] = []

        def flush() -> None:
            lines = [re.sub(r" +", " ", x).strip() for x in "".join(inline).split("\n")]
            inline.clear()
            while lines and not lines[0]:
                lines.pop(0)
            while lines and not lines[-1]:
                lines.pop()
            if lines:
                block(lines)

        count = 0
        for c in n.children:
            if isinstance(c, str) or c.tag not in BLOCKS:
                if isinstance(c, Node) and any(isinstance(x, Node) and x.tag in BLOCKS for x in c.children) and shown(c, main_only):
                    flush()
                    walk(c, depth, item)
                else:
                    inline.append(text_of(c))
                continue
            flush()
            if not shown(c, main_only):
                continue
            if c.tag == "pre":
                block("".join(x if isinstance(x, str) else text_of(x) for x in c.children).strip("\n").split("\n"))
            elif c.tag == "table":
                cells = [[re.sub(r"\s+", " ", text_of(d)).strip() for d in r.children if isinstance(d, Node) and d.tag in ("td", "th")] for r in rows_of(c)]
                cells = [r for r in cells if any(r)]
                wide = [max((len(r[k]) for r in cells if k < len(r)), default=0) for k in range(max(map(len, cells), default=0))]
                block([" | ".join(v.ljust(wide[k]) for k, v in enumerate(r)).rstrip() for r in cells])
            elif c.tag in ("ul", "ol"):
                lines = []
                for li in (x for x in c.children if isinstance(x, Node) and shown(x, main_only)):
                    count += 1
                    held, out[:] = list(out), []
                    walk(li, depth + 1, "")
                    body, out[:] = [x for x in out if x], held
                    if body:
                        mark = f"{count}. " if c.tag == "ol" else "- "
                        lines += [mark + body[0], *("  " + x for x in body[1:])]
                count = 0
                block(lines)
            elif re.fullmatch(r"h[1-6]", c.tag):
                head = re.sub(r"\s+", " ", text_of(c)).strip()
                block(["#" * int(c.tag[1]) + " " + head] if head else [])
            else:
                walk(c, depth, item)
        flush()

    walk(node, 0, "")
    return "\n".join(out)


# --- furniture in extracted text ---------------------------------------------

# The two lists that follow serve single texts only, where no corpus tells what repeats.
# Titles of side boxes.
BOX_TITLES = (
    r"related (?:articles|pages|topics|links|posts)|popular (?:pages|articles|posts)|more in this section|on this page|(?:table of )?contents|in this (?:article|section|page)|see also|recommended(?: for you)?|what to read next|you may also like|most (?:read|viewed)|recent posts|further reading"
    r"|auf dieser seite|inhalt(?:sverzeichnis)?|in diesem (?:artikel|abschnitt)|verwandte (?:artikel|seiten|themen)|siehe auch|beliebte (?:seiten|artikel)|ähnliche (?:artikel|seiten)|mehr in diesem (?:abschnitt|bereich)|weitere (?:artikel|seiten)|das könnte (?:sie|dich) auch interessieren"
    r"|sur cette page|sommaire|table des matières|dans cet(?:te)? (?:article|section|page)|articles (?:liés|connexes|similaires)|pages (?:liées|populaires|connexes)|voir aussi|à lire aussi|dans la même (?:section|rubrique)|contenu"
    r"|en esta página|en este artículo|en esta sección|contenido|índice|artículos relacionados|páginas (?:relacionadas|populares)|temas relacionados|ver también|véase también|más en esta sección"
)
# Beginnings of lines that belong to the page, not to its text.
PHRASES = (
    r"skip to|jump to|zum (?:haupt)?inhalt|direkt zum|aller au contenu|passer au|saltar al|ir al contenido",
    r"☰|≡|(?:open|close|show|hide|toggle|main) (?:menu|navigation|theme|sidebar|search|dark mode)|menu$|menü|menú|menu principal|navigation (?:ein|aus|öffnen)|thema wechseln|changer (?:le|de) thème|cambiar (?:el )?tema|(?:ouvrir|afficher|basculer) (?:le|la) (?:menu|navigation)|(?:abrir|mostrar) (?:el )?menú",
    r"search\b.{0,60}(?:docs|manual|⌘k|ctrl|…|\.\.\.)|\[search|suche in|durchsuchen|rechercher|buscar en",
    r"(?:log|sign) (?:in|out|up)\b|login\b|anmelden|abmelden|registrieren|se connecter|connexion|s'inscrire|iniciar sesión|acceder|registrarse",
    r"you are here|sie sind hier|vous êtes ici|usted está aquí|estás aquí|startseite\s*[>»/]",
    r"(?:©|\(c\)\s*\d|copyright\b)|.{0,80}(?:all rights reserved|alle rechte vorbehalten|tous droits réservés|todos los derechos reservados)",
    r"(?:last (?:updated|modified|edited|changed|reviewed)|updated on|zuletzt (?:geändert|aktualisiert)|stand:|dernière (?:mise|modification)|mis à jour|última (?:actualización|modificación)|actualizado)\b",
    r"(?:subscribe|sign up|newsletter|abonnieren|abonnez-vous|suscríbase)\b",
    r"(?:rate this|was this (?:page|article)|did this (?:answer|help)|is this page helpful|how helpful|war diese seite|hat (?:ihnen |das )?.{0,30}geholfen|cette page vous|.{0,12}ayudó esta|¿?(?:le|te) (?:ayudó|resultó)|fue útil|diese seite bewerten|bewerten|noter cette|valore esta|[^\W\d_].{0,60}(?:[👍👎]|★{3,}))",
    r"(?:share (?:on|this|via)|print(?: this)?(?: page)?$|edit (?:this|on)|view (?:page )?source|back to top|copied!?$|copy (?:link|to clipboard|code)|report (?:an? )?(?:issue|bug|problem)|download (?:as )?pdf|open in|improve this page|suggest (?:an )?edit)",
    r"(?:zurück (?:nach oben|zum anfang)|seite (?:bearbeiten|drucken|teilen)|drucken$|teilen$|nach oben|zum seitenanfang|link kopieren|kopiert!?$|quelltext|problem melden)",
    r"(?:imprimer|modifier cette|partager|haut de (?:la )?page|retour en haut|copier le|copié|voir la source|signaler)",
    r"(?:imprimir|editar esta|compartir|volver arriba|copiar (?:el )?enlace|copiado|ver (?:el )?(?:código|fuente)|informar)",
    r"\d+\s*(?:min(?:ute[sn]?|utos)?\.?)\s*(?:read|lesezeit|de lecture|de lectura)|(?:reading time|lesezeit|temps de lecture|tiempo de lectura)",
    r"(?:previous|prev|vorherige|zurück|précédent|anterior)\b.{1,90}\b(?:next|nächste|weiter|suivant|siguiente)\b|[←«‹].{1,120}[→»›|]|[←→]\s*(?:previous|next|zurück|weiter|précédent|suivant|anterior|siguiente)",
    r"(?:tags?|keywords?|categories|category|filed under|topics|labels|schlagw(?:örter|orte)|kategorien?|themen|mots[- ]clés|étiquettes|catégories?|etiquetas|categorías?|temas)\s*[:»>]",
    r"(?:language|sprache|langue|idioma)\s*:|(?:contact us|privacy policy|terms of (?:use|service)|cookie (?:policy|settings)|impressum|datenschutz(?:erklärung)?|mentions légales|aviso legal)$",
)
_box = re.compile(rf"^(?:#{{1,6}}\s+|\*\*)?(?:{BOX_TITLES})\s*:?(?:\*\*)?$", re.I)
_phrase = re.compile("^(?:[-*•>]\\s+)?\\W{0,3}?(?:" + "|".join(f"(?:{p})" for p in PHRASES) + ")", re.I)
# what a line is by its form alone: a copyright mark, a pager, a name with a list of single words
_form = re.compile(r"^(?:[-*•>]\s+)?\W{0,3}?(?:(?:©|\(c\)\s*\d|copyright\b)|(?:previous|prev|vorherige|zurück|précédent|anterior)\b.{1,90}\b(?:next|nächste|weiter|suivant|siguiente)\b|[←«‹].{1,120}[→»›|]|[^\W\d_]+(?: [^\W\d_]+)?\s*[:»]\s+[\w-]+(?:, [\w-]+){2,}$)", re.I)
_fence = re.compile(r"^\s*(```|~~~)")
_item = re.compile(r"^\s*(?:[-*+•]|\d+[.)])\s+")
_link_only = re.compile(r"^\s*(?:(?:[-*+•|·/>]|\d+[.)])?\s*!?\[[^\]\[]*\]\([^()\s]*(?:\s+\"[^\"]*\")?\)\s*[|·•/,>-]?\s*)+$")
# a sentence with its buttons: a label in brackets or labels between bars
_buttons = re.compile(r"[.!?]\s+(?:\[[^\]\[]{1,40}\]|[^\s|.!?][^|.!?]{0,30}(?:\s\|\s[^|.!?]{1,30})+)$")
_bracket = re.compile(r"^\s*\[[^\]\[]{1,60}\]\s*$")
_heading = re.compile(r"^\s*#{1,6}\s")
_setext = re.compile(r"^\s*(?:={3,}|-{3,})\s*$")
_rule_line = re.compile(r"^\s*(?:[-*_=]\s*){3,}$")
_trail = re.compile(r"^[^|·•/>»›\n]{1,40}(?:\s*(?:[|·•»›]|\s[/>])\s*[^|·•/>»›\n]{1,40}){1,}$")
_gaps = re.compile(r"^\S[^\n]*?\S(?: {2,}\S+(?: \S+){0,2}){1,}$")
_ends = re.compile(r"[.!?:;…]['\"”’»)\]*_`]*$")
_config = re.compile(r"^\s*[\w.-]+\s*[=:]\s*\S|^\s*[{}\[\]],?\s*$|^\s*\"[^\"]+\"\s*:|^\s*[\w.-]+:\s*$|--\w|\w\(.*\)|^\s*[$>#]\s")
_label = re.compile(r"^\s*[^\W\d_][\w’'-]*(?:[ -][^\W_][\w’'-]*){0,2}\s*$")

BUCKETS = 1 << 20
"""Rows of the table of repeated parts."""
_part = re.compile(r"(?<=[.!?…])\s+|\s+(?=\[)")
_link_target = re.compile(r"\]\([^()\s]*(?:\s+\"[^\"]*\")?\)")
_address = re.compile(r"(?:https?://|www\.)\S+")
_number = re.compile(r"\d+")
_name = re.compile(r"(?<=\S )[^\W\d_a-zß-öø-ÿ][\w’'-]*")
_letters = re.compile(r"[^\W\d_]")
_own_word = re.compile(r"[^\W\d_]{2}")


def parts_of(line: str) -> list[str]:
    """The sentences and bracketed labels of a line, the short ones without what differs from page to page: numbers, names, addresses."""
    out = []
    for x in _part.split(line.strip()):
        if x and not _is_sentence(x):
            x = _number.sub("0", _address.sub("u", _link_target.sub("]", x)))
            named = re.sub(r"(?:A )+A\b", "A", _name.sub("A", x))
            x = named if _own_word.search(named) else x
        if x:
            out.append(x.lower())
    return out


def _rows_of(part: str) -> tuple[int, int]:
    return crc32(part.encode()) % BUCKETS, crc32(part[::-1].encode()) % BUCKETS


class Repeats:
    """On how many pages the parts of lines stand, and on how many of these beside prose.

    A table of ``BUCKETS`` hashed rows whatever the corpus; a part has two rows,
    of which the emptier counts. A line is repeated if each of its parts
    stands on ``share`` of all pages, three at least, and beside prose on less
    than ``beside`` of these. Lines mostly of signs are drawings.
    """

    def __init__(self, pages: np.ndarray, prose: np.ndarray, total: int, share: float = 1 / 5000, beside: float = 0.7):
        self.pages, self.prose, self.least, self.beside = pages, prose, max(3.0, share * total), beside
        #: Of fewer than three texts nothing can stand on three.
        self.tells = total >= 3

    def __contains__(self, line: str) -> bool:
        if 2 * len(_letters.findall(line)) < len(line.replace(" ", "")):
            return False
        pages = prose = 0.0
        for x in parts_of(line):
            if not _own_word.search(x):
                if _letters.search(x) or _number.search(x):
                    return False
                continue
            k = min(_rows_of(x), key=lambda r: self.pages[r])
            if self.pages[k] < self.least:
                return False
            pages += self.pages[k]
            prose += self.prose[k]
        return pages > 0 and prose < self.beside * pages


def _is_sentence(s: str) -> bool:
    return len(s.split()) >= 10 and _ends.search(s) is not None


def repeats(df: DataFrame, text: str = "source_chunk") -> Repeats:
    """The table counted over all different texts; it has a fixed size and so may go to the driver and be broadcast."""

    def count(batches):
        last: set[str] = set()
        for b in batches:
            rows, pages, besides = [], [], []
            for t in b["t"]:
                if t in last:
                    continue
                if len(last) >= 4096:
                    last.clear()
                last.add(t)
                # of the text itself, so that copies elsewhere are one page too
                page = crc32(t.encode()) << 32 | crc32(t[::-1].encode())
                seen: dict[int, bool] = {}
                for block, kinds in _kinds(page_tree(t), None, False):
                    for i, node in enumerate(block):
                        if node.tag != "p" or kinds[i] == "F":
                            continue
                        beside = any(0 <= j < len(block) and kinds[j] == "C" and _is_sentence(block[j].attrs["text"]) for j in (i - 1, i + 1))
                        for x in parts_of(node.attrs["text"]):
                            for r in _rows_of(x):
                                seen[r] = seen.get(r, False) or beside
                rows += seen
                besides += seen.values()
                pages += [page - (1 << 63)] * len(seen)
            yield pd.DataFrame({"row": pd.Series(rows, dtype="int32"), "page": pd.Series(pages, dtype="int64"), "beside": pd.Series(besides, dtype="bool")})

    rows = df.select(F.col(text).alias("t")).where("t is not null and t <> ''").mapInPandas(count, "row int, page long, beside boolean").distinct()
    got = rows.groupBy("row").agg(F.count("*").alias("n"), F.count_if("beside").alias("b")).where("n > 2").toPandas()
    total = df.where(F.col(text) != "").select(F.xxhash64(text).alias("x")).agg(F.approx_count_distinct("x")).first()[0]
    pages, prose = np.zeros(BUCKETS, np.float32), np.zeros(BUCKETS, np.float32)
    pages[got["row"]], prose[got["row"]] = got["n"], got["b"]
    return Repeats(pages, prose, total)


class PageBuilder(TreeBuilder):
    """The block tree of lines of Markdown and HTML: elements hold blocks, blocks hold lines with their numbers."""

    def __init__(self):
        super().__init__()
        self.seen: list[tuple[str, bool, bool]] = []  # (text, is a mark, is out of sight) of the line being read

    def out_of_sight(self, node: Node | None = None) -> bool:
        return not all(shown(x, True) for x in [*self.open[1:], *([node] if node else [])])

    def handle_starttag(self, tag, attrs):
        super().handle_starttag(tag, attrs)
        mark = "[" if tag == "a" else "* " if tag == "li" else "#" * int(tag[1]) + " " if re.fullmatch(r"h[1-6]", tag) else "| " if tag in ("td", "th") else ""
        self.seen.append((mark, True, self.out_of_sight(Node(tag, {k: v or "" for k, v in attrs}))))

    def handle_startendtag(self, tag, attrs):
        super().handle_startendtag(tag, attrs)
        self.seen.append(("", True, self.out_of_sight(self.open[-1].children[-1])))

    def handle_endtag(self, tag):
        away = self.out_of_sight()
        super().handle_endtag(tag)
        self.seen.append(("](#)" if tag == "a" else "", True, away))

    def handle_data(self, data):
        self.seen.append((data, False, self.out_of_sight()))

    def handle_comment(self, data):
        self.seen.append(("", True, True))

    def waits(self) -> bool:
        """Whether a tag, a comment, a script or a style goes on."""
        return bool(self.rawdata) or self.cdata_elem is not None

    def read(self, line: str) -> tuple[str, bool]:
        """(text in sight, whether the line is out of sight) of a line of HTML."""
        self.seen = []
        self.feed(line + "\n")
        text = [away for x, mark, away in self.seen if not mark and x.strip()]
        away = all(text) if text else any(away for *_, away in self.seen) or self.rawdata.startswith("<!--")
        return re.sub(r"\s+", " ", "".join(x for x, _, gone in self.seen if not gone)).strip() if text else "", away


# HTML begins at a line that begins with a tag; one amid a sentence or code is text
_markup = re.compile(r"^\s*(?:<!--|<!doctype\b|</?(?:" + "|".join(sorted(BLOCKS | HIDDEN | VOID | {"a", "body", "span", "td", "th"})) + r")(?=[\s>/]|$))", re.I)
_any_tag = re.compile(r"</?[a-z]", re.I)
_span = re.compile(r"`[^`]*`")


def page_tree(text: str) -> Node:
    """The block tree of a text, Markdown and HTML alike: html > elements > block or pre > a node of each line.

    A line's node has its number, its text without tags, and as tag its place: ``h``, ``li``,
    ``hr``, ``blockquote``, ``tr``, ``pre``, ``tag`` (HTML without text) or ``p``. Blank lines part blocks
    and have no node. A block out of sight by its line alone is ``hidden``.
    """
    builder, lines = PageBuilder(), text.split("\n")
    fence = block = last = None
    for i, line in enumerate(lines):
        s = line.strip()
        waits = builder.waits()
        m = None if waits else _fence.match(line)
        if m and (fence is None or fence == m.group(1)) or fence and not waits:
            if m and (fence is None or fence == m.group(1)):
                fence = None if fence else m.group(1)
            pre = Node("pre")
            pre.children.append(Node("pre", {"line": i, "text": s, "raw": line}))
            builder.open[-1].children.append(pre)
            block = None
            continue
        if not s:
            block = None
            continue
        where = builder.open[-1]
        away, is_html = False, waits
        if not waits and "<" in line:
            line = _span.sub(lambda x: x[0].replace("<", "&lt;"), line)
            is_html = _markup.match(line) is not None or len(builder.open) > 1 and _any_tag.search(line) is not None
        if is_html:
            s, away = builder.read(line)
        code = len(builder.open) > 1 and any(x.tag == "pre" for x in builder.open)
        place = (builder.out_of_sight() if len(builder.open) > 1 else False, away, code)
        if block is None or place != last:
            block = Node("pre" if code else "block", {"hidden": ""} if away else {})
            where.children.append(block)
        last = place
        under = i + 1 < len(lines) and _setext.match(lines[i + 1]) is not None
        if is_html and not s or code:
            tag = "tag"
        elif _heading.match(s) or under or _setext.match(s) and block.children:
            tag = "h"
        elif _item.match(s):
            tag = "li"
        elif s.startswith((">", "|")):
            tag = "blockquote" if s[0] == ">" else "tr"
        else:
            tag = "hr" if _rule_line.match(s) else "p"
        block.children.append(Node(tag, {"line": i, "text": s, "under": under} | ({} if is_html else {"raw": lines[i]})))
    return builder.root


def furniture_lines(text: str, seen: Repeats | None = None, root: Node | None = None) -> list[int]:
    """Numbers, from 1, of the lines that are page furniture and not main content; blank lines never are.

    Decided on the block tree: what a page does not show and its landmarks of
    furniture (nav, aside, footer, their roles) are furniture with all their lines,
    code is content, and the lines of other blocks are told by their form, their block and
    their repetition over the corpus. Only where ``seen`` is not given, or knows fewer than three
    texts, lists of customary words and titles stand in for repetition.
    """
    found: list[int] = []
    for block, kinds in _kinds(root or page_tree(text), seen, seen is None or not seen.tells, found):
        found += [x.attrs["line"] + 1 for x, k in zip(block, kinds) if k == "F"]
    return sorted(found)


def _kinds(root: Node, seen: Repeats | None, listed: bool, away: list[int] | None = None) -> Iterator[tuple[list[Node], list[str]]]:
    """Blocks in sight with the kind of each line, F furniture or C content; numbers of lines out of sight go to ``away``."""
    blocks: list[list[Node]] = []
    titles: set[str] = set()

    def walk(node: Node, visible: bool) -> None:
        for c in node.children:
            if "line" in c.attrs:
                if not visible and away is not None:
                    away.append(c.attrs["line"] + 1)
                continue
            inside = visible and shown(c, True)
            if c.tag in ("block", "pre") and inside:
                s = [x.attrs["text"] for x in c.children if "line" in x.attrs]
                titles.update(re.sub(r"^\s*#{1,6}\s+|\s*#*\s*$", "", x).strip().lower() for x in s if _heading.match(x))
                titles.update(x.attrs["text"].lower() for x in c.children if x.attrs.get("under"))
            if c.tag == "block" and inside:
                blocks.append(c.children)
            else:
                walk(c, inside)

    walk(root, True)
    for block in blocks:
        yield block, _kinds_of(block, titles, seen, listed)


def _kinds_of(block: list[Node], headings: set[str], seen: Repeats | None, listed: bool) -> list[str]:
    lines = [x.attrs["text"] for x in block]

    def in_box(s: str) -> bool:
        # a side box holds links, labels and headings of the page
        return _link_only.match(s) is not None or s.lower() in headings or (len(s.split()) <= 6 and not _ends.search(s) and not _heading.match(s))

    kind = [""] * len(block)  # furniture: F, content: C, open: ?
    lead = False  # a plain list under a lead-in line is content
    box = False
    for i, node in enumerate(block):
        s, tag, under = lines[i], node.tag, node.attrs["under"]
        if tag == "tag":
            kind[i] = "C"
            continue
        if box:
            if in_box(s):
                kind[i] = "F"
                continue
            box = False
        again = seen is not None and tag == "p" and not under and not s.endswith(":") and s in seen
        if listed and _box.match(s) and not under and (not _heading.match(s) or _box_follows(lines, i)):
            kind[i] = "F"
            box = True
        elif tag == "h":
            kind[i] = "C"
        elif again:
            # a repeated title opens a box if what follows may stand in one
            kind[i] = "F"
            box = not _ends.search(s) and len(s.split()) <= 5 and i + 1 < len(block) and block[i + 1].tag in ("p", "li") and in_box(lines[i + 1])
        elif (_phrase if listed else _form).match(s) and not (lead and tag == "li") and not _is_prose(s):
            kind[i] = "F"
        elif tag == "p" and _buttons.search(s):
            kind[i] = "F"
        elif _link_only.match(s) or _bracket.match(s):
            kind[i] = "C" if lead and tag == "li" else "F"
        elif tag in ("li", "blockquote", "tr", "hr"):
            kind[i] = "C"
        elif _ends.search(s):
            kind[i] = "C"
        elif (_trail.match(s) or _gaps.match(s)) and not _config.search(s) and _is_labels(s):
            kind[i] = "F"
        else:
            kind[i] = "?"
        lead = (s.endswith(":") and kind[i] == "C") or (lead and _item.match(s) is not None)
    # labels without a sentence beside them: menus, one entry to a line
    for i, s in enumerate(lines):
        if kind[i] == "?":
            labelled = _label.match(s) is not None
            run = 1
            for step in (-1, 1):
                j = i + step
                while 0 <= j < len(block) and kind[j] in "?F" and _label.match(lines[j]):
                    run += 1
                    j += step
            beside = i + 1 < len(block) and kind[i + 1] == "F" or i and kind[i - 1] == "F"
            kind[i] = "F" if labelled and (run >= 2 or beside) else "C"
    return kind


def _box_follows(lines: list[str], at: int) -> bool:
    """Whether links or labels follow a title that is written as a heading."""
    rest = lines[at + 1 : at + 3]
    return bool(rest) and all(_link_only.match(x) for x in rest)


def _is_labels(s: str) -> bool:
    """Whether all parts of a divided line are labels of at most four words."""
    parts = [p for p in re.split(r"\s*[|·•»›]\s*|\s[/>]\s| {2,}", s) if p.strip()]
    return len(parts) >= 2 and all(len(p.split()) <= 4 and not _ends.search(p) for p in parts)


def _is_prose(s: str) -> bool:
    """Whether a line that begins like furniture is a sentence about its subject."""
    return s.count("`") >= 2 or (len(s.split()) > 24 and s.endswith("."))


def page_furniture(df: DataFrame, record_id: str = "record_id", text: str = "source_chunk", keep: int = 4096, seen: Repeats | None = None) -> DataFrame:
    """(record_id, line_no) of each line that is page furniture.

    ``seen`` is counted over the table's texts unless it is given.

    Lines are split at ``\\n`` and numbered from 1; blank lines never count. Null and
    empty texts give no rows. Rows of one record delivered twice give their
    lines once. Records that share a text mostly lie together: each task keeps
    the answers for its last ``keep`` texts, which changes no result.
    """
    shared = df.sparkSession.sparkContext.broadcast(seen or repeats(df, text))

    def run(batches):
        last: dict[str, list[int]] = {}
        table = shared.value
        for b in batches:
            ids, nos = [], []
            for i, t in zip(b["i"], b["t"]):
                got = last.get(t)
                if got is None:
                    if len(last) >= keep:
                        last.clear()
                    got = last[t] = furniture_lines(t, table)
                ids += [i] * len(got)
                nos += got
            yield pd.DataFrame({"record_id": pd.Series(ids, dtype="int64"), "line_no": pd.Series(nos, dtype="int64")})

    rows = df.select(F.col(record_id).cast("long").alias("i"), F.col(text).alias("t")).where("t is not null and t <> ''")
    return rows.mapInPandas(run, "record_id long, line_no long").distinct()


def render_page(root: Node, gone: set[int]) -> str:
    """The lines of a page's tree that are in ``gone`` left out: blocks apart by one blank line, cells of a table aligned, code as it is."""
    out: list[list[str]] = []

    def walk(node: Node) -> None:
        for c in node.children:
            if c.tag not in ("block", "pre") or not c.children or "line" not in c.children[0].attrs:
                walk(c)
                continue
            kept = [x for x in c.children if x.attrs["line"] + 1 not in gone and x.tag != "tag"]
            if c.tag == "pre" and out and out[-1][0] is c.tag and kept and out[-1][1] == kept[0].attrs["line"]:
                out[-1] += [x.attrs.get("raw", x.attrs["text"]) for x in kept]
                out[-1][1] = kept[-1].attrs["line"] + 1
            elif kept:
                out.append([c.tag, kept[-1].attrs["line"] + 1, *_aligned(kept)])

    walk(root)
    return "\n\n".join("\n".join(x[2:]) for x in out)


def _aligned(nodes: list[Node]) -> list[str]:
    """Lines of a block; the cells of adjacent table rows get one width a column."""
    lines: list[str] = []
    rows: list[list[str]] = []

    def flush() -> None:
        wide = [max(len(r[k]) for r in rows if k < len(r)) for k in range(max(map(len, rows), default=0))]
        for r in rows:
            rule = all(re.fullmatch(r":?-+:?", v) for v in r)
            lines.append("| " + " | ".join("-" * wide[k] if rule else v.ljust(wide[k]) for k, v in enumerate(r)) + " |")
        rows.clear()

    for x in nodes:
        s = x.attrs.get("raw", x.attrs["text"])
        if x.tag == "tr":
            rows.append([v.strip() for v in s.strip().strip("|").split("|")])
        else:
            flush()
            lines.append(s.rstrip())
    flush()
    return lines


def main_body(df: DataFrame, record_id: str = "record_id", text: str = "source_chunk", seen: Repeats | None = None, keep: int = 1024) -> DataFrame:
    """(record_id, body) of every row: each text rendered from its block tree without its furniture lines; null stays null.

    Texts written as HTML are first rendered from their elements, so that markup
    that shares a line is told apart too. ``seen`` is counted over the table's texts unless it is given.
    Each task keeps the bodies of its last ``keep`` texts, which changes no result.
    """
    shared = df.sparkSession.sparkContext.broadcast(seen or repeats(df, text))

    def one(t: str, table: Repeats) -> str:
        if re.search(r"<(?:html|body|div|p|nav|table|ul|article)\b", t, re.I):
            t = render(tree(t))
        root = page_tree(t)
        return render_page(root, set(furniture_lines(t, table, root)))

    def run(batches):
        last: dict[str | None, str | None] = {None: None}
        table = shared.value
        for b in batches:
            bodies = []
            for t in b["t"]:
                if t not in last:
                    if len(last) >= keep:
                        last = {None: None}
                    last[t] = one(t, table)
                bodies.append(last[t])
            yield pd.DataFrame({"record_id": b["i"], "body": bodies})

    return df.select(F.col(record_id).cast("long").alias("i"), F.col(text).alias("t")).mapInPandas(run, "record_id long, body string")
