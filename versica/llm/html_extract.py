"""Main text of web pages: flat text blocks, classified by a decision tree.

A page becomes a flat list of text blocks. A block is described by its words and link density, by those of the blocks before
and after it, by where it lies (in an article, in an element or under an exact class name that furniture has; a page may have
neither), whether it is a heading, and by its share of words that notices are made of. A decision tree trained on a small
labelled table, the pages below, decides which blocks are main text; no feature decides alone. Class names are whole tokens or
their last part ("cookie-notice", but not "legal-news" or "has-sidebar"), and count for nothing on what holds the article, the
main element or the first heading.

Defined cases: null html is empty; a page without main text gives '' (an empty table no rows); cut-off pages are read as far
as they go, a tag without its end is dropped; scripts, styles and hidden elements are no blocks; very long pages are read
whole; a share of exactly one half counts as main text; repeated rows and null ids come out as they are; extra columns are not
looked at, whatever their names.
"""

from __future__ import annotations

import functools
import html
import random
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from versica.llm.common import arrow_map
from versica.llm.tree import Tree, grow, share

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^>]*+)>|</?[a-zA-Z][^>]*\Z|</[^>]*(?:>|\Z)|(?P<text>[^<]++|<)",
    re.S,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|style|aria-hidden|hidden|data-y)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

SKIPPED = frozenset("script style noscript template iframe object svg math canvas audio video textarea select option button title xmp noframes".split())
UNSEEN = frozenset("script style noscript template".split())  # skipped, and no end of a block
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
FURNITURE = frozenset("nav aside footer form menu dialog head".split())
#: Class, id and role tokens, or last parts of them, of what is not main text.
NAMES = frozenset(
    "ad ads adv advert advertisement adverts advertising adsense banner banners breadcrumb breadcrumbs comment comments commentlist complementary consent contentinfo cookie cookies copyright dialog discussion disqus "
    "footer footnav gdpr header legal login masthead menu menubar modal nav navbar navigation navi newsletter notice notices notification outbrain overlay pager pagination popup promo promotion promoted "
    "recommendations related replies respond responses search share sharing sidebar sidenav signup skip social sponsor sponsored subscribe subscription taboola teaser toc toolbar topbar widget widgets".split()
)
#: First parts of tokens that tell about a page, not about the element.
ABOUT = frozenset("has no with without is not page layout js body".split())
#: Words that notices are made of, in four languages.
NOTICES = frozenset(
    "© copyright rights reserved cookie cookies consent privacy policy terms accept subscribe subscriber newsletter signup login advert advertisement advertising sponsored promotion offer offers adblock imprint "
    "rechte vorbehalten datenschutz einwilligung akzeptieren abonnieren anzeige werbung impressum droits réservés confidentialité accepter abonnez publicité sponsorisé derechos reservados privacidad aceptar suscríbete publicidad patrocinado".split()
)
#: Examples of notices, and the words that one has at most.
NOTICE_TEXTS = ("We use cookies to improve this site. Accept all cookies?", "© 2024 Example Press. All rights reserved.", "Subscribe to our newsletter for weekly offers.", "Advertisement", "Sponsored content", "Copyright by the publisher", "Read our privacy policy and terms of use.", "This site needs your consent to store cookies on your device. You may accept or change the settings.", "Sign up for the newsletter")
NOTICE_WORDS = 60
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FEATURES = ("words", "link density", "words before", "link density before", "words after", "link density after", "place", "element", "named", "heading", "notice words")
_SPLIT = re.compile(r"[\W_]+")


def _is_name(token: str) -> bool:
    token = token.lower()
    parts = _SPLIT.split(token)
    return token in NAMES or (parts[-1] in NAMES and parts[0] not in ABOUT)


def _named(rest: str) -> tuple[bool, bool, str]:
    """(names furniture, hidden, training label) of a tag's attributes."""
    furniture, hidden, label = False, False, ""
    for m in _ATTRIBUTE.finditer(rest):
        name, value = m[1].lower(), (m[2] or "").strip("\"'")
        if name in ("class", "id", "role"):
            furniture = furniture or any(map(_is_name, value.split()))
        elif name == "style":
            hidden = hidden or bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
        elif name == "data-y":
            label = value
        else:
            hidden = hidden or name == "hidden" or value.lower() == "true"
    return furniture, hidden, label


def blocks(page: str) -> list[dict]:
    """Flat text blocks in page order: text, words, linked, element, named, article, heading, label."""
    out: list[dict] = []
    stack: list[tuple[str, bool, tuple[int, ...], bool, bool, str]] = []  # tag, in a furniture element, named elements around, article, hidden, label; each as inherited
    named_elements: list[bool] = []  # whether each is furniture still
    parts: list[str] = []
    linked: list[str] = []
    state = {"links": 0}

    def flush() -> None:
        text = " ".join("".join(parts).split())
        if text:
            _, element, names, article, _, label = stack[-1] if stack else ("", False, (), False, False, "")
            heading = any(t[0] in HEADINGS for t in stack[-3:])
            out.append({"text": text, "words": len(text.split()), "linked": len("".join(linked).split()), "element": element, "named": names, "article": article, "heading": heading, "label": label})
        parts.clear()
        linked.clear()

    at = 0
    while at < len(page):
        m = _TOKEN.match(page, at)
        at = m.end()
        if (text := m["text"]) is not None:
            if not (stack and stack[-1][4]):
                text = html.unescape(text) if "&" in text else text
                parts.append(text)
                if state["links"]:
                    linked.append(text)
            continue
        tag = m["tag"] or m["tag2"]
        if tag is None:
            continue
        tag, end, rest = tag.lower(), m["end"] or m["end2"], m["rest"] or m["rest2"] or ""
        if tag not in INLINE and tag not in UNSEEN:
            flush()
        elif tag == "br":
            parts.append(" ")
        if end:
            if any(t[0] == tag for t in stack):
                while stack:
                    gone = stack.pop()[0]
                    if gone == "a":
                        state["links"] -= 1
                        linked.append(" ")
                    if gone == tag:
                        break
            continue
        if tag in SKIPPED:
            if not rest.endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(page, at)
                at = close.end() if close else len(page)
            continue
        if tag in VOID or rest.endswith("/"):
            continue
        if tag in ("p", "li", "tr", "td", "th", "dt", "dd") and stack and any(t[0] == tag for t in stack[-4:]) and not any(t[0] in ("ul", "ol", "table", "dl") for t in stack[-4:][[t[0] for t in stack[-4:]].index(tag) :]):
            while stack:  # an end that is left out
                gone = stack.pop()[0]
                state["links"] -= gone == "a"
                if gone == tag:
                    break
        _, element, names, article, hidden, label = stack[-1] if stack else ("", False, (), False, False, "")
        named, gone_, y = _named(rest) if rest else (False, False, "")
        if tag in ("main", "h1") or (tag == "article" and not named):  # what holds these is no furniture, whatever it is called
            for k in names:
                named_elements[k] = False
            element = element and not (tag != "h1" and all(t[0] not in ("nav", "aside", "footer", "menu", "dialog", "head") for t in stack))
        if named and tag not in ("html", "body", "main", "h1") and not (tag == "header" and article):
            names = (*names, len(named_elements))
            named_elements.append(True)
        article = article or tag == "main" or (tag == "article" and not named)
        element = element or tag in FURNITURE or (tag == "header" and not article)
        stack.append((tag, element, names, article, hidden or gone_, y or label))
        state["links"] += tag == "a"
    flush()
    for block in out:
        block["named"] = any(named_elements[k] for k in block["named"])
    return out


def described(found: list[dict]) -> list[list[float]]:
    """FEATURES of each block."""
    own = [(float(b["words"]), min(1.0, b["linked"] / b["words"])) for b in found]
    around = [(0.0, 0.0), *own, (0.0, 0.0)]
    has_article = any(b["article"] for b in found)
    out = []
    for i, b in enumerate(found):
        notices = sum(w in NOTICES for w in re.findall(r"©|[^\W\d_]+", b["text"].lower())) if b["words"] <= NOTICE_WORDS else 0
        out.append([*around[i + 1], *around[i], *around[i + 2], 2.0 if b["article"] else 0.0 if has_article else 1.0, float(b["element"]), float(b["named"]), float(b["heading"]), min(1.0, notices / b["words"])])
    return out


def _text(pick: random.Random, words: int) -> str:
    """A made-up sentence of so many words."""
    syllables = "ba co de fi gu la me ni so ta re vo".split()
    return " ".join("".join(pick.choice(syllables) for _ in range(pick.randint(1, 4))) for _ in range(words)).capitalize() + "."


def labelled_pages(seed: int = 11, each: int = 24) -> list[str]:
    """The labelled table, as pages whose elements carry their label (data-y) for all blocks in them.

    `each` of every layout, varied by a generator. Half of the pages have neither article nor main element; class names are on
    main text as often as on furniture, furniture mostly has names that say nothing, and nothing but words, links and
    neighbours tells the blocks of such pages apart."""
    pick = random.Random(seed)
    link = lambda n: f'<a href="/x">{_text(pick, n)[:-1]}</a>'
    links = lambda: "".join(f'<div data-y="0">{link(pick.randint(1, 5))} {link(pick.randint(1, 7))}</div>' for _ in range(pick.randint(2, 5)))
    menu = lambda: f'<ul data-y="0">{"".join(f"<li>{link(pick.randint(1, 3))}</li>" for _ in range(pick.randint(2, 7)))}</ul>'
    para = lambda n: f'<p data-y="1">{_text(pick, n)}</p>'
    cited = lambda n: f'<p data-y="1">{_text(pick, n)} {link(pick.randint(1, 3))} {_text(pick, n)}</p>'
    label = lambda: f'<div data-y="0">{_text(pick, pick.randint(1, 4))}</div>'
    notice = lambda: f'<div data-y="0">{pick.choice(NOTICE_TEXTS)}</div>'
    lengths = [1, 2, 3, 5, 8, 14, 25, 40, 70, 120]

    def body() -> str:
        out = [para(pick.randint(20, 90))]
        for _ in range(pick.randint(2, 7)):
            out.append(pick.choice((para, para, cited))(pick.choice(lengths)))
        return "".join([*out, para(pick.randint(18, 80))])

    title = lambda k=1: f'<h{k} data-y="1">{_text(pick, pick.randint(2, 9))[:-1]}</h{k}>'
    some_class = lambda: pick.choice(["", "", ' class="c1 wide"', ' class="legal-news"', ' class="has-sidebar"', ' id="content"', ' class="search-help"'])
    named = lambda: f'<div class="{pick.choice(["ad", "cookie-notice", "site-footer", "share", "comments", "newsletter"])}" data-y="0"><p>{_text(pick, pick.choice(lengths))}</p></div>'
    furniture = lambda: pick.choice([named(), notice(), label() + links()])
    own = lambda: pick.choice(["", para(pick.choice(lengths)), f'<p data-y="1">{pick.choice(NOTICE_TEXTS)}</p>'])  # noqa: E731  an article may speak of rights and offers
    pages = []
    for _ in range(each):
        pages += [
            f"<body>{menu()}<div{some_class()}>{title()}{body()}</div>{links()}{notice()}</body>",
            f"<body>{links()}{label()}{links()}<div{some_class()}>{title()}{body()}{title(2)}{body()}</div>{label()}{links()}{label()}{links()}</body>",
            f"<body>{label()}{menu()}{notice()}{title(2)}{body()}{menu()}{label()}{menu()}{notice()}</body>",
            f"<body><table><tr><td>{menu()}</td><td{some_class()}>{body()}<ul>{''.join(f'<li data-y={chr(34)}1{chr(34)}>{_text(pick, pick.randint(1, 6))}</li>' for _ in range(4))}</ul>{para(40)}</td></tr></table>{links()}</body>",
            f"<body><nav data-y='0'>{menu()}</nav>{furniture()}<article{some_class()}>{title()}{body()}{own()}{para(pick.choice(lengths))}</article>{furniture()}<footer data-y='0'>{_text(pick, pick.choice(lengths))}</footer></body>",
            f"<body><header data-y='0'><h2>{_text(pick, 2)}</h2><p>{_text(pick, pick.choice(lengths))}</p></header><main>{title(pick.randint(1, 2))}{para(pick.choice(lengths))}{body()}{named()}"
            f"<aside data-y='0'><p>{_text(pick, pick.choice(lengths))}</p></aside></main><div data-y='0'>{_text(pick, pick.choice(lengths))}</div><form data-y='0'><p>{_text(pick, pick.choice(lengths))}</p></form></body>",
            f"<body>{pick.choice(['', title()])}{pick.choice(['', para(pick.choice(lengths))])}{body()}</body>",
            f"<body>{pick.choice(['', title(2), label()])}{para(pick.choice(lengths))}{body()}{pick.choice(['', notice(), links()])}</body>",
            f"<div{some_class()}><article>{pick.choice(['', title()])}{''.join(para(pick.choice(lengths)) for _ in range(pick.randint(1, 4)))}{own()}</article></div>{pick.choice(['', label(), notice()])}",
            f"{pick.choice(['', menu(), label(), '<nav data-y=0>' + menu() + '</nav>'])}<main>{''.join(para(pick.choice(lengths)) for _ in range(pick.randint(1, 4)))}{own()}{pick.choice(['', named()])}</main>",
            f"<body>{''.join(para(pick.choice(lengths)) for _ in range(pick.randint(1, 2)))}</body>",
            *(f"{pick.choice([menu(), links()])}<{at}>{para(pick.choice(lengths))}{own()}</{at}>" for at in ("article", "main")),
            *(f"<body>{para(n)}</body>" for n in pick.sample(lengths, 2)),
            f"<body><div class='topbar' data-y='0'>{_text(pick, pick.choice(lengths))}</div><div{some_class()}>{title()}{para(pick.choice(lengths))}{body()}</div><div class='comments' data-y='0'><p>{_text(pick, pick.choice(lengths))}</p><p>{_text(pick, 30)}</p></div></body>",
        ]
    return pages


@functools.cache
def model() -> Tree:
    """The tree learned from the labelled pages; the same in every process."""
    rows, labels = [], []
    for page in labelled_pages():
        found = blocks(page)
        rows += described(found)
        labels += [int(b["label"] == "1") for b in found]
    return grow(rows, labels, depth=14, leaf=3)


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    return "\n".join(b["text"] for b, row in zip(found, described(found), strict=True) if share(model(), row) >= 0.5)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for pages(page_id, url, html)."""

    def rows(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(h) for h in b.column("html").to_pylist()]
        return pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return arrow_map(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html"), rows, "page_id long, url string, text string, n_chars long")
