"""Script folding and text normal forms, as column builders.

The folding table comes from the ICU transliterator on Spark's class path: it is asked once, on the driver, for all Han
characters of the basic plane; only pairs of one character each are used, so folding never changes a text's length.
"""

from __future__ import annotations

import functools
import re

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Pairs that the transliterator lacks, and phrases that keep their traditional characters.
EXTRA = {"舃": "舄", "纇": "颣"}
KEPT_PHRASES = ("乾隆", "乾坤", "魏徵")
SPACES = " 　\t\xa0  "
ANONYMOUS = ("不详", "佚", "匿名", "无名", "无名的", "失名", "阙名", "闕名")
ANONYMOUS_PARTS = ("佚名", "无名", "失名", "阙名")
PUNCTUATION = " ，。、？！；：“”‘’「」『』（）()《》〈〉·—…~～．.,;:!?\"'[]{}<>|/"
HAN = "\\x{3400}-\\x{4DBF}\\x{4E00}-\\x{9FFF}\\x{F900}-\\x{FAFF}\\x{20000}-\\x{3134F}"
#: Where kept phrases hide while the table is applied (private use).
_HIDDEN = 0xE000


@functools.cache
def _table(application: str) -> tuple[str, str]:
    jvm = SparkSession.getActiveSession()._jvm
    fold = jvm.com.ibm.icu.text.Transliterator.getInstance("Traditional-Simplified")
    pairs = {}
    for lo, hi in ((0x3400, 0x4DC0), (0x4E00, 0xA000), (0xF900, 0xFB00)):
        plain = [chr(c) for c in range(lo, hi)]
        folded = fold.transliterate("\n".join(plain)).split("\n")
        pairs |= {a: b for a, b in zip(plain, folded, strict=True) if a != b and len(b) == 1}
    pairs |= EXTRA
    return "".join(pairs), "".join(pairs.values())


def table() -> tuple[str, str]:
    """(characters, what they fold to) of the active session."""
    return _table(SparkSession.getActiveSession().sparkContext.applicationId)


@functools.cache
def _closed(source: str, target: str) -> str:
    """The same characters' folds, followed until they stay."""
    step, out = dict(zip(source, target, strict=True)), []
    for c in target:
        seen = {c}
        while c in step and step[c] not in seen:
            c = step[c]
            seen.add(c)
        out.append(c)
    return "".join(out)


def _folded(text: Column, target: str, source: str) -> Column:
    for i, phrase in enumerate(KEPT_PHRASES):
        text = F.replace(text, F.lit(phrase), F.lit(chr(_HIDDEN + i) * len(phrase)))
    text = F.translate(text, source, target)
    for i, phrase in enumerate(KEPT_PHRASES):
        text = F.replace(text, F.lit(chr(_HIDDEN + i) * len(phrase)), F.lit(phrase))
    return text


def fold(text: Column) -> Column:
    """Traditional to simplified, one step, same length; kept phrases stay."""
    source, target = table()
    return _folded(text, target, source)


def fold_text(text: str) -> str:
    """fold() of one string, on the driver."""
    source, target = table()
    for i, phrase in enumerate(KEPT_PHRASES):
        text = text.replace(phrase, chr(_HIDDEN + i) * len(phrase))
    text = text.translate(str.maketrans(source, target))
    for i, phrase in enumerate(KEPT_PHRASES):
        text = text.replace(chr(_HIDDEN + i) * len(phrase), phrase)
    return text


def fold_han(text: Column) -> Column:
    """fold() where a text has Han characters at all."""
    return F.when(text.rlike(f"[{HAN}]"), fold(text)).otherwise(text)


def has_han(text: str) -> bool:
    return bool(_HAN_CHAR.search(text))


def fold_checked(text: Column) -> Column:
    """struct(folded, kept_length)."""
    folded = fold(text)
    return F.struct(folded.alias("folded"), (F.char_length(folded) == F.char_length(text)).alias("kept_length"))


def norm_text(text: Column) -> Column:
    """Folded until it stays, without spaces; null is ''."""
    source, target = table()
    return F.translate(_folded(F.coalesce(text, F.lit("")), _closed(source, target), source), SPACES, "")


def norm_lines(lines: Column) -> Column:
    return F.filter(F.transform(lines, norm_text), lambda x: x != "")


def norm_author(name: Column) -> Column:
    """'' for the anonymous; names like "lady of the X family" are real and stay."""
    name = F.trim(norm_text(name))
    return F.when(name.isin(*ANONYMOUS) | name.rlike("|".join(ANONYMOUS_PARTS)), "").otherwise(name)


def segment(text: Column) -> Column:
    """A space around each Han character; runs of letters and digits, and punctuation, stay as they are."""
    text = F.regexp_replace(text, f"(?<=[^ ])(?=[{HAN}])", " ")
    return F.regexp_replace(text, f"(?<=[{HAN}])(?=[\\p{{L}}\\p{{N}}])", " ")


def tokens(text: Column) -> Column:
    """Search tokens, lower case: single Han characters and runs of other letters and digits, all else separates; a space
    around each, so that a phrase is a substring."""
    found = F.regexp_extract_all(F.lower(text), F.lit(f"([{HAN}]|[\\p{{L}}\\p{{N}}&&[^{HAN}]]+)"), F.lit(1))
    return F.concat(F.lit(" "), F.array_join(found, " "), F.lit(" "))


def comparable(text: Column) -> Column:
    """What two sources of one text share: folded, without punctuation and white space."""
    return F.regexp_replace(F.translate(norm_text(text), PUNCTUATION, ""), r"\s+", "")


class Plain:
    """fold() and comparable() of single strings, made on the driver and used in Python workers."""

    def __init__(self) -> None:
        source, target = table()
        self.step, self.closed = str.maketrans(source, target), str.maketrans(source, _closed(source, target))

    def fold(self, text: str, pairs: dict[int, int] | None = None) -> str:
        for i, phrase in enumerate(KEPT_PHRASES):
            text = text.replace(phrase, chr(_HIDDEN + i) * len(phrase))
        text = text.translate(self.step if pairs is None else pairs)
        for i, phrase in enumerate(KEPT_PHRASES):
            text = text.replace(chr(_HIDDEN + i) * len(phrase), phrase)
        return text

    def comparable(self, text: str | None) -> str:
        return _NOT_COMPARED.sub("", self.fold(text or "", self.closed))


_NOT_COMPARED = re.compile("[" + re.escape(SPACES + PUNCTUATION) + " \\t\\n\\x0B\\f\\r]+")
_HAN_CHAR = re.compile("[㐀-䶿一-鿿豈-\ufaff\U00020000-\U0003134f]")


def token_list(text: str) -> list[str]:
    """tokens() of one string, on the driver."""
    out: list[str] = []
    run = ""
    for c in text.lower() + " ":
        if c.isalnum() and not _HAN_CHAR.match(c):
            run += c
            continue
        out += [run] if run else []
        run = ""
        if _HAN_CHAR.match(c):
            out.append(c)
    return out


def first_sentence(text: Column, most: int = 120) -> Column:
    """Up to the first end of a sentence, or the first `most` characters."""
    text = F.trim(text)
    found = F.regexp_extract(text, r"^([^。！？；!?;\n]*[。！？；!?;\n])", 1)
    return F.when((found != "") & (F.char_length(found) <= most), F.trim(found)).otherwise(F.left(text, F.lit(most)))


def split_verses(text: Column) -> Column:
    """Lines, and in them sentences, without blanks."""
    parts = F.split(F.coalesce(text, F.lit("")), r"[\n\r]+|</?p>|(?<=[。！？；])")
    return F.filter(F.transform(parts, F.trim), lambda x: x != "")


def pick_title(title: Column, tune: Column, body: Column) -> Column:
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    return F.coalesce(blank(title), blank(tune), F.left(F.coalesce(body, F.lit("")), F.lit(12)))


def has_gap(text: Column) -> Column:
    """Whether a text has placeholders for missing characters."""
    return F.coalesce(text, F.lit("")).rlike(r"[□■◼○〇]|\[[^\[\]]{0,8}\]")


def bare_title(title: Column) -> Column:
    return F.regexp_replace(F.trim(title), "^《(.*)》$", "$1")


def escape_like(text: str) -> str:
    return re.sub(r"([\\%_])", r"\\\1", text)
