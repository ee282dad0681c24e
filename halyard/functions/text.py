"""Text expressions."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _decomposed(form: str) -> dict[str, str]:
    """Characters of the basic plane that are others and marks, and those others: by a decomposition of Unicode."""
    pairs = {}
    for code in [*range(0x80, 0xAC00), *range(0xD7A4, 0xD800), *range(0xF900, 0x10000)]:  # not Hangul, which has no marks
        parts = unicodedata.normalize(form, chr(code))
        bare = "".join(c for c in parts if not unicodedata.combining(c))
        if parts != chr(code) and bare:
            pairs[chr(code)] = bare
    return pairs


CANONICAL, COMPATIBLE = _decomposed("NFD"), _decomposed("NFKD")
#: Characters that are one other and marks, those others, and of these pairs those whose other is ASCII.
MARKED, PLAIN = ("".join(x) for x in zip(*[(a, b) for a, b in CANONICAL.items() if len(b) == 1]))
MARKED_ASCII, ASCII = ("".join(x) for x in zip(*[(a, b) for a, b in zip(MARKED, PLAIN) if b < "\x80"]))

#: White space as Unicode text has it, the no-break and the ideographic space among it.
#: Other ASCII, the most by far, is told apart by one range before the list is looked at.
SPACE = r"[[^!-~]&&[\s\u001c-\u001f\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]"
#: Runs of it that are not one plain space already.
UNEVEN = rf"[{SPACE}&&[^ ]]{SPACE}*| {SPACE}+"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value worked out once, however often use names it, in functions over arrays too."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def normalize_spaces(c: Column) -> Column:
    """Runs of white space, of whatever kind, as one space; none at the ends."""
    return F.trim(F.regexp_replace(c, UNEVEN, " "))


def strip_spaces(c: Column) -> Column:
    """Without white space, of whatever kind, at the ends."""
    return F.regexp_replace(c, rf"\A{SPACE}+|{SPACE}+\z", "")


def strip_accents(c: Column) -> Column:
    """Without marks, those written as characters of their own too."""
    return F.regexp_replace(F.translate(c, MARKED, PLAIN), r"[\u0300-\u036F]", "")


def ascii_only(c: Column) -> Column:
    """Without accents, and without what is then not ASCII. Texts that are ASCII, the most by far, are only looked at."""
    return F.when(c.rlike(r"[^\x00-\x7F]"), F.regexp_replace(F.translate(c, MARKED_ASCII, ASCII), r"[^\x00-\x7F]", "")).otherwise(c)


def folded(word: str) -> str:
    """fold_text of a word at hand."""
    plain = unicodedata.normalize("NFD", word).encode("ascii", "ignore").decode()
    return " ".join(plain.split()).lower()


def fold_text(c: Column) -> Column:
    """Without accents, ASCII only, single spaces, lower case. Other characters, the curly apostrophe too, vanish."""
    return F.lower(normalize_spaces(ascii_only(c)))


def normalize_label(c: Column) -> Column:
    """Compatibility forms as what they stand for (ligatures, superscripts, wide letters), no marks, lower case, trimmed; other characters stay."""
    single = F.translate(c, *["".join(x) for x in zip(*[(a, b) for a, b in COMPATIBLE.items() if len(b) == 1])])
    several = constant({a: b for a, b in COMPATIBLE.items() if len(b) > 1}, "map<string,string>")
    plain = F.array_join(F.transform(F.split(single, ""), lambda x: F.coalesce(F.try_element_at(several, x), x)), "")
    return strip_spaces(F.lower(F.regexp_replace(plain, r"\p{Mn}", "")))


def slugify(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(ascii_only(c)), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def short_hash(c: Column, size: int = 10) -> Column:
    return F.substring(F.sha1(c), 1, size)


def metric_text(c: Column) -> Column:
    """Three decimals, without trailing zeros and point; empty for null."""
    shown = F.regexp_replace(F.regexp_replace(F.format_string("%.3f", c), "0+$", ""), r"\.$", "")
    return F.when(c.isNull(), "").otherwise(shown)


def contains_any(c: Column, words: tuple[str, ...]) -> Column:
    """Whether c holds one of words, as substrings."""
    return reduce(lambda a, w: a | c.contains(w), words[1:], c.contains(words[0])) if words else F.lit(False)


def groups_of(c: Column, pattern: str, count: int) -> Column:
    """The groups of a pattern's first match, as an array, by one look; null without one. A group that took no part is empty."""
    head = "" if pattern.startswith("^") else r"\A.*?"
    marked = F.regexp_replace(c, rf"(?s){head}{pattern}.*\z", "\u0001" + "\u0001".join(f"${i + 1}" for i in range(count)))
    return bound(marked, lambda m: F.when(m.startswith("\u0001"), F.slice(F.split(m, "\u0001"), 2, count)))


def constant(value: object, kind: str) -> Column:
    """A map, array or struct as one literal, told as JSON; the optimizer works it out once."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def count_words(c: Column, words: tuple[str, ...]) -> Column:
    """How many of words c holds, each once."""
    return sum((c.contains(w).cast("int") for w in words), F.lit(0))


#: French number words from zero on (fixed values).
NUMBER_WORDS = ("zero", "un", "deux", "trois", "quatre", "cinq", "six", "sept", "huit", "neuf", "dix", "onze", "douze", "treize", "quatorze", "quinze", "seize")


def parse_number(c: Column) -> Column:
    """A French number word, or the digits of a text with a decimal comma or point; case, marks, hyphens and units beside it do not matter."""
    t = F.trim(F.replace(fold_text(c), F.lit("-"), F.lit(" ")))
    word = F.array_position(F.array(*map(F.lit, NUMBER_WORDS)), F.when(t == "une", "un").otherwise(t))
    digits = F.replace(F.regexp_replace(t, r"[^0-9,.]", ""), F.lit(","), F.lit("."))
    return F.when(word > 0, (word - 1).cast("double")).otherwise(digits.try_cast("double"))


def is_iso_date(c: Column) -> Column:
    return c.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$") & F.try_to_date(c, "yyyy-M-d").isNotNull()


def parse_instant(c: Column) -> Column:
    """An ISO instant with Z, or an offset of hours or hours and minutes; null if it is none."""
    whole = F.regexp_replace(F.regexp_replace(strip_spaces(c), "Z$", "+00:00"), r"(T.*[+-]\d{2})$", "$1:00")
    return F.try_to_timestamp(whole)


def host_of(url: Column) -> Column:
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def host_allowed(url: Column, domain: str) -> Column:
    """The domain itself or one below it."""
    h = host_of(url)
    return F.coalesce((h == domain) | h.endswith("." + domain), F.lit(False))


def is_official(url: Column) -> Column:
    h = host_of(url)
    return F.coalesce((h == "gouv.fr") | h.endswith(".gouv.fr"), F.lit(False))
