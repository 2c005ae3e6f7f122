"""Text forms, markers and deterministic ids as columns."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters that normalising replaces one by one, and those it drops.
REPLACED = {
    " ": " ", "‘": "'", "’": "'", "‚": "'", "‛": "'", "“": '"', "”": '"', "„": '"', "‟": '"',
    "–": "-", "—": "-", "−": "-",
}
ZERO_WIDTH = "​‌‍﻿⁠"


def _compatible(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFKC", t))


def _bare(texts: pd.Series) -> pd.Series:
    def bare(t: str | None) -> str | None:
        if t is None:
            return None
        t = t.lower()
        return t if t.isascii() else "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))

    return texts.map(bare)


_nfkc = F.pandas_udf(_compatible, T.StringType())
_fold = F.pandas_udf(_bare, T.StringType())

def is_ascii(text: Column) -> Column:
    """Whether a text has as many bytes as characters, which is found without looking at each."""
    return F.length(text) == F.octet_length(text)


#: Latin letters and common punctuation. None of these joins with a neighbour, so what holds of each holds of a text of them.
_LATIN = [chr(i) for i in (*range(0x180), *range(0x2010, 0x2028))]


def _outside(chars: Iterable[str]) -> str:
    """A pattern for any other character."""
    own = {ord(c) for c in chars}
    assert own.issuperset(range(128))
    # Whether a character is one of many ranges takes long to find out, and most characters are ASCII; so they are passed over first.
    return r"(?=[^\x00-\x7f])[^" + "".join(f"\\u{i:04x}" + f"-\\u{next(j for j in range(i, 1 << 16) if j + 1 not in own):04x}" for i in sorted(own) if i - 1 not in own) + "]"


#: Letters with their lower case as it is, and that without marks, where either is one character.
_BARE = {c: "".join(x for x in unicodedata.normalize("NFKD", c.lower()) if not unicodedata.combining(x)) for c in _LATIN if len(c.lower()) == 1}
_BARE = {c: b for c, b in _BARE.items() if len(b) == 1}
_MARKED = {c.lower(): b for c, b in _BARE.items() if c.lower() != b}
_UNSTABLE = _outside(c for c in _LATIN if unicodedata.normalize("NFKC", c) == c)
_UNCOMMON = _outside(c for c in _BARE if c.lower() in _BARE)
#: Any character from the first that normalising replaces or drops: most texts hold none, and are left as they are.
_REPLACEABLE = r"[\xa0\u2000-\x{10ffff}]"
assert all(re.search("[\xa0\u2000-\U0010ffff]", c) for c in (*REPLACED, *ZERO_WIDTH, "\u2026"))


def compatible(text: Column) -> Column:
    """Compatibility form. Only texts that it may change go to Python."""
    return F.coalesce(_nfkc(F.when(~is_ascii(text) & F.rlike(text, F.lit(_UNSTABLE)), text)), text)


def bare(text: Column) -> Column:
    """Lower case without marks. Only texts with other than Latin letters go to Python."""
    low = F.lower(text)
    return F.coalesce(_fold(F.when(~is_ascii(text) & F.rlike(text, F.lit(_UNCOMMON)), text)), F.when(is_ascii(text), low).otherwise(F.translate(low, "".join(_MARKED), "".join(_MARKED.values()))))


def normalized(text: Column) -> Column:
    """Compatibility form, plain quotes and dashes, no zero-width characters, single spaces, trimmed."""
    t = compatible(text)
    changed = F.translate(t, "".join(REPLACED), "".join(REPLACED.values()))
    changed = F.regexp_replace(F.replace(changed, F.lit("\u2026"), F.lit("...")), f"[{ZERO_WIDTH}]", "")
    t = F.when(is_ascii(t) | ~F.rlike(t, F.lit(_REPLACEABLE)), t).otherwise(changed)
    return F.trim(F.regexp_replace(t, r"(?U)[\s\x1c-\x1f\x85]+", " "))


def folded(text: Column, normalise: bool = True) -> Column:
    """Lower case without marks, of the normalised text or of the text as it is."""
    return bare(normalized(text) if normalise else text)


def tokens(fold: Column) -> Column:
    return F.regexp_extract_all(fold, F.lit("([a-z0-9]+)"), F.lit(1))


def any_of(tests: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def contains_any(text: Column, markers: Iterable[str]) -> Column:
    return any_of(F.contains(text, F.lit(m)) for m in markers)


def starts_with_any(text: Column, starts: Iterable[str]) -> Column:
    return any_of(F.startswith(text, F.lit(s)) for s in starts)


def unicode_pattern(pattern: str) -> str:
    """A pattern whose classes and word boundaries know all of Unicode."""
    return "(?U)" + pattern


def apart(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value) as a lambda of its own. The code of many tests in one row would be too long for the JVM to compile; so it stays out of the generated method."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


#: A pattern that is nothing but words between word boundaries.
_WORDS = re.compile(r"\\b([^\\\[\](){}.*+?^$|]+)\\b")


def matches(text: Column, pattern: str) -> Column:
    """Whether a pattern occurs; where it is plain words, a search for these comes first, which is cheap and mostly fails."""
    found = F.rlike(text, F.lit(unicode_pattern(pattern)))
    return F.contains(text, F.lit(m[1])) & found if (m := _WORDS.fullmatch(pattern)) else found


def matches_any(text: Column, patterns: Iterable[str]) -> Column:
    return any_of(matches(text, p) for p in patterns)


def _any_start(words: Iterable[str]) -> str:
    """A pattern for any of the words, by their first letters; after a word that ends in a letter of a to z there may be no other."""

    def branch(ends: set[str], last: str) -> str:
        ways = [re.escape(c) + branch({w[1:] for w in ends if w[:1] == c}, c) for c in sorted({w[0] for w in ends if w})]
        if "" in ends:
            ways.append("(?![a-z])" if "a" <= last <= "z" else "")
        return ways[0] if len(ways) == 1 else f"(?:{'|'.join(ways)})"

    return "(?<![a-z])" + branch(set(words), "")


def may_match(text: Column, patterns: Iterable[str]) -> Column:
    """True where any pattern occurs, and mostly false elsewhere. Plain words are looked for together in one pass over the text, from the starts of its words on."""
    own = list(dict.fromkeys(patterns))
    words = {p: m[1] for p in own if (m := _WORDS.fullmatch(p)) and "a" <= m[1][0] <= "z"}
    tests = [matches(text, p) for p in own if p not in words]
    return any_of([F.rlike(text, F.lit(_any_start(words.values()))), *tests] if words else tests)


def hash_id(prefix: str, *parts: Column | str) -> Column:
    """prefix and 16 hex digits of the SHA-256 of the parts joined by ``::``."""
    own = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws("::", *own), 256), 1, 16))
