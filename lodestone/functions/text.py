"""Text analysis and token predicates as JVM column expressions.

A token is a maximal run of letters and digits of the normalised text.  Token
predicates are written as one regular expression with token-boundary look-arounds
over that text: the scan stops at the first match, builds no token array and stays
inside generated code, which matters for texts of 20,000 words.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from itertools import groupby
from math import comb

from pyspark.sql import Column
from pyspark.sql import functions as F

# The token character class and its complement.
WORD = r"[\p{L}\p{N}]"
OTHER = r"[^\p{L}\p{N}]"
GAP = OTHER + "++"
LEFT = rf"(?<!{WORD})"
RIGHT = rf"(?!{WORD})"

# Plural endings (Harman 1991) - ending, forbidden preceding letters, replacement.
PLURALS = [
    ("ies", "ea", "y"),
    ("es", "aeo", "e"),
    ("s", "us", ""),
]


def _accent_table() -> tuple[str, str]:
    """Lower-case Latin letters that decompose into an ASCII letter plus marks."""
    src, dst = [], []
    for cp in range(0xC0, 0x250):
        ch = chr(cp)
        base = unicodedata.normalize("NFD", ch)[0]
        if base != ch and base.isascii():
            src.append(ch)
            dst.append(base)
    return "".join(src), "".join(dst)


ACCENTED, PLAIN = _accent_table()


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


@dataclass(frozen=True)
class Analyzer:
    """Case, accent and plural switches; ``stem_when`` limits stemming to some rows."""

    lower: bool = True
    fold_accents: bool = False
    stem: bool = False
    stem_when: Column | None = None

    def text(self, c: Column | str) -> Column:
        c = as_col(c)
        if self.lower:
            c = F.lower(c)
        if self.fold_accents:
            c = F.translate(c, ACCENTED, PLAIN)
        if self.stem:
            s = c
            for ending, forbidden, new in PLURALS:
                s = F.regexp_replace(s, rf"(?<={WORD}{{2}})(?<![{forbidden}]){ending}{RIGHT}", new)
            c = s if self.stem_when is None else F.when(self.stem_when, s).otherwise(c)
        return c

    def terms(self, query: str) -> list[str]:
        """The query string's tokens under the same switches (driver side, few words)."""
        q = query.lower() if self.lower else query
        if self.fold_accents:
            q = q.translate(str.maketrans(ACCENTED, PLAIN))
        runs = groupby(q, key=lambda ch: unicodedata.category(ch)[0] in "LN")
        return [self._stem("".join(g)) for is_word, g in runs if is_word]

    def _stem(self, t: str) -> str:
        if self.stem:
            for ending, forbidden, new in PLURALS:
                stem = t.removesuffix(ending)
                if stem != t and len(stem) >= 2 and stem[-1] not in forbidden:
                    return stem + new
        return t


DEFAULT = Analyzer()
CASED = Analyzer(lower=False)


def tokens(c: Column | str, an: Analyzer = DEFAULT) -> Column:
    """Token array (``array_remove`` keeps it free of lambdas)."""
    return F.array_remove(F.split(an.text(c), GAP), "")


def token_count(c: Column | str, an: Analyzer = DEFAULT) -> Column:
    return F.regexp_count(an.text(c), F.lit(WORD + "++"))


def grams(c: Column | str, n: int) -> Column:
    """Character n-grams of the lower-cased value; shorter values give none."""
    low = F.lower(as_col(c))
    return F.when(
        F.length(low) >= n,
        F.transform(F.sequence(F.lit(1), F.length(low) - n + 1), lambda i: F.substring(low, i, F.lit(n))),
    ).otherwise(F.array().cast("array<string>"))


def _query(terms: str | list[str] | tuple[str, ...], an: Analyzer) -> list[str]:
    words = [terms] if isinstance(terms, str) else list(terms)
    out = [t for w in words for t in an.terms(w)]
    if not out:
        raise ValueError("the query has no terms")
    return out


def _matches(text: Column, needles: list[str], pattern: str) -> Column:
    """Cheap substring tests decide most rows before a costly regular expression runs."""
    cond = text.rlike(pattern)
    for t in reversed(needles):
        cond = text.contains(t) & cond
    return cond


def _start(term: str) -> str:
    """A term that begins a token.  The letters come first and the look-behind after them,
    so the search skips ahead by the letters instead of testing every position."""
    return rf"{term}(?<!{WORD}{term})"


def _phrase_rx(q: list[str]) -> str:
    return "".join([_start(q[0]), *[f"{GAP}{t}" for t in q[1:]], RIGHT])


def phrase(c: Column | str, terms, an: Analyzer = DEFAULT) -> Column:
    """Terms adjacent and in order."""
    return an.text(c).rlike(_phrase_rx(_query(terms, an)))


def contains(c: Column | str, value: str, an: Analyzer = DEFAULT) -> Column:
    """One token present; several words mean a phrase."""
    return phrase(c, value, an)


def word(c: Column | str, value: str) -> Column:
    """Token match without stemming."""
    return phrase(c, value, DEFAULT)


def equals_value(c: Column | str, value: str) -> Column:
    """Whole value, any case (attribute fields)."""
    return F.lower(as_col(c)) == value.lower()


def exact(c: Column | str, value: str) -> Column:
    return as_col(c) == F.lit(value)


def prefix(c: Column | str, value: str) -> Column:
    return as_col(c).startswith(value)


def suffix(c: Column | str, value: str) -> Column:
    return as_col(c).endswith(value)


def substring(c: Column | str, value: str) -> Column:
    return as_col(c).contains(value)


def cased(c: Column | str, value: str) -> Column:
    return phrase(c, value, CASED)


def uncased(c: Column | str, value: str) -> Column:
    return phrase(c, value, DEFAULT)


def gram_match(c: Column | str, value: str, n: int = 3) -> Column:
    """Every n-gram of the value occurs in the field."""
    v = value.lower()
    low = F.lower(as_col(c))
    needles = dict.fromkeys(v[i : i + n] for i in range(len(v) - n + 1))
    if not needles:
        raise ValueError(f"the value has no {n}-gram")
    cond = F.lit(True)
    for g in needles:
        cond = cond & low.contains(g)
    return cond


def matches(c: Column | str, regex: str) -> Column:
    return as_col(c).rlike(regex)


def text_match(c: Column | str, query: str, an: Analyzer = DEFAULT) -> Column:
    """All tokens of the analysed query present, anywhere."""
    cond = None
    for t in dict.fromkeys(_query(query, an)):
        m = an.text(c).rlike(_phrase_rx([t]))
        cond = m if cond is None else cond & m
    return cond


def equiv(c: Column | str, terms, an: Analyzer = DEFAULT) -> Column:
    """Any of the synonyms, counted as one term."""
    return an.text(c).rlike(_equiv_rx(terms, an))


def _equiv_rx(terms, an: Analyzer) -> str:
    return "(?:" + "|".join(_phrase_rx(_query(t, an)) for t in terms) + ")"


def near(c: Column | str, terms, distance: int = 2, an: Analyzer = DEFAULT) -> Column:
    """All terms inside a window of ``distance`` positions, any order.

    A window starts at one of the terms; one look-ahead per term finds it at most
    ``distance`` tokens further on.
    """
    q = list(dict.fromkeys(_query(terms, an)))
    skip = rf"(?:{WORD}++{OTHER}++){{0,{distance}}}"
    start = "(?=(?:" + "|".join(q) + ")" + RIGHT + ")" + LEFT
    return _matches(an.text(c), q, start + "".join(f"(?={skip}{t}{RIGHT})" for t in q))


# Ways to share a distance among the gaps that one pattern may spell out.
MOST_SPLITS = 24


def onear(c: Column | str, terms, distance: int = 2, an: Analyzer = DEFAULT) -> Column:
    """As :func:`near`, in query order.

    Few terms close together are one pattern.  Otherwise every occurrence of the first term gives the window of ``distance`` more
    tokens, where each further term is taken at its first place after the one before: the earliest chain ends earliest, so no other
    need be tried, and the pattern grows with the number of terms alone.
    """
    q = _query(terms, an)
    if distance < len(q) - 1:
        return F.lit(False)
    text = an.text(c)
    if comb(distance, len(q) - 1) > MOST_SPLITS:
        window = rf"(?={q[0]}{RIGHT}){LEFT}(?=((?:{WORD}++{OTHER}*+){{1,{distance + 1}}}))"
        chain = rf"(?s)^{q[0]}" + "".join(rf"(?>.*?{LEFT}{t}{RIGHT})" for t in q[1:])
        # the pattern finds the windows of the rows that hold every term
        found = F.exists(F.regexp_extract_all(text, F.lit(window), F.lit(1)), lambda w: w.rlike(chain))
        for t in dict.fromkeys(q):
            found = text.contains(t) & found
        return found

    def rest(i: int, budget: int) -> str:
        if i == len(q):
            return RIGHT
        after = len(q) - i - 1
        if after == 0:
            return rf"{OTHER}++(?:{WORD}++{OTHER}++){{0,{budget - 1}}}?{q[i]}{RIGHT}"
        steps = [
            rf"{OTHER}++(?:{WORD}++{OTHER}++){{{s - 1}}}{q[i]}{RIGHT}{rest(i + 1, budget - s)}"
            for s in range(1, budget - after + 1)
        ]
        return "(?:" + "|".join(steps) + ")"

    return _matches(text, list(dict.fromkeys(q)), _start(q[0]) + RIGHT + rest(1, distance))


def _close(t: Column, term: str, max_edits: int, prefix_length: int) -> Column:
    cond = F.abs(F.length(t) - len(term)) <= max_edits
    if prefix_length:
        cond = cond & t.startswith(term[:prefix_length])
    return cond & (F.levenshtein(t, F.lit(term), max_edits) >= 0)


def fuzzy_value(c: Column | str, term: str, max_edits: int = 2, prefix_length: int = 0) -> Column:
    """Whole value within an edit distance, its first letters exact."""
    return _close(F.lower(as_col(c)), term.lower(), max_edits, prefix_length)


def fuzzy(c: Column | str, term: str, max_edits: int = 2, prefix_length: int = 0, an: Analyzer = DEFAULT) -> Column:
    """Some token within an edit distance; lengths are compared before the edits."""
    (t,) = _query(term, an)
    return F.exists(tokens(c, an), lambda x: _close(x, t, max_edits, prefix_length))


# Scheme and credentials before the host, and the host characters.
URL_PREFIX = r"^([A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?)"
URL_HOST = URL_PREFIX + r"([^/:?#]*)"


def uri(c: Column | str, value: str, start_anchor: bool = False, end_anchor: bool = False) -> Column:
    """URL parts as a token phrase; anchors tie it to the host's first / last token."""
    c = as_col(c)
    q = _query(value, DEFAULT)
    if not (start_anchor or end_anchor):
        return phrase(c, q)
    wanted = F.array(*[F.lit(t) for t in q])
    toks = tokens(c)
    before = token_count(F.regexp_extract(c, URL_PREFIX, 1))
    upto = before + token_count(F.regexp_extract(c, URL_HOST, 2))
    conds = []
    if start_anchor:
        conds.append(F.slice(toks, before + 1, F.lit(len(q))) == wanted)
    if end_anchor:
        conds.append(F.when(upto >= len(q), F.slice(toks, upto - len(q) + 1, F.lit(len(q))) == wanted).otherwise(False))
    # a cheap phrase test first: the token arrays are built for its few survivors only
    out = phrase(c, q)
    for k in conds:
        out = out & k
    return out


def any_field(predicate, *fields) -> Column:
    """Fieldset search: the predicate holds on at least one field."""
    out = None
    for f in fields:
        out = predicate(f) if out is None else out | predicate(f)
    return out


def term_count(c: Column | str, term, an: Analyzer = DEFAULT) -> Column:
    """Occurrences of a term (a phrase, or a list of synonyms counted as one)."""
    if isinstance(term, (list, tuple)):
        return F.regexp_count(an.text(c), F.lit(_equiv_rx(term, an)))
    q, text = _query(term, an), an.text(c)
    count = F.regexp_count(text, F.lit(_phrase_rx(q)))
    # most texts lack a rare term, which a substring test tells sooner; a null text has a null count
    lacks = ~text.contains(q[0])
    for t in q[1:]:
        lacks = lacks | ~text.contains(t)
    return F.when(lacks, F.lit(0)).otherwise(count)


def highlight(c: Column | str, terms) -> Column:
    """Whole-token matches set in bold tags, original case kept."""
    q = _query(terms, DEFAULT)
    rx = rf"(?iu){LEFT}({'|'.join(dict.fromkeys(q))}){RIGHT}"
    return F.regexp_replace(as_col(c), rx, "<b>$1</b>")
