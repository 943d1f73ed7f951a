"""Text analysis as column expressions: tokens, term and match predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# CJK code points become single-character tokens.
_CJK = r"([\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}])"
_SEP = r"[^\p{L}\p{N}]+"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text) -> Column:
    """Lower-cased tokens: split on runs of non letters/digits; each CJK
    character is its own token; empty tokens dropped.  Works on whole texts."""
    spaced = F.regexp_replace(F.lower(_c(text)), _CJK, " $1 ")
    # array_remove is a native (codegen) expression; a lambda filter would be interpreted per token
    return F.array_remove(F.split(spaced, _SEP), "")


def analyse(text: str) -> list[str]:
    """The same analysis for a short query string on the driver (query text
    only, never data)."""
    import regex

    s = regex.sub(r"([\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}])", r" \1 ", text.lower())
    return [t for t in regex.split(r"[^\p{L}\p{N}]+", s) if t]


def term(col, value: str) -> Column:
    """Exact (non-analysed) token: the indexed tokens of ``col`` contain
    ``value``.  A value that cannot be a token (upper case, separators,
    CJK inside a longer string) never matches."""
    import regex
    if not regex.fullmatch(r"[\p{L}\p{N}]+", value) or value != value.lower() or (
            len(value) > 1 and regex.search(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}]", value)):
        return F.lit(False)
    return has_token(col, value)


# A letter or digit that is not CJK: such characters extend a token; anything
# else (separator or CJK character, itself a one-character token) ends it.
_WORD = r"[\p{L}\p{N}&&[^\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}]]"


def _is_cjk(t: str) -> bool:
    import regex
    return bool(regex.fullmatch(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}]", t))


def token_pattern(terms) -> str:
    """Regex finding any of ``terms`` as a whole token of lower-cased text."""
    alts = "|".join(sorted({t for t in terms}, key=len, reverse=True))
    return f"(?<!{_WORD})(?:{alts})(?!{_WORD})"


def has_token(col, t: str) -> Column:
    """``t`` occurs as a token of ``col`` (one regex scan, no token array)."""
    low = F.lower(_c(col))
    if _is_cjk(t):
        return F.instr(low, t) > 0
    return low.rlike(token_pattern([t]))


def match(col, text: str, operator: str = "or") -> Column:
    """Analysed match: ``or`` -> any query token present, ``and`` -> all.

    Evaluated as a regex search for whole tokens in the lower-cased text
    (same result as comparing with :func:`tokens`, without building arrays)."""
    q = analyse(text)
    if not q:
        return F.lit(False)
    if operator == "and":
        cond = F.lit(True)
        for t in dict.fromkeys(q):
            cond = cond & has_token(col, t)
        return cond
    cjk = [t for t in q if _is_cjk(t)]
    words = [t for t in q if not _is_cjk(t)]
    low = F.lower(_c(col))
    cond = low.rlike(token_pattern(words)) if words else F.lit(False)
    for t in dict.fromkeys(cjk):
        cond = cond | (F.instr(low, t) > 0)
    return cond
