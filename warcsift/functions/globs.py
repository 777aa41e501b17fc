"""Shell-style URL globs as one anchored regular expression.

Semantics follow Python's ``fnmatch`` on a POSIX system: the whole URL must
match, matching is case-sensitive, ``*`` also crosses ``/``, ``?`` is any one
character, ``[seq]`` / ``[!seq]`` are character sets, and a ``[`` without a
closing ``]`` is a literal. Every character is emitted as ``\\x{HEX}`` where
it could be special, so the same regex text means the same in Java (Spark)
and in RE2 (DuckDB, used by the oracles).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from .text import once

_MAX_CP = 0x10FFFF

# One glob element: a closed set, a run of stars, or any one character.
_ELEMENT_RX = r"(?s)\[!?+\]?+[^\]]*+\]|\*+|."
_HOST_RX = r"(?s)\A[^\[]*?://(?:\*\.)?([^/*?\[\]]+)/"


def _lit(ch: str) -> str:
    if ch.isascii() and ch.isalnum():
        return ch
    return "\\x{%X}" % ord(ch)


def _parse_set(body: str) -> list[tuple[str, str]]:
    """Members of a set body as (lo, hi) pairs; empty ranges are dropped.

    The first character is always a member (so ``-`` or ``]`` may lead); a
    ``-`` between two characters forms a range; any other ``-`` is literal.
    """
    out: list[tuple[str, str]] = []
    i, n = 0, len(body)
    while i < n:
        if i + 2 < n and body[i + 1] == "-":
            lo, hi = body[i], body[i + 2]
            if lo <= hi:
                out.append((lo, hi))
            i += 3
        else:
            out.append((body[i], body[i]))
            i += 1
    return out


def glob_to_regex(pattern: str) -> str | None:
    """Unanchored regex body for one glob, or ``None`` if it can never match."""
    parts: list[str] = []
    i, n = 0, len(pattern)
    while i < n:
        c = pattern[i]
        i += 1
        if c == "*":
            if not parts or parts[-1] != ".*":
                parts.append(".*")
        elif c == "?":
            parts.append(".")
        elif c == "[":
            j = i
            if j < n and pattern[j] == "!":
                j += 1
            if j < n and pattern[j] == "]":
                j += 1
            while j < n and pattern[j] != "]":
                j += 1
            if j >= n:
                parts.append(_lit("["))
                continue
            body = pattern[i:j]
            i = j + 1
            negate = body.startswith("!")
            members = _parse_set(body[1:] if negate else body)
            if not members:
                if negate:
                    parts.append(".")
                    continue
                return None
            cls = "".join(_lit(lo) if lo == hi else f"{_lit(lo)}-{_lit(hi)}"
                          for lo, hi in members)
            parts.append(f"[{'^' if negate else ''}{cls}]")
        else:
            parts.append(_lit(c))
    return "".join(parts)


def globs_to_regex(patterns: list[str]) -> str | None:
    """One anchored regex matching a string iff any glob matches it.

    ``None`` means no string can match (empty list, or only impossible sets).
    """
    bodies = [b for b in (glob_to_regex(p) for p in patterns) if b is not None]
    if not bodies:
        return None
    return "(?s)\\A(?:" + "|".join(bodies) + ")\\z"


def globs_to_python_regex(patterns: list[str]) -> str | None:
    """The same expression in Python's spelling (``\\x{2E}`` is ``\\U0000002e`` there)."""
    rx = globs_to_regex(patterns)
    if rx is None:
        return None
    return re.sub(r"\\x\{([0-9A-F]+)\}", lambda m: f"\\U{int(m[1], 16):08x}", rx).replace("\\z", "\\Z")


def url_matches_any(url: Column, patterns: list[str]) -> Column:
    """Boolean column: ``url`` matches at least one glob (NULL url -> NULL)."""
    rx = globs_to_regex(patterns)
    if rx is None:
        return F.lit(False)
    return url.rlike(rx)


def _char_rx(ch: Column) -> Column:
    return F.concat(F.lit("\\x{"), F.hex(F.ascii(ch)), F.lit("}"))


def _set_rx(element: Column) -> Column:
    """Regex of a set element, NULL if no character is in it."""
    negated = F.substring(element, 2, 1) == "!"
    body = F.regexp_extract(element, r"(?s)\A\[!?(.*)\]\z", 1)
    pair = lambda m: F.char_length(m) == 3
    first, last = (lambda m: F.substring(m, 1, 1)), (lambda m: F.substring(m, 3, 1))
    members = F.filter(F.regexp_extract_all(body, F.lit("(?s).-.|."), F.lit(0)), lambda m: ~pair(m) | (first(m) <= last(m)))
    text = F.array_join(F.transform(members, lambda m: F.when(
        pair(m), F.concat(_char_rx(first(m)), F.lit("-"), _char_rx(last(m)))).otherwise(_char_rx(m))), "")
    return (F.when(text != "", F.concat(F.when(negated, F.lit("[^")).otherwise(F.lit("[")), text, F.lit("]")))
            .when(negated, F.lit(".")))


def glob_elements(glob: Column) -> Column:
    """A glob column cut into its elements."""
    return F.regexp_extract_all(glob, F.lit(_ELEMENT_RX), F.lit(0))


def _is_set(element: Column) -> Column:
    return F.startswith(element, F.lit("[")) & (F.char_length(element) > 1)


def glob_regex(elements: Column) -> Column:
    """The anchored regex of each glob's elements (as ``globs_to_regex`` gives for one
    glob), NULL where no string can match."""
    parts = F.transform(elements, lambda e: F.when(F.startswith(e, F.lit("*")), F.lit(".*")).when(e == "?", F.lit("."))
                        .when(_is_set(e), _set_rx(e)).otherwise(_char_rx(e)))
    return F.when(~F.exists(parts, lambda p: p.isNull()),
                  F.concat(F.lit("(?s)\\A(?:"), F.array_join(parts, ""), F.lit(")\\z")))


def glob_literals(elements: Column) -> Column:
    """The runs of literal characters of each glob: every match contains each of them."""
    plain = F.transform(elements, lambda e: F.when(F.startswith(e, F.lit("*")) | (e == "?") | _is_set(e), F.lit("\0")).otherwise(e))
    return F.split(F.array_join(plain, ""), "\0")


def glob_host(glob: Column) -> Column:
    """The literal host of a glob between ``://`` (or ``://*.``) and ``/``, NULL without one."""
    return F.nullif(F.regexp_extract(glob, _HOST_RX, 1), F.lit(""))


def ngrams(text: Column, n: Column) -> Column:
    """The distinct ``n``-character pieces of a text; one empty piece where ``n`` is 0."""
    at = F.sequence(F.lit(1), F.char_length(text) - n + 1)
    pieces = once(F.split(text, ""), lambda chars: F.transform(at, lambda i: F.array_join(F.slice(chars, i, n), "")))
    return (F.when(n == 0, F.array(F.lit(""))).when(F.char_length(text) >= n, F.array_distinct(pieces))
            .otherwise(F.array().cast("array<string>")))
