"""Text functions on generated responses: answer extraction, tag flags,
word counts, stop-string truncation and Python-style stripping.

All are native Column expressions (Java regex inside whole-stage codegen);
nothing here leaves the JVM.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col


def _char_class_body(codepoints: list[int]) -> str:
    """Render sorted code points as a Java regex character-class body."""
    parts: list[str] = []
    start = prev = codepoints[0]
    for cp in codepoints[1:] + [-1]:
        if cp == prev + 1:
            prev = cp
            continue
        if start == prev:
            parts.append(f"\\x{{{start:x}}}")
        else:
            parts.append(f"\\x{{{start:x}}}-\\x{{{prev:x}}}")
        start = prev = cp
    return "".join(parts)


# Whitespace exactly as Python's ``str.isspace`` / ``re`` ``\s`` / ``str.split()``
# understand it: the Unicode White_Space property plus U+001C..U+001F (which
# Java's ``\s`` lacks). Java gets the two-part class (one property lookup per
# character); the explicit list, built from the rule, serves engines without
# Unicode properties (the RE2 oracle) and the consistency test.
PY_SPACE_CODEPOINTS = [c for c in range(sys.maxunicode + 1) if chr(c).isspace()]
WS = r"[\p{IsWhite_Space}\x{1c}-\x{1f}]"
NOT_WS = r"[^\p{IsWhite_Space}\x{1c}-\x{1f}]"
WS_EXPLICIT = "[" + _char_class_body(PY_SPACE_CODEPOINTS) + "]"
NOT_WS_EXPLICIT = "[^" + _char_class_body(PY_SPACE_CODEPOINTS) + "]"

# Fixed values that must equal the reference: the answer and reasoning tags.
ANSWER_OPEN = "<answer>"
ANSWER_CLOSE = "</answer>"
THINK_OPEN = "<think>"
THINK_CLOSE = "</think>"



def _ignorecase_class(ch: str) -> str:
    """Every character Python's ``re.IGNORECASE`` matches for ``ch`` (for
    example ``s`` also matches U+017F), as an explicit class. Spelling the
    tag out this way keeps Python's semantics without Java's slow
    Unicode case-insensitive mode."""
    import re

    p = re.compile(re.escape(ch), re.IGNORECASE)
    cps = [c for c in range(sys.maxunicode + 1) if p.fullmatch(chr(c))]
    return "[" + _char_class_body(cps) + "]"


def _tag_pattern(word: str) -> str:
    return "".join(_ignorecase_class(c) if c.isalpha() else c for c in word)


# Content of an answer tag: case-insensitive (as Python's re.IGNORECASE), dot
# matches newline. Surrounding whitespace is trimmed afterwards, which keeps
# the match linear in runs of blanks.
ANSWER_PATTERN = f"(?s){_tag_pattern('<answer>')}(.*?){_tag_pattern('</answer>')}"
UP_TO_LAST_CLOSE = f"(?s)\\A.*{_tag_pattern('</answer>')}"
PY_SPACES = "".join(map(chr, PY_SPACE_CODEPOINTS))


def extract_answer(text) -> Column:
    """content of the **last** ``<answer>..</answer>``, trimmed.

    NULL when the text is NULL/empty or has no tag; ``""`` for an empty tag.
    A plain substring test on the lower-cased text (``"</an"`` has no other
    case-insensitive spellings) skips the regex for text without a closing
    tag, the common case in long documents. Text after the last closing tag
    is cut first, so that no unclosed tag starts a scan to the end.
    """
    t = as_col(text)
    closed = F.regexp_extract(t, UP_TO_LAST_CLOSE, 0)
    matches = F.regexp_extract_all(closed, F.lit(ANSWER_PATTERN), 1)
    # "</" has no case variants: a plain substring test skips tag-free prose
    # before the lower-cased copy is made.
    candidate = t.contains("</") & (F.instr(F.lower(t), "</an") > 0)
    return F.when(candidate, py_strip(F.try_element_at(matches, F.lit(-1))))


def has_answer_tags(text) -> Column:
    """both answer tags present, case-sensitive substring tests."""
    t = as_col(text)
    return F.coalesce(t.contains(ANSWER_OPEN) & t.contains(ANSWER_CLOSE), F.lit(False))


def has_think_tags(text) -> Column:
    """both reasoning tags present, case-sensitive substring tests."""
    t = as_col(text)
    return F.coalesce(t.contains(THINK_OPEN) & t.contains(THINK_CLOSE), F.lit(False))


def word_count(text) -> Column:
    """``len(text.split())`` -- maximal runs of non-whitespace."""
    return F.regexp_count(as_col(text), F.lit(NOT_WS + "+"))


def py_strip(text) -> Column:
    """Python ``str.strip()``: remove leading and trailing Unicode whitespace."""
    return F.btrim(as_col(text), F.lit(PY_SPACES))


def truncate_at_stop(text, stop: str = ANSWER_CLOSE) -> Column:
    """Cut after the first ``stop`` string (kept), case-sensitive.

    Re-aims the generator's stop handling onto logged text.
    """
    t = as_col(text)
    pos = F.instr(t, stop)
    return F.when(pos > 0, F.substring(t, F.lit(1), pos + F.lit(len(stop) - 1))).otherwise(t)
