"""Python's regular expressions said in Java's, over the parsed expression.

A pattern is parsed as Python parses it and written anew, so that escapes, flags within it, names of groups and the meaning of classes, anchors and
the dot are Python's: \\w is letters, numbers and the underscore, \\s is what str.isspace says, the dot stops at a newline alone, and $ may stand before a
last newline. What Java can't say is named by ``unsayable`` and refused by ``java``.
"""

from __future__ import annotations

import re
import re._constants as C
import re._parser as parser
from functools import lru_cache

WORD, DIGIT, SPACE = r"\p{L}\p{N}_", r"\p{Nd}", r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
ASCII = {WORD: "A-Za-z0-9_", DIGIT: "0-9", SPACE: r"\t-\r\x20"}
_CATEGORIES = {C.CATEGORY_WORD: (WORD, False), C.CATEGORY_NOT_WORD: (WORD, True), C.CATEGORY_DIGIT: (DIGIT, False), C.CATEGORY_NOT_DIGIT: (DIGIT, True), C.CATEGORY_SPACE: (SPACE, False), C.CATEGORY_NOT_SPACE: (SPACE, True)}
_CASED = re.IGNORECASE


class Unsayable(ValueError):
    """A pattern that Java has no words for."""


def _char(code: int) -> str:
    return chr(code) if chr(code).isascii() and chr(code).isalnum() else f"\\x{{{code:x}}}"


def _named(category: int, flags: int) -> tuple[str, bool]:
    inner, negated = _CATEGORIES[category]
    return (ASCII[inner] if flags & re.ASCII else inner), negated


def _set(items: list, flags: int) -> str:
    """A class; one that holds complements is a union with them, and its negation an intersection."""
    negate, inner, complements = False, "", []
    for op, value in items:
        if op is C.NEGATE:
            negate = True
        elif op is C.LITERAL:
            inner += _char(value)
        elif op is C.RANGE:
            inner += f"{_char(value[0])}-{_char(value[1])}"
        else:
            named, without = _named(value, flags)
            if without:
                complements.append(named)
            else:
                inner += named
    if len(complements) == 1 and not inner:
        return f"[{'' if negate else '^'}{complements[0]}]"
    if not negate:
        return f"[{inner}{''.join(f'[^{c}]' for c in complements)}]"
    return f"[{'&&'.join([*(f'[{c}]' for c in complements), *[f'[^{inner}]'] * bool(inner)])}]"


def _at(where: int, flags: int) -> str:
    word = f"[{ASCII[WORD] if flags & re.ASCII else WORD}]"
    lines = flags & re.MULTILINE
    return {
        C.AT_BEGINNING: r"(?<![^\n])" if lines else r"\A", C.AT_BEGINNING_STRING: r"\A",
        C.AT_END: r"(?=\n|\z)" if lines else r"(?=\n?\z)", C.AT_END_STRING: r"\z",
        C.AT_BOUNDARY: f"(?:(?<={word})(?!{word})|(?<!{word})(?={word}))",
        C.AT_NON_BOUNDARY: f"(?:(?<={word})(?={word})|(?<!{word})(?!{word}))",
    }[where]


def _repeat(value: tuple, flags: int, mode: str) -> str:
    """A repeated class stays bare, since Java goes through groups by recursion."""
    least, most, inner = value
    body = _said(inner, flags)
    if len(inner) != 1 or inner[0][0] not in (C.LITERAL, C.NOT_LITERAL, C.ANY, C.IN):
        body = f"(?:{body})"
    times = {(0, C.MAXREPEAT): "*", (1, C.MAXREPEAT): "+", (0, 1): "?"}.get((least, most), f"{{{least},{'' if most is C.MAXREPEAT else most}}}")
    return f"{body}{times}{mode}"


def _group(value: tuple, flags: int) -> str:
    number, add, remove, inner = value
    own = (flags | add) & ~remove
    body = _said(inner, own)
    if number is not None:
        return f"({body})"  # names go by number: Java's can't have an underscore
    if (own ^ flags) & _CASED:
        return f"(?{'' if own & _CASED else '-'}iu:{body})"
    return f"(?:{body})"


def _said(parsed, flags: int) -> str:
    out = []
    for op, value in parsed:
        if op is C.LITERAL:
            out.append(_char(value))
        elif op is C.NOT_LITERAL:
            out.append(f"[^{_char(value)}]")
        elif op is C.ANY:
            out.append(r"[\x{0}-\x{10ffff}]" if flags & re.DOTALL else r"[^\n]")
        elif op is C.IN:
            out.append(_set(value, flags))
        elif op is C.AT:
            out.append(_at(value, flags))
        elif op is C.BRANCH:
            out.append("(?:" + "|".join(_said(x, flags) for x in value[1]) + ")")
        elif op is C.SUBPATTERN:
            out.append(_group(value, flags))
        elif op is C.MAX_REPEAT:
            out.append(_repeat(value, flags, ""))
        elif op is C.MIN_REPEAT:
            out.append(_repeat(value, flags, "?"))
        elif op is C.POSSESSIVE_REPEAT:
            out.append(_repeat(value, flags, "+"))
        elif op is C.ATOMIC_GROUP:
            out.append(f"(?>{_said(value, flags)})")
        elif op in (C.ASSERT, C.ASSERT_NOT):
            sign = "=" if op is C.ASSERT else "!"
            out.append(f"(?{'<' if value[0] < 0 else ''}{sign}{_said(value[1], flags)})")
        elif op is C.GROUPREF:
            out.append(f"(?:\\{value})")
        elif op is C.FAILURE:
            out.append("(?!)")
        elif op is C.GROUPREF_EXISTS:
            raise Unsayable("a condition on a group")
        else:
            raise Unsayable(str(op).lower())
    return "".join(out)


@lru_cache(1024)
def java(pattern: str) -> str:
    """A Python pattern for Java's regex, with groups of the same numbers."""
    parsed = parser.parse(pattern)
    flags = parsed.state.flags
    if flags & re.LOCALE:
        raise Unsayable("the locale flag")
    return ("(?iu)" if flags & _CASED else "") + _said(parsed, flags)


def unsayable(pattern: str) -> str | None:
    """What of a pattern Java can't say; none if it can say all. The pattern is one that Python compiles."""
    try:
        java(pattern)
    except Unsayable as e:
        return str(e)
    return None


def java_replacement(text: str, pattern: str) -> str:
    """A Python replacement for Java's. Digits are escaped too, so that none joins the number of a group."""
    out = []
    for part in parser.parse_template(text, re.compile(pattern)):
        if isinstance(part, int):
            out.append(f"${part}")
        else:
            out += [c if c.isalpha() or c == " " else f"\\{c}" for c in part]
    return "".join(out)
