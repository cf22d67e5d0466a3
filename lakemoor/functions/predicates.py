"""Conditions with exact null, NaN, regex, list and struct semantics.

All are compositions of Spark's own functions, so Catalyst pushes what Parquet can evaluate and
keeps the whole condition above the scan.
"""

from __future__ import annotations

import re
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def list_contains(c: Column, value: Any) -> Column:
    """Whether a list holds a value: null only for a null list; null elements are no match (rather than unknown)."""
    return F.when(c.isNotNull(), F.coalesce(F.array_contains(c, value), F.lit(False)))


def list_len(c: Column) -> Column:
    """Number of elements; null for a null list."""
    return F.array_size(c).cast("bigint")


def list_get(c: Column, i: int) -> Column:
    """Element i from 0, negative from the end; an error out of bounds."""
    return c[i] if i >= 0 else F.element_at(c, i)


#: POSIX classes (of ASCII), and Unicode scripts and properties that Java calls Is...
POSIX = {
    "alnum": "0-9A-Za-z", "alpha": "A-Za-z", "ascii": r"\x00-\x7F", "blank": r"\t ", "cntrl": r"\x00-\x1F\x7F", "digit": "0-9", "graph": "!-~", "lower": "a-z",
    "print": " -~", "punct": r"!-/:-@\[-`{-~", "space": r"\t\n\x0B\f\r ", "upper": "A-Z", "word": "0-9A-Za-z_", "xdigit": "0-9A-Fa-f",
}
PROPERTIES = frozenset("Alphabetic Arabic Armenian Bengali Cyrillic Devanagari Ethiopic Georgian Greek Han Hangul Hebrew Hiragana Katakana Khmer Lao Latin Lowercase Tamil Telugu Thai Tibetan Uppercase White_Space".split())
_CODE = re.compile(r"x\{([0-9A-Fa-f]+)\}|x([0-9A-Fa-f]{2})|u\{([0-9A-Fa-f]+)\}|u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})")
_PROPERTY = re.compile(r"([pP])(?:\{(\^?)(\w+)\}|([A-Z]))")
_GROUP = re.compile(r"\(\?(?:P?<[A-Za-z_]\w*>|([a-zA-Z]*)(?:-([a-zA-Z]+))?([:)]))")
_QUANTIFIER = re.compile(r"(?:[*+?]|\{\d+(?:,\d*)?\})(\??)")


def java_pattern(pattern: str) -> str:
    r"""A linear-time regular expression in Java's dialect: ``$`` is the very end, ``\w``, ``\d``, ``\s`` and ``\b`` are Unicode's, ``.`` stops at ``\n`` only.

    POSIX classes, ``--`` and ``&&`` within classes, ``(?m)`` and other inner flags, named groups and
    code points are translated. ValueError for what linear-time engines lack (look-around,
    back-references, atomic groups) and for what Java would take for something else (``++``, ``~~``,
    the flags x, R, U and -u, escapes unknown to one of them).
    """
    return "(?dU)" + _Pattern(pattern).translated()


class _Pattern:
    def __init__(self, text: str) -> None:
        self.text, self.at, self.multiline = text, 0, [False]

    def refuse(self, what: str) -> ValueError:
        return ValueError(f"{what} is not supported: {self.text!r}")

    def translated(self) -> str:
        out = []
        while self.at < len(self.text):
            c = self.text[self.at]
            quantifier = _QUANTIFIER.match(self.text, self.at)
            if c == "\\":
                out.append(self.escape(False))
            elif c == "[":
                out.append(self.bracket())
            elif c == "(":
                out.append(self.group())
            elif c == ")":
                if len(self.multiline) == 1:
                    raise self.refuse("an unopened group")
                self.multiline.pop()
                out.append(self.take(1))
            elif c == "^":
                self.take(1)
                out.append(r"(?:\A|(?<=\n))" if self.multiline[-1] else r"\A")
            elif c == "$":
                self.take(1)
                out.append(r"(?=\n|\z)" if self.multiline[-1] else r"\z")
            elif quantifier:
                out.append(self.take(len(quantifier[0])))
                if _QUANTIFIER.match(self.text, self.at):
                    raise self.refuse("a quantifier of a quantifier")
            elif c in "{}]":
                out.append("\\" + self.take(1))
            else:
                out.append(self.take(1))
        if len(self.multiline) > 1:
            raise self.refuse("an unclosed group")
        return "".join(out)

    def take(self, n: int) -> str:
        self.at += n
        return self.text[self.at - n : self.at]

    def group(self) -> str:
        if not self.text.startswith("(?", self.at):
            self.multiline.append(self.multiline[-1])
            return self.take(1)
        m = _GROUP.match(self.text, self.at)
        if not m:
            raise self.refuse("look-around or another special group")
        self.at = m.end()
        if m[3] is None:  # a name is of no use to a condition
            self.multiline.append(self.multiline[-1])
            return "("
        on, off = set(m[1]), set(m[2] or "")
        if bad := (on - set("imsu") | off - set("ims")):
            raise self.refuse(f"the flag {min(bad)}")
        multiline = "m" in on or self.multiline[-1] and "m" not in off
        if m[3] == ":":
            self.multiline.append(multiline)
        else:
            self.multiline[-1] = multiline
        keep = "".join(sorted(on & set("is"))) + ("-" + "".join(sorted(off & set("is"))) if off & set("is") else "")
        return f"(?{keep}{m[3]}" if keep or m[3] == ":" else ""

    def escape(self, in_class: bool) -> str:
        rest = self.text[self.at + 1 :]
        if not rest:
            raise self.refuse("a lone backslash")
        if m := _CODE.match(rest):
            self.take(1 + m.end())
            return rf"\x{{{next(g for g in m.groups() if g)}}}"
        if m := _PROPERTY.match(rest):
            self.take(1 + m.end())
            name = m[3] or m[4]
            if len(name) > 2 and name not in PROPERTIES:
                raise self.refuse(f"the property {name}")
            inverse = (m[1] == "P") != bool(m[2])
            return rf"\{'P' if inverse else 'p'}{{{name if len(name) < 3 else 'Is' + name}}}"
        c = rest[0]
        if c.isdigit() or c == "k":
            raise self.refuse("a back-reference")
        if c.isalpha() and (c not in "dDwWsSnrtfva" if in_class else c not in "dDwWsSbBAznrtfva") or ord(c) > 127 or rest.startswith("b{") or c in "<>":
            raise self.refuse(f"the escape \\{c}")
        self.take(2)
        return {"v": r"\x0B", "a": r"\x07"}.get(c, "\\" + c)

    def bracket(self) -> str:
        """A class: unions of items, of which further ones are taken away or intersected with."""
        self.take(1)
        negated = self.text.startswith("^", self.at)
        self.at += negated
        operands, items, joined = [], [], "&&"
        first = True
        while True:
            rest = self.text[self.at :]
            if not rest:
                raise self.refuse("an unclosed class")
            if rest[0] == "]" and not first:
                self.take(1)
                break
            if rest[:2] in ("&&", "--", "~~") and not (rest[:2] == "--" and first):
                if rest[:2] == "~~":
                    raise self.refuse("~~ in a class")
                operands.append((joined, items))
                items, joined = [], self.take(2)
            elif m := re.match(r"\[:(\^?)(\w+):\]", rest):
                if m[2] not in POSIX:
                    raise self.refuse(f"the class {m[0]}")
                self.take(m.end())
                items.append(f"[{m[1]}{POSIX[m[2]]}]")
            elif rest[0] == "[":
                items.append(self.bracket())
            elif rest[0] == "\\":
                items.append(self.escape(True))
            else:
                c = self.take(1)
                items.append("\\" + c if c in "]&#^ " or c == "-" and (first or self.text[self.at : self.at + 1] == "]") else c)
            first = False
        operands.append((joined, items))
        if any(not x for _, x in operands):
            raise self.refuse("an empty class")
        inner = "&&".join(f"[{'^' if how == '--' else ''}{''.join(x)}]" for how, x in operands)
        return f"[^[{inner}]]" if negated and len(operands) > 1 else f"[^{''.join(operands[0][1])}]" if negated else f"[{inner}]" if len(operands) > 1 else f"[{''.join(operands[0][1])}]"


def contains_regex(c: Column, pattern: str, literal: bool = False) -> Column:
    """Whether a string has a match of the expression (or, literally, the text) anywhere."""
    return F.contains(c, F.lit(pattern)) if literal else c.rlike(java_pattern(pattern))


def starts_with(c: Column, prefix: str) -> Column:
    return c.startswith(prefix)


def ends_with(c: Column, suffix: str) -> Column:
    return c.endswith(suffix)


def len_chars(c: Column) -> Column:
    """Code points of a string."""
    return F.char_length(c).cast("bigint")


def to_lowercase(c: Column) -> Column:
    return F.lower(c)


def to_uppercase(c: Column) -> Column:
    return F.upper(c)


def is_between(c: Column, low: Any, high: Any, closed: str = "both") -> Column:
    """Whether a value lies in a range with the bounds included or not: both, left, right, none."""
    if closed not in ("both", "left", "right", "none"):
        raise ValueError("`closed` must be one of: 'both', 'left', 'right', 'none'")
    return (c >= low if closed in ("both", "left") else c > low) & (c <= high if closed in ("both", "right") else c < high)


def is_in(c: Column, values: list, nulls_equal: bool = False) -> Column:
    """Whether a value is one of some; a null is one of them only with nulls_equal and a null among them."""
    known = [v for v in values if v is not None]
    found = c.isin(known) if known else F.when(c.isNotNull(), F.lit(False))
    if nulls_equal:
        return F.coalesce(found, F.lit(len(known) < len(values)))
    return found


def eq_missing(a: Column, b: Any) -> Column:
    """Equality that holds for two nulls and is never null."""
    return a.eqNullSafe(b)


def ne_missing(a: Column, b: Any) -> Column:
    return ~a.eqNullSafe(b)


def is_finite(c: Column) -> Column:
    """Neither NaN nor infinite; null for null only."""
    return F.when(c.isNotNull(), ~F.isnan(c) & (F.abs(c) < float("inf")))


def field(c: Column, *names: str) -> Column:
    """A field of a struct, nested by further names; null where the struct is."""
    for n in names:
        c = c.getField(n)
    return c
