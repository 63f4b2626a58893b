"""Split text into the pieces that byte-pair merging works on, as the public tokenizer libraries do.

The libraries follow Unicode 16, while the ``regex`` module and ``unicodedata`` follow other versions. Text without
letters or digits of a disputed version takes the module's own classes; any other text takes classes spelled out.
"""

from __future__ import annotations

import functools
import sys
import unicodedata

import regex

#: Letters and numbers that Unicode 16.0 has and 15.1 does not, as ranges of code points.
LETTERS_16 = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
    (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA),
    (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
NUMBERS_16 = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
)
#: Blanks beyond ASCII; none needs more than three bytes.
BLANKS = tuple(p for p in range(0x80, 0x10000) if chr(p).isspace())


def _ranges(letters: list[str]) -> str:
    """The body of a character class for sorted letters."""
    out: list[list[int]] = []
    for p in map(ord, letters):
        if out and out[-1][1] == p - 1:
            out[-1][1] = p
        else:
            out.append([p, p])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out)


@functools.cache
def _classes() -> tuple[str, str, str]:
    """Letters, numbers, and what the ``regex`` module classes otherwise, as bodies of character classes."""
    kinds: dict[str, set[str]] = {"L": set(), "N": set()}
    every = [chr(p) for p in range(sys.maxunicode + 1) if not 0xD800 <= p <= 0xDFFF]
    for c, kind in zip(every, map(unicodedata.category, every)):
        if kind[0] in kinds:
            kinds[kind[0]].add(c)
    for kind, more in (("L", LETTERS_16), ("N", NUMBERS_16)):
        kinds[kind].update(chr(p) for a, b in more for p in range(a, b + 1))
    odd = set()
    for kind, letters in kinds.items():
        odd |= letters ^ set(regex.findall(rf"\p{{{kind}}}", "".join(every)))
    return _ranges(sorted(kinds["L"])), _ranges(sorted(kinds["N"])), _ranges(sorted(odd))


def _spell_out(pattern: str, letters: str, numbers: str) -> str:
    """``\\p{L}`` and ``\\p{N}`` replaced by their code points, inside and outside of brackets."""
    out, inside = [], False
    for part in regex.split(r"(\\p\{[LN]\}|\\.|[\[\]])", pattern):
        if part in ("[", "]"):
            inside = part == "["
        elif part in (r"\p{L}", r"\p{N}"):
            body = letters if part == r"\p{L}" else numbers
            part = body if inside else f"[{body}]"
        out.append(part)
    return "".join(out)


class Splitter:
    """The matches of ``pattern``, which may name ``\\p{L}`` and ``\\p{N}`` and keeps a blank with what follows it."""

    def __init__(self, pattern: str) -> None:
        letters, numbers, odd = _classes()
        self._usual = regex.compile(pattern)
        self._exact = regex.compile(_spell_out(pattern, letters, numbers))
        self._odd = regex.compile(f"[{odd}]") if odd else None

    def lines(self, text: str) -> list[str] | None:
        """The lines of ``text`` if pieces can be found run by run; else none.

        Where spaces and line breaks are the only blanks and no two meet, a piece begins at every space and every
        line break, and a line break is a piece. Then splitting at those and at all blanks gives the same words.
        """
        if text.split() != text.replace("\n", " ").split(" "):
            return None
        return text.split("\n")

    def runs(self, text: str) -> list[str]:
        """Parts of ``text`` that can be split into pieces one by one; they repeat more often than whole texts do."""
        lines = self.lines(text)
        if lines is None:
            return [text]
        out: list[str] = []
        for line in lines:
            first, *rest = line.split(" ")
            out.append(first)
            out += [" " + run for run in rest]
            out.append("\n")
        out.pop()
        return out

    def odd(self, letters: set[str]) -> set[str]:
        """Those of the letters that the ``regex`` module classes otherwise."""
        return set() if self._odd is None else set(self._odd.findall("".join(letters)))

    def find(self, text: str) -> list[str]:
        if text.isascii() or not self.odd(set(text)):
            return self._usual.findall(text)
        return self._exact.findall(text)


@functools.cache
def splitter(pattern: str) -> Splitter:
    """One splitter per worker process and pattern."""
    return Splitter(pattern)
