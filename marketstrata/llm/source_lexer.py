"""A lexer of source and configuration syntax, and a reader of its tokens that finds which name is given which literal."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

#: Lines without any of these signs give no name a value.
_HINT = re.compile(r"[=:<(]|--")
_TOKEN = re.compile(
    r"""(?P<string>(?:(?<![A-Za-z0-9_])[bBfFrRuU]{1,2})?(?:\"\"\"(?:(?!\"\"\").)*\"\"\"|'''(?:(?!''').)*''')"""
    r"""|(?:(?<![A-Za-z0-9_])[bBfFrRuU]{1,2})?(?:(?<!\\)"(?:[^"\\\n]|\\.)*"|(?<![A-Za-z0-9\\])'(?:[^'\\\n]|\\.)*'|`[^`\n]*`)"""
    r"""|(?<![A-Za-z0-9_])[bBfFrRuU]{1,2}'(?:[^'\\\n]|\\.)*')"""
    r"""|(?P<assign>:=|=>|={1,3}|:)"""
    r"""|(?P<flag>(?<![A-Za-z0-9_\-])--?[A-Za-z][A-Za-z0-9_\-]*)"""
    r"""|(?P<word>[A-Za-z_$][A-Za-z0-9_.\-$]*)"""
    r"""|(?P<line>\n)"""
    r"""|(?P<mark>[\[\](){}<>,;+|])"""
    r"""|(?P<other>[^\s"'`\[\](){}<>,;+|=:]+)"""
    r"""|(?P<quote>["'`])""",
    re.ASCII | re.DOTALL,
)
_NAME = re.compile(r"[A-Za-z_$][A-Za-z0-9_.\-$]*\Z", re.ASCII)
_IDENTIFIER = re.compile(r"[A-Za-z_$][A-Za-z0-9_.$]*\Z", re.ASCII)
#: What may end a bare value.
_BARE = re.compile(r"""[^\s"'`,;(){}\[\]<>]+""")
_INDENT = re.compile(r"[ \t]*")
#: Calls whose first argument names the second: lookups with a default, and setters.
_GIVING = re.compile(r"(?:^|[._])(?:get|getenv|setdefault|set|put|environ|setenv|putenv|define|setProperty|getProperty)\Z", re.ASCII)


@dataclass
class Given:
    """A name, the literal it is given, and where the literal's pieces stand."""

    name: str
    value: str
    pieces: list[tuple[int, int]]


@dataclass
class Reading:
    given: list[Given] = field(default_factory=list)
    #: ``(name, source)``: the name is given what the source holds.
    aliases: list[tuple[str, str]] = field(default_factory=list)


def _content(text: str, start: int, end: int) -> tuple[int, int]:
    """Where the content of a string token stands, without prefix and quotes."""
    while text[start] not in "\"'`":
        start += 1
    wide = 3 if text[start : start + 3] in ('"' * 3, "'" * 3) and end - start >= 6 else 1
    return start + wide, end - wide


class _Reader:
    def __init__(self, text: str):
        self.text, self.out = text, Reading()
        self.kind: list[str] = []
        self.start: list[int] = []
        self.end: list[int] = []
        for m in _TOKEN.finditer(text):
            self.kind.append(m.lastgroup)
            self.start.append(m.start())
            self.end.append(m.end())

    def said(self, i: int) -> str:
        return self.text[self.start[i] : self.end[i]] if i < len(self.kind) else ""

    def is_(self, i: int, kind: str, said: str | None = None) -> bool:
        return 0 <= i < len(self.kind) and self.kind[i] == kind and (said is None or self.said(i) == said)

    def named(self, i: int) -> str | None:
        """The name that a word, a quoted key or a subscript ending at token ``i`` stands for."""
        if self.is_(i, "word") or self.is_(i, "flag"):
            return self.said(i).lstrip("-")
        if self.is_(i, "mark", "]") and self.is_(i - 1, "string") and self.is_(i - 2, "mark", "["):
            i -= 1
        if self.is_(i, "string"):
            a, b = _content(self.text, self.start[i], self.end[i])
            key = self.text[a:b]
            return key if _NAME.match(key) else None
        return None

    def skip_lines(self, i: int) -> int:
        while self.is_(i, "line"):
            i += 1
        return i

    def give(self, name: str, i: int) -> None:
        """Read the value that begins at token ``i``: strings, joined or adjacent, a name, or a bare literal."""
        inside = False
        while self.is_(i, "mark", "("):
            i, inside = self.skip_lines(i + 1), True
        if self.is_(i, "string"):
            pieces = []
            while True:
                if self.is_(i, "string"):
                    pieces.append(_content(self.text, self.start[i], self.end[i]))
                elif self.is_(i, "word") and pieces:
                    self.out.aliases.append((name, self.said(i)))
                else:
                    break
                after = self.skip_lines(i + 1) if inside else i + 1
                joined = self.is_(after, "mark", "+") or self.is_(after, "other", ".") or self.is_(after, "other", "\\")
                i = self.skip_lines(after + 1) if joined else after
                if not joined and not self.is_(i, "string"):
                    break
            self.put(name, pieces)
        elif i < len(self.kind) and self.kind[i] in ("word", "other", "flag"):
            at = self.start[i]
            bare = _BARE.match(self.text, at)
            raw, end = bare[0], bare.end()
            if self.text[end : end + 1] == "(" or self.text[end : end + 1] == "[":
                return  # what a call or a lookup returns is no literal
            if _IDENTIFIER.match(raw):
                self.out.aliases.append((name, raw))
                if not any(c.isdigit() for c in raw):
                    return  # a name, not a literal
            self.put(name, [(at, end)])

    def put(self, name: str, pieces: list[tuple[int, int]]) -> None:
        value = "".join(self.text[a:b] for a, b in pieces)
        if value:
            self.out.given.append(Given(name, value, [p for p in pieces if p[0] < p[1]]))

    def block(self, name: str, i: int) -> bool:
        """A block scalar: the lines after token ``i`` that are indented deeper than the key's line."""
        if not (self.is_(i, "mark", "|") or self.is_(i, "mark", ">")):
            return False
        after = i + 1
        if self.is_(after, "other") or self.is_(after, "mark", "+"):
            after += 1  # a chomping sign
        if not self.is_(after, "line"):
            return False
        text = self.text
        deep = _INDENT.match(text, text.rfind("\n", 0, self.start[i]) + 1)
        limit, at, pieces = deep.end() - deep.start(), self.end[after], []
        while at < len(text):
            stop = text.find("\n", at)
            stop = len(text) if stop < 0 else stop
            first = _INDENT.match(text, at).end()
            if first < stop:
                if first - at <= limit:
                    break
                pieces.append((first, len(text[:stop].rstrip()) if text[stop - 1] in " \t\r" else stop))
            at = stop + 1
        self.put(name, pieces)
        return True

    def read(self) -> Reading:
        for i, kind in enumerate(self.kind):
            if kind == "assign":
                name = self.named(i - 1)
                if name is None:
                    continue
                to = i + 1
                if self.said(i) == ":":
                    if self.block(name, to):
                        continue
                    # An annotated name: the type stands between.
                    if self.is_(to, "word") and self.is_(to + 1, "assign") and self.said(to + 1) in ("=", ":="):
                        to += 2
                self.give(name, to)
            elif kind == "flag" and i + 1 < len(self.kind) and self.start[i + 1] > self.end[i] and self.said(i).startswith("--"):
                if self.kind[i + 1] in ("string", "word", "other"):
                    self.give(self.said(i).lstrip("-"), i + 1)
            elif kind == "mark" and self.said(i) == ">" and self.is_(i - 1, "word") and self.is_(i - 2, "mark", "<"):
                close = self.text.find("<", self.end[i])
                if 0 < close and self.text.startswith(f"</{self.said(i - 1)}", close):
                    inner = self.text[self.end[i] : close]
                    a = self.end[i] + len(inner) - len(inner.lstrip())
                    self.put(self.said(i - 1), [(a, a + len(inner.strip()))])
            elif kind == "mark" and self.said(i) == "(" and self.is_(i - 1, "word") and _GIVING.search(self.said(i - 1)):
                if self.is_(i + 1, "string") and self.is_(i + 2, "mark", ",") and self.is_(i + 3, "string"):
                    name = self.named(i + 1)
                    if name:
                        self.give(name, i + 3)
        return self.out


def read_source(text: str) -> Reading:
    """Which names a text gives which literals, and which names it gives other names, in order; linear in its length.

    Understood are assignments and key-value pairs (``=``, ``:=``, ``:``, ``=>``, comparisons, annotated names),
    quoted keys, subscripts (``cfg['key'] = ...``), strings joined by a sign or side by side, block scalars, command
    line flags, elements (``<key>...</key>``), and calls that name what they are given (``getenv("KEY", "...")``).
    Comments are read like code, for what stands in them is as public. What a call or a lookup returns is no literal.
    """
    if not _HINT.search(text):
        return Reading()
    return _Reader(text).read()


def reached(aliases: list[tuple[str, str]], wanted: set[str]) -> set[str]:
    """All names whose value reaches one of the ``wanted`` through any chain of aliases; each alias is looked at once."""
    sources: dict[str, list[str]] = {}
    for name, source in aliases:
        sources.setdefault(name, []).append(source)
    seen, todo = set(wanted), list(wanted)
    while todo:
        for source in sources.get(todo.pop(), ()):
            if source not in seen:
                seen.add(source)
                todo.append(source)
    return seen
