"""Task objects as people write them in property files: JSON, or JSON with bare or single-quoted names and values,
trailing commas, and lines continued by a backslash."""

from __future__ import annotations

import re

_TOKEN = re.compile(r"""(?P<space>(?:\s|\\\r?\n|\\$)+)|(?P<mark>[{}\[\],:])|(?P<text>"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(?P<bare>[^\s{}\[\],:"'\\]+)""", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f", "\n": ""}


class _Reader:
    def __init__(self, text: str):
        self.text, self.tokens, at = text, [], 0
        while at < len(text):
            m = _TOKEN.match(text, at)
            if m is None:
                self.fail(at, "a name, a value or one of { } [ ] , : should stand here")
            if m.lastgroup != "space":
                self.tokens.append((m.lastgroup, m.group(), at))
            at = m.end()
        self.tokens.append(("end", "", len(text)))
        self.next = 0

    def fail(self, at: int, what: str):
        line = self.text.count("\n", 0, at) + 1
        raise ValueError(f"task parameters, line {line}, column {at - self.text.rfind(chr(10), 0, at)}: {what}")

    def take(self, *marks: str) -> str | None:
        """The next token if it is one of ``marks``."""
        kind, token, _ = self.tokens[self.next]
        if kind == "mark" and token in marks:
            self.next += 1
            return token
        return None

    def need(self, mark: str) -> None:
        if not self.take(mark):
            self.fail(self.tokens[self.next][2], f"{mark} expected")

    def word(self) -> tuple[str, str]:
        kind, token, at = self.tokens[self.next]
        if kind not in ("text", "bare"):
            self.fail(at, "a name or a value expected")
        self.next += 1
        if kind == "bare":
            return kind, token
        return kind, re.sub(r"\\(u[0-9a-fA-F]{4}|.)", lambda m: chr(int(m[1][1:], 16)) if len(m[1]) == 5 else _ESCAPES.get(m[1], m[1]),
                            token[1:-1], flags=re.S)

    def value(self):
        if self.take("["):
            return self.items("]", self.value)
        if self.take("{"):
            return self.object()
        kind, word = self.word()
        if kind == "text":
            return word
        if word in ("null", "true", "false"):
            return {"null": None, "true": True, "false": False}[word]
        return int(word) if re.fullmatch(r"[+-]?\d+", word) else word

    def items(self, end: str, one) -> list:
        out = []
        while not self.take(end):
            out.append(one())
            if not self.take(","):
                self.need(end)
                break
        return out

    def object(self) -> dict:
        out: dict = {}

        def pair():
            at = self.tokens[self.next][2]
            _, name = self.word()
            if name in out:
                self.fail(at, f"{name} is given twice")
            self.need(":")
            out[name] = self.value()

        self.items("}", pair)
        return out


def read_object(text: str) -> dict:
    """The object that ``text`` holds; ``ValueError`` with line and column if it holds something else."""
    reader = _Reader(text)
    reader.need("{")
    out = reader.object()
    if reader.tokens[reader.next][0] != "end":
        reader.fail(reader.tokens[reader.next][2], "nothing should follow the object")
    return out
