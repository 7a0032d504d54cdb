"""A reader and writer for the part of YAML that digests, ledgers and briefs use.

Block mappings and lists, flow lists of scalars, plain, quoted and literal/folded scalars,
comments, documents parted by ---. Anchors, tags and complex keys are refused.
"""

from __future__ import annotations

import json
import re
from typing import Any

_NUMBER = re.compile(r"[-+]?(?:\d+|\d*\.\d+(?:[eE][-+]?\d+)?|\d+[eE][-+]?\d+)")
_KEY = re.compile(r"""^((?:"(?:[^"\\]|\\.)*")|(?:'(?:[^']|'')*')|[^\s#'"\[\]{}&*!|>%@`-][^#]*?|-[^\s#][^#]*?)\s*:(?:\s+|$)(.*)$""")


class YamlError(ValueError):
    pass


def scalar(s: str) -> Any:
    s = s.strip()
    if not s or s in ("~", "null", "Null", "NULL"):
        return None
    if s[0] == '"':
        return json.loads(s)
    if s[0] == "'":
        return s[1:-1].replace("''", "'")
    if s[0] == "[" and s[-1] == "]":
        return [scalar(x) for x in _split(s[1:-1])]
    if s == "{}":
        return {}
    if s[0] in "&*!{%@`":
        raise YamlError(f"not supported: {s[:40]}")
    if s in ("true", "True", "false", "False"):
        return s.lower() == "true"
    if _NUMBER.fullmatch(s):
        return float(s) if any(c in s for c in ".eE") else int(s)
    return s


def _split(s: str) -> list[str]:
    out, quote, start = [], "", 0
    for i, c in enumerate(s):
        if quote:
            quote = "" if c == quote else quote
        elif c in "\"'":
            quote = c
        elif c == ",":
            out.append(s[start:i])
            start = i + 1
    return [x for x in [*out, s[start:]] if x.strip()]


def _uncomment(line: str) -> str:
    quote = ""
    for i, c in enumerate(line):
        if quote:
            quote = "" if c == quote else quote
        elif c in "\"'" and (i == 0 or line[i - 1] in " [,:-"):
            quote = c
        elif c == "#" and (i == 0 or line[i - 1].isspace()):
            return line[:i].rstrip()
    return line.rstrip()


class _Lines:
    def __init__(self, text: str) -> None:
        self.raw = text.replace("\r\n", "\n").split("\n")
        self.at = 0

    def peek(self) -> tuple[int, str] | None:
        """Indent and content of the next line with content."""
        while self.at < len(self.raw):
            line = _uncomment(self.raw[self.at])
            if line.strip():
                return len(line) - len(line.lstrip(" ")), line.strip()
            self.at += 1
        return None

    def literal(self, parent: int, fold: bool, keep: bool) -> str:
        rows: list[str] = []
        while self.at < len(self.raw):
            line = self.raw[self.at]
            if line.strip() and len(line) - len(line.lstrip(" ")) <= parent:
                break
            rows.append(line)
            self.at += 1
        while rows and not rows[-1].strip():
            rows.pop()
        cut = min((len(r) - len(r.lstrip(" ")) for r in rows if r.strip()), default=0)
        text = "\n".join(r[cut:] for r in rows)
        if fold:
            text = re.sub(r"(?<!\n)\n(?!\n)", " ", text)
        return text + ("\n" if keep and text else "")


def _value(lines: _Lines, rest: str, indent: int) -> Any:
    rest = rest.strip()
    if re.fullmatch(r"[|>][-+]?", rest):
        return lines.literal(indent, rest[0] == ">", not rest.endswith("-"))
    if rest:
        while rest[0] in "\"'" and not _closed(rest) and lines.at < len(lines.raw):  # a quoted scalar over lines
            rest += " " + lines.raw[lines.at].strip()
            lines.at += 1
        return scalar(rest)
    nxt = lines.peek()
    if nxt and (nxt[0] > indent or (nxt[0] == indent and nxt[1].startswith("- "))):
        return _block(lines, nxt[0])
    return None


def _closed(s: str) -> bool:
    return bool(re.fullmatch(r'"(?:[^"\\]|\\.)*"|\'(?:[^\']|\'\')*\'', s.strip(), re.S))


def _block(lines: _Lines, indent: int) -> Any:
    first = lines.peek()
    if first and (first[1] == "-" or first[1].startswith("- ")):
        out: list = []
        while (n := lines.peek()) and n[0] == indent and (n[1] == "-" or n[1].startswith("- ")):
            rest = n[1][1:].strip()
            if rest and _KEY.match(rest):
                # a mapping that starts on the dash's line
                shift = len(n[1]) - len(n[1][1:].lstrip())
                lines.raw[lines.at] = " " * (indent + shift) + rest
                out.append(_block(lines, indent + shift))
            else:
                lines.at += 1
                out.append(_value(lines, rest, indent))
        return out
    found: dict = {}
    while (n := lines.peek()) and n[0] == indent and not n[1].startswith("- "):
        m = _KEY.match(n[1])
        if not m:
            if not found:
                lines.at += 1
                return scalar(n[1])
            raise YamlError(f"no key: {n[1][:60]}")
        lines.at += 1
        found[str(scalar(m[1]))] = _value(lines, m[2], indent)
    return found


def load(text: str) -> Any:
    """The first document."""
    docs = load_all(text)
    return docs[0] if docs else None


def load_all(text: str) -> list[Any]:
    """All documents; empty ones are left out."""
    out = []
    for part in re.split(r"(?m)^(?:---|\.\.\.)[ \t]*$", text):
        lines = _Lines(part)
        n = lines.peek()
        if n:
            out.append(_block(lines, n[0]))
            if lines.peek():
                raise YamlError(f"unexpected: {lines.peek()[1][:60]}")
    return out


def dump(value: Any, indent: int = 0) -> str:
    """value as YAML: keys in their order, strings quoted where needed, line breaks escaped."""
    pad = " " * indent
    if isinstance(value, dict):
        return "".join(f"{pad}{_word(k)}:{_under(v, indent)}" for k, v in value.items()) if value else f"{pad}{{}}\n"
    if isinstance(value, (list, tuple)):
        return "".join(f"{pad}-{_under(v, indent, True)}" for v in value) if value else f"{pad}[]\n"
    return f"{pad}{_word(value)}\n"


def _under(v: Any, indent: int, item: bool = False) -> str:
    if isinstance(v, (dict, list, tuple)) and v:
        body = dump(v, indent + 2)
        return " " + body[indent + 2 :] if item and isinstance(v, dict) else "\n" + body
    return " " + ("{}" if isinstance(v, dict) else "[]" if isinstance(v, (list, tuple)) else _word(v)) + "\n"


def _word(v: Any) -> str:
    if v is None:
        return "null"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return repr(v)
    s = str(v)
    try:
        plain = s == s.strip() and s and scalar(s) == s and s.lower() not in ("yes", "no", "on", "off", "y", "n") and not re.search(r"[\n\r\t]|: |\s#|:$", s) and s[0] not in "-?:,[]{}#&*!|>'\"%@`"
    except (YamlError, ValueError):
        plain = False
    return s if plain else json.dumps(s, ensure_ascii=False)
