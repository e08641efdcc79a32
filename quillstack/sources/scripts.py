"""Data in script replies: the arguments of calls, as JSON.

A reply is read by tokens, so what stands in strings or comments is never taken for syntax. Values are
literals in either quotes, with their escapes, numbers of all notations, arrays with gaps, objects with bare keys,
``new Date(n)``, which is n, and calls, which are their name and arguments.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TOKEN = re.compile(
    r"""(?P<skip>\s+|//[^\n]*|/\*.*?\*/)|(?P<string>"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*'|`(?:[^`\\]|\\.)*`)"""
    r"""|(?P<number>0[xX][0-9a-fA-F]+|(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)|(?P<name>[A-Za-z_$][\w$]*(?:\.[A-Za-z_$][\w$]*)*)|(?P<mark>.)""",
    re.S,
)
_ESCAPE = re.compile(r"\\(u\{[0-9a-fA-F]+\}|u[0-9a-fA-F]{4}|x[0-9a-fA-F]{2}|\r\n|.)", re.S)
#: Escapes of one letter, names that are values, and words before brackets that are no calls.
_LETTERS = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f", "v": "\v", "0": "\0", "\n": "", "\r\n": "", "\u2028": "", "\u2029": ""}
_VALUES = {"null": None, "undefined": None, "NaN": None, "Infinity": None, "true": True, "false": False}
_NO_CALLS = frozenset("function if for while switch catch return throw typeof with".split())
_DEEPEST = 200


class _Broken(ValueError):
    pass


def _text(quoted: str) -> str:
    def one(m):
        x = m[1]
        if x[0] in "ux" and len(x) > 1:
            code = int(x[1:].strip("{}"), 16)
            return chr(code) if code < 0x110000 else "\ufffd"
        return _LETTERS.get(x, x)

    whole = _ESCAPE.sub(one, quoted[1:-1])
    # two halves of a character above the first plane become one; a half alone has no UTF-8
    return whole.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


class _Reader:
    def __init__(self, text: str):
        self.tokens = [(m.lastgroup, m[0]) for m in _TOKEN.finditer(text) if m.lastgroup != "skip"]
        self.at = 0

    def peek(self, k: int = 0) -> tuple[str, str]:
        return self.tokens[self.at + k] if self.at + k < len(self.tokens) else ("end", "")

    def mark(self, text: str) -> bool:
        """Whether this mark comes next; it is taken if so."""
        if self.peek() == ("mark", text):
            self.at += 1
            return True
        return False

    def listed(self, close: str, depth: int) -> list:
        out = []
        while not self.mark(close):
            if self.mark(","):
                out.append(None)  # a gap
                continue
            out.append(self.value(depth))
            if not self.mark(",") and self.peek() != ("mark", close):
                raise _Broken
        return out

    def object(self, depth: int) -> dict:
        out = {}
        while not self.mark("}"):
            kind, key = self.peek()
            if kind not in ("string", "name", "number"):
                raise _Broken
            self.at += 1
            if not self.mark(":"):
                raise _Broken
            out[_text(key) if kind == "string" else key] = self.value(depth)
            if not self.mark(",") and self.peek() != ("mark", "}"):
                raise _Broken
        return out

    def value(self, depth: int = 0):
        if depth > _DEEPEST:
            raise _Broken
        kind, text = self.peek()
        self.at += 1
        if kind == "string":
            whole = _text(text)
            while self.peek() == ("mark", "+") and self.peek(1)[0] == "string":
                whole += _text(self.peek(1)[1])
                self.at += 2
            return whole
        if kind == "number":
            if text[:2] in ("0x", "0X"):
                return int(text, 16)
            return int(text) if text.isdigit() else float(text)
        if kind == "mark" and text in "+-!":
            inner = self.value(depth + 1)
            if text == "!":
                return not inner
            if isinstance(inner, bool) or not isinstance(inner, int | float):
                raise _Broken
            return -inner if text == "-" else inner
        if kind == "mark" and text == "[":
            return self.listed("]", depth + 1)
        if kind == "mark" and text == "{":
            return self.object(depth + 1)
        if kind == "mark" and text == "(":
            inner = self.value(depth + 1)
            if not self.mark(")"):
                raise _Broken
            return inner
        if kind != "name":
            raise _Broken
        if text == "new":
            name = self.peek()[1]
            self.at += 1
            made = self.listed(")", depth + 1) if self.mark("(") else []
            return made[0] if name == "Date" and len(made) == 1 else [name, made]
        if text in _VALUES:
            return _VALUES[text]
        return [text, self.listed(")", depth + 1)] if self.mark("(") else text

    def call(self, callee: str | None) -> list | None:
        """The arguments of the first call, or of the first to a name or to a method of that name."""
        for k in range(len(self.tokens) - 1):
            (kind, name), after = self.tokens[k], self.tokens[k + 1]
            if kind == "name" and after == ("mark", "(") and name not in _NO_CALLS and (callee is None or callee in (name, name.rpartition(".")[2])):
                self.at = k + 2
                return self.listed(")", 1)
        return None


def _json(value) -> str | None:
    return json.dumps(value, ensure_ascii=False, allow_nan=False).replace("\x00", "\\u0000")


def _data(text: str) -> str | None:
    """The last argument of the reply's call, or the literal that it is or assigns."""
    reader = _Reader(text)
    for k, token in enumerate(reader.tokens):
        if token[0] == "mark" and token[1] in "[{":
            reader.at = k
            return _json(reader.value())
        if token == ("mark", "("):
            break
    arguments = reader.call(None)
    return _json(arguments[-1]) if arguments else None


@F.udf(T.StringType(), useArrow=True)
def _data_json(text):
    try:
        return None if text is None else _data(text)
    except (_Broken, ValueError, OverflowError):
        return None


def script_data(text: Column) -> Column:
    """The data of a reply such as f([...]) or x = [...] as JSON text; null if it has none or is broken."""
    return _data_json(text)


def call_arguments(text: Column, callee: str) -> Column:
    """The arguments of the first call to a function or method in a script, as a JSON array; null without one."""

    @F.udf(T.StringType(), useArrow=True)
    def found(script):
        try:
            arguments = None if script is None else _Reader(script).call(callee)
            return None if arguments is None else _json(arguments)
        except (_Broken, ValueError, OverflowError):
            return None

    return found(text)


def script_reply(text: Column, schema: str) -> Column:
    """The data of a script reply, typed."""
    return F.from_json(script_data(text), schema)


def script_variant(text: Column, callee: str | None = None) -> Column:
    """The data of a script reply, or the arguments of a call in it, as a VARIANT."""
    return F.try_parse_json(script_data(text) if callee is None else call_arguments(text, callee))
