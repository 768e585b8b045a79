"""Secret scan by assignment-aware lexing.

Fixed patterns give the base spans. Beyond them the text is read as source or
configuration syntax: a lexer yields name-literal pairs. It knows strings (also in
three quotes, over several lines, with prefixes), bare configuration values, sums and
neighbours, block scalars, lists, calls that set a name or decode a value, XML
attributes and elements, environment lists (name and value apart, bound by their mapping
or tag at any distance), passwords in URLs, anchors and aliases; the names around a pair
(brackets, indentation, sections) count beside its own. Comments are
read like the rest, as secrets are left in them too. Constants are propagated from
name to name, backwards and forwards, through sums and strings they are put into,
until nothing changes, and each literal is scored by how sensitive the names are that
it ends up in and by how random it looks. Literals that score enough and are not part
of a base span are reported as kind ``literal``.

Nulls: a null text is read as empty, a null id is returned as it is. Repeated
rows give one row each, other columns are dropped, an empty table gives an
empty result. Texts are read whole; the pairs of one text are held at a time.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, table, text_bytes

KINDS = ("assign", "access", "hex", "literal")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a run of 32 or more is matched whole, shorter ones never

_NAME = r"""(?:(?P<name>[A-Za-z_$@][\w.$\-]*+)(?:\[[ \t]*+["'](?P<key>[^"'\n]++)["'][ \t]*+\])?|(?P<q>["'])(?P<quoted>[^"'\\\n]++)(?P=q))"""
_SIGN = r"""[ \t]*+(?P<op>:=|=>|\+=|\?=|=(?![=~>])|:(?![:/]))[ \t]*+"""
#: What the lexer stops at: a new line with its indentation and list marks, a call that sets a name, a name with an assignment
#: sign, the password of a URL, an XML element with text, brackets, quotes, other names. Nothing here goes back over what it
#: has read.
SCAN = re.compile(
    r"(?P<line>\n[ \t]*+(?:-[ \t]++)*+)"
    r"""|(?P<call>(?<![\w.])[A-Za-z_][\w.]*+[ \t]*+\([ \t]*+(?P<cq>["'])(?P<cname>[A-Za-z_][\w.\-]*+)(?P=cq)[ \t]*+,[ \t]*+)"""
    rf"|(?P<pair>(?<![\w.]){_NAME}{_SIGN})"
    r"|(?P<url>://[^\s/:@\"']++:(?=[^\s/@\"']++@))"
    r"|(?P<element><(?P<ename>[A-Za-z_][\w.\-:]*+)>[ \t]*+(?P<ebody>[^<>\s][^<>\n]*+)</)"
    r"|(?P<open>[(\[{])|(?P<close>[)\]}])|(?P<quote>[\"'`])"
    r"|(?P<other>(?<![\w.])[A-Za-z_$@][\w.$\-]*+)"  # a name without a sign: no part of it has one either
)
PAIR = re.compile(_NAME + _SIGN)
BEGIN = re.compile(r"[ \t]*+(?:-[ \t]++)*+")
SECTION = re.compile(r"[ \t]*+\[\[?[ \t]*+([^\[\]\n=,\"']++)\]\]?[ \t]*+(?=\n|$)")
#: A string with its prefix: in three quotes, in one (not an apostrophe), or in backquotes.
STRING = re.compile(r"""(?s)[fFrRbBuU]{0,2}(?:"{3}(?P<d3>.*?)"{3}|'{3}(?P<s3>.*?)'{3}|"(?P<dq>(?:[^"\\\n]|\\.)*+)"|(?<!\w)'(?P<sq>(?:[^'\\\n]|\\.)*+)'(?!\w)|`(?P<bq>[^`]*+)`)""")
PREFIXED = re.compile(r"""[fFrRbBuU]{1,2}["']""")
BARE = re.compile(r"""[^\s"'`,;()\[\]{}<>|\\]++""")
JOIN = re.compile(r"""[ \t]*+(?:[+.&]|\\\n)[ \t\n]*+(?=["'`A-Za-z_])|[ \t]++(?=["'])""")
EMPTY = re.compile(r"[ \t]*+(?:#[^\n]*+)?(?=\n|$)")
SCALAR = re.compile(r"[|>][+\-0-9]*+[ \t]*+\n")
ANNOTATED = re.compile(r"[ \t]*+=(?![=~>])[ \t]*+")
INSERTED = re.compile(r"\$?\{([A-Za-z_][\w.]*+)\}|\$([A-Za-z_]\w*+)")
SPACES = re.compile(r"\s*+")
#: What ends the tag or statement that a label set by = belongs to.
ENDED = re.compile(r"[>;]|\n[ \t]*+\n")
MARK = re.compile(r"[&*][A-Za-z_][\w\-]*+")
SCHEMES = {"bearer", "basic", "token", "digest"}
#: Functions whose string arguments are the value itself.
DECODERS = {"str", "bytes", "bytearray", "string", "decode", "b64decode", "base64", "atob", "unhex", "fromhex", "encode", "secretstr", "buffer", "from", "join"}
LABELS, VALUES = {"key", "name"}, {"value", "default", "content"}
NAME_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
IDENTIFIER = re.compile(r"[A-Za-z_$][A-Za-z0-9_.]*\Z")
ENV_NAME = re.compile(r"[A-Z][A-Z_]*\Z")
PLACEHOLDER = re.compile(r"(?i)^(?:<.*>|\$\{?.*|x+|\*+|your.*|change.?me|example.*|placeholder.*|none|null|true|false|todo)$")
#: How sensitive a part of a name is.
WEIGHTS = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "secrets": 1.0,
    "token": 0.9, "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "bearer": 0.9, "auth": 0.6,
    "authorization": 0.8, "signature": 0.6, "salt": 0.6, "cert": 0.5, "key": 0.4, "access": 0.3,
    "private": 0.5, "api": 0.3, "client": 0.2, "session": 0.3, "encryption": 0.4, "signing": 0.4,
}
#: What the names around a name count beside it.
NESTED = 0.8
THRESHOLD = 0.55
#: Of the names around a literal so many innermost ones are reported.
PATH_NAMES = 32
MIN_LITERAL = 8


class Span(NamedTuple):
    start: int
    end: int
    kind: str


@dataclass(slots=True)
class Scope:
    """A name inside others. Its score needs only the fixed words met on the way, so a scope costs the same at any depth."""

    name: str
    parent: Scope | None
    words: frozenset[str]
    last: str

    def path(self) -> str:
        names, at = [], self
        while at is not None and len(names) < PATH_NAMES:
            names.append(at.name)
            at = at.parent
        return ".".join(reversed(names))


def inside(parent: Scope | None, name: str) -> Scope:
    parts = name_parts(name)
    if not parts:
        return Scope(name, parent, parent.words if parent else frozenset(), parent.last if parent else "")
    fresh = sensitive_words(name)
    if parent is None:
        return Scope(name, None, fresh, parts[-1])
    across = parent.last + parts[0]
    if across in WEIGHTS:
        fresh = fresh | {across}
    return Scope(name, parent, parent.words if fresh <= parent.words else parent.words | fresh, parts[-1])


@dataclass(slots=True)
class Bracket:
    """An open bracket: the scope inside, the name whose elements are collected ("": none), the label of a value to come."""

    scope: Scope | None
    collects: str = ""
    label: str = ""


@dataclass(slots=True)
class Pair:
    """A name (with the names around it) and what is assigned to it: spans of literals, and words that may be names or literals."""

    name: str
    scope: Scope
    literals: list[tuple[int, int]]
    words: list[tuple[int, int]]
    names: list[str]  # surely names: aliases, and what is put into strings
    op: str = "="


def base_spans(text: str) -> list[Span]:
    found = [Span(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    found += [Span(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    return found + [Span(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


class Lexer:
    """Reads a text as source or configuration: pairs by their signs, nested by brackets, indentation and sections."""

    def __init__(self, text: str):
        self.text = text
        self.pairs: list[Pair] = []
        self.brackets: list[Bracket] = []
        self.indents: list[tuple[int, Scope]] = []
        self.section: Scope | None = None
        self.indent = 0
        self.labels: list[tuple[int, str]] = []  # of mappings by indentation
        self.attribute: tuple[int, str] = (-1, "")  # a label set by =, and where it ends
        self.element: tuple[int, str] = (-1, "")  # a label that is an XML element

    def around(self) -> Scope | None:
        if self.brackets:
            return self.brackets[-1].scope
        return self.indents[-1][1] if self.indents else self.section

    def add(self, name: str, literals, words=(), names=(), op: str = "=", scope: Scope | None = None) -> None:
        self.pairs.append(Pair(name, scope or inside(self.around(), name), list(literals), list(words), list(names), op))

    def run(self) -> list[Pair]:
        text, at = self.text, self.line(0, BEGIN.match(self.text).end())
        while m := SCAN.search(text, at):
            at = m.end()
            kind = m.lastgroup if m.lastgroup in ("line", "call", "pair", "url", "element", "open", "close", "quote", "other") else "pair"
            if m["line"] is not None:
                at = self.line(m.start() + 1, at)
            elif m["call"] is not None:
                at = self.assigned(m["cname"], ",", at)
            elif m["pair"] is not None:
                at = self.assigned(m["key"] or m["name"] or m["quoted"], m["op"], at)
            elif m["url"] is not None:
                end = text.index("@", at)
                self.add("url_password", [(at, end)])
                at = end
            elif m["element"] is not None:
                at = self.tagged(m)
            elif m["other"] is not None:
                if text.startswith("(", at) and (cut := max(m[0].rfind("-"), m[0].rfind("$"))) >= 0:
                    at = m.start() + cut + 1  # what is called may be the last part alone
            elif kind == "open":
                self.brackets.append(Bracket(self.around()))
            elif kind == "close":
                if self.brackets:
                    self.brackets.pop()
            else:
                at = self.quoted(m.start())
        return self.pairs

    def tagged(self, m: re.Match) -> int:
        """An XML element with text; a value element belongs to the name element just before."""
        a, b = m.span("ebody")
        while self.text[b - 1] in " \t":
            b -= 1
        name, end = m["ename"], self.text.find(">", m.end())
        end = m.end() if end < 0 else end + 1
        if name.lower() in LABELS:
            self.element = (end, self.text[a:b])
        elif name.lower() in VALUES and self.element[0] >= 0 and SPACES.fullmatch(self.text, self.element[0], m.start()):
            name = self.element[1]
        self.add(name, [(a, b)])
        return m.end()

    def label_of(self, op: str, at: int) -> str:
        """The label that a value at this place belongs to, once: that of its bracket, its mapping by indentation, or its tag."""
        if self.brackets:
            label, self.brackets[-1].label = self.brackets[-1].label, ""
        elif op == ":":
            label = self.labels.pop()[1] if self.labels and self.labels[-1][0] == self.indent else ""
        else:
            (end, label), self.attribute = self.attribute, (-1, "")
            label = label if end >= 0 and not ENDED.search(self.text, end, at) else ""
        return label

    def set_label(self, op: str, end: int, label: str) -> None:
        if self.brackets:
            self.brackets[-1].label = label
        elif op == ":":
            if self.labels and self.labels[-1][0] == self.indent:
                self.labels.pop()
            self.labels.append((self.indent, label))
        else:
            self.attribute = (end, label)

    def line(self, start: int, at: int) -> int:
        """A new line: leave what it is not inside of; a list item belongs to the name above."""
        if self.brackets:
            return at
        self.indent = at - start
        while self.indents and self.indents[-1][0] >= self.indent:
            self.indents.pop()
        item = "-" in self.text[start:at]
        if self.text[at : at + 1] not in ("", "\n"):
            while self.labels and (self.labels[-1][0] > self.indent or (item and self.labels[-1][0] == self.indent)):
                self.labels.pop()
        if section := SECTION.match(self.text, start):
            self.section, self.indents = inside(None, section[1].strip()), []
            return section.end()
        if self.text[start:at].endswith((" ", "\t")) and item and self.indents and not PAIR.match(self.text, at):
            scope = self.indents[-1][1]
            literals, words, names, at, _ = self.value(at, ":")
            self.add(scope.name, literals, words, names, ":", scope)
        return at

    def quoted(self, start: int) -> int:
        """A string by itself: an element of what is collected; quoted configuration is read on inside."""
        while start and self.text[start - 1] in "fFrRbBuU" and PREFIXED.match(self.text, start - 1):
            start -= 1
        m = STRING.match(self.text, start)
        if not m:
            return start + 1 if self.text[start] in "\"'`" else start + 2
        if self.brackets and self.brackets[-1].collects:
            own = self.brackets[-1]
            self.add(own.collects, self.pieces(m), (), self.inserted(m), scope=own.scope)
        elif '":' in m[0] or "':" in m[0]:
            return start + 1
        return m.end()

    def assigned(self, name: str, op: str, at: int) -> int:
        """What stands behind an assignment sign."""
        text = self.text
        scope = inside(self.around(), name)
        if op == ":" and not self.brackets and EMPTY.match(text, at):
            self.indents.append((self.indent, scope))
            return at
        if op == ":" and (m := SCALAR.match(text, at)):
            end, literals = m.end(), []
            while end < len(text):  # the lines that stand further in
                stop = text.find("\n", end)
                stop = len(text) if stop < 0 else stop
                body = text[end:stop]
                if body.strip() and len(body) - len(body.lstrip(" \t")) <= self.indent:
                    break
                if body.strip():
                    literals.append((end + len(body) - len(body.lstrip()), end + len(body.rstrip())))
                end = stop + 1
            self.add(name, literals, op=op)
            return max(at, min(end, len(text)) - 1)
        literals, words, names, end, opened = self.value(at, op)
        lower = name.lower()
        if lower in LABELS and len(literals) + len(words) == 1:
            a, b = (literals or words)[0]
            self.set_label(op, end, text[a:b])
        elif lower in VALUES and (label := self.label_of(op, at)):
            name, scope = label, inside(self.around(), label)
        if literals or words or names:
            self.add(name, literals, words, names, op, scope)
        if opened:
            self.brackets.append(Bracket(scope, name if opened in "([" else ""))
        return end

    def value(self, at: int, op: str) -> tuple[list, list, list, int, str]:
        """Literals, words, names and end of an expression; a bracket that it opens, or "" (call arguments count if they are decoded)."""
        text, literals, words, names, marks = self.text, [], [], [], []

        def told(end: int, opened: str = "") -> tuple[list, list, list, int, str]:
            if not marks:
                return literals, words, names, end, opened
            for mark, inner in zip(marks, marks[1:], strict=False):  # anchors before anchors stand for what comes
                self.add(mark, [], [], [inner], op)
            self.add(marks[-1], literals, words, names, op)
            return literals, words, [*names, marks[0]], end, opened

        while at < len(text):
            if m := STRING.match(text, at):
                literals += self.pieces(m)
                names += self.inserted(m)
                at = m.end()
            elif text[at] in "([{":
                return told(at + 1, text[at])
            elif op == ":" and (m := MARK.match(text, at)):
                at = m.end()
                if m[0][0] == "*":
                    names.append(m[0][1:])
                    break
                while at < len(text) and text[at] in " \t":
                    at += 1
                marks.append(m[0][1:])
                continue
            elif m := BARE.match(text, at):
                at = m.end()
                if text[at : at + 1] == "(":
                    known = m[0].rsplit(".", 1)[-1].lower() in DECODERS
                    return told(at + 1 if known else at, "(" if known else "")
                if m[0].lower() in SCHEMES:
                    spaces = re.compile(r"[ \t]++").match(text, at)
                    if spaces and (more := BARE.match(text, spaces.end())):
                        words.append(more.span())
                        at = more.end()
                    break
                if op == ":" and (typed := ANNOTATED.match(text, at)):
                    at, op = typed.end(), "="
                    continue
                words.append(m.span())
            else:
                break
            joined = JOIN.match(text, at)
            if not joined or (op == ":" and words and not literals):
                break
            at = joined.end()
        return told(at)

    def pieces(self, m: re.Match) -> list[tuple[int, int]]:
        """The span of a string's content; of one with several lines, of each line."""
        a, b = next(m.span(k) for k in ("d3", "s3", "dq", "sq", "bq") if m[k] is not None)
        body = self.text[a:b]
        if "\n" not in body:
            return [(a, b)]
        out = []
        for line in re.finditer(r"[^\n]+", body):
            inner = line[0].strip()
            if inner:
                begin = a + line.start() + line[0].index(inner)
                out.append((begin, begin + len(inner)))
        return out

    def inserted(self, m: re.Match) -> list[str]:
        return [x[1] or x[2] for x in INSERTED.finditer(m[0])] if "{" in m[0] or "$" in m[0] else []


def lex(text: str) -> list[Pair]:
    """Name-literal pairs in the order of the text."""
    return Lexer(text).run()


@lru_cache(maxsize=100_000)
def name_parts(name: str) -> tuple[str, ...]:
    return tuple(x.lower() for x in NAME_PART.findall(name))


@lru_cache(maxsize=100_000)
def sensitive_words(name: str) -> frozenset[str]:
    """The fixed words that are parts of a name, or two neighbouring parts of it."""
    parts = name_parts(name)
    return frozenset(x for x in (*parts, *(a + b for a, b in zip(parts, parts[1:], strict=False))) if x in WEIGHTS)


def name_score(words: frozenset[str]) -> float:
    return min(1.0, sum(WEIGHTS[x] for x in sorted(words)))


def literal_score(value: str) -> float:
    """0 to 1: length, entropy and mixture of classes; 0 for placeholders and prose."""
    if len(value) < MIN_LITERAL or PLACEHOLDER.match(value) or ENV_NAME.match(value) or re.search(r"\s", value):
        return 0.0
    n = len(value)
    entropy = -sum(k / n * math.log2(k / n) for k in Counter(value).values())
    classes = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return min(1.0, entropy / 4) * (0.5 if classes < 2 else 1.0)


def assigned_spans(text: str) -> list[tuple[Span, str, float]]:
    """Literals with the most sensitive name they reach and their score.

    A word is a name if it looks like one and something is assigned to it; it stands for the last assignment before, or
    else the first one behind. Constants go from name to name until nothing changes: pairs are visited from the most
    sensitive name down, so each is visited once, with the greatest weight that reaches it."""
    pairs = lex(text)
    where: dict[str, list[int]] = defaultdict(list)
    for i, pair in enumerate(pairs):
        where[pair.name].append(i)
        if "." in pair.name:
            where[pair.name.rsplit(".", 1)[-1]].append(i)

    def resolve(name: str, i: int) -> int | None:
        for key in (name, name.rsplit(".", 1)[-1]):
            if own := where.get(key):
                at = bisect_left(own, i)
                if at:
                    return own[at - 1]
                return next((j for j in own if j > i), None)
        return None

    literals: list[list[tuple[int, int]]] = []
    others: list[list[int]] = []
    for i, pair in enumerate(pairs):
        held, names = list(pair.literals), list(pair.names)
        for a, b in pair.words:
            parts = text[a:b].split("+")
            if all(IDENTIFIER.match(x) and resolve(x, i) is not None for x in parts):
                names += parts
            elif not IDENTIFIER.match(text[a:b]) or pair.op == ":" or re.search(r"\d", text[a:b]):
                held.append((a, b))
        if pair.op == "+=":
            names.append(pair.name)
        literals.append(held)
        others.append([j for j in (resolve(n, i) for n in names) if j is not None and j != i])
    weights = [max(name_score(sensitive_words(p.name)), NESTED * name_score(p.scope.words)) for p in pairs]
    seen, best = [False] * len(pairs), {}
    for i in sorted(range(len(pairs)), key=lambda i: -weights[i]):
        if not weights[i]:
            break
        todo = [i]
        while todo:
            j = todo.pop()
            if seen[j]:
                continue
            seen[j] = True
            for span in literals[j]:
                score = weights[i] * literal_score(text[span[0] : span[1]])
                if score > best.get(span, (0.0, 0))[0]:
                    best[span] = (score, i)
            todo += others[j]
    return [(Span(*s, "literal"), pairs[i].scope.path(), x) for s, (x, i) in best.items() if x >= THRESHOLD]


def scan_text(text: str) -> tuple[list[Span], list[tuple[Span, str, float]]]:
    """The base spans, and what the method adds outside them, each by start and kind."""
    base = sorted(base_spans(text), key=lambda s: (s.start, KINDS.index(s.kind)))
    added = []
    if "=" in text or ":" in text or "('" in text or '("' in text:
        for span, name, score in assigned_spans(text):
            if not any(b.start < span.end and span.start < b.end for b in base):
                added.append((span, name, score))
    return base, sorted(added)


def scan_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row: its spans (code points, end exclusive) with kind, text, target name and score."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            rows = []
            for body in batch.column("body").to_pylist():
                text = (body or b"").decode("utf-8", "replace")
                base, added = scan_text(text)
                found = [(s, None, None) for s in base] + added
                found.sort(key=lambda x: (x[0].start, KINDS.index(x[0].kind)))
                rows.append([{"kind": s.kind, "start": s.start, "end": s.end, "value": text[s.start : s.end], "target": n, "score": x} for s, n, x in found])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, SPANS)], ["doc_id", "found"])

    return text_bytes(df, id_col, text_col).mapInArrow(kernel, "doc_id long, found array<struct<kind:string,start:int,end:int,value:string,target:string,score:double>>")


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string()), ("target", pa.string()), ("score", pa.float64())]))


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    kind = lambda *names: F.filter("found", lambda s: s["kind"].isin(*names))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda name: F.size(kind(name)).cast("long")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(joined(kind("assign", "access", "hex")), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
        count("literal").alias("n_literal"),
    )
