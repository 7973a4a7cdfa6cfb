"""Secret scans by assignment-aware lexing.

Three base patterns give the spans that always count.  On top of them a small
lexer reads source and configuration syntax into (name, literal) pairs:
``name = "..."``, ``name: value``, ``"name": "..."``, ``name => '...'``,
``export NAME=value``, ``name="a" + "b"`` and ``<name>value</name>``.  Names
bound to literals are propagated to later names that refer to them, and each
literal is scored by the names it reaches: a literal that looks random and
flows into a sensitive name is a secret, wherever it was first written.  Blanks,
names, values and the number of literals a name holds have no upper bound; a
literal ends with its line.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "literal")
# Fixed patterns of the base kinds.  re.ASCII keeps "either case" to ASCII letters.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

#: Words in a name that mark what it holds, with the weight each gives its literal.
SENSITIVE = {"password": 3.0, "passwd": 3.0, "pwd": 3.0, "passphrase": 3.0, "secret": 3.0, "token": 2.5, "apikey": 3.0,
             "credential": 2.5, "credentials": 2.5, "auth": 1.5, "bearer": 2.5, "signature": 1.5, "private": 1.5,
             "access": 1.0, "key": 1.5, "salt": 1.0, "session": 1.0}
#: Literals that stand for a value rather than being one.
PLACEHOLDERS = {"none", "null", "true", "false", "changeme", "example", "placeholder", "password", "secret", "token"}
THRESHOLD = 4.0
#: First characters of a value that tell whether it is a placeholder.
HEAD = max(map(len, PLACEHOLDERS))

# One statement: a name (quoted in JSON), a binding sign, then operands.  What follows a
# possessive part is never one of its own characters, and a word ends at a binding sign (but
# for base64 padding), so every match stays linear and no two operands read the same text again.
BINDING = re.compile(r"""
    (?<![\w.$-]) (?P<q>["']?) (?P<name>[A-Za-z_$][\w.$-]*+) (?P=q) [\x20\t]*+
    (?: := | => | = (?![=~]) | : (?![:/]) ) [\x20\t]*+
""", re.VERBOSE | re.ASCII)
TAG = re.compile(r"<(?P<name>[A-Za-z_][\w.-]*+)>(?P<value>[^<>\x00-\x1f]{6,}+)</(?P=name)>", re.ASCII)
OPERAND = re.compile(r"""
    "(?P<double>[^"\\\n]*(?:\\.[^"\\\n]*)*)" | '(?P<single>[^'\\\n]*(?:\\.[^'\\\n]*)*)'
  | \$?\{?(?P<word>[A-Za-z0-9_$][\w.$+/-]*+(?:={1,2}(?![\w.$+/=-]))?)\}?
""", re.VERBOSE | re.ASCII)
PLUS = re.compile(r"[\x20\t]*+(?:[+.][\x20\t]*+)?\+[\x20\t]*+", re.ASCII)
SPLIT = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z0-9])(?=[A-Z])")


def name_score(name: str) -> float:
    words = [w.lower() for w in SPLIT.split(name) if w]
    joined = {a + b for a, b in zip(words, words[1:], strict=False)}
    return max([SENSITIVE.get(w, 0.0) for w in (*words, *joined)], default=0.0)


def literal_score(value: str) -> float:
    """How much a literal looks like key material: bits per character, classes mixed, no spaces."""
    return chars_score(Counter(value), len(value), value[:HEAD])


def chars_score(chars: Counter[str], n: int, head: str) -> float:
    """``literal_score`` of a value known by its characters' counts, its length and its first characters."""
    if n < 6 or " " in chars or n <= HEAD and head.lower() in PLACEHOLDERS or head.startswith(("${", "{{", "<")):
        return -10.0
    entropy = -sum(c / n * math.log2(c / n) for c in chars.values())
    classes = sum(any(f(c) for c in chars) for f in (str.isdigit, str.islower, str.isupper))
    return min(entropy, 4.5) / 1.5 + (0.5 if classes > 1 else 0.0) + (0.5 if n >= 16 else 0.0)


class Value:
    """What a name holds after one binding: its own literals, then the values it
    refers to.  Kept as character counts, so its size does not grow with them."""

    def __init__(self, binding: int, own: str, parts: list[Value]):
        self.binding, self.own, self.parts = binding, own, [p.binding for p in parts]
        self.n = len(own) + sum(p.n for p in parts)
        self.head = (own[:HEAD] + "".join(p.head for p in parts))[:HEAD]
        self._chars: Counter[str] | None = None
        if parts:
            for p in parts:
                self.chars().update(p.chars())

    def chars(self) -> Counter[str]:
        if self._chars is None:
            self._chars = Counter(self.own)
        return self._chars


def lex(text: str) -> list[tuple[str, list[tuple[int, int, str]], list[str]]]:
    """(name, literal pieces as (start, end, value), names referred to) per binding, in order."""
    out = []
    for m in BINDING.finditer(text):
        literals, refs, at = [], [], m.end()
        while (o := OPERAND.match(text, at)) is not None:
            if (word := o["word"]) is None:
                g = "double" if o["double"] is not None else "single"
                literals.append((o.start(g), o.end(g), o[g]))
            else:
                refs.append(word)
                literals.append((o.start("word"), o.end("word"), word))
            at = o.end()
            if (p := PLUS.match(text, at)) is None:
                break
            at = p.end()
        if literals:
            out.append((m["name"], literals, refs))
    out += [(m["name"], [(m.start("value"), m.end("value"), m["value"])], []) for m in TAG.finditer(text)]
    return out


def flagged_literals(text: str) -> list[tuple[int, int]]:
    """Spans of literals whose value and the names they reach score as a secret."""
    bindings = lex(text)
    if not bindings:
        return []
    # constants: what each name holds, following references to earlier bindings
    holds: dict[str, Value] = {}
    at: list[list[tuple[int, int]]] = []  # per binding: where its own literals are, the bindings it refers to, its value
    parts: list[list[int]] = []
    length: list[int] = []
    looks: list[str | float] = []  # a value's text, or its score where it is put together
    for i, (name, literals, refs) in enumerate(bindings):
        referred = set(refs)
        mine = [x for x in literals if x[2] not in holds or x[2] not in referred]
        value = Value(i, "".join(v for _, _, v in mine), [holds[r] for r in refs if r in holds])
        at.append([(a, b) for a, b, _ in mine])
        parts.append(value.parts)
        length.append(value.n)
        looks.append(chars_score(value.chars(), value.n, value.head) if value.parts else value.own)
        holds[name] = holds[name.rsplit(".", 1)[-1]] = value
    # later bindings pass their name's score and the longest value down to all they refer to
    score = [name_score(name) for name, _, _ in bindings]
    longest = list(range(len(bindings)))
    longer = lambda i: (length[i], -i)
    reach: dict[tuple[int, int], tuple[float, int]] = {}
    for i in reversed(range(len(bindings))):
        for p in parts[i]:
            score[p] = max(score[p], score[i])
            longest[p] = max(longest[p], longest[i], key=longer)
        for span in at[i]:
            s, j = reach.get(span, (0.0, longest[i]))
            reach[span] = max(s, score[i]), max(j, longest[i], key=longer)
    scored = {j: literal_score(x) if isinstance(x := looks[j], str) else x for s, j in reach.values() if s > 0}
    return sorted(span for span, (s, j) in reach.items() if s > 0 and s + scored[j] >= THRESHOLD)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    spans = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Per document row: doc_id, n_assign, n_access, n_hex, base_sha256 (of the
    base spans), spans (all, kind:start:end) and matches (kind, start, end and
    the matched text of all spans).

    Spans are code points, end exclusive.  Null texts count as empty and have
    no spans; overlapping spans of different kinds all stay; rows are
    independent, so repeats and null ids pass through; an empty table gives an
    empty result.
    """
    match = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, list[int]] = {k: [] for k in KINDS}
            sha, spans_out, matches = [], [], []
            for text in batch.column("text").to_pylist():
                base = base_spans(text)
                seen = Counter(kind for _, _, kind in base)
                for k in KINDS:
                    counts[k].append(seen[k])
                sha.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans = sorted(base + [(a, b, "literal") for a, b in flagged_literals(text)],
                               key=lambda s: (s[0], KINDS.index(s[2])))
                spans_out.append(joined(spans))
                matches.append([{"kind": k, "start": a, "end": b, "text": text[a:b]} for a, b, k in spans])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(counts[k], pa.int64()) for k in KINDS[:3]), pa.array(sha, pa.string()),
                 pa.array(spans_out, pa.string()), pa.array(matches, pa.list_(match))],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "matches"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, f"doc_id {id_type}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
             "matches array<struct<kind: string, start: long, end: long, text: string>>")
