"""Secret scans with a trigram index.

Each rule's pattern is turned into a Boolean query of trigrams that any match must hold (of lower-cased text, so it also
covers patterns that ignore case). Every task indexes its documents a block at a time: for each trigram that some rule
asks for, the list of documents with it. The lists are intersected and united as the query says, and only the documents
left are searched with the pattern. A rule without a mandatory trigram is searched in every document. The index is split
by documents, so nothing is shuffled and a lost executor costs its own blocks.

Matches are leftmost and do not overlap within a kind; those shorter than the rule's least length are dropped
afterwards. Spans are in code points, end exclusive, ordered by start and then by the rules' order.

Cases: null and empty texts have no spans; repeated rows each get theirs; all columns are kept in ``redact``, and
``find_secrets`` returns the id and the spans only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as sre
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwatch.llm import words as W

MOST = 64  # strings that a stretch of a pattern may stand for before it is cut


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    any_case: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0))


# The three base kinds and some well-known token formats.
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    Rule("hex", r"[0-9a-f]{16,}", 16),  # the same as runs of any length of which those of 16 or more are kept
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)

Query = tuple  # ("all", parts) or ("any", parts); a part is a query or a trigram


def trigrams(text: bytes) -> Query:
    return ("all", tuple(sorted({text[i : i + 3] for i in range(len(text) - 2)})))


def simplified(query: Query) -> Query:
    kind, parts = query
    parts = tuple(dict.fromkeys(p if isinstance(p, bytes) else simplified(p) for p in parts))
    if kind == "any" and ("all", ()) in parts:
        return ("all", ())
    parts = tuple(p for p in parts if p != ("all", ()))
    return parts[0] if len(parts) == 1 and not isinstance(parts[0], bytes) else (kind, parts)


def of_strings(strings: set[bytes]) -> Query:
    return ("any", tuple(trigrams(s) for s in sorted(strings)))


def of_items(items) -> tuple[set[bytes] | None, Query]:
    """The strings a part of a pattern stands for, or None if they are too many; and what any match must hold."""
    must: list[Query] = []
    run: set[bytes] = {b""}
    whole = True

    def cut() -> None:
        nonlocal run, whole
        must.append(of_strings(run))
        run, whole = {b""}, False

    for op, value in items:
        exact: set[bytes] | None = None
        inner: Query = ("all", ())
        if op is sre.LITERAL:
            exact = {chr(value).lower().encode()}
        elif op is sre.IN and all(o in (sre.LITERAL, sre.RANGE) for o, _ in value):
            spans = [(v, v) if o is sre.LITERAL else v for o, v in value]
            if sum(b - a + 1 for a, b in spans) <= 16:
                exact = {chr(c).lower().encode() for a, b in spans for c in range(a, b + 1)}
        elif op is sre.SUBPATTERN:
            exact, inner = of_items(value[-1])
        elif op is sre.BRANCH:
            options = [of_items(v) for v in value[1]]
            if all(e is not None for e, _ in options):
                exact = set().union(*(e for e, _ in options))
            inner = ("any", tuple(("all", (q, of_strings(e))) if e is not None else q for e, q in options))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, body = value
            strings, query = of_items(body)
            if strings is not None and low == 0 and high == 1:
                exact = strings | {b""}
            elif low > 0:
                inner = ("all", (query, of_strings(strings))) if strings is not None else query
        elif op is sre.AT:
            exact = {b""}
        if exact is not None and len(run) * len(exact) <= MOST:
            run = {a + b for a in run for b in exact}
        else:
            cut()
            must.append(inner if exact is None else of_strings(exact))
    if whole:
        return run, ("all", tuple(must))
    must.append(of_strings(run))
    return None, ("all", tuple(must))


def trigram_query(rule: Rule) -> Query:
    strings, query = of_items(parser.parse(rule.pattern, re.ASCII))
    return simplified(query if strings is None else ("all", (query, of_strings(strings))))


def asked(query: Query) -> set[bytes]:
    return set().union(*({p} if isinstance(p, bytes) else asked(p) for p in query[1])) if query[1] else set()


class Block:
    """The posting lists of some texts for a vocabulary of trigrams."""

    def __init__(self, texts: pa.Array, vocabulary: np.ndarray, listed: np.ndarray):
        raw, offsets = W.raw_bytes(texts)
        data = W.LOWER[raw].astype(np.uint32)
        codes = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:] if len(data) > 2 else np.zeros(0, np.uint32)
        at = np.flatnonzero(listed[codes])
        row = np.searchsorted(offsets, at, "right") - 1
        inside = at + 3 <= offsets[row + 1]
        pairs = np.unique(np.searchsorted(vocabulary, codes[at[inside]]).astype(np.int64) * len(texts) + row[inside])
        self.rows, self.vocabulary = pairs % max(len(texts), 1), vocabulary
        self.starts = np.searchsorted(pairs // max(len(texts), 1), np.arange(len(vocabulary) + 1))
        self.all = np.arange(len(texts))

    def posting(self, gram: bytes) -> np.ndarray:
        k = int(np.searchsorted(self.vocabulary, int.from_bytes(gram, "big")))
        return self.rows[self.starts[k] : self.starts[k + 1]]

    def found(self, query: Query) -> np.ndarray:
        kind, parts = query
        out = self.all if kind == "all" else np.zeros(0, np.int64)
        for part in parts:
            rows = self.posting(part) if isinstance(part, bytes) else self.found(part)
            out = np.intersect1d(out, rows, assume_unique=True) if kind == "all" else np.union1d(out, rows)
        return out


def scanner(rules: tuple[Rule, ...]):
    """A function from texts to each one's spans (kind, start, end)."""
    queries = [trigram_query(r) for r in rules]
    vocabulary = np.array(sorted({int.from_bytes(g, "big") for q in queries for g in asked(q)}), np.uint32)
    listed: np.ndarray | None = None

    def scan(texts: pa.Array) -> list[list[tuple[str, int, int]]]:
        nonlocal listed
        if listed is None:
            listed = np.zeros(1 << 24, bool)
            listed[vocabulary] = True
        block, spans = Block(texts, vocabulary, listed), [[] for _ in range(len(texts))]
        cache: dict[int, str] = {}
        for rank, (rule, query) in enumerate(zip(rules, queries)):
            find = rule.compiled().finditer
            for row in block.found(query).tolist():
                if row not in cache:
                    cache[row] = texts[row].as_py() or ""
                spans[row] += [(m.start(), rank, m.end()) for m in find(cache[row]) if len(m[rule.group]) >= rule.least]
        return [[(rules[rank].kind, start, end) for start, rank, end in sorted(s)] for s in spans]

    return scan


def find_secrets(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per document: doc_id and spans (kind, start, end)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(rules)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in W.pieces(batches, "text"):
            found = [[{"kind": k, "start": s, "end": e} for k, s, e in spans] for spans in scan(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind)], ["doc_id", "spans"])

    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {id_type}, spans array<struct<kind: string, start: bigint, end: bigint>>")


def redact(docs: DataFrame, *, text: str = "text", rules: tuple[Rule, ...] = RULES, mark: str = "[secret]") -> DataFrame:
    """The documents with every span replaced by ``mark``; spans that overlap or touch become one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(rules)
        for batch in W.pieces(batches, text):
            column, out = batch.column(text), None
            for row, spans in enumerate(scan(column)):
                if not spans:
                    continue
                out = out or column.to_pylist()
                old, parts, done = out[row], [], 0
                for _, start, end in spans:
                    if start > done or not parts:
                        parts += [old[done:start], mark]
                    done = max(done, end)
                out[row] = "".join([*parts, old[done:]])
            yield batch if out is None else batch.set_column(batch.schema.get_field_index(text), text, pa.array(out, column.type))

    return docs.mapInArrow(run, docs.schema)
