"""Secret scans with a trigram inverted index.

From the parse tree of each rule's regular expression a Boolean query over
trigrams is derived: every match must contain certain literal strings, hence
their trigrams ("aki" and "kia" for ``AKIA...``; an OR over the keywords of an
alternation).  Each slab of texts is a shard with an inverted index, trigram ->
sorted text numbers, over A-Z lower-cased bytes.  The queries intersect and
unite postings; only the texts that remain are run through the regular
expression.  Rules without a mandatory trigram (long hex runs) scan all texts.
The index holds the trigrams that any rule asks for, so its size follows the
matches and not the text.  There is no shuffle.

Edge cases: null and empty texts have no spans; offsets are code points, ends
exclusive; matches of one kind do not overlap (leftmost first), kinds may.
"""

from __future__ import annotations

import re
import re._constants as sre
import re._parser as parser
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from notelab.llm import bytewords as bw
from notelab.llm.common import fresh_name


@dataclass(frozen=True)
class Rule:
    """A match counts if the text of ``group`` has ``min_chars`` or more."""

    kind: str
    pattern: str
    group: int = 0
    min_chars: int = 0
    ignore_case: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.ignore_case else 0))


# The base kinds.  A hex run is one match of [0-9a-f]+, which
# counts from 24 characters on; {24,} finds the same runs.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULES = BASE_RULES + MORE_RULES

#: A query in disjunctive form: one of the sets of trigrams must be there in
#: full.  None: no condition.
Query = frozenset[frozenset[bytes]] | None
MOST_STRINGS = 64


def _trigrams(text: str) -> frozenset[bytes]:
    raw = text.lower().encode()
    return frozenset(raw[i: i + 3] for i in range(len(raw) - 2))


def _any_of(strings: set[str]) -> Query:
    sets = {_trigrams(x) for x in strings}
    if not sets or frozenset() in sets:
        return None
    return frozenset(s for s in sets if not any(t < s for t in sets))


def _both(a: Query, b: Query) -> Query:
    if a is None or b is None:
        return b if a is None else a
    sets = {x | y for x in a for y in b}
    return frozenset(s for s in sets if not any(t < s for t in sets))


def _either(queries: list[Query]) -> Query:
    return None if any(q is None for q in queries) else frozenset().union(*queries)


def _strings(op, arg) -> set[str] | None:
    """All strings that a node can match, if they are few."""
    if op is sre.LITERAL:
        return {chr(arg)}
    if op is sre.IN:
        out: set[str] = set()
        for kind, value in arg:
            if kind is sre.LITERAL:
                out.add(chr(value))
            elif kind is sre.RANGE and value[1] - value[0] < 8:
                out |= {chr(c) for c in range(value[0], value[1] + 1)}
            else:
                return None
        return out if len(out) <= 8 else None
    if op is sre.SUBPATTERN:
        return _sequence_strings(arg[-1])
    if op is sre.BRANCH:
        parts = [_sequence_strings(x) for x in arg[1]]
        return None if any(p is None for p in parts) else set().union(*parts)
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[1] <= 5:
        one = _sequence_strings(arg[2])
        if one is None or len(one) ** arg[1] > MOST_STRINGS:
            return None
        out, power = set(), {""}
        for n in range(arg[1] + 1):
            out |= power if n >= arg[0] else set()
            power = {x + y for x in power for y in one}
        return out
    return None


def _sequence_strings(nodes) -> set[str] | None:
    out = {""}
    for op, arg in nodes:
        own = _strings(op, arg)
        if own is None or len(out) * len(own) > MOST_STRINGS:
            return None
        out = {x + y for x in out for y in own}
    return out


def trigram_query(pattern: str) -> Query:
    """The trigrams, lower-cased, that every match of a pattern contains."""
    return _sequence_query(parser.parse(pattern))


def _sequence_query(nodes) -> Query:
    query, run = None, {""}
    for op, arg in nodes:
        own = _strings(op, arg)
        if own is not None and len(run) * len(own) <= MOST_STRINGS:
            run = {x + y for x in run for y in own}
            continue
        query = _both(query, _any_of(run))
        run = {""} if own is None else own
        if own is None:
            if op is sre.SUBPATTERN:
                query = _both(query, _sequence_query(arg[-1]))
            elif op is sre.BRANCH:
                query = _both(query, _either([_sequence_query(x) for x in arg[1]]))
            elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] >= 1:
                query = _both(query, _sequence_query(arg[2]))
    return _both(query, _any_of(run))


class TrigramIndex:
    """Inverted index of a slab over the given trigrams."""

    def __init__(self, slab: bw.Slab, wanted: np.ndarray, codes: np.ndarray) -> None:
        """wanted: mask over all 2**24 trigram codes; codes: those set in it."""
        d = bw.LOWER[slab.data].astype(np.uint32)
        grams = (d[:-2] << 16) | (d[1:-1] << 8) | d[2:] if len(d) > 2 else np.zeros(0, np.uint32)
        at = np.flatnonzero(wanted[grams])
        text = np.searchsorted(slab.offsets, at, side="right") - 1
        inside = at + 3 <= slab.offsets[text + 1]
        pairs = np.unique(np.searchsorted(codes, grams[at[inside]]) * np.int64(slab.n) + text[inside])
        code, text = pairs // max(1, slab.n), pairs % max(1, slab.n)
        edges = np.searchsorted(code, np.arange(len(codes) + 1))
        self.postings = {int(c): text[edges[i]: edges[i + 1]] for i, c in enumerate(codes)}

    def find(self, query: frozenset[frozenset[bytes]]) -> np.ndarray:
        """Numbers of the texts that satisfy a query, shortest postings first."""
        found = [np.zeros(0, np.int64)]
        for need in query:
            lists = sorted((self.postings[int.from_bytes(g, "big")] for g in need), key=len)
            texts = lists[0]
            for other in lists[1:]:
                if not len(texts):
                    break
                texts = np.intersect1d(texts, other, assume_unique=True)
            found.append(texts)
        return np.unique(np.concatenate(found))


def _scan(text_at: int, rules: tuple[Rule, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [r.compiled() for r in rules]
        queries = [trigram_query(r.pattern) for r in rules]
        codes = np.array(sorted({int.from_bytes(g, "big") for q in queries if q for s in q for g in s}), np.int64)
        wanted = np.zeros(1 << 24, bool)
        wanted[codes] = True
        for batch in batches:
            spans: list[list] = [[] for _ in range(batch.num_rows)]
            column = batch.column(text_at)
            for slab in bw.slabs(column):
                index = TrigramIndex(slab, wanted, codes)
                texts: dict[int, str] = {}
                for k, rule in enumerate(rules):
                    for i in (range(slab.n) if queries[k] is None else index.find(queries[k]).tolist()):
                        if i not in texts:
                            texts[i] = column[slab.first + i].as_py() or ""
                        spans[slab.first + i] += [
                            (m.start(), k, m.end()) for m in compiled[k].finditer(texts[i])
                            if m.end(rule.group) - m.start(rule.group) >= rule.min_chars]
            out = pa.array([[{"kind": rules[k].kind, "start": s, "end": e} for s, k, e in sorted(x)] for x in spans], SPANS)
            yield pa.RecordBatch.from_arrays([*(c for i, c in enumerate(batch.columns) if i != text_at), out],
                                             names=[f"c{i}" for i in range(batch.num_columns)])

    return run


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find_secrets(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, str]:
    """The columns of ``docs`` but the text, and an array of (kind, start,
    end) by start, then order of the rules; the name of that array."""
    rest = [c for c in docs.columns if c != text_col]
    name, types = fresh_name(docs, "spans"), dict(docs.dtypes)
    schema = ", ".join([*(f"c{i} {types[c]}" for i, c in enumerate(rest)),
                        f"c{len(rest)} array<struct<kind: string, start: long, end: long>>"])
    return docs.mapInArrow(_scan(docs.columns.index(text_col), rules), schema).toDF(*rest, name), name
