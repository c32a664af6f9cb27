"""Secrets in texts by one deterministic automaton for all rules.

``automaton.compile_rules`` joins the regexes of all rules by subset construction and
minimises the result; a scan reads every byte of every whole text once, whatever the
number of rules.  Texts are cut into pieces at bytes that no rule can contain (the
automaton knows them), and the pieces of a batch run through the transition arrays side by side.

A rule is a ``head`` (a key name, say) followed by a ``body``, the secret itself.  Its matches are
the leftmost ones that don't overlap, each as long as can be; those whose body is shorter
than ``least`` are dropped afterwards, so they still cover their words.  Spans are in
code points, the end exclusive, and ``value`` is where the body begins.

Nulls: a null text is empty; a null key is kept as it is.  Empty texts have no spans.
Repeated rows give repeated results, an empty table none.  Columns beside the key and the
text aren't read.  Each text is scanned in the task that reads it; nothing is shuffled."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from slotcast.llm import textops as T
from slotcast.llm.automaton import Automaton, Matcher, compile_rules, ends


@dataclass(frozen=True)
class Rule:
    kind: str
    body: bytes
    head: bytes = b""
    least: int = 1  # bytes of the body
    nocase: bool = False  # letters of head and body in either case


#: Key assignments, cloud access keys and long hexadecimal strings.
BASE = (
    Rule("assign", rb"[A-Za-z0-9+/_.=-]+", rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", 8, True),
    Rule("access", rb"AKIA[A-Z0-9]+", least=16),
    Rule("hex", rb"[0-9a-f]{32,}"),
)

#: Published token formats: their fixed prefixes and least lengths.
TOKENS = (
    Rule("github", rb"gh[pousr]_[A-Za-z0-9]+", least=40),
    Rule("slack", rb"xox[abprs]-[A-Za-z0-9-]+", least=20),
    Rule("google", rb"AIza[A-Za-z0-9_-]+", least=39),
    Rule("private_key", rb"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE + TOKENS

SPANS = "array<struct<kind:string,start:long,end:long,value:long>>"


class Scanner:
    """The rules' joint automaton, and a matcher each way for every rule."""

    def __init__(self, rules: Sequence[Rule]):
        self.rules = list(rules)
        self.automaton: Automaton = compile_rules([(r.head + b"(?:" + r.body + b")", r.nocase) for r in rules])
        self.backward = [Matcher(r.head + b"(?:" + r.body + b")", r.nocase, backward=True) for r in rules]
        self.heads = [Matcher(r.head, r.nocase) if r.head else None for r in rules]

    def pieces(self, c: T.Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Parts of the chunk's texts between bytes that no rule can contain."""
        cut = self.automaton.cuts[c.data]
        begin = ~cut
        begin[1:] &= cut[:-1]
        full = c.offsets[:-1][c.offsets[:-1] < c.offsets[1:]]
        begin[full] = ~cut[full]
        first = np.flatnonzero(begin)
        stop = np.append(np.flatnonzero(cut), len(c.data))
        last = stop[np.searchsorted(stop, first)] if len(first) else first
        return first, np.minimum(last, c.offsets[np.searchsorted(c.offsets, first, "right")]) if len(first) else last

    def scan(self, c: T.Chunk) -> dict[int, list[tuple[int, int, int, int]]]:
        """(start, rule, end, value) of each text's spans in bytes of the text, in order."""
        first, last = self.pieces(c)
        if not len(first):
            return {}
        place, rules = ends(self.automaton, c.data, first, last)
        order = np.argsort(place, kind="stable")
        docs = np.searchsorted(c.offsets, place[order], "left") - 1  # a match ends after its text's first byte
        raw, out, before = c.data.tobytes() if len(place) else b"", {}, {}
        for end, mask, doc in zip(place[order].tolist(), rules[order].tolist(), docs.tolist(), strict=True):
            base = int(c.offsets[doc])
            for r in (i for i in range(len(self.rules)) if mask >> i & 1):
                start = self.backward[r].longest(raw, end, before.get((doc, r), base))
                before[doc, r] = end
                value = self.heads[r].longest(raw, start, end) if self.heads[r] else start
                if end - value >= self.rules[r].least:
                    out.setdefault(doc, []).append((start - base, r, end - base, value - base))
        return {doc: sorted(spans) for doc, spans in out.items()}


def find_secrets(docs: DataFrame, rules: Sequence[Rule] = RULES, key: str = "doc_id", text: str = "text", redact: bool = False) -> DataFrame:
    """Per row: the key and ``spans`` (kind, start, end, value), by start, then by the rules' order; with ``redact`` also
    ``redacted``, the text with ``<kind>`` in place of each secret (of overlapping ones the first, as far as all reach)."""
    scanner = Scanner(rules)
    kinds = [r.kind for r in rules]

    def blank(raw: bytes, spans) -> bytes:
        parts, done, covered = [], 0, 0
        for _, r, end, value in sorted(spans, key=lambda x: (x[3], x[0], x[1])):
            if value >= covered:
                parts += [raw[done:value], f"<{kinds[r]}>".encode()]
            covered = done = max(covered, end)
        return b"".join([*parts, raw[done:]])

    def run(batches):
        names = ["key", "spans", *["redacted"] * redact]
        for b in batches:
            for c in T.chunks(b.column("text")):
                found, n = scanner.scan(c), c.hi - c.lo
                flat: list[tuple[str, int, int, int]] = []
                for d in sorted(found):
                    text_bytes = c.data[c.offsets[d] : c.offsets[d + 1]]
                    points = np.append(0, np.cumsum((text_bytes & 0xC0) != 0x80))
                    flat += [(kinds[r], *points[[start, end, value]].tolist()) for start, r, end, value in found[d]]
                columns = [pa.array([x[0] for x in flat], pa.string()), *(pa.array([x[i] for x in flat], pa.int64()) for i in (1, 2, 3))]
                spans = T.list_array(pa.StructArray.from_arrays(columns, ["kind", "start", "end", "value"]), np.array([len(found.get(d, ())) for d in range(n)], np.int64))
                out = [b.column("key").slice(c.lo, n), spans]
                if redact:
                    own = b.column("text").slice(c.lo, n).to_pylist()
                    out.append(pa.array([blank(t.encode(), found[d]).decode() if d in found else t for d, t in enumerate(own)], pa.string()))
                yield pa.RecordBatch.from_arrays(out, names)

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    more = ", redacted string" if redact else ""
    schema = S.StructType([S.StructField("key", rows.schema["key"].dataType), *S.StructType.fromDDL(f"spans {SPANS}{more}").fields])
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def of_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def listed(spans: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
