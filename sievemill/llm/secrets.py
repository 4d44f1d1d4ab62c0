"""Secret scans over a trigram inverted index.

Each rule's regex yields a Boolean trigram query: an OR of ANDs of trigrams that every match must hold. Each block of
documents (an Arrow batch, in the task that reads it) gets an inverted index of the trigrams that any rule asks for;
postings are intersected and united as the query says, and the regex runs over the candidates alone. A rule without
mandatory trigrams scans every document. Only the index of one block is in memory at a time, and nothing is shuffled.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as C
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sievemill.llm.common import as_bytes, chunks


@dataclass(frozen=True)
class Rule:
    """kind, its regex, the group that must have least characters at least (0: the whole match)."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    flags: int = re.ASCII


RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]+", 24),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("hub", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("stripe", r"[sr]k_live_[A-Za-z0-9]{16,}"),
)
BASE_KINDS = ("assign", "access", "hex")

#: No more strings than this are spelt out for one part of a regex; beyond it, the part counts as unknown.
MOST_STRINGS = 64


def mandatory(pattern: str, flags: int = 0) -> list[frozenset[str]] | None:
    """The trigram query of a regex as alternatives of lower-cased trigrams, all of which a match holds; None: no trigram is mandatory."""

    def spell(items) -> list[list[str | None]]:
        """Alternatives, each a list of literal runs; None stands for unknown text."""
        out: list[list[str | None]] = [[""]]

        def append(parts: list[list[str | None]]):
            nonlocal out
            if len(out) * len(parts) > MOST_STRINGS:
                parts = [[None]]
            made = []
            for a, b in itertools.product(out, parts):
                joined = list(a)
                for x in b:
                    if x is not None and joined and joined[-1] is not None:
                        joined[-1] += x
                    elif not (x is None and joined and joined[-1] is None):
                        joined.append(x)
                made.append(joined)
            out = [list(x) for x in dict.fromkeys(map(tuple, made))]

        for op, arg in items:
            if op is C.LITERAL:
                append([[chr(arg).lower()]])
            elif op is C.IN:
                chars = {chr(v).lower() for o, v in arg if o is C.LITERAL}
                append([[c] for c in sorted(chars)] if all(o is C.LITERAL for o, _ in arg) and len(chars) <= 8 else [[None]])
            elif op is C.SUBPATTERN:
                append(spell(arg[-1]))
            elif op is C.BRANCH:
                append([x for branch in arg[1] for x in spell(branch)])
            elif op in (C.MAX_REPEAT, C.MIN_REPEAT):
                low, high, item = arg
                one = spell(item)
                if (low, high) == (0, 1):
                    append([[""], *one])
                else:
                    for _ in range(min(low, 3)):
                        append(one)
                    if high != low or low > 3:
                        append([[None]])
            elif op is not C.AT:
                append([[None]])
        return out

    query = []
    for runs in spell(_parser.parse(pattern, flags)):
        grams = frozenset(r[i : i + 3] for r in runs if r for i in range(len(r) - 2))
        if not grams or any(ord(c) > 127 for g in grams for c in g):
            return None
        query.append(grams)
    return list(dict.fromkeys(query))


class Matcher:
    """All rules with their queries, and the table of trigrams that the index keeps."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = [(r, re.compile(r.pattern, r.flags), mandatory(r.pattern, r.flags)) for r in rules]
        self.grams = sorted({g for _, _, q in self.rules for alt in q or () for g in alt})
        self.ids = {g: i + 1 for i, g in enumerate(self.grams)}
        self.table = np.zeros(1 << 24, np.uint16)
        for g, i in self.ids.items():
            a, b, c = g.encode()
            self.table[a | b << 8 | c << 16] = i
        self.lower = np.arange(256, dtype=np.uint32)
        self.lower[65:91] += 32

    def index(self, texts: list[bytes]) -> dict[int, np.ndarray]:
        """Postings: the rows that hold a trigram, sorted, by the trigram's id."""
        raw = self.lower[np.frombuffer(b"\0\0".join(texts) + b"\0\0", np.uint8)]
        ids = self.table[raw[:-2] | raw[1:-1] << 8 | raw[2:] << 16]
        at = np.flatnonzero(ids)
        ends = np.cumsum([len(t) + 2 for t in texts])
        pairs = np.unique(ids[at].astype(np.int64) << 32 | np.searchsorted(ends, at, "right"))
        grams, rows = pairs >> 32, pairs & 0xFFFFFFFF
        edges = np.searchsorted(grams, np.arange(1, len(self.grams) + 2))
        return {i: rows[edges[i - 1] : edges[i]] for i in range(1, len(self.grams) + 1)}

    def candidates(self, postings: dict[int, np.ndarray], query: list[frozenset[str]] | None, n: int) -> np.ndarray:
        if query is None:
            return np.arange(n)
        found = []
        for alt in query:
            rows = None
            for gram in sorted(alt, key=lambda g: len(postings[self.ids[g]])):
                own = postings[self.ids[gram]]
                rows = own if rows is None else np.intersect1d(rows, own, assume_unique=True)
                if not len(rows):
                    break
            found.append(rows)
        return np.unique(np.concatenate(found))

    def scan(self, texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
        """Of each text: (start, rule's number, end) in code points, sorted."""
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        decoded: dict[int, str] = {}
        postings = self.index(texts)
        for number, (rule, regex, query) in enumerate(self.rules):
            for row in self.candidates(postings, query, len(texts)).tolist():
                text = decoded.get(row)
                if text is None:
                    text = decoded[row] = texts[row].decode()
                for m in regex.finditer(text):
                    a, b = m.span(rule.group)
                    if b - a >= rule.least:
                        found[row].append((m.start(), number, m.end()))
        return [sorted(x) for x in found]



def scan(df: DataFrame, rules: tuple[Rule, ...] = RULES, identity: str = "doc_id", text: str = "text") -> DataFrame:
    """(identity, spans array<struct<start, kind, end>>), a row for each row of df; a null text has no spans.

    Repeated rows are scanned alike; other columns are not read; an empty table gives an empty table."""
    kinds = [r.kind for r in rules]
    made = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(rules)
        for batch in batches:
            texts = as_bytes(batch.column(1))
            for a, b in chunks([len(t) for t in texts], 1 << 22):
                spans = [[{"start": s, "kind": kinds[k], "end": e} for s, k, e in x] for x in matcher.scan(texts[a:b])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(spans, made)], [identity, "spans"])

    kind_of = dict(df.dtypes)[identity]
    return df.select(identity, text).mapInArrow(run, f"`{identity}` {kind_of}, spans array<struct<start: long, kind: string, end: long>>")


def op8_secrets(spark, sf_dir):
    from pyspark.sql import functions as F

    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    is_base = lambda s: s["kind"].isin(*BASE_KINDS)
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as long) as n_{k}") for k in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(F.filter("spans", is_base)), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def _sql() -> str:
    """Matches are placed by the lengths of the pieces between them."""
    either = lambda w: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
    keyword = "|".join(either(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    pattern = {r.kind: r.pattern for r in RULES} | {
        "assign": RULES[0].pattern.replace("(?i:(password|passwd|secret|token|api_?key))", f"({keyword})"),
        # A run's longest match is its first, so the least length may stand in the pattern.
        "access": "AKIA[A-Z0-9]{16,}",
        "hex": "[0-9a-f]{24,}",
    }
    found = []
    for i, rule in enumerate(RULES):
        p = "'" + pattern[rule.kind].replace("'", "''") + "'"
        group = f"regexp_extract_all(text, {p}, 2)" if rule.kind == "assign" else f"regexp_extract_all(text, {p})"
        found.append(f"select doc_id, {i} place, '{rule.kind}' kind, {rule.least if rule.kind == 'assign' else 0} least, regexp_split_to_array(text, {p}) pieces, regexp_extract_all(text, {p}) matches, {group} own from d")
    counts = ", ".join(f"count(*) filter (kind = '{k}') n_{k}" for k in BASE_KINDS)
    joined = lambda where: f"coalesce(string_agg(kind || ':' || a || ':' || b, ',' order by a, place){where}, '')"
    return f"""
with d as (select doc_id, coalesce(text, '') text from documents),
m as ({" union all ".join(found)}),
u as (select doc_id, place, kind, least, unnest(range(len(matches))) i, unnest(matches) match, unnest(pieces[1:len(matches)]) piece, unnest(own) own from m),
s as (select *, sum(length(piece) + length(match)) over (partition by doc_id, place order by i) b from u),
t as (select doc_id, place, kind, (b - length(match))::bigint a, b::bigint b from s where length(own) >= least),
g as (select doc_id, {counts}, {joined(" filter (place < " + str(len(BASE_KINDS)) + ")")} base, {joined("")} spans from t group by doc_id)
select d.doc_id, {", ".join(f"coalesce(n_{k}, 0) n_{k}" for k in BASE_KINDS)}, sha256(coalesce(base, '')) base_sha256, coalesce(spans, '') spans from d left join g using (doc_id)"""


#: The same by DuckDB's own regexes.
OP8_SQL = _sql()
