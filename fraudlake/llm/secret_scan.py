"""Secret scan with a trigram inverted index in front of the regexes.

From each rule's regex a Boolean query over trigrams is derived: every match of the
regex holds the trigrams of one of the query's branches. Documents are indexed in
segments (slices of bounded size inside a task): the postings of every trigram that
some query names, as sorted document numbers of the segment. A query is answered by
intersecting and uniting postings, and only its candidates are verified with the
regex. A rule whose regex has no mandatory trigram scans all texts.

The index folds A-Z to lower case, so it never loses a match of a rule that ignores
case and only admits more candidates for the others.

Rules: a regex, a least length in characters of one of its groups (0: the match), and
whether case of ASCII letters is ignored. Matches of a rule are leftmost and do not
overlap; those that are too short are dropped afterwards. Positions count code points.

Cases: null counts as empty; empty texts have no spans; very long texts are a segment
of their own and scanned whole; spans of different rules may overlap and all stay;
repeated rows are scanned each for itself; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlake.llm.common import text_slices
from fraudlake.llm.words import text_buffers


class Rule(NamedTuple):
    kind: str
    pattern: str
    least: int = 0  # characters of ``group`` at least
    group: int = 0
    any_case: bool = False


# fixed values: the base rules
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"[0-9a-f]+", 32),
)
# fixed values: public formats of keys and tokens
MORE_RULES = (
    Rule("github", r"gh[opusr]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abeoprs]-[A-Za-z0-9-]+", 24),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 39),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]+", 24),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 36),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\x0D\x0A\x20]*", 0),
    Rule("url_login", r"[a-z][a-z0-9+.-]*://[^\x00-\x20:@/?#]+:[^\x00-\x20:@/?#]+@", 0),
    Rule("bearer", r"bearer\x20+([A-Za-z0-9._~+/=-]+)", 20, 1, True),
)
RULES = BASE_RULES + MORE_RULES

# --- Boolean trigram queries ----------------------------------------------------------
# A query is True (no condition), a trigram (int), or ("and" | "or", queries).

MOST_STRINGS = 64


def trigram(s: str) -> int:
    a, b, c = s.encode("latin-1")
    return a << 16 | b << 8 | c


def both(queries, kind: str = "and"):
    """``queries`` joined by ``kind``, simplified."""
    neutral = [q for q in dict.fromkeys(queries) if q is not True]
    if kind == "or" and len(neutral) < len(set(queries)) or not neutral:
        return True
    return neutral[0] if len(neutral) == 1 else (kind, tuple(neutral))


def of_strings(strings: set[str]):
    """The query of texts that hold one of ``strings``."""
    return both([both([trigram(s[i : i + 3]) for i in range(len(s) - 2)]) for s in sorted(strings)], "or")


def _derive(items) -> tuple[set[str] | None, object]:
    """(all strings that the items match, or None; the query of texts that hold a match)."""
    from re import _constants as op

    run, query, exact = {""}, [], True

    def end_run():
        nonlocal run
        query.append(of_strings(run))
        run = {""}

    for kind, arg in items:
        if kind is op.AT:
            continue
        strings, more = None, True
        if kind is op.LITERAL and arg < 128:
            strings = {chr(arg).lower()}
        elif kind is op.IN and all(k is op.LITERAL and a < 128 for k, a in arg):
            strings = {chr(a).lower() for _, a in arg}
        elif kind is op.SUBPATTERN:
            strings, more = _derive(arg[-1])
        elif kind is op.BRANCH:
            each = [_derive(branch) for branch in arg[1]]
            strings = None if any(s is None for s, _ in each) else set().union(*[s for s, _ in each])
            more = both([of_strings(s) if s is not None else q for s, q in each], "or")
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
            least, most, inner = arg
            inside, inner_query = _derive(inner)
            if least == 0 and most == 1 and inside is not None:
                strings = inside | {""}
            elif least >= 1:
                more = of_strings(inside) if inside is not None else inner_query
        if strings is not None and len(strings) * len(run) <= MOST_STRINGS:
            run = {a + b for a in run for b in strings}
        else:
            end_run()
            query.append(of_strings(strings) if strings is not None else more)
            exact = False
    if exact:
        return run, of_strings(run)
    end_run()
    return None, both(query)


def trigram_query(pattern: str):
    """The query that every text with a match of ``pattern`` fulfils."""
    from re import _parser

    return _derive(_parser.parse(pattern))[1]


def trigrams_of(query) -> set[int]:
    if query is True:
        return set()
    return {query} if isinstance(query, int) else set().union(*map(trigrams_of, query[1]))


# --- the index of a segment -------------------------------------------------------------


def slot_table(trigrams: list[int]) -> np.ndarray:
    """Trigram -> its place in the list plus 1, else 0."""
    table = np.zeros(1 << 24, dtype=np.uint16)
    table[trigrams] = np.arange(1, len(trigrams) + 1)
    return table


def _folding() -> np.ndarray:
    fold = np.arange(256, dtype=np.uint8)
    fold[65:91] += 32
    return fold


def postings(texts: pa.Array, trigrams: list[int], table: np.ndarray) -> dict[int, np.ndarray]:
    """Trigram -> ascending numbers of the texts that hold it."""
    data, at = text_buffers(texts, lower=False)
    data = _folding()[data]
    if len(data) < 3 or not trigrams:
        return {t: np.zeros(0, np.int64) for t in trigrams}
    code = data[:-2].astype(np.uint32) << np.uint32(16)
    code |= data[1:-1].astype(np.uint32) << np.uint32(8)
    code |= data[2:]
    slot = table[code]
    place = np.flatnonzero(slot)
    doc = np.searchsorted(at, place, side="right") - 1
    inside = place + 3 <= at[doc + 1]
    slot, doc = slot[place][inside].astype(np.int64), doc[inside]
    n = len(at) - 1
    pairs = np.unique((slot - 1) * n + doc)
    lists = np.split(pairs % n, np.searchsorted(pairs // n, np.arange(1, len(trigrams))))
    return dict(zip(trigrams, lists, strict=True))


def answer(query, index: dict[int, np.ndarray], n: int) -> np.ndarray:
    """Numbers of the texts that fulfil ``query``."""
    if query is True:
        return np.arange(n)
    if isinstance(query, int):
        return index[query]
    kind, parts = query
    lists = [answer(q, index, n) for q in parts]
    if kind == "or":
        return np.unique(np.concatenate(lists))
    lists.sort(key=len)  # the shortest list first
    out = lists[0]
    for other in lists[1:]:
        out = np.intersect1d(out, other, assume_unique=True)
    return out


def _verifier(rule: Rule):
    """text -> [(start, end)] of the rule's matches."""
    expr = re.compile(rule.pattern, re.ASCII | re.IGNORECASE if rule.any_case else re.ASCII)
    runs = re.fullmatch(r"(\[[^\]]*\])\+", rule.pattern)
    if runs and not rule.group and rule.least:  # maximal runs of one class: short ones need not be matched first
        expr = re.compile(f"{runs[1]}{{{rule.least},}}", expr.flags)
    return lambda text: [m.span() for m in expr.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, text, spans) of every document; ``spans``: array of (start, end, rule, kind), ascending, rule the place in ``rules``."""
    queries = [trigram_query(r.pattern) for r in rules]
    needed = sorted(set().union(*map(trigrams_of, queries)))

    def task(batches):
        table = slot_table(needed)
        checks = [_verifier(r) for r in rules]
        kind = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("rule", pa.int32()), ("kind", pa.string())])
        for batch in batches:
            for part in text_slices(batch):
                texts = part.column("text")
                index = postings(texts, needed, table)
                spans = [[] for _ in range(part.num_rows)]
                read = texts.to_pylist()
                for number, (rule, query, check) in enumerate(zip(rules, queries, checks, strict=True)):
                    for d in answer(query, index, len(read)).tolist():
                        if read[d]:
                            spans[d] += [{"start": s, "end": e, "rule": number, "kind": rule.kind} for s, e in check(read[d])]
                for found in spans:
                    found.sort(key=lambda s: (s["start"], s["rule"], s["end"]))
                yield pa.record_batch([part.column("doc_id"), texts, pa.array(spans, pa.list_(kind))], names=["doc_id", "text", "spans"])

    return docs.select("doc_id", "text").mapInArrow(task, "doc_id long, text string, spans array<struct<start:long,end:long,rule:int,kind:string>>")


def redacted(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[secret]") -> DataFrame:
    """(doc_id, text) with every span, overlapping ones as one, replaced by ``mark``."""
    found = scan(docs, rules)
    # walk the spans in order: (text so far, end of what is done)
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("done"))

    def step(acc, s):
        gap = F.when(s["start"] >= acc["done"], F.concat(acc["out"], F.substr("text", (acc["done"] + 1).cast("int"), (s["start"] - acc["done"]).cast("int")), F.lit(mark))).otherwise(acc["out"])
        return F.struct(gap.alias("out"), F.greatest(acc["done"], s["end"]).alias("done"))

    walked = F.aggregate("spans", start, step, lambda a: F.concat(a["out"], F.substr("text", (a["done"] + 1).cast("int"))))
    return found.select("doc_id", walked.alias("text"))


def digest(docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """Per document the numbers of base spans, the hash of their list, and all spans as text."""
    found = scan(docs, rules)
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of = lambda kinds: F.filter("spans", lambda s: s["kind"].isin(kinds))
    own = of([r.kind for r in base])
    counts = [F.size(of([r.kind])).cast("long").alias(f"n_{r.kind}") for r in base]
    return found.select("doc_id", *counts, F.sha2(line(own), 256).alias("base_sha256"), line("spans").alias("spans"))
