"""Secrets in texts through a trigram inverted index. DataFrame functions only.

From each rule's regular expression a Boolean query over trigrams is derived that every text with a match satisfies.
The index has one posting (trigram, document) for each mandatory trigram of any rule that a text holds; the postings are
intersected by the queries, and only the documents that come out are verified with the rule's expression. Rules without
mandatory trigrams scan all texts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _parser as parser  # the standard library's own parse of an expression

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, small, spread
from .spans import found, listed, number_of, tagged

#: A set of exact strings is followed up to this size when a query is derived.
MOST_STRINGS = 64
#: A range of more characters is any character.
MOST_CHARS = 8


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    least: int
    group: int = 0
    base: bool = False


#: Formats of the base kinds, and published formats of common credentials. Repeats are possessive: time is linear.
RULES = (
    Rule("assign", r"""(?i:(?:password|passwd|secret|token|api_?key))["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)""", 6, 1, True),
    Rule("access", r"AKIA[A-Z0-9]++", 20, 0, True),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{24,}+", 24, 0, True),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----", 1),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36}", 1),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}+", 1),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+", 1),
)

# A query is True (no demand), a trigram, ("and", queries) or ("or", queries).


def _all(queries) -> object:
    parts = frozenset(p for q in queries if q is not True for p in _demands(q))
    return True if not parts else next(iter(parts)) if len(parts) == 1 else ("and", parts)


def _demands(q: object) -> frozenset:
    return q[1] if isinstance(q, tuple) and q[0] == "and" else frozenset([q])


def _any(queries) -> object:
    parts = frozenset(queries)
    if True not in parts:  # what asks for more than another alternative adds nothing
        parts = frozenset(q for q in parts if not any(_demands(p) < _demands(q) for p in parts))
    return True if True in parts or not parts else next(iter(parts)) if len(parts) == 1 else ("or", parts)


def _of_strings(strings: set[str]) -> object:
    """Every match holds one of the strings."""
    return _any(_all(s[i : i + 3] for i in range(len(s) - 2)) for s in strings)


def _chars(items) -> set[str] | None:
    out: set[str] = set()
    for op, arg in items:
        name = str(op)
        if name == "LITERAL":
            out.add(chr(arg).lower())
        elif name == "RANGE" and arg[1] - arg[0] < MOST_CHARS:
            out |= {chr(c).lower() for c in range(arg[0], arg[1] + 1)}
        else:
            return None
    return out


def _read(tree) -> tuple[set[str] | None, object]:
    """For a sequence: the exact set of its strings if small, and a query its matches satisfy."""
    run: set[str] | None = {""}
    demands: list = []
    whole = True
    for op, arg in tree:
        name, exact, query = str(op), None, True
        if name == "LITERAL":
            exact = {chr(arg).lower()}
        elif name == "IN":
            exact = _chars(arg)
        elif name == "SUBPATTERN":
            exact, query = _read(arg[3])
        elif name == "BRANCH":
            both = [_read(x) for x in arg[1]]
            exact = set().union(*(x for x, _ in both)) if all(x is not None for x, _ in both) else None
            query = _any(q if x is None else _of_strings(x) for x, q in both)
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            low, high, inner = arg
            one, inside = _read(inner)
            if one is not None and int(high) <= 1:
                exact = one | {""} if low == 0 else one
            elif low > 0:
                query = inside if one is None else _of_strings(one)
        elif name in ("ASSERT", "ASSERT_NOT", "AT"):
            continue
        if exact is not None and run is not None and len(run) * len(exact) <= MOST_STRINGS:
            run = {a + b for a in run for b in exact}
            continue
        whole = False
        demands += [_of_strings(run or {""}), query if exact is None else True]
        run = exact if exact is not None and len(exact) <= MOST_STRINGS else {""}
    if whole:
        return run, _of_strings(run)
    return None, _all([*demands, _of_strings(run or {""})])


def trigram_query(pattern: str) -> object:
    """A Boolean query over lower-case trigrams that any text with a match of pattern satisfies."""
    exact, query = _read(parser.parse(pattern))
    return query if exact is None else _of_strings(exact)


def trigrams(query: object) -> set[str]:
    return set() if query is True else {query} if isinstance(query, str) else set().union(*(trigrams(q) for q in query[1]))


def _satisfied(query: object, has) -> Column:
    if isinstance(query, str):
        return has(query)
    parts = [_satisfied(q, has) for q in sorted(query[1], key=str)]
    out = parts[0]
    for p in parts[1:]:
        out = out & p if query[0] == "and" else out | p
    return out


def _long_enough(least: int):
    return lambda s: F.length(s["group"]) >= least


def build_index(docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "key", text_col: str = "text") -> DataFrame:
    """trigram, key: the postings of the rules' mandatory trigrams, in lower case."""
    needed = sorted(set().union(*(trigrams(trigram_query(r.pattern)) for r in rules)))
    low = docs.select(key, F.lower(text_col).alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in needed]))
    return low.select(key, F.explode(held).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "key") -> DataFrame:
    """key, rules: for each document that some rule's query selects, the kinds of those rules."""
    asked = [(r, q) for r in rules if (q := trigram_query(r.pattern)) is not True]
    needed = sorted(set().union(*(trigrams(q) for _, q in asked)))
    # a set of mandatory trigrams: as many as the rules have at most
    met = index.filter(F.col("trigram").isin(needed)).groupBy(key).agg(F.collect_set("trigram").alias("held"))
    has = lambda t: F.array_contains("held", t)
    kinds = F.array_compact(F.array(*[F.when(_satisfied(q, has), F.lit(r.kind)) for r, q in asked]))
    return met.select(key, kinds.alias("rules")).filter(F.size("rules") > 0)


def keyed(docs: DataFrame) -> DataFrame:
    """docs with the key that an index of them goes by: a hash of id and text, so repeated and missing ids do no harm."""
    return docs.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("key", F.xxhash64("doc_id", "text"))


def with_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES, out: str = "spans", index: DataFrame | None = None) -> DataFrame:
    """docs (doc_id, text) with an array of spans (start, rank, end, kind, base, score), sorted by start and kind.

    index: a stored build_index of keyed(docs), for rules it was built with or some of them; without one it is built here.
    The candidates' table is broadcast if it is small; beyond that the join shuffles, for which documents and index are
    best stored bucketed by key.
    """
    rows = keyed(spread(docs))
    met = cut(candidates(build_index(rows, rules) if index is None else index, rules))
    both = rows.join(small(met, 200_000), "key", "left")
    names = []
    for r in rules:
        full = trigram_query(r.pattern) is True
        guard = F.lit(True) if full else F.coalesce(F.array_contains("rules", r.kind), F.lit(False))
        seen = found(F.col("text"), r.pattern, r.group, guard)
        names.append(f"__{r.kind}")
        both = both.withColumn(names[-1], F.filter(seen, _long_enough(r.least)))
    all_ = F.concat(*[tagged(F.col(n), i, r.kind, r.base) for i, (n, r) in enumerate(zip(names, rules))])
    return both.withColumn(out, F.array_sort(all_)).drop("key", "rules", *names)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, index: DataFrame | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans: one row per row of docs.

    A null text counts as empty; empty texts give no spans. Repeated rows and ids give rows each, an empty table an empty
    one; other columns are not looked at, whatever their names.
    """
    seen = with_spans(docs.select("doc_id", "text"), rules, "all", index)
    counts = [number_of(F.col("all"), r.kind).alias(f"n_{r.kind}") for r in rules if r.base]
    return seen.select("doc_id", *counts, F.sha2(listed(F.filter("all", lambda s: s["base"])), 256).alias("base_sha256"), listed(F.col("all")).alias("spans"))


def matches_by_rule(text: str, rules: tuple[Rule, ...] = RULES) -> list[tuple[int, int, int, str]]:
    """Brute force, for tests: start, rank, end, kind of all matches, by the standard library."""
    out = []
    for i, r in enumerate(rules):
        out += [(m.start(), i, m.end(), r.kind) for m in re.finditer(r.pattern, text) if len(m.group(r.group)) >= r.least]
    return sorted(out)
