"""Secret scans over a trigram inverted index, in DataFrame functions only.

From every rule's pattern a Boolean query over lower-cased trigrams is derived: whatever the pattern matches contains
them. The index holds a posting (trigram, document) for each trigram that some query names; intersecting postings
leaves the candidates of each rule, which its pattern then verifies over the whole text. A rule without mandatory
trigrams has no query and scans every text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product
from re import _constants as C
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``group`` of a match must have ``least`` characters; matches that do not are dropped after matching."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False


RULES = (
    # fixed values: the three base rules
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, True),
    Rule("access", "AKIA[A-Z0-9]+", 0, 18, True),
    Rule("hex", "[0-9a-f]+", 0, 16, True),
    # formats that public services document for their keys
    Rule("github", "gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("google", "AIza[A-Za-z0-9_-]+", 0, 39),
    Rule("stripe", "[rs]k_live_[A-Za-z0-9]+", 0, 24),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
)
ALTERNATIVES = 8  # literal alternatives followed at once; more end the literal run (the query gets weaker, not wrong)


def _choices(op, value) -> list[str] | None:
    """The few literal strings a pattern element can be; None if there are many."""
    if op is C.LITERAL:
        return [chr(value)]
    if op is C.IN and all(kind is C.LITERAL for kind, _ in value):
        return [chr(v) for _, v in value]
    if op is C.SUBPATTERN:
        return _strings(value[3])
    if op is C.BRANCH:
        parts = [_strings(branch) for branch in value[1]]
        return None if any(p is None for p in parts) else [s for p in parts for s in p]
    if op is C.MAX_REPEAT and value[1] <= 2:
        own = _strings(value[2])
        return None if own is None else ["".join(t) for n in range(value[0], value[1] + 1) for t in product(own, repeat=n)]
    return None


def _strings(sequence) -> list[str] | None:
    out = [""]
    for op, value in sequence:
        own = _choices(op, value)
        if own is None or len(own) * len(out) > ALTERNATIVES:
            return None
        out = [a + b for a in out for b in own]
    return out


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """All of the lists must hold; a list holds if all trigrams of one of its sets occur. Empty: no mandatory trigram."""
    query, run = [], [""]

    def close() -> None:
        sets = [frozenset(s.lower()[i:i + 3] for i in range(len(s) - 2)) for s in run]
        if all(sets):
            query.append(sorted(set(sets), key=sorted))
        run[:] = [""]

    def walk(sequence) -> None:
        for op, value in sequence:
            own = _choices(op, value)
            if own is not None and len(own) * len(run) <= ALTERNATIVES:
                run[:] = [a + b for a in run for b in own]
                continue
            close()
            if own is not None and len(own) <= ALTERNATIVES:
                run[:] = own
            elif op is C.SUBPATTERN:
                walk(value[3])
                close()
            elif op is C.MAX_REPEAT and value[0] >= 1:
                walk(value[2])
                close()

    walk(parser.parse(pattern))
    close()
    return query


def postings(texts: DataFrame, rules=RULES) -> DataFrame:
    """(trigram, key): the inverted index of ``texts`` (key, text), for the trigrams that the rules' queries name."""
    names = sorted({t for r in rules for either in trigram_query(r.pattern) for one in either for t in one})
    lowered = texts.select("key", F.lower("text").alias("__low"))
    present = F.array_compact(F.array(*[F.when(F.contains("__low", F.lit(t)), F.lit(t)) for t in names]))
    return lowered.select("key", F.explode(present).alias("trigram"))


def candidates(index: DataFrame, rules=RULES) -> DataFrame:
    """(key, kinds): the rules whose postings intersect at the document."""
    found = index.groupBy("key").agg(F.collect_set("trigram").alias("have"))  # at most the named trigrams

    def holds(query) -> Column:
        out = F.lit(True)
        for either in query:
            some = F.lit(False)
            for one in either:
                every = F.lit(True)
                for t in sorted(one):
                    every = every & F.array_contains("have", t)
                some = some | every
            out = out & some
        return out

    kinds = [F.when(holds(q), F.lit(r.kind)) for r in rules if (q := trigram_query(r.pattern))]
    return found.select("key", F.array_compact(F.array(*kinds)).alias("kinds")).where(F.size("kinds") > 0)


def _located(rule: Rule, order: int, scanned: Column) -> list[Column]:
    """Matches, tested groups and the texts between matches, where the rule is scanned and matches at all."""
    text, pattern = F.col("text"), F.lit(rule.pattern)
    hit = scanned & text.rlike(f"[0-9a-f]{{{rule.least}}}" if rule.kind == "hex" else rule.pattern)
    none = F.array().cast("array<string>")
    return [F.when(hit, e).otherwise(none) for e in (
        F.regexp_extract_all(text, pattern, F.lit(0)), F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.split(text, rule.pattern, -1))]


BLOCK = 256


def _spans(rule: Rule, order: int) -> Column:
    """[(start, order, end)] of the rule's matches: running lengths of gaps and matches. Spans are gathered in blocks, so
    a text with many matches does not copy all of them for each."""
    m, g, p = (f"`__{part}{order}`" for part in "mgp")
    kind = "array<struct<start:bigint,ord:int,end:bigint>>"
    keep = f"length({g}[i]) >= {rule.least}"
    start, end = f"a.at + length({p}[i])", f"a.at + length({p}[i]) + length({m}[i])"
    span = f"named_struct('start', {start}, 'ord', {order}, 'end', {end})"
    full = f"size(a.open) >= {BLOCK}"
    return F.expr(f"""CASE WHEN size({m}) = 0 THEN CAST(array() AS {kind}) ELSE aggregate(sequence(0, size({m}) - 1),
      named_struct('at', 0L, 'done', CAST(array() AS array<{kind}>), 'open', CAST(array() AS {kind})),
      (a, i) -> named_struct('at', {end},
        'done', CASE WHEN {full} THEN array_append(a.done, a.open) ELSE a.done END,
        'open', CASE WHEN {keep} THEN array_append(CASE WHEN {full} THEN CAST(array() AS {kind}) ELSE a.open END, {span})
                     WHEN {full} THEN CAST(array() AS {kind}) ELSE a.open END),
      a -> concat(flatten(a.done), a.open)) END""")


def scan(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``secret_spans array<struct<start,kind,end>>`` by start, then order of the rules.

    Positions count code points, ends are exclusive. Matches of one rule are leftmost and do not overlap; different
    rules may overlap. A null or empty text has no spans. Rows with null or repeated ids are scanned like any other (an
    id only brings candidates together; the pattern decides on each text). An existing ``secret_spans`` is replaced.
    """
    kept = [c for c in docs.columns if c != "secret_spans"]
    rows = docs.select(*[F.col(f"`{c}`").alias(f"__own{k}") for k, c in enumerate(kept)],
                       F.coalesce(docs[id_col].cast("string"), F.lit("")).alias("key"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    found = candidates(postings(rows.select("key", "text"), rules), rules)
    out = rows.join(found, "key", "left")
    for k, rule in enumerate(rules):
        scanned = F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False)) if trigram_query(rule.pattern) else F.lit(True)
        own = _located(rule, k, scanned)
        out = out.withColumns({f"__{part}{k}": e for part, e in zip("mgp", own)})
    spans = out.select(*[F.col(f"__own{k}") for k in range(len(kept))], F.array_sort(F.concat(*[_spans(r, k) for k, r in enumerate(rules)])).alias("__spans"))
    names = F.array(*[F.lit(r.kind) for r in rules])
    named = F.transform("__spans", lambda s: F.struct(s["start"].alias("start"), F.get(names, s["ord"]).alias("kind"), s["end"].alias("end")))
    return spans.select(*[F.col(f"__own{k}").alias(c) for k, c in enumerate(kept)], named.alias("secret_spans"))


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(scanned: DataFrame, rules=RULES, id_col: str = "doc_id") -> DataFrame:
    """Per document the number of base spans of each kind, the digest of the base spans, and all spans."""
    base = [r.kind for r in rules if r.base]
    spans = F.col("secret_spans")
    own = F.filter(spans, lambda s: s["kind"].isin(base))

    def of(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    counts = [of(k).alias(f"n_{k}") for k in base]
    return scanned.select(F.col(id_col).alias("doc_id"), *counts, F.sha2(written(own), 256).alias("base_sha256"), written(spans).alias("spans"))


def redacted(scanned: DataFrame, text_col: str = "text", mask: str = "[secret]") -> DataFrame:
    """The scanned rows with every span (overlapping ones together) replaced by ``mask``; ``secret_spans`` is dropped."""
    kind = "array<string>"
    body = F.expr(f"""aggregate(secret_spans, named_struct('at', 0L, 'out', CAST(array() AS {kind})),
      (a, s) -> CASE WHEN s.end <= a.at THEN a
        WHEN s.start < a.at THEN named_struct('at', s.end, 'out', a.out)
        ELSE named_struct('at', s.end, 'out', concat(a.out, array(substring(`{text_col}`, CAST(a.at AS INT) + 1, CAST(s.start - a.at AS INT)), '{mask}'))) END,
      a -> concat(array_join(a.out, ''), substring(`{text_col}`, CAST(a.at AS INT) + 1)))""")
    return scanned.withColumn(text_col, F.when(F.size("secret_spans") > 0, body).otherwise(F.col(text_col))).drop("secret_spans")


def oracle_sql(rules=RULES) -> str:
    """The digest of ``documents`` by full scans."""
    quoted = [r.pattern.replace("'", "''") for r in rules]
    scans = " UNION ALL ".join(
        f"""SELECT doc_id, {k} AS ord, '{r.kind}' AS kind, i, length(pieces[i]) AS gap, length(hits[i]) AS size, length(groups[i]) >= {r.least} AS keep
  FROM (SELECT doc_id, string_split_regex(text, '{q}') AS pieces, regexp_extract_all(text, '{q}', 0) AS hits,
        regexp_extract_all(text, '{q}', {r.group}) AS groups FROM documents), unnest(range(1, len(hits) + 1)) AS u(i)"""
        for k, (r, q) in enumerate(zip(rules, quoted)))
    base = [r.kind for r in rules if r.base]
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in base)
    listed = ", ".join(f"'{k}'" for k in base)
    return f"""
WITH found AS ({scans}),
placed AS (SELECT *, sum(gap + size) OVER (PARTITION BY doc_id, ord ORDER BY i)::BIGINT AS stop FROM found),
kept AS (SELECT doc_id, ord, kind, stop - size AS start, kind || ':' || (stop - size) || ':' || stop AS span FROM placed WHERE keep),
joined AS (SELECT doc_id, {counts},
  coalesce(string_agg(span, ',' ORDER BY start, ord) FILTER (WHERE kind IN ({listed})), '') AS base, string_agg(span, ',' ORDER BY start, ord) AS spans
  FROM kept GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in base)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN joined USING (doc_id)"""
