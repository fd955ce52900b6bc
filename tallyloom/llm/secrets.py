"""Secret scan: a trigram inverted index proposes documents for each rule, the rule's regex verifies them.

DataFrame functions only.  A rule's regex yields a Boolean query (an OR of ANDs of
trigrams that any match must hold); only those trigrams are indexed.  Postings are
intersected by counting; rules without mandatory trigrams scan every text.
"""

from __future__ import annotations

import re._constants as op
import re._parser as parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import table

GAP = None
MOST_ALTERNATIVES = 64  # of a regex's literal spellings; more count as "anything"


@dataclass(frozen=True)
class Rule:
    """kind; regex; the group whose length counts and its least length; base: given from outside, order kept."""

    kind: str
    regex: str
    group: int = 0
    least: int = 0
    base: bool = True


# The base rules' patterns.  Runs of one class are maximal, so the last two
# may ask for their least length in the pattern.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", base=False),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", base=False),
)


def _spellings(nodes) -> list[tuple]:
    """What a regex's matches look like: sequences of lower-case characters and GAPs."""
    out: list[tuple] = [()]
    for kind, value in nodes:
        if kind is op.LITERAL:
            part = [(chr(value).lower(),)]
        elif kind is op.SUBPATTERN:
            part = _spellings(value[-1])
        elif kind is op.BRANCH:
            part = [s for branch in value[1] for s in _spellings(branch)]
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
            least, most, inner = value
            once = _spellings(inner)
            part = [s + (() if most == 1 else (GAP,)) for s in once] if least else [(), *once] if most == 1 else [(GAP,)]
            part = [(GAP,)] if not least and any(GAP in s for s in part) else part
        else:
            part = [(GAP,)]
        out = [a + b for a in out for b in part]
        if len(out) > MOST_ALTERNATIVES:
            out = [(GAP,)]
    return out


def trigram_query(regex: str) -> list[frozenset[str]] | None:
    """The Boolean query: a text can match only if it holds, in lower case, all trigrams of
    one of the sets.  None if some spelling has no trigram at all."""
    clauses = set()
    for spelling in _spellings(parser.parse(regex)):
        runs = "".join("\0" if c is GAP else c for c in spelling).split("\0")
        clause = frozenset(run[i : i + 3] for run in runs for i in range(len(run) - 2))
        if not clause or not all(t.isascii() for t in clause):
            return None
        clauses.add(clause)
    return sorted((c for c in clauses if not any(d < c for d in clauses)), key=sorted)


def candidates(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, rules): for each document id in the index, the rules whose query its texts satisfy."""
    queries = {r.kind: trigram_query(r.regex) for r in rules}
    clauses = [(kind, n, t, len(c)) for kind, q in queries.items() for n, c in enumerate(q or []) for t in sorted(c)]
    vocabulary = sorted({t for _, _, t, _ in clauses})
    low = docs.select("doc_id", F.lower("text").alias("text"))
    held = F.array_compact(F.array(*[F.when(F.contains("text", F.lit(t)), F.lit(t)) for t in vocabulary])) if vocabulary else F.array().cast("array<string>")
    postings = low.select("doc_id", F.explode(held).alias("trigram")).distinct()
    rows = F.array(*[F.struct(F.lit(k).alias("rule"), F.lit(n).alias("clause"), F.lit(t).alias("trigram"), F.lit(s).alias("size")) for k, n, t, s in clauses])
    wanted = docs.sparkSession.range(1).select(F.inline(rows)) if clauses else docs.sparkSession.sql("SELECT '' rule, 0 clause, '' trigram, 1 size LIMIT 0")
    met = postings.join(F.broadcast(wanted), "trigram").groupBy("doc_id", "rule", "clause", "size").agg(F.count("*").alias("n"))
    return met.where("n = size").groupBy("doc_id").agg(F.collect_set("rule").alias("rules"))


def found(text: Column, rule: Rule) -> Column:
    """The rule's spans (start, end) in code points, leftmost and non-overlapping.

    Regexes give no positions; they follow from the lengths of the pieces between matches."""
    whole, part = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(0)), F.regexp_extract_all(text, F.lit(rule.regex), F.lit(rule.group))
    steps = F.arrays_zip(whole.alias("whole"), part.alias("part"), F.slice(F.split(text, rule.regex, -1), F.lit(1), F.size(whole)).alias("gap"))
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["gap"])
        end = start + F.length(x["whole"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(F.length(x["part"]) >= rule.least, F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    return F.aggregate(steps, F.struct(F.lit(0).alias("at"), empty.alias("spans")), step, lambda s: s["spans"])


def labelled(spans: Column, n: int, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(n).alias("kind_no"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def of_kind(spans: str, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def secret_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, spans) per row of docs; spans: array of (start, kind_no, end, kind), in that order.

    A null text has no spans.  The index is by doc_id, which need not be unique or known:
    rows that share an id share candidates, and the regex decides for each row.  Other
    columns aren't read.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    met = candidates(docs, rules).select(F.col("doc_id").alias("_id"), "rules")
    joined = docs.join(met.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    none = F.array().cast("array<struct<start:int,end:int>>")
    parts = []
    for n, rule in enumerate(rules):
        spans = found(F.col("text"), rule)
        if trigram_query(rule.regex) is None:
            spans = F.when(F.col("text").rlike(rule.regex), spans).otherwise(none)
        else:
            spans = F.when(F.array_contains("rules", rule.kind), spans).otherwise(none)
        parts.append(labelled(spans, n, rule.kind))
    return joined.select("doc_id", F.array_sort(F.concat(*parts)).alias("spans"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = [r.kind for r in RULES if r.base]
    rows = secret_spans(table(spark, sf_dir, "documents"))

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    counts = [F.size(of_kind("spans", k)).cast("long").alias(f"n_{k}") for k in base]
    of_base = F.filter("spans", lambda s: s["kind_no"] < len(base))
    return rows.select("doc_id", *counts, F.sha2(listed(of_base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def sql() -> str:
    """The same result by a full scan with every rule."""
    base = sum(r.base for r in RULES)
    parts = []
    for n, r in enumerate(RULES):
        p = "'" + r.regex.replace("'", "''") + "'"
        parts.append(
            f"""list_filter(list_transform(range(1, len(regexp_extract_all(t, {p})) + 1), lambda i: struct_pack(
              s := coalesce(list_sum(list_transform(string_split_regex(t, {p})[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(regexp_extract_all(t, {p})[1:i-1], lambda x: length(x))), 0),
              n := {n}, e := coalesce(list_sum(list_transform(string_split_regex(t, {p})[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(regexp_extract_all(t, {p})[1:i], lambda x: length(x))), 0),
              k := '{r.kind}', g := length(regexp_extract_all(t, {p}, {r.group})[i]))), lambda x: x.g >= {r.least})"""
        )
    listed = "coalesce(array_to_string(list_transform({}, lambda x: x.k || ':' || x.s::BIGINT || ':' || x.e::BIGINT), ','), '')"
    counts = ", ".join(f"len(list_filter(a, lambda x: x.n = {n}))::BIGINT AS n_{r.kind}" for n, r in enumerate(RULES) if r.base)
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
      a AS (SELECT doc_id, list_sort(flatten([{", ".join(parts)}])) AS a FROM d)
      SELECT doc_id, {counts}, sha256({listed.format(f"list_filter(a, lambda x: x.n < {base})")}) AS base_sha256, {listed.format("a")} AS spans FROM a"""
