"""Secret scan by a trigram inverted index (DataFrame functions only).

1. ``trigram_query`` derives from each rule's pattern a Boolean query over
   lower-cased trigrams: an AND of clauses, each an OR of trigram sets, that
   every text with a match must satisfy.
2. ``build_index`` makes posting lists (trigram -> documents) for the trigrams
   that the queries name. The index is cut into blocks of documents by a hash,
   so that a posting list of a frequent trigram, or of a trigram that a third of all
   documents hold, never grows beyond its block.
3. ``candidates`` evaluates the queries on the posting lists: intersections
   within a set, unions within a clause, intersections over clauses.
4. ``scan`` verifies the candidates with the pattern itself; rules without a
   mandatory trigram (long hex runs) scan every text.

Offsets are code points, ends exclusive. Edge cases: a null or empty text has
no span; a null id is an id like any other; rows with an equal id share
candidates and are verified on their own; repeated rows each give a row; an empty
table gives an empty result; other columns of the input are ignored by ``scan``.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product
from re import _constants as rc  # the parsed form of a pattern
from re import _parser as rp

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.llm.common import fresh
from rillflow.session import materialize

#: documents per index block: bounds each block's posting lists
BLOCK_DOCS = 20_000
#: alternatives that a literal run may have before it is cut
MAX_ALTERNATIVES = 64


@dataclass(frozen=True)
class Rule:
    """``group``'s text must have ``least`` characters, else the match is dropped."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: fixed by the contract of the base spans, in the order of their kinds
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
         r"([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    # the runs of 24 and more are the same as those of [0-9a-f]+ that pass
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
#: a PEM key: the marker, then all up to the END line that is the next marker; without one,
#: header lines and the run of base64 lines, a last short one if alone on its line (white
#: space may be escaped, or lines quoted; possessive loops need no stack)
_GAP = r"""(?:[\s"'+,;>#*|]|\\+[nrt])"""
_PEM = (r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
        r"(?:(?:[^-]++|-(?!----))*+-----END [A-Z ]*PRIVATE KEY-----"
        rf"|(?:{_GAP}++[A-Z][A-Za-z-]+:[^\n\\]*+)*+(?:{_GAP}++[A-Za-z0-9+/]{{16,}}+={{0,2}})++"
        r"""(?:[ \t"'+]*+(?:\r|\\+r)?(?:\n|\\+n)[ \t"'+>#*|]*+[A-Za-z0-9+/]{1,15}+={0,2}"""
        r"""(?=[ \t"'+,;]*(?:[\r\n]|\\+[rn]|\Z)))?+)?+""")
#: further credentials with telling prefixes
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", _PEM),
)
RULES = BASE_RULES + MORE_RULES

Clause = frozenset  # of frozensets of trigrams: any one set, all of its trigrams


def _strings(items) -> set[str] | None:
    """All texts that a parsed pattern can match, lower-cased; None if there are
    too many to list."""
    out = {""}
    for op, av in items:
        if op is rc.LITERAL:
            part = {chr(av).lower()}
        elif op is rc.IN and all(o is rc.LITERAL for o, _ in av):
            part = {chr(v).lower() for _, v in av}
        elif op is rc.SUBPATTERN:
            part = _strings(av[3])
        elif op is rc.BRANCH:
            parts = [_strings(x) for x in av[1]]
            part = None if None in parts else set().union(*parts)
        elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT) and av[1] <= 8:
            one = _strings(av[2])
            part = None if one is None or len(one) ** av[1] > MAX_ALTERNATIVES else {
                "".join(x) for n in range(av[0], av[1] + 1) for x in product(one, repeat=n)}
        elif op is rc.AT:
            part = {""}
        else:
            part = None
        if part is None or len(out) * len(part) > MAX_ALTERNATIVES:
            return None
        out = {a + b for a in out for b in part}
    return out


def _clause(strings: set[str]) -> Clause | None:
    """None: it holds for every text."""
    sets = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings}
    if frozenset() in sets:
        return None
    return frozenset(s for s in sets if not any(t < s for t in sets))


def _clauses(items) -> set[Clause]:
    found, run = set(), {""}

    def cut():
        if clause := _clause(run):
            found.add(clause)

    for op, av in items:
        part = _strings([(op, av)])
        if part is not None and len(run) * len(part) <= MAX_ALTERNATIVES:
            run = {a + b for a in run for b in part}
            continue
        once = _strings(av[2]) if op in (rc.MAX_REPEAT, rc.MIN_REPEAT) and av[0] else None
        if part is None and once and len(run) * len(once) <= MAX_ALTERNATIVES:
            run = {a + b for a in run for b in once}  # one time at its start
            cut()
            run = once  # and one at its end
            continue
        cut()
        run = part if part is not None else {""}
        if part is None and op is rc.SUBPATTERN:
            found |= _clauses(av[3])
        elif part is None and op in (rc.MAX_REPEAT, rc.MIN_REPEAT) and av[0] >= 1:
            found |= _clauses(av[2])
    cut()
    return found


def trigram_query(pattern: str) -> list[Clause]:
    """The clauses that the lower-cased text of any match satisfies; empty if the
    pattern has no mandatory trigram."""
    return sorted(_clauses(rp.parse(pattern)), key=lambda c: sorted(map(sorted, c)))


def build_index(docs: DataFrame, key: str, text: str, trigrams: list[str]) -> DataFrame:
    """(block, trigram -> posting list) over the named trigrams."""
    blocks = max(1, -(-docs.count() // BLOCK_DOCS))
    low = F.lower(F.col(text))
    held = F.filter(F.array(*[F.when(F.contains(low, F.lit(g)), F.lit(g)) for g in trigrams]),
                    lambda g: g.isNotNull())
    postings = docs.select(F.col(key), F.explode(held).alias("trigram"))
    lists = postings.groupBy(F.pmod(F.hash(key), F.lit(blocks)).alias("block"), "trigram") \
        .agg(F.collect_set(key).alias("ids"))
    return lists.groupBy("block").agg(
        F.map_from_entries(F.collect_list(F.struct("trigram", "ids"))).alias("postings"))


def candidates(index: DataFrame, queries: dict[int, list[Clause]], key: str) -> DataFrame:
    """(key, bits): bit ``i`` is set if the document satisfies rule ``i``'s query."""
    none = F.array().cast("array<bigint>")

    def ids(g: str) -> Column:
        return F.coalesce(F.try_element_at("postings", F.lit(g)), none)

    def all_of(parts: list[Column], join) -> Column:
        out = parts[0]
        for p in parts[1:]:
            out = join(out, p)
        return out

    def of(query: list[Clause]) -> Column:
        return all_of([all_of([all_of([ids(g) for g in sorted(s)], F.array_intersect)
                               for s in sorted(c, key=sorted)], F.array_union)
                       for c in query], F.array_intersect)

    per_rule = F.array(*[F.struct(F.lit(1 << i).cast("bigint").alias("bit"), of(q).alias("ids"))
                         for i, q in queries.items()])
    return (index.select(F.inline(per_rule)).select("bit", F.explode("ids").alias(key))
            .groupBy(key).agg(F.bit_or("bit").alias("bits")))


SPANS = "array<struct<start:bigint,end:bigint>>"


def match_spans(text: Column, rule: Rule) -> Column:
    """Leftmost non-overlapping matches of a rule that pass its least length:
    the texts between the matches and the matches themselves give the offsets."""
    p = F.lit(rule.pattern)
    sizes = F.arrays_zip(
        F.transform(F.split(text, rule.pattern, -1), F.length).alias("gap"),
        F.transform(F.regexp_extract_all(text, p, F.lit(0)), F.length).alias("len"),
        F.transform(F.regexp_extract_all(text, p, F.lit(rule.group)), F.length).alias("val"))

    def step(acc, x):
        start = acc["at"] + x["gap"]
        end = start + F.coalesce(x["len"], F.lit(0))
        return F.struct(end.cast("bigint").alias("at"), F.when(
            x["val"] >= rule.least,
            F.array_append(acc["out"], F.struct(start.cast("bigint").alias("start"),
                                                end.cast("bigint").alias("end"))))
            .otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(SPANS).alias("out"))
    found = F.aggregate(sizes, start, step, lambda acc: acc["out"])
    return F.when(text.rlike(rule.pattern), found).otherwise(F.array().cast(SPANS))


def with_spans(docs: DataFrame, out: str, id_col: str = "doc_id", text_col: str = "text",
               rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` plus ``out``: all spans, array of (start, rank, kind, end) by start,
    then by the rules' order."""
    key, bits = fresh(docs, "_key", "_bits")
    queries = {i: q for i, r in enumerate(rules) if (q := trigram_query(r.pattern))}
    keyed = docs.withColumn(key, F.xxhash64(id_col))  # equal keys only add candidates
    hits = None
    if queries:
        grams = sorted({g for q in queries.values() for c in q for s in c for g in s})
        index = build_index(keyed.select(key, text_col), key, text_col, grams)
        # a table of its own: its size, known from its files, picks the join
        hits = materialize(candidates(index, queries, key)
                           .withColumnRenamed("bits", bits), "secret-candidates")
        keyed = keyed.join(hits, key, "left")
    none, text = F.array().cast(SPANS), F.col(text_col)
    parts = []
    for i, r in enumerate(rules):
        found = match_spans(text, r)
        if i in queries:
            found = F.when(F.col(bits).bitwiseAND(F.lit(1 << i)) != 0, found).otherwise(none)
        parts.append(F.transform(F.coalesce(found, none), _ranked(i, r.kind)))
    return keyed.withColumn(out, F.array_sort(F.concat(*parts))).drop(key, bits)


def _ranked(i: int, kind: str):
    return lambda s: F.struct(s["start"].alias("start"), F.lit(i).alias("rank"),
                              F.lit(kind).alias("kind"), s["end"].alias("end"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row of ``docs``: its id and ``spans``."""
    return with_spans(docs.select(id_col, text_col), "spans", id_col, text_col, rules) \
        .select(id_col, "spans")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with every span, overlapping ones together, replaced by ``mark``."""
    def step(acc, s):
        cut = F.substring(text, (acc["at"] + 1).cast("int"),
                          (s["start"] - acc["at"]).cast("int"))
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] >= acc["at"], F.concat(acc["out"], cut, F.lit(mark)))
            .otherwise(acc["out"]).alias("out"))

    return F.aggregate(
        spans, F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out")), step,
        lambda acc: F.concat(acc["out"], F.substring(
            text, (acc["at"] + 1).cast("int"), F.length(text))))
