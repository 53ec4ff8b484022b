"""Secrets: a trigram inverted index names the documents each rule has to look at.

For every rule a Boolean query over trigrams is derived from its regular expression: the literal
runs that any match contains, as a disjunction of conjunctions. Only trigrams of these queries
are indexed. The index holds postings (trigram, doc_id); intersecting them gives the rules a
document has to be checked for, and its text is matched against those alone. Rules without a
mandatory trigram (long hexadecimal runs) scan every text.

Null or empty text: no spans. A document without an id cannot be indexed and is checked for every
rule. Repeated rows with one id share its postings and are verified each on its own text.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import product
from re import _constants as rc
from re import _parser as rp

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rigpulse.llm.common import joined_spans, of_kind, spans


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    least: int = 0  # code points of the group
    group: int = 0
    base: bool = False

    def keep(self, hit: Column) -> Column:
        part = hit if not self.group else F.regexp_extract(hit, self.pattern, self.group)
        return F.char_length(part) >= self.least


# The first three are the base rules (fixed values).
RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        8, 2, True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 16, 0, True),
    Rule("hex", r"[0-9a-f]+", 32, 0, True),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}+"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}+"),
    Rule("cloud", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("payment", r"sk_live_[0-9A-Za-z]{16,}+"),
    Rule("signed", r"eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+"),
    Rule("pem", r"-----BEGIN [A-Z ]*?PRIVATE KEY-----"),
)
KINDS = tuple(r.kind for r in RULES)
# A faster form with the same matches of 32 and more.
_SCANNED = {"hex": r"(?<![0-9a-f])[0-9a-f]{32,}+"}

# A class or repetition is spelled out up to this many strings, a conjunction keeps this many
# trigrams. Both only make a query looser: a document may be checked in vain, never missed.
MAX_STRINGS, MAX_TRIGRAMS = 16, 4


def _strings(items) -> list[tuple[list[str], bool]]:
    """All ways a parsed sequence can be spelled, each a list of literal runs that it contains.

    The flag tells whether the last run is still open, that is, adjacent to what follows.
    """
    ways: list[tuple[list[str], bool]] = [([""], True)]

    def add(parts: list[list[str]], whole: bool) -> None:
        """parts: runs each alternative adds; whole: the alternative is exactly its single run."""
        nonlocal ways
        made = []
        for (runs, open_), new in product(ways, parts):
            if whole and open_:
                made.append(([*runs[:-1], runs[-1] + new[0]], True))
            elif whole:
                made.append(([*runs, new[0]], True))
            else:
                made.append(([*runs, *new], False))
        if len(made) > MAX_STRINGS:
            ways = [(runs, False) for runs, _ in ways]
        else:
            ways = made

    def stop() -> None:
        nonlocal ways
        ways = [(runs, False) for runs, _ in ways]

    for op, arg in items:
        if op is rc.LITERAL:
            add([[chr(arg).lower()]], True)
        elif op is rc.IN:
            chosen = [chr(a).lower() for o, a in arg if o is rc.LITERAL]
            small = len(chosen) == len(arg) <= MAX_STRINGS
            add([[c] for c in dict.fromkeys(chosen)], True) if small else stop()
        elif op is rc.SUBPATTERN:
            inner = _strings(arg[3])
            if all(open_ and len(runs) == 1 for runs, open_ in inner):
                add([runs for runs, _ in inner], True)
            else:
                add([runs for runs, _ in inner], False)
        elif op is rc.BRANCH:
            inner = [way for branch in arg[1] for way in _strings(branch)]
            add([runs for runs, _ in inner], all(o and len(r) == 1 for r, o in inner))
        elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT) and arg[:2] == (0, 1):
            inner = _strings(arg[2])
            if all(o and len(r) == 1 for r, o in inner):
                add([[""], *(r for r, _ in inner)], True)
            else:
                stop()
        elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT) and arg[0] >= 1:
            inner = _strings(arg[2])
            if len(inner) == 1 and inner[0][1] and len(inner[0][0]) == 1:
                add([[inner[0][0][0] * arg[0]]], True)
            else:
                add([runs for runs, _ in inner], False)
            if arg[0] != arg[1]:
                stop()
        else:
            stop()
    return ways


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Any-of-all-of trigrams of the lower-cased text; None when some match may hold none."""
    query = []
    for runs, _ in _strings(rp.parse(pattern)):
        grams = [run[i : i + 3] for run in runs for i in range(len(run) - 2)]
        if not grams:
            return None
        step = max(1, len(grams) // MAX_TRIGRAMS)
        query.append(frozenset(grams[::step][:MAX_TRIGRAMS]))
    return list(dict.fromkeys(query))


def queries_of(rules: tuple[Rule, ...]) -> dict[str, list[frozenset[str]] | None]:
    return {r.kind: trigram_query(r.pattern) for r in rules}


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """(trigram, doc_id) for the trigrams that each lower-cased text contains."""
    low = docs.where(F.col("doc_id").isNotNull()).select("doc_id", F.lower("text").alias("low"))
    has = [F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams]
    return low.select(F.explode(F.array_compact(F.array(*has))).alias("trigram"), "doc_id")


def to_check(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, check): the kinds whose trigram queries the document's postings satisfy."""
    queries = {k: q for k, q in queries_of(rules).items() if q}
    place = {t: i for i, t in enumerate(sorted({t for q in queries.values() for c in q for t in c}))}
    if not place:
        return index.select("doc_id", F.array().cast("array<string>").alias("check")).limit(0)
    words = len(place) // 62 + 1
    at = F.create_map(*(x for t, i in place.items() for x in (F.lit(t), F.lit(i))))
    numbered = index.select("doc_id", at[F.col("trigram")].alias("at"))
    one = lambda w: F.when(
        F.floor(F.col("at") / 62) == w, F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at") % 62)
    )
    masks = numbered.groupBy("doc_id").agg(
        *(F.coalesce(F.bit_or(one(w)), F.lit(0).cast("long")).alias(f"m{w}") for w in range(words))
    )

    def all_of(conjunct: frozenset[str]) -> Column:
        parts = []
        for w in range(words):
            need = sum(1 << (place[t] % 62) for t in conjunct if place[t] // 62 == w)
            if need:
                parts.append(F.col(f"m{w}").bitwiseAND(F.lit(need)) == F.lit(need))
        return reduce(lambda a, b: a & b, parts)

    checks = [
        F.when(reduce(lambda a, b: a | b, map(all_of, q)), F.lit(k)) for k, q in queries.items()
    ]
    return masks.select("doc_id", F.array_compact(F.array(*checks)).alias("check")).where(
        F.size("check") > 0
    )


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with ``found_<kind>`` (spans of each rule) added; other columns stay."""
    queries = queries_of(rules)
    grams = sorted({t for q in queries.values() if q for c in q for t in c})
    check = to_check(postings(docs, grams), rules).withColumnRenamed("doc_id", "_id")
    every = F.array(*(F.lit(r.kind) for r in rules))
    rows = docs.join(check, docs["doc_id"] == F.col("_id"), "left").withColumn(
        "_check",
        F.when(docs["doc_id"].isNull(), every).otherwise(
            F.coalesce("check", F.array().cast("array<string>"))
        ),
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.array().cast("array<struct<rank:int,start:int,end:int,kind:string>>")
    for i, r in enumerate(rules):
        found = of_kind(spans(text, _SCANNED.get(r.kind, r.pattern), r.keep), r.kind, i)
        if queries[r.kind]:
            found = F.when(F.array_contains("_check", r.kind), found).otherwise(none)
        rows = rows.withColumn(f"found_{r.kind}", found)
    return rows.drop("_id", "check", "_check")


def by_start(found: Column) -> Column:
    """The spans by start, then kind in the order of the rules."""
    moved = F.transform(
        found,
        lambda s: F.struct(
            s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"),
            s["kind"].alias("kind"),
        ),
    )
    return F.array_sort(moved)


def added(rules: tuple[Rule, ...] = RULES) -> Column:
    """Spans of the further rules that overlap no base span."""
    base = F.concat(*(F.col(f"found_{r.kind}") for r in rules if r.base))
    more = F.concat(*(F.col(f"found_{r.kind}") for r in rules if not r.base))
    return F.filter(
        more, lambda m: ~F.exists(base, lambda b: (b["start"] < m["end"]) & (b["end"] > m["start"]))
    )


def report(docs: DataFrame) -> DataFrame:
    """The contract's columns, derived from the spans."""
    base = F.concat(*(F.col(f"found_{r.kind}") for r in RULES if r.base))
    found = scan(docs.select("doc_id", "text")).withColumn("_added", added())
    return found.select(
        "doc_id",
        *(F.size(f"found_{r.kind}").cast("long").alias(f"n_{r.kind}") for r in RULES if r.base),
        F.sha2(joined_spans(by_start(base)), 256).alias("base_sha256"),
        joined_spans(by_start(F.concat(base, "_added"))).alias("spans"),
        F.size("_added").cast("long").alias("n_added"),
    )


def redacted(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span replaced by the mark and n_chars counted anew."""
    names = docs.columns
    every = F.concat(*(F.col(f"found_{r.kind}") for r in RULES))
    text = F.col("text")
    piece = lambda a, b: F.substring(text, a + 1, F.greatest(b - a, F.lit(0)))

    def step(state: Column, s: Column) -> Column:
        """Copy up to the span and mark it; a span that begins inside the last one prolongs it."""
        fresh = s["start"] >= state["pos"]
        out = F.concat(state["out"], piece(state["pos"], s["start"]), F.lit(mark))
        return F.struct(
            F.when(fresh, out).otherwise(state["out"]).alias("out"),
            F.greatest(state["pos"], s["end"]).alias("pos"),
        )

    replaced = F.aggregate(
        by_start(every),
        F.struct(F.lit("").alias("out"), F.lit(0).alias("pos")),
        step,
        lambda state: F.concat(state["out"], piece(state["pos"], F.char_length(text))),
    )
    changed = F.when(F.size(every) > 0, replaced).otherwise(text)
    # The row travels in a struct, so that its other columns may have any name.
    rest = F.struct(F.lit(0).alias("_"), *(docs[n] for n in names if n not in ("text", "n_chars")))
    rows = docs.select("doc_id", "text", rest.alias("_row"))
    new = {"text": F.col("_new"), "n_chars": F.char_length("_new").cast("long")}
    return scan(rows).withColumn("_new", changed).select(
        *((new[n] if n in new else F.col("_row")[n]).alias(n) for n in names)
    )


