"""Personal data: candidate spans scored by boosted trees, all in native expressions.

Four strict patterns give the base spans. Loose generators propose further, overlapping
candidates, also disguised ones: mails with (at) and (dot), addresses with [.], cards with dots or
of 13 to 15 digits, national phone numbers. Each is described by a few small binned features of
its format and its left context. Counts of every feature combination over all documents (a table
bounded by the product of the bins) are the sufficient statistics on which the driver boosts
shallow regression trees with logistic loss. A candidate is positive when its plain form, without
the disguise, is a valid value by evidence of its own (see ``_evidence``); whether a base pattern
matches there is not asked. A part of the documents is held out to calibrate one threshold per
kind. The trees become nested WHEN expressions, so scoring runs inside Spark; candidates over the
threshold that overlap no base span of their kind are added to the base spans.

Null or empty text: no spans. Repeated rows and equal ids: a result row each. Null ids: kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rigpulse.llm.common import digits, joined_spans, luhn, of_kind, saved, spans

KINDS = ("email", "ip", "card", "phone")

# Base patterns (fixed values), written with possessive quantifiers and look-arounds that skip
# starts inside a run which has failed as a whole; the matches are the same.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}

# Loose generators of candidates by kind.
LOOSE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]++"
    r"(?:(?:\.| ?\(dot\) ?| ?\[dot\] ?)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:(?:\.|\[\.\]|\(\.\)|\[dot\]|\(dot\))[0-9]{1,3}){2,5}+(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[ .-]?[0-9]){12,18}+(?![0-9])",
    "phone": r"(?<![0-9])[+(]?[0-9](?:[ ().-]{0,3}[0-9]){6,14}+(?![0-9])",
}
# Usual ends of mail domains, numbers by card issuer, forms of phone numbers.
DOMAINS = r"\.(?i:com|org|net|edu|gov|mil|int|info|biz|io|co|me|eu|uk|de|fr|es|it|nl|be|ch|at|pl|pt|se|no|dk|fi|ie|us|ca|mx|br|ar|au|nz|jp|cn|kr|in|ru|ua|tr|za|example|test)$"
ISSUERS = (
    r"^(?:4(?:[0-9]{12}|[0-9]{15}|[0-9]{18})|5[1-5][0-9]{14}|2[2-7][0-9]{14}|3[47][0-9]{13}|3[068][0-9]{12}"
    r"|6(?:011|[45][0-9]{2})[0-9]{12})$"
)
PHONES = (
    r"^(?:\+|00)[1-9]|^(?:1[ .-]?)?(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-][0-9]{4}$"
)
HINTS = r"(?i)(mail|phone|tel|call|fax|mobil|card|visa|pay|addr|host|server|contact)"
CONTEXT = 24
SEPARATORS = "[^A-Za-z0-9]"

# Feature: number of bins.
FEATURES = {
    "kind": 4, "n_digits": 6, "length": 5, "separators": 5, "checked": 2, "usual": 2, "opened": 3,
    "hint": 2, "spaced": 2,
}
MAX_COMBINATIONS = int(np.prod(list(FEATURES.values())))


def base_spans(text: Column, kind: str) -> Column:
    keep = {
        "email": None,
        "ip": lambda hit: F.forall(
            F.split(hit, r"\."),
            lambda part: F.char_length(F.regexp_replace(part, "^0+", "")) <= 3,
        )
        & F.forall(
            F.split(hit, r"\."),
            lambda part: F.coalesce(
                F.substring(F.regexp_replace(part, "^0+", ""), 1, 4).try_cast("int"), F.lit(0)
            )
            <= 255,
        ),
        "card": lambda hit: luhn(digits(hit)),
        "phone": lambda hit: F.char_length(digits(hit)).between(8, 15),
    }[kind]
    guard = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}
    found = spans(text, BASE[kind], keep)
    if kind in guard:
        return F.when(guard[kind], found).otherwise(F.expr("cast(array() as " + _SPAN + ")"))
    return found


_SPAN = "array<struct<start:int,end:int,hit:string>>"


def _bin(value: Column, *edges: int) -> Column:
    """How many of the edges the value reaches."""
    return sum((value >= e).cast("int") for e in edges)


def _plain(hit: Column, kind: str) -> Column:
    """A candidate without its disguise."""
    if kind == "email":
        at = F.regexp_replace(hit, r" ?(?:@|\(at\)|\[at\]) ?", "@")
        return F.regexp_replace(at, r" ?(?:\(dot\)|\[dot\]) ?", ".")
    if kind == "ip":
        return F.regexp_replace(hit, r"\[\.\]|\(\.\)|\[dot\]|\(dot\)", ".")
    return hit


def _evidence(hit: Column, kind: str) -> tuple[Column, Column]:
    """Whether the plain form is well formed, and whether it is a usual value.

    email: a name, an @ and a domain; a usual end. ip: parts to 255; four parts. card: the Luhn
    check; an issuer's first digits and length. phone: 8 to 15 digits; an international prefix or the groups
    of a national number.
    """
    plain, number = _plain(hit, kind), digits(hit)
    return {
        "email": (plain.rlike(r"^[A-Za-z0-9_%+-][^@ ]*@[^@ ]+\.[A-Za-z]{2,}$"), plain.rlike(DOMAINS)),
        "ip": (
            F.forall(F.split(plain, r"\."), lambda p: p.try_cast("int") <= 255),
            F.size(F.split(plain, r"\.")) == 4,
        ),
        "card": (luhn(number), number.rlike(ISSUERS)),
        "phone": (F.char_length(number).between(8, 15), hit.rlike(PHONES)),
    }[kind]


def _candidates(text: Column, kind: str, base: Column) -> Column:
    """array<struct<rank, start, end, kind, features..., label>>"""
    rank = KINDS.index(kind)

    def describe(s: Column) -> Column:
        hit, number = s["hit"], digits(s["hit"])
        n = F.char_length(number)
        size = F.char_length(hit)
        left = F.substring(
            text, F.greatest(s["start"] - CONTEXT, F.lit(0)) + 1, F.least(s["start"], F.lit(CONTEXT))
        )
        checked, usual = (F.coalesce(e, F.lit(False)) for e in _evidence(hit, kind))
        hinted = left.rlike(HINTS)
        # A lone @ between words is no mail; with a hint in front of it, it may be.
        sure = ~F.contains(hit, F.lit(" @")) & ~F.contains(hit, F.lit("@ ")) | hinted
        return F.struct(
            F.lit(rank).alias("rank"), s["start"].alias("start"), s["end"].alias("end"),
            F.lit(kind).alias("kind"),
            F.struct(
                F.lit(rank).alias("kind"),
                _bin(n, 1, 7, 10, 13, 16).alias("n_digits"),
                _bin(size, 10, 16, 22, 32).alias("length"),
                _bin(F.char_length(F.regexp_replace(hit, "[A-Za-z0-9]", "")), 1, 2, 3, 5)
                .alias("separators"),
                checked.cast("int").alias("checked"),
                usual.cast("int").alias("usual"),
                F.when(F.startswith(hit, F.lit("+")), 2)
                .when(F.startswith(hit, F.lit("(")), 1).otherwise(0).alias("opened"),
                hinted.cast("int").alias("hint"),
                F.contains(hit, F.lit(" ")).cast("int").alias("spaced"),
            ).alias("f"),
            (checked & usual & sure).cast("int").alias("label"),
            F.exists(
                base, lambda b: (b["start"] < s["end"]) & (b["end"] > s["start"])
            ).alias("overlaps"),
        )

    return F.transform(spans(text, LOOSE[kind]), describe)


def described(docs: DataFrame) -> DataFrame:
    """doc_id, held (calibration part), base_<kind> spans and candidates; one pass over the texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    out = docs.select("doc_id", text.alias("text")).select(
        "doc_id", "text", *(base_spans(F.col("text"), k).alias(f"base_{k}") for k in KINDS)
    )
    has_digit = F.col("text").rlike("[0-9@]|[(\\[]at[)\\]]")
    candidates = F.concat(
        *(_candidates(F.col("text"), k, F.col(f"base_{k}")) for k in KINDS)
    )
    return out.select(
        "doc_id",
        (F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0).cast("int").alias("held"),
        *(of_kind(F.col(f"base_{k}"), k, i).alias(f"base_{k}") for i, k in enumerate(KINDS)),
        F.when(has_digit, candidates).alias("candidates"),
    )


@dataclass
class Tree:
    """A split on ``feature >= edge``, or a leaf."""

    value: float = 0.0
    feature: str | None = None
    edge: int = 0
    low: Tree | None = None
    high: Tree | None = None

    def column(self, f: Column) -> Column:
        if self.feature is None:
            return F.lit(self.value)
        return F.when(f[self.feature] >= self.edge, self.high.column(f)).otherwise(
            self.low.column(f)
        )

    def predict(self, x: dict[str, np.ndarray]) -> np.ndarray:
        n = len(next(iter(x.values())))
        if self.feature is None:
            return np.full(n, self.value)
        return np.where(x[self.feature] >= self.edge, self.high.predict(x), self.low.predict(x))


def _grow(x: dict, g: np.ndarray, h: np.ndarray, depth: int, ridge: float) -> Tree:
    gs, hs = g.sum(), h.sum()
    best, cut = 1e-6, None
    for name, bins in FEATURES.items() if depth else ():
        for edge in range(1, bins):
            up = x[name] >= edge
            gu, hu = g[up].sum(), h[up].sum()
            gain = (
                gu**2 / (hu + ridge) + (gs - gu) ** 2 / (hs - hu + ridge) - gs**2 / (hs + ridge)
            )
            if gain > best:
                best, cut = gain, (name, edge, up)
    if cut is None:
        return Tree(value=float(gs / (hs + ridge)))
    name, edge, up = cut
    part = lambda m: _grow({k: v[m] for k, v in x.items()}, g[m], h[m], depth - 1, ridge)
    return Tree(feature=name, edge=edge, low=part(~up), high=part(up))


@dataclass
class Model:
    """Log-odds = base + rate * sum of trees; a threshold of the odds for each kind (None: never)."""

    bias: float
    rate: float
    trees: list[Tree]
    thresholds: dict[str, float | None]

    def score(self, f: Column) -> Column:
        total = F.lit(self.bias)
        for tree in self.trees:
            total = total + F.lit(self.rate) * tree.column(f)
        return total

    def raw(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return self.bias + self.rate * sum(t.predict(x) for t in self.trees)


def statistics(found: DataFrame) -> DataFrame:
    """Candidates and positives of each feature combination, apart for the held-out part."""
    return (
        found.select("held", F.explode("candidates").alias("c"))
        .groupBy("held", *(F.col(f"c.f.{n}").alias(n) for n in FEATURES))
        .agg(F.count("*").alias("n"), F.sum("c.label").alias("positive"))
    )


def fit(
    found: DataFrame, trees: int = 16, depth: int = 3, rate: float = 0.4, ridge: float = 1.0,
    precision: float = 0.9, least: int = 5,
) -> Model:
    """Boost on the statistics of all documents; at most 2 * MAX_COMBINATIONS rows reach the driver.

    A kind's threshold is the lowest score at which held-out candidates of its kind reach the
    precision. With fewer than ``least`` held-out positives of its kind, those of all kinds set it,
    and where these are as few, all candidates do. Without any positive nothing is added.
    """
    rows = statistics(found).collect()
    x = {n: np.array([r[n] for r in rows], int) for n in FEATURES}
    held = np.array([r["held"] for r in rows], int) == 1
    n = np.array([r["n"] for r in rows], float)
    pos = np.array([r["positive"] for r in rows], float)
    train = ~held
    total, hits = n[train].sum(), pos[train].sum()
    if not rows or not hits or hits == total:
        return Model(0.0, rate, [], dict.fromkeys(KINDS))
    model = Model(float(np.log(hits / (total - hits))), rate, [], {})
    xt = {k: v[train] for k, v in x.items()}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-model.raw(xt)))
        model.trees.append(
            _grow(xt, pos[train] - n[train] * p, n[train] * p * (1 - p), depth, ridge)
        )
    raw = np.round(model.raw(x), 6)
    for rank, kind in enumerate(KINDS):
        own = next(
            (m for m in (held & (x["kind"] == rank), held) if pos[m].sum() >= least), n > 0
        )
        best = None
        for cut in sorted(set(raw[own]), reverse=True):
            over = own & (raw >= cut)
            if pos[over].sum() < precision * n[over].sum():
                break
            best = float(cut)
        model.thresholds[kind] = best
    return model


def found_spans(found: DataFrame, model: Model) -> DataFrame:
    """doc_id, base (array of spans by kind and start), added (array of spans)."""
    limit = F.create_map(
        *(
            v
            for k in KINDS
            if model.thresholds.get(k) is not None
            for v in (F.lit(k), F.lit(model.thresholds[k] - 1e-5))
        )
    ) if any(v is not None for v in model.thresholds.values()) else None
    none = F.expr("cast(array() as array<struct<rank:int,start:int,end:int,kind:string>>)")
    added = none
    if limit is not None:
        chosen = F.filter(
            F.col("candidates"),
            lambda c: ~c["overlaps"] & (model.score(c["f"]) >= limit[c["kind"]]),
        )
        added = F.coalesce(
            F.transform(
                chosen,
                lambda c: F.struct(
                    c["rank"].alias("rank"), c["start"].alias("start"), c["end"].alias("end"),
                    c["kind"].alias("kind"),
                ),
            ),
            none,
        )
    return found.select(
        "doc_id",
        *(f"base_{k}" for k in KINDS),
        F.concat(*(f"base_{k}" for k in KINDS)).alias("base"),
        added.alias("added"),
    )


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, base_<kind> spans, base, added; see the module's text."""
    found = saved(described(docs), "pii")
    return found_spans(found, fit(found))


def report(docs: DataFrame) -> DataFrame:
    """The contract's columns, derived from the spans."""
    return personal_data(docs).select(
        "doc_id",
        *(F.size(f"base_{k}").cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(joined_spans(F.col("base")), 256).alias("base_sha256"),
        joined_spans(F.array_sort(F.concat("base", "added"))).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )
