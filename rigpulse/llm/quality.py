"""Quality rules: an ordered decision list learned from labelled statistics, run natively.

Statistics of a text are native expressions. From a bounded sample of labelled documents the
driver learns, by sequential covering, conjunctions of thresholds for the class to reject: each is
grown condition by condition on one part of the sample, pruned on the other and kept while it is
precise enough there. The list becomes one ordered CASE expression.

Null or empty text: no words, hence failed by the base rule. Repeated rows and equal ids: a result
row each. Labels with a null value or id are not used; repeated labels of one id must agree, else
the lower one holds. Without usable labels the list is empty and the base rule alone decides.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
# Bound of the labelled sample that the list is learned from.
SAMPLE = 8_000


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _repeated(windows: Column) -> Column:
    """Words covered by windows that occur twice or more; windows: hash at each start."""
    numbered = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))

    def starts(s: Column) -> Column:
        same = lambda x, j: (j >= 0) & (j < F.size(s)) & (F.get(s, j)["h"] == x["h"])
        again = F.filter(
            s,
            lambda x, j: F.coalesce(same(x, j - 1), F.lit(False))
            | F.coalesce(same(x, j + 1), F.lit(False)),
        )
        return F.array_sort(F.transform(again, lambda x: x["i"]))

    covered = lambda at: F.aggregate(
        at,
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda state, i: F.struct(
            i.alias("last"), (state["n"] + F.least(i - state["last"], F.lit(WINDOW))).alias("n")
        ),
        lambda state: state["n"],
    )
    return _let(F.array_sort(numbered), lambda s: _let(starts(s), covered))


def _word_statistics(words: Column) -> Column:
    n = F.size(words)
    windows = F.when(
        n >= WINDOW,
        F.transform(
            F.sequence(F.lit(1), F.greatest(n - WINDOW + 1, F.lit(1))),
            lambda i: F.xxhash64(F.slice(words, i, WINDOW)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    repeats = _let(
        windows,
        lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(_repeated(w)),
    )
    return F.struct(
        n.cast("long").alias("n_words"),
        F.size(F.array_distinct(words)).cast("long").alias("n_distinct"),
        repeats.cast("long").alias("n_repeat_words"),
    )


def statistics(text: Column) -> dict[str, Column]:
    """Columns of counts over the whole text."""
    text = F.coalesce(text, F.lit(""))
    without = lambda pattern: F.char_length(F.regexp_replace(text, pattern, ""))
    size = F.char_length(text)
    words = F.filter(F.split(text, SPACE, -1), lambda w: w != "")
    lines = _let(
        F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        lambda x: F.size(x) - F.size(F.array_distinct(x)),
    )
    return {
        "w": _let(words, _word_statistics),
        "word_chars": without(SPACE).cast("long"),
        "n_symbols": (size - F.char_length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": lines.cast("long"),
        "n_code_points": size.cast("long"),
        "n_upper": (size - without(r"\p{Lu}+")).cast("long"),
        "n_letters": (size - without(r"\p{L}+")).cast("long"),
    }


COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct",
    "n_code_points", "n_upper", "n_letters",
)


def with_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with a struct column ``_stats`` of COUNTS; other columns stay."""
    made = statistics(F.col("text"))
    flat = docs.withColumn("_s", F.struct(*(c.alias(n) for n, c in made.items())))
    return flat.withColumn(
        "_stats",
        F.struct(
            *(
                (F.col("_s.w")[n] if n in ("n_words", "n_distinct", "n_repeat_words")
                 else F.col("_s")[n]).alias(n)
                for n in COUNTS
            )
        ),
    ).drop("_s")


def features(s: Column) -> dict[str, Column]:
    """What the thresholds of the list are on; never null."""
    n, chars = F.greatest(s["n_words"], F.lit(1)), F.greatest(s["n_code_points"], F.lit(1))
    return {
        "words": s["n_words"].cast("double"),
        "word_length": s["word_chars"] / n,
        "symbols_per_word": s["n_symbols"] / n,
        "repeated_share": s["n_repeat_words"] / n,
        "distinct_share": s["n_distinct"] / n,
        "dup_lines": s["n_dup_lines"].cast("double"),
        "upper_share": s["n_upper"] / F.greatest(s["n_letters"], F.lit(1)),
        "letter_share": s["n_letters"] / chars,
    }


def base_failed(s: Column) -> Column:
    return (s["n_words"] < MIN_WORDS) | (
        100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"]
    )


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # feature >= edge, else feature < edge
    edge: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return (x[self.feature] >= self.edge) == self.above

    def column(self, f: dict[str, Column]) -> Column:
        c = f[self.feature]
        return c >= F.lit(self.edge) if self.above else c < F.lit(self.edge)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.edge:.4g}"


@dataclass
class DecisionList:
    """The first rule that holds rejects; none: keep."""

    rules: list[tuple[Condition, ...]] = field(default_factory=list)

    def keeps(self, s: Column) -> Column:
        f = features(s)
        chosen = F.when(F.lit(False), F.lit(False))
        for rule in self.rules:
            holds = F.lit(True)
            for c in rule:
                holds = holds & c.column(f)
            chosen = chosen.when(holds, F.lit(False))
        return chosen.otherwise(F.lit(True))

    def rejects(self, x: dict[str, np.ndarray]) -> np.ndarray:
        n = len(next(iter(x.values())))
        out = np.zeros(n, bool)
        for rule in self.rules:
            out |= _covered(rule, x, n)
        return out


def _covered(rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for c in rule:
        out &= c.holds(x)
    return out


def _conditions(x: dict[str, np.ndarray], cuts: int = 48) -> list[Condition]:
    made = []
    for name, values in x.items():
        edges = np.unique(np.quantile(values, np.linspace(0, 1, cuts + 2)[1:-1]))
        made += [Condition(name, above, float(e)) for e in edges for above in (True, False)]
    return made


def _grow(x, bad: np.ndarray, left: np.ndarray, options, most: int) -> tuple[Condition, ...]:
    """Add the condition of the largest information gain until no good document is covered."""
    rule: tuple[Condition, ...] = ()
    covered = left.copy()
    while len(rule) < most:
        p, n = (covered & bad).sum(), (covered & ~bad).sum()
        if not p or not n:
            break
        before = np.log2(p / (p + n))
        best, chosen, cover = 1e-9, None, None
        for c, holds in options:
            new = covered & holds
            p1 = (new & bad).sum()
            if not p1:
                continue
            gain = p1 * (np.log2(p1 / new.sum()) - before)
            if gain > best:
                best, chosen, cover = gain, c, new
        if chosen is None:
            break
        rule, covered = (*rule, chosen), cover
    return rule


def _prune(rule, x, bad: np.ndarray, left: np.ndarray) -> tuple[tuple[Condition, ...], float, int]:
    """The shortest prefix of the best worth on the pruning part; its precision and cover there."""
    best = ((), -1.0, 0.0, 0)
    for k in range(1, len(rule) + 1):
        covered = left & _covered(rule[:k], x, len(bad))
        p, n = int((covered & bad).sum()), int((covered & ~bad).sum())
        worth = (p - n) / (p + n) if p + n else -1.0
        if worth > best[1]:
            best = (rule[:k], worth, p / (p + n), p)
    return best[0], best[2], best[3]


def learn(
    x: dict[str, np.ndarray], bad: np.ndarray, precision: float = 0.95, most_rules: int = 12,
    most_conditions: int = 4, least: int = 3,
) -> DecisionList:
    """Sequential covering of the bad documents; every third row is for pruning."""
    found = DecisionList()
    if not len(bad) or not bad.any():
        return found
    pruning = np.arange(len(bad)) % 3 == 2
    g, q = {k: v[~pruning] for k, v in x.items()}, {k: v[pruning] for k, v in x.items()}
    gb, qb = bad[~pruning], bad[pruning]
    options = [(c, c.holds(g)) for c in _conditions(g)]
    gl, ql = np.ones(len(gb), bool), np.ones(len(qb), bool)
    for _ in range(most_rules):
        rule = _grow(g, gb, gl, options, most_conditions)
        rule, good, cover = _prune(rule, q, qb, ql) if rule else ((), 0.0, 0)
        own = gl & _covered(rule, g, len(gb))
        if not rule or good < precision or cover < least or (own & gb).sum() < precision * own.sum():
            break
        found.rules.append(rule)
        gl &= ~_covered(rule, g, len(gb))
        ql &= ~_covered(rule, q, len(qb))
    return found


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Texts and labels of at most ``sample`` labelled documents, chosen by a hash of the id.

    The chosen ids are bounded by ``sample``, so they are broadcast and the texts stay in place.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    one = usable.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DecisionList:
    """Learn the list from what the base rule does not fail already."""
    rows = with_statistics(labelled_sample(docs, labels, sample)).where(~base_failed(F.col("_stats")))
    f = features(F.col("_stats"))
    got = (
        rows.select("doc_id", "quality", *(c.alias(n) for n, c in f.items()))
        .dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).collect()
    )
    x = {n: np.array([r[n] for r in got], float) for n in f}
    return learn(x, np.array([r["quality"] == 0 for r in got], bool))


def judged(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """``docs`` with ``_stats``, ``_base_failed`` and ``_kept``; other columns stay."""
    s = F.col("_stats")
    return (
        with_statistics(docs)
        .withColumn("_base_failed", base_failed(s))
        .withColumn("_kept", F.when(F.col("_base_failed"), F.lit(False)).otherwise(rules.keeps(s)))
    )


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns."""
    shown = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged(docs.select("doc_id", "text"), fit(docs, labels)).select(
        "doc_id",
        *(F.col(f"_stats.{n}").alias(n) for n in shown),
        F.col("_base_failed").alias("base_failed"),
        F.col("_kept").alias("kept"),
    )
