"""Quality rules learned as an ordered decision list, in DataFrame functions only.

Each text becomes a row of counts, computed by built-in functions inside its own row.
From labelled rows, sequential covering learns what to reject:

* a rule is a conjunction of thresholds on shares of these counts. It grows by the
  condition with the highest information gain (FOIL) on two thirds of the labelled
  rows, and loses its last conditions where that helps on the other third;
* a rule that is precise enough on that third is kept, the rows it covers are set
  aside, and the next rule is grown on the rest.

What the driver sees per step is one histogram: bad and good rows by feature and bin.
The list ends up as one chain of ``when`` expressions.

A null text counts as empty and has no word. A row without a label takes no part in
the learning; a document with several labels counts as bad if one of them says so.
Without labels no rule is learned and only the base test decides.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.lineage import stored

# What a word is, which characters are symbols, and the limits of the base test.
SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
LEAST_WORDS, MOST_REPEATED_PERCENT = 20, 30

#: Quantiles per feature and class that become thresholds.
QUANTILES = 32
MOST_CONDITIONS, MOST_RULES = 4, 12
#: Least share of bad rows among those a rule covers in the pruning third, and least bad rows there.
PRECISION, LEAST_COVERED = 0.9, 3

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with one more column, the struct ``__measures`` of counts (all long)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.withColumns({
        "__words": F.array_remove(F.split(text, SPACE), ""),
        "__lines": F.filter(F.split(text, "\n"), lambda line: line.rlike(NOT_SPACE)),
    })
    rows = rows.withColumn(
        "__windows",
        F.when(
            F.size("__words") >= WINDOW,
            F.transform(F.sequence(F.lit(1), F.size("__words") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("__words", i, WINDOW))),
        ),
    )
    # Only texts with a repeated window pay for finding which ones: sorted by hash, equals are neighbours.
    repeats = F.size(F.array_distinct("__windows")) < F.size("__windows")
    rows = rows.withColumn(
        "__sorted",
        F.when(repeats, F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("at"))))),
    )
    twin = "filter(__sorted, (e, i) -> coalesce(get(__sorted, i - 1).h = e.h, false) or coalesce(get(__sorted, i + 1).h = e.h, false))"
    rows = rows.withColumn("__starts", F.sort_array(F.transform(F.expr(twin), lambda e: e["at"])))
    covered = (
        f"aggregate(__starts, named_struct('sum', 0L, 'before', {-WINDOW}),"
        f" (a, at) -> named_struct('sum', a.sum + least({WINDOW}, at - a.before), 'before', at), a -> a.sum)"
    )
    measures = F.struct(
        F.size("__words").cast("long").alias("n_words"),
        F.char_length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.expr(covered), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("__lines").cast("long").alias("n_lines"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count(text, F.lit(r"[!?]")).cast("long").alias("n_shouts"),
        F.regexp_count(text, F.lit(r"\p{Nd}")).cast("long").alias("n_digits"),
        F.size(F.array_distinct("__words")).cast("long").alias("n_distinct"),
    )
    return rows.select(*docs.columns, measures.alias("__measures"))


def features() -> dict[str, Column]:
    """What thresholds are set on; no words make shares of 0."""
    m = {n: F.col(f"__measures.{n}") for n in [*COUNTS, "n_lines", "n_upper", "n_shouts", "n_digits", "n_distinct"]}

    def share(a: str, b: str) -> Column:
        return F.coalesce(m[a] / F.nullif(m[b], F.lit(0)), F.lit(0.0))

    return {
        "words": m["n_words"].cast("double"),
        "chars_per_word": share("word_chars", "n_words"),
        "symbols_per_word": share("n_symbols", "n_words"),
        "repeated_lines": share("n_dup_lines", "n_lines"),
        "repeated_words": share("n_repeat_words", "n_words"),
        "capitals": share("n_upper", "word_chars"),
        "shouts_per_word": share("n_shouts", "n_words"),
        "digits": share("n_digits", "word_chars"),
        "distinct_words": share("n_distinct", "n_words"),
        "words_per_line": share("n_words", "n_lines"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = features()[self.feature]
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]

    def column(self) -> Column:
        return reduce(Column.__and__, (c.column() for c in self.conditions))

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


def base_failed() -> Column:
    words, repeated = F.col("__measures.n_words"), F.col("__measures.n_repeat_words")
    return (words < LEAST_WORDS) | (100 * repeated > MOST_REPEATED_PERCENT * words)


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The measures of labelled documents that pass the base test, with ``bad`` and the part they learn in."""
    marks = labels.filter(F.col("quality").isNotNull()).groupBy(F.col("doc_id")).agg((F.min("quality") == 0).alias("bad"))
    found = rows.select("doc_id", "__measures").join(marks, "doc_id").filter(~base_failed())
    return found.select("__measures", "bad", (F.pmod(F.xxhash64("doc_id"), F.lit(3)) > 0).alias("grow"))


def thresholds(rows: DataFrame) -> dict[str, list[float]]:
    """Quantiles of each feature among bad and among good rows."""
    steps = [k / (QUANTILES + 1) for k in range(1, QUANTILES + 1)]
    by_class = rows.groupBy("bad").agg(*(F.percentile_approx(v, steps, 1000).alias(n) for n, v in features().items())).collect()
    return {n: sorted({v for r in by_class for v in (r[n] or ())}) for n in features()}


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def _best_condition(table: DataFrame, cuts: dict[str, list[float]], p0: int, n0: int) -> tuple[float, Condition] | None:
    """The condition of highest gain among the rows of ``table``, from one histogram."""
    bins = F.explode(F.arrays_zip(F.array(*map(F.lit, cuts)).alias("feature"), F.col("bins").alias("bin"))).alias("x")
    counts = table.select("bad", bins).groupBy("x.feature", "x.bin").agg(
        F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n")
    ).collect()
    found: dict[str, dict[int, tuple[int, int]]] = {}
    for r in counts:
        found.setdefault(r["feature"], {})[r["bin"]] = (r["p"], r["n"])
    best: tuple[float, Condition] | None = None
    for name, values in cuts.items():
        p = n = 0
        for b, cut in enumerate(values):  # bin b: above the first b cuts, at most cut b
            dp, dn = found.get(name, {}).get(b, (0, 0))
            p, n = p + dp, n + dn
            for above, (a, c) in ((False, (p, n)), (True, (p0 - p, n0 - n))):
                gain = _gain(a, c, p0, n0)
                if gain > 1e-9 and (best is None or gain > best[0]):
                    best = gain, Condition(name, above, cut)
    return best


def _bin(value: Column, cuts: list[float]) -> Column:
    """How many of the cuts lie below a value."""
    return F.size(F.filter(F.array(*map(F.lit, cuts)).cast("array<double>"), lambda cut: cut < value))


def learned_rules(rows: DataFrame, labels: DataFrame) -> list[Rule]:
    """The decision list for documents ``rows`` (from ``measured``, stored)."""
    table = stored(labelled(rows, labels), "labelled")
    cuts = thresholds(table)
    if not any(cuts.values()):
        return []
    bins = F.array(*(_bin(features()[n], c) for n, c in cuts.items()))
    left = stored(table.withColumn("bins", bins), "binned")

    def hits(df: DataFrame) -> tuple[int, int]:
        r = df.agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n")).first()
        return r["p"], r["n"]

    rules: list[Rule] = []
    while len(rules) < MOST_RULES:
        grown: list[Condition] = []
        covered = left.filter("grow")
        p, n = hits(covered)
        while p and n and len(grown) < MOST_CONDITIONS:
            best = _best_condition(covered, cuts, p, n)
            if best is None:
                break
            grown.append(best[1])
            covered = covered.filter(best[1].column())
            p, n = hits(covered)
        if not grown:
            break
        prefixes = [Rule(tuple(grown[: k + 1])) for k in range(len(grown))]
        counts = left.filter(~F.col("grow")).agg(
            *(F.count_if(r.column() & (F.col("bad") == b)).alias(f"{'np'[b]}{k}") for k, r in enumerate(prefixes) for b in (True, False))
        ).first()
        scores = [(counts[f"p{k}"], counts[f"n{k}"]) for k in range(len(prefixes))]
        k = max(range(len(prefixes)), key=lambda i: ((scores[i][0] - scores[i][1]) / max(1, sum(scores[i])), -i))
        p, n = scores[k]
        if p < LEAST_COVERED or p < PRECISION * (p + n):
            break
        rules.append(prefixes[k])
        left = left.filter(~prefixes[k].column())
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The number of the first rule that rejects a row, from 1; null if none does."""
    out = F.lit(None).cast("int")
    for k, rule in reversed(list(enumerate(rules, start=1))):
        out = F.when(rule.column(), F.lit(k)).otherwise(out)
    return out


def judged(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """doc_id, the counts, base_failed, kept, and the rule that rejected the row."""
    rule = verdict(rules)
    return rows.select(
        "doc_id", *(F.col(f"__measures.{n}").alias(n) for n in COUNTS),
        base_failed().alias("base_failed"), (~base_failed() & rule.isNull()).alias("kept"), rule.alias("rule"),
    )


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs`` with its counts and verdict; texts are read once."""
    rows = stored(measured(docs.select("doc_id", "text")).select("doc_id", "__measures"), "measures")
    return judged(rows, learned_rules(rows, labels))


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    rows = stored(measured(docs), "measured")
    rules = learned_rules(rows, labels)
    return rows.filter(~base_failed() & verdict(rules).isNull()).select(docs.columns)
