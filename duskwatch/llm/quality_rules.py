"""Quality rules: text statistics, and decision lists learned from labelled ones by sequential covering.

A rule is a conjunction of thresholds on statistics. It is grown on two thirds of the labelled rows, each step adding
the threshold with the largest gain of information about low quality, and pruned on the other third to the length with
the best precision there; rows it covers are set aside and the next rule is grown. A rule that isn't precise enough is
left out, and until the next rule is found none begins with its first statistic and side. Thresholds are quantiles of all
labelled rows and of the low-quality ones alone, and each statistic's smallest value above 0. The list becomes one ordered conditional expression. Labelled rows are counted by bin of each statistic, so every step is
one small aggregate; the driver sees counts per bin and nothing else.

Cases: a null text has no words, all counts are 0 and it fails the base rule; rows without a label, or whose id has no
statistics, don't teach; with one class only, or an empty table, the list is empty and all is kept. Repeated rows are
judged one by one, and repeated labels count as often as they occur. Statistics replace columns of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskwatch.session import stage

SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks")
FEATURES = {
    "n_words": F.col,
    "word_length": lambda _: F.try_divide(F.col("word_chars"), F.col("n_words")),
    "symbol_share": lambda _: F.try_divide(F.col("n_symbols"), F.col("word_chars")),
    "upper_share": lambda _: F.try_divide(F.col("n_upper"), F.col("word_chars")),
    "mark_share": lambda _: F.try_divide(F.col("n_marks"), F.col("n_words")),
    "dup_line_share": lambda _: F.try_divide(F.col("n_dup_lines"), F.col("n_lines")),
    "repeat_share": lambda _: F.try_divide(F.col("n_repeat_words"), F.col("n_words")),
}
CUTS = (0.01, 0.02, 0.04, 0.06, 0.08, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.85, 0.9, 0.92, 0.94, 0.96, 0.98, 0.99)
BAD_CUTS = (0.001, 0.005, *CUTS, 0.995, 0.999)  # of the low-quality rows alone


def feature(name: str) -> Column:
    return F.coalesce(FEATURES[name](name).cast("double"), F.lit(0.0))


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column) -> Column:
    """Words in three-word windows that occur twice or more in the list: windows are sorted, equal neighbours found."""
    windows = F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, i: F.struct(
            F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)).alias("h"), w.alias("a"), F.get(words, i + 1).alias("b"), F.get(words, i + 2).alias("c"), i.alias("i")
        ),
    )

    def same(x: Column, y: Column) -> Column:
        return F.coalesce((x.h == y.h) & (x.a == y.a) & (x.b == y.b) & (x.c == y.c), F.lit(False))

    found = let(
        F.sort_array(windows),
        lambda ws: F.filter(F.transform(ws, lambda w, j: F.when(same(w, F.get(ws, j + 1)) | same(w, F.get(ws, j - 1)), w.i)), lambda i: i.isNotNull()),
    )
    start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
    return F.aggregate(
        F.sort_array(found), start, lambda acc, i: F.struct((acc.n + F.least(F.lit(3), i - acc.last)).alias("n"), i.alias("last")), lambda acc: acc.n
    )


def text_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the statistics of a text; ``n_marks`` counts ! and ?, ``n_upper`` A-Z, ``n_lines`` lines with a word."""
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    trimmed = F.btrim(value, F.lit(SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))
    lines = F.filter(F.split(value, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    of_words = let(
        words,
        lambda ws: F.struct(F.size(ws).alias("n_words"), F.length(F.array_join(ws, "")).alias("word_chars"), repeated_words(ws).alias("n_repeat_words")),
    )
    of_lines = let(lines, lambda ls: F.struct(F.size(ls).alias("n_lines"), (F.size(ls) - F.size(F.array_distinct(ls))).alias("n_dup_lines")))
    kept = lambda chars: F.length(F.regexp_replace(value, f"[^{chars}]+", ""))
    keep = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in STATS]
    counted = docs.select(
        *keep, of_words.alias("_w"), of_lines.alias("_l"), kept("#*$%&|<>").alias("n_symbols"), kept("A-Z").alias("n_upper"), kept("!?").alias("n_marks")
    )
    where = {"n_words": "_w", "word_chars": "_w", "n_repeat_words": "_w", "n_lines": "_l", "n_dup_lines": "_l"}
    return counted.select(*keep, *[F.col(f"{where[s]}.{s}" if s in where else s).cast("long").alias(s) for s in STATS])


@dataclass(frozen=True)
class Threshold:
    feature: str
    cut: float
    at_least: bool

    def column(self) -> Column:
        return feature(self.feature) >= self.cut if self.at_least else feature(self.feature) < self.cut


Rule = tuple[Threshold, ...]


def all_of(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def rule_column(rule: Rule) -> Column:
    return all_of([t.column() for t in rule])


def verdict(rules: list[Rule]) -> Column:
    """True where the list keeps a document: the first rule that fits rejects it."""
    out = F
    for rule in rules:
        out = out.when(rule_column(rule), F.lit(False))
    return out.otherwise(F.lit(True)) if rules else F.lit(True)


def gain(bad: int, good: int, new_bad: int, new_good: int) -> float:
    from math import log2

    return new_bad * (log2(new_bad / (new_bad + new_good)) - log2(bad / (bad + good))) if new_bad else 0.0


def learn_rules(labelled: DataFrame, *, max_rules: int = 8, max_terms: int = 3, min_precision: float = 0.95, min_rows: int = 8) -> list[Rule]:
    """Learn a list from rows with the statistics, ``fold_key`` (any id) and ``bad`` (boolean)."""
    features = list(FEATURES)
    values = labelled.where("bad IS NOT NULL").select("bad", (F.pmod(F.xxhash64("fold_key"), F.lit(3)) == 0).alias("prune"), *[feature(f).alias(f) for f in features])
    of_all = [F.percentile_approx(f, F.array(*map(F.lit, CUTS)), 1000).alias(f) for f in features]
    of_bad = [F.percentile_approx(F.when(F.col("bad"), F.col(f)), F.array(*map(F.lit, BAD_CUTS)), 10000).alias(f"{f}_bad") for f in features]
    found = values.agg(*of_all, *of_bad, *[F.min(F.when(F.col(f) > 0, F.col(f))).alias(f"{f}_least") for f in features]).first()
    cuts = {f: sorted({c for c in [*(found[f] or []), *(found[f"{f}_bad"] or []), found[f"{f}_least"] or 0] if c > 0}) for f in features}
    features = [f for f in features if cuts[f]]
    if not features:
        return []
    binned = [sum((F.col(f) >= c).cast("int") for c in cuts[f]).alias(f) for f in features]
    table = stage(values.select("bad", "prune", *binned).groupBy("prune", *features).agg(F.count_if("bad").alias("b"), F.count_if(~F.col("bad")).alias("g")), "rule-bins")

    def term(t: tuple[str, int, bool]) -> Column:
        return F.col(t[0]) >= t[1] if t[2] else F.col(t[0]) < t[1]

    def grow(open_rows: Column) -> list[tuple[str, int, bool]]:
        terms: list[tuple[str, int, bool]] = []
        while len(terms) < max_terms:
            now = table.where(~F.col("prune") & open_rows & all_of([term(t) for t in terms]))
            pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("bin")) for f in features]))
            counts = {(r.f, r.bin): (r.b, r.g) for r in now.select(pairs.alias("p"), "b", "g").groupBy("p.f", "p.bin").agg(F.sum("b").alias("b"), F.sum("g").alias("g")).collect()}
            total = [sum(v[k] for (f, _), v in counts.items() if f == features[0]) for k in (0, 1)]
            if not total[0] or not total[1]:
                break
            options = []
            for f in features:
                low = [0, 0]
                for at in range(1, len(cuts[f]) + 1):
                    low = [x + y for x, y in zip(low, counts.get((f, at - 1), (0, 0)))]
                    options += [(gain(*total, *low), (f, at, False)), (gain(*total, total[0] - low[0], total[1] - low[1]), (f, at, True))]
            options = [o for o in options if terms or (o[1][0], o[1][2]) not in aside]
            if not options:
                break
            best = max(options, key=lambda o: (o[0], cuts[o[1][0]][o[1][1] - 1] == found[f"{o[1][0]}_least"], o[1]))  # of equals, one that parts 0 from the rest
            if best[0] <= 1e-9:
                break
            terms.append(best[1])
        return terms

    rules: list[Rule] = []
    open_rows = F.lit(True)
    aside: set[tuple[str, bool]] = set()
    while len(rules) < max_rules:
        terms = grow(open_rows)
        if not terms:
            break
        sums = []
        for k in range(1, len(terms) + 1):
            fits = all_of([term(t) for t in terms[:k]])
            sums += [F.sum(F.when(fits & F.col("prune"), F.col(c))).alias(f"{c}{k}") for c in "bg"] + [F.sum(F.when(fits, F.col(c))).alias(f"{c}{k}_all") for c in "bg"]
        row = table.where(open_rows).agg(*sums).first().asDict()
        share = lambda b, g: ((b or 0) + 1) / ((b or 0) + (g or 0) + 2)
        best = max(range(1, len(terms) + 1), key=lambda k: (share(row[f"b{k}"], row[f"g{k}"]), -k))
        bad, good = row[f"b{best}_all"] or 0, row[f"g{best}_all"] or 0
        if bad + good < min_rows or bad / (bad + good) < min_precision or (row[f"g{best}"] or 0) > (1 - min_precision) * ((row[f"b{best}"] or 0) + (row[f"g{best}"] or 0)):
            aside.add((terms[0][0], terms[0][2]))
            continue
        rules.append(tuple(Threshold(f, cuts[f][at - 1], up) for f, at, up in terms[:best]))
        open_rows = open_rows & ~all_of([term(t) for t in terms[:best]])
        aside = set()
    return rules


def base_failed(min_words: int = 50, max_repeat_percent: int = 50) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))


def judge_quality(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality", **options) -> tuple[DataFrame, list[Rule]]:
    """Each row's id with its statistics, base_failed and kept, and the rules learned from ``labels`` (0: low quality).

    All labelled rows teach; counting them by bin keeps that small.
    """
    stats = stage(text_stats(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("_text")), "_text").drop("_text"), "text-stats")
    known = labels.select(F.col(f"`{doc_id}`").alias("doc_id"), (F.col(f"`{label}`") == 0).alias("bad"))
    rules = learn_rules(stats.join(known, "doc_id").withColumn("fold_key", F.col("doc_id")), **options)
    judged = stats.withColumn("base_failed", base_failed())
    return judged.withColumn("kept", ~F.col("base_failed") & verdict(rules)), rules
