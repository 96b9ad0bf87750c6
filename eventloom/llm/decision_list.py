"""Quality rules: statistics of a text and a decision list learned from labelled statistics.

Everything runs as DataFrame expressions. The learner sees histograms only: for each growth
step one aggregation counts labels by (statistic, bin), at most ``bins`` rows a statistic,
so what reaches the driver does not grow with the data.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import SPACE, as_row, fresh_name, let, space_words, whole_text
from eventloom.session import stage_table

SYMBOLS = r"[#*$%&|<>]"
FEATURES = (
    "mean_word",
    "symbol_share",
    "mark_share",
    "upper_share",
    "dup_line_share",
    "repeat_share",
    "distinct_share",
    "n_words",
)


def repeated_window_words(words: Column) -> Column:
    """Words inside a three-word window that the text holds twice or more.

    Windows are compared by the 64-bit hash of their three words. Sorting (hash, place)
    brings equal windows together: n log n in a text's length, no pairs.
    """

    def count(w: Column) -> Column:
        windows = F.transform(
            F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
            lambda x, i: F.struct(F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")),
        )
        return let(F.sort_array(windows), covered)

    def covered(s: Column) -> Column:
        same = lambda x, j: F.coalesce(x["h"] == F.get(s, j)["h"], F.lit(False))
        twice = F.filter(s, lambda x, j: same(x, j - 1) | same(x, j + 1))
        places = F.sort_array(F.transform(twice, lambda x: x["i"]))
        # A window adds three words, or fewer if the next one starts before its end.
        return let(
            places,
            lambda p: F.aggregate(
                F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3)))),
                F.lit(0).cast("bigint"),
                lambda total, x: total + x,
            ),
        )

    return let(words, count)


def text_statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and one column a statistic; a null or empty text has zeros everywhere."""
    text, words = fresh_name(df, "_text"), fresh_name(df, "_words")
    # The words are one row's array; the generator keeps the planner from computing it twice.
    rows = df.select(
        F.col(id_col),
        whole_text(text_col).alias(text),
        F.explode(F.array(space_words(whole_text(text_col)))).alias(words),
    )
    t, w = F.col(text), F.col(words)
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    distinct = let(lines, lambda x: F.struct(F.size(x).alias("all"), F.size(F.array_distinct(x)).alias("distinct")))
    counts = F.struct(
        F.size(w).cast("bigint").alias("n_words"),
        F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
        F.regexp_count(t, F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        F.regexp_count(t, F.lit("[!?]")).cast("bigint").alias("n_marks"),
        F.length(F.regexp_replace(t, r"[^\p{Lu}]+", "")).cast("bigint").alias("n_upper"),
        distinct.alias("lines"),
        F.size(F.array_distinct(w)).cast("bigint").alias("n_distinct"),
        repeated_window_words(w).alias("n_repeat_words"),
    )
    # A generator again: what is asked of the counts below must not repeat their computation.
    counted = rows.select(id_col, F.explode(F.array(counts)).alias("c")).select(id_col, "c.*")
    share = lambda part, whole: F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)
    return counted.select(
        id_col,
        "n_words",
        "word_chars",
        "n_symbols",
        (F.col("lines.all") - F.col("lines.distinct")).cast("bigint").alias("n_dup_lines"),
        "n_repeat_words",
        share("word_chars", "n_words").alias("mean_word"),
        share("n_symbols", "word_chars").alias("symbol_share"),
        share("n_marks", "word_chars").alias("mark_share"),
        share("n_upper", "word_chars").alias("upper_share"),
        F.when(
            F.col("lines.all") > 0, (F.col("lines.all") - F.col("lines.distinct")) / F.col("lines.all")
        ).otherwise(0.0).alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        share("n_distinct", "n_words").alias("distinct_share"),
    )


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        c = F.col(self.feature)
        return (c > F.lit(self.threshold)) if self.above else (c <= F.lit(self.threshold))

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    """All conditions hold: the row is rejected. The counts are those of the pruning rows."""

    conditions: tuple[Condition, ...]
    hits: int
    misses: int

    def column(self) -> Column:
        held = F.lit(True)
        for c in self.conditions:
            held = held & c.column()
        return F.coalesce(held, F.lit(False))

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


def verdict(rules: list[Rule]) -> Column:
    """The list in order: number of the first rule that holds (from 1), 0 if none does."""
    out = F.lit(0)
    for n, rule in reversed(list(enumerate(rules, 1))):
        out = F.when(rule.column(), F.lit(n)).otherwise(out)
    return out


def _thresholds(rows: DataFrame, features, bins: int) -> dict[str, list[float]]:
    """Cut points: quantiles of either class, so that a rare class has its own."""
    points = [i / bins for i in range(bins + 1)]
    cuts: dict[str, set[float]] = {f: set() for f in features}
    aggs = [F.percentile_approx(f, points, 10_000).alias(f) for f in features]
    for row in rows.groupBy("_bad").agg(*aggs).collect():  # two rows
        for f in features:
            cuts[f].update(float(x) for x in row[f] or () if x is not None and not math.isnan(x))
    return {f: sorted(x) for f, x in cuts.items()}


def _best(table: list, cuts: dict[str, list[float]], floor: int) -> tuple[float, Condition | None]:
    """The condition with the highest FOIL gain over all rows of the histogram."""
    best: tuple[float, Condition | None] = (0.0, None)
    cells: dict[str, dict[int, tuple[int, int]]] = {}
    for row in table:
        cells.setdefault(row["feature"], {})[row["bin"]] = (row["bad"], row["good"])
    for feature in sorted(cells):
        own = cells[feature]
        bad, good = (sum(x[i] for x in own.values()) for i in (0, 1))
        if not bad:
            continue
        before = math.log2(bad / (bad + good))
        low_bad = low_good = 0
        for k, cut in enumerate(cuts[feature]):
            b, g = own.get(k, (0, 0))
            low_bad, low_good = low_bad + b, low_good + g
            for above, p, n in ((False, low_bad, low_good), (True, bad - low_bad, good - low_good)):
                if p >= floor and p + n < bad + good:
                    gain = p * (math.log2(p / (p + n)) - before)
                    if gain > best[0] + 1e-9:
                        best = (gain, Condition(feature, above, cut))
    return best


def learn(
    labelled: DataFrame,
    features: tuple[str, ...] = FEATURES,
    bad_col: str = "bad",
    key_col: str = "doc_id",
    max_rules: int = 8,
    max_conditions: int = 3,
    bins: int = 64,
    min_hits: int = 8,
    min_precision: float = 0.97,
) -> list[Rule]:
    """Sequential covering of the rows whose ``bad_col`` is 1, over all labelled rows.

    Two thirds of the rows (by a hash of the key) grow a rule, one condition at a time; the
    others prune it to the beginning with the highest (hits - misses) / (hits + misses). A
    rule is kept from ``min_hits`` rows and ``min_precision`` on, measured on the pruning
    rows; the rows it covers leave, and the next is grown. No labels or no bad rows: no rule.
    Null or NaN statistics meet no condition.
    """
    rows = labelled.where(F.col(bad_col).isin(0, 1)).select(
        F.col(bad_col).cast("int").alias("_bad"),
        (F.pmod(F.xxhash64(F.col(key_col).cast("string")), F.lit(3)) != 0).alias("_grow"),
        *[F.when(~F.isnan(F.col(f).cast("double")), F.col(f).cast("double")).alias(f) for f in features],
    )
    rows = stage_table(rows, "labelled-statistics")
    cuts = {f: x for f, x in _thresholds(rows, features, bins).items() if x}
    if not cuts:
        return []
    # Bin k of a value: the number of cut points below it; bin k <= condition at cut k.
    bin_of = lambda f: F.size(F.filter(F.lit(cuts[f]), lambda c: c < F.col(f)))
    binned = F.explode(
        F.array(*[F.struct(F.lit(f).alias("feature"), bin_of(f).alias("bin"), F.col(f).isNotNull().alias("known")) for f in cuts])
    )
    rules: list[Rule] = []
    left = rows
    while len(rules) < max_rules:
        conditions: list[Condition] = []
        inside = left.where("_grow")
        while len(conditions) < max_conditions:
            table = (
                inside.select("_bad", binned.alias("b"))
                .where("b.known")
                .groupBy("b.feature", "b.bin")
                .agg(F.sum("_bad").alias("bad"), F.sum(1 - F.col("_bad")).alias("good"))
                .collect()  # at most bins x 2 + 3 rows a feature
            )
            gain, found = _best(table, cuts, min_hits)
            if found is None or found in conditions:
                break
            conditions.append(found)
            inside = inside.where(found.column())
        if not conditions:
            break
        counts = []
        for k in range(1, len(conditions) + 1):
            held = Rule(tuple(conditions[:k]), 0, 0).column()
            counts += [
                F.coalesce(F.sum(F.when(held, F.col("_bad"))), F.lit(0)).alias(f"bad{k}"),
                F.coalesce(F.sum(F.when(held, 1 - F.col("_bad"))), F.lit(0)).alias(f"good{k}"),
            ]
        pruned = left.where(~F.col("_grow")).agg(*counts).first()  # one row
        choices = [
            ((pruned[f"bad{k}"] - pruned[f"good{k}"]) / (pruned[f"bad{k}"] + pruned[f"good{k}"]), -k)
            for k in range(1, len(conditions) + 1)
            if pruned[f"bad{k}"] + pruned[f"good{k}"]
        ]
        if not choices:
            break
        k = -max(choices)[1]
        bad, good = pruned[f"bad{k}"], pruned[f"good{k}"]
        if bad < max(1, min_hits // 2) or bad < min_precision * (bad + good):
            break
        rules.append(Rule(tuple(conditions[:k]), bad, good))
        left = left.where(~rules[-1].column())
    return rules


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judge(
    documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", **learning
) -> tuple[DataFrame, list[Rule]]:
    """Statistics, ``base_failed``, ``rule`` (0: none) and ``kept`` of every document, and the list.

    Repeated ids in ``labels`` count once, with the lower label. Texts are read once: the
    statistics are written to the shared folder, which learning and the verdict read.
    """
    stats = stage_table(text_statistics(documents, id_col, text_col), "text-statistics")
    marks = (
        labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"))
        .where("_id is not null and _label is not null")
        .groupBy("_id")
        .agg(F.min("_label").alias("_label"))
    )
    labelled = stats.join(marks, stats[id_col] == marks["_id"]).withColumn("bad", 1 - F.col("_label"))
    rules = learn(labelled, key_col=id_col, **learning)
    return judged(stats, rules), rules


def judged(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    out = stats.withColumn("base_failed", base_failed()).withColumn("rule", verdict(rules))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def kept_rows(documents: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """The rows that pass, with their columns. Statistics are computed in place: no join, no shuffle."""
    rows = documents.select(as_row(documents).alias("_row"), F.col(text_col).alias("_own_text"))
    return judged(text_statistics(rows, "_row", "_own_text"), rules).where("kept").select("_row.*")
