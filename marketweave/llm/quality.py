"""Quality rules: a decision list learned by sequential covering, built-in functions only.

``text_statistics`` measures every whole text inside its row (no shuffle). ``learn_rules``
reads the statistics of labelled rows, folds them into histogram cells, and grows one
conjunction of thresholds at a time on one part of the cells (each step is one grouped count
of at most features x cuts rows), prunes it on the other part, removes what it covers and
goes on. ``verdict`` turns the list into one ordered ``CASE WHEN``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketweave.llm.common import SEPARATORS, WORD
from marketweave.session import cut_lineage

WINDOW = 5
# Labelled rows to learn from: the ones with the smallest id hashes.
MAX_ROWS = 40_000
CUTS = 24


def _count(text: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0)).cast("long")


def repeated_window_words(df: DataFrame, words: str, out: str) -> DataFrame:
    """Add ``out``: words of the array ``words`` that lie in a run of five words found twice
    or more. Windows are hashed; only a text with equal windows sorts them, and then equal
    neighbours mark their positions, whose covered words are counted left to right."""
    df = (df.withColumn("_h", F.transform(words, lambda w: F.xxhash64(w)))
          .withColumn("_g", F.when(
              F.size("_h") >= WINDOW,
              F.transform(F.sequence(F.lit(0), F.size("_h") - WINDOW),
                          lambda i: F.xxhash64(*[F.get("_h", i + j) for j in range(WINDOW)])))
              .otherwise(F.array().cast("array<long>")))
          .withColumn("_s", F.when(
              F.size(F.array_distinct("_g")) < F.size("_g"),
              F.array_sort(F.transform("_g", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
          .withColumn("_m", F.filter("_s", lambda x, k: (
              (x["h"] == F.get("_s", k - 1)["h"]) | (x["h"] == F.get("_s", k + 1)["h"]))))
          .withColumn("_p", F.array_sort(F.transform("_m", lambda x: x["i"]))))
    covered = F.aggregate(
        F.transform("_p", lambda p, k: F.least(
            F.lit(WINDOW), F.coalesce(F.get("_p", k + 1) - p, F.lit(WINDOW)))),
        F.lit(0), lambda a, x: a + x)
    return df.withColumn(out, F.coalesce(covered, F.lit(0)).cast("long")).drop(
        "_h", "_g", "_s", "_m", "_p")


STATISTICS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
              "n_bangs", "n_upper")


def text_statistics(docs: DataFrame, *carry: str) -> DataFrame:
    """``doc_id``, the columns ``carry`` and the ``STATISTICS`` of every row's whole text.

    A null text counts as empty (all zero); words are runs of anything but ASCII white space;
    repeated rows are measured each; other columns are ignored."""
    text = F.col("text")
    d = (docs.select("doc_id", F.coalesce(text, F.lit("")).alias("text"), *carry)
         .withColumn("_w", F.filter(F.split(text, SEPARATORS), lambda w: w != ""))
         .withColumn("_l", F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))))
    d = d.select(
        "doc_id", *carry, "_w", F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        _count(text, r"[#*$%&|<>]").alias("n_symbols"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        _count(text, "!").alias("n_bangs"), _count(text, "[A-Z]").alias("n_upper"))
    return repeated_window_words(d, "_w", "n_repeat_words").select("doc_id", *carry, *STATISTICS)


def base_failed() -> Column:
    """Too short, or more than a fifth of the words repeated."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def rule_features() -> dict[str, Column]:
    """What rules may test: numbers in the units a reader expects."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "words": F.col("n_words").cast("double"),
        "chars_per_word": F.col("word_chars") / words,
        "symbols_per_word": F.col("n_symbols") / words,
        "bangs_per_word": F.col("n_bangs") / words,
        "upper_share": F.col("n_upper") / F.greatest(F.col("word_chars"), F.lit(1)),
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeat_share": F.col("n_repeat_words") / words,
    }


@dataclass(frozen=True)
class Test:
    """``feature`` above (or not above) ``cut``, the ``bin``-th cut of the feature."""

    feature: str
    above: bool
    bin: int
    cut: float

    def on_bins(self) -> Column:
        return F.col(self.feature) > self.bin if self.above else F.col(self.feature) <= self.bin

    def on_rows(self) -> Column:
        x = rule_features()[self.feature]
        return x > self.cut if self.above else x <= self.cut

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:.6g}"


Rule = tuple[Test, ...]


def _all(tests) -> Column:
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def _cuts(rows: DataFrame) -> dict[str, list[float]]:
    """Distinct quantiles of every feature, over all rows and over the bad rows alone."""
    steps = [(i + 0.5) / CUTS for i in range(CUTS)]
    q = rows.agg(*[F.percentile_approx(F.when(c, F.col(f)), steps, 10_000).alias(f"{f}_{n}")
                   for f in rule_features()
                   for n, c in (("all", F.lit(True)), ("bad", F.col("bad") == 1))]).first()
    return {f: sorted({*(q[f"{f}_all"] or []), *(q[f"{f}_bad"] or [])}) for f in rule_features()}


def _grow(cells: DataFrame, cuts: dict[str, list[float]], most: int) -> Rule:
    """Add the test with the best FOIL gain until nothing good is covered."""
    from math import log2

    rule: list[Test] = []
    while len(rule) < most:
        pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("b"))
                                    for f in cuts]))
        got = (cells.filter(_all(t.on_bins() for t in rule))
               .select(pairs.alias("x"), "bad", "n").groupBy("x.f", "x.b")
               .agg(F.sum(F.when(F.col("bad") == 1, F.col("n")).otherwise(0)).alias("p"),
                    F.sum(F.when(F.col("bad") == 0, F.col("n")).otherwise(0)).alias("g"))
               .collect())  # at most features x (cuts + 1) rows
        first = next(iter(cuts))
        p0 = sum(r["p"] for r in got if r["f"] == first)
        g0 = sum(r["g"] for r in got if r["f"] == first)
        if p0 == 0 or g0 == 0:
            break
        best, choice = 1e-9, None
        for f in cuts:
            hist = {r["b"]: (r["p"], r["g"]) for r in got if r["f"] == f}
            low_p = low_g = 0
            for b, cut in enumerate(cuts[f]):
                p, g = hist.get(b, (0, 0))
                low_p, low_g = low_p + p, low_g + g
                for above, (p, g) in ((False, (low_p, low_g)), (True, (p0 - low_p, g0 - low_g))):
                    if p:
                        gain = p * (log2(p / (p + g)) - log2(p0 / (p0 + g0)))
                        if gain > best:
                            best, choice = gain, Test(f, above, b, cut)
        if choice is None:
            break
        rule.append(choice)
    return tuple(rule)


def _prune(cells: DataFrame, rule: Rule) -> tuple[Rule, int, int]:
    """The shortest prefix of the rule with the best (bad - good) / covered on held-out cells."""
    sums = []
    for k in range(1, len(rule) + 1):
        hit = _all(t.on_bins() for t in rule[:k])
        for name, c in (("p", F.col("bad") == 1), ("g", F.col("bad") == 0)):
            sums.append(F.sum(F.when(hit & c, F.col("n")).otherwise(0)).alias(f"{name}{k}"))
    r = cells.agg(*sums).first()
    worth = [((r[f"p{k}"] or 0) - (r[f"g{k}"] or 0)) / ((r[f"p{k}"] or 0) + (r[f"g{k}"] or 0) + 1)
             for k in range(1, len(rule) + 1)]
    k = worth.index(max(worth)) + 1
    return rule[:k], r[f"p{k}"] or 0, r[f"g{k}"] or 0


def labelled(labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS) -> DataFrame:
    """``(doc_id, bad)`` of at most ``max_rows`` labelled ids, the ones with the smallest
    hashes. Of several labels of an id the smallest counts; null labels and null ids teach
    nothing."""
    return (labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
            .groupBy("doc_id").agg((F.min(label) == 0).cast("int").alias("bad"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))


def learn_rules(stats: DataFrame, picked: DataFrame, *, max_rules: int = 12, max_tests: int = 4,
                precision: float = 0.9, least_share: float = 0.005) -> list[Rule]:
    """Rules that recognise bad rows of ``picked`` (see ``labelled``) by their statistics,
    each right on ``precision`` of the held-out rows it covers and covering ``least_share``
    of the bad ones; without bad rows there is no rule."""
    feats = rule_features()
    rows = (stats.filter(~base_failed()).join(F.broadcast(picked), "doc_id")
            .select("bad", (F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(3)) == 0)
                    .alias("held"), *[c.alias(f) for f, c in feats.items()]))
    rows = cut_lineage(rows)
    cuts = {f: c for f, c in _cuts(rows).items() if c}
    if not cuts:
        return []

    def bin_of(f: str) -> Column:
        return F.size(F.filter(F.array(*map(F.lit, cuts[f])), lambda c: F.col(f) > c))

    binned = rows.select("bad", "held", *[bin_of(f).alias(f) for f in cuts])
    cells = cut_lineage(binned.groupBy(*binned.columns).agg(F.count(F.lit(1)).alias("n")))
    n_bad = cells.filter("bad = 1 AND held").agg(F.sum("n")).first()[0] or 0
    rules: list[Rule] = []
    while len(rules) < max_rules:
        rest = cells.filter(_all(~_all(t.on_bins() for t in r) for r in rules))
        rule = _grow(rest.filter(~F.col("held")), cuts, max_tests)
        if not rule:
            break
        rule, bad, good = _prune(rest.filter("held"), rule)
        if bad < max(2, least_share * n_bad) or bad < precision * (bad + good):
            break
        rules.append(rule)
    return rules


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that rejects a row (from 1), 0 when none does."""
    out = None
    for i, r in enumerate(rules, 1):
        hit = _all(t.on_rows() for t in r)
        out = F.when(hit, i) if out is None else out.when(hit, i)
    return F.lit(0) if out is None else out.otherwise(0)


def judge(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``doc_id``, the ``STATISTICS``, ``base_failed``, ``rule`` and ``kept`` for every row of
    ``docs``; ``kept`` needs the base test and no rule against the text."""
    stats = cut_lineage(text_statistics(docs))
    rules = learn_rules(stats, labelled(labels), **options)
    return (stats.withColumn("base_failed", base_failed()).withColumn("rule", verdict(rules))
            .withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0)))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, columns unchanged. Rules are learned from the
    labelled rows alone; the verdict is evaluated inside each row, without a join."""
    picked = cut_lineage(labelled(labels))
    sample = docs.join(F.broadcast(picked.select("doc_id")), "doc_id", "left_semi")
    rules = learn_rules(cut_lineage(text_statistics(sample)), picked, **options)
    rows = text_statistics(docs.select("doc_id", "text", F.struct(*docs.columns).alias("_row")), "_row")
    # through a generator, so that the filter reads the statistics and does not repeat them
    rows = rows.select("_row", F.explode(F.array(F.struct(*STATISTICS))).alias("_s")).select("_row", "_s.*")
    return rows.filter(~base_failed() & (verdict(rules) == 0)).select("_row.*")
