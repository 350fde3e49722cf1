"""Quality rules with risk-controlled thresholds.

Method: every rule rejects texts whose value lies above a cutoff.  Labelled documents are the
holdout: in each stratum (language) and for each rule, the number of good documents above a
cutoff is a binomial count.  A cutoff is certified if, were the rule to reject a share RISK
of good documents, so few rejections would have probability at most ERROR / m, with m all
tests made (strata x rules x cutoffs: Bonferroni), by the exact binomial tail.  Of the certified cutoffs the one
that separates bad from good labels best is taken, the loosest on a tie; a rule
without one rejects nothing.  With probability 1 - ERROR, no rule rejects more than a share RISK of the good
documents of any stratum.

All steps are DataFrame expressions.  Counts are made in one pass over whole texts; 8-word
windows are hashed and compared within the row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, only, stored

#: Most false rejections of a rule in a stratum, and the chance that any guarantee fails.
RISK, ERROR = 0.01, 0.05
#: Candidate cutoffs of each rule's value.
CUTOFFS: dict[str, list[float]] = {
    "symbols": [0.02, 0.03, 0.05, 0.08, 0.1, 0.12, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5],
    "word_length": [8, 9, 10, 11, 12, 14, 16, 20, 30, 50],
    "dup_lines": [0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8],
    "repeats": [0.02, 0.05, 0.08, 0.1, 0.12, 0.15, 0.2, 0.25],
    "capitals": [0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8],
}
WINDOW = 8
#: Terms of a binomial tail that are added one by one; a geometric bound covers the rest.
TERMS = 2000


def _bind(value: Column, body) -> Column:
    """body(x) with x computed once (a lambda's variable is a value, not an expression)."""
    return F.transform(F.array(value), body)[0]


def _repeats(windows: Column) -> Column:
    """Words covered by windows (hashes, in order) that occur twice or more."""
    def of_sorted(s: Column) -> Column:
        twice = lambda j: ((j > 0) & (s[j]["h"] == F.get(s, j - 1)["h"])) | (
            (j < F.size(s) - 1) & (s[j]["h"] == F.get(s, j + 1)["h"]))
        at = F.sort_array(F.transform(F.filter(F.sequence(F.lit(0), F.size(s) - 1), twice), lambda j: F.get(s, j)["i"]))
        return _bind(at, lambda p: F.aggregate(
            F.zip_with(p, F.slice(p, 2, F.size(p)), lambda a, b: F.coalesce(F.least(b - a, F.lit(WINDOW)), F.lit(WINDOW))),
            F.lit(0).cast("long"), lambda total, x: total + x))

    ordered = F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    return F.when(F.size(windows) == F.size(F.array_distinct(windows)), F.lit(0).cast("long")).otherwise(_bind(ordered, of_sorted))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """Per row: id, stratum, the counts, base_failed and the rules' values (v_<rule>)."""
    t = only(docs, id_col, text_col, stratum_col).toDF("id", "text", "stratum").withColumn("text", F.coalesce("text", F.lit("")))
    t = t.withColumn("words", F.array_remove(F.split("text", SPACE), ""))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    starts = F.when(F.size("words") >= WINDOW, F.sequence(F.lit(1), F.size("words") - (WINDOW - 1))).otherwise(F.array().cast("array<int>"))
    t = t.select(
        "id", F.coalesce("stratum", F.lit("")).alias("stratum"),
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", "[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("text", "[^A-Z]+", "")).cast("long").alias("n_capitals"),
        lines.alias("lines"),
        F.transform(starts, lambda i: F.xxhash64(F.slice("words", i, WINDOW))).alias("windows"))
    t = t.select("id", "stratum", "n_words", "word_chars", "n_symbols", "n_capitals", F.size("lines").cast("long").alias("n_lines"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                 _repeats(F.col("windows")).alias("n_repeat_words"))
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return t.withColumns({
        "base_failed": (F.col("n_words") < 20) | (F.lit(100) * F.col("n_repeat_words") > F.lit(30) * F.col("n_words")),
        "v_symbols": share("n_symbols", "word_chars"), "v_word_length": share("word_chars", "n_words"),
        "v_dup_lines": share("n_dup_lines", "n_lines"), "v_repeats": share("n_repeat_words", "n_words"),
        "v_capitals": share("n_capitals", "word_chars")})


def _log_factorial(x: Column) -> Column:
    """ln x! by Stirling's series at x + 11, stepped back; error below 1e-11."""
    y = x + F.lit(11.0)
    series = (y - 0.5) * F.log(y) - y + F.lit(0.9189385332046727) + 1 / (12 * y) - 1 / (360 * y * y * y)
    return series - reduce(lambda a, b: a + b, [F.log(x + F.lit(float(i))) for i in range(1, 11)])


def tail(n: Column, k: Column, risk: float) -> Column:
    """P(Binomial(n, risk) <= k), never too small: 1 where k is not below n * risk.

    The terms fall from k downwards; those after TERMS are bounded by a geometric series."""
    n, k = n.cast("double"), k.cast("double")
    first = F.exp(_log_factorial(n) - _log_factorial(k) - _log_factorial(n - k) + k * F.log(F.lit(risk)) + (n - k) * F.log1p(F.lit(-risk)))
    down = lambda i: i / (n - i + 1) * ((1 - risk) / risk)  # noqa: E731  term(i - 1) / term(i)
    steps = F.sequence(F.lit(0), F.least(k, F.lit(float(TERMS))).cast("int"))
    state = F.aggregate(
        steps, F.struct(F.lit(0.0).alias("sum"), F.lit(1.0).alias("term")),
        lambda s, j: F.struct((s["sum"] + s["term"]).alias("sum"), (s["term"] * down(k - j.cast("double"))).alias("term")))
    ratio = down(F.greatest(k - TERMS, F.lit(0.0)))
    whole = first * (state["sum"] + F.when(k > TERMS, state["term"] / (1 - ratio)).otherwise(F.lit(0.0)))
    return F.when(k < n * risk, F.least(whole, F.lit(1.0))).otherwise(F.lit(1.0))


def certify(measured: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """(stratum, cut_<rule> ...): the certified cutoffs; null where a rule has none.

    Labels that are null or neither 0 nor 1 are left out; repeated label rows count once."""
    lab = only(labels, id_col, label_col).toDF("id", "good").where("id is not null and good in (0, 1)").distinct()
    held = measured.where("not base_failed").join(lab, "id")
    over = {f"{rule}_{i}_{g}": F.count(F.when((F.col(f"v_{rule}") > c) & (F.col("good") == g), 1))
            for rule, cuts in CUTOFFS.items() for i, c in enumerate(cuts) for g in (0, 1)}
    counts = held.groupBy("stratum").agg(*[c.alias(n) for n, c in over.items()], F.count(F.when(F.col("good") == 1, 1)).alias("n1"),
                                         F.count(F.when(F.col("good") == 0, 1)).alias("n0"))
    tries = [F.struct(F.lit(rule).alias("rule"), F.lit(float(c)).alias("cut"), F.col(f"{rule}_{i}_1").alias("k1"), F.col(f"{rule}_{i}_0").alias("k0"))
             for rule, cuts in CUTOFFS.items() for i, c in enumerate(cuts)]
    tests = counts.select("stratum", "n1", "n0", F.explode(F.array(*tries)).alias("t")).select("stratum", "n1", "n0", "t.*")
    m = stored(tests, "tests")
    made = max(1, m.count())
    sure = m.where("n1 > 0 and k0 > 0").where(tail(F.col("n1"), F.col("k1"), RISK) <= ERROR / made)
    gain = F.col("k0") / F.greatest("n0", F.lit(1)) - F.col("k1") / F.col("n1")
    best = sure.where(gain > 0).groupBy("stratum", "rule").agg(F.max(F.struct(gain.alias("gain"), "cut"))["cut"].alias("cut"))
    return best.groupBy("stratum").pivot("rule", list(CUTOFFS)).agg(F.first("cut")).select(
        "stratum", *[F.col(r).alias(f"cut_{r}") for r in CUTOFFS])


#: Strata whose cutoffs are sent to all tasks; more are joined by a shuffle.
BROADCAST_STRATA = 10_000


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
          label_id: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """Per row: id, the counts, base_failed, kept and the stratum's cutoffs.

    A null or wordless text has no words and fails the base; a null stratum is one of
    its own; null and repeated ids are judged row by row.  An empty table gives an empty result.
    """
    rows = stored(measure(docs, id_col, text_col, stratum_col), "quality")
    cuts = stored(certify(rows, labels, label_id, label_col), "cutoffs")
    small = cuts.count() <= BROADCAST_STRATA
    out = rows.join(F.broadcast(cuts) if small else cuts, "stratum", "left")
    above = reduce(lambda a, b: a | b, [F.coalesce(F.col(f"v_{r}") > F.col(f"cut_{r}"), F.lit(False)) for r in CUTOFFS])
    return out.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      (~F.col("base_failed") & ~above).alias("kept"), *[f"cut_{r}" for r in CUTOFFS])
