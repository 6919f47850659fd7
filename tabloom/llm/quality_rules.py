"""Quality rules as a learned decision list, kept and applied as Spark conditional expressions."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tabloom.llm.common import in_fit_fold

#: White space that separates words, and the symbols that are counted.
SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
#: Rows that the list is learned from at most (the lowest hashes of their ids), and thresholds tried per statistic.
FIT_ROWS = 20_000
CUTS = 24
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SHARES = ["mean_word", "symbol_share", "repeat_share", "upper_share", "digit_share", "mark_share", "line_words"]


@dataclass(frozen=True)
class Rule:
    """All tests (statistic, "<=" or ">", threshold) hold: the verdict is ``keep``."""

    tests: tuple[tuple[str, str, float], ...]
    keep: bool

    def condition(self) -> Column:
        out = F.lit(True)
        for name, sign, cut in self.tests:
            out = out & (F.col(name) <= cut if sign == "<=" else F.col(name) > cut)
        return out

    def holds(self, row) -> bool:
        return all(row[n] <= c if s == "<=" else row[n] > c for n, s, c in self.tests)


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add counts of every whole text, as columns and without a shuffle.

    ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines`` (lines with a word, equal to an earlier one),
    ``n_repeat_words`` (words in windows of three found twice or more) and shares of them. A null text counts
    as an empty one; shares of nothing are 0. Input columns of the result names are replaced.

    Repeated windows: each window is hashed, hash and place are sorted together, a place next to an equal hash repeats; the
    windows' places in order then cover min(3, gap) words each.
    """
    body = F.coalesce(F.col("_text"), F.lit(""))
    results = [*STATS, *SHARES]
    if text in results:
        raise ValueError(f"the text column may not be named {text}")
    kept = [c for c in docs.columns if c not in results]
    # the input row is one struct from here on, so that no column of it meets one of these helpers
    split = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"), F.col(f"`{text}`").alias("_text"))
    split = split.withColumn("_w", F.expr("filter(split(coalesce(_text, ''), '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w != '')"))
    split = split.withColumn("n_words", F.size("_w").cast("long"))
    windows = F.expr("""case when n_words < 4 then cast(array() as array<struct<h:bigint,i:int>>) else
        array_sort(transform(sequence(0, cast(n_words as int) - 3),
            i -> named_struct('h', xxhash64(_w[i], _w[i + 1], _w[i + 2]), 'i', i))) end""")
    split = split.withColumn("_s", windows)
    again = F.expr("""array_sort(transform(filter(transform(_s, (x, k) -> named_struct('i', x.i, 'd',
        (k > 0 and _s[greatest(k - 1, 0)].h = x.h) or (k + 1 < size(_s) and _s[least(k + 1, size(_s) - 1)].h = x.h))),
        x -> x.d), x -> x.i))""")
    split = split.withColumn("_p", again).drop("_s")
    covered = F.expr("""case when size(_p) = 0 then 0L else
        aggregate(_p, named_struct('at', -3, 'n', 0L), (a, i) -> named_struct('at', i, 'n', a.n + least(3, i - a.at)), a -> a.n) end""")
    lines = F.expr("filter(split(coalesce(_text, ''), '\\n'), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]')")
    split = split.withColumns({
        "word_chars": F.length(F.array_join("_w", "")).cast("long"),
        "n_symbols": F.regexp_count(body, F.lit(SYMBOLS)).cast("long"),
        "n_repeat_words": covered,
        "_l": lines,
    }).drop("_w", "_p")
    split = split.withColumns({
        "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
        "line_words": F.col("n_words") / F.greatest(F.size("_l"), F.lit(1)),
        "_u": F.regexp_count(body, F.lit(r"\p{Lu}")),
        "_d": F.regexp_count(body, F.lit("[0-9]")),
        "_m": F.regexp_count(body, F.lit(r"[^\p{L}\p{N}\s]")),
    }).drop("_l")
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    split = split.withColumns({
        "mean_word": F.col("word_chars") / words,
        "symbol_share": F.col("n_symbols") / words,
        "repeat_share": F.col("n_repeat_words") / words,
        "upper_share": F.col("_u") / chars,
        "digit_share": F.col("_d") / chars,
        "mark_share": F.col("_m") / words,
    })
    return split.select("_row.*", *results)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _gain(p: int, n: int, p_before: int, n_before: int) -> float:
    """Information gained by the covered rejects when a test is added."""
    if not p:
        return -math.inf
    return p * (math.log2(p / (p + n)) - math.log2(p_before / (p_before + n_before)))


def _cuts(rows: list, name: str) -> list[float]:
    values = sorted(r[name] for r in rows)
    return sorted({float(values[min(len(values) - 1, k * len(values) // CUTS)]) for k in range(CUTS)} | {float(values[-1])})


def _grow(rows: list, names: list[str]) -> tuple:
    """Add the test of most gain until no good row is covered or nothing is gained."""
    tests: tuple = ()
    inside = rows
    while len(tests) < 4:
        p = sum(not r["good"] for r in inside)
        n = len(inside) - p
        if not p or not n:
            break
        best, chosen = 1e-9, None
        for name in names:
            for cut in _cuts(inside, name):
                below = [r["good"] for r in inside if r[name] <= cut]
                bad = len(below) - sum(below)
                for sign, pk, nk in (("<=", bad, len(below) - bad), (">", p - bad, n - (len(below) - bad))):
                    gain = _gain(pk, nk, p, n)
                    if gain > best:
                        best, chosen = gain, (name, sign, cut)
        if chosen is None:
            break
        tests += (chosen,)
        inside = [r for r in inside if Rule((chosen,), False).holds(r)]
    return tests


def _worth(tests: tuple, rows: list) -> float:
    covered = [r["good"] for r in rows if Rule(tests, False).holds(r)]
    good = sum(covered)
    return (len(covered) - 2 * good) / len(covered) if covered else -1.0


def _prune(tests: tuple, rows: list) -> tuple:
    """Drop last tests while the held-back rows do not object."""
    best = tests
    for k in range(len(tests) - 1, 0, -1):
        if _worth(tests[:k], rows) >= _worth(best, rows):
            best = tests[:k]
    return best


def learn_list(rows: list, names: list[str], purity: float = 0.8, least: int = 5, most: int = 16) -> list[Rule]:
    """Sequential covering: two thirds of the rows grow a rule for rejects, the rest prunes it; the covered rows go, and
    so on until a rule is no longer pure. Rows that no rule covers are kept. Without rejects the list is empty."""
    rules: list[Rule] = []
    grow, hold = [r for i, r in enumerate(rows) if i % 3], [r for i, r in enumerate(rows) if i % 3 == 0]
    while len(rules) < most and any(not r["good"] for r in grow):
        tests = _grow(grow, names)
        tests = _prune(tests, hold or grow) if tests else tests
        if not tests:
            break
        rule = Rule(tests, False)
        covered = [r["good"] for r in [*grow, *hold] if rule.holds(r)]
        if len(covered) < least or 1 - sum(covered) / len(covered) < purity:
            break
        rules.append(rule)
        grow, hold = [r for r in grow if not rule.holds(r)], [r for r in hold if not rule.holds(r)]
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The ordered list as one conditional expression; rows that no rule covers are kept."""
    out = None
    for rule in rules:
        out = F.when(rule.condition(), F.lit(rule.keep)) if out is None else out.when(rule.condition(), F.lit(rule.keep))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def fit_rules(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality",
              fit_rows: int = FIT_ROWS) -> list[Rule]:
    """Learn the list from labelled documents of the fit fold, ``fit_rows`` of them at most.

    Labels choose the rows first; only their texts are measured. Documents or labels without an id or a
    label are not used; an id with several labels takes the lowest.
    """
    names = [*STATS, *SHARES]
    chosen = (labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull() & in_fit_fold(F.col(key)))
              .groupBy(key).agg(F.min(label).alias("_y"))
              .orderBy(F.xxhash64(key), key).limit(fit_rows))
    # at most fit_rows short rows, so the bound of the broadcast is the parameter
    rows = docs.select(F.col(key).alias("_k"), F.col(text).alias("_t")).join(F.broadcast(chosen.withColumnRenamed(key, "_k")), "_k")
    seen = text_statistics(rows, "_t").select("_k", (F.col("_y") > 0).alias("good"), *names).orderBy(F.xxhash64("_k"), "_k", *names)
    return learn_list([r.asDict() for r in seen.limit(fit_rows).collect()], names)


def apply_rules(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """Statistics of every text, ``base_failed`` and ``kept``: false where the base rules fail,
    else the verdict of the list. A null or empty text fails the base rules. Texts of any length are measured whole; repeated rows are judged
    alike; an empty table gives an empty one."""
    stats = text_statistics(docs.drop("base_failed", "kept"), text)
    return stats.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & verdict(rules))
