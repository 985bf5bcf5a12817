"""Quality rules: a table of thresholds compiled into projections of built-in expressions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from syncloom.llm.common import WHITE, fresh, named, white_words

SYMBOLS = "#*$%&|<>"

#: Frequent short words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that for it was on are as with his they at be this from have or by "
    "der die das und den von zu mit sich des auf ist im dem nicht ein eine als auch es an "
    "de la le et les des en un du une que est pour qui dans par sur au "
    "el los y del se las por con no para su al lo"
).split()


@dataclass(frozen=True)
class Rule:
    """A document passes when low <= measure <= high; None leaves that side open."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


#: The verdict of the method. The measures are columns or ratios of `measures`.
RULES = (
    Rule("length", "n_words", 50, 1_000_000),
    Rule("word_length", "chars_per_word", 1.5, 20),
    Rule("symbols", "symbols_per_word", None, 0.2),
    Rule("stop_words", "stop_word_ratio", 0.01, None),
    Rule("repeated_lines", "dup_line_ratio", None, 0.5),
    Rule("repeated_words", "repeat_word_ratio", None, 0.5),
)


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def measures(df: DataFrame, text: str = "text", out: str = "quality") -> DataFrame:
    """The table with a struct column of counts and ratios; an `out` that is there is replaced.

    Words are runs of other characters than ASCII white space, compared as they are. A null text
    counts as empty, and an empty one has 0 in all measures. Every row is measured by itself, so
    repeated rows, null keys and other columns don't matter, and an empty table stays empty.

    A word of three that occur in a row twice or more is repeated. The windows become numbers, the
    upper bits of their hash above their position, so sorting brings equal windows together; words
    are compared before windows count as equal.
    """
    words, lines, bits, keys, spots = fresh(df, "_words", "_lines", "_bits", "_keys", "_spots")
    body = F.coalesce(named(text), F.lit(""))
    split = df.withColumns({words: white_words(named(text)), lines: F.split(body, "\n")})
    n = F.size(words)
    sized = split.withColumn(bits, F.coalesce(F.length(F.bin(n.cast("long"))), F.lit(1)))
    hashed = F.expr(
        f"transform({words}, (w, i) -> shiftleft(xxhash64(w, get({words}, i + 1),"
        f" get({words}, i + 2)), {bits}) | i)"
    )
    windows = F.slice(hashed, 1, F.greatest(n - 2, F.lit(0)))
    keyed = sized.withColumn(keys, F.sort_array(windows))
    mask = f"(shiftleft(1L, {bits}) - 1)"
    at = lambda key, k: f"get({words}, cast({key} & {mask} as int) + {k})"
    equal = " and ".join(f"{at('a', k)} = {at('b', k)}" for k in range(3))
    repeated = F.expr(
        f"flatten(filter(zip_with({keys}, slice({keys}, 2, greatest(size({keys}) - 1, 0)), (a, b)"
        f" -> case when shiftright(a, {bits}) = shiftright(b, {bits}) and {equal}"
        f" then array(a & {mask}, b & {mask}) end), p -> p is not null))"
    )
    spotted = keyed.withColumn(spots, F.sort_array(F.array_distinct(repeated)))
    covered = F.expr(
        f"aggregate(zip_with({spots}, slice({spots}, 2, greatest(size({spots}) - 1, 0)), (a, b) ->"
        " least(3L, coalesce(b - a, 3L))), 0L, (sum, x) -> sum + x)"
    )
    stops = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    full = F.expr(f"filter({lines}, l -> btrim(l, '{WHITE.encode('unicode_escape').decode()}') <> '')")
    counted = spotted.withColumns({lines: full}).withColumn(
        out,
        F.struct(
            n.cast("long").alias("n_words"),
            F.length(F.translate(body, WHITE, "")).cast("long").alias("word_chars"),
            (F.length(body) - F.length(F.translate(body, SYMBOLS, "")))
            .cast("long")
            .alias("n_symbols"),
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            covered.alias("n_repeat_words"),
            F.expr(f"size(filter({words}, w -> w in ({stops})))").cast("long").alias("n_stop_words"),
        ),
    )
    m = named(out)
    ratios = {
        "chars_per_word": _ratio(m["word_chars"], m["n_words"]),
        "symbols_per_word": _ratio(m["n_symbols"], m["n_words"]),
        "stop_word_ratio": _ratio(m["n_stop_words"], m["n_words"]),
        "dup_line_ratio": _ratio(m["n_dup_lines"], m["n_lines"]),
        "repeat_word_ratio": _ratio(m["n_repeat_words"], m["n_words"]),
    }
    kept = [c for c in counted.columns if c not in (words, lines, bits, keys, spots, out)]
    full_struct = reduce(lambda s, name: s.withField(name, ratios[name]), ratios, m)
    return counted.select(*map(named, kept), full_struct.alias(out))


def passes(measured: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The rule table as one condition on the struct of measures."""
    tests = [F.lit(True)]
    for rule in rules:
        if rule.low is not None:
            tests.append(measured[rule.measure] >= rule.low)
        if rule.high is not None:
            tests.append(measured[rule.measure] <= rule.high)
    return reduce(lambda a, b: a & b, tests)


def base_failed(measured: Column) -> Column:
    """Under 50 words, or more than half of the words in repeated windows of three."""
    return (measured["n_words"] < 50) | (
        100 * measured["n_repeat_words"] > 50 * measured["n_words"]
    )


def judge(
    df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, out: str = "quality"
) -> DataFrame:
    """`measures` with `base_failed` and `kept` in the struct; see there for odd input."""
    m = named(out)
    found = measures(df, text, out)
    failed = base_failed(m)
    verdict = m.withField("base_failed", failed).withField("kept", ~failed & passes(m, rules))
    return found.withColumn(out, verdict)


def keep_good(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows that the rules keep, with the columns they came with.

    The guard, a number that is not deterministic to the planner, keeps the condition above the
    projections. Pushed below them, it would work out a row's word list anew for each of its words.
    """
    out, guard = fresh(df, "_quality", "_guard")
    judged = judge(df, text, rules, out).withColumn(guard, F.monotonically_increasing_id())
    good = named(out)["kept"] & (named(guard) >= 0)
    return judged.where(good).drop(out, guard)
