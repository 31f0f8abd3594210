"""Quality rules: a table of thresholds compiled into one projection.

Every metric is a built-in expression over one row, so the whole operator is a scan and a
projection: no shuffle, no Python, nothing that depends on other rows.

Defined cases: a null or empty text has no words and fails on length; ratios of an empty text are
0; a null metric (never produced here) passes no bound; repeated rows are judged alike; extra
columns are kept by `metrics` and dropped by `judge`'s caller as it likes. Two three-word windows
count as equal when their 64-bit hashes are: in a text of n words a false match has a chance of
about n^2 / 2^65.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthlake.functions.columns import computed_once
from monthlake.llm import text as tx

SYMBOLS = "#*$%&|<>"
WINDOW = 3
# Frequent function words of the four languages of the corpus.
STOP_WORDS = [
    "the", "of", "and", "to", "in", "that", "is", "was", "for", "it", "with", "as", "on", "be", "at", "by",
    "der", "die", "und", "das", "ist", "nicht", "von", "mit", "den", "des", "ein", "eine", "zu", "auf",
    "de", "la", "le", "et", "les", "un", "une", "que", "dans", "pour", "qui", "sur", "par", "en",
    "el", "los", "las", "y", "se", "del", "con", "su", "al", "lo", "para", "no",
]


@dataclass(frozen=True)
class Rule:
    """A metric has to lie within [low, high]; a bound that is None is open."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None


#: Ratios are per word, per line or per code point as named. Contract rules come first.
RULES = (
    Rule("too_short", "n_words", low=50),
    Rule("repeated_windows", "repeat_ratio", high=0.5),
    Rule("mean_word_length", "mean_word_chars", low=2.0, high=14.0),
    Rule("symbols", "symbol_ratio", high=0.3),
    Rule("exclamations", "exclamation_ratio", high=0.3),
    Rule("duplicate_lines", "dup_line_ratio", high=0.5),
    Rule("few_stop_words", "stop_ratio", low=0.04),
    Rule("upper_case", "upper_ratio", high=0.5),
)
BASE = ("too_short", "repeated_windows")


def _ratio(count: Column, of: Column) -> Column:
    return F.when(of > 0, count / of).otherwise(F.lit(0.0))


def _windows(words: Column) -> Column:
    """A 64-bit hash for each place where a three-word window starts."""
    return F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - (WINDOW - 1), F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)),
    )


def _sorted_windows(hashes: Column) -> Column:
    """(hash, place), sorted; null where all windows of a text differ, which spares the sort."""
    pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), F.sort_array(pairs))


def _repeated_places(windows: Column) -> Column:
    """Places, in order, of the windows that occur twice or more: equal ones are neighbours."""
    same = lambda x, k: F.coalesce(F.get(windows, k)["h"] == x["h"], F.lit(False))
    again = F.filter(windows, lambda x, k: same(x, k - 1) | same(x, k + 1))
    return F.sort_array(F.transform(again, lambda x: x["i"]))


def _covered(places: Column) -> Column:
    """Words inside those windows: each place covers up to the next one, three words at most."""
    steps = F.transform(
        places, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(places, k + 1) - p, F.lit(WINDOW)))
    )
    return F.coalesce(F.aggregate(steps, F.lit(0), lambda s, x: s + x), F.lit(0))


def metrics(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of `docs` but the text's, and every metric the rules may name."""
    keep = [F.col(f"`{c}`") for c in docs.columns]
    body = F.coalesce(F.col("_t"), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(tx.WORD))
    first = docs.select(F.struct(*keep).alias("_row"), F.col(f"`{text}`").alias("_t")).select(
        "_row",
        tx.words(F.col("_t")).alias("_w"),
        lines.alias("_l"),
        # One pass leaves the few characters that are counted below.
        F.regexp_replace(body, f"[^{SYMBOLS}!A-Z]+", "").alias("_s"),
    )
    counted = first.select(
        "_row",
        F.size("_w").cast("long").alias("n_words"),
        F.char_length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        tx.count_of(F.col("_s"), SYMBOLS).cast("long").alias("n_symbols"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        tx.count_of(F.col("_s"), "!").cast("long").alias("n_exclamations"),
        F.char_length(F.translate("_s", SYMBOLS + "!", "")).cast("long").alias("n_upper"),
        F.size(F.filter("_w", lambda w: w.isin(STOP_WORDS))).cast("long").alias("n_stops"),
        _windows(F.col("_w")).alias("_h"),
    )
    ordered = counted.withColumn("_windows", _sorted_windows(F.col("_h"))).drop("_h")
    placed = ordered.withColumn("_places", _repeated_places(F.col("_windows"))).drop("_windows")
    covered = placed.withColumn("n_repeat_words", _covered(F.col("_places")).cast("long")).drop("_places")
    n, chars = F.col("n_words"), F.col("word_chars")
    return covered.select(
        "*",
        _ratio(F.col("n_repeat_words"), n).alias("repeat_ratio"),
        _ratio(chars, n).alias("mean_word_chars"),
        _ratio(F.col("n_symbols"), n).alias("symbol_ratio"),
        _ratio(F.col("n_exclamations"), n).alias("exclamation_ratio"),
        _ratio(F.col("n_dup_lines"), F.col("n_lines")).alias("dup_line_ratio"),
        _ratio(F.col("n_stops"), n).alias("stop_ratio"),
        _ratio(F.col("n_upper"), chars).alias("upper_ratio"),
    )


def broken(rule: Rule) -> Column:
    bounds = []
    if rule.low is not None:
        bounds.append(F.col(rule.metric) < rule.low)
    if rule.high is not None:
        bounds.append(F.col(rule.metric) > rule.high)
    return reduce(lambda a, b: a | b, bounds)


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """`_row` (the input row), the metrics, `broken_rules` (names, in table order) and `kept`."""
    names = F.filter(F.array(*[F.when(broken(r), r.name) for r in rules]), lambda x: x.isNotNull())
    # Else a filter on the verdict would carry copies of all metrics below it.
    judged = computed_once(metrics(docs, text), "broken_rules", names)
    return judged.withColumn("kept", F.size("broken_rules") == 0)


def op2_quality_rules(spark, sf_dir: str) -> DataFrame:
    judged = judge(tx.documents(spark, sf_dir).select("doc_id", "text"))
    # Contract's own integer test of the repeats, so no rounding of a ratio decides it.
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select(
        F.col("_row.doc_id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base.alias("base_failed"),
        (~base & F.col("kept")).alias("kept"),
        F.concat_ws(",", "broken_rules").alias("broken_rules"),
    )


_STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS)

OP2_SQL = rf"""
with split_words as (
  select doc_id, coalesce(text, '') as t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
  from documents),
wins as (
  select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g
  from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from split_words)),
places as (
  select doc_id, i, lead(i) over (partition by doc_id order by i) as nxt
  from (select doc_id, i, count(*) over (partition by doc_id, g) as c from wins) where c >= 2),
covered as (select doc_id, sum(least(3, coalesce(nxt - i, 3))) as n from places group by doc_id),
counts as (
  select s.doc_id, len(w) as n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) as word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols,
         len(l) as n_lines, len(l) - len(list_distinct(l)) as n_dup_lines,
         length(t) - length(replace(t, '!', '')) as n_ex,
         length(regexp_replace(t, '[^A-Z]', '', 'g')) as n_upper,
         len(list_filter(w, lambda x: x in ({_STOPS}))) as n_stops,
         coalesce(c.n, 0) as n_repeat
  from split_words s left join covered c on s.doc_id = c.doc_id),
flags as (
  select *, n_words < 50 as b1, n_words > 0 and n_repeat / n_words > 0.5 as b2,
         n_words = 0 or word_chars / n_words < 2.0 or word_chars / n_words > 14.0 as b3,
         n_words > 0 and n_symbols / n_words > 0.3 as b4, n_words > 0 and n_ex / n_words > 0.3 as b5,
         n_lines > 0 and n_dup_lines / n_lines > 0.5 as b6,
         n_words = 0 or n_stops / n_words < 0.04 as b7,
         word_chars > 0 and n_upper / word_chars > 0.5 as b8
  from counts)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars,
       cast(n_symbols as bigint) as n_symbols, cast(n_dup_lines as bigint) as n_dup_lines,
       cast(n_repeat as bigint) as n_repeat_words,
       n_words < 50 or 100 * n_repeat > 50 * n_words as base_failed,
       not (n_words < 50 or 100 * n_repeat > 50 * n_words or b1 or b2 or b3 or b4 or b5 or b6 or b7 or b8) as kept,
       concat_ws(',', case when b1 then 'too_short' end, case when b2 then 'repeated_windows' end,
                 case when b3 then 'mean_word_length' end, case when b4 then 'symbols' end,
                 case when b5 then 'exclamations' end, case when b6 then 'duplicate_lines' end,
                 case when b7 then 'few_stop_words' end, case when b8 then 'upper_case' end) as broken_rules
from flags
"""
