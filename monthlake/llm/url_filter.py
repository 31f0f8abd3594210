"""URL filters: host and path rules first, then a weighted vocabulary counted with Aho-Corasick.

Host, path and rules are built-in expressions. The vocabulary runs in Arrow batches: one automaton
per Python worker, made from the terms, which are a parameter of bounded size. A term counts where
the characters beside it are not letters or digits (or the text ends), so "bet" does not count in
"alphabet". One strict term, or different soft terms that weigh `soft_limit` together, block a url.

Defined cases: a null url, or one without "://", has empty host and path, fits no rule, and is
judged by its own characters (null: allowed). Repeated rows are judged alike; extra columns are kept, but
for those named like a result (host, path, rule, verdict, strict_hits, soft_terms, soft_weight), which are
replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthlake.llm.url_terms import SOFT, SOFT_LIMIT, STRICT

@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def _after_scheme(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1)), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The longest rule that fits, as a struct of rule and verdict; null where none does."""
    ordered = sorted(rules, key=lambda r: (-len(r.name), r.name))
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in reversed(ordered):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        found = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


@lru_cache(maxsize=4)
def _automaton(vocabulary: str):
    import ahocorasick

    machine = ahocorasick.Automaton()
    for term, weight in json.loads(vocabulary):
        machine.add_word(term, (term, weight))
    machine.make_automaton()
    return machine


def term_hits(url: str, machine) -> tuple[int, int, int]:
    """Occurrences of strict terms, the number of different soft terms, and their weights together."""
    strict, soft, last = 0, {}, len(url) - 1
    for end, (term, weight) in machine.iter(url):
        start = end - len(term) + 1
        if (start and _in_word(url[start - 1])) or (end < last and _in_word(url[end + 1])):
            continue
        if weight is None:
            strict += 1
        else:
            soft[term] = weight
    return strict, len(soft), sum(soft.values())


def _in_word(c: str) -> bool:
    return "a" <= c <= "z" or "0" <= c <= "9"


def hits(url: Column, strict: list[str] = STRICT, soft: dict[str, int] = SOFT) -> Column:
    """struct<strict, soft, weight> of a lower-cased url. A term in both lists is strict."""
    vocabulary = json.dumps([*soft.items(), *([t, None] for t in strict)])

    @F.pandas_udf("strict long, soft long, weight long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        machine = _automaton(vocabulary)
        for urls in batches:
            found = [term_hits(u, machine) if u else (0, 0, 0) for u in urls]
            yield pd.DataFrame(found, columns=["strict", "soft", "weight"], dtype="int64")

    return count(url)


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, soft_limit: int = SOFT_LIMIT) -> DataFrame:
    """`pages` with host, path, rule, strict_hits, soft_terms, soft_weight and verdict."""
    parsed = (
        pages.withColumn("host", host(F.col("url")))
        .withColumn("path", path(F.col("url")))
        .withColumn("_hits", hits(lower_ascii(F.col("url"))))
    )
    by_words = F.when((F.col("_hits.strict") > 0) | (F.col("_hits.weight") >= soft_limit), "block").otherwise("allow")
    return (
        parsed.withColumn("_rule", matched_rule(F.col("host"), F.col("path"), rules))
        .withColumn("rule", F.col("_rule.rule"))
        .withColumn("verdict", F.coalesce(F.col("_rule.verdict"), by_words))
        .withColumn("strict_hits", F.col("_hits.strict"))
        .withColumn("soft_terms", F.col("_hits.soft"))
        .withColumn("soft_weight", F.col("_hits.weight"))
        .drop("_rule", "_hits")
    )


def op10_url_filter(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages).select("page_id", "host", "path", "rule", "verdict", "strict_hits", "soft_terms", "soft_weight")


def _count_sql(term: str) -> str:
    # Separators doubled, so that neighbouring terms do not share one.
    return f"len(regexp_extract_all(u, '(?:^|[^a-z0-9]){term}(?:[^a-z0-9]|$)'))"


_STRICT_SQL = " + ".join(_count_sql(t) for t in STRICT)
_SOFT_SQL = ", ".join(f"case when {_count_sql(t)} > 0 then {w} end" for t, w in SOFT.items())

OP10_SQL = rf"""
with p as (
  select page_id, url, case when position('://' in url) > 0 then substr(url, position('://' in url) + 3) end as r,
         regexp_replace(translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                        '([^a-z0-9])', '\1\1', 'g') as u
  from pages),
q as (
  select *, coalesce(translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                               'abcdefghijklmnopqrstuvwxyz'), '') as host,
         coalesce(regexp_extract(r, '^[^/?#]*([^?#]*)', 1), '') as path
  from p),
s as (select *, {_STRICT_SQL} as strict_hits, list_filter([{_SOFT_SQL}], lambda x: x is not null) as soft from q),
v as (select *, len(soft) as soft_terms, coalesce(list_sum(soft), 0) as soft_weight from s),
fits as (
  select v.page_id, v.url, t.rule, t.verdict, row_number() over (partition by v.page_id, v.url order by length(t.rule) desc) as k
  from v join (values ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
                      ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'),
                      ('com/de/', 'com', '/de/', 'block')) t(rule, h, s, verdict)
    on (v.host = t.h or ends_with(v.host, '.' || t.h)) and starts_with(v.path, t.s))
select v.page_id, v.host, v.path, f.rule,
       coalesce(f.verdict, case when strict_hits > 0 or soft_weight >= {SOFT_LIMIT} then 'block' else 'allow' end) as verdict,
       cast(strict_hits as bigint) as strict_hits, cast(soft_terms as bigint) as soft_terms,
       cast(soft_weight as bigint) as soft_weight
from v left join fits f on v.page_id = f.page_id and v.url is not distinct from f.url and f.k = 1
"""
