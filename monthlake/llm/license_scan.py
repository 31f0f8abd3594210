"""License scans: templates with optional and replaceable regions, compiled into token automata.

A template is words with two kinds of markup: `[[ ... ]]` may be left out, `{{a..b}}` stands for a
to b words of any kind. Everything else is mandatory wording, and a text is accepted where it holds
all of it, word by word. Each template becomes a small automaton over words, run only from places
whose word can start it, and only in texts that hold its key words. Templates are whole licenses and
notices (license_templates), and short notices.

Templates and phrases are parameters of bounded size; the work is one Arrow pass over whole texts,
with no shuffle. Words are runs of letters and digits (after A-Z is lower-cased) and of everything
beyond ASCII, so bytes of UTF-8 can be split as they are.

Defined cases: null or empty text has no words, no places (null first and last) and score 0.
Overlapping places all count. Repeated rows are judged alike; an empty table gives an empty result.
Score: 1 where a template is accepted, 0.5 where only phrases are found, else 0.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from monthlake.llm import text as tx
from monthlake.llm.license_templates import TEXTS

KEYS = 4  # longest words of a template, all of which a text must hold before places are tried
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

PHRASES = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}

TEMPLATES = {
    "mit": ["[[released|distributed]] under the [[terms of the]] mit license",
            "permission is hereby granted free of charge to any person obtaining a copy of this {{1..6}}"],
    "apache-2.0": ["licensed under the apache license [[version]] 2 0"],
    "gpl-notice": ["licensed under the gnu general public license [[version {{1..1}}]]"],
    "gpl-later": ["under the terms of the gnu general public license as published by the free software foundation"],
    "cc-by-nc": ["licensed under [[a|the]] cc by nc [[{{1..1}} 0]]"],
    "bsd": ["redistribution and use in source and binary forms with or without modification are permitted"],
    "copyright": ["copyright [[c]] {{1..8}} all rights reserved"],
} | TEXTS

_TOKEN = re.compile(r"\[\[|\]\]|\{\{\d+\.\.\d+\}\}|\||[^\s\[\]{}|]+")


@dataclass(frozen=True)
class Automaton:
    """step[s] maps a word to next states; any_word[s] are states after a replaceable word."""

    step: tuple[dict[bytes, tuple[int, ...]], ...]
    any_word: tuple[tuple[int, ...], ...]
    skip: tuple[tuple[int, ...], ...]
    end: int
    keys: tuple[bytes, ...]

    def closed(self, states) -> frozenset[int]:
        found, todo = set(), list(states)
        while todo:
            s = todo.pop()
            if s not in found:
                found.add(s)
                todo.extend(self.skip[s])
        return frozenset(found)

    def starts(self) -> frozenset[bytes]:
        return frozenset(w for s in self.closed([0]) for w in self.step[s])

    def match(self, words: list[bytes], at: int) -> int:
        """The end of the longest accepted run of words that starts at `at`; -1 without one."""
        states, best = self.closed([0]), -1
        for i in range(at, len(words) + 1):
            if self.end in states:
                best = i
            if i == len(words) or not states:
                break
            nxt = [t for s in states for t in (*self.step[s].get(words[i], ()), *self.any_word[s])]
            states = self.closed(nxt)
        return best


def compile_template(template: str) -> Automaton:
    """States are made left to right; an optional region adds a way around itself."""
    step, any_word, skip, mandatory = [{}], [()], [()], []

    def state() -> int:
        step.append({}), any_word.append(()), skip.append(())
        return len(step) - 1

    here, opened, branches = 0, None, []
    for token in _TOKEN.findall(template):
        if token == "[[":
            opened, branches = here, []
        elif token == "|":
            branches.append(here)
            here = state()
            skip[opened] += (here,)
        elif token == "]]":
            close = state()
            for s in (*branches, here, opened):
                skip[s] += (close,)
            here, opened = close, None
        elif token.startswith("{{"):
            low, high = map(int, token[2:-2].split(".."))
            stops = []
            for k in range(high):
                if k >= low:
                    stops.append(here)
                nxt = state()
                any_word[here] += (nxt,)
                here = nxt
            for s in stops:
                skip[s] += (here,)
        else:
            nxt, word = state(), token.lower().encode()
            step[here][word] = (*step[here].get(word, ()), nxt)
            if opened is None:
                mandatory.append(word)
            here = nxt
    return Automaton(tuple(step), tuple(any_word), tuple(skip), here, tuple(sorted(set(mandatory), key=len)[-KEYS:]))


@lru_cache(maxsize=8)
def _compiled(templates: tuple, phrases: tuple):
    machines = [(label, m, m.starts()) for label, ts in templates for m in map(compile_template, ts)]
    return machines, [(label, [w.encode() for w in p.split()]) for label, p in phrases]


def _frozen(labelled: dict) -> tuple:
    return tuple((k, tuple(v) if isinstance(v, list) else v) for k, v in sorted(labelled.items()))


def scan_text(text: str | None, machines, phrases):
    """n_words, starts of phrase places, base labels, template labels."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower()
    words = WORD.findall(raw)
    places, base, found = [], set(), set()
    for label, phrase in phrases:
        if all(w in raw for w in phrase):
            n = len(phrase)
            at = [i for i, w in enumerate(words) if w == phrase[0] and words[i : i + n] == phrase]
            if at:
                base.add(label)
                places += at
    for label, machine, starts in machines:
        if label not in found and all(k in raw for k in machine.keys):
            if any(w in starts and machine.match(words, i) >= 0 for i, w in enumerate(words)):
                found.add(label)
    return len(words), places, base, found


RESULT = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
)


def scan(text: Column, templates: dict = TEMPLATES, phrases: dict = PHRASES) -> Column:
    """A struct of RESULT for each text."""
    tables = (_frozen(templates), _frozen(phrases))

    @F.pandas_udf(RESULT)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        machines, base_phrases = _compiled(*tables)
        for texts in batches:
            rows = []
            for text in texts:
                n, places, base, own = scan_text(text, machines, base_phrases)
                score = 1.0 if own else 0.5 if base else 0.0
                first, last = (min(places), max(places)) if places else (None, None)
                rows.append((n, len(places), first, last, ",".join(sorted(base)), ",".join(sorted(base | own)), score))
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in RESULT.split(", ")])
            yield out.astype({"n_words": "int64", "n_base": "int64", "first_word": "Int64", "last_word": "Int64"})

    return found(text)


def op9_license_scan(spark, sf_dir: str):
    docs = tx.documents(spark, sf_dir)
    return docs.select("doc_id", scan(F.col("text")).alias("_s")).select("doc_id", "_s.*")


def template_regex(template: str) -> str:
    """The same template as a regular expression over words that are each followed by a blank."""
    out = []
    for token in _TOKEN.findall(template):
        if token.startswith("{{"):
            low, high = token[2:-2].split("..")
            out.append(f"(?:[^ ]+ ){{{low},{high}}}")
        else:
            out.append({"[[": "(?:", "|": "|", "]]": ")?"}.get(token, f"{token.lower()} "))
    return " " + "".join(out)


def _own_sql(templates: dict) -> str:
    cases = []
    for label, own in templates.items():
        test = " or ".join(f"regexp_matches(t, '{template_regex(t)}')" for t in own)
        cases.append(f"case when {test} then '{label}' end")
    return ",\n      ".join(cases)


OP9_SQL = r"""
with d as (
  select doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
p as (
  select doc_id, w, ' ' || array_to_string(w, ' ') || ' ' as t,
         list_filter(range(1, len(w)), lambda i: w[i] = 'cc' and w[i + 1] = 'by') as cc,
         list_filter(range(1, len(w) - 1),
                     lambda i: w[i] = 'general' and w[i + 1] = 'public' and w[i + 2] = 'license') as gpl,
         list_filter(range(1, len(w) - 1),
                     lambda i: w[i] = 'all' and w[i + 1] = 'rights' and w[i + 2] = 'reserved') as arr
  from d),
b as (
  select *, list_concat(list_concat(cc, gpl), arr) as places,
    list_filter([case when len(cc) > 0 then 'cc-by' end, case when len(gpl) > 0 then 'gpl' end,
                 case when len(arr) > 0 then 'reserved' end], lambda x: x is not null) as base,
    list_filter([
      OWN],
      lambda x: x is not null) as own
  from p)
select doc_id, cast(len(w) as bigint) as n_words, cast(len(places) as bigint) as n_base,
       cast(list_min(places) - 1 as bigint) as first_word, cast(list_max(places) - 1 as bigint) as last_word,
       coalesce(array_to_string(list_sort(base), ','), '') as base_labels,
       coalesce(array_to_string(list_sort(list_concat(base, own)), ','), '') as labels,
       case when len(own) > 0 then 1.0::double when len(base) > 0 then 0.5::double else 0.0::double end as score
from b
""".replace("OWN", _own_sql(TEMPLATES))
