"""Suffix-array dedup: remove every byte covered by a string of `length` bytes (400 unless told
otherwise) that starts twice or more.

All pairs of places cannot be compared, so strings are first routed by content. Each such
string has an anchor: the smallest hash among its 64-byte grams. Equal strings have equal anchors,
so strings are split by anchor, and no repeat is lost between shards. In a text, strings that share
an anchor start at neighbouring places and form a segment (some 570 bytes at a length of 400).

1. One Arrow pass lists the segments of each text as (anchor, content hash, length, place).
2. Segments are counted by content, combining on the map side. Content that occurs twice is removed
   whole, so groups of copies, however large, shrink to one row here.
3. Anchors that hold different contents are what copies with edits, and the edges of shared
   passages, leave. Each different content is fetched once and sent to the shard of its anchor. A
   shard passes over segments none of whose strings has a hash that comes twice there, builds the suffix
   array of the others by Larsson-Sadakane refinement, takes common prefixes by Kasai's method (all segments
   side by side), and marks starts with a prefix of `length` bytes in common.
4. An anchor too large for one shard is dealt to several, by content, and goes the same way in each.
   Such a shard also gives one entry for each of its different strings: sorted by 128-bit
   fingerprint, and cut at fixed fingerprints into as many slices as the anchor has shards. A slice of
   all these shards meets in one task, where the sorted lists are merged by binary search of one in the
   other; entries that two lists hold are repeats across shards. A string takes 32 bytes there once a
   shard, however often it occurs, and no task holds more than about a shard's number of strings.
5. Marks are joined back to segments and merged into spans of each text.

Texts themselves are read three times and are shuffled only where a text has something to fetch.
Contents are equal when 64-bit anchor, 64-bit content hash and length are.

Defined cases: null text counts as empty; texts under `length` bytes lose
nothing; `length` is at least 64 (a gram); a row with null doc_id is judged like any other; repeated rows are
repeats of each other; extra columns are dropped; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthlake.llm import text as tx
from monthlake.llm.packing import _chunks
from monthlake.plans.joins import dimension
from monthlake.session import shared_folder

LENGTH = 400
GRAM = 64
PART = 1 << 20  # starts handled at a time in a long text
SHARD_BYTES = 1 << 20
HOT_BYTES = 2 << 20
BROADCAST_KEYS = 200_000

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20240301).integers(0, 1 << 63, 256, dtype=np.uint64)
_LOW = np.uint64((1 << 24) - 1)


@lru_cache(maxsize=2)
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def _power(base: int, n: int) -> np.ndarray:
    return _powers(base, max(1 << 14, 1 << (n - 1).bit_length()))[:n]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _prefix(data: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power(_BASE, len(data)), out=out[1:])
    return out


def _range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return _mixed((prefix[end] - prefix[start]) * _power(_INVERSE, len(prefix))[start])


def _sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of `width` values, by prefix and suffix minima of blocks."""
    n = len(v) - width + 1
    pad = -len(v) % width
    blocks = np.concatenate([v, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def segments(data: np.ndarray, length: int = LENGTH):
    """(anchor, content hash, length, place) of the segments of a text, as four arrays."""
    found = []
    for at in range(0, max(0, len(data) - length + 1), PART):
        part = data[at : at + PART + length - 1]
        prefix = _prefix(part)
        place = np.arange(len(part) - GRAM + 1)
        gram = _range_hash(prefix, place, place + GRAM)
        low = _sliding_min((gram & ~_LOW) | place.astype(np.uint64), length - GRAM + 1) & _LOW
        start = np.concatenate([[0], np.flatnonzero(np.diff(low)) + 1])
        end = np.concatenate([start[1:], [len(low)]]) - 1 + length
        found.append((gram[low[start].astype(np.int64)], _range_hash(prefix, start, end), end - start, start + at))
    if not found:
        return tuple(np.empty(0, np.uint64 if i < 2 else np.int64) for i in range(4))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans (start, end) without overlap or touch."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            if e > out[-1][1]:
                out[-1] = (out[-1][0], e)
        else:
            out.append((s, e))
    return out


SEGMENT = "array<struct<anchor:long,content:long,len:int,place:int,times:int>>"
SPAN = "array<struct<s:int,e:int>>"


def _listed(rows: list[list[tuple]], names: tuple[str, ...], kinds: tuple) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    flat = [x for r in rows for x in r]
    arrays = [pa.array([x[i] for x in flat], kind) for i, kind in enumerate(kinds)]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(arrays, list(names)))


def survey(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """row_id, key (md5), segs (different segments of the text), own (spans whose segment occurs twice
    within the text)."""
    body = F.coalesce("text", F.lit(""))
    keyed = docs.select(
        F.monotonically_increasing_id().alias("row_id"), F.unhex(F.md5(body)).alias("key"), body.alias("text")
    )
    plain = ("row_id", "key")
    split = segments if length == LENGTH else partial(segments, length=length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (c for b in batches for c in _chunks(b)):
            segs, own = [], []
            for text in batch["text"]:
                raw = text.as_buffer()
                seen: dict[tuple, list] = {}
                if raw is not None and raw.size >= length:
                    columns = split(np.frombuffer(raw, np.uint8))
                    anchor, content = (c.view(np.int64).tolist() for c in columns[:2])
                    for a, c, n, p in zip(anchor, content, columns[2].tolist(), columns[3].tolist(), strict=True):
                        seen.setdefault((a, c, n), []).append(p)
                segs.append([(*k, p[0], min(2, len(p))) for k, p in seen.items()])
                own.append(merged([(s, s + k[2]) for k, p in seen.items() if len(p) > 1 for s in p]))
            names = ("anchor", "content", "len", "place", "times")
            yield pa.RecordBatch.from_arrays(
                [batch[c] for c in plain]
                + [
                    _listed(segs, names, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())),
                    _listed(own, ("s", "e"), (pa.int32(), pa.int32())),
                ],
                names=[*plain, "segs", "own"],
            )

    schema = T.StructType(
        [keyed.schema[c] for c in plain]
        + [T.StructField("segs", T._parse_datatype_string(SEGMENT)), T.StructField("own", T._parse_datatype_string(SPAN))]
    )
    return keyed.mapInArrow(run, schema)


def suffix_array(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Order of all suffixes of segments; ends[p] is where p's segment ends. A segment ends in a
    sign of its own, smaller than any byte and in segment order. Groups of equal first h bytes are
    refined by the rank h bytes on, h doubling; only groups of two or more are sorted again."""
    n = len(data)
    place = np.arange(n, dtype=np.int32)
    rest = ends.astype(np.int32) - place
    key = np.zeros(n, np.uint64)
    for i in range(8):
        ahead = np.zeros(n, np.uint64)
        ahead[: n - i] = data[i:]
        ahead[rest <= i] = 0
        key |= ahead << np.uint64(56 - 8 * i)
    order = np.lexsort((np.minimum(rest, 8).astype(np.int8), key)).astype(np.int32)
    short, key = rest[order] < 8, key[order]
    new = np.ones(n, bool)
    new[1:] = (key[1:] != key[:-1]) | short[1:] | short[:-1]
    del key, short, rest, ahead
    first = np.maximum.accumulate(np.where(new, place, 0))
    rank = np.empty(n, np.int32)
    rank[order] = first
    h = 8
    while True:
        # Places in the order that are not settled: their group goes on before or behind.
        tied = np.zeros(n, bool)
        tied[1:] = first[1:] == first[:-1]
        tied[:-1] |= tied[1:]
        at = np.flatnonzero(tied).astype(np.int32)
        if not len(at):
            return order
        p = order[at]
        ahead = np.minimum(p + h, n - 1)
        key = np.where(p + h < ends[p], rank[ahead].astype(np.int64) + n, p)
        key |= first[at].astype(np.int64) << 32
        by = np.argsort(key, kind="stable")
        key = key[by]
        order[at] = p[by]
        fresh = np.ones(len(at), bool)
        fresh[1:] = key[1:] != key[:-1]
        del key, by, ahead
        first[at] = np.maximum.accumulate(np.where(fresh, at, 0))
        rank[order[at]] = first[at]
        h *= 2


def common_prefixes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, order: np.ndarray, length: int = LENGTH
) -> np.ndarray:
    """Common prefix of each suffix with the one before it in the order, at most `length`, by text place.

    Kasai: a text place keeps all but one of the common bytes of the place before it. Segments do
    not depend on each other, so place t of every segment is handled at once.
    """
    n = len(data)
    before = np.full(n, -1, np.int32)
    before[order[1:]] = order[:-1]
    out = np.zeros(n, np.int16 if length < 1 << 15 else np.int32)
    seg_end = ends[starts]
    h = np.zeros(len(starts), np.int64)
    for t in range(int((seg_end - starts).max())):
        live = np.flatnonzero(starts + t < seg_end)
        p = starts[live] + t
        q = before[p]
        have = np.where(q >= 0, np.maximum(h[live] - 1, 0), 0)
        most = np.where(q >= 0, np.minimum(np.minimum(seg_end[live] - p, ends[q] - q), length), 0)
        grow = np.flatnonzero(have < most)
        while len(grow):
            same = data[p[grow] + have[grow]] == data[q[grow] + have[grow]]
            grow = grow[same]
            have[grow] += 1
            grow = grow[have[grow] < most[grow]]
        h[live] = have
        out[p] = have
    return out


def with_repeats(parts: list[bytes], length: int = LENGTH) -> np.ndarray:
    """Which segments hold a string of `length` bytes whose hash comes twice among all of them.

    Equal strings have equal hashes, so a segment passed over has no repeat: it need not be sorted.
    """
    sizes = np.array([len(x) for x in parts])
    starts = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(parts), np.uint8)
    n = np.maximum(sizes - length + 1, 0)
    owner = np.repeat(np.arange(len(parts)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + starts[owner]
    hashes = _range_hash(_prefix(data), at, at + length)
    order = np.argsort(hashes)
    same = hashes[order[1:]] == hashes[order[:-1]]
    found = np.zeros(len(parts), bool)
    found[owner[order[1:][same]]] = True
    found[owner[order[:-1][same]]] = True
    return found


def repeated_starts(parts: list[bytes], length: int = LENGTH) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each segment, which of its starts (with `length` bytes ahead) have their string elsewhere,
    and which have it before them in the suffix array (all but one of equal strings)."""
    out = [np.zeros(max(0, len(x) - length + 1), bool) for x in parts]
    later = list(out)
    chosen = np.flatnonzero(with_repeats(parts, length))
    if not len(chosen):
        return out, later
    parts = [parts[i] for i in chosen]
    sizes = np.array([len(x) for x in parts])
    ends_of = np.cumsum(sizes)
    starts = ends_of - sizes
    data = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.repeat(ends_of.astype(np.int32), sizes)
    order = suffix_array(data, ends)
    shared = common_prefixes(data, starts, ends, order, length)[order] >= length
    again = shared.copy()
    again[:-1] |= shared[1:]
    marked, behind = np.zeros(len(data), bool), np.zeros(len(data), bool)
    marked[order], behind[order] = again, shared
    for i, s in zip(chosen, starts, strict=True):
        out[i], later[i] = marked[s : s + len(out[i])], behind[s : s + len(out[i])]
    return out, later


def _runs(marks: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Spans of bytes, relative to the segment, that marked starts cover."""
    edge = np.diff(np.concatenate([[0], marks.astype(np.int8), [0]]))
    return merged([(int(s), int(e) - 1 + length) for s, e in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)])


#: A string of a segment: 128-bit fingerprint, most significant byte first, and where it starts.
ENTRY = np.dtype([("mark", "S16"), ("content", "<i8"), ("len", "<i4"), ("start", "<i4")])


def entries(content: int, part: bytes, later: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """The strings of a segment that are not `later` ones of their shard."""
    prefix = _prefix(np.frombuffer(part, np.uint8))
    at = np.flatnonzero(~later)
    half = length // 2
    left, right = _range_hash(prefix, at, at + half), _range_hash(prefix, at + half, at + length)
    # Strings often share their first half, so the hash of the whole comes first and cuts the slices.
    whole = _mixed(left + np.uint64(0x632BE59BD9B4E019) * right)
    out = np.empty(len(at), ENTRY)
    out["mark"] = np.stack([whole, left], axis=1).astype(">u8").view("S16").ravel()
    out["content"], out["len"], out["start"] = content, len(part), at
    return out


def slices(listed: np.ndarray, pieces: int) -> list[tuple[int, np.ndarray]]:
    """Entries sorted by fingerprint and cut at `pieces` - 1 fixed fingerprints; those that hold any."""
    listed = listed[np.argsort(listed["mark"], kind="stable")]
    bounds = np.zeros((pieces + 1, 2), ">u8")
    bounds[:, 0] = [min(i * (1 << 64) // pieces, (1 << 64) - 1) for i in range(pieces + 1)]
    cuts = np.searchsorted(listed["mark"], bounds[:-1].view("S16").ravel()).tolist() + [len(listed)]
    return [(i, listed[a:b]) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a]


def merged_marks(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two sorted lists of different fingerprints, each with a flag (in two lists or more), as one."""
    (x, twice), (y, other) = a, b
    at = np.searchsorted(x, y)
    same = np.zeros(len(y), bool)
    inside = at < len(x)
    same[inside] = x[at[inside]] == y[inside]
    twice = twice.copy()
    twice[at[same]] = True
    return np.insert(x, at[~same], y[~same]), np.insert(twice, at[~same], other[~same])


def in_several(lists: list[np.ndarray]) -> list[np.ndarray]:
    """For each sorted list of different fingerprints, which of its entries another list holds too."""
    level = [(x, np.zeros(len(x), bool)) for x in lists]
    while len(level) > 1:
        pairs = [merged_marks(a, b) for a, b in zip(level[::2], level[1::2], strict=False)]
        level = pairs + level[len(pairs) * 2 :]
    marks, twice = level[0]
    return [twice[np.searchsorted(marks, x)] for x in lists]


def _saved(df: DataFrame, what: str) -> DataFrame:
    path = shared_folder(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _texts(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """key and text of the documents whose key is wanted, one row for each key and document."""
    body = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    return body.withColumn("key", F.unhex(F.md5("text"))).join(dimension(keys, BROADCAST_KEYS), "key", "left_semi")


def _contents(docs: DataFrame, told: DataFrame, wanted: DataFrame) -> DataFrame:
    """`wanted` (anchor, content, len, row_id of one text that holds it, ...) with its bytes."""
    lists = wanted.groupBy("row_id").agg(F.collect_list(F.struct("anchor", "content", "len", "shard", "pieces")).alias("want"))
    needed = _saved(told.select("row_id", "key", "segs").join(lists, "row_id").select("key", "segs", "want"), "wanted")
    texts = _texts(docs, needed.select("key").distinct()).dropDuplicates(["key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, segs, want in zip(batch["text"], batch["segs"].to_pylist(), batch["want"].to_pylist(), strict=True):
                raw = text.as_buffer()
                place = {(s["anchor"], s["content"], s["len"]): s["place"] for s in segs}
                for w in want:
                    at = place[w["anchor"], w["content"], w["len"]]
                    part = raw[at : at + w["len"]].to_pybytes()
                    rows.append((w["anchor"], w["content"], w["len"], w["shard"], w["pieces"], part))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary())
            names = ("anchor", "content", "len", "shard", "pieces", "part")
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    return (
        texts.join(needed, "key")
        .select("text", "segs", "want")
        .mapInArrow(run, "anchor long, content long, len int, shard long, pieces int, part binary")
    )


ARRAYS = f"anchor long, content long, len int, spans {SPAN}, slice int, strings binary"


def _suffix_arrays(parts: DataFrame, length: int) -> DataFrame:
    """Spans that repeat within a shard (slice is null) and, of anchors of several shards, the slices
    of their strings (spans is null)."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["anchor", "content", "len"], kind="stable")
        marks, later = repeated_starts(frame["part"].tolist(), length)
        split: dict[tuple[int, int], list] = {}
        rows = []
        for x, mark, behind in zip(frame.itertuples(index=False), marks, later, strict=True):
            if mark.any():
                rows.append((x.anchor, x.content, x.len, [{"s": s, "e": e} for s, e in _runs(mark, length)], None, None))
            if x.pieces > 1:
                split.setdefault((x.anchor, x.pieces), []).append(entries(x.content, x.part, behind, length))
        for (anchor, pieces), listed in split.items():
            for i, piece in slices(np.concatenate(listed), pieces):
                rows.append((anchor, None, None, None, i, piece.tobytes()))
        # Typed column by column: a 64-bit hash beside None would become a double.
        kinds = dict(anchor="int64", content="Int64", len="Int32", spans=object, slice="Int32", strings=object)
        columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
        return pd.DataFrame({c: pd.Series(list(v), dtype=k) for (c, k), v in zip(kinds.items(), columns, strict=True)})

    return parts.groupBy("shard").applyInPandas(run, ARRAYS)


def _across_shards(arrays: DataFrame, length: int) -> DataFrame:
    """Spans of the strings that several shards of an anchor hold."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        lists = [np.frombuffer(b, ENTRY) for b in frame["strings"]]
        found = in_several([np.ascontiguousarray(x["mark"]) for x in lists])
        again = np.concatenate([x[f] for x, f in zip(lists, found, strict=True)])
        at = {"anchor": frame["anchor"].iloc[0], "content": again["content"], "len": again["len"], "start": again["start"]}
        return pd.DataFrame(at)

    met = arrays.filter("strings is not null").select("anchor", "slice", "strings").groupBy("anchor", "slice")
    covered = F.struct(F.col("start").alias("s"), (F.col("start") + length).alias("e"))
    starts = met.applyInPandas(run, "anchor long, content long, len int, start int")
    return starts.groupBy("anchor", "content", "len").agg(F.collect_list(covered).alias("spans"))  # of one segment


def removed_spans(docs: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """The survey of `docs` (saved), and row_id with the spans (may overlap) found across texts."""
    told = _saved(survey(docs, length), "survey")
    listed = told.select("row_id", F.explode("segs").alias("s")).select("row_id", "s.*")
    contents = _saved(
        listed.groupBy("anchor", "content", "len").agg(F.sum("times").alias("times"), F.min("row_id").alias("row_id")),
        "contents",
    )
    # Written before it is joined, so that adaptive execution can split an anchor of many contents.
    anchors = _saved(
        contents.groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("n"), F.min("times").alias("fewest"), F.sum("len").alias("bytes"))
        .filter((F.col("n") > 1) & (F.col("fewest") == 1)),
        "anchors",
    )
    mixed = _saved(contents.join(anchors.select("anchor", "bytes"), "anchor"), "mixed")
    total = mixed.filter(F.col("bytes") <= HOT_BYTES).agg(F.sum("len")).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    hot = F.col("bytes") > HOT_BYTES
    pieces = F.when(hot, 2 + F.floor(F.col("bytes") / SHARD_BYTES)).otherwise(1).cast("int")
    piece = F.pmod(F.xxhash64("content", "len"), F.col("pieces"))
    own = F.lit(shards) + F.shiftrightunsigned(F.xxhash64("anchor", piece), 2)
    # A large anchor does not share its shards, so none holds more than HOT_BYTES or about SHARD_BYTES.
    shard = F.when(F.col("bytes") > SHARD_BYTES // 2, own).otherwise(F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    placed = mixed.withColumn("pieces", pieces).withColumn("shard", F.when(hot, own).otherwise(shard))
    parts = _saved(_contents(docs, told, placed), "parts")
    arrays = _saved(_suffix_arrays(parts, length), "arrays")
    inside = arrays.filter("spans is not null").select("anchor", "content", "len", "spans")
    marked = inside.unionAll(_across_shards(arrays, length))
    whole = contents.filter(F.col("times") > 1).select(
        "anchor", "content", "len", F.array(F.struct(F.lit(0).alias("s"), F.col("len").alias("e"))).alias("spans")
    )
    partly = marked.join(whole.select("anchor", "content", "len"), ["anchor", "content", "len"], "left_anti")
    hits = _saved(whole.unionAll(partly), "hits")
    moved = F.transform(
        "spans", lambda x: F.struct((x["s"] + F.col("place")).alias("s"), (x["e"] + F.col("place")).alias("e"))
    )
    spans = (
        listed.join(hits, ["anchor", "content", "len"])
        .select("row_id", moved.alias("spans"))
        .groupBy("row_id")
        .agg(F.flatten(F.collect_list("spans")).alias("spans"))  # of one text
    )
    return told, spans


def _merged_spans():
    @F.pandas_udf(SPAN)
    def run(spans: pd.Series) -> pd.Series:
        return spans.map(lambda x: [{"s": s, "e": e} for s, e in merged([(y["s"], y["e"]) for y in x])])

    return run


def judged(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """row_id, key, cut (removed spans: sorted, apart from each other)."""
    told, spans = removed_spans(docs, length)
    all_spans = F.concat(F.col("own"), F.coalesce("spans", F.array().cast(SPAN)))
    joined = told.select("row_id", "key", "own").join(spans, "row_id", "left")
    return _saved(joined.select("row_id", "key", _merged_spans()(all_spans).alias("cut")), "cut")


def kept_bytes(raw: bytes, cut: list) -> bytes:
    at, out = 0, []
    for x in cut:
        out.append(raw[at : x["s"]])
        at = x["e"]
    return b"".join([*out, raw[at:]])


def _cut_texts(docs: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """`docs` without the rows that lose bytes, and the rows that do, with _cut (their removed spans).

    Equal texts lose the same bytes, so cuts are joined by the digest of the text.
    """
    found = judged(docs, length).filter(F.size("cut") > 0).select("key", "cut").dropDuplicates(["key"])
    cuts = _saved(found.toDF("_cut_key", "_cut"), "cuts")
    keyed = docs.withColumn("_text_key", F.unhex(F.md5("text")))
    keys = dimension(cuts.select("_cut_key"), BROADCAST_KEYS)
    same = F.col("_text_key") == F.col("_cut_key")
    return keyed.join(keys, same, "left_anti"), keyed.join(keys, same, "left_semi").join(cuts, same)


def digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, text (what is left) for each row.

    A character that loses some of its bytes is missing in `text`; kept_sha256 is of the bytes.
    """

    @F.pandas_udf("text string, sha string, n long")
    def left(texts: pd.Series, cut: pd.Series) -> pd.DataFrame:
        kept = [kept_bytes(t.encode(), c) for t, c in zip(texts, cut, strict=True)]
        return pd.DataFrame(
            {"text": [k.decode("utf-8", "ignore") for k in kept], "sha": [hashlib.sha256(k).hexdigest() for k in kept],
             "n": [len(k) for k in kept]}
        )

    untouched, touched = _cut_texts(docs.select("doc_id", "text"), length)
    body, none = F.coalesce("text", F.lit("")), F.lit(0).cast("long")
    n_bytes = F.octet_length(body).cast("long").alias("n_bytes")
    whole = untouched.select(
        "doc_id", n_bytes, none.alias("n_removed"), none.alias("n_spans"), F.sha2(body, 256).alias("kept_sha256"), "text"
    )
    cut = touched.select("doc_id", n_bytes, "_cut", left("text", "_cut").alias("_left")).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.col("_left.n")).alias("n_removed"),
        F.size("_cut").cast("long").alias("n_spans"),
        F.col("_left.sha").alias("kept_sha256"),
        F.col("_left.text").alias("text"),
    )
    return whole.unionAll(cut)


def remove(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """`docs` with repeated bytes cut out of its text; columns and rows stay.

    A character that loses some of its bytes is dropped whole.
    """

    @F.pandas_udf("string")
    def cut_text(texts: pd.Series, cut: pd.Series) -> pd.Series:
        left = [kept_bytes(t.encode(), c).decode("utf-8", "ignore") for t, c in zip(texts, cut, strict=True)]
        return pd.Series(left, dtype=object)

    untouched, touched = _cut_texts(docs, length)
    names = [cut_text("text", "_cut").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    return untouched.select(*docs.columns).unionAll(touched.select(*names))


def op6_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return digests(tx.documents(spark, sf_dir).select("doc_id", "text"))
