"""Best-fit packing of tokenised documents into sequences, by patterns.

1. One Arrow pass over whole texts gives a row for each piece (at most `capacity` tokens).
2. The histogram of piece lengths has at most `capacity` bins, whatever the corpus. On it, and not
   on documents, the packing is planned: patterns of two to four lengths that fill a sequence, their
   repeat counts by non-negative least squares, rounded down; what is left by best fit, longest
   first, in runs of equal sequences.
3. A plan is a table of rank ranges: pieces of length L with ranks a to b go to these sequences, at
   this offset. Its size depends on the capacity alone. Ranks within a length are counted in salted
   groups of some ten thousand pieces, so no length has to fit one task.

Defined cases: null or empty text is a document of one token (the end token); repeated rows are
packed one by one; an empty table gives an empty result; extra columns are dropped. `doc_id` is
carried as it is, null included. The patterns listed (`near`) and the sweeps of the fit (`SWEEPS`) bound the plan
only: what they leave is packed by best fit.
"""

from __future__ import annotations

import bisect
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthlake.llm import text as tx
from monthlake.session import shared_folder

CAPACITY = 4096
END_ID = 1
SALT_ROWS = 50_000
CHUNK_BYTES = 8 << 20
TOKEN_BYTES = 2 << 20  # of text whose ids are held at a time
SWEEPS = 60
WORDS = 500_000  # of a worker's table
CODED = 5_000  # words encoded at a time: an encoding takes about a kilobyte beside its ids
# A run of marks between a letter or digit and white space is a word of its own to the tokenizer;
# set apart here, so that fewer distinct words remain. Only behind letters that the tokenizer's
# normalising leaves letters: others, such as the capital dotted I or some letters of India, turn into a letter
# and a combining mark, which runs on into the marks behind it.
_PLAIN = r"a-zA-Z0-9\x{00C0}-\x{00D6}\x{00D8}-\x{00F6}\x{00F8}-\x{012F}\x{0131}-\x{0148}\x{014A}-\x{017E}\x{0410}-\x{044F}"
_TAIL = rf"([{_PLAIN}])([.,;:!?$%&*#]+)([ \t\n\r\f\v]|$)"


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=1)
def _table(path: str) -> WordTable:
    """One for each worker process; it outlives a task."""
    return WordTable(_tokenizer(path))


def _ids(tokenizer, texts: list[str]) -> list[list[int]]:
    return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class WordTable:
    """Ids of the words a worker has met, in one flat array; emptied when it holds `WORDS`, so that
    its memory is bounded. Only words that are not in it are encoded."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.starts, self.sizes = np.empty(0, np.int64), np.empty(0, np.int64)
        self.flat = np.empty(0, np.uint32)

    def places(self, words: list[str]) -> np.ndarray:
        """The number of each word (no word twice) in the table."""
        if len(self.place) + len(words) > WORDS:
            self.clear()
        new = [w for w in words if w not in self.place]
        if new:
            sizes, flat = [], []
            for at in range(0, len(new), CODED):
                ids = _ids(self.tokenizer, new[at : at + CODED])
                sizes.append(np.fromiter(map(len, ids), np.int64, len(ids)))
                flat.append(np.fromiter((i for w in ids for i in w), np.uint32, int(sizes[-1].sum())))
            each = np.concatenate(sizes)
            ends = np.cumsum(each) + len(self.flat)
            for w in new:
                self.place[w] = len(self.place)
            self.starts, self.sizes = np.append(self.starts, ends - each), np.append(self.sizes, each)
            self.flat = np.concatenate([self.flat, *flat])
        return np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))


def tokenise(texts: pa.Array, table: WordTable) -> list[np.ndarray]:
    """Ids of each text, as the tokenizer gives them for the whole text.

    White space always ends a word of this tokenizer, so each different word is encoded once.
    Lower-casing A-Z first changes nothing, but for texts with "<|", which might spell a
    special token; those are encoded whole.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    whole = pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)
    body = pc.if_else(pa.array(whole), pa.scalar("", pa.large_string()), texts)
    lists = pc.ascii_split_whitespace(pc.replace_substring_regex(pc.ascii_lower(body), _TAIL, r"\1 \2\3"))
    coded = lists.flatten().dictionary_encode()
    place = table.places(coded.dictionary.to_pylist())
    index = place[coded.indices.to_numpy(zero_copy_only=False)]
    n = table.sizes[index]
    ends = np.cumsum(n)
    ids = table.flat[np.repeat(table.starts[index] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]
    bounds = np.concatenate([[0], ends])[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
    out = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    for i in np.flatnonzero(whole):
        out[i] = np.array(_ids(table.tokenizer, [texts[int(i)].as_py()])[0], np.uint32)
    return out


def _chunks(batch: pa.RecordBatch, size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of some megabytes of text, so that long documents do not add up."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        done = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, done + size, "right")))
        yield batch.slice(at, to - at)
        at = to


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32; the end token belongs to the last piece."""
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType(
        [T.StructField("doc_id", kind)]
        + [T.StructField("piece", T.IntegerType())]
        + [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32")]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(tokenizer_path)
        for batch in (c for b in batches for c in _chunks(b, TOKEN_BYTES)):
            row, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(tokenise(batch["text"], table)):
                ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                for k, a in enumerate(range(0, len(ids), capacity)):
                    part = ids[a : a + capacity]
                    row.append(i), piece.append(k), start.append(a), length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(row, pa.int64())), pa.array(piece, pa.int32())]
                + [pa.array(x, pa.int64()) for x in (start, length, crc)],
                names=schema.names,
            )

    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def patterns(histogram: dict[int, int], capacity: int = CAPACITY, near: int = 6) -> list[tuple[int, ...]]:
    """Patterns of two to four lengths of the histogram that fill a sequence exactly.

    All pairs are listed. For more, the longest piece takes the largest fillers that occur, from
    `near` starting points.
    """
    have = sorted(histogram)
    present = set(have)
    found: set[tuple[int, ...]] = set()
    for a in have:
        rest = capacity - a
        if rest in present and rest <= a:
            found.add((a, rest))
        if rest < 2:
            continue
        top = bisect.bisect_right(have, min(rest - 1, a))
        for b in have[max(0, top - near) : top] + have[: top : max(1, top // near)]:
            left = rest - b
            if left in present and left <= b:
                found.add((a, b, left))
            at = bisect.bisect_right(have, min(left - 1, b)) - 1
            if at >= 0 and left - have[at] in present and left - have[at] <= have[at]:
                found.add((a, b, have[at], left - have[at]))
    return sorted(found)


def fit_counts(cols: list[tuple[int, ...]], histogram: dict[int, int], sweeps: int = SWEEPS) -> np.ndarray:
    """argmin |A x - h|^2 with x >= 0 by coordinate descent; column j of A counts pattern j's lengths."""
    left = {k: float(v) for k, v in histogram.items()}
    x = np.zeros(len(cols))
    counts = [[(v, p.count(v)) for v in set(p)] for p in cols]
    for _ in range(sweeps):
        moved = 0.0
        for j, parts in enumerate(counts):
            new = max(0.0, x[j] + sum(left[v] * n for v, n in parts) / sum(n * n for _, n in parts))
            step = new - x[j]
            if step:
                x[j] = new
                moved = max(moved, abs(step))
                for v, n in parts:
                    left[v] -= step * n
        if moved < 0.25:
            break
    return x


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first_rank, n_ranks, per_sequence, sequence, offset).

    Rank r of the row goes to sequence + k // per_sequence at offset + (k % per_sequence) * length,
    where k = r - first_rank.
    """
    left, used = dict(histogram), dict.fromkeys(histogram, 0)
    rows, sequences = [], 0

    def take(length: int, n: int) -> int:
        first = used[length]
        used[length] += n
        left[length] -= n
        return first

    cols = patterns(histogram, capacity)
    x = fit_counts(cols, histogram)
    for j in np.argsort(-x, kind="stable"):
        need = {v: cols[j].count(v) for v in set(cols[j])}
        n = min([int(x[j]), *(left[v] // k for v, k in need.items())])
        if n < 1:
            continue
        offset = 0
        for v in sorted(need, reverse=True):
            rows.append((v, take(v, n * need[v]), n * need[v], need[v], sequences, offset))
            offset += v * need[v]
        sequences += n
    # Open runs of equal sequences: room -> [(first sequence, how many)]; best fit takes the least room.
    rooms: list[int] = []
    runs: dict[int, list[tuple[int, int]]] = {}

    def keep(room: int, first: int, n: int) -> None:
        if n and room:
            if room not in runs:
                bisect.insort(rooms, room)
                runs[room] = []
            runs[room].append((first, n))

    for length in sorted(left, reverse=True):
        while left[length]:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = runs[room].pop()
                if not runs[room]:
                    del runs[room]
                    rooms.pop(at)
            else:
                room, first, n = capacity, sequences, -(-left[length] // (capacity // length))
                sequences += n
            each = room // length
            full = min(n, left[length] // each)
            if full:
                rows.append((length, take(length, full * each), full * each, each, first, capacity - room))
                keep(room - each * length, first, full)
            rest = left[length] if full < n else 0
            if rest:
                rows.append((length, take(length, rest), rest, rest, first + full, capacity - room))
                keep(room - rest * length, first + full, 1)
            keep(room, first + full + (1 if rest else 0), n - full - (1 if rest else 0))
    return rows


PLAN_SCHEMA = "_length long, _first long, _n long, _per long, _seq long, _off long"


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    path = shared_folder(spark, "pieces")
    pieces(docs, tokenizer_path, capacity).write.parquet(path)
    cut = spark.read.parquet(path)
    # At most `capacity` rows.
    histogram = {r.length: r["count"] for r in cut.groupBy("length").count().collect()}
    table = spark.createDataFrame(plan(histogram, capacity), PLAN_SCHEMA)
    salts = spark.createDataFrame(
        [(k, -(-n // SALT_ROWS)) for k, n in sorted(histogram.items())], "length long, _salts long"
    )
    salted = cut.join(F.broadcast(salts), "length").withColumn(
        "_salt", F.expr("pmod(xxhash64(doc_id, piece, ids_crc32), _salts)")
    )
    before = W.partitionBy("length").orderBy("_salt").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        salted.groupBy("length", "_salt")
        .count()
        .select("length", "_salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_base"))
    )
    inside = W.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        salted.withColumn("_rank", F.row_number().over(inside) - 1)
        .join(offsets, ["length", "_salt"])
        .withColumn("_rank", F.col("_rank") + F.col("_base"))
    )
    k = F.col("_rank") - F.col("_first")
    # The plan has some tens of thousands of rows at most, bounded by the capacity.
    return ranked.join(
        F.broadcast(table),
        (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_first")) & (k < F.col("_n")),
    ).select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("_seq") + F.floor(k / F.col("_per"))).cast("long").alias("sequence_id"),
        (F.col("_off") + (k % F.col("_per")) * F.col("length")).cast("long").alias("offset"),
    )


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op8_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack(tx.documents(spark, sf_dir).select("doc_id", "text"), default_tokenizer())
