"""Vector code compression: product codes whose nearest entries are found by Orchard's search.

Components become integers, vectors are cut into equal parts, and each part position has a codebook
refined by a few rounds of assignment and means. All of it is integer arithmetic, so results do not
depend on the order of rows or on the number of tasks.

A search keeps one current entry. Every entry has a list of all entries, nearest first. The list of
the current entry is walked; an entry that is nearer to the query becomes the current one and its
list is taken up from the start; entries seen before are skipped by their mark. The walk stops at a
list distance beyond twice the current distance: by the triangle inequality nothing behind that can
be as near. "Beyond" is strict, and of equal distances the lower index is taken, so the result is
the nearest entry with the lowest index. The searches of a batch go side by side, a step each.

Rows go through one Arrow pass a round. A task returns sums and counts of its rows for each entry,
which Spark adds up, so the driver sees one row for each entry and part, whatever the number of rows.

Defined cases: rows whose vector is null, empty, or holds null or non-finite components are dropped,
and so are those with a component of `LIMIT` or more, whose squares would not fit a long. Vectors
are filled up with zeros to the next multiple of `parts`; vectors of different length have
codebooks of their own. Fewer rows than entries give as many entries as rows. First entries are taken
by vec_id, null last, then by the vector, so repeated ids are in a fixed order; every row counts. Equal
labels share label_error, null labels among them; a sum beyond a long is null. Extra columns are
dropped; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthlake.plans.joins import dimension
from monthlake.session import shared_folder

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
LIMIT = 1 << 18  # of a component as given
SEARCHES = 1 << 14  # searches that go side by side


def _saved(df: DataFrame, what: str) -> DataFrame:
    path = shared_folder(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def usable(vector: str = "embedding", limit: float = LIMIT) -> F.Column:
    """Not null, not empty, and every component a finite number below the limit."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= limit))
    return F.coalesce((F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True)), F.lit(False))


def neighbour_lists(book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry, all entries nearest first (of equal distances the lower index), and their squared distances."""
    gap = book[:, None, :] - book[None, :, :]
    squares = (gap * gap).sum(axis=2)
    order = np.argsort(squares, axis=1, kind="stable")
    return order, np.take_along_axis(squares, order, axis=1)


def orchard(queries: np.ndarray, book: np.ndarray, lists: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Index of each query's nearest entry (lowest index among equals) and its squared distance."""
    near, far = lists
    n, size = len(queries), len(book)
    current = np.zeros(n, np.int64)
    best = ((queries - book[0]) ** 2).sum(axis=1)
    seen = np.zeros((n, size), bool)
    seen[:, 0] = True
    place = np.zeros(n, np.int64)
    live = np.arange(n)
    while len(live):
        at, c = place[live], current[live]
        # A list distance beyond twice the current distance, as squares.
        go = (at < size) & (far[c, np.minimum(at, size - 1)] <= 4 * best[live])
        live, at, c = live[go], at[go], c[go]
        if not len(live):
            break
        entry = near[c, at]
        place[live] += 1
        new = ~seen[live, entry]
        who, entry = live[new], entry[new]
        seen[who, entry] = True
        distance = ((queries[who] - book[entry]) ** 2).sum(axis=1)
        better = (distance < best[who]) | ((distance == best[who]) & (entry < current[who]))
        who = who[better]
        current[who], best[who], place[who] = entry[better], distance[better], 0
    return current, best


def assign(x: np.ndarray, books: np.ndarray, lists: list) -> tuple[np.ndarray, np.ndarray]:
    """Codes and squared distances (rows x parts) of integer vectors."""
    parts, _, width = books.shape
    codes = np.empty((len(x), parts), np.int64)
    errors = np.empty((len(x), parts), np.int64)
    for at in range(0, len(x), SEARCHES):
        rows = slice(at, at + SEARCHES)
        for p in range(parts):
            codes[rows, p], errors[rows, p] = orchard(x[rows, p * width : (p + 1) * width], books[p], lists[p])
    return codes, errors


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def integers(vectors: DataFrame, scale: int = SCALE, parts: int = PARTS) -> DataFrame:
    """vec_id, label, dim, x (integers, filled up to a multiple of `parts`) of the usable rows."""
    floors = F.transform("embedding", lambda c: F.floor(c.cast("double") * scale).cast("long"))
    fill = F.array_repeat(F.lit(0).cast("long"), F.pmod(-F.size("embedding"), F.lit(parts)))
    return vectors.filter(usable()).select(
        "vec_id", "label", F.size("embedding").alias("dim"), F.concat(floors, fill).alias("x")
    )


def first_books(rows: DataFrame, parts: int, entries: int) -> np.ndarray:
    """parts x entries x width: the parts of the first rows by vec_id."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).select("x").collect()
    x = np.array([r.x for r in first], np.int64)
    return np.ascontiguousarray(x.reshape(len(x), parts, -1).transpose(1, 0, 2))


def refine(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks after one round: entries become the floored means of their parts."""
    parts, size, width = books.shape
    lists = [neighbour_lists(b) for b in books]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, size, width), np.int64)
        counts = np.zeros((parts, size), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch["x"])
            codes, _ = assign(x, books, lists)
            for p in range(parts):
                np.add.at(sums[p], codes[:, p], x[:, p * width : (p + 1) * width])
                counts[p] += np.bincount(codes[:, p], minlength=size)
        part, entry = np.nonzero(counts)
        arrays = [pa.array(part), pa.array(entry), pa.array(counts[part, entry])]
        arrays += [pa.array(sums[part, entry, w]) for w in range(width)]
        yield pa.RecordBatch.from_arrays(arrays, names=names)

    names = ["part", "entry", "n", *[f"s{w}" for w in range(width)]]
    told = rows.select("x").mapInArrow(add, ", ".join(f"{n} long" for n in names))
    summed = told.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(n).alias(n) for n in names[3:]])
    out = books.copy()
    for r in summed.collect():  # at most parts x entries rows
        out[r.part, r.entry] = [r[n] // r.n for n in names[3:]]
    return out


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code, error."""
    lists = [neighbour_lists(b) for b in books]
    schema = T.StructType([rows.schema["vec_id"], rows.schema["label"], T.StructField("code", T.StringType()),
                           T.StructField("error", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codes, errors = assign(_matrix(batch["x"]), books, lists)
                code = pa.array([c.tobytes().hex() for c in codes.astype(np.uint8)])
                yield pa.RecordBatch.from_arrays(
                    [batch["vec_id"], batch["label"], code, pa.array(errors.sum(axis=1))], names=schema.names
                )

    return rows.select("vec_id", "label", "x").mapInArrow(run, schema)


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> tuple[DataFrame, dict[int, np.ndarray]]:
    """Rows vec_id, label, dim, code, error, and the final codebooks of each vector length.

    `entries` is at most 256, so that an index is two hex digits.
    """
    if not 0 < entries <= 256:
        raise ValueError("entries must be 1 to 256")
    rows = _saved(integers(vectors, scale, parts), "integers")
    books, coded = {}, []
    for r in rows.select("dim").distinct().orderBy("dim").collect():
        own = rows.filter(F.col("dim") == r.dim)
        book = first_books(own, parts, entries)
        for _ in range(rounds):
            book = refine(own, book)
        books[r.dim] = book
        coded.append(encode(own, book).withColumn("dim", F.lit(r.dim)))
    if not coded:
        none = rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), "dim")
        return none.limit(0), books
    return reduce(DataFrame.unionByName, coded), books


def op13_vector_codes(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    coded, books = compress(vectors)
    coded = _saved(coded, "codes")
    # A saved total, so that the join with a hot label can be split.
    total = F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long")
    totals = _saved(coded.groupBy("label").agg(total.alias("label_error")), "label-errors").withColumnRenamed("label", "_label")
    digest = F.lit(None).cast("string")
    for dim, book in books.items():
        digest = F.when(F.col("dim") == dim, books_digest(book)).otherwise(digest)
    joined = coded.join(dimension(totals), F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256"))


_SQUARES = "cast(list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as bigint)"


def _best_sql(n: int) -> str:
    """Nearest entry of each part in the codebook of round n, by an exhaustive search."""
    return f"""
best{n} as (
  select r, p, min(struct_pack(d := d, e := e)) as m
  from (select a.r, a.p, b.e, {_SQUARES} as d from parts a join book{n} b on a.p = b.p)
  group by r, p)"""


def _book_sql(n: int) -> str:
    """The codebook that follows round n."""
    return f"""
sums{n} as (
  select p, e, i, cast(sum(c) as bigint) as s, count(*) as k
  from (select a.p, m.e as e, unnest(a.v) as c, generate_subscripts(a.v, 1) as i
    from best{n} join parts a using (r, p))
  group by p, e, i),
book{n + 1} as (
  select b.p, b.e, coalesce(s.v, b.v) as v
  from book{n} b left join (
    select p, e, list((s - ((s % k) + k) % k) // k order by i) as v from sums{n} group by p, e) s
  on b.p = s.p and b.e = s.e)"""


OP13_SQL = f"""
with kept as (
  select row_number() over (order by vec_id nulls last, embedding) as r, vec_id, label,
    list_transform(embedding, lambda c: cast(floor(256 * cast(c as double)) as bigint)) as x
  from embeddings
  where len(embedding) > 0 and len(list_filter(embedding, lambda c: c is null or not isfinite(c) or abs(c) >= {LIMIT})) = 0),
parts as (
  select r, p, list_slice(x, p * len(x) // 16 + 1, (p + 1) * len(x) // 16) as v
  from kept, (select unnest(range(16)) as p)),
book0 as (select p, r - 1 as e, v from parts where r <= 64),
{_best_sql(0)},
{_book_sql(0)},
{_best_sql(1)},
{_book_sql(1)},
{_best_sql(2)},
told as (
  select r, string_agg(printf('%02x', m.e), '' order by p) as code, cast(sum(m.d) as bigint) as error
  from best2 group by r),
digest as (select sha256(string_agg(array_to_string(v, ','), ',' order by p, e)) as h from book2)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, h as codebooks_sha256
from told join kept using (r), digest"""
