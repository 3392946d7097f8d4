"""Sharding: a Feistel permutation of the global row numbers gives every row its shard and its slot there.

Rows are numbered from 0 in the order of their ids (then of a hash of the whole row). A number below ``total`` is taken as a cell of the smallest
near-square grid that has room for all, row and column are changed in turn by rounds that depend on the other one only, and a result that is no
row's number is permuted again (cycle walking). Each round can be undone, so this is a permutation. The row at place p lies in shard
p mod ``shards``, slot p div ``shards``: sizes differ by one row at most, and slots have no gap. ``place`` and ``row_at`` compute both directions for
a single number without reading anything.

The grid has less than one row of cells too many. How often a walk can pass such cells is found on those cells alone, before the table is permuted;
so every walk ends, and no row is left out. Only SQL functions run on the rows. One range shuffle numbers them; rows with one id are
spread by the hash of the row, and rows equal throughout, which are interchangeable, by their place in the input.

Cases: null ids come first; a null text is a row like any other; an empty or very long text changes nothing; rows with one id are ordered by the
hash of all columns (but maps and variants); repeated rows get a place each, so copies do not stay together; an empty table gives an empty result; a
column of the documents that is named like a result is replaced by it, as is one that differs from it by case only.
"""

from __future__ import annotations

import hashlib
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.scratch import materialize

#: Primes of the two linear steps of a round.
PRIMES = (2 ** 31 - 1, 2 ** 31 - 19)
ROUNDS = 8

Key = tuple[int, int, int, int]


def keys(seed: int, rounds: int = ROUNDS) -> list[Key]:
    """Factor and shift of both linear steps of each round, from the seed."""
    out = []
    for i in range(rounds):
        h = hashlib.sha256(f"{seed}:{i}".encode()).digest()
        a, b, c, d = (int.from_bytes(h[8 * j: 8 * j + 8], "big") for j in range(4))
        out.append((1 + a % (PRIMES[0] - 1), b % PRIMES[0], 1 + c % (PRIMES[1] - 1), d % PRIMES[1]))
    return out


def grid(total: int) -> tuple[int, int]:
    """Rows and columns of the smallest near-square grid of at least ``total`` cells; less than one row of them is too many."""
    high = isqrt(total - 1) + 1 if total > 0 else 1
    return high, max(1, -(-total // high))


def _mixed(x, key: Key):
    """For numbers and for columns alike; stays below 2 ** 63."""
    a, b, c, d = key
    return ((x * a + b) % PRIMES[0] * c + d) % PRIMES[1]


def permute(x: int, total: int, seed: int = 0) -> int:
    """Where row number ``x`` goes."""
    high, wide = grid(total)
    while True:
        left, right = divmod(x, wide)
        for i, key in enumerate(keys(seed)):
            if i % 2 == 0:
                left = (left + _mixed(right, key)) % high
            else:
                right = (right + _mixed(left, key)) % wide
        x = left * wide + right
        if x < total:
            return x


def restore(x: int, total: int, seed: int = 0) -> int:
    """Which row number went to ``x``."""
    high, wide = grid(total)
    while True:
        left, right = divmod(x, wide)
        for i, key in reversed(list(enumerate(keys(seed)))):
            if i % 2 == 0:
                left = (left - _mixed(right, key)) % high
            else:
                right = (right - _mixed(left, key)) % wide
        x = left * wide + right
        if x < total:
            return x


def place(row: int, total: int, shards: int, seed: int = 0) -> tuple[int, int]:
    """Shard and slot of a row number."""
    slot, shard = divmod(permute(row, total, seed), shards)
    return shard, slot


def row_at(shard: int, slot: int, total: int, shards: int, seed: int = 0) -> int:
    """The row number at a slot of a shard."""
    return restore(slot * shards + shard, total, seed)


def _once(df: DataFrame, x: str, total: int, seed: int, when: Column | None = None) -> DataFrame:
    """``x`` permuted in the grid; each round is a projection of its own, so that no expression is repeated."""
    high, wide = grid(total)
    df = df.withColumns({"left": F.call_function("div", F.col(x), F.lit(wide)), "right": F.col(x) % F.lit(wide)})
    for i, key in enumerate(keys(seed)):
        side, other, size = ("left", "right", high) if i % 2 == 0 else ("right", "left", wide)
        df = df.withColumn(side, (F.col(side) + _mixed(F.col(other), key)) % F.lit(size))
    moved = F.col("left") * F.lit(wide) + F.col("right")
    return df.withColumn(x, moved if when is None else F.when(when, moved).otherwise(F.col(x))).drop("left", "right")


def walks(df: DataFrame, total: int, seed: int = 0) -> int:
    """The most steps that a walk takes after the first: counted on the cells beyond ``total``, fewer than the root of it."""
    high, wide = grid(total)
    spare = df.sparkSession.range(total, high * wide).toDF("x")
    moved = _once(spare.withColumn("from", F.col("x")), "x", total, seed).where(F.col("x") >= total)
    # A cell that another spare cell leads to is met later on that one's walk; a cycle of spare cells is met by no row.
    met = materialize(spare.join(moved.select("x"), "x", "left_anti"), "spare")
    steps = 0
    while met.limit(1).count():
        steps += 1
        met = materialize(_once(met, "x", total, seed).where(F.col("x") >= total), "spare")
    return steps


def permuted(df: DataFrame, number: str, total: int, seed: int = 0) -> DataFrame:
    """``number`` replaced by its image; it must lie in 0 to ``total`` - 1. Columns named left and right must not occur."""
    if total <= 1:
        return df
    out = _once(df, number, total, seed)
    for _ in range(walks(df, total, seed)):
        out = _once(out, number, total, seed, F.col(number) >= F.lit(total))
    return out


def numbered(docs: DataFrame, id_column: str = "doc_id") -> tuple[DataFrame, int]:
    """(held: the row, number: from 0 in the order of the ids), written, and how many rows there are."""
    hashed = [F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("held"), F.col(f"`{id_column}`").alias("id"),
                        F.xxhash64(*hashed).alias("hash"), F.monotonically_increasing_id().alias("copy"))
    order = ["id", "hash", "copy"]
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    # Written, so that a lost executor cannot deal the rows anew between counting and numbering.
    stored = materialize(ordered.select("held", F.monotonically_increasing_id().alias("at")), "numbered")
    part = F.shiftright("at", 33)
    sizes = stored.groupBy(part.alias("part")).agg(F.count("*").alias("n"))  # a row for each range
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(sizes.select("part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")), "starts")
    total = starts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    number = F.col("start") + F.col("at") - F.shiftleft("part", 33)
    return stored.join(F.broadcast(starts), part == F.col("part")).select("held", number.alias("number")), total


def shard(docs: DataFrame, shards: int, id_column: str = "doc_id", seed: int = 0, into: str = "shard", slot: str = "slot") -> DataFrame:
    """All rows with their shard, from 0, and their slot in it, from 0."""
    rows, total = numbered(docs, id_column)
    found = permuted(rows, "number", total, seed)
    kept = [F.col(f"held.`{c}`") for c in docs.columns if c.lower() not in (into.lower(), slot.lower())]
    return found.select(*kept, (F.col("number") % shards).cast("int").alias(into), F.call_function("div", F.col("number"), F.lit(shards)).alias(slot))


def write(docs: DataFrame, path: str, shards: int, rows_per_file: int = 1_000_000, **options) -> None:
    """One folder for each shard below ``path``, of files of ``rows_per_file`` rows at most, each in the order of the slots."""
    placed = shard(docs, shards, **options)
    into, slot = options.get("into", "shard"), options.get("slot", "slot")
    part = F.call_function("div", F.col(slot), F.lit(rows_per_file))
    placed = placed.withColumn("part of shard", part)
    ordered = placed.repartition(into, "part of shard").sortWithinPartitions(into, slot).drop("part of shard")
    ordered.write.partitionBy(into).option("maxRecordsPerFile", rows_per_file).parquet(path)


def digests(placed: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """What the query returns of each row: size in bytes, checksum of the text, the law that holds, shard and slot."""
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    return placed.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def sql(shards: int, seed: int = 0) -> str:
    """The same in SQL: row numbers by the id, rounds as nested queries, the walk as a recursion."""
    high, wide = "(SELECT high FROM g)", "(SELECT wide FROM g)"

    def once(source: str) -> str:
        out = f"SELECT x0, x // {wide} AS l, x % {wide} AS r FROM ({source})"
        for i, (a, b, c, d) in enumerate(keys(seed)):
            side, other, size = ("l", "r", high) if i % 2 == 0 else ("r", "l", wide)
            out = (f"SELECT x0, {other}, ({side} + (({other} * {a} + {b}) % {PRIMES[0]} * {c} + {d}) % {PRIMES[1]}) % {size} AS {side} "
                   f"FROM ({out})")
        return f"SELECT x0, l * {wide} + r AS x FROM ({out})"

    table = ("list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: "
             "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i::BIGINT))")
    return f"""
    WITH RECURSIVE n AS (SELECT count(*)::BIGINT AS n FROM documents),
    g AS (SELECT n, high, greatest(1, (n + high - 1) // high) AS wide FROM (
        SELECT n, greatest(1, ceil(sqrt(n)))::BIGINT AS high FROM n)),
    rows AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST) - 1 AS x0 FROM documents),
    walk AS ({once("SELECT x0, x0 AS x FROM rows")}
        UNION ALL {once("SELECT x0, x FROM walk WHERE x >= (SELECT n FROM g)")}),
    crc AS (SELECT {table} AS t),
    bytes AS (SELECT x0, hex(encode(coalesce(text, ''))) AS h FROM rows),
    sums AS (SELECT x0, xor(list_reduce(list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT),
        lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295), 4294967295) AS text_crc32 FROM bytes, crc)
    SELECT doc_id, (octet_length(encode(coalesce(text, ''))) + 16)::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law,
        (x % {shards})::INT AS shard, x // {shards} AS slot, NULL::INT AS grown_shard
    FROM rows JOIN walk USING (x0) JOIN sums USING (x0) WHERE x < (SELECT n FROM g)"""
