"""Token-id files: documents as blocks of range-coded ids (see idcoder), in ascending order of their ids.

A file set is a folder of records, one for each block: shard and block number, the ids before it in its shard, the documents in it, and the coded block
with header and checksum as its payload. The folder is written by Spark's own committer, so a lost executor leaves no half-written block. Documents
are dealt over shards by ranges of their id; a document is cut only where it is longer than a block.

Cases: a null or empty text is its end id alone; repeated rows are written each, next to one another; rows that share an id are ordered by
text; a null id comes first; an empty table gives an empty file set; other columns are ignored; a vocabulary of more than 131,072 ids is refused.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from gridpulse.llm import idcoder
from gridpulse.llm.encoding import encoder
from gridpulse.scratch import materialize

RECORD = ("shard int, block int, first long, n_ids long, docs array<struct<doc_id: long, doc_no: long, start: long, length: long, pieces: int>>, "
          "payload binary")
_DOC = pa.struct([("doc_id", pa.int64()), ("doc_no", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("pieces", pa.int32())])
_RECORD = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()), ("docs", pa.list_(_DOC)),
                     ("payload", pa.binary())])


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, blanks: bool = False, id_column: str = "doc_id",
          text_column: str = "text", block_ids: int = 1 << 17, together: int = 48) -> None:
    """Encode every whole text, append ``end_id`` and write the ids below ``path``. ``together`` blocks are coded in step."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, shard = encoder(tokenizer_path, blanks), TaskContext.get().partitionId()
        vocabulary = max(tokenizer.tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1)
        if vocabulary > 1 << 17:
            raise ValueError("the vocabulary is too large for this format")
        full: list[tuple[np.ndarray, list]] = []
        ids, spans, size, first, block, doc_no = [], [], 0, 0, 0, 0

        def close() -> None:
            nonlocal ids, spans, size
            if size:
                full.append((np.concatenate(ids), spans))
            ids, spans, size = [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal full, first, block
            rows = []
            for (held, docs_in), payload in zip(full, idcoder.encode([h for h, _ in full], vocabulary)):
                rows.append({"shard": shard, "block": block, "first": first, "n_ids": len(held), "docs": docs_in, "payload": payload})
                first, block = first + len(held), block + 1
            full = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_RECORD)

        for batch in batches:
            names, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for at in range(0, len(names), 256):
                found = tokenizer.parts_of(texts.slice(at, 256).to_pylist())
                for name, parts in zip(names[at: at + 256], found):
                    own = np.append(tokenizer.ids_of(parts), np.uint32(end_id))
                    pieces = -(-len(own) // block_ids)
                    if size + len(own) > block_ids:
                        close()
                    for p in range(pieces):
                        part = own[p * block_ids: (p + 1) * block_ids]
                        ids.append(part)
                        spans.append({"doc_id": name, "doc_no": doc_no, "start": p * block_ids, "length": len(part), "pieces": pieces})
                        size += len(part)
                        if pieces > 1:
                            close()
                    doc_no += 1
                if len(full) >= together:
                    yield from flush()
        close()
        yield from flush()

    frame = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    ordered = frame.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, RECORD).write.parquet(path)


def _decoded(batches: Iterator[pa.RecordBatch], together: int) -> Iterator[tuple[dict, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, together):
            rows = batch.slice(at, together).to_pylist()
            # Blocks of several vocabularies may lie in one folder.
            groups: dict[int, list[dict]] = {}
            for row in rows:
                groups.setdefault(idcoder.HEADER.unpack_from(row["payload"])[2], []).append(row)
            for own in groups.values():
                yield from zip(own, idcoder.decode([r["payload"] for r in own]))


def read(spark: SparkSession, path: str, together: int = 48) -> DataFrame:
    """doc_id, shard, doc_no, start, ids: every piece of every document as it was written."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, ids in _decoded(batches, together):
            at, out = 0, []
            for d in row["docs"]:
                out.append({"doc_id": d["doc_id"], "shard": row["shard"], "doc_no": d["doc_no"], "start": d["start"],
                            "ids": ids[at: at + d["length"]].astype(np.int64)})
                at += d["length"]
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                ("doc_id", pa.int64()), ("shard", pa.int32()), ("doc_no", pa.int64()), ("start", pa.int64()), ("ids", pa.list_(pa.int64()))]))

    return _records(spark, path).mapInArrow(run, "doc_id long, shard int, doc_no long, start long, ids array<long>")


def digests(spark: SparkSession, path: str, together: int = 48) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of each document in the files."""
    names = ["doc_id", "shard", "doc_no", "pieces", "at", "n_tokens", "ids_crc32"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, ids in _decoded(batches, together):
            raw, at, out = ids.astype("<u4").tobytes(), 0, []
            for d in row["docs"]:
                end = at + d["length"]
                out.append((d["doc_id"], row["shard"], d["doc_no"], d["pieces"], row["first"] + at, d["length"], zlib.crc32(raw[4 * at: 4 * end])))
                at = end
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    blocks = _records(spark, path)
    schema = "doc_id long, shard int, doc_no long, pieces int, at long, n_tokens long, ids_crc32 long"
    # Blocks are dealt anew: the files' sizes say nothing about the time to decode them.
    # Read twice, whole documents and cut ones, so it is written once.
    found = materialize(blocks.repartition("shard", F.floor(F.col("block") / together)).mapInArrow(run, schema), "digests")
    whole = found.where("pieces = 1").drop("pieces")
    cut = found.where("pieces > 1").groupBy("shard", "doc_no").applyInPandas(_joined, "doc_id long, shard int, doc_no long, at long, n_tokens long, ids_crc32 long")
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))  # a row for each shard
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return whole.unionByName(cut).join(F.broadcast(base), "shard").select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def _records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RECORD).parquet(path)


def _joined(frame: pd.DataFrame) -> pd.DataFrame:
    """The pieces of one document, which are few, as one."""
    frame = frame.sort_values("at")
    crc = 0
    for length, part in zip(frame["n_tokens"].tolist(), frame["ids_crc32"].tolist()):
        crc = combine(crc, part, 4 * length)
    first = frame.iloc[[0]][["doc_id", "shard", "doc_no", "at"]]
    return first.assign(n_tokens=int(frame["n_tokens"].sum()), ids_crc32=crc)


def combine(first: int, second: int, length: int) -> int:
    """The crc32 of two byte strings one after the other, from the crc32 of each and the length of the second."""
    # Appending a zero byte is linear over the bits of the crc; the matrix of one zero bit is squared up to ``length`` bytes.
    matrix = [0xEDB88320] + [1 << i for i in range(31)]

    def times(m: list[int], vector: int) -> int:
        out = 0
        for row in m:
            if vector & 1:
                out ^= row
            vector >>= 1
        return out

    for _ in range(3):
        matrix = [times(matrix, row) for row in matrix]
    while length:
        if length & 1:
            first = times(matrix, first)
        matrix = [times(matrix, row) for row in matrix]
        length >>= 1
    return first ^ second
