"""Token ids in binary shards: blocks of ids cut into planes, each plane compressed, with an index of the blocks.

A shard file is a magic word, the planes of its blocks one after the other, an index entry per
block and a footer. A block holds ``block`` ids (the last one of a shard fewer). Its ids are turned
so that all lowest bytes (or bits) lie side by side, then all next ones, and so on: high planes of
a vocabulary are nearly constant and shrink to a few bytes. An index entry is the block's offset,
its number of ids and the stored length of each plane; a plane of zeros has length 0 and no bytes.
So a reader finds any id by one seek, and reads no other block.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.llm.common import file_system
from loanlens.llm.encoding import ByteEncoder
from loanlens.session import shared_folder

END = 0
#: Ids of a block. A writer and a reader hold one block at a time.
BLOCK = 1 << 16
MAGIC = b"IDPLANES"
#: Planes of an id, by the kind of plane.
PLANES = {"byte": 4, "bit": 32}
LEVEL = 3
#: Bytes of texts that are encoded together, if there are several: each different word of theirs is looked up once.
TEXT_BYTES_AT_ONCE = 2 << 20
ROWS_AT_ONCE = 4096


def planes_of(ids: np.ndarray, kind: str) -> np.ndarray:
    """A block's ids as a row of bytes per plane, lowest plane first."""
    lanes = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    if kind == "byte":
        return lanes
    shifts = np.arange(8, dtype=np.uint8)[None, :, None]
    bits = (lanes[:, None, :] >> shifts) & np.uint8(1)
    return np.packbits(bits.reshape(32, -1), axis=1, bitorder="little")


def ids_of(planes: np.ndarray, kind: str, count: int) -> np.ndarray:
    """Undo ``planes_of``."""
    if kind == "bit":
        bits = np.unpackbits(planes, axis=1, bitorder="little", count=count).reshape(4, 8, count)
        planes = (bits << np.arange(8, dtype=np.uint8)[None, :, None]).sum(axis=1, dtype=np.uint8)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


def _entry(kind: str) -> np.dtype:
    return np.dtype([("offset", "<u8"), ("count", "<u4"), ("lengths", "<u4", (PLANES[kind],))])


FOOTER = np.dtype([("index", "<u8"), ("blocks", "<u8"), ("ids", "<u8"), ("block", "<u4"), ("planes", "<u4"), ("magic", "S8")])


class ShardWriter:
    """Ids appended in any portions to one shard file."""

    def __init__(self, out, kind: str = "byte", block: int = BLOCK):
        import zstandard

        self.out, self.kind, self.block = out, kind, block
        self.pack = zstandard.ZstdCompressor(level=LEVEL).compress
        self.entries, self.held, self.waiting, self.ids = [], [], 0, 0
        self.offset = self._put(MAGIC)

    def _put(self, data: bytes) -> int:
        self.out.write(data)
        return len(data)

    def append(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.waiting += len(ids)
        if self.waiting >= self.block:
            every = np.concatenate(self.held)
            whole = len(every) - len(every) % self.block
            for at in range(0, whole, self.block):
                self._flush(every[at : at + self.block])
            self.held, self.waiting = [every[whole:].copy()], len(every) - whole

    def _flush(self, ids: np.ndarray) -> None:
        start, lengths = self.offset, []
        for plane in planes_of(ids, self.kind):
            lengths.append(self._put(self.pack(plane.tobytes())) if plane.any() else 0)
        self.offset += sum(lengths)
        self.entries.append((start, len(ids), lengths))
        self.ids += len(ids)

    def close(self) -> None:
        if self.waiting:
            self._flush(np.concatenate(self.held))
        index = np.array([(o, n, tuple(p)) for o, n, p in self.entries], dtype=_entry(self.kind))
        self._put(index.tobytes())
        footer = (self.offset, len(index), self.ids, self.block, PLANES[self.kind], MAGIC)
        self._put(np.array([footer], dtype=FOOTER).tobytes())
        self.out.close()


class ShardReader:
    """Any stretch of a shard's ids; the block last read is kept."""

    def __init__(self, file):
        import zstandard

        self.file, self.unpack = file, zstandard.ZstdDecompressor().decompress
        size = file.size()
        footer = np.frombuffer(file.read_at(FOOTER.itemsize, size - FOOTER.itemsize), FOOTER)[0]
        if footer["magic"] != MAGIC:
            raise ValueError("not a shard of token ids")
        self.kind = next(kind for kind, n in PLANES.items() if n == footer["planes"])
        kind = _entry(self.kind)
        self.index = np.frombuffer(file.read_at(int(footer["blocks"]) * kind.itemsize, int(footer["index"])), kind)
        self.block, self.ids, self.at, self.held = int(footer["block"]), int(footer["ids"]), -1, None

    def read_block(self, number: int) -> np.ndarray:
        if number != self.at:
            entry = self.index[number]
            count, lengths = int(entry["count"]), entry["lengths"].tolist()
            width = count if self.kind == "byte" else (count + 7) // 8
            stored, planes, at = self.file.read_at(sum(lengths), int(entry["offset"])), np.zeros((len(lengths), width), np.uint8), 0
            for row, length in enumerate(lengths):
                if length:
                    planes[row] = np.frombuffer(self.unpack(stored[at : at + length], max_output_size=width), np.uint8)
                    at += length
            self.at, self.held = number, ids_of(planes, self.kind, count)
        return self.held

    def stretches(self, start: int, count: int) -> Iterator[np.ndarray]:
        """The ids from ``start`` on, block by block."""
        if start + count > self.ids:
            raise ValueError("beyond the end of the shard")
        while count:
            number, inside = divmod(start, self.block)
            part = self.read_block(number)[inside : inside + count]
            yield part
            start, count = start + len(part), count - len(part)


def _document(kind: T.DataType) -> T.StructType:
    fields = T._parse_datatype_string("shard int, file string, start long, n_tokens long").fields
    return T.StructType([T.StructField("doc_id", kind), *fields])


def portions(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """A batch of ``doc_id, text`` in parts with texts of ``most`` bytes, or a single longer text."""
    ends, at = np.cumsum(pc.binary_length(batch.column(1)).fill_null(0).to_numpy().astype(np.int64)), 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(at, to - at)
        at = to


def _write(folder: str, tokenizer_path: str, schema: T.StructType, kind: str, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        encode, shard = ByteEncoder(tokenizer_path, END), TaskContext.get().partitionId()
        system, path = file_system(folder)
        name, writer, start = f"{uuid.uuid4().hex}.ids", None, 0
        for batch in (part for b in batches for part in portions(b, TEXT_BYTES_AT_ONCE)):
            writer = writer or ShardWriter(system.open_output_stream(f"{path}/{name}", compression=None), kind, block)
            ids, lengths = encode.ids_of_all(batch.column(1))
            writer.append(ids)
            starts = start + np.cumsum(lengths) - lengths
            start += len(ids)
            n = batch.num_rows
            columns = [batch.column(0), pa.array([shard] * n, pa.int32()), pa.array([name] * n), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)
        if writer:
            writer.close()
        pa.default_memory_pool().release_unused()  # the worker waits for its next task without it

    return run


def write_shards(docs: DataFrame, folder: str, tokenizer_path: str, kind: str = "byte", block: int = BLOCK) -> DataFrame:
    """Encode each row of ``docs`` (``doc_id, text``) and write the ids in ascending order of ``doc_id``.

    Returns the document index, written below ``folder`` too: ``doc_id, shard, file, start, n_tokens``,
    with ``start`` counted from the shard's first id. Each document ends with the id END; a null or
    empty text is that id alone. Rows without an id come first; rows that share an id follow each
    other in the order of a digest of their texts, so that a rerun writes the same ids. Equal rows
    are written as often as they occur. Other columns are not read. No rows, no shards.

    Texts and not ids are shuffled, which is less, and by ranges of the id and of the row's place in
    the input, so that many rows with one id are shared by several shards. A task writes one file,
    a block at a time, under a name of its own; files of lost or repeated tasks are in no index.
    ``folder`` must be reachable from all executors by a file system that pyarrow knows.
    """
    if kind not in PLANES:
        raise ValueError(f"planes are of the kinds {', '.join(PLANES)}")
    system, path = file_system(folder)
    system.create_dir(path, recursive=True)
    order = ["doc_id", F.xxhash64("text"), "place"]
    dealt = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("place")).repartitionByRange(*order)
    rows = dealt.sortWithinPartitions(*order).select("doc_id", "text")
    schema = _document(docs.schema["doc_id"].dataType)
    rows.mapInArrow(_write(folder, tokenizer_path, schema, kind, block), schema).write.parquet(f"{folder}/index")
    return docs.sparkSession.read.schema(schema).parquet(f"{folder}/index")


def _read(folder: str, schema: T.StructType, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        system, path = file_system(folder)
        opened, reader = None, None
        for batch in (b.slice(at, ROWS_AT_ONCE) for b in batches for at in range(0, b.num_rows, ROWS_AT_ONCE)):
            sums, held = [], []
            places = zip(*(batch.column(c).to_pylist() for c in ("file", "start", "n_tokens")), strict=True)
            for file, start, count in places:
                if file != opened:
                    if reader:
                        reader.file.close()
                    opened, reader = file, ShardReader(system.open_input_file(f"{path}/{file}"))
                crc, parts = 0, []
                for part in reader.stretches(start, count):
                    crc = zlib.crc32(part.tobytes(), crc)
                    if with_ids:
                        parts.append(part)
                sums.append(crc)
                if with_ids:
                    held.append(np.concatenate(parts).astype(np.int32))
            columns = [batch.column("doc_id"), batch.column("first"), batch.column("n_tokens"), pa.array(sums, pa.int64())]
            if with_ids:
                columns.append(pa.array(held, arrow.field("ids").type))
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)
        if reader:
            reader.file.close()

    return run


def shards(index: DataFrame) -> DataFrame:
    """``shard, file, ids, first``: a row per shard, ``first`` being the number of ids in all shards before it.

    There are as many rows as tasks that wrote; a window over them is small at any size of the corpus.
    """
    sizes = index.groupBy("shard", "file").agg(F.sum("n_tokens").alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("first", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_documents(index: DataFrame, folder: str, selected: DataFrame | None = None, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of documents, read back from the files; ``ids`` if asked for.

    ``index`` is the whole document index; ``selected`` are the rows of it to read, all by default.
    ``start`` counts the ids of all documents before this one in all shards. A shard is read front
    to back by one task, a block at a time, and blocks without a selected document are skipped.
    """
    tasks = max(1, index.agg(F.countDistinct("shard")).first()[0])
    rows = (index if selected is None else selected).join(F.broadcast(shards(index).select("shard", "first")), "shard")
    narrow = rows.select("doc_id", "shard", "file", "start", "n_tokens", (F.col("first") + F.col("start")).alias("first"))
    ordered = narrow.repartitionByRange(tasks, "shard").sortWithinPartitions("shard", "start")
    fields = T._parse_datatype_string("start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids).fields
    schema = T.StructType([index.schema["doc_id"], *fields])
    return ordered.mapInArrow(_read(folder, schema, with_ids), schema)


def read_stretch(index: DataFrame, folder: str, start: int, count: int) -> np.ndarray:
    """``count`` ids from position ``start`` of the whole corpus on, as a trainer asks for them; by the caller, not in a job."""
    system, path = file_system(folder)
    inside = shards(index).where((F.col("first") < start + count) & (F.col("first") + F.col("ids") > start)).orderBy("first").collect()
    found = [np.empty(0, np.uint32)]
    for row in inside:
        begin, end = max(start, row["first"]), min(start + count, row["first"] + row["ids"])
        with system.open_input_file(f"{path}/{row['file']}") as file:
            found += list(ShardReader(file).stretches(begin - row["first"], end - begin))
    return np.concatenate(found)


def new_folder(spark: SparkSession) -> str:
    """A folder for shards below the cluster's shared one."""
    return f"{shared_folder(spark)}/ids-{uuid.uuid4().hex}"
