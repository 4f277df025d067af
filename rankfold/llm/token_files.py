"""Token ids in binary files: frequency-ranked, byte-aligned, with separate control bytes.

``write_ids`` encodes every text once, ranks the ids by how often they occur
(rank 0 is the most frequent) and writes the ranks in ascending order of the
document id.  A rank takes one to four bytes, low byte first; two control bits
give its length, and four ranks share one control byte.  Control bytes stand
apart from data bytes, so a reader needs no branch per byte: a 256-row table
turns control bytes into lengths, their running sum into places, and one gather
per byte position into ranks; a second table turns ranks into ids.  Every
document starts with a control byte of its own (up to three zero ranks fill the
one before), so each can be decoded alone.

A folder holds ``ranks`` (the id of every rank), ``files`` (a Parquet list of
the data files with the ids before each) and the data files::

    magic "FRVB", version, documents, ranks      4 little-endian 64-bit numbers
    document ids, null flags, ranks each         64, 8 and 64 bits a document
    control bytes, data bytes

Steps: encode (a written table of compressed ids), count ids (at most one row a
vocabulary entry reaches the driver), sort by range (the row's own number
splits an id that a third of all rows may share), write files of about
``FILE_IDS`` ids.  A task that is run again writes equal bytes under the same
name.  Only numbers per file and per range partition meet in one place.

Edge cases: a null or empty text has the end id alone; null document ids come
first; rows that share an id stand by checksum of their ids, equal ones in
their input order; a document is never split, so the longest one bounds a file
and a task's memory; an empty table writes no data file and reads as no rows;
extra columns are ignored.  The vocabulary must lie at ``vocabulary`` on every
worker.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .arrays import map_array, write_array
from .pieces import encoder
from .textvec import chunks

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
FILE_IDS = 4_000_000
MAGIC = int.from_bytes(b"FRVB", "little")
VERSION = 1
#: Lengths of the four ranks behind each control byte.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1

CODED = "doc_id long, rid long, crc long, n_ids long, packed binary, counts binary"
FILES = "part int, seq int, file string, n_docs long, n_ids long, n_bytes long"
READ = "doc_id long, start long, n_ids long, ids binary"


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


def pack(ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(control bytes, data bytes) of ``ranks``, whose number is a multiple of four."""
    size = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    code = (size - 1).reshape(-1, 4).astype(np.uint8)
    control = code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6
    first = np.cumsum(size, dtype=np.int64) - size
    data = np.zeros(int(size.sum(dtype=np.int64)), np.uint8)
    for k in range(4):
        has = np.flatnonzero(size > k)
        if len(has) == 0:
            break
        data[first[has] + k] = ranks[has] >> (8 * k) & 0xFF
    return control.astype(np.uint8), data


def unpack(control: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, int]:
    """(ranks behind ``control``, data bytes they took)."""
    size = LENGTHS[control].ravel()
    behind = np.cumsum(size, dtype=np.int64)
    if len(behind) == 0:
        return np.empty(0, np.uint32), 0
    first = behind - size
    ranks = data[first].astype(np.uint32)
    for k in range(1, 4):
        has = np.flatnonzero(size > k)
        if len(has) == 0:
            break
        ranks[has] |= data[first[has] + k].astype(np.uint32) << np.uint32(8 * k)
    return ranks, int(behind[-1])


def _slots(n: np.ndarray) -> tuple[np.ndarray, int]:
    """Places of the ranks of documents with ``n`` ranks each when every document fills whole control bytes."""
    room = (n + 3) // 4 * 4
    shift = (np.cumsum(room) - room) - (np.cumsum(n) - n)
    return np.arange(int(n.sum())) + np.repeat(shift, n), int(room.sum())


def encode_ids(docs: DataFrame, vocabulary: str, end_id: int | None = END_ID, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """(doc_id, rid, crc, n_ids, packed, counts): the ids of every whole text, compressed; ``rid`` is the input order.

    The first row of a chunk holds how often each id occurs in the chunk (ids, then counts, 32 bits each).
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("rid"),
                       F.coalesce(text_col, F.lit("")).alias("text"))
    end = np.array([] if end_id is None else [end_id], "<u4")

    def run(batches):
        enc, squeeze = encoder(vocabulary), pa.Codec("zstd")
        for b in chunks(batches, max_bytes=16 << 20):
            ids, n = enc.encode(b.column("text"))
            edges = np.concatenate(([0], np.cumsum(n)))
            crc, packed = [], []
            for i, j in zip(edges[:-1], edges[1:]):
                raw = np.concatenate((ids[i:j].astype("<u4"), end))
                crc.append(zlib.crc32(raw))
                packed.append(squeeze.compress(raw, asbytes=True))
            total = np.bincount(ids, minlength=int(end.max(initial=0)) + 1)
            total[end] += b.num_rows
            seen = np.flatnonzero(total)
            counts = np.concatenate((seen, total[seen])).astype("<u4").tobytes()
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("rid"), pa.array(crc, pa.int64()), pa.array(n + len(end), pa.int64()),
                 pa.array(packed, pa.binary()), pa.array([counts] + [None] * (b.num_rows - 1), pa.binary())],
                names=["doc_id", "rid", "crc", "n_ids", "packed", "counts"])
    return rows.mapInArrow(run, CODED)


def _opened(b: pa.RecordBatch, squeeze: pa.Codec) -> list[np.ndarray]:
    return [np.frombuffer(squeeze.decompress(p, 4 * n, asbytes=True), "<u4") if n else np.empty(0, "<u4")
            for n, p in zip(b.column("n_ids").to_pylist(), b.column("packed"))]


def id_ranks(coded: DataFrame) -> DataFrame:
    """(id, count), most frequent first, ties to the smaller id."""
    def add(batches):
        total = np.zeros(0, np.int64)
        for b in batches:
            for raw in b.column(0):
                ids, n = np.frombuffer(raw.as_py(), "<u4").reshape(2, -1).astype(np.int64)
                if len(ids) and ids[-1] >= len(total):
                    total = np.concatenate((total, np.zeros(int(ids[-1]) + 1 - len(total), np.int64)))
                total[ids] += n
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen])], names=["id", "count"])
    counts = coded.where("counts IS NOT NULL").select("counts").mapInArrow(add, "id long, count long")
    return counts.groupBy("id").agg(F.sum("count").alias("count")).orderBy(F.desc("count"), "id")


def _write_files(folder: str, rank_of: np.ndarray, file_ids: int):
    def save(part: int, seq: int, docs: list, ids: list[np.ndarray]):
        n = np.array([len(x) for x in ids], np.int64)
        places, room = _slots(n)
        ranks = np.zeros(room, np.uint32)
        ranks[places] = rank_of[np.concatenate(ids)]
        control, data = pack(ranks)
        head = np.array([MAGIC, VERSION, len(docs), len(ranks)], "<u8")
        keys = np.array([0 if d is None else d for d in docs], "<i8")
        null = np.array([d is None for d in docs], np.uint8)
        body = np.concatenate([x.view(np.uint8) for x in (head, keys, null, n.astype("<u8"), control, data)])
        name = f"ids-{part:07d}-{seq:04d}.frvb"
        write_array(folder, name, body)
        return part, seq, name, len(docs), int(n.sum()), len(body)

    def run(batches):
        part, squeeze, seq, held = TaskContext.get().partitionId(), pa.Codec("zstd"), 0, 0
        docs, ids, out = [], [], []
        for b in batches:
            for doc, x in zip(b.column("doc_id").to_pylist(), _opened(b, squeeze)):
                docs.append(doc)
                ids.append(x)
                held += len(x)
                if held >= file_ids:
                    out.append(save(part, seq, docs, ids))
                    docs, ids, held, seq = [], [], 0, seq + 1
        if docs:
            out.append(save(part, seq, docs, ids))
        columns = zip(*out) if out else [[]] * 6
        types = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                         names=["part", "seq", "file", "n_docs", "n_ids", "n_bytes"])
    return run


def write_ids(docs: DataFrame, folder: str | None = None, vocabulary: str | None = None, end_id: int | None = END_ID,
              file_ids: int = FILE_IDS, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Write the ids of all texts in ascending document order; returns the folder (one in the shared folder if not given)."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "ids")
    path = scratch_path(spark, "coded")
    coded = encode_ids(docs, vocabulary or default_vocabulary(), end_id, id_col, text_col)
    coded.write.option("compression", "none").parquet(path)         # the ids are compressed already
    coded = spark.read.schema(CODED).parquet(path)
    ranked = np.array([r.id for r in id_ranks(coded).collect()], np.uint32)      # at most one row a vocabulary entry
    rank_of = np.zeros(int(ranked.max()) + 1 if len(ranked) else 0, np.uint32)
    rank_of[ranked] = np.arange(len(ranked), dtype=np.uint32)
    write_array(folder, "ranks", ranked.astype("<u4"))
    total = coded.agg(F.sum("n_ids")).first()[0] or 0
    parts = max(1, -(-total // file_ids), min(spark.sparkContext.defaultParallelism, total // 200_000))
    ordered = (coded.repartitionByRange(parts, F.asc_nulls_first("doc_id"), "crc", "rid")
               .sortWithinPartitions(F.asc_nulls_first("doc_id"), "crc", "rid").select("doc_id", "n_ids", "packed"))
    scratch = scratch_path(spark, "written")
    ordered.mapInArrow(_write_files(folder, rank_of, file_ids), FILES).write.parquet(scratch)
    listed = spark.read.schema(FILES).parquet(scratch)
    # ids before each file: sums per range partition run over one row a partition, then inside each partition
    per = listed.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    per = per.select("part", (F.sum("_n").over(Window.orderBy("part")) - F.col("_n")).alias("_before"))
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_ids")
    (listed.withColumn("_inside", inside).join(per, "part")
     .select("part", "seq", "file", "n_docs", "n_ids", "n_bytes", (F.col("_before") + F.col("_inside")).alias("start"))
     .write.parquet(f"{folder}/files"))
    return folder


def _documents(body: np.ndarray, block_ids: int = 1 << 19):
    """(document ids, null flags, ranks each, ranks in a row) of a data file, a block of documents at a time."""
    head = body[:32].view("<u8")
    if len(head) < 4 or head[0] != MAGIC or head[1] != VERSION:
        raise ValueError("not a token id file of this version")
    docs, slots = int(head[2]), int(head[3])
    a = 32 + 8 * docs
    keys, null = body[32:a].view("<i8"), body[a:a + docs]
    n = body[a + docs:a + 9 * docs].copy().view("<u8").astype(np.int64)
    control = body[a + 9 * docs:a + 9 * docs + slots // 4]
    data = body[a + 9 * docs + slots // 4:]
    room = np.cumsum((n + 3) // 4)
    i = done = at = 0
    while i < docs:
        j = max(i + 1, int(np.searchsorted(room, done + block_ids // 4, side="right")))
        ranks, used = unpack(control[done:room[j - 1]], data[at:])
        places, _ = _slots(n[i:j])
        yield keys[i:j], null[i:j], n[i:j], ranks[places]
        i, done, at = j, int(room[j - 1]), at + used


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_ids, ids) from the files: ``ids`` are little-endian 32-bit, ``start`` counts the ids before."""
    listed = spark.read.parquet(f"{folder}/files").select("file", "start")
    files = listed.count()
    listed = listed.repartition(max(1, min(files, 4 * spark.sparkContext.defaultParallelism)), "file")

    def run(batches):
        id_of = map_array(folder, "ranks", "<u4")
        for b in batches:
            for name, start in zip(b.column("file").to_pylist(), b.column("start").to_pylist()):
                for keys, null, n, ranks in _documents(map_array(folder, name, np.uint8)):
                    raw = id_of[ranks].astype("<u4").tobytes()
                    edges = np.concatenate(([0], np.cumsum(n)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys, pa.int64(), mask=null.astype(bool)), pa.array(start + edges[:-1], pa.int64()),
                         pa.array(n, pa.int64()),
                         pa.array([raw[4 * i:4 * j] for i, j in zip(edges[:-1], edges[1:])], pa.binary())],
                        names=["doc_id", "start", "n_ids", "ids"])
                    start += int(edges[-1])
    return listed.mapInArrow(run, READ)
