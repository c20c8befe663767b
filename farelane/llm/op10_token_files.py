"""Token ids in Arrow stream files of fixed-size lists, and the way back."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelane.llm.texts import gathered, give_back, slices, small_batches
from farelane.llm.tokens import Pieces, load
from farelane.session import fresh_path, hadoop_path

#: Ids in a sequence, sequences in a record batch, and ids after which a file ends with its document.
WIDTH, BATCH_SEQUENCES, FILE_IDS = 1024, 1024, 1 << 21
#: Documents that a Python worker is sent at once.
BATCH_ROWS = 250


def sequence_schema(width: int) -> pa.Schema:
    """Sequences of one length with a mask, true where an id stands: row i of a batch is at
    i * width of one flat buffer."""
    lists = {
        "ids": pa.list_(pa.field("item", pa.uint16(), nullable=False), width),
        "mask": pa.list_(pa.field("item", pa.bool_(), nullable=False), width),
    }
    return pa.schema([pa.field(k, v, nullable=False) for k, v in lists.items()])


def file_bytes(doc_ids: pa.Array, starts: np.ndarray, ids: np.ndarray, width: int) -> pa.Buffer:
    """One file: a stream of its documents with ``start`` and ``n_tokens``, then one of its sequences."""
    sink = pa.BufferOutputStream()
    documents = pa.RecordBatch.from_arrays(
        [doc_ids, pa.array(starts[:-1]), pa.array(np.diff(starts))], ["doc_id", "start", "n_tokens"]
    )
    with pa.ipc.new_stream(sink, documents.schema) as out:
        out.write_batch(documents)
    rows = -(-len(ids) // width)
    padded = np.zeros(rows * width, dtype=np.uint16)
    padded[: len(ids)] = ids
    mask = np.arange(rows * width) < len(ids)
    schema = sequence_schema(width)
    with pa.ipc.new_stream(sink, schema) as out:
        for lo in range(0, rows * width, BATCH_SEQUENCES * width):
            flat, known = padded[lo : lo + BATCH_SEQUENCES * width], mask[lo : lo + BATCH_SEQUENCES * width]
            columns = [
                pa.FixedSizeListArray.from_arrays(pa.array(values), type=field.type)
                for values, field in zip((flat, known), schema)
            ]
            out.write_batch(pa.RecordBatch.from_arrays(columns, schema=schema))
    return sink.getvalue()


def open_file(buffer) -> tuple[pa.Table, list[pa.RecordBatch]]:
    """The documents and the batches of sequences of one file; both share the buffer's memory."""
    reader = pa.BufferReader(buffer)
    with pa.ipc.open_stream(reader) as stream:
        documents = stream.read_all()
    with pa.ipc.open_stream(reader) as stream:
        return documents, list(stream)


def sequences(batch: pa.RecordBatch) -> np.ndarray:
    """The ids of a batch as (sequences, width), without a copy."""
    column = batch.column("ids")
    return column.flatten().to_numpy(zero_copy_only=True).reshape(-1, column.type.list_size)


def parts_of(batch: pa.RecordBatch):
    """``doc_id``, where each document's ids start and the ids, of parts of about ``FILE_IDS`` ids."""
    packed = batch.column("ids").cast(pa.large_binary())
    ends = np.cumsum(pc.binary_length(packed).to_numpy() // 2)
    cuts = np.flatnonzero(np.diff(ends // FILE_IDS)) + 1
    for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
        if lo == hi:
            continue
        part = packed.slice(lo, hi - lo)
        offsets = np.frombuffer(part.buffers()[1], dtype=np.int64)[part.offset : part.offset + len(part) + 1]
        ids = np.frombuffer(part.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]].view("<u2")
        yield batch.column("doc_id").slice(lo, hi - lo), (offsets - offsets[0]) // 2, ids


def range_bounds(rows: DataFrame, partitions: int) -> list[Column]:
    """Where ranges of the rows' order begin but for the first: at most ``partitions`` - 1 literals."""
    place = F.struct(*rows.columns)
    dealt = rows.repartitionByRange(partitions, *rows.columns)
    least = dealt.groupBy(F.spark_partition_id().alias("part")).agg(F.min(place).alias("least"))
    fields = {x.name: x.dataType for x in rows.schema}
    begins = [r.least for r in least.orderBy("part").collect()[1:]]
    return [F.struct(*[F.lit(r[k]).cast(t).alias(k) for k, t in fields.items()]) for r in begins]


def write_token_files(
    docs: DataFrame,
    tokenizer: str,
    root: str,
    end: int = 1,
    width: int = WIDTH,
    partitions: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Write the ids of ``docs`` in ascending id order below ``root``; return the list of files.

    ``root`` is a folder that executors share, by a path or URI of which Arrow has the file system.
    Documents are encoded where they lie; their ids, of 16 bits and smaller than the texts, are dealt
    out by ranges of (id, hash of the text) and sorted, and each range writes files of its own, which
    end with a document. A file is named by its range, its number in that and the task's attempt, and
    gets this name when it is whole: a repeated task writes other files, and only those that the
    returned table names count. The vocabulary may have 65,536 ids; a larger one is refused.

    Null and empty texts are the end id alone. Null ids come first. Rows of one id are ordered by the
    text's hash and then its ids; repeated rows are written each for itself. An empty table writes no
    file.
    """
    if load(tokenizer).get_vocab_size() > 1 << 16:
        raise ValueError("the files hold ids of 16 bits")
    partitions = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def encoded(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, starts = Pieces(batch.column("text"), tokenizer).ids(end)
        buffers = [None, pa.py_buffer((2 * starts).astype(np.int32)), pa.py_buffer(ids.astype("<u2"))]
        packed = pa.Array.from_buffers(pa.binary(), batch.num_rows, buffers)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tie"), packed], ["doc_id", "tie", "ids"])

    def encode(batches):
        # Nothing of a slice but its ids is left when the next one is gathered.
        yield from map(encoded, slices(gathered(batches)))

    def write(batches):
        task = TaskContext.get()
        part, attempt, number = task.partitionId(), task.taskAttemptId(), 0
        files, folder = arrow_fs.FileSystem.from_uri(f"{root}/data")
        files.create_dir(folder, recursive=True)
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        size = 0

        def save() -> pa.RecordBatch:
            lengths = np.concatenate([np.diff(starts) for _, starts, _ in held])
            starts = np.concatenate([[0], np.cumsum(lengths)])
            ids = np.concatenate([ids for _, _, ids in held])
            name = f"{part:08d}-{number:05d}-{attempt}.arrows"
            content = file_bytes(pa.concat_arrays([x for x, _, _ in held]), starts, ids, width)
            with files.open_output_stream(f"{folder}/.{name}") as out:
                out.write(content)
            files.move(f"{folder}/.{name}", f"{folder}/{name}")
            return pa.RecordBatch.from_pydict(
                {"name": [name], "part": [part], "number": [number], "n_ids": [len(ids)]}
            )

        for batch in batches:
            for doc_ids, starts, ids in parts_of(batch):
                held.append((doc_ids, starts, ids))
                size += len(ids)
                if size < FILE_IDS:
                    continue
                yield save()
                held, size, number = [], 0, number + 1
        if held:
            yield save()
        held = []
        give_back()

    texts = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).withColumn("tie", F.xxhash64("text"))
    bounds = range_bounds(texts.select("doc_id", "tie"), partitions)
    kind = texts.schema["doc_id"].dataType.simpleString()
    place = F.struct("doc_id", "tie")
    below = F.size(F.filter(F.array(*bounds), lambda x: x <= place)) if bounds else F.lit(0)
    ordered = (
        texts.mapInArrow(encode, f"doc_id {kind}, tie long, ids binary")
        .repartitionById(len(bounds) + 1, below)
        .sortWithinPartitions("doc_id", "tie", "ids")
        .select("doc_id", "ids")
    )
    listed = ordered.mapInArrow(write, "name string, part long, number long, n_ids long")
    fs, data = hadoop_path(docs.sparkSession, f"{root}/data")
    fs.mkdirs(data)
    with small_batches(docs.sparkSession, BATCH_ROWS):
        listed.write.parquet(f"{root}/files")
    return docs.sparkSession.read.schema(listed.schema).parquet(f"{root}/files")


def read_token_files(listed: DataFrame, root: str, id_type: str = "bigint") -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` of each document, from the files.

    Spark reads the files; the ids before each come from the sizes in ``listed``, a row for each
    file. An empty list gives no row.
    """
    spark = listed.sparkSession
    # Ids before a file: those of earlier ranges, of which there are as many as tasks wrote, and those of
    # its own range's earlier files.
    ranges = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = listed.groupBy("part").agg(F.sum("n_ids").alias("n"))
    sums = sums.select("part", F.coalesce(F.sum("n").over(ranges), F.lit(0)).alias("before"))
    earlier = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    based = listed.withColumn("own", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)))
    based = based.join(sums, "part").select("name", (F.col("before") + F.col("own")).alias("base"))
    # Each file is about FILE_IDS ids, so a file is a row that a task can hold.
    contents = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.arrows")
        .load(f"{root}/data")
        .select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    )

    def documents(batches):
        for batch in batches:
            for name, content in zip(batch.column("name"), batch.column("content")):
                found, parts = open_file(content.as_buffer())
                flat = np.concatenate([sequences(x).reshape(-1) for x in parts])
                raw = flat.astype("<u4").tobytes()
                start, n = (found[k].to_numpy() for k in ("start", "n_tokens"))
                crc = [zlib.crc32(raw[4 * a : 4 * (a + k)]) for a, k in zip(start.tolist(), n.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name.as_py()] * len(n)),
                        found["doc_id"].combine_chunks(),
                        pa.array(start),
                        pa.array(n),
                        pa.array(crc, pa.int64()),
                    ],
                    ["name", "doc_id", "local", "n_tokens", "ids_crc32"],
                )
        give_back()

    found = contents.mapInArrow(
        documents, f"name string, doc_id {id_type}, local long, n_tokens long, ids_crc32 long"
    )
    return found.join(based, "name").select(
        "doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_files(docs: DataFrame, tokenizer: str, end: int = 1, root: str | None = None) -> DataFrame:
    """Write ``docs`` below ``root``, by default in the shared folder, and read them back."""
    root = root or fresh_path(docs.sparkSession, "token-files")
    listed = write_token_files(docs, tokenizer, root, end)
    return read_token_files(listed, root, docs.schema["doc_id"].dataType.simpleString())
