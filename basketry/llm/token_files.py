"""Files of token ids: all documents in ascending order of their id, as Simple-8b blocks, written and read by tasks.

A file holds blocks of up to ``BLOCK`` ids, whatever documents they belong to. A block has its words and escapes, and
for the documents that begin in it their ids and sizes, so that it can be decoded by itself. The index at the end of a
file says where each block begins and how many ids come before it. A reading task owns the documents that begin in its
blocks and follows the last of them into the next blocks.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm import bpe, simple8b
from basketry.llm.common import partitions, pieces, record_batch, shared_path, stored, texts_of

#: Ids in a block; blocks that a task reads.
BLOCK, RUN = 1 << 16, 32
#: Block: mark, ids, words, escapes, documents that begin in it, ids before the first of these, checksum of what follows.
HEAD = struct.Struct("<4s6I4x")
#: End of a file: blocks, ids, where the index begins, mark.
TAIL = struct.Struct("<QQQ4s")
MARK, LAST = b"S8B1", b"S8BX"
#: Rows, and ids, that a reading task hands on at a time.
ROWS, IDS = 4096, 1 << 20


class Writer:
    """Takes documents and writes their ids as blocks to ``out``."""

    def __init__(self, out) -> None:
        self.out, self.at, self.first, self.index = out, 0, 0, []
        self.ids, self.names = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.starts, self.sizes, self.nameless = (np.zeros(0, np.int64) for _ in range(3))
        self.end = 0

    def add(self, ids: np.ndarray, sizes: np.ndarray, names: np.ndarray, nameless: np.ndarray) -> None:
        """Documents of ``sizes`` ids each, laid end to end in ``ids``."""
        starts = self.end + np.cumsum(sizes) - sizes
        self.end += int(sizes.sum())
        self.ids = np.concatenate([self.ids, ids.astype(np.uint32)])
        self.starts, self.sizes = np.concatenate([self.starts, starts]), np.concatenate([self.sizes, sizes])
        self.names, self.nameless = np.concatenate([self.names, names]), np.concatenate([self.nameless, nameless])
        self._flush(BLOCK)

    def _flush(self, least: int) -> None:
        done = 0
        while len(self.ids) - done >= least:
            ids = self.ids[done:done + BLOCK]
            n = int(np.searchsorted(self.starts, self.first + len(ids)))
            lead = int(self.starts[0] - self.first) if n else len(ids)
            words, escapes = simple8b.encode(ids)
            body = b"".join(x.tobytes() for x in (
                words.astype("<u8"), escapes.astype("<u4"), self.names[:n].astype("<i8"), self.sizes[:n].astype("<i8"),
                self.nameless[:n].astype("u1")))
            self.index.append((self.at, self.first))
            self.out.write(HEAD.pack(MARK, len(ids), len(words), len(escapes), n, lead, zlib.crc32(body)))
            self.out.write(body)
            self.at += HEAD.size + len(body)
            self.first, done = self.first + len(ids), done + len(ids)
            self.names, self.sizes, self.nameless, self.starts = (
                x[n:] for x in (self.names, self.sizes, self.nameless, self.starts))
        self.ids = self.ids[done:]

    def close(self) -> None:
        if len(self.ids):
            self._flush(1)
        index = np.array(self.index, "<u8").tobytes()
        self.out.write(index + TAIL.pack(len(self.index), self.end, self.at, LAST))
        self.at += len(index) + TAIL.size


class Reader:
    """The blocks of a file, by the index at its end."""

    def __init__(self, file) -> None:
        self.file, size = file, file.size()
        self.n_blocks, self.n_ids, at, mark = TAIL.unpack(file.read_at(TAIL.size, size - TAIL.size))
        if mark != LAST:
            raise ValueError("no end of a token file")
        index = np.frombuffer(file.read_at(16 * self.n_blocks, at), "<u8").reshape(-1, 2).astype(np.int64)
        self.places, self.firsts = np.append(index[:, 0], at).tolist(), index[:, 1].tolist()

    def block(self, k: int) -> tuple[np.ndarray, int, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of block ``k``, ids before its first document, and names, sizes and lack of a name of its documents."""
        raw = self.file.read_at(self.places[k + 1] - self.places[k], self.places[k])
        mark, n, n_words, n_escapes, n_docs, lead, check = HEAD.unpack_from(raw)
        if mark != MARK or zlib.crc32(memoryview(raw)[HEAD.size:]) != check:
            raise ValueError(f"block {k} is damaged")
        parts, at = [], HEAD.size
        for kind, size in (("<u8", n_words), ("<u4", n_escapes), ("<i8", n_docs), ("<i8", n_docs), ("u1", n_docs)):
            parts.append(np.frombuffer(raw, kind, size, at))
            at += parts[-1].nbytes
        return simple8b.decode(parts[0], parts[1], n), lead, *parts[2:]

    def documents(self, first: int, last: int) -> Iterator[tuple[int | None, int, int, list[np.ndarray]]]:
        """Id, place of the first token in the file, size and parts of each document that begins in the blocks from
        ``first`` up to, not including, ``last``."""
        begun, missing = None, 0
        for k in range(first, self.n_blocks):
            if k >= last and not missing:
                return
            ids, lead, names, sizes, nameless = self.block(k)
            if missing:
                begun[3].append(ids[:missing])
                missing -= len(begun[3][-1])
                if not missing:
                    yield begun
            if k >= last:
                continue
            at = lead
            for name, size, none in zip(names.tolist(), sizes.tolist(), nameless.tolist()):
                begun = (None if none else name, self.firsts[k] + at, size, [ids[at:at + size]])
                missing = size - len(begun[3][0])
                at += size
                if not missing:
                    yield begun


def write_tokens(
    documents: DataFrame, tokenizer: str, folder: str, end_id: int = 0, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Writes the ids of all ``documents`` as files below ``folder``; a table of ``path``, ``part`` (the order of the
    files), ``base`` (ids before the file), ``ids``, ``documents`` and ``blocks``.

    Documents come in ascending order of their id, null first, those of one id by checksum of the text; each ends with
    ``end_id``. A null or empty text is its end id alone; an empty table makes no file; other columns are not written.
    The tokenizer is a byte-level one, as for ``bpe.encode``. Ranges of the order, which cut even rows of one id apart,
    make the files. A task that is repeated writes a file of another name; only files of tasks that ended are listed.
    """
    spark = documents.sparkSession
    rows = texts_of(documents, id_column, text_column).withColumns(
        {"turn": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    order = [F.col("doc_id").asc_nulls_first(), F.col("turn"), F.col("row")]
    rows = rows.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order).select("doc_id", "text")

    def write(batches):
        from pyspark import TaskContext

        context, writer, n = TaskContext.get(), None, 0
        system, base = fs.FileSystem.from_uri(folder)
        name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}.s8b"
        for piece in pieces(batches):
            if writer is None:
                system.create_dir(base, recursive=True)
                writer = Writer(system.open_output_stream(f"{base}/{name}", compression=None))
            ids, ends = bpe.encode_column(piece.column("text"), tokenizer)
            names = piece.column("doc_id")
            writer.add(
                np.insert(ids, ends[1:], end_id), np.diff(ends) + 1, names.fill_null(0).to_numpy(),
                names.is_null().to_numpy(zero_copy_only=False))
            n += piece.num_rows
        if writer is not None:
            writer.close()
            writer.out.close()
            yield record_batch({
                "path": [f"{folder}/{name}"], "part": pa.array([context.partitionId()], pa.int32()), "ids": [writer.end],
                "documents": [n], "blocks": pa.array([len(writer.index)], pa.int32())})

    files = stored(rows.mapInArrow(write, "path string, part int, ids long, documents long, blocks int"), "token-files")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return files.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_tokens(files: DataFrame, with_ids: bool = True) -> DataFrame:
    """One row per document of ``files``: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and
    ``ids`` (array of long) or else ``ids_crc32`` (of the ids as little-endian unsigned 32-bit numbers).

    A damaged block is an error. Without ids, a document of any length is read block by block.
    """
    firsts = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1, F.lit(RUN)))
    runs = files.where("blocks > 0").select("path", "base", firsts.alias("first"))
    runs = runs.repartition(partitions(files.sparkSession), "path", "first")

    def read(batches):
        for batch in batches:
            for run in batch.to_pylist():
                system, path = fs.FileSystem.from_uri(run["path"])
                with system.open_input_file(path) as file:
                    held, size = [], 0
                    for name, start, n, parts in Reader(file).documents(run["first"], run["first"] + RUN):
                        value = np.concatenate(parts).astype(np.int64) if with_ids else _checksum(parts)
                        held.append((name, start + run["base"], n, value))
                        size += n
                        if len(held) >= ROWS or with_ids and size >= IDS:
                            yield made(held)
                            held, size = [], 0
                    if held:
                        yield made(held)

    def made(held):
        names, starts, sizes, values = zip(*held)
        last = pa.array(values, pa.list_(pa.int64()) if with_ids else pa.int64())
        return record_batch({"doc_id": pa.array(names, pa.int64()), "start": pa.array(starts, pa.int64()),
                             "n_tokens": pa.array(sizes, pa.int64()), kind.split()[0]: last})

    kind = "ids array<long>" if with_ids else "ids_crc32 long"
    return runs.mapInArrow(read, f"doc_id long, start long, n_tokens long, {kind}")


def _checksum(parts: list[np.ndarray]) -> int:
    total = 0
    for part in parts:
        total = zlib.crc32(part.astype("<u4"), total)
    return total


def round_trip(documents: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = 0, **columns: str) -> DataFrame:
    """Writes the ids of ``documents`` and reads them back: ``doc_id, start, n_tokens, ids_crc32``."""
    files = write_tokens(documents, tokenizer, folder or shared_path(documents.sparkSession, "tokens"), end_id, **columns)
    return read_tokens(files, with_ids=False)
