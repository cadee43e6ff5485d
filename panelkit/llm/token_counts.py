"""Token counts of documents in flat token files without an index.

A token file holds ids of fixed width, one after the other, with an
end-of-document id after each document. Blocks of the files are searched for
that id independently, with one vectorised comparison each. A prefix scan
over the blocks' totals then stitches documents that cross blocks: it tells each
block how many documents end before it, and where the last of them ended.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelkit.llm.common import in_arrow
from panelkit.runtime import scratch_dir, stored

#: Ids are little-endian and this wide.
WIDTH = np.dtype("<u2")
#: Ids in a block.
BLOCK = 1 << 21
#: Ends a document in the files this module writes: the free id of the 50,256-id byte-level vocabulary.
EOD = 50256
#: The vocabulary's ranks, one "base64 rank" a line, and the pattern that cuts texts for it.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
#: Texts are tokenised in pieces of about this many characters, cut before a space.
PIECE = 1 << 20


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark writes it, and the path in it."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = f"file://{path[5:]}"
    return fs.FileSystem.from_uri(path)


def pieces(text: str, limit: int = PIECE) -> Iterator[str]:
    """Cut a long text before a space that follows a letter, where the pattern cuts as well."""
    at = 0
    while len(text) - at > limit:
        end = at + limit
        while end < len(text) and not (text[end] == " " and text[end - 1].isalpha() and text[end + 1 : end + 2].isalpha()):
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def tokeniser(vocabulary: str = VOCABULARY) -> Callable[[str], list[int]]:
    """A function from text to ids, made where it is called, from a vocabulary file."""
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    made = tiktoken.Encoding("flat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return made.encode_ordinary


def write_files(docs: DataFrame, id_col: str, text_col: str, path: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """Write a token file for each partition of ``docs``; (file, doc_no, doc) says what was put where.

    A task writes to a file of its own and renames it when it is whole, so that
    a task that is run again replaces what the first left. Null texts are documents without
    tokens. The folder must be one that all executors share.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        encode, (system, folder) = tokeniser(vocabulary), file_system(path)
        name = f"part-{number:06d}.bin"
        system.create_dir(folder, recursive=True)
        draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
        done = 0
        with system.open_output_stream(draft) as out:
            for batch in batches:
                for text in batch.column(1):
                    for piece in pieces(text.as_py() or ""):
                        out.write(np.array(encode(piece), WIDTH).tobytes())
                    out.write(np.array([EOD], WIDTH).tobytes())
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * n), pa.array(np.arange(done, done + n)), batch.column(0)], ["file", "doc_no", "doc"]
                )
                done += n
        system.move(draft, f"{folder}/{name}")

    flat = docs.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`").alias("text"))
    return stored(flat.transform(in_arrow, run, f"file string, doc_no long, doc {flat.schema['doc'].dataType.simpleString()}"))


def blocks(spark: SparkSession, path: str, block: int = BLOCK, width: int = WIDTH.itemsize) -> DataFrame:
    """(file, block, start, stop): the blocks of all token files below ``path``, in ids.

    Only names and sizes of files are listed. A file whose size is not a
    multiple of the width raises.
    """
    system, folder = file_system(path)
    files = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    sizes = [(f.base_name, f.size) for f in files if f.type == fs.FileType.File and not f.base_name.startswith(".")]
    if odd := [name for name, size in sizes if size % width]:
        raise ValueError(f"{odd[0]} ends within an id")
    rows = spark.createDataFrame([(n, s // width) for n, s in sizes], "file string, ids long")
    last = F.ceil(F.col("ids") / F.lit(block)) - 1
    rows = rows.where("ids > 0").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))))
    return rows.select(
        "file", "block", (F.col("block") * block).alias("start"), F.least(F.col("ids"), (F.col("block") + 1) * block).alias("stop")
    )


def _searched(path: str, eod: int, dtype: np.dtype, with_ends: bool):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, folder = file_system(path)
        for frame in frames:
            for row in frame.itertuples(index=False):
                with system.open_input_file(f"{folder}/{row.file}") as source:
                    source.seek(row.start * dtype.itemsize)
                    ids = np.frombuffer(source.read((row.stop - row.start) * dtype.itemsize), dtype)
                ends = np.flatnonzero(ids == eod) + row.start
                if with_ends:
                    first = np.append(row.open, ends[:-1] + 1) if len(ends) else ends
                    yield pd.DataFrame({"file": row.file, "doc_no": row.before + np.arange(len(ends)), "start": first, "n_tokens": ends - first})
                    if row.last and row.stop > (start := ends[-1] + 1 if len(ends) else row.open):
                        yield pd.DataFrame({"file": [row.file], "doc_no": [row.before + len(ends)], "start": [start], "n_tokens": [row.stop - start]})
                else:
                    yield pd.DataFrame({"file": [row.file], "block": [row.block], "start": [row.start], "stop": [row.stop], "found": [len(ends)], "end": [ends[-1] + 1 if len(ends) else -1]})

    return run


def counts(spark: SparkSession, path: str, eod: int = EOD, dtype: np.dtype = WIDTH, block: int = BLOCK) -> DataFrame:
    """(file, doc_no, start, n_tokens) of every document of the token files below ``path``.

    start is the document's first id; the end-of-document id is not counted.
    Ids after the last end are a document too, with no end; an empty file has none.
    """
    listed = blocks(spark, path, block, dtype.itemsize)
    listed = listed.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1), "file", "block")
    found = stored(listed.mapInPandas(_searched(path, eod, dtype, False), "file string, block long, start long, stop long, found long, end long"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    scan = found.select(
        "file", "block", "start", "stop", F.coalesce(F.sum("found").over(before), F.lit(0)).alias("before"),
        F.greatest(F.coalesce(F.max("end").over(before), F.lit(0)), F.lit(0)).alias("open"),
        F.lead("block").over(Window.partitionBy("file").orderBy("block")).isNull().alias("last"),
    )
    scan = scan.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1), "file", "block")
    return scan.mapInPandas(_searched(path, eod, dtype, True), "file string, doc_no long, start long, n_tokens long")


def document_counts(docs: DataFrame, id_col: str, text_col: str, vocabulary: str = VOCABULARY, block: int = BLOCK) -> DataFrame:
    """(id_col, n_tokens long, file, doc_no) of every row of ``docs``, by way of flat token files.

    Texts are tokenised whole, written to flat files in the shared folder and
    counted there. Null and empty texts have no tokens; rows may repeat; an empty
    table gives no rows; other columns are not read.
    """
    path = f"{scratch_dir(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    placed = write_files(docs, id_col, text_col, path, vocabulary)
    found = counts(docs.sparkSession, path, block=block)
    # both sides have a row for each document: neither is broadcast
    return placed.join(found.hint("merge"), ["file", "doc_no"]).select(F.col("doc").alias(id_col), "n_tokens", "file", "doc_no")
