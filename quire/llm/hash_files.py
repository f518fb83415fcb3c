"""Sorted hash arrays in the shared folder, cut into buckets by the hashes' leading bits and memory-mapped.

Tasks write whole files and put them in place by a rename, so a task that runs twice leaves the same files.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm import words as W
from quire.llm.store import partitions, scratch_path


def bucket_bits(partitions: int) -> int:
    """Leading bits that give about two to four buckets per partition."""
    return max(2, (partitions * 2 - 1).bit_length())


def cut_points(keys: np.ndarray, bits: int) -> list[int]:
    """Where each bucket of sorted ``keys`` begins, and their end."""
    edges = np.searchsorted(keys, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
    return [0, *edges.tolist(), len(keys)]


def joined(column: pa.ChunkedArray, dtype: str) -> np.ndarray:
    """The values of all binary cells in a row."""
    return np.concatenate([np.zeros(0, dtype), *[np.frombuffer(x.as_buffer(), dtype) for x in column]])


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if uri.startswith("file:") or "://" in uri else f"file://{uri}")


def put(uri: str, name: str, array: np.ndarray) -> None:
    fs, root = file_system(uri)
    fs.create_dir(root, recursive=True)
    part = f"{root}/{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(part) as out:
        out.write(np.ascontiguousarray(array).tobytes())
    fs.move(part, f"{root}/{name}")


class HashFiles:
    """A worker's memory maps of the arrays below ``uri``, opened when first needed."""

    def __init__(self, uri: str, bits: int):
        self.uri, self.bits, self.open = uri, bits, {}

    def array(self, name: str, dtype: str) -> np.ndarray:
        if name not in self.open:
            fs, root = file_system(self.uri)
            info = fs.get_file_info(f"{root}/{name}")
            if info.type == pafs.FileType.NotFound or not info.size:
                self.open[name] = np.zeros(0, dtype)
            elif isinstance(fs, pafs.LocalFileSystem):
                self.open[name] = np.asarray(np.memmap(info.path, dtype, "r"))
            else:  # a copy that goes with the process
                with tempfile.NamedTemporaryFile() as copy, fs.open_input_stream(info.path) as src:
                    while block := src.read(1 << 24):
                        copy.write(block)
                    copy.flush()
                    self.open[name] = np.asarray(np.memmap(copy.name, dtype, "r"))
        return self.open[name]

    def look(self, wanted: np.ndarray, kind: str, keys: str, values: dict[str, tuple[str, object]]) -> tuple[np.ndarray, ...]:
        """For sorted ``wanted``: the named values of equal keys (or the given missing value), and which were found.

        Arrays are named ``kind-bucket-part``; ``values`` is {part: (dtype, missing)}.
        """
        out = [np.full(len(wanted), missing, dtype) for dtype, missing in values.values()]
        found = np.zeros(len(wanted), bool)
        cuts = cut_points(wanted, self.bits)
        for bucket in range(1 << self.bits):
            a, b = cuts[bucket], cuts[bucket + 1]
            have = self.array(f"{kind}-{bucket}-{keys}", "<u8") if a < b else ()
            if len(have):
                at = np.minimum(np.searchsorted(have, wanted[a:b]), len(have) - 1)
                hit = have[at] == wanted[a:b]
                found[a:b] = hit
                for o, (part, (dtype, _)) in zip(out, values.items(), strict=True):
                    o[a:b][hit] = self.array(f"{kind}-{bucket}-{part}", dtype)[at[hit]]
        return (*out, found)


def store_set(hashes: DataFrame, name: str) -> tuple[str, int]:
    """The column ``h`` of distinct 64-bit numbers as sorted arrays; their place and the bits of their buckets."""
    spark = hashes.sparkSession
    bits, uri = bucket_bits(partitions(spark)), scratch_path(spark, name)

    def note(table: pa.Table) -> pa.Table:
        put(uri, f"s-{table['bucket'][0].as_py()}-k", np.sort(table["h"].to_numpy().view(np.uint64)))
        return pa.table({"n": pa.array([table.num_rows], pa.int64())})

    cut = hashes.select("h", F.shiftrightunsigned("h", 64 - bits).cast("int").alias("bucket"))
    cut.groupBy("bucket").applyInArrow(note, "n long").agg(F.sum("n")).collect()
    return uri, bits


def rows_in(df: DataFrame, h: Column, stored: tuple[str, int], found: bool) -> DataFrame:
    """The rows of ``df`` whose ``h`` is in the stored set (or, with ``found`` false, is not), where they are read:
    no row is shuffled, however large the set is.  A null ``h`` is not in any set."""
    uri, bits = stored
    packed = df.select(F.struct("*").alias("row"), h.alias("h"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = HashFiles(uri, bits)
        for batch in batches:
            column = batch.column(1)
            known = column.is_valid().to_numpy(zero_copy_only=False)
            value, back = np.unique(column.fill_null(0).to_numpy().view(np.uint64), return_inverse=True)
            hit = files.look(value, "s", "k", {})[-1][back] & known
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(hit == found))], ["row"])

    return packed.mapInArrow(lambda it: W.released(keep(it)), T.StructType([packed.schema["row"]])).select("row.*")
