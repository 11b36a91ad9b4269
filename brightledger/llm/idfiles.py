"""Token ids in binary files with keyed access through minimal perfect hashing.

A folder holds

* ``ids/<shard>.bin``: the raw ids of consecutive documents, little-endian and unsigned, of 16
  bits if all ids of the vocabulary fit and of 32 otherwise, nothing between them;
* ``shards/``: a Parquet table (shard, first_id, n_ids): how many ids lie before a shard;
* ``index/<bucket>.npz``: a minimal perfect hash over the document keys of a hash bucket and,
  at each key's number, its fingerprint, shard, offset in ids and length.

A key is a document id and the number of the copy (0 for the first row with that id, in file
order), so repeated ids stay reachable. Looking a key up hashes it once to a bucket and then
level by level to a bit (under two levels on average); the number of bits set before it is
the key's number. A key that was never stored fails the 32-bit fingerprint, except by chance.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from brightledger.llm.common import fresh_folder
from brightledger.llm.files import NewFile, load_arrays, opened, save_arrays
from brightledger.llm.ids import encoder
from brightledger.llm.shingles import mixed

END_ID = 2
SHARD_BYTES = 8 << 20  # of text
BUCKET_KEYS = 1 << 16
GAMMA = 2.0

def key_hash(keys: pa.Table | pa.RecordBatch) -> np.ndarray:
    """One 64-bit hash of doc_id (which may be null) and copy."""
    doc_id, copy = keys.column("doc_id"), keys.column("copy").to_numpy().astype(np.uint64)
    flags = copy * np.uint64(2) + doc_id.is_null().to_numpy(zero_copy_only=False).astype(np.uint64)
    return mixed(mixed(flags, 1) ^ doc_id.fill_null(0).to_numpy().astype(np.uint64), 2)


def bucketed(keys: DataFrame, buckets: int) -> DataFrame:
    """The rows with the hash bucket of their (doc_id, copy)."""

    def to_bucket(batches):
        for batch in batches:
            bucket = (key_hash(batch) % np.uint64(buckets)).astype("int32")
            yield batch.append_column("bucket", pa.array(bucket))

    return keys.mapInArrow(to_bucket, f"{_ddl(keys)}, bucket int")


class PerfectHash:
    """Numbers distinct 64-bit keys 0..n-1. Each level has ``gamma`` bits per key that is
    left; keys alone on their bit are settled there, the others go to the next level."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.before = [np.concatenate([[0], np.cumsum(bits, dtype=np.int64)]) for bits in levels]
        self.base = np.concatenate([[0], np.cumsum([b[-1] for b in self.before], dtype=np.int64)])

    @classmethod
    def over(cls, keys: np.ndarray, gamma: float = GAMMA) -> "PerfectHash":
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two document keys have the same 64-bit hash")
        levels = []
        while len(keys):
            width = max(1, int(gamma * len(keys)))
            at = mixed(keys, 100 + len(levels)) % np.uint64(width)
            alone = np.bincount(at.astype(np.int64), minlength=width) == 1
            levels.append(alone)
            keys = keys[~alone[at.astype(np.int64)]]
        return cls(levels)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; -1 where no bit is set for it."""
        found, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for n, bits in enumerate(self.levels):
            at = (mixed(keys[left], 100 + n) % np.uint64(len(bits))).astype(np.int64)
            here = bits[at]
            found[left[here]] = self.base[n] + self.before[n][at[here]]
            left = left[~here]
        return found

    def packed(self) -> dict[str, np.ndarray]:
        sizes = np.array([len(bits) for bits in self.levels], np.int64)
        return {"sizes": sizes, "bits": np.packbits(np.concatenate([*self.levels, np.zeros(0, bool)]))}

    @classmethod
    def unpacked(cls, stored) -> "PerfectHash":
        sizes = stored["sizes"]
        bits = np.unpackbits(stored["bits"], count=int(sizes.sum())).astype(bool)
        return cls(np.split(bits, np.cumsum(sizes)[:-1]) if len(sizes) else [])


_PLACES_DDL = "doc_id long, copy long, shard int, offset long, length long"
_PLACES = pa.schema(
    [("doc_id", pa.int64()), ("copy", pa.int64()), ("shard", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())]
)


@dataclass(frozen=True)
class IdFiles:
    spark: SparkSession
    folder: str
    buckets: int
    kind: str  # of an id: <u2 or <u4

    def shards(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/shards")

    def located(self, keys: DataFrame) -> DataFrame:
        """Looks (doc_id, copy) up in the index: doc_id, copy, shard, offset, length. Keys
        that were never stored have no row."""
        folder = self.folder

        def look_up(bucket: tuple, table: pa.Table) -> pa.Table:
            stored = index_bucket(folder, bucket[0].as_py())
            if stored is None:
                return _PLACES.empty_table()
            table = table.combine_chunks()
            hashes = key_hash(table)
            at = stored["hash"].numbers(hashes)
            right = (at >= 0) & (stored["print"][at] == fingerprint(hashes))
            table, at = table.filter(pa.array(right)), at[right]
            return pa.table([table["doc_id"], table["copy"], *[stored[name][at] for name in ("shard", "offset", "length")]], schema=_PLACES)

        return bucketed(keys.select("doc_id", "copy"), self.buckets).groupBy("bucket").applyInArrow(look_up, _PLACES_DDL)

    def payload(self, places: DataFrame, digest) -> DataFrame:
        """``digest`` (an array of ids to a whole number) of the ids at each (shard, offset,
        length), read in file order, with the columns of ``places``."""
        kind = np.dtype(self.kind)
        folder, schema = self.folder, f"{_ddl(places)}, digest long"

        def read(batches):
            files, path = opened(f"{folder}/ids")
            shard, file = None, None
            for batch in batches:
                found = []
                for at, offset, length in zip(*[batch.column(name).to_pylist() for name in ("shard", "offset", "length")]):
                    if at != shard:
                        if file is not None:
                            file.close()
                        shard, file = at, files.open_input_file(f"{path}/{at}.bin")
                    file.seek(kind.itemsize * offset)
                    ids = np.frombuffer(file.read(kind.itemsize * length), kind)
                    if len(ids) != length:
                        raise ValueError(f"shard {at} ends before {offset + length} ids")
                    found.append(digest(ids))
                yield batch.append_column("digest", pa.array(found, pa.int64()))
            if file is not None:
                file.close()

        ordered = places.repartition("shard").sortWithinPartitions("shard", "offset")
        return ordered.mapInArrow(read, schema)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in df.dtypes)


def fingerprint(hashes: np.ndarray) -> np.ndarray:
    return (mixed(hashes, 3) >> np.uint64(32)).astype(np.uint32)


@lru_cache(maxsize=4)
def index_bucket(folder: str, bucket: int) -> dict | None:
    stored = load_arrays(f"{folder}/index", f"{bucket}.npz")
    return stored and stored | {"hash": PerfectHash.unpacked(stored)}


def write_id_files(
    documents: DataFrame, tokenizer: str, end_id: int = END_ID, shard_bytes: int = SHARD_BYTES, bucket_keys: int = BUCKET_KEYS
) -> tuple[IdFiles, DataFrame]:
    """Encodes whole documents (doc_id, text), each with ``end_id`` appended, into files in
    ascending doc_id order and indexes every document.

    Returns the files and their keys (doc_id, copy). Null texts are empty and so have the
    end id alone; a null doc_id sorts first and is a key like any other; rows with one doc_id
    are told apart as copies, in the order of a hash of their text; other columns are
    ignored; an empty table gives no shard. Texts of any length lie in one shard.

    Range partitions of (doc_id, hash of text) are the shards, so neither a repeated id nor
    a hot source fills one. A task sorts its range, encodes document by document and streams
    the ids to its file; only (shard, offset, length) rows go on. Index buckets hold a
    bounded number of keys, as the count of all rows says.
    """
    spark = documents.sparkSession
    folder = fresh_folder(spark, "token-ids")
    kind = "<u2" if max(end_id + 1, encoder(tokenizer).tokenizer.get_vocab_size()) <= 1 << 16 else "<u4"
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    total, rows = documents.agg(F.coalesce(F.sum(size), F.lit(0)), F.count("*")).first()
    shards, buckets = max(1, -(-total // shard_bytes)), max(1, -(-rows // bucket_keys))

    def write(batches):
        file = shard = None
        offset = 0
        for batch in batches:
            if shard is None and batch.num_rows:
                shard = batch.column("shard")[0].as_py()
                file = NewFile(f"{folder}/ids", f"{shard}.bin")
            lengths = []
            for text in batch.column("text"):
                ids = encoder(tokenizer).encode(text.as_py(), end_id)
                file.out.write(ids.astype(kind).tobytes())
                lengths.append(len(ids))
            ends = offset + np.cumsum(lengths, dtype=np.int64)
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "shard": batch.column("shard"), "offset": ends - lengths, "length": np.array(lengths, "int64")}
            )
            offset = int(ends[-1]) if len(ends) else offset
        encoder(tokenizer).forget()
        if file is not None:
            file.close()

    ranged = (
        documents.select("doc_id", "text", F.xxhash64("text").alias("tie"))
        .repartitionByRange(shards, "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text", F.spark_partition_id().alias("shard"))
    )
    ranged.mapInArrow(write, "doc_id long, shard int, offset long, length long").write.parquet(f"{folder}/written")
    written = spark.read.parquet(f"{folder}/written")

    per_shard = written.groupBy("shard").agg(F.sum("length").alias("n_ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    per_shard.select("shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("first_id"), "n_ids").write.parquet(f"{folder}/shards")

    copy = F.row_number().over(Window.partitionBy("doc_id").orderBy("shard", "offset")) - 1
    entries = written.withColumn("copy", copy.cast("long"))

    def index(bucket: tuple, table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        hashes = key_hash(table)
        made = PerfectHash.over(hashes)
        at = np.empty(len(hashes), np.int64)
        at[made.numbers(hashes)] = np.arange(len(hashes))
        columns = {name: table[name].to_numpy()[at] for name in ("shard", "offset", "length")}
        save_arrays(f"{folder}/index", f"{bucket[0].as_py()}.npz", **made.packed(), **columns, print=fingerprint(hashes)[at])
        return table.select(["doc_id", "copy"])

    keys = bucketed(entries, buckets).groupBy("bucket").applyInArrow(index, "doc_id long, copy long")
    keys.write.parquet(f"{folder}/keys")
    return IdFiles(spark, folder, buckets, kind), spark.read.parquet(f"{folder}/keys")


def ids_crc32(ids: np.ndarray) -> int:
    """crc32 of the ids as little-endian unsigned 32-bit integers."""
    return crc32(ids.astype("<u4").tobytes())
