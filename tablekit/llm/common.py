"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.session import shared_dir

#: ASCII white space, as in [\x20\x09-\x0D].
WS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared checkpoint folder and read
    back: what builds on it is not computed again, and a lost executor costs
    only its own tasks. The folder goes when the application ends."""
    spark = df.sparkSession
    path = shared_dir(spark, "llm", name, unique=True)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(c, UPPER, UPPER.lower())


def text_hash(c: Column) -> Column:
    """64-bit hash of a text, null as the empty text: with doc_id it tells rows
    that share an id but not a text apart."""
    return F.xxhash64(F.coalesce(c, F.lit("")))


def packed(docs: DataFrame) -> DataFrame:
    """doc_id, text and all other columns in one struct ``rest``, so that an
    operator's own column names never clash with the caller's."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", (F.struct(*rest) if rest else F.lit(0)).alias("rest"))


def unpacked(done: DataFrame, columns: list[str], **more: Column) -> DataFrame:
    """The caller's columns again, in their order, then ``more``."""
    own = [F.col(c) if c in ("doc_id", "text") else F.col(f"rest.`{c}`").alias(c) for c in columns]
    return done.select(*own, *[c.alias(name) for name, c in more.items()])


def unused(name: str, columns: list[str]) -> str:
    """``name``, with more underscores in front while the caller has such a column."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8 (bytes.split() cuts at exactly
    these bytes, which never occur inside a longer UTF-8 sequence)."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


_STEP = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)
_MEMO_LIMIT = 500_000


class WordHashes(dict):
    """63-bit hash of each word, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > _MEMO_LIMIT:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word) >> 1
        return h

    def of(self, ws: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, ws), dtype=np.int64, count=len(ws)).view(np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit integers (wraps around)."""
    x = (x ^ (x >> _SHIFT)) * _STEP
    return x ^ (x >> _SHIFT)


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """One hash for every window of ``size`` consecutive hashes."""
    n = len(h) - size + 1
    if n < 1:
        return h[:0]
    key = mix(h[:n])
    for j in range(1, size):
        key = mix(key * _STEP + h[j:j + n])
    return key


#: Rows of a few numbers each (under 100 bytes) that may be broadcast: 10 MB.
BROADCAST_ROWS = 100_000


def join_few(big: DataFrame, few: DataFrame, on: list[str], rows: int) -> DataFrame:
    """Inner join of wide rows with ``rows`` narrow ones: without moving the
    wide ones if the narrow side is small, else a shuffled hash join."""
    return big.join(F.broadcast(few) if rows <= BROADCAST_ROWS else few.hint("shuffle_hash"), on)


#: Table of CRC-32 (reflected polynomial EDB88320) for half bytes: fixed values.
CRC_HALVES = [
    0x00000000, 0x1DB71064, 0x3B6E20C8, 0x26D930AC, 0x76DC4190, 0x6B6B51F4, 0x4DB26158, 0x5005713C,
    0xEDB88320, 0xF00F9344, 0xD6D6A3E8, 0xCB61B38C, 0x9B64C2B0, 0x86D3D2D4, 0xA00AE278, 0xBDBDF21C,
]


def crc32_sql(text: str) -> str:
    """DuckDB expression: unsigned CRC-32 of the UTF-8 bytes of ``text``, by half bytes, low ones first."""
    halves = f"string_split(regexp_replace(hex(encode({text})), '(.)(.)', '\\2\\1', 'g'), '')"
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, [CAST('0x' || x AS BIGINT) FOR x IN {halves}"
            f" IF x <> '']), lambda crc, x: xor(list_extract({CRC_HALVES}::BIGINT[], CAST(1 + (xor(crc, x) & 15) AS INTEGER)),"
            " crc >> 4)))")
