"""What the operators of this subpackage share: table access, staging, folding."""

from __future__ import annotations

import atexit
import re
import tempfile
import unicodedata
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Give a scan of few files as many partitions as the cluster has cores.

    Only inputs smaller than one split per core are moved; a large input
    already has more splits than cores and stays where it is.
    """
    want = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df


def shared_dir(spark: SparkSession) -> str:
    """The cluster's folder for tables that cut lineage (spark.checkpoint.dir).

    Where the session names none a folder of our own is set, but only if driver
    and executors are one process; a cluster must name the folder it shares.
    """
    for key in ("spark.checkpoint.dir", "spark.quire.checkpoint.dir"):
        if found := spark.conf.get(key, None):
            return found
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    found = tempfile.mkdtemp(prefix="quire-")
    spark.conf.set("spark.quire.checkpoint.dir", found)
    return found


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back.

    Unlike a checkpoint of the RDD this computes the plan once, keeps column
    pruning for the readers, and outlives lost executors.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quire-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


#: A filter of hashes has so many bits at most, and so many a hash if that is less.
FILTER_BITS, BITS_A_HASH = 1 << 25, 16


def hash_filter(hashes: DataFrame) -> np.ndarray:
    """Bits, as 64-bit words, of which one is set for each hash (the only column): FILTER_BITS at most."""
    (name,) = hashes.columns
    hashes = staged(hashes, "hashes")
    bits = min(FILTER_BITS, 1 << max(10, (hashes.count() * BITS_A_HASH).bit_length()))
    at = F.col(name).bitwiseAND(F.lit(bits - 1))
    words = hashes.select(at.alias("at")).select(F.shiftright("at", 6).alias("word"), F.expr("shiftleft(1L, int(at & 63))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()  # bits / 64 rows
    out = np.zeros(bits // 64, np.int64)
    out[words["word"].to_numpy(int)] = words["bits"].to_numpy(np.int64)
    return out


def passing(rows: DataFrame, hashes: str, bits: np.ndarray) -> DataFrame:
    """Rows of which a hash of the array column ``hashes`` is in the filter: all that belong, and some by chance.

    The column itself goes no further.
    """
    known = rows.sparkSession.sparkContext.broadcast(bits)  # FILTER_BITS at most
    kept = [c for c in rows.columns if c != hashes]
    at = rows.columns.index(hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = known.value
        for batch in batches:
            lists = batch.column(at)
            size = np.asarray(lists.value_lengths().fill_null(0))
            own = np.repeat(np.arange(len(size)), size)
            h = np.asarray(lists.flatten()) & (len(words) * 64 - 1)
            some = np.bincount(own[((words[h >> 6] >> (h & 63)) & 1) == 1], minlength=len(size)) > 0
            yield batch.select(kept).filter(pa.array(some))

    return rows.mapInArrow(run, rows.select(*kept).schema)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # noqa: BLE001 - the session may be gone already
        pass


# Characters that look like a Latin one.
LOOKALIKE_FROM = "аеорсухѕіјАВЕІЈКМНОРСТУХЅοαινρϲυΑΒΕΖΗΙΚΜΝΟΡΤΥΧ"
LOOKALIKE_TO = "aeopcyxsijABEIJKMHOPCTYXSoaivpcuABEZHIKMNOPTYX"
# Characters without a visible form.
INVISIBLE = "­​‌‍‎‏⁠⁡⁢⁣﻿"
# Blanks of other widths, and hyphens of other kinds.
BLANKS = "               　"
HYPHENS = "‐‑﹣－"
# Ligatures and compatibility numerals.
LIGATURES = {
    "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st",
    "Ⅰ": "I", "Ⅱ": "II", "Ⅲ": "III", "Ⅳ": "IV", "Ⅴ": "V", "Ⅵ": "VI", "Ⅶ": "VII",
    "Ⅷ": "VIII", "Ⅸ": "IX", "Ⅹ": "X", "Ⅺ": "XI", "Ⅻ": "XII", "…": "...",
    "ĳ": "ij", "Ĳ": "IJ", "ŉ": "'n", "ǆ": "dž", "ǉ": "lj", "ǌ": "nj",
}


def letter_table() -> np.ndarray:
    """For each BMP code point the folded letter it counts as, or 0.

    Letters of the categories L and M remain, in lower case, full-width and
    look-alike forms as the Latin letter; everything else counts as 0.
    """
    out = np.zeros(0x10000, dtype=np.uint32)
    alike = dict(zip(LOOKALIKE_FROM, LOOKALIKE_TO, strict=True))
    for cp in range(0x10000):
        if 0xD800 <= cp < 0xE000:
            continue
        ch = chr(cp)
        if 0xFF01 <= cp <= 0xFF5E:
            ch = chr(cp - 0xFEE0)
        ch = alike.get(ch, ch)
        low = ch.lower()
        low = low if len(low) == 1 else ch
        low = alike.get(low, low)
        if unicodedata.category(low)[0] in "LM":
            out[cp] = ord(low)
    return out


_LETTERS: np.ndarray | None = None


def letters() -> np.ndarray:
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = letter_table()
    return _LETTERS


def fold_letters(cp: np.ndarray) -> np.ndarray:
    """For each code point the folded letter it counts as, or 0; beyond the BMP letters stay as they are."""
    out = letters()[np.where(cp < 0x10000, cp, 0)]
    if len(high := np.unique(cp[cp >= 0x10000])):
        for c in high.tolist():
            low = chr(c).lower()
            if unicodedata.category(low)[0] in "LM":
                out[cp == c] = ord(low)
    return out


_EXPAND = _EXPANDED = None


def expand(text: str) -> str:
    """Ligatures as their letters, accents composed; cheap for plain ASCII."""
    global _EXPAND, _EXPANDED
    if text.isascii():
        return text
    if _EXPAND is None:
        _EXPAND, _EXPANDED = str.maketrans(LIGATURES | dict.fromkeys(INVISIBLE)), re.compile("[" + "".join(LIGATURES) + INVISIBLE + "]")
    if _EXPANDED.search(text):  # few texts have any
        text = text.translate(_EXPAND)
    return unicodedata.normalize("NFC", text)
