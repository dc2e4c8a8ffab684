"""Helpers of the operators: written intermediate tables, words, 64-bit hashes."""
from __future__ import annotations

import uuid

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfin.session import ensure_checkpoint_dir

#: A word is a run of anything but blank and the five ASCII control blanks.
#: ``bytes.split()`` cuts UTF-8 at exactly these bytes.
WORD = r"[^\x20\x09-\x0D]+"


def run_folder(spark, name: str) -> str:
    """A new folder under the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: a lineage
    cut that outlives executors and lets later steps read single columns.
    The folder goes with the run's checkpoint folder."""
    spark = df.sparkSession
    path = run_folder(spark, name)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.written_path = path
    return back


def release(*tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(t.written_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def word_count(text) -> F.Column:
    """Number of words of a text column; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def held_out(doc_id) -> F.Column:
    """The rows no model may learn labels from: crc32(doc_id as text) mod 4 = 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def byte_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hash of each word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def odd_constants(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit multipliers."""
    return np.random.default_rng(seed).integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def gram_hashes(h: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Hash of every run of ``len(c)`` consecutive word hashes."""
    n = len(h) - len(c) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = h[:n] * c[0]
    for i in range(1, len(c)):
        out += h[i:i + n] * c[i]
    return mixed(out)


def text_groups(texts, limit: int = 300_000):
    """Texts of a batch in groups of about ``limit`` words: (numbers of the
    texts, their word counts, the hashes of all their words).  Array work is
    done per group, so short texts cost little and memory stays bounded."""
    numbers, counts, words = [], [], []
    for i, text in enumerate(texts):
        w = byte_words(text.as_py())
        numbers.append(i)
        counts.append(len(w))
        words += w
        if len(words) >= limit:
            yield np.array(numbers), np.array(counts), word_hashes(words)
            numbers, counts, words = [], [], []
    if numbers:
        yield np.array(numbers), np.array(counts), word_hashes(words)
