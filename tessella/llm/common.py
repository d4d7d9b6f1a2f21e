"""Helpers that several operators share: intermediate tables, learned splits, batches of texts."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tessella.runtime import checkpoint_dir

#: removes the shuffle files of a query as soon as it has ended
_CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: [#*$%&|<>], \n and the ASCII white space that separates words: fixed values of the contracts.
WORD_SPACE = " \t\n\x0b\x0c\r"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once as Parquet into the shared folder and read it back.

    Lineage ends there, so nothing upstream runs twice and a lost executor costs only the tasks
    that it ran. The folder is the one the session names in ``spark.checkpoint.dir``; tables stay
    until the folder is cleared, or until ``forget`` is called on them. The shuffle files of the
    write go once it has ended, as nothing can read them again.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEAN_SHUFFLES)
    spark.conf.set(_CLEAN_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN_SHUFFLES, before)
    made = spark.read.schema(df.schema).parquet(path)
    made._tessella_path = path
    return made


def forget(df: DataFrame) -> None:
    """Delete a table that ``materialize`` made, once nothing reads it any more."""
    path = getattr(df, "_tessella_path", None)
    if path is not None:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """The name, with underscores in front until no column of the frame has it."""
    while name in df.columns:
        name = "_" + name
    return name


def row_of(columns: list[str]) -> Column:
    """The columns as one struct, so that their names can't clash with any others."""
    return F.struct(*[F.col(f"`{c}`") for c in columns])


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; -1 for rows without an id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts)),
                      F.lit(-1)).cast("int")


def sample_share(rows: int, bound: int) -> float:
    """Share of rows to keep so that about ``bound`` of them stay; 1 when there are no more."""
    return 1.0 if rows <= bound else bound / rows


def in_sample(key: Column, share: float) -> Column:
    """Whether a row belongs to the sample of that share; decided by its key alone."""
    if share >= 1.0:
        return F.lit(True)
    return F.pmod(F.xxhash64(key), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))


_TABLE: dict[tuple, object] = {}


def worker_table(make, *args):
    """What ``make(*args)`` gives, kept by this Python worker; the table of another operator goes first.

    Workers serve one stage after the other, so tables of earlier stages would add up.
    """
    if (make, args) not in _TABLE:
        _TABLE.clear()
        _TABLE[make, args] = make(*args)
    return _TABLE[make, args]


def drop_tables() -> None:
    """Free what this Python worker keeps for other operators."""
    _TABLE.clear()


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def text_groups(texts: list[str | None], budget: int = 1 << 20) -> Iterator[tuple[int, list[str]]]:
    """Consecutive runs of texts with at most ``budget`` characters (or one longer text) each."""
    start, group, size = 0, [], 0
    for i, text in enumerate(texts):
        text = text or ""
        if group and size + len(text) > budget:
            yield start, group
            start, group, size = i, [], 0
        group.append(text)
        size += len(text)
    if group:
        yield start, group


def struct_array(fields: dict[str, tuple[object, pa.DataType]]) -> pa.StructArray:
    arrays = [pa.array(values, kind) for values, kind in fields.values()]
    return pa.StructArray.from_arrays(arrays, list(fields))


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser: spreads every input bit over the word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
