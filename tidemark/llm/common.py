"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Rows in one Arrow batch; long texts make the default of 10,000 rows too large for a worker.
BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; where it is unset a temporary folder, in local mode only: elsewhere the machines would not share it."""
    global _temporary
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        _temporary = _temporary or tempfile.mkdtemp(prefix="tidemark-")
    return named or _temporary


_temporary: str | None = None


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written as a table to the shared folder and read again: its lineage is cut, and it survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tidemark-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def released(spark: SparkSession, *tables: DataFrame) -> None:
    """Deletes checkpointed tables whose readers have all been written, and lets the driver drop the shuffles of finished steps."""
    jvm = spark.sparkContext._jvm
    for df in tables:
        for file in df.inputFiles()[:1]:
            folder = jvm.org.apache.hadoop.fs.Path(file).getParent()
            if folder.getName().startswith("tidemark-"):
                folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
    # the session keeps the plan that ran last, with its shuffles, until another has run
    spark.range(1).collect()
    gc.collect()
    jvm.System.gc()


def unheld(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is never broadcast: tables that grow with the documents would be built in the driver, several at once."""
    return df.hint("merge")


def fresh(name: str, *taken: str) -> str:
    """``name``, with underscores in front until no column of ``taken`` has it (case doesn't count)."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name = "_" + name
    return name


def remainder(key: str, modulus: int) -> Column:
    """``crc32(key as text) mod modulus``; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % modulus


def annotate(
    df: DataFrame,
    added: dict[str, T.DataType],
    make: Callable[[], Callable[[list], Iterable]],
    text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """``df`` with columns computed from ``text`` in Arrow batches.

    ``make()`` runs once a task and returns ``f(texts) -> columns`` in the order
    of ``added``. ``keep`` names the input columns that stay (default: all);
    an input column that has the name of an added one is replaced.
    """
    kept = [c for c in (df.columns if keep is None else keep) if c not in added]
    read = kept if text in kept else [*kept, text]
    fields = [df.schema[c] for c in kept] + [T.StructField(k, t) for k, t in added.items()]
    kinds = [to_arrow_type(t) for t in added.values()]
    names, at = [f.name for f in fields], read.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for b in batches:
            for lo in range(0, b.num_rows, BATCH_ROWS):
                part = b.slice(lo, BATCH_ROWS)
                new = [pa.array(c, k) for c, k in zip(f(part.column(at).to_pylist()), kinds)]
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(len(kept))] + new, names=names)

    return df.select(*read).mapInArrow(run, T.StructType(fields))


def vocabulary_path(name: str) -> str:
    """Where the public vocabulary file ``name`` lies; callers may pass another path."""
    import public_tokenizers

    return str(public_tokenizers.path(name))
