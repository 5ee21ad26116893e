"""What several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A word: a run of anything but space, tab, newline, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str) -> Column:
    """The text, where null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z alone. Texts of one byte a character take the faster built-in, which does the same for them."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def remainder(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, mod n; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % n


#: A side of a join is broadcast only where its counted rows are known to take no more than this.
BROADCAST_BYTES = 8 << 20
#: Rows of an Arrow batch. Spark's 10,000 would hold 20 MB of usual texts and hundreds of long ones, several times over.
BATCH_ROWS = 1000


def broadcast_if_small(side: DataFrame, row_bytes: int) -> DataFrame:
    """``side`` with a hint to broadcast it, if its rows of ``row_bytes`` at most fit into ``BROADCAST_BYTES``.

    It is counted here, so it should be a written table or cheap. Otherwise it is joined by a shuffle.
    """
    return F.broadcast(side) if side.count() * row_bytes <= BROADCAST_BYTES else side


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, once its session hands texts to Python in batches of at most ``BATCH_ROWS`` rows (a smaller setting stays)."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(name)) <= BATCH_ROWS:
        df.sparkSession.conf.set(name, str(BATCH_ROWS))
    return df


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less the columns whose names an operator's own output takes (case aside)."""
    taken = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken])
