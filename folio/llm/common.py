"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.session import ensure_checkpoint_dir, ship_package, shuffles_dropped

WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True


def prepare(spark: SparkSession, batch_rows: int = 1024) -> None:
    """Ship the package to the workers, set the checkpoint folder and keep Arrow
    batches small, so that a batch of very long texts stays bounded."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch_rows))


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: checkpoint() into the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage with a compressed table in the shared checkpoint folder. These tables stay until the folder is
    cleaned, so they are written with the denser codec."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words_of(text: str | bytes | None) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ of the text, A-Z lower-cased, as UTF-8 bytes."""
    if not text:
        return []
    return (text.encode() if isinstance(text, str) else text).lower().split()


def text_bytes(column) -> list[bytes]:
    """UTF-8 bytes of each value of an Arrow string column; null counts as empty."""
    return [x or b"" for x in column.cast("binary").to_pylist()]


def digest_key(col: str):
    """A key of a text, null included."""
    return F.xxhash64(F.coalesce(F.col(col), F.lit("\0")))


def pack(docs: DataFrame, **keys) -> DataFrame:
    """The row as one struct ``row`` beside the keys, so that no column of docs can clash with a key."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[k.alias(n) for n, k in keys.items()])


def unpack(rows: DataFrame, columns: list[str], **new) -> DataFrame:
    """The columns of docs again; ``new`` replaces columns of the same name or is added."""
    named = {n.lower(): (n, e) for n, e in new.items()}
    here = [named[c.lower()][1].alias(c) if c.lower() in named else F.col("row").getField(c).alias(c) for c in columns]
    rest = [e.alias(n) for low, (n, e) in named.items() if low not in {c.lower() for c in columns}]
    return rows.select(*here, *rest)


def union_min(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of a[i] and b[i] in place; label[x] ends as the least member of x's set."""
    while len(a):
        ra, rb = label[a], label[b]
        apart = ra != rb
        if not apart.any():
            return
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(label, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of edges (u long, v long): rows (node, root), root the
    least node of the component. Alternating large-star and small-star rounds;
    every round only groups and joins, so a hub's links are never held together."""
    e = cut(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        e = cut(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        state = now
    raise RuntimeError("components did not settle")
