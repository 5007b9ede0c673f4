"""Parquet layers: partitioned writes, guarded reads, table registration and
materialized views.

Row counts are taken with an ``Observation`` on the write itself, so a table
is evaluated once (not once for the write and again for a ``count()``).
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def write_table(df: DataFrame, path: str, partition_cols: list[str] | None = None,
                replace: str | None = None, rebalance: bool = True) -> int:
    """Overwrite a Parquet table. Returns the number of rows written.

    The whole table is replaced, or with ``replace`` (the first partition
    column) all of its partitions whose value occurs in ``df``, e.g. a whole
    quarter: written partitions are swapped in, then those of the same
    quarters that this load no longer holds are dropped.

    A partitioned write is preceded by a REBALANCE on the partition columns:
    without it every task writes one file per partition value it holds
    (tasks x states small files at scale); a plain repartition by state would
    put a hot state into one task. REBALANCE lets AQE cut each partition
    value into advisory-size pieces, so files are few, even-sized, and a state
    holding a third of the rows is spread over many writers."""
    if partition_cols and rebalance:
        df = df.hint("rebalance", *partition_cols)
    obs = Observation(f"write:{path}")
    seen = F.collect_set(F.struct(*[F.col(c).cast("string") for c in partition_cols or []])) if replace else F.lit(None)
    # one entry per partition written (quarters x states): bounded by the folder count
    out = df.observe(obs, F.count(F.lit(1)).alias("rows"), *([seen.alias("seen")] if replace else []))
    w = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if replace else "static")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)
    got = obs.get
    if replace:
        _drop_stale(df.sparkSession, path, partition_cols, [tuple(r) for r in got.get("seen") or []])
    return int(got.get("rows", 0))


def _drop_stale(spark: SparkSession, path: str, cols: list[str], written: list[tuple]) -> None:
    """Delete partition folders that share their first value with a written one but were not written."""
    if len(cols) < 2:
        return
    jvm = spark.sparkContext._jvm
    default = "__HIVE_DEFAULT_PARTITION__"
    name = lambda v: default if v in (None, "") else str(v)
    keep = {tuple(name(v) for v in t[:2]) for t in written}
    firsts = {t[0] for t in keep}
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    unescape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName

    def folders(at, col: str):
        for st in fs.listStatus(at):
            folder = st.getPath().getName()
            if st.isDirectory() and folder.startswith(f"{col}="):
                yield st.getPath(), unescape(folder.split("=", 1)[1])

    for at, first in folders(root, cols[0]):
        if first in firsts:
            for sub, second in folders(at, cols[1]):
                if (first, second) not in keep:
                    fs.delete(sub, True)


def write_silver(df: DataFrame, path: str) -> int:
    return write_table(df, path, ["cy_qtr", "state"], replace="cy_qtr")


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    if df.isEmpty():
        raise ValueError(f"No records in {path}")
    return df


def register_tables(spark: SparkSession, gold_dir: str, tables: dict[str, str]) -> list[str]:
    """Expose gold folders as temp views (the fact under both of its names)."""
    names = []
    for name, rel in tables.items():
        spark.read.parquet(f"{gold_dir.rstrip('/')}/{rel}").createOrReplaceTempView(name)
        names.append(name)
    if "facts" in tables:
        spark.table("facts").createOrReplaceTempView("fact_daily_staffing")
        names.append("fact_daily_staffing")
    return names


def create_external_tables(spark: SparkSession, database: str, base: str, tables: dict[str, str]) -> list[str]:
    """Catalog tables over stored Parquet folders: any session of the same catalog reads them by name.

    The schema comes from the files and the partition columns from the folders' names; partitions are listed in the
    catalog, so a filter on them is answered there. ``recover_partitions`` adds the folders of later loads."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    names = []
    for name, rel in tables.items():
        path = f"{base.rstrip('/')}/{rel}"
        if not path_exists(spark, path):
            continue
        parts = partition_columns(spark, path)
        fields = {f.name: f for f in spark.read.parquet(path).schema.fields}
        order = [f for n, f in fields.items() if n not in parts] + [fields[p] for p in parts]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in order)
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")  # the table only: the files are external
        where = path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE `{database}`.`{name}` ({columns}) USING parquet "
                  + (f"PARTITIONED BY ({', '.join(f'`{p}`' for p in parts)}) " if parts else "") + f"LOCATION '{where}'")
        if parts:
            recover_partitions(spark, f"`{database}`.`{name}`")
        names.append(f"{database}.{name}")
    return names


def recover_partitions(spark: SparkSession, table: str) -> None:
    """List the partition folders that the catalog does not know yet, and forget those that are gone."""
    spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """The ``column=value`` levels of a stored table, from the first folder of each level."""
    fs, at = _file_system(spark, path)
    out = []
    while True:
        below = [st.getPath() for st in fs.listStatus(at) if st.isDirectory() and "=" in st.getPath().getName()]
        if not below:
            return out
        out.append(below[0].getName().split("=", 1)[0])
        at = below[0]


def to_serving(df: DataFrame) -> DataFrame:
    """Decimals as doubles for the consumer."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType)
                       else F.col(f.name) for f in df.schema.fields])


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


class RefreshConflict(RuntimeError):
    """Another refresh of the same view was committed in the meantime."""


class MaterializedView:
    """A stored query result with versions.

    A refresh writes ``version=<number>-<id>`` and then commits it: a file named by the number, holding the folder's
    name, is renamed into ``_log``. The rename fails if that number is taken, so of two refreshes that start from the
    same version one wins and the other raises ``RefreshConflict``; a refresh that is killed leaves a folder that nobody
    reads. Numbers, not clocks, order the versions. Readers take the newest committed one."""

    def __init__(self, spark: SparkSession, path: str, definition, keep_versions: int = 2):
        self.spark, self.path, self.definition = spark, path.rstrip("/"), definition
        self.keep_versions = keep_versions

    def _log(self) -> list[tuple[int, str]]:
        """(number, folder name after ``version=``) of all committed versions, oldest first."""
        fs, p = _file_system(self.spark, f"{self.path}/_log")
        if not fs.exists(p):
            return []
        out = []
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if name.isdigit():
                stream = fs.open(st.getPath())
                try:
                    out.append((int(name), self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
                finally:
                    stream.close()
        return sorted(out)

    def versions(self) -> list[str]:
        return [v for _, v in self._log()]

    def refresh(self) -> int:
        log = self._log()
        number = log[-1][0] + 1 if log else 1
        version = f"{number:015d}-{uuid.uuid4().hex[:8]}"
        rows = write_table(self.definition(), f"{self.path}/version={version}")
        self._commit(number, version)
        self.prune()
        return rows

    def _commit(self, number: int, version: str) -> None:
        jvm = self.spark.sparkContext._jvm
        fs, entry = _file_system(self.spark, f"{self.path}/_log/{number:015d}")
        fs.mkdirs(entry.getParent())
        draft = jvm.org.apache.hadoop.fs.Path(entry.getParent(), f"draft-{version}")
        stream = fs.create(draft, True)
        stream.write(bytearray(version.encode()))
        stream.close()
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        how = self.spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.NONE  # do not replace
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            fs.makeQualified(entry).toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        try:
            files.rename(fs.makeQualified(draft), fs.makeQualified(entry), how)
        except Py4JJavaError as e:
            fs.delete(draft, False)
            if "FileAlreadyExistsException" not in str(e.java_exception):
                raise
            delete_path(self.spark, f"{self.path}/version={version}")
            raise RefreshConflict(f"version {number} of {self.path} was committed by another refresh") from e

    def prune(self) -> list[str]:
        """Drop versions older than the newest ``keep_versions`` (the previous one stays for readers that
        started before the refresh), and what killed refreshes with an older number left behind."""
        log = self._log()
        old = log[:-self.keep_versions] if self.keep_versions > 0 else []
        for number, version in old:
            delete_path(self.spark, f"{self.path}/_log/{number:015d}")
            delete_path(self.spark, f"{self.path}/version={version}")
        kept = {v for _, v in log}
        fs, p = _file_system(self.spark, self.path)
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if name.startswith("version=") and name[8:] not in kept:
                if name[8:23].isdigit() and log and int(name[8:23]) <= log[-1][0]:
                    fs.delete(st.getPath(), True)
        return [v for _, v in old]

    def read(self) -> DataFrame:
        vs = self.versions()
        if not vs:
            self.refresh()
            vs = self.versions()
        return self.spark.read.parquet(f"{self.path}/version={vs[-1]}")


def materialize(spark: SparkSession, path: str, definition) -> DataFrame:
    mv = MaterializedView(spark, path, definition)
    mv.refresh()
    return mv.read()
