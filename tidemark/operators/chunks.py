"""Parsing by chunks of directories, each committed alone, with a ledger that a later call resumes from."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import sampling as S
from tidemark.sources import commit as M
from tidemark.sources import trees as T
from tidemark.sources import xml_files as P

#: Jobs that run at the same time: the driver puts one's chunks in place while tasks parse another's.
ABREAST = 4
LEDGER = "chunk_id string, exit_code long, started_at timestamp_ntz, finished_at timestamp_ntz, attempts long, error string"


class Incomplete(RuntimeError):
    """Chunks that failed; all others are done, and a further call parses only these."""


def digest(df: DataFrame, *columns: str) -> str:
    """A hash of the rows of ``df`` that doesn't depend on their order; one value comes to the driver."""
    return df.agg(F.sha2(F.concat_ws(":", F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64(*columns)), F.lit(0))), 256).alias("h")).first()["h"]


def ledger(spark: SparkSession, work: str) -> DataFrame:
    """The last row of each chunk."""
    if not M.exists(spark, f"{work}/ledger"):
        return spark.createDataFrame([], LEDGER)
    d = spark.read.schema(LEDGER).option("recursiveFileLookup", True).parquet(f"{work}/ledger")
    return d.groupBy("chunk_id").agg(F.max(F.struct("finished_at", *[c for c in d.columns if c not in ("chunk_id", "finished_at")])).alias("r")).select("chunk_id", "r.*").select(*d.columns)


def plan(files: DataFrame, work: str, snapshot: str, chunk_size: int) -> DataFrame:
    """directory_accession, chunk_id, number of every directory; made once, later calls get the first one's.

    An error where the directories aren't those of the first call.
    """
    spark = files.sparkSession
    own = files.select(F.element_at(F.split("path", "/"), -2).alias("directory_accession")).where("directory_accession is not null")
    if "directory_accession" in files.columns:  # a listing, which has empty directories too
        own = files.select("directory_accession")
    path, names = f"{work}/plan", f"{work}/_directories"
    own.distinct().write.mode("overwrite").parquet(names)  # read several times; the files may be costly to make
    own = spark.read.parquet(names)
    if not M.exists(spark, path):
        manifest = S.directory_manifest(own, snapshot).select("manifest_row_id", "directory_accession")
        number = F.floor(F.col("manifest_row_id") / chunk_size)
        chunks = S.chunk_manifest(manifest, chunk_size).select("chunk_id", F.floor(F.col("start_row") / chunk_size).alias("number"))
        with M.staging(spark, path) as staged:
            manifest.withColumn("number", number).join(chunks, "number").select("directory_accession", "chunk_id", "number").write.parquet(staged)
    made = spark.read.parquet(path)
    same = digest(made, "directory_accession") == digest(own, "directory_accession")
    M.delete(spark, names)
    if not same:
        raise ValueError(f"{work} belongs to other directories")
    return made


def _keyed(files: DataFrame, chosen: DataFrame) -> DataFrame:
    """``files`` of the directories in ``chosen``, with its other columns."""
    d = files.withColumn("directory_accession", F.element_at(F.split("path", "/"), -2)).where("path is not null")
    return d.join(chosen, "directory_accession").drop("directory_accession")


def _deal(files: DataFrame, made: DataFrame, jobs: list[list[str]], into: str) -> bool:
    """Writes the files of all jobs once, a folder for each, so that no job makes or lists the others' files again.

    False where that fails: a job then takes its files from ``files``, so that only chunks with the fault fail.
    """
    spark = files.sparkSession
    M.delete(spark, into)
    of = spark.createDataFrame([(i, k) for k, ids in enumerate(jobs) for i in ids], "chunk_id string, job int")
    own = _keyed(files, made.select("directory_accession", "chunk_id").join(F.broadcast(of), "chunk_id"))
    try:
        own.repartition(len(jobs), "job").write.option("compression", "zstd").partitionBy("job").parquet(into)
    except Exception:  # noqa: BLE001  told by the job that meets it again
        M.delete(spark, into)
        return False
    return True


def _parse(own: DataFrame, ids: list[str], into: str, snapshot: str) -> None:
    """Parses files, which have a chunk_id, into a folder for each chunk; a chunk's files are parsed by a few tasks, so its folder has few."""
    n = max(len(ids), int(own.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    own = own.repartition(n, "chunk_id", F.pmod(F.xxhash64("path"), F.lit(n // len(ids))))
    own = own if "content" in own.columns else T.contents(own)
    P.parsed(own, snapshot, with_paths=True, keep=("chunk_id",)).write.option("compression", "zstd").partitionBy("chunk_id").parquet(into)


def run(files: DataFrame, work: str, snapshot: str, chunk_size: int = 5_000, at_once: int = 8, retries: int = 1) -> DataFrame:
    """Parses ``files`` by chunks of ``chunk_size`` directories and returns all parsed files, with their chunk_id.

    ``files`` has path, modificationTime, length, and content unless tasks shall read it; they are dealt to the jobs once,
    and a job reads its own only. ``at_once`` chunks are one Spark job, and ``ABREAST`` jobs run at a time; each chunk is
    then put in place and noted in the ledger by itself. If a job fails, its chunks are tried one by one,
    ``retries`` times more; one that still fails is noted with its error, and ``Incomplete`` is raised after the others
    are done. A call with the same ``work`` parses only chunks that no ledger row calls done.
    """
    spark = files.sparkSession
    made = plan(files, work, snapshot, chunk_size)
    chunks = made.select("chunk_id", "number").distinct()

    def attempt(ids: list[str], attempts: int, job: int) -> Exception | None:
        began = datetime.now(UTC).replace(tzinfo=None)
        error = None
        into = f"{work}/_parsing/{job}"
        M.delete(spark, into)
        try:
            if M.exists(spark, f"{work}/_files"):
                own = spark.read.schema(shape).parquet(part).where(F.col("chunk_id").isin(ids)) if M.exists(spark, part := f"{work}/_files/job={job}") else None
            else:
                own = _keyed(files, F.broadcast(made.where(F.col("chunk_id").isin(ids)).select("directory_accession", "chunk_id")))
            if own is not None:  # chunks of empty directories have no files
                _parse(own, ids, into, snapshot)
            for i in ids:
                if M.exists(spark, part := f"{into}/chunk_id={i}"):
                    M.commit(spark, part, f"{work}/parsed/chunk_id={i}")
        except Exception as e:  # noqa: BLE001  any failure of a chunk is a row of the ledger
            error = e
            if len(ids) > 1:
                return e
        ended = datetime.now(UTC).replace(tzinfo=None)
        row = (None if error is None else (str(error).strip().splitlines() or [type(error).__name__])[0][:500])
        with M.staging(spark, f"{work}/ledger/{ids[0]}-{began:%Y%m%d%H%M%S%f}") as staged:
            spark.createDataFrame([(i, int(error is not None), began, ended, attempts, row) for i in ids], LEDGER).coalesce(1).write.parquet(staged)
        return error

    todo = [r["chunk_id"] for r in S.pending(chunks, ledger(spark, work)).orderBy("number").collect()]  # a row a chunk
    jobs = [todo[k : k + at_once] for k in range(0, len(todo), at_once)]
    shape = _keyed(files, made.select("directory_accession", "chunk_id")).schema
    M.delete(spark, f"{work}/_files")
    if len(jobs) > 1:
        _deal(files, made, jobs, f"{work}/_files")

    def done(job: int) -> list[str]:
        """The chunks of a job that failed."""
        ids = jobs[job]
        if len(ids) > 1 and attempt(ids, 1, job) is None:
            return []
        return [i for i in ids if not any(attempt([i], k + 1, job) is None for k in range(1 + retries))]

    with ThreadPoolExecutor(ABREAST) as pool:
        failed = [i for ids in pool.map(done, range(len(jobs))) for i in ids]
    M.delete(spark, f"{work}/_files")
    if failed:
        raise Incomplete(f"failed chunks: {', '.join(failed[:20])}{' ...' if len(failed) > 20 else ''}")
    M.delete(spark, f"{work}/_parsing")
    parsed_shape = P.parsed(files.where("false") if "content" in files.columns else T.contents(files.where("false")), snapshot, with_paths=True).schema.add("chunk_id", "string")
    if not M.exists(spark, f"{work}/parsed"):
        return spark.createDataFrame([], parsed_shape)
    return spark.read.schema(parsed_shape).parquet(f"{work}/parsed")
