"""Structured Streaming jobs over files, and their batch counterparts.

Jobs that take ``out`` keep their progress and what they have written there: a call with the same folder goes on where the last
one ended, and a batch that runs again replaces what it wrote. None of them keeps state that grows with the stream in memory.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.tables import scratch


def spooled(df: DataFrame, path: str, kind: str) -> str:
    df.write.format(kind).save(path)
    return path


def spooled_in_turn(parts: Sequence[DataFrame], path: str, files: int = 1) -> str:
    """A folder with ``files`` files for each of the parts, in this order: with the same ``files`` a stream takes them one by one."""
    for part in parts:
        (part.coalesce(1) if files == 1 else part.repartition(files)).write.mode("append").parquet(path)
    return path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at ``path``."""
    try:
        _files(spark, path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def _files(spark: SparkSession, path: str) -> DataFrame:
    """path of the files at ``path``; their contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")


def written(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The columns of ``schema`` of the table at ``path``, which is empty as long as nothing has been written there."""
    schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    return spark.read.schema(schema).parquet(path).select(*schema.names) if exists(spark, path) else spark.createDataFrame([], schema)


def events(spark: SparkSession, path: str, files: int = 64) -> DataFrame:
    """A stream over the table at ``path``, a file or a folder of files; at most ``files`` of them in a batch."""
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rpartition("/")
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files)
    return reader.option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").parquet(path) if _is_folder(spark, path) else reader.option("pathGlobFilter", name).parquet(folder)


def _is_folder(spark: SparkSession, path: str) -> bool:
    first = _files(spark, path).limit(1).collect()
    return not first or not first[0][0].endswith("/" + path.rpartition("/")[2])


def run(stream: DataFrame, mode: str = "append", each: Callable[[DataFrame, int], None] | None = None, out: str | None = None) -> DataFrame | None:
    """Run a stream until its input is used up; return what it wrote, unless ``each`` takes the batches."""
    spark = stream.sparkSession
    out = out or scratch(spark, "stream")
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{out}/state").trigger(availableNow=True)
    q = writer.foreachBatch(each).start() if each else writer.format("parquet").start(f"{out}/rows")
    q.awaitTermination()
    return None if each else written(spark, f"{out}/rows", stream.schema)


def decoded(spark: SparkSession, path: str, schema: str, required: Sequence[str], out: str | None = None) -> DataFrame:
    """JSON lines as rows of ``schema``; lines that do not parse or lack a required field are rejected. Empty input gives no row."""
    rows = spark.readStream.text(path).select(F.from_json("value", schema).alias("r")).select("r.*")
    for c in required:
        rows = rows.where(F.col(c).isNotNull())
    return run(rows, out=out)


def routed(spark: SparkSession, path: str, column: str, routes: Sequence[tuple[str, str]], out: str | None = None) -> DataFrame:
    """One row for each task whose term the column equals; a null equals none, repeated rows are routed each."""
    tasks = F.array_compact(F.array(*[F.when(F.col(column) == term, F.lit(task)) for task, term in routes]))
    return run(events(spark, path).select("event_id", F.explode(F.array_distinct(tasks)).alias("task")), out=out)


def unprocessed(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows of keys that no earlier run has processed; exact, where a Bloom filter would lose some. Null keys are never processed."""
    return df.join(done.select(key), key, "left_anti")


#: Bits of a Bloom filter's block, which are those of one of Spark's bitmaps, and bits set for a key.
_BLOCK_BITS, _KEY_BITS = 32768, 6


def _hashed(df: DataFrame, keys: Sequence[str], parts: int, blocks: int) -> DataFrame:
    """``df`` with _part and _block of its keys and the places _bits of their bits in that block. Nulls are values like others."""
    named = F.struct(*keys)
    text = F.to_json(named, {"ignoreNullFields": "false"})
    h, g = F.xxhash64(text), F.xxhash64(text, F.lit(1))
    low, high = g.bitwiseAND(F.lit(0x7FFFFFFF)), F.shiftrightunsigned(g, 32).bitwiseOR(F.lit(1))
    bits = F.array(*[F.pmod(low + i * high, F.lit(_BLOCK_BITS)).cast("int") for i in range(_KEY_BITS)])
    return df.withColumns({"_part": F.pmod(h, F.lit(parts)).cast("int"), "_block": F.pmod(F.shiftright(h, 20), F.lit(blocks)).cast("int"), "_bits": bits})


def _all_set(bitmap: str, bits: str) -> Column:
    def is_set(i: Column) -> Column:
        byte = F.conv(F.hex(F.substring(bitmap, F.shiftright(i, 3) + 1, F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, i % 8) == 1

    return F.forall(bits, is_set)


def _keys_of(spark: SparkSession, out: str, schema: T.StructType, parts: Sequence[int]) -> DataFrame:
    """The keys of some parts, from their own files alone."""
    if not parts:
        return spark.createDataFrame([], schema)
    chosen = "{" + ",".join(map(str, sorted(parts))) + "}"
    return spark.read.schema(schema).option("basePath", f"{out}/rows").parquet(f"{out}/rows/batch=*/_part={chosen}")


def stream_distinct(spark: SparkSession, path: str, keys: Sequence[str], out: str | None = None, *, parts: int = 16, expected: int = 5_000_000, files: int = 64) -> DataFrame:
    """Each key once over the whole stream, nulls included; exact.

    Known keys lie in ``parts`` by their hash, and each part has a Bloom filter of about ten bits for each of its share of the ``expected`` keys
    (with more keys it only answers "perhaps" more often). A batch reads the filters, and of the keys only the parts of those
    that a filter may hold, which are then compared. What a batch writes lies under its number, so that a batch that runs again
    replaces it: its new keys, the filters of the parts that got some, and the number under which each part's filter lies.
    """
    out = out or scratch(spark, "distinct")
    stream = events(spark, path, files).select(*keys)
    blocks = max(1, -(-expected * 10 // (_BLOCK_BITS * parts)))
    schema = T.StructType([*stream.schema, T.StructField("batch", T.IntegerType()), T.StructField("_part", T.IntegerType())])
    bloom = "_block int, bitmap binary, batch int, _part int"

    def write(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        new = _hashed(batch.distinct(), keys, parts, blocks)
        filters = {r[0]: r[1] for r in session.read.parquet(f"{out}/filters/batch={number - 1}").collect()} if number else {}  # one row per part
        held = None
        if filters:
            lying = [f"{out}/bloom/batch={last}/_part={part}" for part, last in filters.items()]
            held = session.read.schema(bloom).option("basePath", f"{out}/bloom").parquet(*lying).drop("batch")
            new = new.join(held, ["_part", "_block"], "left").withColumn("_perhaps", F.coalesce(_all_set("bitmap", "_bits"), F.lit(False))).drop("bitmap").persist()
            asked = [r[0] for r in new.where("_perhaps").select("_part").distinct().collect()]  # at most ``parts`` numbers
            known = _keys_of(session, out, schema, asked).where(F.col("batch") < number)
            same = F.lit(True)
            for c in keys:
                same = same & new[c].eqNullSafe(known[c])
            fresh = new.where(~F.col("_perhaps")).unionByName(new.where("_perhaps").join(known.select(*keys, F.col("_part").alias("_known")), same & (F.col("_part") == F.col("_known")), "left_anti"))
        else:
            fresh = new
        fresh.select(*keys, "_part").repartition("_part").write.mode("overwrite").partitionBy("_part").parquet(f"{out}/rows/batch={number}")
        new.unpersist()
        added = _hashed(session.read.schema(schema).parquet(f"{out}/rows").where(F.col("batch") == number).select(*keys), keys, parts, blocks)
        bitmaps = added.select("_part", "_block", F.explode("_bits").alias("bit")).groupBy("_part", "_block").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
        touched = [r[0] for r in bitmaps.select("_part").distinct().collect()]
        if held is not None:
            bitmaps = bitmaps.unionByName(held.where(F.col("_part").isin(touched)).select("_part", "_block", "bitmap")).groupBy("_part", "_block").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
        bitmaps.repartition("_part").write.mode("overwrite").partitionBy("_part").parquet(f"{out}/bloom/batch={number}")
        latest = sorted((filters | {part: number for part in touched}).items())
        session.createDataFrame(latest, "part int, batch int").coalesce(1).write.mode("overwrite").parquet(f"{out}/filters/batch={number}")

    run(stream, each=write, out=out)
    return written(spark, f"{out}/rows", schema).select(*keys)


def mark(df: DataFrame, key: str, marks: str, dry: bool) -> DataFrame:
    """The keys this run would process: those without a mark. A real run marks them in the folder ``marks``, a dry one does not.

    Null keys are neither processed nor marked; a repeated key is one. The folder must hold a table of keys, which may be empty.
    """
    spark = df.sparkSession
    known = spark.read.parquet(marks)
    new = df.select(key).where(F.col(key).isNotNull()).distinct().join(known, key, "left_anti")
    if not dry:
        new.write.mode("append").parquet(marks)
    return new


def micro_batches(spark: SparkSession, path: str, keys: Sequence[str], out: str) -> DataFrame:
    """Batches without repeated keys, each written under its number, so that a repeated batch replaces itself. Nulls are keys; an empty stream gives no row."""

    def write(batch: DataFrame, number: int) -> None:
        batch.dropDuplicates(list(keys)).write.mode("overwrite").parquet(f"{out}/rows/batch={number}")

    stream = events(spark, path)
    run(stream, each=write, out=out)
    return written(spark, f"{out}/rows", stream.schema)


def _save(rows: DataFrame, path: str) -> None:
    rows.repartition("shard").write.mode("overwrite").option("maxRecordsPerFile", 1_000_000).partitionBy("shard").parquet(path)


def shard_writes(
    spark: SparkSession, path: str, key: str, shards: int, out: str, *, valid: Column | None = None, attempts: int = 3, wait: float = 0.5, save: Callable[[DataFrame, str], None] = _save
) -> DataFrame:
    """shard, written, failed, attempts: each batch's rows written by shard, in files of bounded size under ``out``/rows.

    A batch whose write fails is tried again, ``attempts`` times at most and after ``wait`` seconds, then twice as many and so on; then its rows count as failed and stand in ``out``/failed, like
    those that are not ``valid``. attempts is the most that a batch of the shard took. A null key's shard is null. An empty
    stream writes and counts nothing.
    """
    good = F.lit(True) if valid is None else F.coalesce(valid, F.lit(False))

    def write(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn("shard", F.pmod(F.col(key), F.lit(shards)).cast("long"))
        taken, done = 0, False
        while not done and taken < attempts:
            taken += 1
            try:
                save(rows.where(good), f"{out}/rows/batch={number}")
                done = True
            except (PySparkException, Py4JJavaError, OSError):  # a sink that is away for a while
                if taken < attempts:
                    time.sleep(wait * 2 ** (taken - 1))
        written = good if done else F.lit(False)
        rows.where(~written).write.mode("overwrite").parquet(f"{out}/failed/batch={number}")
        counts = rows.groupBy("shard").agg(F.count_if(written).alias("written"), F.count_if(~written).alias("failed"))
        counts.withColumn("attempts", F.lit(taken)).write.mode("overwrite").parquet(f"{out}/counts/batch={number}")

    run(events(spark, path), each=write, out=out)
    counts = written(spark, f"{out}/counts", "shard long, written long, failed long, attempts int")
    return counts.groupBy("shard").agg(F.sum("written").alias("written"), F.sum("failed").alias("failed"), F.max("attempts").alias("attempts"))


def hour_windows(spark: SparkSession, path: str, out: str | None = None) -> DataFrame:
    """start, event_type, n of tumbling hours. Every batch writes partial counts, which are added up; no row is too late for that.

    Null types are a type of their own; rows without a time belong to no window. An empty stream has no window.
    """
    out = out or scratch(spark, "hours")

    def write(batch: DataFrame, number: int) -> None:
        counts = batch.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"))
        counts.select(F.col("w.start").alias("start"), "event_type", "n").write.mode("overwrite").parquet(f"{out}/rows/batch={number}")

    stream = events(spark, path)
    run(stream, each=write, out=out)
    kinds = stream.select(F.col("ts").alias("start"), "event_type", F.lit(0).cast("long").alias("n")).schema
    return written(spark, f"{out}/rows", kinds).groupBy("start", "event_type").agg(F.sum("n").alias("n"))


def closed_windows(spark: SparkSession, path: str, ts: str, by: Sequence[str], width: str, delay: str, out: str, *, files: int = 64, complete: bool = False) -> DataFrame:
    """start, ``by``, n of the tumbling windows that are closed: the latest time seen is ``delay`` past their end.

    A window's count never changes once it is closed. A row that comes for a closed window is late: it stands in ``out``/late as it came, so that
    closed, open and late rows together are all that have a time. Spark's own watermark closes the same windows for the same
    batches once it has moved past them (which it does a batch later, where more input waits), but drops late rows. The watermark of a batch follows from what the batches before it have seen, as written, so that
    a batch that runs again decides alike. With ``complete`` the input has ended and open windows count too. Null values of ``by`` are
    values; rows without a time belong to no window and are not late; an empty stream has no window.
    """
    stream = events(spark, path, files)
    at, kind = F.window(ts, width), dict(stream.dtypes)[ts]
    counted = stream.select(F.col(ts).alias("start"), F.col(ts).alias("end"), *by, F.lit(0).cast("long").alias("n")).schema

    def mark(session: SparkSession, number: int) -> str | None:
        return session.read.parquet(f"{out}/marks/batch={number}").first()[0] if number >= 0 else None  # one row

    def passed(until: str | None) -> Column:
        """Whether a window had ended when the watermark stood at ``until``."""
        return F.lit(False) if until is None else F.col("end") <= F.lit(until).cast(kind)

    def write(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        before = mark(session, number - 1)
        rows = batch.where(F.col(ts).isNotNull()).withColumn("_window", at).withColumns({"_start": F.col("_window.start"), "_end": F.col("_window.end")})
        late = F.lit(False) if before is None else F.col("_end") <= F.lit(before).cast(kind)
        rows.where(late).select(*batch.columns).write.mode("overwrite").parquet(f"{out}/late/batch={number}")
        counts = rows.where(~late).groupBy(F.col("_start").alias("start"), F.col("_end").alias("end"), *by).agg(F.count("*").alias("n"))
        counts.write.mode("overwrite").parquet(f"{out}/parts/batch={number}")
        seen = batch.agg((F.date_trunc("millisecond", F.max(ts)) - F.expr(f"INTERVAL {delay}")).cast("timestamp").alias("mark"))
        seen = seen.select(F.greatest("mark", F.lit(before).cast("timestamp")).cast("string").alias("mark"))
        seen.write.mode("overwrite").parquet(f"{out}/marks/batch={number}")
        parts = session.read.schema(T.StructType([*counted, T.StructField("batch", T.IntegerType())])).parquet(f"{out}/parts").where(F.col("batch") <= number)
        closing = parts.where(passed(mark(session, number)) & ~passed(before)).groupBy("start", "end", *by).agg(F.sum("n").alias("n"))
        closing.write.mode("overwrite").parquet(f"{out}/closed/batch={number}")

    run(stream, each=write, out=out)
    closed = written(spark, f"{out}/closed", counted)
    if complete and exists(spark, f"{out}/marks"):
        last = spark.read.parquet(f"{out}/marks").orderBy(F.desc("batch")).first()[0]
        closed = closed.unionByName(written(spark, f"{out}/parts", counted).where(~passed(last)).groupBy("start", "end", *by).agg(F.sum("n").alias("n")))
    return closed.select("start", *by, "n")


def days_to_do(days: DataFrame, done: DataFrame, fingerprint: str) -> DataFrame:
    """Days that no run with the same parameters has finished."""
    return days.join(done.where(F.col("fingerprint") == fingerprint).select("day"), "day", "left_anti")


def run_days(days: DataFrame, out: str, parameters: Mapping[str, object], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``work`` makes of the days that are still to do: rows with their day, written to ``out``/rows.

    A day is done once its rows have been written, also if there are none, and is not worked again; a run that was interrupted
    before works its days again and replaces what it wrote of them. ``out`` belongs to the ``parameters`` it was begun with: other ones
    are refused, with what differs. Null days are never worked, repeated ones once.
    """
    spark = days.sparkSession
    given = {k: json.dumps(v, sort_keys=True, default=str) for k, v in parameters.items()}
    if exists(spark, f"{out}/parameters"):
        begun = dict(map(tuple, spark.read.parquet(f"{out}/parameters").collect()))
        differing = [f"{k}: {begun.get(k, 'not set')} then, {given.get(k, 'not set')} now" for k in sorted(begun.keys() | given.keys()) if begun.get(k) != given.get(k)]
        if differing:
            raise ValueError(f"{out} was begun with other parameters: " + "; ".join(differing))
    else:
        spark.createDataFrame(sorted(given.items()), "name string, value string").coalesce(1).write.parquet(f"{out}/parameters")
    done = written(spark, f"{out}/done", "day date")
    todo = spooled(days.select("day").where("day IS NOT NULL").distinct().join(done, "day", "left_anti"), f"{out}/todo/{uuid.uuid4()}", "parquet")
    todo = spark.read.schema("day date").parquet(todo)
    rows = work(todo)
    rows.where("day IS NOT NULL").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(f"{out}/rows")
    todo.write.mode("append").parquet(f"{out}/done")
    return written(spark, f"{out}/rows", rows.schema).join(todo, "day", "left_semi")
