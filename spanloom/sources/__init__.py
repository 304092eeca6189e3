"""Readers and writers of corpora, labels and vocabularies.

Texts are read as bytes and decoded as UTF-8; line ends are never translated,
since offsets count them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTITIES = "array<struct<text:string,type:string,position:array<int>,assertions:array<string>,candidates:array<string>>>"


def numbered_files(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """doc_id, content of each ``<number>.<suffix>`` in the folder; other names are skipped."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{suffix}").load(folder)
    return files.select(F.expr(f"try_cast(regexp_extract(path, '([^/]*)[.]{suffix}$', 1) AS BIGINT)").alias("doc_id"), "content").filter("doc_id IS NOT NULL")


def corpus(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, text."""
    return numbered_files(spark, folder, "txt").select("doc_id", F.decode("content", "UTF-8").alias("text"))


def labels(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, raw, entities; entities are null where the file isn't an array of them."""
    return numbered_files(spark, folder, "json").select("doc_id", F.decode("content", "UTF-8").alias("raw")).withColumn("entities", F.from_json("raw", ENTITIES))


def mentions(labelled: DataFrame) -> DataFrame:
    """A row for each entity of ``labels``."""
    return labelled.select("doc_id", F.explode("entities").alias("e")).select("doc_id", "e.text", "e.type", F.col("e.position")[0].alias("start_pos"), F.col("e.position")[1].alias("end_pos"), F.coalesce("e.assertions", F.array()).alias("assertions"), F.coalesce("e.candidates", F.array()).alias("candidates"))


def records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Lines of JSON."""
    return spark.read.schema(schema).json(path)


def vocabulary(spark: SparkSession, path: str, columns: str) -> DataFrame:
    """A CSV with a header, all columns strings; quotes double inside quotes."""
    return spark.read.csv(path, header=True, schema=", ".join(f"{c} STRING" for c in columns.split()), escape='"')


def pipe_fields(spark: SparkSession, path: str, picks: dict[str, int], least: int) -> DataFrame:
    """Named fields of a file with fields between bars and no header; shorter lines are dropped."""
    parts = spark.read.text(path).select(F.split("value", "\\|").alias("f")).filter(F.size("f") >= least)
    return parts.select(*(F.get("f", F.lit(i)).alias(c) for c, i in picks.items()))


def concept_atoms(spark: SparkSession, path: str) -> DataFrame:
    """code, kind, text of a concept file's own vocabulary."""
    return pipe_fields(spark, path, {"code": 0, "source": 11, "kind": 12, "text": 14}, 15).filter("source = 'RXNORM'").drop("source")


def archived_atoms(spark: SparkSession, path: str) -> DataFrame:
    """code, kind, text of an archive of atoms."""
    return pipe_fields(spark, path, {"code": 6, "kind": 14, "text": 2}, 15)


def write_labels(entities: DataFrame, path: str) -> None:
    """A JSON line for each document, under its id."""
    entities.write.partitionBy("doc_id").mode("overwrite").text(path)


def write_records(rows: DataFrame, path: str) -> None:
    """Rows as lines of JSON, in as many files as there are partitions; a failed run leaves no half file."""
    rows.write.mode("overwrite").json(path)


def write_sorted(rows: DataFrame, path: str, order: list[str]) -> None:
    """A vocabulary as CSV with a header, that ``vocabulary`` reads back; its files together are in ``order``."""
    rows.orderBy(*order).write.mode("overwrite").csv(path, header=True, escape='"')


def append_sorted(base: DataFrame, more: DataFrame, path: str, key: list[str], resume: bool = False) -> None:
    """A vocabulary with the rows of ``more`` added, as ``write_sorted`` writes it.

    ``resume``: rows whose ``key`` the base has already stay out, so that a run which stopped
    can be run again, and of repeated keys in ``more`` one row is added.  Columns are those of
    the base; ``path`` must not be where the base is read from.
    """
    fresh = more.dropDuplicates(key).join(base.select(*key), key, "left_anti") if resume else more
    write_sorted(base.unionByName(fresh.select(*base.columns)), path, key)


def write_documents(records: DataFrame, folder: str) -> None:
    """``<doc_id>.json``, indented, for each row of doc_id and payload (JSON).

    ``folder`` must be one that all executors share.  Each file is written under a name of its
    own attempt and renamed, so a task that runs twice leaves whole files.  Rows with a null id
    or payload have no file; of rows with one id the last one written stays.
    """

    def write(rows) -> None:
        import json
        import os
        import uuid

        os.makedirs(folder, exist_ok=True)
        for r in rows:
            at = os.path.join(folder, f"{r['doc_id']}.json")
            own = f"{at}.{uuid.uuid4().hex}.tmp"
            with open(own, "w", encoding="utf-8", newline="") as out:
                out.write(json.dumps(json.loads(r["payload"]), ensure_ascii=False, indent=2))
            os.replace(own, at)

    records.select("doc_id", "payload").filter("doc_id IS NOT NULL AND payload IS NOT NULL").foreachPartition(write)


def package(records: DataFrame, issues: DataFrame, path: str) -> int:
    """A zip of ``output/<doc_id>.json`` for each row of doc_id and payload, in order of the ids;
    returns how many.

    Raises ValueError if ``issues`` (``level``) holds an error, or if an id is null or comes
    twice.  The archive is one local file by its nature; rows pass through the driver a
    partition at a time.  It appears under its name when whole.
    """
    import os
    import zipfile

    if issues.filter("level = 'error'").limit(1).count():
        raise ValueError("records with errors are not packaged")
    if records.groupBy("doc_id").count().filter("doc_id IS NULL OR count > 1").limit(1).count():
        raise ValueError("every record needs an id of its own")
    n = 0
    with zipfile.ZipFile(f"{path}.tmp", "w", compression=zipfile.ZIP_DEFLATED) as out:
        for r in records.select("doc_id", "payload").orderBy("doc_id").toLocalIterator():
            out.writestr(f"output/{r['doc_id']}.json", r["payload"])
            n += 1
    os.replace(f"{path}.tmp", path)
    return n
