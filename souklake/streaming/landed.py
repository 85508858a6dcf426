"""Load landed batches as they appear, each exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from souklake.operators.upsert import upsert_table
from souklake.plans.ingest import TableSpec, landing_root, staging_path
from souklake.sources.landing import CSV_OPTIONS
from souklake.sources.nested import flatten_structs


def load_stream(
    spark: SparkSession, spec: TableSpec, root: str, schema, checkpoint: str, latest_by: str
) -> StreamingQuery:
    """Upsert every batch that was landed since the last call, then stop.

    The checkpoint, a folder that outlives the session and serves this table and root only, remembers which files
    are done. A micro-batch that fails half-way is repeated, which the upsert turns into the same table. Files of
    several days may share a micro-batch, so ``latest_by`` names the column that tells which copy of a key is
    newest. A record that does not fit its types stops the stream.
    """
    reader = spark.readStream.schema(schema).option("mode", "FAILFAST")
    folder = f"{landing_root(root)}/{spec.source}/{spec.landing_name}/*.{spec.fmt}"
    if spec.fmt == "csv":
        batches = reader.options(**CSV_OPTIONS, multiLine=spec.free_text, enforceSchema=False, columnPruning=False).csv(folder)
    else:
        batches = flatten_structs(reader.json(folder))

    def merge(batch: DataFrame, _: int) -> None:
        upsert_table(
            batch.sparkSession, staging_path(root, spec.name), batch, list(spec.keys), spec.part, dedupe_by=latest_by
        )

    return (
        batches.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
