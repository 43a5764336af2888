"""Results and conditions appended batch by batch as documents land.

The transforms are those of the batch plan: the two parts of a race meet by a
join of two streams, and events and competitions, which land before, are
joined as tables.
"""

from rinkflow import fixed_values as fixed
from rinkflow.plans import enrichment
from rinkflow.sources import landed_json as landed
from rinkflow.sources.delimited import write_semicolon_csv


def stream_races(spark, folder, files_per_batch=fixed.EVENTS_PER_BATCH):
    """Nested races of a growing landing folder, each once, when its later part lands.

    A race's first documents count. The state holds a key for each document, and
    documents whose other part has not landed.
    """
    details, results = (
        landed.stream_race_documents(spark, f"{folder}/{kind}", kind, files_per_batch)
        for kind in ("competition_details", "competition_results")
    )
    return enrichment.race_documents(
        landed.read_latest_events(spark, f"{folder}/event_details"),
        landed.read_listed_competitions(spark, f"{folder}/competitions"),
        details,
        results,
    )


def append_batches(races, path, checkpoint):
    """Start a query that adds the rows of each batch under ``path``/results and /conditions, batch=<number>.

    A batch repeated after a failure rewrites its own folders, so no row is
    appended twice.
    """

    def write(batch, number):
        # Both outputs read the joined batch.
        held = batch.persist()
        for name, rows, columns in (
            ("results", enrichment.result_rows(held), fixed.RESULT_COLUMNS),
            ("conditions", enrichment.condition_rows(held), fixed.CONDITION_COLUMNS),
        ):
            write_semicolon_csv(rows, f"{path}/{name}/batch={number}", columns)
        held.unpersist()

    return (
        races.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
