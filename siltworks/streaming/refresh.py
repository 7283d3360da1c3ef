"""A stream of documents refined load by load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from siltworks.plans.increment import Layers

# Fixed value: the property in which a batch finds the identity of its query.
QUERY_ID = "sql.streaming.queryId"


def load_name(query: str, batch: int) -> str:
    return f"{query}-{batch:012d}"


def refine_available(
    documents: DataFrame, layers: Layers, array: str, datasource: str, checkpoint: str
) -> StreamingQuery:
    """Refine all documents waiting in a stream, a load for each batch, then stop.

    Started again with the same ``checkpoint`` folder, it loads only what is new. A batch that
    Spark runs again, as after a failure between its end and its entry in the checkpoint, is a
    load that is finished already and changes nothing; one that broke off is run as a whole. The
    name of a load is made of the query, which a checkpoint keeps, and of the batch.
    """

    def load(batch: DataFrame, number: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
        name = load_name(query, number)
        if name in layers.finished():
            return
        # The batch's own session lasts as long as the batch; a load reads it once, and no later.
        layers.run(batch, name, array, datasource)

    return (
        documents.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
