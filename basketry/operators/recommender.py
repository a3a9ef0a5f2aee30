"""Any callable as a recommender: an Arrow table function over users' candidates.

The function takes a table partitioned by user. A user's candidate rows reach
the callable as one Arrow table, so it ranks whole lists with vectorised code,
and its answer becomes ordinary prediction rows that metrics, sinks and
reports take. A user's candidates are bounded by the catalog.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# (the user's rows, n) -> rows with product_id and score, best first
Recommend = Callable[[pa.Table, int], pa.Table]


def table_function(candidates: DataFrame, call: Recommend, n: int, key: str = "user_id"):
    """The table function of ``call``; its key and product types are those of ``candidates``."""
    types = dict(candidates.dtypes)

    class Recommender:
        def __init__(self):
            self.batches = []

        def eval(self, rows: pa.RecordBatch):
            self.batches.append(rows)
            yield from ()

        def terminate(self):
            if not self.batches:
                return
            rows = pa.Table.from_batches(self.batches)
            best = call(rows, n).slice(0, n)
            user = rows.column(key)[0]
            yield pa.table({
                key: pa.array([user.as_py()] * len(best), rows.schema.field(key).type),
                "rank": pa.array(range(1, len(best) + 1), pa.int64()),
                "product_id": best.column("product_id"),
                "score": pc.cast(best.column("score"), pa.float64())})

    schema = f"{key} {types[key]}, rank bigint, product_id {types['product_id']}, score double"
    return F.arrow_udtf(returnType=schema)(Recommender)


def recommend_by(candidates: DataFrame, call: Recommend, n: int, key: str = "user_id") -> DataFrame:
    """(key, rank, product_id, score): the answers of ``call`` for every user of ``candidates``.

    Users without candidates have no rows. More than ``n`` rows are cut, as the
    list length is ``n``; fewer stay fewer.
    """
    function = table_function(candidates, call, n, key)
    return function(candidates.asTable().partitionBy(key))


def best_scores(rows: pa.Table, n: int) -> pa.Table:
    """Highest score first, equal ones by product id."""
    order = pc.sort_indices(rows, sort_keys=[("score", "descending"), ("product_id", "ascending")])
    return rows.take(order.slice(0, n))
