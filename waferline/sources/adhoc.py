"""Ad-hoc SQL over one table, named ``t``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

# Fixed value: an ad-hoc view shows at most this many rows.
MAX_ROWS = 2000


def view(df: DataFrame, sql: str, rows: int = 200) -> DataFrame:
    """The result of ``sql`` over ``df`` as table t, cut to ``rows``.

    A text without FROM is the condition of a WHERE clause.
    """
    text = (sql or "").strip()
    rows = max(1, min(rows, MAX_ROWS))
    if not text:
        return df.limit(rows)
    if "from" not in text.lower():
        text = f"SELECT * FROM t WHERE {text}"
    # a view of its own per call, so that concurrent calls do not replace each other's t
    name = f"t_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(name)
    return df.sparkSession.sql(f"WITH t AS (SELECT * FROM {name}) {text}").limit(rows)
