"""Join helpers with an explicit, checked broadcast decision and a salted fallback."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from driftsweep.session import scratch_path

DEFAULT_BROADCAST_ROWS = 50_000
CONF_KEY = "driftsweep.broadcast.maxRows"
SALT_CONF_KEY = "driftsweep.join.salts"
DEFAULT_SALTS = 32


#: A table is broadcast only if its rows as text stay below this, too.
BROADCAST_BYTES = 32 << 20


def broadcast_limit(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(CONF_KEY, str(DEFAULT_BROADCAST_ROWS)))


def stored(df: DataFrame, *measures: Column, sink: str = "table") -> DataFrame:
    """The rows, written once to the shared scratch folder and read back: cuts the lineage like ``checkpoint``, in one job.

    ``measures`` (aliased aggregates) are taken while the rows are written, see ``stored_with``."""
    return stored_with(df, *measures, sink=sink)[0]


def stored_with(df: DataFrame, *measures: Column, sink: str = "table") -> tuple[DataFrame, dict]:
    """``stored`` and the values of the measures."""
    path = scratch_path(df.sparkSession, sink)
    seen = Observation(sink) if measures else None
    (df.observe(seen, *measures) if seen else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), (seen.get if seen else {})


def salted_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner",
                salts: int | None = None, salt_from: list[str] | None = None) -> DataFrame:
    """Shuffle join that spreads every key of ``big`` over ``salts`` partitions.

    The salt is a hash of ``salt_from`` (deterministic, so retried tasks agree); ``small``
    is replicated once per salt with ``explode(sequence(...))``. A key holding a third of
    ``big`` is split ``salts`` ways instead of landing in one task. The hint keeps the planner from broadcasting
    ``small`` after all: files of few bytes can hold many rows, and these come ``salts`` times.
    """
    n = salts or int(big.sparkSession.conf.get(SALT_CONF_KEY, str(DEFAULT_SALTS)))
    cols = salt_from or [c for c in big.columns if c not in on][:4]
    b = big.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(n)).cast("int"))
    s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return b.join(s.hint("merge"), [*on, "_salt"], how).drop("_salt")


def join_checked(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner",
                 at_rest: bool = False, max_rows: int | None = None,
                 salt_from: list[str] | None = None) -> DataFrame:
    """Broadcast ``small`` only when its row count is under the bound (``max_rows``, else
    the ``driftsweep.broadcast.maxRows`` setting) and its size under BROADCAST_BYTES; above
    either, a salted shuffle join. ``at_rest``: small is read from stored rows, so it is not stored again."""
    limit = broadcast_limit(big) if max_rows is None else max_rows
    measures = (F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length(F.to_json(F.struct("*"))).cast("long")).alias("bytes"))
    if at_rest:
        seen = small.agg(*measures).first().asDict()
    else:
        small, seen = stored_with(small, *measures)     # counted while the table is written
    if seen["rows"] <= limit and (seen["bytes"] or 0) <= BROADCAST_BYTES:
        return big.join(F.broadcast(small), on, how)
    return salted_join(big, small, on, how, salt_from=salt_from)
