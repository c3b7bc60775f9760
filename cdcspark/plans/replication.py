"""Whole jobs put together from the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import apply
from ..operators.transforms import Transform, chain, dispatch, route
from ..scratch import cut


def replicate(feed: DataFrame, keys: list[str], values: list[str], transform: Transform = lambda d: d, selected: DataFrame | None = None) -> DataFrame:
    """Current rows of one table's feed after dispatch and transforms."""
    df = dispatch(feed, selected) if selected is not None else feed
    return apply.current(apply.key_ops(df.transform(transform), keys, values), keys, values)


def replicate_routed(feed: DataFrame, routes: DataFrame, keys: list[str], values: list[str], *transforms: Transform) -> DataFrame:
    """Current rows per target database of the shards that are routed to it; the last change wins across shards."""
    df = route(feed, routes).transform(chain(*transforms))
    df = df.withColumns({"b_tgt_db": df["tgt_db"], "a_tgt_db": df["tgt_db"]})
    return apply.current(apply.key_ops(df, ["tgt_db", *keys], values), ["tgt_db", *keys], values)


def in_batches(state: DataFrame, keys: list[str], values: list[str], parts: list[DataFrame]) -> DataFrame:
    """State after the parts of a feed, merged one after the other as micro-batches come.

    Each merge lets only later places through, so parts that come twice or late change nothing. The plan
    is cut after each of them.
    """
    for part in parts:
        state = cut(apply.merge(state, apply.compact(apply.key_ops(part, keys, values), keys, values), keys, values))
    return state
