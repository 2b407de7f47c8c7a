"""The mart DAG as lazily built DataFrames.

    raw (adapter) -> staging -> rfm_v2 -> clusters -> {journey, early signals,
    ltv v1/v2, order items -> product affinity, category affinity} -> serving

A property is built once per ``Marts`` object. Staging relations and facts are
plans; the derived marts are stored once when first read (see ``Marts``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aisle.operators import staging
from aisle.params import DEFAULT, Params
from aisle.session import shared_dir, sized_tasks
from aisle.sources import tpch_adapter as adapter
from aisle.sources.tables import TableStore, drop_folder

SLICED_ROWS = 10_000_000     # of facts, from which on the pairs of one cluster at a time are counted


class Marts:
    """With ``keep`` the derived marts that several queries read are stored as tables
    when first asked for (as the reference materialises them): RFM, clusters, LTV,
    product affinity with its basket lines, baskets, totals and pairs, and the rollup. Readers plan
    over the stored table, not over all that made it, and a lost executor costs no rebuild.
    The number of tasks that make a table rises with the facts (``sized_tasks``), so a
    task's memory does not; the shuffle files behind a table go once it is stored.
    Raw facts are never stored, only re-scanned. Every object has a folder of its own
    below ``spark.checkpoint.dir``, so no query sees marts of other inputs;
    ``release`` drops it."""

    def __init__(self, spark: SparkSession, sf_dir: str, params: Params = DEFAULT, keep: bool = True):
        self.spark, self.sf_dir, self.p, self.keep = spark, sf_dir, params, keep
        self.t = adapter.Tables(spark, sf_dir)
        self._folder = f"marts-{uuid.uuid4().hex}"
        self._stored = 0

    def _kept(self, df: DataFrame) -> DataFrame:
        if not self.keep:
            return df
        return self._written([df])

    def _written(self, parts: list[DataFrame]) -> DataFrame:
        """The parts of a relation as one table, stored one after the other."""
        self._stored += 1
        path = f"{shared_dir(self.spark, self._folder)}/{self._stored}"
        with sized_tasks(self.spark, self._fact_rows):
            for part in parts:
                part.write.mode("append").parquet(path)
        return self.spark.read.schema(parts[0].schema).parquet(path)

    def _kept_per(self, column: str, df: DataFrame, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """``make(df)``, stored; over many facts in an action for each value of ``column``,
        so that no more than one value's shuffle files lie on the disks. ``column`` has
        few values, and ``make`` no row that comes from two of them."""
        if not self.keep or self._fact_rows < SLICED_ROWS:
            return self._kept(make(df))
        values = [r[0] for r in df.select(column).distinct().collect()]
        return self._written([make(df.filter(F.col(column).eqNullSafe(F.lit(v)))) for v in values] or [make(df)])

    @cached_property
    def _fact_rows(self) -> int:
        """Rows of the facts, from the footers of their files."""
        return sum(self.t[name].count() for name in ("orders", "lineitem", "events"))

    def stored(self, df: DataFrame) -> DataFrame:
        """A query's own result, made in tasks sized to the facts and stored."""
        return self._kept(df)

    def release(self) -> None:
        """Drop what this object has stored."""
        if self._stored:
            drop_folder(self.spark, shared_dir(self.spark, self._folder))
            self._stored = 0

    def materialise(self, folder: str) -> TableStore:
        """The derived marts as tables of a store, each swapped in when it is whole
        (A2, A6)."""
        store = TableStore(self.spark, folder)
        for name in ("rfm", "clusters", "ltv_v2", "product_affinity", "affinity_rollup"):
            store.refresh(name, getattr(self, name))
        return store

    # ---- staging -----------------------------------------------------------
    @cached_property
    def customers(self) -> DataFrame:
        return staging.stg_customers(adapter.raw_customers(self.t))

    @cached_property
    def orders(self) -> DataFrame:
        return staging.stg_orders(adapter.raw_orders(self.t))

    @cached_property
    def sessions(self) -> DataFrame:
        return staging.stg_sessions(adapter.raw_sessions(self.t))

    @cached_property
    def products(self) -> DataFrame:
        return staging.stg_products(adapter.raw_products(self.t))

    @cached_property
    def order_lines(self) -> DataFrame:
        return adapter.raw_order_lines(self.t)

    # ---- personas ----------------------------------------------------------
    @cached_property
    def rfm(self) -> DataFrame:
        from aisle.operators.rfm import rfm_v2
        return self._kept(rfm_v2(self.customers, self.orders, self.sessions, self.p))

    @cached_property
    def rfm_v1(self) -> DataFrame:
        from aisle.operators.rfm import rfm_naive_fanout
        return rfm_naive_fanout(self.customers, self.orders, self.sessions, self.p)

    @cached_property
    def clusters(self) -> DataFrame:
        from aisle.operators.clusters import behavioral_clusters
        return self._kept(behavioral_clusters(self.rfm, self.p))

    @cached_property
    def events(self) -> DataFrame:
        from aisle.operators.journey import all_events
        return all_events(self.sessions, self.orders, self.p)

    @cached_property
    def journey_events(self) -> DataFrame:
        from aisle.operators.journey import events_with_context
        return events_with_context(self.customers, self.sessions, self.orders, self.clusters, self.p)

    @cached_property
    def journey(self) -> DataFrame:
        from aisle.operators.journey import customer_journey
        return customer_journey(self.events, self.customers, self.clusters, self.p)

    @cached_property
    def early_signals(self) -> DataFrame:
        from aisle.operators.early import early_signals
        return early_signals(self.customers, self.sessions, self.orders, self.clusters, self.p)

    # ---- forecasting -------------------------------------------------------
    @cached_property
    def ltv_v2(self) -> DataFrame:
        from aisle.operators.ltv import ltv_forecast_v2
        return self._kept(ltv_forecast_v2(self.customers, self.orders, self.clusters, self.p))

    @cached_property
    def cohort_curve(self) -> DataFrame:
        from aisle.operators.ltv import cluster_revenue_curve
        return cluster_revenue_curve(self.customers, self.orders, self.clusters, self.p)

    @cached_property
    def ltv_v1(self) -> DataFrame:
        from aisle.operators.ltv import ltv_forecast_v1
        return ltv_forecast_v1(self.customers, self.orders, self.clusters, self.cohort_curve, self.p)

    # ---- baskets -----------------------------------------------------------
    @cached_property
    def basket_items(self) -> DataFrame:
        from aisle.operators.basket import expand_baskets
        return expand_baskets(self.orders, self.products, self.clusters, self.p)

    @cached_property
    def line_items(self) -> DataFrame:
        from aisle.operators.basket import enrich_lines
        return enrich_lines(self.order_lines, self.orders, self.clusters)

    @cached_property
    def product_affinity(self) -> DataFrame:
        from aisle.operators.basket import product_affinity
        return self._kept(product_affinity(self.affinity_pairs, self.affinity_totals, self.affinity_lines, self.p,
                                           self.affinity_baskets))

    @cached_property
    def affinity_rollup(self) -> DataFrame:
        from aisle.operators.basket import affinity_rollup
        return self._kept(affinity_rollup(self.product_affinity, self.p))

    @cached_property
    def family_affinity(self) -> DataFrame:
        from aisle.operators.basket import (affinity_baskets, affinity_lines, affinity_pairs, affinity_totals, family_items,
                                            product_affinity)
        from aisle.operators.relational import large_baskets
        lines = self._kept(affinity_lines(family_items(self.basket_items)))
        baskets = self._kept(affinity_baskets(lines))
        pairs = self._kept(affinity_pairs(lines, self._kept(large_baskets(baskets))))
        return self._kept(product_affinity(pairs, self._kept(affinity_totals(lines)), lines, self.p, baskets))

    @cached_property
    def affinity_pairs(self) -> DataFrame:
        from aisle.operators.basket import affinity_pairs
        from aisle.operators.relational import large_baskets
        large = self._kept(large_baskets(self.affinity_baskets))
        return self._kept_per("cluster_name", self.affinity_lines, lambda lines: affinity_pairs(lines, large))

    @cached_property
    def affinity_baskets(self) -> DataFrame:
        from aisle.operators.basket import affinity_baskets
        return self._kept(affinity_baskets(self.affinity_lines))

    @cached_property
    def affinity_totals(self) -> DataFrame:
        from aisle.operators.basket import affinity_totals
        return self._kept(affinity_totals(self.affinity_lines))

    @cached_property
    def affinity_lines(self) -> DataFrame:
        from aisle.operators.basket import affinity_lines
        return self._kept(affinity_lines(self.affinity_items))

    @cached_property
    def affinity_items(self) -> DataFrame:
        from aisle.operators.basket import affinity_items
        return affinity_items(self.basket_items)
