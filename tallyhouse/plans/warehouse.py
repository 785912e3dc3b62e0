"""The three layers over one raw source: every table is built once, from the published ones."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from decimal import Decimal
from functools import cache, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.measures import COST_RATIO
from tallyhouse.operators.keys import Keep, assign_keys
from tallyhouse.operators.validate import Parents, broken_contract
from tallyhouse.plans import dims, facts
from tallyhouse.plans.rejects import REASONS, Routed, route
from tallyhouse.sources.keymap import KeyMap
from tallyhouse.sources.layers import (
    Steps,
    cut_lineage,
    ensure_layers,
    has_table,
    last_commit,
    layers_root,
    publish,
    read_table,
    shuffles_released,
    work_path,
)
from tallyhouse.sources.schemas import CONTRACTS, CORE, MART, RAW_SCHEMAS, STAGING, Contract
from tallyhouse.sources.testdata import TestTables


class Warehouse:
    """Loads a table on first use. ``raw`` gives a raw table by name; ``prefix`` keeps several
    warehouses in one catalog apart; ``root`` is the folder of the layers, by default
    ``spark.sql.warehouse.dir``. The calendar covers the whole years of the data, or ``calendar`` (first and
    last day). With ``keep_keys`` members keep their keys from load to load and new ones follow;
    otherwise keys are dense in every load, and one new member moves the others'. With
    ``check_lengths`` a text longer than its column is declared refuses the load. With ``quarantine`` orders,
    products and lines that would fail a load are left out of it; ``routed`` has them with the reason."""

    def __init__(
        self,
        spark: SparkSession,
        raw: Callable[[str], DataFrame],
        prefix: str = "",
        root: str | None = None,
        *,
        cost_ratio: Decimal = COST_RATIO,
        channel: str = "Website",
        calendar: tuple[str, str] | None = None,
        holidays: DataFrame | None = None,
        keep_keys: bool = False,
        check_lengths: bool = False,
        quarantine: bool = False,
    ):
        self.spark, self.raw, self.prefix = spark, raw, prefix
        self.cost_ratio, self.channel, self.calendar, self.holidays = cost_ratio, channel, calendar, holidays
        self._resolved_orders: DataFrame | None = None
        self._check_lengths, self._quarantine = check_lengths, quarantine
        self._routed: dict[str, Routed] = {}
        self._key_folder = f"{layers_root(spark, root)}/{prefix}keys" if keep_keys else None
        ensure_layers(spark, prefix, root)

    def staging(self, name: str) -> DataFrame:
        return self._table(STAGING, name)

    def core(self, name: str) -> DataFrame:
        return self._table(CORE, name)

    def mart(self, name: str) -> DataFrame:
        return self._table(MART, name)

    def _table(self, layer: str, name: str) -> DataFrame:
        if has_table(self.spark, layer, name, self.prefix):
            return read_table(self.spark, layer, name, self.prefix)
        return self.load(layer, name)

    def routed(self, name: str) -> Routed:
        """A staging table's rows that load and its rejects, written once per load of the table."""
        if name not in self._routed:
            path = work_path(self.spark, f"routed-{name}-{uuid.uuid4().hex}")
            self._routed[name] = route(self.spark, self.staging(name), REASONS[name](), path)
        return self._routed[name]

    def _input(self, name: str) -> DataFrame:
        """A staging table as core is built from it."""
        return self.routed(name).loaded if self._quarantine and name in REASONS else self.staging(name)

    def resolved_orders(self) -> DataFrame:
        """Orders as both facts need them, written once per load of orders and customers."""
        if self._resolved_orders is None:
            self._resolved_orders = cut_lineage(
                facts.resolve_orders(self._input("raw_orders"), self.core("dim_customer")), "resolved_orders"
            )
        return self._resolved_orders

    def load(self, layer: str, name: str, reload: bool = False) -> DataFrame:
        """Build one table from the published ones and replace it, if it keeps its contract.

        A staging table that exists is the audit copy: only ``reload`` replaces it. On disk are the shuffle files
        of one query at a time, and of the facts one part of the query (``Steps``).
        """
        steps = Steps(self.spark)
        try:
            with shuffles_released(self.spark):
                return self._load(layer, name, reload, steps)
        finally:
            steps.drop()

    def _load(self, layer: str, name: str, reload: bool, steps: Steps) -> DataFrame:
        if layer == STAGING and not reload and has_table(self.spark, layer, name, self.prefix):
            return read_table(self.spark, layer, name, self.prefix)
        if name in ("raw_orders", "dim_customer"):
            self._resolved_orders = None
        if layer == STAGING:
            self._routed.pop(name, None)
            return publish(self.raw(name), layer, name, self.prefix)
        contract = CONTRACTS[layer][name]
        since = last_commit(self.spark, layer, name, self.prefix)
        by_month = layer == CORE and name == "fact_sales"
        if by_month:
            df = self._sales(by_month, steps)
        elif (layer, name) == (MART, "fact_revenue_by_month"):
            df = facts.build_keyed_monthly(self.core("fact_sales"), self.core("dim_date"), contract.key, steps)
        else:
            df = self.build(layer, name, steps)
        identity = None
        if contract.key not in df.columns:
            if contract.natural_key:
                df = assign_keys(df, contract.key, list(contract.natural_key), keep=steps)
            else:
                identity = contract.key
        check = partial(
            broken_contract, contract=contract, unique_key=identity is None, parents=self.parents(layer, contract), lengths=self._check_lengths
        )
        return publish(
            df, layer, name, self.prefix, partition_by=contract.partition_by, identity=identity, check=check, rebalanced=by_month, since=since
        )

    def _sales(self, by_month: bool = False, keep: Keep | None = None) -> DataFrame:
        items, orders = self._input("raw_order_items"), self.resolved_orders()
        product, store = self.core("dim_product"), self.core("dim_store")
        return facts.build_fact_sales(items, orders, product, store, self.cost_ratio, self.channel, by_month=by_month, keep=keep)

    def parents(self, layer: str, contract: Contract) -> Parents:
        """The published tables that a table's foreign keys refer to, in its own layer or else in core."""
        found = {}
        for fk, (dim, pk) in contract.foreign_keys.items():
            home = layer if dim in CONTRACTS[layer] else CORE
            found[fk] = (self._table(home, dim), pk, f"{home}.{dim}.{pk}")
        return found

    def load_all(self, reload_staging: bool = False) -> None:
        """Every table, in the order of their dependencies; staging tables only where they are
        missing, or asked for."""
        for name in RAW_SCHEMAS:
            self.load(STAGING, name, reload_staging)
        for layer in (CORE, MART):
            for name in CONTRACTS[layer]:
                self.load(layer, name)

    def _calendar_bounds(self) -> DataFrame:
        if self.calendar is None:
            return dims.data_bounds(self._input("raw_orders"))
        first, last = (F.lit(day).cast("date") for day in self.calendar)
        return self.spark.range(0, 1, 1, 1).select(first.alias("start"), last.alias("end"))

    def _keys_of(self, name: str, keep: Keep | None) -> dims.GiveKeys:
        return KeyMap(self.spark, f"{self._key_folder}/{name}").keyed if self._key_folder else partial(assign_keys, keep=keep)

    def build(self, layer: str, name: str, keep: Keep | None = None) -> DataFrame:
        """The plan of a core or mart table over published inputs; fact row ids come at load time."""
        builders: dict[tuple[str, str], Callable[[], DataFrame]] = {
            (CORE, "dim_date"): lambda: dims.build_dim_date(self._calendar_bounds(), self.holidays),
            (CORE, "dim_customer"): lambda: dims.build_dim_customer(self._input("raw_customers"), self._keys_of(name, keep)),
            (CORE, "dim_product"): lambda: dims.build_dim_product(
                self._input("raw_products"), self._input("raw_product_category_translation"), give_keys=self._keys_of(name, keep)
            ),
            (CORE, "dim_store"): lambda: dims.build_dim_store(self._input("raw_sellers"), self._keys_of(name, keep)),
            (CORE, "fact_sales"): self._sales,
            (MART, "dim_month"): lambda: dims.build_dim_month(self.core("dim_date")),
            (MART, "dim_product"): lambda: dims.narrow(
                self.core("dim_product"), list(CONTRACTS[MART]["dim_product"].columns)
            ),
            (MART, "dim_store"): lambda: dims.narrow(self.core("dim_store"), list(CONTRACTS[MART]["dim_store"].columns)),
            (MART, "fact_revenue_by_month"): lambda: facts.build_monthly(self.core("fact_sales"), self.core("dim_date")),
            (MART, "order_fulfilment_snapshot"): lambda: facts.build_fulfilment(self.resolved_orders()),
        }
        return builders[layer, name]()


@cache
def _open(application_id: str, spark: SparkSession, folder: str) -> tuple[Warehouse, TestTables]:
    tables = TestTables(spark, folder)
    mark = hashlib.md5(f"{application_id} {folder}".encode()).hexdigest()[:10]
    return Warehouse(spark, tables.raw, prefix=f"th_{mark}_", root=work_path(spark, "layers")), tables


def open_warehouse(spark: SparkSession, folder: str) -> tuple[Warehouse, TestTables]:
    """The warehouse over one folder of test tables, kept for the life of the application."""
    return _open(spark.conf.get("spark.app.id"), spark, folder.rstrip("/"))
