"""What each table must look like: columns, key, partitioning, clustering."""

from __future__ import annotations

from dataclasses import dataclass, field

# Source labels and lineage columns.
CLOUDS = ("aws", "azure", "gcp")
LINEAGE_COLUMNS = ("_source", "_layer", "_cloud", "_ingested_at", "_date_part")


@dataclass(frozen=True)
class TableContract:
    """One domain table. ``columns`` maps each business column to its SQL type."""

    name: str
    key: str
    columns: dict[str, str] = field(hash=False)
    feed_format: str
    partition_by: tuple[str, ...]
    cluster_by: tuple[str, ...]

    def ddl(self) -> str:
        """The business columns as a schema string, for readers that need one."""
        return ", ".join(f"`{name}` {kind}" for name, kind in self.columns.items())


CUSTOMERS = TableContract(
    name="customers",
    key="customer_id",
    columns={"customer_id": "string", "country_code": "string", "email": "string"},
    feed_format="csv",
    partition_by=("_date_part",),
    cluster_by=("customer_id",),
)

TRANSACTIONS = TableContract(
    name="transactions",
    key="transaction_id",
    columns={
        "transaction_id": "string",
        "customer_id": "string",
        "product_id": "string",
        "amount": "double",
        "txn_date": "date",
        "status": "string",
    },
    feed_format="parquet",
    partition_by=("txn_year", "txn_month"),
    cluster_by=("customer_id", "txn_date"),
)

PRODUCTS = TableContract(
    name="products",
    key="product_id",
    columns={"product_id": "string", "category": "string", "price": "double"},
    feed_format="json",
    partition_by=("_date_part",),
    cluster_by=("category",),
)

CONTRACTS = {c.name: c for c in (CUSTOMERS, TRANSACTIONS, PRODUCTS)}

# Clustering columns of the Gold models.
GOLD_CLUSTER_BY = {
    "daily_revenue": ("txn_date",),
    "customer_rfm": ("rfm_segment",),
    "product_performance": ("category",),
}
