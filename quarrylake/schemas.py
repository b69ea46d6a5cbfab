"""The three topics: raw columns, required fields, keys, and the silver shape."""

from __future__ import annotations

from dataclasses import dataclass, field

AUDIT_COLUMNS = {
    "_ingestion_timestamp": "timestamp",
    "_source_file": "string",
    "_validation_errors": "string",
    "_record_status": "string",
}


@dataclass(frozen=True)
class Topic:
    name: str
    key: str
    event_time: str
    required: tuple[str, ...]
    raw: dict[str, str]
    silver: dict[str, str]
    not_null: tuple[str, ...]
    salted: tuple[str, ...] = ()
    partition_by: str | None = None
    buckets: int = 16
    cluster_by: tuple[str, ...] = field(default=())

    @property
    def raw_ddl(self) -> str:
        return ddl(self.raw)

    @property
    def bronze_ddl(self) -> str:
        return ddl({**self.raw, **AUDIT_COLUMNS})


def ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in columns.items())


# Column names, types and required fields of the topics.
_ITEMS = "array<struct<product_id:string,quantity:int,unit_price:double>>"

ORDERS = Topic(
    name="orders",
    key="order_id",
    event_time="order_date",
    required=("order_id", "customer_id", "order_date", "total_amount"),
    raw={
        "order_id": "string",
        "customer_id": "string",
        "order_date": "string",
        "total_amount": "double",
        "status": "string",
        "payment_method": "string",
        "shipping_address_id": "string",
        "items": _ITEMS,
    },
    silver={
        "order_id": "string",
        "customer_id": "string",
        "order_date": "timestamp",
        "total_amount": "double",
        "status": "string",
        "payment_method": "string",
        "shipping_address_id": "string",
    },
    not_null=("order_id", "customer_id", "order_date", "total_amount"),
    partition_by="order_day",
    cluster_by=("customer_id", "order_date"),
)

CUSTOMERS = Topic(
    name="customers",
    key="customer_id",
    event_time="updated_at",
    required=("customer_id", "email", "name"),
    raw={
        "customer_id": "string",
        "email": "string",
        "name": "string",
        "phone": "string",
        "address": "string",
        "city": "string",
        "state": "string",
        "country": "string",
        "postal_code": "string",
        "created_at": "string",
        "updated_at": "string",
        "lifetime_value": "double",
    },
    silver={
        "customer_id": "string",
        "name": "string",
        "email": "string",
        "phone": "string",
        "address": "string",
        "city": "string",
        "state": "string",
        "country": "string",
        "postal_code": "string",
        "created_at": "timestamp",
        "updated_at": "timestamp",
    },
    not_null=("customer_id",),
    salted=("email", "phone", "name"),
    cluster_by=("customer_id",),
)

PRODUCTS = Topic(
    name="products",
    key="product_id",
    event_time="updated_at",
    required=("product_id", "name", "price"),
    raw={
        "product_id": "string",
        "name": "string",
        "price": "double",
        "category": "string",
        "description": "string",
        "brand": "string",
        "sku": "string",
        "weight": "double",
        "created_at": "string",
        "updated_at": "string",
    },
    silver={
        "product_id": "string",
        "name": "string",
        "category": "string",
        "price": "double",
        "description": "string",
        "brand": "string",
        "sku": "string",
        "weight": "double",
        "created_at": "timestamp",
        "updated_at": "timestamp",
    },
    not_null=("product_id",),
    salted=("name",),
    cluster_by=("product_id", "category"),
)

TOPICS: dict[str, Topic] = {topic.name: topic for topic in (ORDERS, CUSTOMERS, PRODUCTS)}
