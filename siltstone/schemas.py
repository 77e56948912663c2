"""Table and load descriptions of the e-commerce star schema, and stored schemas."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIRST_WATERMARK = "1900-01-01"
INGESTED_AT = "ingestion_timestamp"


@dataclass(frozen=True)
class TableSpec:
    """One silver table.

    ``columns`` maps a name to its silver type; ``None`` passes the source type through.
    ``tracked`` lists the columns whose change opens a new version (all when None).
    ``ties`` orders changes of a key that are equal in ``sequence``; their own values decide after that.
    ``rules`` are named SQL predicates a row must satisfy.
    """

    name: str
    columns: dict[str, str | None]
    keys: tuple[str, ...] = ()
    sequence: str | None = None
    strategy: str = "incremental"
    tracked: tuple[str, ...] | None = None
    ties: tuple[str, ...] = ()
    deletes: str | None = None
    upper: tuple[str, ...] = ()
    rules: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class LoadSpec:
    """One entry of the load configuration: which source table, and how much of it.

    ``cdc_key`` names columns that order rows equal in ``cdc_column``, such as a growing id.  The mark then is the value
    and the key of the last row, and a later load takes what comes after both."""

    schema: str
    table: str
    cdc_column: str = ""
    from_date: str = ""
    load_strategy: str = "full"
    cdc_key: tuple[str, ...] = ()

    def __post_init__(self):
        if self.load_strategy not in ("full", "incremental"):
            raise ValueError(f"{self.table}: unknown load strategy {self.load_strategy!r}")
        if self.load_strategy == "incremental" and not self.cdc_column:
            raise ValueError(f"{self.table}: an incremental load needs a cdc_column")

    @property
    def incremental(self) -> bool:
        return self.load_strategy == "incremental"


LOAD_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("schema", "table", "cdc_column", "from_date", "load_strategy")]
)


def read_loads(spark: SparkSession, path: str) -> list[LoadSpec]:
    """The load configuration from a JSON document (an array of objects, all strings)."""
    rows = spark.read.schema(LOAD_SCHEMA).json(path, multiLine=True).collect()
    return [LoadSpec(**{k: v or "" for k, v in r.asDict().items()}) for r in rows]


# The six tables of the warehouse and how each is loaded.
LOADS = [
    LoadSpec("dbo", "DimCustomer", "updated_at", "", "incremental"),
    LoadSpec("dbo", "DimProduct", "updated_at", "", "incremental"),
    LoadSpec("dbo", "DimSeller", "updated_at", "", "incremental"),
    LoadSpec("dbo", "FactOrder", "order_approved_at", "", "incremental"),
    LoadSpec("dbo", "FactOrderItem", "", "", "full"),
    LoadSpec("dbo", "DimDate", "", "", "full"),
]

# Column names, types, keys and rules of the silver tables.
DIM_CUSTOMER = TableSpec(
    "DimCustomer",
    {
        "customer_id": None,
        "customer_unique_id": None,
        "customer_zip_code_prefix": None,
        "customer_city": None,
        "customer_state": None,
        "updated_at": "timestamp",
    },
    keys=("customer_id",),
    sequence="updated_at",
    upper=("customer_state",),
)
DIM_PRODUCT = TableSpec(
    "DimProduct",
    {
        "product_id": None,
        "product_category_name": None,
        "product_name_length": "int",
        "product_description_length": "int",
        "product_photos_qty": "int",
        "product_weight_g": "int",
        "product_length_cm": "int",
        "product_height_cm": "int",
        "product_width_cm": "int",
        "updated_at": "timestamp",
    },
    keys=("product_id",),
    sequence="updated_at",
)
DIM_SELLER = TableSpec(
    "DimSeller",
    {
        "seller_id": None,
        "seller_zip_code_prefix": None,
        "seller_city": None,
        "seller_state": None,
        "updated_at": "timestamp",
    },
    keys=("seller_id",),
    sequence="updated_at",
    upper=("seller_state",),
)
FACT_ORDER = TableSpec(
    "FactOrder",
    {
        "order_id": None,
        "customer_id": None,
        "order_status": None,
        "order_purchase_timestamp": "timestamp",
        "order_approved_at": "timestamp",
        "order_delivered_carrier_date": "timestamp",
        "order_delivered_customer_date": "timestamp",
        "order_estimated_delivery_date": "timestamp",
        "total_payment_value": "decimal(10,2)",
        "payment_type": None,
    },
    keys=("order_id",),
    sequence="order_approved_at",
)
FACT_ORDER_ITEM = TableSpec(
    "FactOrderItem",
    {
        "order_item_id": "bigint",
        "order_id": None,
        "order_item_seq": "int",
        "product_id": None,
        "seller_id": None,
        "shipping_limit_date": "timestamp",
        "price": "decimal(10,2)",
        "freight_value": "decimal(10,2)",
    },
    keys=("order_id", "order_item_id", "product_id"),
    strategy="full",
    rules={"valid_order_item": "order_item_id IS NOT NULL", "valid_price": "price >= 0"},
)

SPECS = {s.name: s for s in (DIM_CUSTOMER, DIM_PRODUCT, DIM_SELLER, FACT_ORDER, FACT_ORDER_ITEM)}

# Documented lists of columns whose change opens a version; the pipelines themselves track all.
DOCUMENTED_TRACKED = {
    "FactOrder": ("order_status", "order_approved_at", "order_delivered_customer_date"),
    "DimCustomer": ("customer_city", "customer_state", "customer_zip_code_prefix"),
    "DimProduct": (
        "product_category_name",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    ),
    "DimSeller": ("seller_city", "seller_state", "seller_zip_code_prefix"),
}

# Documented rules the pipelines themselves do not apply; the set of statuses is the caller's.
DOCUMENTED_ITEM_RULES = {"valid_order": "order_id IS NOT NULL", "valid_freight": "freight_value >= 0"}
DOCUMENTED_ORDER_RULES = {"valid_order": "order_id IS NOT NULL"}


def documented(specs: Mapping[str, TableSpec] | None = None, statuses: Sequence[str] = ()) -> dict[str, TableSpec]:
    """The tables as the documentation describes them: versions by the tracked lists, all documented rules, and orders
    with a status other than ``statuses`` rejected (if any are given)."""
    listed = ", ".join("'" + s.replace("'", "''") + "'" for s in statuses)
    status = {"valid_status": f"order_status IN ({listed})"} if statuses else {}
    more = {"FactOrder": {**DOCUMENTED_ORDER_RULES, **status}, "FactOrderItem": DOCUMENTED_ITEM_RULES}
    return {
        name: replace(spec, tracked=DOCUMENTED_TRACKED.get(name, spec.tracked), rules={**spec.rules, **more.get(name, {})})
        for name, spec in (SPECS if specs is None else specs).items()
    }


_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 20}  # decimal digits that hold any value of the type
_WIDER = {("float", "double"), ("date", "timestamp_ntz")} | {(i, f) for i, f in (("tinyint", "float"), ("smallint", "float"), ("int", "double"))}


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that keeps every value of both: the larger whole number, a decimal with the digits of
    both sides, text where nothing else does."""
    names = a.simpleString(), b.simpleString()
    if names[0] == names[1]:
        return a
    if all(n in _DIGITS for n in names):
        return max(a, b, key=lambda t: _DIGITS[t.simpleString()])
    sizes = [
        (t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (_DIGITS[n], 0) if n in _DIGITS else None
        for t, n in zip((a, b), names)
    ]
    if all(sizes):
        whole, scale = (max(s[i] for s in sizes) for i in (0, 1))
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.StringType()
    for first, second, given in ((*names, b), (*reversed(names), a)):
        if (first, second) in _WIDER or (first in ("tinyint", "smallint") and second == "double"):
            return given
    return T.StringType()


def evolve(known: T.StructType | None, seen: T.StructType) -> T.StructType:
    """``known`` plus the columns only ``seen`` has, all nullable; a column that changed gets the wider type."""
    fields = {f.name: T.StructField(f.name, f.dataType, True) for f in (known.fields if known else [])}
    for f in seen.fields:
        kind = wider(fields[f.name].dataType, f.dataType) if f.name in fields else f.dataType
        fields[f.name] = T.StructField(f.name, kind, True)
    return T.StructType(list(fields.values()))


def widened(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the columns and types of ``schema``, an ``evolve`` of its own."""

    def column(f: T.StructField):
        if f.name not in df.columns:
            return F.lit(None).cast(f.dataType).alias(f.name)
        own = df.schema[f.name].dataType
        if own.simpleString() == f.dataType.simpleString():
            return F.col(f.name)
        if isinstance(own, (T.StructType, T.ArrayType, T.MapType)):
            return F.to_json(f.name).alias(f.name)
        return instant_text(F.col(f.name), own).cast(f.dataType).alias(f.name)

    return df.select(*[column(f) for f in schema.fields])


def instant_text(col: Column, kind: T.DataType) -> Column:
    """An instant as text in UTC with its zone, which reads back the same in every session; others as they are."""
    if not isinstance(kind, T.TimestampType):
        return col
    since = F.make_dt_interval(secs=(F.unix_micros(col) / F.lit(1_000_000)).cast("decimal(18,6)"))
    return F.concat((F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + since).cast("string"), F.lit("Z"))


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def save_schema(spark: SparkSession, schema: T.StructType, path: str) -> None:
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_schema(spark: SparkSession, path: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(spark.read.text(path, wholetext=True).first().value))


def schema_of(spark: SparkSession, data: str, saved: str) -> T.StructType:
    """Schema of the Parquet files under ``data``, inferred once, kept at ``saved``, widened later."""
    seen = spark.read.option("mergeSchema", "true").parquet(data).schema
    known = load_schema(spark, saved) if exists(spark, saved) else None
    merged = evolve(known, seen)
    if merged != known:
        save_schema(spark, merged, saved)
    return merged
