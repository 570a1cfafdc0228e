"""Table schemas and the fixed values of the data contract."""

from __future__ import annotations

from pyspark.sql import types as T

# Event names, weights and labels that results must carry.
EVENT_WEIGHTS = {"view": 1, "addtocart": 3, "transaction": 5}
DEFAULT_WEIGHT = 1
VALID_EVENTS = ["view", "addtocart", "transaction"]
FEATURE_COLUMNS = [
    "total_interacciones",
    "productos_distintos",
    "peso_total",
    "views",
    "carritos",
    "compras",
]
# Names of the labels of one published fit; fitted segments are named by their rank.
CLUSTER_NAMES = {
    0: "Cluster 0 — Bajo/moderado",
    1: "Cluster 1 — Ocasional (1 interacción)",
    2: "Cluster 2 — Muy activo",
    3: "Cluster 3 — Sobre el promedio",
    4: "Cluster 4 — Orientado a compra",
    5: "Cluster 5 — Actividad intermedia",
}
MIN_TIMESTAMP_RATIO = 0.01
MAX_REMOVED_RATIO = 0.02

# Ties on the newest timestamp are broken by these columns, newest first.
ROW_ORDER = ["timestamp", "itemid", "event", "transactionid"]

# The column names of the raw files.
EVENTS = T.StructType(
    [
        T.StructField("timestamp", T.LongType()),
        T.StructField("visitorid", T.LongType()),
        T.StructField("event", T.StringType()),
        T.StructField("itemid", T.DoubleType()),
        T.StructField("transactionid", T.DoubleType()),
    ]
)

CATEGORY_TREE = T.StructType(
    [
        T.StructField("categoryid", T.LongType()),
        T.StructField("parentid", T.LongType()),
    ]
)

ITEM_PROPERTIES = T.StructType(
    [
        T.StructField("timestamp", T.LongType()),
        T.StructField("itemid", T.LongType()),
        T.StructField("property", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)


def with_text_timestamp(schema: T.StructType) -> T.StructType:
    """The same table as a spreadsheet saves it: the timestamp is text."""
    return T.StructType(
        [
            T.StructField(f.name, T.StringType() if f.name == "timestamp" else f.dataType)
            for f in schema
        ]
    )
