"""Explicit schemas and fixed column lists.

Every reader in the package passes one of these schemas, so nothing depends
on schema inference or on sampling (a fact key that is absent from every
sampled document would otherwise vanish from the inferred struct).
"""

from __future__ import annotations

from pyspark.sql.types import (
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)

# Money columns leave the sector rules as this type: exact, and the same in
# every sector branch, so a union never widens them to text.
MONEY = DecimalType(38, 6)
# Facts are parsed with this type before arithmetic.
FACT_NUMBER = DecimalType(38, 6)

# Price tick as written by the market-data extract.
TICK = StructType(
    [
        StructField("_id", StringType()),
        StructField("Date", StringType()),
        StructField("Open", DoubleType()),
        StructField("High", DoubleType()),
        StructField("Low", DoubleType()),
        StructField("Close", DoubleType()),
        StructField("Volume", LongType()),
        StructField("Dividends", DoubleType()),
        StructField("Stock Splits", DoubleType()),
        StructField("ticker", StringType()),
        StructField("fetch_timestamp", StringType()),
    ]
)

FACT = StructType(
    [
        StructField("value", StringType()),
        StructField("context", StringType()),
        StructField("name", StringType()),
    ]
)

# Filing document. `facts` is a map, so a missing tag reads as NULL instead
# of failing analysis.
FILING = StructType(
    [
        StructField(
            "file_info",
            StructType(
                [
                    StructField("instance_filename", StringType()),
                    StructField("taxonomy_filename", StringType()),
                    StructField("file_size", LongType()),
                ]
            ),
        ),
        StructField("ticker", StringType()),
        StructField("tahun", StringType()),
        StructField("triwulan", StringType()),
        StructField("facts", MapType(StringType(), FACT)),
        StructField("processed_date", StructType([StructField("$date", StringType())])),
    ]
)

# Output column order of a sector row.
SECTOR_IDENTITY_COLUMNS = [
    "entity_name", "emiten", "tahun", "triwulan", "report_date", "satuan", "pembulatan",
]
SECTOR_MONEY_COLUMNS = [
    "revenue", "gross_profit", "operating_profit", "net_profit", "cash", "total_assets",
    "short_term_borrowing", "long_term_borrowing", "total_equity", "liabilities",
    "cash_dari_operasi", "cash_dari_investasi", "cash_dari_pendanaan",
]
SECTOR_COLUMNS = SECTOR_IDENTITY_COLUMNS + SECTOR_MONEY_COLUMNS

SECTOR_ROW = StructType(
    [StructField(c, StringType()) for c in SECTOR_IDENTITY_COLUMNS]
    + [StructField(c, MONEY) for c in SECTOR_MONEY_COLUMNS]
)

# Tick measure -> averaged column name.
MEASURES = [
    ("Open", "avg_open"),
    ("High", "avg_high"),
    ("Low", "avg_low"),
    ("Close", "avg_close"),
    ("Volume", "avg_volume"),
    ("Dividends", "avg_dividends"),
    ("Stock Splits", "avg_stock_splits"),
]
AVG_COLUMNS = [out for _, out in MEASURES]

# Keys of the three aggregate grains and of the two merge targets.
DAILY_KEYS = ["Date", "ticker"]
MONTHLY_KEYS = ["Year", "Month", "ticker"]
YEARLY_KEYS = ["Year", "ticker"]
FILING_KEYS = ["ticker", "tahun", "triwulan"]
SECTOR_KEYS = ["emiten", "tahun", "triwulan"]


def aggregate_schema(keys: list[StructField]) -> StructType:
    return StructType(keys + [StructField(c, DoubleType()) for c in AVG_COLUMNS])


def _fields(spec: list[tuple[str, object]]) -> list[StructField]:
    return [StructField(n, t) for n, t in spec]


# Staged aggregate schemas, as the JSON sink writes them (Date as ISO text).
DAILY_AGG = aggregate_schema(_fields([("Date", StringType()), ("ticker", StringType())]))
MONTHLY_AGG = aggregate_schema(
    _fields([("Year", IntegerType()), ("Month", IntegerType()), ("ticker", StringType())]))
YEARLY_AGG = aggregate_schema(_fields([("Year", IntegerType()), ("ticker", StringType())]))
