"""Download manifests (P11, K8): what the extract would fetch, as a table.

Nothing is fetched here; network download, browser automation and rate
limits are outside the library. The manifest is the Spark-side hand-off: a
downloader (any tool) reads it, and its archives come back through
`tidemark.sources.xbrl`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Path of a filing archive below the report site's base URL.
ARCHIVE_PATH = "%s/Laporan%%20Keuangan%%20Tahun%%20%s/%s/%s/instance.zip"
EXCHANGE_SUFFIX = ".JK"


def filing_manifest(keys: DataFrame, base_url: str) -> DataFrame:
    """(ticker, tahun, triwulan) -> symbol, archive URL and document name."""
    return keys.select(
        "ticker",
        "tahun",
        "triwulan",
        F.concat(F.col("ticker"), F.lit(EXCHANGE_SUFFIX)).alias("symbol"),
        F.format_string(ARCHIVE_PATH, F.lit(base_url), F.col("tahun"), F.col("triwulan"), F.col("ticker")).alias("url"),
        F.concat_ws("_", "ticker", "tahun", "triwulan").alias("document_name_stem"),
    ).withColumn("document_name", F.concat(F.col("document_name_stem"), F.lit(".json"))).drop("document_name_stem")
