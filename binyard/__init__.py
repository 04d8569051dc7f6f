"""binyard: packhouse and orchard reports as lazy Spark DataFrame plans.

Four season-scoped reports over two generations of an orchard ERP star
schema: ``bin_intake``, ``batch_packout``, ``defect_share`` and
``pack_units``.  Each takes a catalog (Parquet, JDBC or in-memory frames), the
requested seasons and an optional ``ReportConfig`` and returns a DataFrame;
nothing is collected.
"""

from binyard.config import DEFAULT_CONFIG, ReportConfig
from binyard.plans.batch_packout import batch_packout
from binyard.plans.bin_intake import bin_intake
from binyard.plans.defect_share import defect_share
from binyard.plans.pack_units import pack_units
from binyard.session import build_session, materialize
from binyard.sources.catalog import FrameCatalog, JdbcCatalog, ParquetCatalog
from binyard.plans.season_store import SeasonStore
from binyard.sources.sinks import publish_report, read_report, write_catalog, write_report

__all__ = [
    "DEFAULT_CONFIG", "ReportConfig", "batch_packout", "bin_intake", "defect_share", "pack_units",
    "FrameCatalog", "JdbcCatalog", "ParquetCatalog", "SeasonStore", "build_session", "materialize",
    "publish_report", "read_report", "write_catalog", "write_report",
]
