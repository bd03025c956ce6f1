from tidemark.sources.files import (
    email_load,
    ip_range_load,
    lead_load,
    model_batch,
    model_batch_export,
    model_output_load,
    pixel_load,
    scrape_load,
)
from tidemark.sources.tables import drop_partitions, drop_versions, load_table, save_table, table_exists
from tidemark.sources.warehouse import Warehouse

__all__ = [
    "Warehouse",
    "drop_partitions",
    "drop_versions",
    "email_load",
    "ip_range_load",
    "lead_load",
    "load_table",
    "model_batch",
    "model_batch_export",
    "model_output_load",
    "pixel_load",
    "save_table",
    "scrape_load",
    "table_exists",
]
