"""The WARC query. It has no SQL and is tested by reading back what was written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowmill.llm.tables import query, table
from rowmill.llm.warc import archive_pages, lookups, read_records
from rowmill.storage import new_path


@query("op4_warc_index")
def warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, read back through the capture index."""
    folder = new_path(spark, "warc")
    captures, index_files = archive_pages(spark, table(spark, sf_dir, "pages"), folder)
    wanted, tasks = lookups(captures)
    records = read_records(wanted, folder, index_files, with_payload=False, tasks=tasks)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
