from tierstat.streaming.ingest import start_ingest, stream_table, text_schema

__all__ = ["start_ingest", "stream_table", "text_schema"]
