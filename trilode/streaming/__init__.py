from trilode.streaming.ingest import ingest_stream, landing_stream, load_arrivals, read_arrivals

__all__ = ["ingest_stream", "landing_stream", "load_arrivals", "read_arrivals"]
