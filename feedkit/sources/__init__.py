"""Source reading, publishing and the testdata adapters."""

from feedkit.sources.catalog import Namespace, Sources, export_text, publish, read_source, read_sources

__all__ = ["Namespace", "Sources", "export_text", "publish", "read_source", "read_sources"]
