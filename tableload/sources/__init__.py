"""Sources: declared-column scans (Parquet/ORC/CSV/JSON/JDBC) and the text COPY format."""

from .declared import declared_schema, scan_declared
from .delimited import scan_delimited, to_text_lines

__all__ = ["declared_schema", "scan_declared", "scan_delimited", "to_text_lines"]
