"""Document sources (S1-S5) and documents built from tables."""

from .documents import (
    document_lines, documents_from, parse_documents, read_document_lines, read_envelope, rejected_lines, scan_lines, unwrap_envelope,
)

__all__ = ["document_lines", "documents_from", "parse_documents", "read_document_lines",
           "read_envelope", "rejected_lines", "scan_lines", "unwrap_envelope"]
