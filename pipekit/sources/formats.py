"""Named file formats and landing places."""

from __future__ import annotations

from dataclasses import dataclass

ON_ERROR = {"abort": "FAILFAST", "continue": "DROPMALFORMED", "report": "PERMISSIVE"}


@dataclass(frozen=True)
class FileFormat:
    """Delimited-text options shared by loads and exports."""

    sep: str = ","
    header: bool = True
    quote: str | None = '"'
    escape: str = '"'
    date_format: str = "yyyy-MM-dd"
    null_value: str = ""
    compression: str = "none"

    def reader_options(self) -> dict[str, str]:
        """Compression is found from the file extension, so it is not set here."""
        return {
            "sep": self.sep, "header": str(self.header).lower(), "quote": self.quote or "\u0000",
            "escape": self.escape, "dateFormat": self.date_format, "nullValue": self.null_value,
        }

    def writer_options(self) -> dict[str, str]:
        """Fields are enclosed only where they need it."""
        return {
            "sep": self.sep, "header": str(self.header).lower(), "quote": self.quote or "\u0000",
            "escape": self.escape, "dateFormat": self.date_format, "compression": self.compression,
            "quoteAll": "false", "nullValue": self.null_value, "emptyValue": '""' if self.quote else "",
        }


@dataclass(frozen=True)
class Stage:
    """A landing folder with its default format."""

    path: str
    format: FileFormat = FileFormat()

    def child(self, name: str) -> Stage:
        return Stage(f"{self.path.rstrip('/')}/{name}", self.format)
