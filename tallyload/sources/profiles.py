"""Load profiles: how a family's data files are read."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class LoadProfile:
    """``layout``:

    * ``lines``     one record per physical line, quote-aware (A4, A5)
    * ``continued`` physical lines glued until one ends in the quote char;
                    the glued lines lose their line breaks (A6)
    * ``multiline`` quoted fields may hold line breaks, which are kept
    """

    name: str
    layout: str = "lines"
    delimiter: str = ","
    quote: str = '"'
    escape: str = '"'
    encoding: str = "UTF-8"
    reject_limit: int | None = None  # per file; above it the file is ERROR (D6)

    def with_limit(self, limit: int | None) -> "LoadProfile":
        return replace(self, reject_limit=limit)

    def csv_options(self) -> dict[str, str]:
        return {
            "sep": self.delimiter,
            "quote": self.quote,
            "escape": self.escape,
            "encoding": self.encoding,
            "header": "false",
            "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": "_corrupt_record",
        }


# The reject limit of the external-table profile.
EXTERNAL_REJECT_LIMIT = 10000

PROFILES = {
    "quoted": LoadProfile("quoted"),
    "external": LoadProfile("external", reject_limit=EXTERNAL_REJECT_LIMIT),
    "continued": LoadProfile("continued", layout="continued"),
    "multiline": LoadProfile("multiline", layout="multiline"),
}
